"""Pieces of a byte-level BPE vocabulary and their ids, for many texts at once.

The library's own pre-tokenizer cuts text where the kind of character changes
(letters, numbers, white space, other). Here the cuts of a whole batch are found
with numpy; what kind a character is, is asked of the library once for each
character. Ids of a piece do not depend on its neighbours, so each different
piece is encoded by the library once and kept.
"""

import json
import re
from functools import cache

import numpy as np
from tokenizers import Tokenizer

from courtstats.llm.arrays import Prefixes

LETTER, NUMBER, SPACE, OTHER = range(4)
#: Pieces that are kept; beyond it the store of a worker starts anew.
MOST_KEPT = 1 << 20
#: Letters that join an apostrophe (fixed values of the pre-tokenizer).
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")


def vocabulary(name):
    """The path of one of the public vocabulary files."""
    import public_tokenizers

    return public_tokenizers.path(name)


@cache
def library(path):
    return Tokenizer.from_file(path)


@cache
def special_strings(path):
    """Texts that the library takes as one token wherever they stand."""
    added = library(path).get_added_tokens_decoder()
    return {t.content: i for i, t in added.items()}


@cache
def _kinds(path):
    return np.full(0x110000, 255, np.uint8)


def _kind(pre, char):
    for kind, beside in ((LETTER, "a"), (NUMBER, "1"), (OTHER, "!")):
        if len(pre.pre_tokenize_str(beside + char)) == 1:
            return kind
    return SPACE


def _learn(path, codes, kinds):
    pre = library(path).pre_tokenizer
    for code in np.unique(codes[kinds[codes] == 255]):
        kinds[code] = _kind(pre, chr(code))


def cut(path, data, offsets):
    """Where each piece begins, as positions in bytes; texts are whole UTF-8.

    Also begin and end of white space of several characters before other text,
    which is one piece as long as that text is not there.
    """
    first = np.flatnonzero((data & 0xC0) != 0x80)
    if not len(first):
        return first, first, first
    codes = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    kinds = _kinds(path)
    _learn(path, codes, kinds)
    kind = kinds[codes]
    n = len(codes)
    edge = np.zeros(n + 1, bool)
    edge[np.searchsorted(first, offsets)] = True
    text_edge = edge.copy()
    text_edge[n] = True
    edge[0] = True
    edge[1:n] |= kind[1:] != kind[:-1]
    edge[n] = True
    # The last of several white-space characters before other text stands apart;
    # a blank there joins what follows.
    last_space = np.zeros(n, bool)
    last_space[:-1] = (kind[:-1] == SPACE) & (kind[1:] != SPACE)
    last_space &= ~text_edge[1:]
    several = np.flatnonzero(last_space[1:] & (kind[:-1] == SPACE) & ~text_edge[1:n]) + 1
    edges = np.flatnonzero(edge)
    run = first[edges[np.searchsorted(edges, several, "right") - 1]]
    run_end = first[several + 1]
    edge[:n] |= last_space
    blank = np.flatnonzero(last_space & (codes == 0x20))
    edge[blank + 1] = False
    # An apostrophe alone, with no blank before it, takes some letters along.
    alone = np.flatnonzero((codes == 0x27) & edge[:n] & edge[1:] & ~text_edge[1:])
    alone = alone[kind[alone + 1] == LETTER]
    for letters in CONTRACTIONS:
        at = alone
        for k, letter in enumerate(letters):
            at = at[at + 1 + k < n]
            at = at[(codes[at + 1 + k] == ord(letter)) & ~text_edge[at + 1 + k]]
        edge[at + 1] = False
        edge[at + 1 + len(letters)] = True
    return first[np.flatnonzero(edge[:n])], run, run_end


class Store:
    """Values of different pieces, found by a 64-bit hash of the piece."""

    def __init__(self, of_pieces):
        self.of_pieces = of_pieces
        self.clear()

    def clear(self):
        self.hashes = np.zeros(0, np.uint64)
        self.at = np.zeros(0, np.int64)
        self.values, self.offsets = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def find(self, hashes, data, starts, ends):
        """For each piece its row in ``offsets``."""
        each, where, back = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.hashes) > MOST_KEPT:
            self.clear()
        place = np.searchsorted(self.hashes, each)
        known = place < len(self.hashes)
        known[known] = self.hashes[place[known]] == each[known]
        new = np.flatnonzero(~known)
        if len(new):
            raw = data.tobytes()
            lists = self.of_pieces([raw[starts[i] : ends[i]] for i in where[new]])
            sizes = np.fromiter(map(len, lists), np.int64, len(lists))
            flat = np.fromiter((x for own in lists for x in own), np.uint32, sizes.sum())
            row = len(self.offsets) - 1
            self.values = np.concatenate([self.values, flat])
            self.offsets = np.concatenate([self.offsets, self.offsets[-1] + np.cumsum(sizes)])
            merged = np.concatenate([self.hashes, each[new]])
            at = np.concatenate([self.at, row + np.arange(len(new))])
            order = np.argsort(merged, kind="stable")
            self.hashes, self.at = merged[order], at[order]
            place = np.searchsorted(self.hashes, each)
        return self.at[place][back]


@cache
def byte_characters():
    """The character that stands for each byte in the vocabulary file."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    table = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [table[b] for b in range(256)]


@cache
def tokens(path):
    """``bytes: id`` of all ordinary tokens, where ids follow the order of merges.

    Then a merge with a smaller id is always done first, and ids are ranks too.
    """
    model = json.loads(library(path).to_str())["model"]
    of = {c: b for b, c in enumerate(byte_characters())}
    raw = {w: bytes(of[c] for c in w) for w in model["vocab"]}
    made = [model["vocab"]["".join(m)] for m in model["merges"]]
    if made != sorted(made) or len(made) + 256 != len(raw):
        raise ValueError("ids of this vocabulary do not follow its merges")
    return {raw[w]: i for w, i in model["vocab"].items()}


def _piece_ids(path):
    """Encode single pieces; tiktoken needs a fifth of the time for the same ids."""
    import tiktoken

    pattern = r"(?s).+"
    encoding = tiktoken.Encoding(
        "own", pat_str=pattern, mergeable_ranks=tokens(path), special_tokens={}
    )
    return lambda raw: [encoding.encode_ordinary(x.decode("utf-8")) for x in raw]


@cache
def _id_store(path):
    return Store(_piece_ids(path))


def piece_spans(path, data, offsets):
    """Starts, ends and hashes of all pieces, and the number in each text."""
    starts = cut(path, data, offsets)[0]
    ends = np.append(starts[1:], len(data))[: len(starts)]
    counts = np.diff(np.searchsorted(starts, offsets))
    return starts, ends, Prefixes(data).of(starts, ends) if len(starts) else starts.astype(np.uint64), counts


def ids_of(path, data, offsets):
    """All ids of some texts, one array, and how many each text has."""
    if any(s.encode() in data.tobytes() for s in special_strings(path)):
        lists = [_ids_around(path, data[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
        return np.concatenate(lists), np.array([len(x) for x in lists], np.int64)
    starts, ends, hashes, counts = piece_spans(path, data, offsets)
    store = _id_store(path)
    row = store.find(hashes, data, starts, ends)
    begin, size = store.offsets[row], store.offsets[row + 1] - store.offsets[row]
    total = np.cumsum(size)
    at = np.repeat(begin - (total - size), size) + np.arange(total[-1] if len(total) else 0)
    edges = np.append(0, total)[np.append(0, np.cumsum(counts))]
    return store.values[at], np.diff(edges)


def _ids_around(path, data):
    """Ids of one text that may hold special strings."""
    text = data.tobytes().decode("utf-8")
    special = special_strings(path)
    longest_first = "|".join(re.escape(s) for s in sorted(special, key=len, reverse=True))
    parts = []
    for part in re.split(f"({longest_first})", text):
        if part in special:
            parts.append(np.array([special[part]], np.uint32))
        elif part:
            raw = np.frombuffer(part.encode(), np.uint8)
            parts.append(ids_of(path, raw, np.array([0, len(raw)]))[0])
    return np.concatenate(parts) if parts else np.zeros(0, np.uint32)
