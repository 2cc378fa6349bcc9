"""Token counts at every prefix of a text, by dynamic programming.

The last token of a prefix is the one token ending there that goes with the last
token of the prefix before it: a pair goes together if encoding both gives the
pair again. So each prefix costs a few lookups, and its count is one more than an
earlier one.

The counts are stored as steps from character to character, two bytes for each byte
of text that compress well. They answer how many tokens any beginning of a text has,
and which beginning fits any number of tokens, without encoding again.
"""

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtstats.llm import byte_bpe
from courtstats.llm.arrays import LARGE_SLICE_BYTES, Prefixes, pieces
from courtstats.sources.shared import stage

VOCABULARY = "byte_bpe_50k.json"
_MOST_PAIRS = 1 << 20
#: Stored for a byte that does not end a character.
INSIDE = -(1 << 15)


@cache
def _pairs(path):
    """Whether two tokens stay as they are when one follows the other."""
    import tiktoken

    raw = {i: t for t, i in byte_bpe.tokens(path).items()}
    encoding = tiktoken.Encoding(
        "own", pat_str=r"(?s).+", mergeable_ranks=byte_bpe.tokens(path), special_tokens={}
    )
    known = {}

    def stay(a, b):
        found = known.get((a, b))
        if found is None:
            if len(known) > _MOST_PAIRS:
                known.clear()
            found = known[a, b] = encoding._encode_single_piece(raw[a] + raw[b]) == [a, b]
        return found

    return stay


def prefix_dynamic_program(path, piece):
    """The number of tokens of each beginning of one piece, as a list."""
    ids, stay = byte_bpe.tokens(path), _pairs(path)
    longest = _longest(path)
    last, counts = [0], [0]
    for end in range(1, len(piece) + 1):
        for begin in range(max(0, end - longest), end):
            token = ids.get(piece[begin:end])
            if token is not None and (begin == 0 or stay(last[begin], token)):
                last.append(token)
                counts.append(counts[begin] + 1)
                break
    return counts[1:]


@cache
def _longest(path):
    return max(map(len, byte_bpe.tokens(path)))


@cache
def _store(path):
    return byte_bpe.Store(lambda raw: [prefix_dynamic_program(path, x) for x in raw])


def prefix_counts(path, data, offsets):
    """For each byte that ends a character: tokens of its text up to there."""
    held = data.tobytes()
    if any(s.encode() in held for s in byte_bpe.special_strings(path)):
        parts = [_around(path, data[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
        return np.concatenate(parts)
    if not len(data):
        return np.zeros(0, np.int64)
    starts, run, run_end = byte_bpe.cut(path, data, offsets)
    size = np.diff(np.append(starts, len(data)))
    hashes = Prefixes(data)
    store = _store(path)
    row = store.find(hashes.of(starts, starts + size), data, starts, starts + size)
    inside = np.repeat(store.offsets[row] - starts, size) + np.arange(len(data))
    inside = store.values[inside].astype(np.int64)
    total = np.append(0, np.cumsum(inside[starts + size - 1]))
    texts = np.searchsorted(starts, offsets)
    base = total[:-1] - np.repeat(total[texts[:-1]], np.diff(texts))
    out = inside + np.repeat(base, size)
    if len(run):
        # White space at the end of a prefix is one piece; before text it is two.
        row = store.find(hashes.of(run, run_end), data, run, run_end)
        alone = store.values[store.offsets[row + 1] - 1].astype(np.int64)
        out[run_end - 1] = base[np.searchsorted(starts, run)] + alone
    begin = starts[size == 3]
    begin = begin[data[begin] == 0x27]
    for tail in byte_bpe.CONTRACTIONS:
        if len(tail) == 2:
            at = begin[(data[begin + 1] == ord(tail[0])) & (data[begin + 2] == ord(tail[1]))]
            out[at + 1] = out[at] + 1
    return out


def _around(path, data):
    """Counts of one text that may hold special strings.

    Until such a string is complete its beginning is ordinary text.
    """
    special = [s.encode() for s in byte_bpe.special_strings(path)]
    text, done, base, out = data.tobytes(), 0, 0, []
    while done < len(text):
        found = [(text.find(s, done), -len(s), s) for s in special if text.find(s, done) >= 0]
        if not found:
            part = data[done:]
            out.append(base + prefix_counts(path, part, np.array([0, len(part)])))
            break
        at, _, string = min(found)
        plain = data[done:at]
        before = prefix_counts(path, plain, np.array([0, len(plain)]))
        open_ = data[done : at + len(string) - 1]
        counts = prefix_counts(path, open_, np.array([0, len(open_)]))
        counts[: len(plain)] = before
        out.append(base + counts)
        base += (before[-1] if len(before) else 0) + 1
        out.append(np.array([base]))
        done = at + len(string)
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def steps_of(data, counts, offsets):
    """How many tokens each character adds to its text, at its last byte.

    The other bytes of a character hold ``INSIDE``.
    """
    ends = np.append((data[1:] & 0xC0) != 0x80, True)[: len(data)]
    at = np.flatnonzero(ends)
    steps = np.full(len(data), INSIDE, "<i2")
    steps[at] = np.diff(counts[at], prepend=0)
    # The first character of a text starts from nothing.
    first = np.unique(np.searchsorted(at, offsets[:-1][offsets[1:] > offsets[:-1]]))
    steps[at[first]] = counts[at[first]]
    return steps


def fitting(steps, limit):
    """Bytes of the longest beginning with at most ``limit`` tokens, in whole characters."""
    ends = steps != INSIDE
    counts = np.cumsum(np.where(ends, steps, 0), dtype=np.int64)
    fit = np.flatnonzero(ends & (counts <= limit))
    return int(fit[-1]) + 1 if len(fit) else 0


def _stored(path):
    def run(batches):
        for batch in batches:
            for begin, end, data, offsets in pieces(batch.column(1), LARGE_SLICE_BYTES):
                steps = steps_of(data, prefix_counts(path, data, offsets), offsets)
                totals = np.append(0, np.cumsum(np.where(steps == INSIDE, 0, steps), dtype=np.int64))
                held, at = steps.tobytes(), (2 * offsets).tolist()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(begin, end - begin),
                        pa.array(np.diff(offsets), pa.int64()),
                        pa.array(np.diff(totals[offsets]), pa.int64()),
                        pa.array([held[a:b] for a, b in zip(at[:-1], at[1:])], pa.binary()),
                    ],
                    ["doc_id", "n_bytes", "n_tokens", "steps"],
                )

    return run


def _fitted(limit):
    def run(batches):
        for batch in batches:
            totals = batch.column(2).to_numpy()
            fits = batch.column(1).to_numpy().copy()
            for i in np.flatnonzero(totals > limit):
                fits[i] = fitting(np.frombuffer(batch.column(3)[i].as_py(), "<i2"), limit)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(fits, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens", "fit_bytes"],
            )

    return run


def prefix_table(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, steps`` for every row of ``docs``.

    ``steps`` are 16-bit numbers, little-endian, one for each byte of the text: the
    tokens that a character adds, at its last byte. Null counts as empty. Rows that
    repeat are counted each, an empty table gives no rows, other columns are not
    read. Texts are worked on in slices of 1 MB, a longer one alone.
    """
    path = path or byte_bpe.vocabulary(VOCABULARY)
    return docs.select("doc_id", "text").mapInArrow(
        _stored(path), "doc_id bigint, n_bytes bigint, n_tokens bigint, steps binary"
    )


def longest_beginnings(table: DataFrame, limit: int) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, fit_bytes``: what fits ``limit`` tokens, from stored steps."""
    return table.select("doc_id", "n_bytes", "n_tokens", "steps").mapInArrow(
        _fitted(limit), "doc_id bigint, n_bytes bigint, n_tokens bigint, fit_bytes bigint"
    )


def token_counts(docs: DataFrame, limit: int = 512, path: str | None = None) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit, fit_bytes`` for every row of ``docs``.

    ``n_tokens`` is what the library gives for the whole text (null: empty) without
    added tokens, ``fit_bytes`` the length of the longest beginning, in whole
    characters, of at most ``limit`` tokens. The counts at all prefixes are stored
    first, as ``prefix_table`` gives them. Rows that repeat are counted each; an empty
    table gives no rows and other columns are not read. ``path`` is a byte-level BPE
    vocabulary file.
    """
    return longest_beginnings(stage(prefix_table(docs, path), "prefix-counts"), limit).select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), "fit_bytes"
    )
