"""Toxicity of restored text.

Disguised words (digits and signs for letters, spelled-out or repeated letters) are
restored by a noisy channel: every sign of such a word offers some letters or
nothing, and the Viterbi path through this lattice under a bigram model of letters,
counted over the whole corpus, is the word that was meant. A linear model over words
and beginnings of words then scores the restored text.

The model is fitted on at most ``most_labelled`` rows of each class; the letter
model counts every text.
"""

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtstats.llm.arrays import LARGE_SLICE_BYTES, Prefixes, pieces
from courtstats.sources.shared import stage

#: Letters that signs stand for (fixed values); a sign may also stand for nothing.
SIGNS = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t",
    "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "li", "+": "t", "€": "e",
}
GAPS = "._-*~"
LETTERS = "abcdefghijklmnopqrstuvwxyzàáâäãåæçèéêëìíîïñòóôöõøœùúûüýÿß"
SIZE = 64
OTHER = SIZE - 1
#: Log probabilities of the channel.
SUBSTITUTED, DROPPED = np.log(0.4), np.log(0.2)
BEGINNINGS = (3, 4, 5, 6, 7, 8)
MOST_LABELLED = 4000
FOLDS = 5
ROWS_AT_A_TIME = 1000
#: Words, and steps of words, that are searched at a time.
MOST_WORDS, MOST_STEPS = 4096, 1_000_000


@cache
def _tables():
    """Lower case, letter number and kind of every character.

    Kinds: 0 other, 1 letter, 2 sign, 3 gap, 4 white space.
    """
    lower = np.arange(0x110000, dtype=np.uint32)
    kind = np.zeros(0x110000, np.uint8)
    for c in range(0x110000):
        x = chr(c)
        if x.isalpha():
            kind[c] = 1
            low = x.lower()
            if len(low) == 1:
                lower[c] = ord(low)
    for table, k in ((SIGNS, 2), (GAPS, 3), (" \t\n\x0b\f\r", 4)):
        kind[[ord(x) for x in table]] = k
    number = np.where(kind == 1, OTHER, 0).astype(np.uint8)
    number[[ord(x) for x in LETTERS]] = np.arange(1, len(LETTERS) + 1)
    return lower, number[lower], kind


def _codes(data, offsets):
    """Characters of some texts, and where each text begins among them."""
    codes = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    first = np.flatnonzero((data & 0xC0) != 0x80)
    return _tables()[0][codes], np.searchsorted(first, offsets)


def _counted_pairs(batches):
    total = np.zeros(SIZE * SIZE, np.int64)
    for batch in batches:
        for _, _, data, offsets in pieces(batch.column(0), LARGE_SLICE_BYTES):
            codes, edges = _codes(data, offsets)
            number = np.insert(_tables()[1][codes], edges, 0).astype(np.int64)
            total += np.bincount(number[:-1] * SIZE + number[1:], minlength=SIZE * SIZE)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["pair", "n"])


def letter_model(docs: DataFrame) -> np.ndarray:
    """Log probabilities of a letter after a letter, over every text; 0 is no letter."""
    counts = np.zeros(SIZE * SIZE)
    pairs = docs.select("text").mapInArrow(_counted_pairs, "pair bigint, n bigint")
    for row in pairs.groupBy("pair").agg(F.sum("n").alias("n")).collect():
        counts[row.pair] = row.n
    counts = counts.reshape(SIZE, SIZE) + 0.1
    counts[0, 0] = 0.1
    return np.log(counts / counts.sum(axis=1, keepdims=True))


@cache
def _letter_step(letter, double):
    return (letter,), False, double


@cache
def _sign_step(code, double):
    return tuple(LETTERS.index(x) + 1 for x in SIGNS[chr(code)]), True, double


_GAP_STEP = (), True, False


def _runs(word):
    """Begin and end of the runs of equal characters."""
    cuts = np.append(np.flatnonzero(word[1:] != word[:-1]) + 1, len(word))
    return np.append(0, cuts[:-1]), cuts


def _step_codes(word):
    """The character of each step of a word's lattice."""
    begins, ends = _runs(word)
    size, kind = ends - begins, _tables()[2][word[begins]]
    once = (kind == 1) & (size > 2) | (kind == 2) & (size != 2) | (kind != 1) & (kind != 2)
    return np.repeat(word[begins], np.where(once, 1, size))


def _lattice(word):
    """Steps of a word: (letters, may be dropped, may be double) after joining runs."""
    number, kind = _tables()[1], _tables()[2]
    steps = []
    for begin, end in zip(*map(np.ndarray.tolist, _runs(word))):
        code, n = int(word[begin]), end - begin
        if kind[code] == 1:
            letter = int(number[code])
            steps += [_letter_step(letter, False)] * n if n < 3 else [_letter_step(letter, True)]
        elif kind[code] == 2:
            steps += [_sign_step(code, n > 1)] if n != 2 else [_sign_step(code, False)] * 2
        else:
            steps.append(_GAP_STEP)
    return steps


def _restored(words, model, lattice):
    """The characters of each disguised word; letters without a number keep their own."""
    plain = np.array([0, *map(ord, LETTERS)] + [0] * (SIZE - 1 - len(LETTERS)), np.uint32)
    out = []
    for word, found in zip(words, _decoded(words, model, lattice)):
        letters, steps = np.array(found, np.int64).reshape(-1, 2).T
        out.append(np.where(letters == OTHER, _step_codes(word)[steps], plain[letters]))
    return out


def decode(words, model):
    """The most likely letters of each disguised word, as letter numbers."""
    return [[letter for letter, _ in word] for word in _decoded(words, model)]


def _ending(steps):
    """Steps of a word whose signs behind the last letter all stand for letters."""
    at = max((t + 1 for t, x in enumerate(steps) if x[0] and not x[1]), default=0)
    return steps[:at] + [(x[0], False, x[2]) if x[0] else x for x in steps[at:]]


def _decoded(words, model, lattice=_lattice):
    """The most likely letters of each disguised word, each with its step.

    A path has to pass every plain letter, so it is the best path from each of them
    to the next; only the steps between are searched.
    """
    out = [[] for _ in words]
    parts, places = [], []
    for i, word in enumerate(words):
        steps, before, open_steps = lattice(word), 0, []
        for t, step in enumerate([*steps, None]):
            if step is not None and (step[1] or step[2] or len(step[0]) > 1):
                open_steps.append(step)
                continue
            letter = step[0][0] if step is not None else 0
            if open_steps:
                places.append((i, len(out[i]), t - len(open_steps)))
                out[i].append(None)
                parts.append((before, open_steps, letter))
                open_steps = []
            if step is not None:
                out[i].append(((letter, t),))
            before = letter
    order = sorted(range(len(parts)), key=lambda k: -len(parts[k][1]))
    at = 0
    while at < len(order):
        # The first of a group is its longest.
        most = max(1, min(MOST_WORDS, MOST_STEPS // len(parts[order[at]][1])))
        group = order[at : at + most]
        at += len(group)
        for k, letters in zip(group, _viterbi([parts[k] for k in group], model)):
            i, place, first = places[k]
            out[i][place] = [(letter, first + t) for letter, t in letters]
    return [[x for part in word for x in part] for word in out]


def _viterbi(parts, model):
    """The letters of the best path of each part, each with its step.

    A part is (letter before, steps, letter after). A step leads to its one or two letters or leaves the state as it is, so two
    sources and two numbers of letters are kept for each, 4 bytes in all.
    """
    n, steps = len(parts), max(len(p[1]) for p in parts)
    rows = np.arange(n)
    best = np.full((n, SIZE), -np.inf)
    best[rows, [p[0] for p in parts]] = 0
    offered = np.zeros((steps, n, 2), np.uint8)
    # Beyond its end a part stays as it is: kind 0. Kinds 1 and 2: letter, sign or gap.
    kinds = np.zeros((steps, n), np.uint8)
    doubles = np.zeros((steps, n), bool)
    for i, (_, own, _) in enumerate(parts):
        offered[: len(own), i, 0] = [x[0][0] if x[0] else 0 for x in own]
        offered[: len(own), i, 1] = [x[0][1] if len(x[0]) > 1 else 0 for x in own]
        kinds[: len(own), i] = [1 + x[1] for x in own]
        doubles[: len(own), i] = [x[2] for x in own]
    back = np.zeros((steps, n, 2), np.uint8)
    count = np.zeros((steps, n, 2), np.uint8)
    staying, costs = np.array([0.0, -np.inf, DROPPED]), np.array([0.0, 0.0, SUBSTITUTED])
    for t in range(steps):
        new = best + staying[kinds[t]][:, None]
        cost = costs[kinds[t]]
        for k in range(2):
            letter = offered[t, :, k].astype(np.int64)
            has = letter > 0
            if not has.any():
                continue
            score = best + model[:, letter].T
            source = score.argmax(axis=1)
            once = score[rows, source] + cost
            twice = np.where(doubles[t], once + model[letter, letter], -np.inf)
            value = np.maximum(once, twice)
            better = has & (value > new[rows, letter])
            at = rows[better]
            new[at, letter[better]] = value[better]
            back[t, at, k] = source[better]
            count[t, at, k] = np.where(twice > once, 2, 1)[better]
        best = new
    state = (best + model[:, [p[2] for p in parts]].T).argmax(axis=1)
    paths = [[] for _ in range(n)]
    for t in range(steps - 1, -1, -1):
        before = state.copy()
        for k in range(2):
            taken = (count[t, :, k] > 0) & (offered[t, :, k] == state)
            for i in np.flatnonzero(taken):
                paths[i] += [(int(state[i]), t)] * int(count[t, i, k])
            before[taken] = back[t, taken, k]
        state = before
    return [p[::-1] for p in paths]


def _tokens(stop, first):
    """Begin and end of runs of characters outside ``stop``; texts begin at ``first``."""
    begin = ~stop & (np.append(True, stop[:-1]) | first)
    end = ~stop & np.append(stop[1:] | first[1:], True)
    return np.flatnonzero(begin), np.flatnonzero(end) + 1


def _disguised(codes, edges):
    """Spans of disguised words: begin and end among the characters.

    Words end at blanks and at characters that are no letter, sign or gap. A word
    with gaps is taken both whole and in the parts between its gaps. Two signs in a
    row are a word even without letters.
    """
    kind = _tables()[2][codes]
    n = len(codes)
    first = np.zeros(n, bool)
    first[edges[:-1][edges[:-1] < n]] = True
    letter, sign, gap = kind == 1, kind == 2, kind == 3
    before = lambda x: np.append(False, x[:-1]) & ~first
    after = lambda x: np.append(x[1:] & ~first[1:], False)
    thrice = letter & before(letter & (codes == np.append(codes[:1], codes[:-1])) & before(letter))
    thrice &= codes == np.append(codes[:1], codes[:-1])
    touching = sign & (before(letter | sign) | after(letter | sign))
    spans = []
    for whole in (True, False):
        stop = (kind == 4) | (kind == 0) | (gap & (not whole))
        starts, ends = _tokens(stop, first)
        if not len(starts):
            return starts, starts
        sums = lambda x: np.diff(np.append(0, np.cumsum(x))[np.stack([starts, ends])], axis=0)[0]
        letters, signs, gaps = sums(letter), sums(sign), sums(gap)
        # A sign counts wherever it touches a letter or another sign.
        odd = (sums(touching) > 0) | (sums(thrice) > 0)
        if whole:
            odd |= (gaps >= 2) & (2 * (letters + signs) <= 3 * gaps + 3)
            odd &= (gaps > 0) & (letters + signs > 0)
            # Three or more single characters in a row are one word, spelled with blanks.
            single = (ends - starts == 1) & (letters + signs == 1)
            joined = single[1:] & single[:-1] & (starts[1:] - ends[:-1] == 1) & ~first[starts[1:]]
            joined &= kind[ends[:-1]] == 4
            run = np.flatnonzero(np.diff(joined.astype(np.int8), prepend=0, append=0)).reshape(-1, 2)
            run = run[run[:, 1] - run[:, 0] >= 2]
            spans.append((starts[run[:, 0]], ends[run[:, 1]]))
        spans.append((starts[odd], ends[odd]))
    return tuple(np.concatenate(x) for x in zip(*spans))


def _readings(codes, begins, ends, model):
    """Restored words and the number of the span of each.

    A word with signs behind its last letter is read twice: as the lattice judges
    them, and with all of them for letters, because dropping the last sign of a
    word often looks as likely.
    """
    names = [codes[b:e].tobytes() for b, e in zip(begins, ends)]
    different = {name: None for name in names}
    words = [np.frombuffer(x, np.uint32) for x in different]
    kinds = [_tables()[2][w] for w in words]
    signed = [bool((k[(k == 1).nonzero()[0].max(initial=-1) + 1 :] == 2).any()) for k in kinds]
    found = {name: [x] for name, x in zip(different, _restored(words, model, _lattice))}
    again = [w for w, x in zip(words, signed) if x]
    for w, x in zip(again, _restored(again, model, lambda w: _ending(_lattice(w)))):
        found[w.tobytes()].append(x)
    flat = [x for name in names for x in found[name]]
    return flat, np.repeat(np.arange(len(names)), [len(found[name]) for name in names])


def _features(column, model):
    """For each text: hashes of its words and their beginnings, as written and restored."""
    for first, last, data, offsets in pieces(column, LARGE_SLICE_BYTES):
        codes, edges = _codes(data, offsets)
        begins, ends = _disguised(codes, edges)
        owner = np.searchsorted(edges, begins, "right") - 1
        words, of = _hashes(codes, _tables()[2][codes] == 1, edges)
        if len(begins):
            flat, span = _readings(codes, begins, ends, model)
            owner = owner[span]
            cut = np.cumsum([0, *[len(f) for f in flat]])
            joined = np.concatenate(flat).astype(np.uint32)
            more, row = _hashes(joined, joined > 0, cut)
            words, of = np.concatenate([words, more]), np.concatenate([of, owner[row]])
        yield first, last, words, of


def _hashes(codes, letter, edges):
    """Hashes of runs of letters and of their beginnings, with the row of each."""
    n = len(codes)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    before = np.append(False, letter[:-1])
    before[edges[:-1][edges[:-1] < n]] = False
    after = np.append(letter[1:], False)
    after[edges[1:][edges[1:] > 0] - 1] = False
    starts, ends = np.flatnonzero(letter & ~before), np.flatnonzero(letter & ~after) + 1
    row = np.searchsorted(edges, starts, "right") - 1
    prefix = Prefixes(codes)
    hashes, rows = [prefix.of(starts, ends)], [row]
    for size in BEGINNINGS:
        long = ends - starts > size
        hashes.append(prefix.of(starts[long], starts[long] + size) ^ np.uint64(size))
        rows.append(row[long])
    return np.concatenate(hashes), np.concatenate(rows)


def _counted_features(model):
    def run(batches):
        toxic, clean = [], []
        for batch in batches:
            label = batch.column(1).to_numpy()
            for first, last, words, of in _features(batch.column(0), model):
                order = np.lexsort((words, of))
                words, of = words[order], of[order]
                new = np.append(True, (words[1:] != words[:-1]) | (of[1:] != of[:-1]))[: len(words)]
                for value, kept in ((1, toxic), (0, clean)):
                    kept.append(np.unique(words[new & (label[first + of] == value)], return_counts=True))
        for kept, column in ((toxic, 0), (clean, 1)):
            if kept:
                words = np.concatenate([k[0] for k in kept])
                each, back = np.unique(words, return_inverse=True)
                n = np.bincount(back, weights=np.concatenate([k[1] for k in kept])).astype(np.int64)
                n = n if len(each) else np.zeros(0, np.int64)
                zero = np.zeros(len(each), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(each.view(np.int64)), pa.array(zero if column else n), pa.array(n if column else zero)],
                    ["feature", "toxic", "clean"],
                )

    return run


def _present(model, chosen):
    """For each batch: row and place among ``chosen`` of every feature that a text has."""
    low = np.uint64((1 << 22) - 1)
    filled = np.zeros(1 << 22, bool)
    filled[(chosen & low).astype(np.int64)] = True

    def find(column):
        for first, last, words, of in _features(column, model):
            keep = np.flatnonzero(filled[(words & low).astype(np.int64)])
            words, of = words[keep], of[keep]
            place = np.searchsorted(chosen, words)
            place[place == len(chosen)] = 0
            hit = chosen[place] == words if len(chosen) else np.zeros(0, bool)
            pair = np.unique((of[hit] + first) * len(chosen) + place[hit])
            yield first, last, pair // max(1, len(chosen)), pair % max(1, len(chosen))

    return find


def _examples(model, chosen):
    def run(batches):
        for batch in batches:
            found = [[] for _ in range(batch.num_rows)]
            for _, _, row, place in _present(model, chosen)(batch.column(0)):
                for i, p in zip(row.tolist(), place.tolist()):
                    found[i].append(p)
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array(found, pa.list_(pa.int64()))], ["toxic", "features"]
            )

    return run


def fit(examples, size, rounds=300, rate=1.0, decay=1e-4):
    """Weights and bias of a logistic model over sets of features, classes alike."""
    label = np.array([e[0] for e in examples], float)
    row = np.repeat(np.arange(len(examples)), [len(e[1]) for e in examples])
    place = np.array([p for e in examples for p in e[1]], np.int64)
    share = np.where(label == 1, 0.5 / max(1, label.sum()), 0.5 / max(1, (1 - label).sum()))
    weight, bias = np.zeros(size), 0.0
    step, bias_step = np.full(size, 1e-8), 1e-8
    for _ in range(rounds):
        sums = np.bincount(row, weights=weight[place], minlength=len(label)) + bias
        error = (1 / (1 + np.exp(-sums)) - label) * share
        slope = np.bincount(place, weights=error[row], minlength=size) + decay * weight
        step += slope**2
        bias_step += error.sum() ** 2
        weight -= rate * slope / np.sqrt(step)
        bias -= rate * error.sum() / np.sqrt(bias_step)
    return weight, bias


def _scores(column, model, chosen, weight, bias):
    sums = np.full(len(column), bias)
    for _, _, row, place in _present(model, chosen)(column):
        np.add.at(sums, row, weight[place])
    return pa.array(1 / (1 + np.exp(-np.clip(sums, -500, 500))), pa.float64())


def _scored(*learned):
    def run(batches):
        for batch in batches:
            score = _scores(batch.column(1), *learned)
            yield pa.RecordBatch.from_arrays([batch.column(0), score], ["doc_id", "score"])

    return run


def _scored_rows(text, *learned):
    """All columns and a score, some rows of a batch at a time."""

    def run(batches):
        for batch in batches:
            for begin in range(0, batch.num_rows, ROWS_AT_A_TIME):
                some = batch.slice(begin, ROWS_AT_A_TIME)
                score = _scores(some.column(text), *learned)
                yield pa.RecordBatch.from_arrays([*some.columns, score], [*batch.schema.names, "score"])

    return run


def _held_out(doc_id):
    number = F.coalesce(F.crc32(doc_id.cast("string").cast("binary")), F.lit(0))
    return F.pmod(number, F.lit(FOLDS)) == 0


def train(docs: DataFrame, labels: DataFrame, most_labelled: int = MOST_LABELLED):
    """The letter model, chosen features, weights and bias.

    Labels of rows with crc32(doc_id as text) mod 5 = 0, null ids and null labels
    are not used; a document labelled both ways counts as toxic. Without any label
    of one class, or if no feature tells the classes apart, no feature is chosen and
    every score is the share of toxic labels.
    """
    model = letter_model(docs)
    usable = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~_held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    some = [
        usable.where(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_labelled)
        for k in (0, 1)
    ]
    # At most 2 x most_labelled pairs of numbers.
    sample = F.broadcast(some[0].unionByName(some[1]))
    found = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(sample, "doc_id")
    # Ids that repeat do not make the sample larger.
    order = F.xxhash64("doc_id"), "doc_id", F.sha2(F.col("text").cast("binary"), 256)
    some = [found.where(F.col("toxic") == k).orderBy(*order).limit(most_labelled) for k in (0, 1)]
    rows = stage(
        some[0].unionByName(some[1]).select("text", F.col("toxic").cast("bigint").alias("toxic")), "examples"
    )
    totals = {r.toxic: r["count"] for r in rows.groupBy("toxic").count().collect()}
    if not totals.get(0) or not totals.get(1):
        rate = 1.0 if totals.get(1) else 0.0
        return model, np.zeros(0, np.uint64), np.zeros(0), 20.0 if rate else -20.0
    odds = F.log((F.col("t") + 0.5) / (totals[1] + 1)) - F.log((F.col("c") + 0.5) / (totals[0] + 1))
    counted = (
        rows.mapInArrow(_counted_features(model), "feature bigint, toxic bigint, clean bigint")
        .groupBy("feature")
        .agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c"))
        .where(F.col("t") >= max(3, totals[1] // 500))
        .where(odds >= float(np.log(8)))
        .select("feature")
    )
    # All of them; the bounded sample bounds them too.
    chosen = np.sort(np.array([r.feature for r in counted.collect()], np.int64).view(np.uint64))
    if not len(chosen):
        share = {r.toxic: r["count"] for r in usable.groupBy("toxic").count().collect()}
        return model, chosen, np.zeros(0), float(np.log(share[1] / share[0]))
    examples = rows.mapInArrow(_examples(model, chosen), "toxic bigint, features array<bigint>")
    weight, bias = fit([(r.toxic, r.features) for r in examples.collect()], len(chosen))
    return model, chosen, weight, bias


def score_texts(docs: DataFrame, labels: DataFrame, most_labelled: int = MOST_LABELLED) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``.

    ``score`` looks at the whole text only. Null and empty texts get the score of a
    text without features. ``held_out`` marks rows whose crc32(doc_id as text) mod 5
    is 0 (null ids too). Rows that repeat are scored each;
    an empty table gives no rows, texts are taken whole, however long, and other
    columns are not read.
    """
    learned = train(docs, labels, most_labelled)
    return docs.select("doc_id", "text").mapInArrow(_scored(*learned), "doc_id bigint, score double").select(
        "doc_id",
        _held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` with a score under 0.5, all columns kept.

    Scores are those of ``score_texts``: null and empty texts and rows that repeat are
    scored each, an empty table stays empty.
    """
    learned = train(docs, labels)
    # Columns go by number, so names neither clash nor need quoting, and the text
    # goes to the workers once.
    numbered = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    shape = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in numbered.schema.fields)
    return (
        numbered.mapInArrow(_scored_rows(docs.columns.index("text"), *learned), f"{shape}, score double")
        .where("score < 0.5")
        .drop("score")
        .toDF(*docs.columns)
    )
