"""Removal of long repeated byte strings by shard suffix arrays.

Every window of ``length`` bytes is owned by an anchor inside it: the 8 bytes with
the smallest hash, the leftmost of equals. Equal windows have the same anchor at
the same place, so windows are dealt to shards by text that all windows of an
anchor's half share (about half a window). Shares that occur once in the whole
corpus cannot hold a repeated window and are left out before any text moves.

What remains is cut into fragments (the owned starts and one window more), equal
fragments are counted once, and each shard builds the suffix array of its
fragments by induced sorting and their permuted common prefixes. Starts whose
neighbours in suffix order agree for a whole window are repeated; they go back to
the documents by fragment.

Runs of some number of words can be asked for besides. Their windows are owned by
anchors of ``WORD_GRAM`` words and thinned out by shares in the same way; what
remains is compared by 128-bit digests of single windows.
"""

import hashlib
from itertools import accumulate, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest

from courtstats.llm.arrays import Prefixes, bytes_of, in_batches, mix, pieces, word_spans
from courtstats.llm.super_kmers import texts_with_shared_windows
from courtstats.llm.suffix_array import permuted_common_prefixes, suffix_array
from courtstats.llm.tables import distinct_texts, text_key, with_key
from courtstats.sources.shared import stage

LENGTH = 400
GRAM = 8
WORD_GRAM = 3
#: A run of over 50 words that documents share is reported.
PASSAGE_WORDS = 51
#: A shard is worked on in parts of about this many bytes, whole shares each.
PART_BYTES = 1 << 18
PARTITION_BYTES = 16 << 20
#: A share with more bytes of different fragments is cut into single windows.
HOT_BYTES = 16 << 20
_END = 254
_POSITION = np.uint64((1 << 32) - 1)
#: Keeps shares of words apart from shares of bytes.
_OF_WORDS = np.uint64(0xA5A5A5A55A5A5A5A)


def _grams(data):
    """The value of every 8 bytes, or of every few words given by their hashes."""
    if data.dtype != np.uint8:
        starts = np.arange(len(data) - WORD_GRAM + 1)
        return Prefixes(data).of(starts, starts + WORD_GRAM), WORD_GRAM
    gram = np.zeros(len(data) - GRAM + 1, np.uint64)
    for k in range(GRAM):
        gram |= data[k : k + len(gram)].astype(np.uint64) << np.uint64(8 * k)
    return gram, GRAM


def _shares(data, offsets, length):
    """Owned starts ``low..high`` and the key of the text they all share.

    ``data`` are bytes or hashes of words; everything is counted in these.
    """
    none = np.zeros(0, np.int64)
    n = len(data) - length + 1
    if n <= 0:
        return none, none, np.zeros(0, np.uint64)
    gram, size = _grams(data)
    value = (mix(gram) & ~_POSITION) | np.arange(len(gram), dtype=np.uint64)
    width = length - size + 1
    filled = np.full(-(-len(value) // width) * width, ~np.uint64(0))
    filled[: len(value)] = value
    rows = filled.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    anchor = (np.minimum(behind[:n], ahead[width - 1 : width - 1 + n]) & _POSITION).astype(np.int64)
    inside = np.zeros(n + 1, np.int64)
    begins, ends = offsets[:-1], offsets[1:] - length + 1
    some = ends > begins
    np.add.at(inside, begins[some], 1)
    np.add.at(inside, ends[some], -1)
    starts = np.flatnonzero(np.cumsum(inside[:-1]))
    if not len(starts):
        return none, none, np.zeros(0, np.uint64)
    half = length // 2
    anchor = anchor[starts]
    left = anchor - starts >= half
    new = np.ones(len(starts), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (left[1:] != left[:-1]) | (starts[1:] != starts[:-1] + 1)
    at = np.flatnonzero(new)
    low = starts[at]
    high = starts[np.append(at[1:], len(starts)) - 1]
    anchor, left = anchor[at], left[at]
    first = np.where(left, anchor - half, anchor)
    last = np.where(left, anchor + size, anchor - half + 1 + length)
    key = Prefixes(data).of(first, last) ^ left.astype(np.uint64)
    return low, high, key


def _of_rows(column, length):
    """For each row: its bytes, and its shares as starts and keys."""
    for begin, end, data, offsets in pieces(column):
        low, high, key = _shares(data, offsets, length)
        cut = np.searchsorted(low, offsets)
        for i in range(end - begin):
            own = slice(cut[i], cut[i + 1])
            yield data[offsets[i] : offsets[i + 1]], low[own] - offsets[i], high[own] - offsets[i], key[own]


def _words_of_rows(column, words):
    """For each row: its number of words, and its shares as first words and keys."""
    for begin, end, data, offsets in pieces(column):
        starts, ends, counts = word_spans(data, offsets)
        edges = np.append(0, np.cumsum(counts))
        low, high, key = _shares(Prefixes(data).of(starts, ends), edges, words)
        cut = np.searchsorted(low, edges)
        for i in range(end - begin):
            own = slice(cut[i], cut[i + 1])
            yield int(counts[i]), low[own] - edges[i], high[own] - edges[i], key[own] ^ _OF_WORDS


def _keyed(length, words):
    def rows(batches):
        none = np.zeros(0, np.uint64)
        for batch in batches:
            runs = _words_of_rows(batch.column(1), words) if words else repeat((0, none, none, none))
            for i, ((data, _, _, key), (number, _, _, more)) in enumerate(
                zip(_of_rows(batch.column(1), length), runs)
            ):
                each, counts = np.unique(np.concatenate([key, more]), return_counts=True)
                own = each[counts > 1].view(np.int64)
                yield batch.column(0)[i].as_py(), len(data), number, each.view(np.int64), own

    many = pa.list_(pa.int64())
    return lambda batches: in_batches(
        ["text_key", "n_bytes", "n_words", "keys", "own"],
        [pa.binary(), pa.int64(), pa.int64(), many, many],
        rows(batches),
        lambda row: 100 + row[3].nbytes + row[4].nbytes,
    )


def _fragments(length):
    """The wanted fragments of every text; a task holds out the bytes it sent before."""

    def rows(batches):
        seen = set()
        for batch in batches:
            for i, (data, low, high, key) in enumerate(_of_rows(batch.column(1), length)):
                text_id = batch.column(0)[i].as_py()
                wanted = np.array(batch.column(2)[i].as_py(), np.int64).view(np.uint64)
                at = np.flatnonzero(np.isin(key, wanted))
                shares = key[at].view(np.int64).tolist()
                held = data.tobytes()
                for share, first, last in zip(shares, low[at].tolist(), high[at].tolist()):
                    part = held[first : last + length]
                    name = xxh3_128_digest(part)
                    yield name, share, text_id, first, last - first + 1, None if name in seen else part
                    seen.add(name)
            if len(seen) > 100_000:
                seen.clear()

    return lambda batches: in_batches(
        ["fragment", "share", "text_key", "start", "owned", "held"],
        [pa.binary(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.binary()],
        rows(batches),
        lambda row: 200 + len(row[5] or b""),
    )


def _word_windows(words):
    """A row for each window of words in the wanted shares of each text."""

    def rows(batches):
        for batch in batches:
            texts, offsets = bytes_of(batch.column(1))
            for i, (_, low, high, key) in enumerate(_words_of_rows(batch.column(1), words)):
                wanted = np.array(batch.column(2)[i].as_py(), np.int64).view(np.uint64)
                at = np.flatnonzero(np.isin(key, wanted))
                if not len(at):
                    continue
                text_id = batch.column(0)[i].as_py()
                each = texts[offsets[i] : offsets[i + 1]].tobytes().split()
                edges = list(accumulate((len(w) + 1 for w in each), initial=0))
                held = b" ".join(each)
                for first, last in zip(low[at].tolist(), high[at].tolist()):
                    for k in range(first, last + 1):
                        yield xxh3_128_digest(held[edges[k] : edges[k + words] - 1]), text_id, k

    return lambda batches: in_batches(
        ["window", "text_key", "first"],
        [pa.binary(), pa.binary(), pa.int64()],
        rows(batches),
        lambda row: 200,
    )


def _word_places(texts, words):
    """``text_key, firsts``: first words of the windows that occur again."""
    windows = stage(
        texts.mapInArrow(_word_windows(words), "window binary, text_key binary, first bigint"), "windows"
    )
    twice = stage(windows.groupBy("window").count().where("count > 1").select("window"), "twice")
    places = windows.join(twice, "window").groupBy("text_key").agg(F.collect_list("first").alias("firsts"))
    return stage(places, "word-places")


def repeated_starts(held, offsets, owned, weights, length=LENGTH):
    """Which owned starts of some fragments begin a window that occurs again.

    ``held`` are the bytes of all fragments, ``owned`` how many starts of each
    count, ``weights`` in how many places each fragment stands.
    """
    sizes = np.diff(offsets)
    text = np.empty(len(held) + len(sizes), np.uint8)
    shift = np.repeat(np.arange(len(sizes)), sizes)
    text[np.arange(len(held)) + shift] = held + 1
    begins = offsets[:-1] + np.arange(len(sizes))
    text[begins + sizes] = _END
    weight = np.zeros(len(text), np.int64)
    at = np.repeat(begins - (np.cumsum(owned) - owned), owned) + np.arange(owned.sum())
    weight[at] = np.repeat(weights, owned)
    order = suffix_array(text)
    shared = permuted_common_prefixes(text, order, length)
    window = np.cumsum(shared[order] < length)
    total = np.bincount(window, weights=weight[order])
    repeated = np.zeros(len(text), bool)
    repeated[order] = total[window] >= 2
    return repeated[at]


def _sorted_parts(length):
    """Fragments of one partition in shard order, some shares at a time."""

    def part(rows):
        table = pa.Table.from_batches(rows).combine_chunks().to_batches()[0]
        data, offsets = bytes_of(table.column(3))
        owned = table.column(4).to_numpy().astype(np.int64)
        weights = table.column(5).to_numpy().astype(np.int64)
        flags = repeated_starts(data, offsets, owned, weights, length)
        edges = np.cumsum(owned)
        runs = [_runs(f) for f in np.split(flags, edges[:-1])]
        skip = table.column(2).to_numpy()
        kind = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
        values = [[{"a": int(a + s), "b": int(b + s)} for a, b in r] for r, s in zip(runs, skip)]
        return pa.RecordBatch.from_arrays(
            [table.column(1), pa.array(values, kind)], ["fragment", "runs"]
        )

    def run(batches):
        held, size = [], 0
        for batch in batches:
            shares = batch.column(0).to_numpy()
            edges = np.append(np.flatnonzero(shares[1:] != shares[:-1]) + 1, len(shares))
            begin = 0
            sizes = np.cumsum(np.append(0, np.diff(bytes_of(batch.column(3))[1])))
            for edge in edges:
                if held and size > PART_BYTES and held[-1].column(0)[-1].as_py() != shares[begin]:
                    yield part(held)
                    held, size = [], 0
                held.append(batch.slice(begin, edge - begin))
                size += int(sizes[edge] - sizes[begin])
                begin = edge
        if held:
            yield part(held)

    return run


def _runs(flags):
    """Begin and end of each run of true values."""
    edge = np.flatnonzero(np.diff(flags.astype(np.int8), prepend=0, append=0))
    return edge.reshape(-1, 2)


def _cut(length, words):
    """What stays of each text when its repeated windows are taken out."""

    def run(batches):
        for batch in batches:
            removed, spans, digests, kept = [], [], [], []
            data, offsets = bytes_of(batch.column(1))
            for i in range(batch.num_rows):
                own = data[offsets[i] : offsets[i + 1]]
                cover = np.zeros(len(own) + 1, np.int64)
                for each in batch.column(2)[i].as_py() or ():
                    cover[each["a"]] += 1
                    cover[each["b"] - 1 + length] -= 1
                if words and (firsts := batch.column(3)[i].as_py()):
                    starts, ends, _ = word_spans(own, np.array([0, len(own)]))
                    firsts = np.array(firsts)
                    np.add.at(cover, starts[firsts], 1)
                    np.add.at(cover, ends[firsts + words - 1], -1)
                gone = np.cumsum(cover[:-1]) > 0
                left = own[~gone].tobytes()
                removed.append(int(gone.sum()))
                spans.append(len(_runs(gone)))
                digests.append(hashlib.sha256(left).hexdigest())
                kept.append(_whole_characters(own, gone))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(removed, pa.int64()),
                    pa.array(spans, pa.int64()),
                    pa.array(digests, pa.string()),
                    pa.array(kept, pa.string()),
                ],
                ["text_key", "n_removed", "n_spans", "kept_sha256", "kept_text"],
            )

    return run


def _whole_characters(own, gone):
    """The remaining text; a character of which some bytes stay, stays whole."""
    first = np.flatnonzero((own & 0xC0) != 0x80)
    if not len(first):
        return ""
    all_gone = np.logical_and.reduceat(gone, first)
    keep = np.repeat(~all_gone, np.diff(np.append(first, len(own))))
    return own[first[0] :][keep].tobytes().decode("utf-8", "replace")


def repeated_text(docs: DataFrame, length: int = LENGTH, words: int | None = None) -> DataFrame:
    """``text_key, n_removed, n_spans, kept_sha256, kept_text`` of texts that lose bytes.

    Every whole text counts, as UTF-8 (null: empty). A byte goes if some string of
    ``length`` bytes over it starts anywhere else too, in the same text, another
    one, or a copy of it: each row of ``docs`` is a place of its own, so rows that
    repeat each other lose everything if they are long enough. Texts shorter than
    ``length`` lose nothing and do not appear. ``kept_text`` keeps characters whole.

    With ``words``, which must be over ``WORD_GRAM``, a run of so many words that
    starts anywhere else too goes as well, however few bytes it has and whatever
    white space stands between its words; rows that repeat each other lose
    everything if they have so many words.
    """
    keyed = stage(
        docs.select(text_key().alias("text_key"), "text")
        .mapInArrow(
            _keyed(length, words),
            "text_key binary, n_bytes bigint, n_words bigint, keys array<bigint>, own array<bigint>",
        )
        .groupBy("text_key")
        .agg(
            F.first("n_bytes").alias("n_bytes"),
            F.first("n_words").alias("n_words"),
            F.first("keys").alias("keys"),
            F.first("own").alias("own"),
            F.count("*").alias("copies"),
        ),
        "keyed",
    )
    short = F.xxhash64("text_key").alias("id")
    each = keyed.select(short, F.explode("keys").alias("share"))
    # Stored, so that the join is between two shuffles and hot shares can be split.
    twice = stage(
        each.groupBy("share")
        .agg(F.min("id").alias("a"), F.max("id").alias("b"))
        .where("a < b")
        .select("share"),
        "twice",
    )
    wanted = (
        each.join(twice, "share")
        .unionByName(keyed.select(short, F.explode("own").alias("share")))
        .groupBy("id")
        .agg(F.collect_set("share").alias("wanted"))
    )
    ids = keyed.select("text_key", short).join(wanted, "id").select("text_key", "wanted")
    texts = stage(distinct_texts(docs).join(ids, "text_key").select("text_key", "text", "wanted"), "texts")
    fragments = stage(
        texts.mapInArrow(
            _fragments(length),
            "fragment binary, share bigint, text_key binary, start bigint, owned bigint, held binary",
        ),
        "fragments",
    )
    runs = stage(_repeated(fragments, length), "runs")
    places = stage(
        fragments.select("fragment", "text_key", "start")
        .join(runs, "fragment")
        .select(
            "text_key",
            F.explode(
                F.transform(
                    "runs",
                    lambda r: F.struct(
                        (r["a"] + F.col("start")).alias("a"), (r["b"] + F.col("start")).alias("b")
                    ),
                )
            ).alias("run"),
        )
        .groupBy("text_key")
        .agg(F.collect_list("run").alias("runs")),
        "places",
    )
    found = texts.select("text_key", "text").join(places, "text_key", "left" if words else "inner")
    if words:
        found = found.join(_word_places(texts, words), "text_key", "left")
        found = found.where("runs is not null or firsts is not null")
    cut = found.mapInArrow(
        _cut(length, words),
        "text_key binary, n_removed bigint, n_spans bigint, kept_sha256 string, kept_text string",
    )
    long = F.col("n_bytes") >= length
    if words:
        long |= F.col("n_words") >= words
    copied = keyed.where((F.col("copies") > 1) & long).select(
        "text_key",
        F.col("n_bytes").alias("n_removed"),
        F.lit(1).cast("bigint").alias("n_spans"),
        F.lit(hashlib.sha256(b"").hexdigest()).alias("kept_sha256"),
        F.lit("").alias("kept_text"),
    )
    single = cut.join(copied.select("text_key"), "text_key", "left_anti")
    return single.unionByName(copied)


def _repeated(fragments, length):
    """``fragment, runs``: the repeated starts of each different fragment."""
    different = stage(
        fragments.groupBy("share", "fragment", "owned").agg(
            F.max("held").alias("held"), F.count("*").alias("weight")
        ),
        "different",
    )
    hot = (
        different.groupBy("share")
        .agg(F.sum(F.octet_length("held")).alias("bytes"))
        .where(F.col("bytes") > HOT_BYTES)
        .select("share", F.lit(True).alias("hot"))
    )
    marked = different.join(hot, "share", "left")
    columns = ["share", "fragment", "skip", "held", "owned", "weight"]
    whole = marked.where("hot is null").withColumn("skip", F.lit(0).cast("bigint"))
    single = (
        marked.where("hot")
        .withColumn("skip", F.explode(F.expr("sequence(0L, owned - 1)")))
        .withColumn("held", F.expr(f"substring(held, cast(skip as int) + 1, {length})"))
        .withColumn("share", F.xxhash64("held"))
        .withColumn("owned", F.lit(1).cast("bigint"))
    )
    rows = whole.select(columns).unionByName(single.select(columns))
    size = different.agg(F.sum(F.octet_length("held"))).first()[0] or 0
    most = int(fragments.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        rows.repartition(max(most, -(-size // PARTITION_BYTES)), "share")
        .sortWithinPartitions("share")
        .select("share", "fragment", "skip", "held", "owned", "weight")
        .mapInArrow(_sorted_parts(length), "fragment binary, runs array<struct<a: bigint, b: bigint>>")
        .where("size(runs) > 0")
    )


def without_repeats(docs: DataFrame, length: int = LENGTH, words: int | None = None) -> DataFrame:
    """``docs`` with repeated strings taken out of the text; all rows and columns stay.

    ``length`` and ``words`` as in ``repeated_text``. A null text stays null, an empty
    table stays empty.
    """
    changed = repeated_text(docs, length, words).select("text_key", "kept_text")
    rows = with_key(docs).join(changed.withColumn("changed", F.lit(True)), "text_key", "left")
    text = docs.columns.index("text")
    cut = F.when(F.col("changed"), F.col("kept_text")).otherwise(F.col(f"c{text}"))
    return rows.select(
        *[(cut if i == text else F.col(f"c{i}")).alias(c) for i, c in enumerate(docs.columns)]
    )


def repeat_report(docs: DataFrame, length: int = LENGTH, words: int = PASSAGE_WORDS) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, repeats`` for every row.

    ``repeats`` is true if bytes go, and also if a run of ``words`` words, which may
    be shorter than ``length``, stands in another document as well (whatever white
    space stands between the words). Nulls count as empty; rows that repeat are
    judged each, an empty table gives no rows, and other columns are not read.
    """
    rows = docs.select(
        "doc_id",
        text_key().alias("text_key"),
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"),
    )
    found = stage(repeated_text(docs, length).drop("kept_text"), "repeated")
    short = texts_with_shared_windows(docs, found, words).select(
        F.col("text_key").alias("short_key"), F.lit(True).alias("shared")
    )
    short = stage(short, "passages")
    zero = F.lit(0).cast("bigint")
    judged = rows.join(found, "text_key", "left").withColumn("short_key", F.substring("text_key", 1, 16))
    return judged.join(short, "short_key", "left").select(
        "doc_id",
        "n_bytes",
        F.coalesce("n_removed", zero).alias("n_removed"),
        F.coalesce("n_spans", zero).alias("n_spans"),
        F.coalesce("kept_sha256", F.lower(F.hex("text_key"))).alias("kept_sha256"),
        (F.col("n_removed").isNotNull() | (F.col("shared").isNotNull() & F.col("doc_id").isNotNull())).alias("repeats"),
    )
