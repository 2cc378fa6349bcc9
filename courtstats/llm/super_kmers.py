"""Removal of word windows that an earlier document has, by super-k-mers.

A window is some words in a row. Its minimiser is the run of ``GRAM`` words in it
with the smallest hash, the leftmost of equals; windows in a row with one minimiser
travel together as one packed string, a super-k-mer, to the bucket of that
minimiser. Equal windows have equal minimisers, so a bucket holds every place of
its windows, and sorting the windows of a bucket finds the smallest document of
each exactly.

Before any text moves, buckets that only one text has are left out by their hashes.
Equal super-k-mers are counted once, in the reading tasks already. A bucket with
more than ``HOT_BYTES`` of different super-k-mers is sorted by all tasks: each of
its windows goes by a digest of its own words. Copies of a text are one text with
the smallest of their documents; the others lose every word if there is a window.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtstats.llm.arrays import Prefixes, bytes_of, in_batches, mix, pieces, word_spans
from courtstats.sources.shared import stage

#: Words of a window, and of a minimiser.
WINDOW = 13
GRAM = 7
#: A task sorts whole buckets of about this many bytes at a time.
PART_BYTES = 4 << 20
#: Beyond this, windows of a bucket are dealt out by themselves.
HOT_BYTES = 1 << 17
#: Keys of super-k-mers that a task remembers.
_MOST_SEEN = 200_000
_POSITION = np.uint64((1 << 32) - 1)
_NONE = np.iinfo(np.int64).max


def _digest(held):
    """128 bits of a strong digest, as ``_text_key`` gives them for a text."""
    return hashlib.sha256(held).digest()[:16]


def _text_key():
    return F.substring(F.unhex(F.sha2(F.col("text").cast("binary"), 256)), 1, 16)


def super_kmers(words, counts, window=WINDOW, gram=GRAM):
    """First window, last window and bucket of every super-k-mer.

    ``words`` are hashes of words, ``counts`` how many each text has; positions are
    those in ``words``.
    """
    none = np.zeros(0, np.int64)
    if len(words) < window:
        return none, none, none
    at = np.arange(len(words) - gram + 1)
    value = (mix(Prefixes(words).of(at, at + gram)) & ~_POSITION) | at.astype(np.uint64)
    least, size = value, 1
    while size < window - gram + 1:
        step = min(size, window - gram + 1 - size)
        least, size = np.minimum(least[:-step], least[step:]), size + step
    ends = np.cumsum(counts)
    begins = ends - counts
    some = counts >= window
    owned = np.zeros(len(words) + 1, np.int64)
    owned[begins[some]] += 1
    owned[ends[some] - window + 1] -= 1
    starts = np.flatnonzero(np.cumsum(owned[:-1]))
    if not len(starts):
        return none, none, none
    least = least[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (least[1:] != least[:-1]) | (starts[1:] != starts[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(starts)) - 1
    gram_at = (least[first] & _POSITION).astype(np.int64)
    bucket = mix(Prefixes(words).of(gram_at, gram_at + gram)).view(np.int64)
    return starts[first], starts[last], bucket


def _texts(column, window):
    """For each row: bytes, starts and ends of words, and its super-k-mers."""
    for begin, end, data, offsets in pieces(column):
        starts, ends, counts = word_spans(data, offsets)
        low, high, bucket = super_kmers(Prefixes(data).of(starts, ends), counts, window)
        edges = np.append(0, np.cumsum(counts))
        cut = np.searchsorted(low, edges)
        for i in range(end - begin):
            words = slice(edges[i], edges[i + 1])
            own = slice(cut[i], cut[i + 1])
            yield (
                data[offsets[i] : offsets[i + 1]],
                starts[words] - offsets[i],
                ends[words] - offsets[i],
                low[own] - edges[i],
                high[own] - edges[i],
                bucket[own],
            )


def _joined(data, starts, ends):
    """The words of a text with one space between them, and where each begins."""
    sizes = ends - starts + 1
    to = np.append(0, np.cumsum(sizes))
    if not len(starts):
        return b"", to
    at = np.arange(to[-1]) + np.repeat(starts - to[:-1], sizes)
    held = np.full(to[-1], 0x20, np.uint8)
    inside = np.ones(to[-1], bool)
    inside[to[1:] - 1] = False
    held[inside] = data[at[inside]]
    return held[:-1].tobytes(), to


def _keyed(window):
    """``doc_id, text_key, buckets`` of every row with a window."""

    def rows(batches):
        for batch in batches:
            for i, (data, starts, _, _, _, bucket) in enumerate(_texts(batch.column(1), window)):
                if len(starts) >= window:
                    yield batch.column(0)[i].as_py(), _digest(data.tobytes()), np.unique(bucket)

    def run(batches):
        return in_batches(
            ["doc_id", "text_key", "buckets"],
            [pa.int64(), pa.binary(), pa.list_(pa.int64())],
            rows(batches),
            lambda row: 50 + row[2].nbytes,
        )

    return run


def _packed(window):
    """The wanted super-k-mers of every text; a task holds out those it sent before."""

    def rows(batches):
        seen = set()
        for batch in batches:
            for i, (data, starts, ends, low, high, bucket) in enumerate(_texts(batch.column(2), window)):
                at = np.flatnonzero(np.isin(bucket, np.array(batch.column(3)[i].as_py(), np.int64)))
                held, to = _joined(data, starts, ends)
                text, doc = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                for j, b, first, last in zip(at, bucket[at], low[at], high[at]):
                    part = held[to[first] : to[last + window] - 1]
                    key = _digest(part)
                    yield b, key, None if key in seen else part, text, doc, first
                    seen.add(key)
            if len(seen) > _MOST_SEEN:
                seen.clear()

    def run(batches):
        return in_batches(
            ["bucket", "packed_key", "packed", "text_key", "doc", "start"],
            [pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int64()],
            rows(batches),
            lambda row: 150 + len(row[2] or b""),
        )

    return run


def smallest_documents(packed, documents, window=WINDOW):
    """For each packed string, the smallest document of each of its windows.

    Words become numbers, and runs of 2, 4, 8 words the ranks of pairs of shorter
    runs; so equal ranks are equal words, and sorting by rank counts exactly.
    """
    words = b" ".join(packed).split(b" ")
    ids = pa.array(words, pa.binary()).dictionary_encode().indices.to_numpy().astype(np.int64)
    counts = np.array([p.count(b" ") + 1 for p in packed])
    ends = np.cumsum(counts)
    many = counts - window + 1
    at = np.repeat(ends - counts - (np.cumsum(many) - many), many) + np.arange(many.sum())
    rank, size = ids, 1
    while size < window:
        step = min(size, window - size)
        pair = rank[: len(rank) - step] * np.int64(len(ids)) + rank[step:]
        rank, size = np.unique(pair, return_inverse=True)[1].astype(np.int64), size + step
    order = np.argsort(rank[at], kind="stable")
    sorted_ = rank[at][order]
    new = np.append(True, sorted_[1:] != sorted_[:-1])
    least = np.minimum.reduceat(np.repeat(documents, many)[order], np.flatnonzero(new))
    found = np.empty(len(at), np.int64)
    found[order] = least[np.cumsum(new) - 1]
    return found, many


def _sorted_buckets(window):
    """``packed_key, least``: the smallest document of each window, bucket by bucket."""

    def part(rows):
        table = pa.Table.from_batches(rows).combine_chunks()
        least, many = smallest_documents(table.column(2).to_pylist(), table.column(3).to_numpy(), window)
        begins = np.cumsum(many) - many
        kept = np.minimum.reduceat(least, begins) < table.column(4).to_numpy()
        lists = pa.ListArray.from_arrays(
            pa.array(np.append(0, np.cumsum(many[kept])), pa.int32()), pa.array(least[np.repeat(kept, many)])
        )
        keys = table.column(1).filter(pa.array(kept)).combine_chunks()
        return pa.RecordBatch.from_arrays([keys, lists], ["packed_key", "least"])

    def run(batches):
        held, size = [], 0
        for batch in batches:
            buckets = batch.column(0).to_numpy()
            edges = np.flatnonzero(buckets[1:] != buckets[:-1]) + 1
            if held and batch.num_rows and held[-1].column(0)[-1].as_py() != buckets[0]:
                edges = np.append(0, edges)
            if size > PART_BYTES and len(edges):
                # Whole buckets up to the last that begins here.
                yield part([*held, batch.slice(0, edges[-1])])
                held, size, batch = [], 0, batch.slice(edges[-1])
            if batch.num_rows:
                held.append(batch)
                size += int(np.diff(bytes_of(batch.column(2))[1]).sum())
        if held:
            yield part(held)

    return run


def _single(window):
    """Every window of some super-k-mers by the digest of its words."""

    def rows(batches):
        for batch in batches:
            for key, held, least, most in zip(*(batch.column(k).to_pylist() for k in range(4))):
                to = np.append(0, np.flatnonzero(np.frombuffer(held + b" ", np.uint8) == 0x20) + 1)
                for offset in range(len(to) - window):
                    yield _digest(held[to[offset] : to[offset + window] - 1]), key, offset, least, most

    def run(batches):
        return in_batches(
            ["window", "packed_key", "offset", "least", "most"],
            [pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64()],
            rows(batches),
            lambda row: 100,
        )

    return run


def _least_of_windows(places: DataFrame, window: int) -> DataFrame:
    """``packed_key, least``: for super-k-mers with a window of a smaller document."""
    different = stage(
        places.groupBy("bucket", "packed_key").agg(
            F.first("packed", True).alias("packed"), F.min("doc").alias("least"), F.max("doc").alias("most")
        ),
        "super-k-mers",
    )
    sizes = different.groupBy("bucket").agg(F.sum(F.octet_length("packed")).alias("bytes"))
    hot = stage(sizes.where(F.col("bytes") > HOT_BYTES).select(F.col("bucket").alias("hot")), "hot")
    marked = different.join(hot, different["bucket"] == hot["hot"], "left")
    size = different.agg(F.sum(F.octet_length("packed"))).first()[0] or 0
    shares = int(places.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    whole = (
        marked.where("hot is null")
        .select("bucket", "packed_key", "packed", "least", "most")
        .repartition(max(shares, -(-size // (16 * PART_BYTES))), "bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(_sorted_buckets(window), "packed_key binary, least array<bigint>")
    )
    if hot.isEmpty():
        return whole
    single = stage(
        marked.where("hot is not null")
        .select("packed_key", "packed", "least", "most")
        .mapInArrow(
            _single(window), "window binary, packed_key binary, offset bigint, least bigint, most bigint"
        ),
        "windows",
    )
    first = stage(
        single.groupBy("window")
        .agg(F.min("least").alias("first"), F.max("most").alias("most"))
        .where("first < most")
        .select("window", "first"),
        "first",
    )
    lists = (
        single.join(first, "window")
        .groupBy("packed_key")
        .agg(F.sort_array(F.collect_list(F.struct("offset", "first"))).alias("found"))
    )
    # Offsets without a smaller document stay open.
    least = F.transform(
        F.sequence(F.lit(0), F.element_at("found", -1)["offset"].cast("int")),
        lambda k: F.coalesce(
            F.get(F.filter("found", lambda f: f["offset"] == k), F.lit(0))["first"], F.lit(_NONE)
        ),
    )
    return whole.unionAll(lists.select("packed_key", least.alias("least")))


def _cut(window):
    """``text_key, n_removed, kept_sha256`` of texts, from the windows that go."""

    def rows(batches):
        for batch in batches:
            data, offsets = bytes_of(batch.column(1))
            for i in range(batch.num_rows):
                own = data[offsets[i] : offsets[i + 1]]
                starts, ends, _ = word_spans(own, np.array([0, len(own)]))
                cover = np.zeros(len(starts) + 1, np.int64)
                firsts = np.array(batch.column(2)[i].as_py(), np.int64)
                np.add.at(cover, firsts, 1)
                np.add.at(cover, firsts + window, -1)
                stay = np.cumsum(cover[:-1]) == 0
                kept, _ = _joined(own, starts[stay], ends[stay])
                yield batch.column(0)[i].as_py(), int((~stay).sum()), hashlib.sha256(kept).hexdigest()

    def run(batches):
        return in_batches(
            ["text_key", "n_removed", "kept_sha256"],
            [pa.binary(), pa.int64(), pa.string()],
            rows(batches),
            lambda row: 150,
        )

    return run


def _windows(window):
    """Every window in the wanted super-k-mers of some texts."""

    def rows(batches):
        for batch in batches:
            for i, (data, starts, ends, low, high, bucket) in enumerate(_texts(batch.column(2), window)):
                at = np.flatnonzero(np.isin(bucket, np.array(batch.column(3)[i].as_py(), np.int64)))
                held, to = _joined(data, starts, ends)
                text, doc = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                for first, last in zip(low[at].tolist(), high[at].tolist()):
                    for k in range(first, last + 1):
                        yield _digest(held[to[k] : to[k + window] - 1]), text, doc

    def run(batches):
        return in_batches(
            ["window", "text_key", "doc"],
            [pa.binary(), pa.binary(), pa.int64()],
            rows(batches),
            lambda row: 100,
        )

    return run


def texts_with_shared_windows(docs: DataFrame, settled: DataFrame, window: int) -> DataFrame:
    """``text_key`` of texts with a window that another document has, too.

    ``settled`` has the ``text_key`` (32 bytes of SHA-256, as everywhere) of texts
    that need no answer; others are compared with all texts. A null ``doc_id`` is no
    other document.
    """
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    short = settled.select(F.substring("text_key", 1, 16).alias("text_key"), F.lit(True).alias("settled"))
    keyed = stage(
        texts.where("doc_id is not null")
        .mapInArrow(_keyed(window), "doc_id bigint, text_key binary, buckets array<bigint>")
        .groupBy("text_key")
        .agg(F.min("doc_id").alias("doc"), F.max("doc_id").alias("last"), F.first("buckets").alias("buckets"))
        .join(short, "text_key", "left"),
        "keyed",
    )
    each = keyed.select(
        F.xxhash64("text_key").alias("id"),
        "doc",
        F.col("settled").isNull().alias("open"),
        F.explode("buckets").alias("bucket"),
    )
    shared = stage(
        each.groupBy("bucket")
        .agg(F.min("doc").alias("a"), F.max("doc").alias("b"), F.max("open").alias("open"))
        .where("a < b and open")
        .select("bucket"),
        "shared",
    )
    wanted = stage(
        each.select("id", "bucket").join(shared, "bucket").groupBy("id").agg(F.collect_list("bucket").alias("wanted")),
        "wanted",
    )
    ids = stage(
        keyed.select("text_key", "doc", F.xxhash64("text_key").alias("id")).join(wanted, "id").drop("id"), "ids"
    )
    # Copies are dropped in the reading tasks, before the join.
    whole = texts.groupBy(_text_key().alias("text_key")).agg(F.first("text").alias("text"))
    held = whole.join(ids, "text_key").select("text_key", "doc", "text", "wanted")
    windows = stage(held.mapInArrow(_windows(window), "window binary, text_key binary, doc bigint"), "windows")
    twice = stage(
        windows.groupBy("window")
        .agg(F.min("doc").alias("a"), F.max("doc").alias("b"))
        .where("a < b")
        .select("window"),
        "twice",
    )
    found = windows.join(twice, "window").select("text_key")
    copied = keyed.where("doc < last").select("text_key")
    # Settled ones may be among them.
    return found.unionAll(copied).distinct()


def earlier_windows(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` of every row.

    Words are runs of characters other than ASCII white space, unchanged; a null or
    empty text has none. A word goes if a window of ``window`` words over it is also
    a window of a document with a smaller ``doc_id``; windows are judged as given.
    ``kept_sha256`` is that of the remaining words with one space between them. Rows
    with the same ``doc_id`` do not judge each other, and a null ``doc_id`` is
    neither smaller nor larger than another. An empty table gives no rows. Long
    texts are read whole in one task, in numpy arrays of about 50 times their bytes.
    Other columns are not read.
    """
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    keyed = stage(
        texts.where("doc_id is not null")
        .mapInArrow(_keyed(window), "doc_id bigint, text_key binary, buckets array<bigint>")
        .groupBy("text_key")
        .agg(F.min("doc_id").alias("doc"), F.max("doc_id").alias("last"), F.first("buckets").alias("buckets")),
        "keyed",
    )
    # Two texts with one number only make each other's buckets candidates.
    number = F.xxhash64("text_key").alias("id")
    each = keyed.select(number, "doc", F.explode("buckets").alias("bucket"))
    shared = stage(
        each.groupBy("bucket")
        .agg(F.min("doc").alias("a"), F.max("doc").alias("b"))
        .where("a < b")
        .select("bucket"),
        "shared",
    )
    wanted = each.select("id", "bucket").join(shared, "bucket").groupBy("id").agg(
        F.collect_list("bucket").alias("wanted")
    )
    ids = keyed.select("text_key", "doc", number).join(wanted, "id")
    whole = texts.groupBy(_text_key().alias("text_key")).agg(F.first("text").alias("text"))
    held = stage(whole.join(ids, "text_key").select("text_key", "doc", "text", "wanted"), "texts")
    places = stage(
        held.mapInArrow(
            _packed(window),
            "bucket bigint, packed_key binary, packed binary, text_key binary, doc bigint, start bigint",
        ),
        "places",
    )
    least = stage(_least_of_windows(places, window), "least")
    firsts = (
        places.select("packed_key", "text_key", "doc", "start")
        .join(least, "packed_key")
        .select("text_key", "doc", "start", F.posexplode("least").alias("offset", "first"))
        .where(F.col("first") < F.col("doc"))
        .groupBy("text_key")
        .agg(F.collect_list(F.col("start") + F.col("offset")).alias("firsts"))
    )
    cut = (
        held.select("text_key", "text")
        .join(firsts, "text_key")
        .mapInArrow(_cut(window), "text_key binary, n_removed bigint, kept_sha256 string")
    )
    changed = stage(
        keyed.where("doc < last")
        .select("text_key", "doc")
        .join(cut, "text_key", "full")
        .select("text_key", "doc", F.col("n_removed").alias("cut"), F.col("kept_sha256").alias("left")),
        "changed",
    )
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+", -1), lambda w: w != "")
    rows = texts.select("doc_id", _text_key().alias("text_key"), words.alias("words")).select(
        "doc_id",
        "text_key",
        F.size("words").cast("bigint").alias("n_words"),
        F.sha2(F.array_join("words", " ").cast("binary"), 256).alias("whole"),
    )
    own = F.col("doc_id").isNotNull()
    later = own & (F.col("doc_id") > F.col("doc"))
    cut_here = own & F.col("cut").isNotNull()
    return rows.join(changed, "text_key", "left").select(
        "doc_id",
        "n_words",
        F.when(later, F.col("n_words"))
        .when(cut_here, F.col("cut"))
        .otherwise(F.lit(0).cast("bigint"))
        .alias("n_removed"),
        F.when(later, F.lit(hashlib.sha256(b"").hexdigest()))
        .when(cut_here, F.col("left"))
        .otherwise(F.col("whole"))
        .alias("kept_sha256"),
    )
