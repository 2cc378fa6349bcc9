"""Vectors as short codes: product quantisation over tries of distinct parts.

Vectors become integers and are cut into parts. Equal parts are counted once, in
the reading tasks already, and stored in lexicographic order by ranges, so that
parts with common beginnings lie together. A task reads them as a trie: going down
depth first, the distances to all entries of a codebook are added up once for each
common prefix, and the leaves take the nearest entry and the sums weighted by how
often a part occurs. Only sums for each entry leave a task.

The driver holds the codebooks, entries times dimensions, whatever the number of
vectors, and goes through a fixed number of rounds.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtstats.sources.shared import stage

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
#: Scaled components are below this, so that sums of squares fit a long.
MOST = 1 << 24
#: Leaves of a subtrie whose levels are worked out as whole arrays.
BLOCK = 2048


def _first_new(parts):
    """For each row the first dimension in which it differs from the row before."""
    new = np.ones((len(parts), parts.shape[1] + 1), bool)
    new[0, :] = True
    new[1:, :-1] = parts[1:] != parts[:-1]
    return np.argmax(new, axis=1)


def nearest(parts, book):
    """Index of the nearest entry and its squared distance for sorted rows.

    Ties go to the lower index. ``parts`` and ``book`` are integers.
    """
    n, dims = parts.shape
    most = max((int(np.abs(a).max()) for a in (parts, book) if a.size), default=0)
    # Doubles hold every sum exactly below 2 ** 53 and are faster.
    kind = np.float64 if 4 * most * most * max(dims, 1) < 1 << 53 else np.int64
    parts, book = parts.astype(kind), book.astype(kind)
    index, distance = np.empty(n, np.int64), np.empty(n, np.int64)
    differs = _first_new(parts) if n else None
    todo = [(0, n, 0, np.zeros(len(book), kind))] if n else []
    while todo:
        low, high, depth, shared = todo.pop()
        if high - low <= BLOCK or depth == dims:
            found = _subtrie(parts[low:high], differs[low:high], depth, shared, book)
            index[low:high] = np.argmin(found, axis=1)
            distance[low:high] = np.min(found, axis=1)
            continue
        edges = np.append(low + np.flatnonzero(differs[low:high] <= depth), high)
        edges = edges if edges[0] == low else np.append(low, edges)
        below, begin = [], low
        for a, b in zip(edges[:-1], edges[1:]):
            if b - a > BLOCK:
                if begin < a:
                    below.append((begin, a, depth, shared))
                step = parts[a, depth] - book[:, depth]
                below.append((a, b, depth + 1, shared + step * step))
                begin = b
            elif b - begin > BLOCK:
                below.append((begin, a, depth, shared))
                begin = a
        if begin < high:
            below.append((begin, high, depth, shared))
        todo += below[::-1]
    return index, distance


def _subtrie(parts, differs, depth, shared, book):
    """Distances of some rows with a common prefix of ``depth`` dimensions.

    Prefixes that several rows have are worked out level by level, each once; the
    rest of a row that shares no more is added in one step.
    """
    sums, heads = shared[None, :], np.zeros(1, np.int64)
    for level in range(depth, parts.shape[1]):
        new = differs <= level
        new[0] = True
        at = np.flatnonzero(new)
        if 2 * len(at) > len(parts):
            break
        step = parts[at, level][:, None] - book[None, :, level]
        sums = sums[np.searchsorted(heads, at, "right") - 1] + step * step
        heads = at
    else:
        level = parts.shape[1]
    rest, others = parts[:, level:], book[:, level:]
    sums = sums[np.searchsorted(heads, np.arange(len(parts)), "right") - 1]
    return sums + ((rest * rest).sum(axis=1)[:, None] - 2 * (rest @ others.T) + (others * others).sum(axis=1))


def _rows(column, width):
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return values.reshape(len(column), width)


def _weighted_sums(books):
    """``part, entry, dim, total``: sums of the parts nearest to each entry.

    Dimension -1 holds the number of parts.
    """

    def run(batches):
        entries, width = books[0].shape
        totals = np.zeros((len(books), entries, width + 1), np.int64)
        for batch in batches:
            numbers = batch.column(0).to_numpy()
            parts, weights = _rows(batch.column(1), width), batch.column(2).to_numpy()
            for k, book in enumerate(books):
                own = np.flatnonzero(numbers == k)
                if len(own):
                    index, _ = nearest(parts[own], book)
                    weight = weights[own][:, None]
                    np.add.at(totals[k], index, np.hstack([weight, parts[own] * weight]))
        k, entry, dim = np.nonzero(np.repeat(totals[:, :, :1] > 0, width + 1, axis=2))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(k, pa.int32()),
                pa.array(entry, pa.int32()),
                pa.array(dim - 1, pa.int32()),
                pa.array(totals[k, entry, dim], pa.int64()),
            ],
            ["part", "entry", "dim", "total"],
        )

    return run


def _next_books(parts: DataFrame, books):
    """Each entry replaced by the rounded-down mean of its parts; one round."""
    sums = parts.mapInArrow(_weighted_sums(books), "part int, entry int, dim int, total bigint")
    rows = sums.groupBy("part", "entry", "dim").agg(F.sum("total").alias("total")).collect()
    counts = {(r.part, r.entry): r.total for r in rows if r.dim < 0}
    out = [book.copy() for book in books]
    for r in rows:
        if r.dim >= 0:
            out[r.part][r.entry, r.dim] = r.total // counts[r.part, r.entry]
    return out


def _codes(books):
    """Add ``code`` and ``error`` to the other columns; the vector is the last one."""

    def run(batches):
        width = books[0].shape[1]
        for batch in batches:
            vectors = _rows(batch.column(batch.num_columns - 1), width * len(books))
            codes = np.empty((len(vectors), len(books)), np.uint8)
            error = np.zeros(len(vectors), np.int64)
            for k, book in enumerate(books):
                parts, back = np.unique(
                    vectors[:, k * width : (k + 1) * width], axis=0, return_inverse=True
                )
                index, distance = nearest(parts, book)
                codes[:, k] = index[back.ravel()]
                error += distance[back.ravel()]
            others = [batch.column(i) for i in range(batch.num_columns - 1)]
            texts = [row.tobytes().hex() for row in codes]
            yield pa.RecordBatch.from_arrays(
                [*others, pa.array(texts, pa.string()), pa.array(error, pa.int64())],
                [*batch.schema.names[:-1], "code", "error"],
            )

    return run


def whole_vectors(rows: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector is there and has finite components only, scaled to integers."""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf"))
    )

    def scaled(x):
        large = F.raise_error(F.concat(F.lit("a component is too large: "), x.cast("string")))
        value = x.cast("double") * SCALE
        return F.when(F.abs(value) < MOST, F.floor(value)).otherwise(large).cast("int")

    return rows.where(F.col(vector).isNotNull() & finite).withColumn(vector, F.transform(vector, scaled))


def train_books(kept: DataFrame, identity: str, vector: str, rounds: int = ROUNDS):
    """The codebooks of scaled vectors, one integer array for each part; none without rows."""
    first = (
        kept.select(identity, vector)
        .orderBy(F.col(identity).asc_nulls_last(), vector)
        .limit(ENTRIES)
        .collect()
    )
    if not first:
        return []
    dims = len(first[0][vector])
    if dims % PARTS or any(len(r[vector]) != dims for r in first):
        raise ValueError(f"vectors must all have the same length, a multiple of {PARTS}")
    width = dims // PARTS
    start = np.array([r[vector] for r in first], np.int64).reshape(len(first), dims)
    books = [start[:, k * width : (k + 1) * width] for k in range(PARTS)]
    same = F.when(F.size(vector) == dims, F.col(vector)).otherwise(
        F.raise_error(F.lit("vectors differ in length"))
    )
    cut = F.array(*[F.slice(same, 1 + k * width, width) for k in range(PARTS)])
    shares = int(kept.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = stage(
        kept.select(F.posexplode(cut).alias("part", "held"))
        .groupBy("part", "held")
        .agg(F.count("*").alias("weight"))
        .repartitionByRange(shares, "part", "held")
        .sortWithinPartitions("part", "held"),
        "parts",
    )
    for _ in range(rounds):
        books = _next_books(parts, books)
    return books


def books_digest(books) -> str:
    """SHA-256 of all components in decimal, by part, entry and dimension."""
    return hashlib.sha256(",".join(str(v) for b in books for v in b.ravel()).encode()).hexdigest()


def vector_codes(
    rows: DataFrame, identity: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` of the whole vectors.

    Vectors that are null or hold null or non-finite components are left out.
    Others must have the same length, a multiple of four, and components below
    16384; anything else raises. The codebooks start with the vectors of the
    smallest identities, ties in order of the vectors, null identities last. Rows
    that repeat each other count as often as they stand there. Null labels are one
    label. An empty table, or one without whole vectors, gives no rows. Columns
    other than the three are not read, and nothing is text.
    """
    kept = whole_vectors(
        rows.select(
            rows[identity].alias("vec_id"), rows[label].alias("label"), rows[vector].alias("vector")
        ),
        "vector",
    )
    books = train_books(kept, "vec_id", "vector")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept.schema.fields[:2])
    coded = kept.limit(0).select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("bigint").alias("error"))
    if books:
        coded = stage(kept.mapInArrow(_codes(books), f"{kinds}, code string, error bigint"), "codes")
    totals = stage(
        coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error")), "label-errors"
    )
    return coded.join(totals, F.col("label").eqNullSafe(F.col("_label"))).select(
        "vec_id", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256")
    )
