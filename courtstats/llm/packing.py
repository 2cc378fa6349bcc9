"""Packing of token sequences: shortest pack first over the length histogram.

Documents are cut into full sequences and one rest. Only the histogram of piece
lengths (one number for each length up to the sequence size, however many
documents there are) comes to the driver. There lengths are placed longest first
into the packs that are shortest so far, all packs of one pattern at once. Pieces
find their place by length and rank: ranks are counted in blocks, so a length that
many pieces share is not gathered in one task.
"""

import heapq
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from courtstats.llm import byte_bpe
from courtstats.llm.arrays import LARGE_SLICE_BYTES, pieces
from courtstats.sources.shared import stage

VOCABULARY = "byte_bpe_50k.json"
SIZE = 1024
#: The id behind each document.
END = 0


def _cut(path, size):
    def run(batches):
        for batch in batches:
            rows = [[] for _ in range(5)]
            for begin, end, data, offsets in pieces(batch.column(1), LARGE_SLICE_BYTES):
                ids, counts = byte_bpe.ids_of(path, data, offsets)
                edges = np.append(0, np.cumsum(counts))
                for i in range(begin, end):
                    own = ids[edges[i - begin] : edges[i - begin + 1]].astype("<u4")
                    own = np.append(own, np.uint32(END)).astype("<u4")
                    for start in range(0, len(own), size):
                        part = own[start : start + size]
                        values = (i, start, len(part), crc32(part.tobytes()), len(own))
                        for column, value in zip(rows, values):
                            column.append(value)
            rows = [pa.array(r, pa.int64()) for r in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(rows[0]), *rows[1:]],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens"],
            )

    return run


def shortest_pack_first(histogram: dict[int, int], size: int) -> list[tuple[tuple, int]]:
    """Patterns (lengths, longest first) and how many packs follow each."""
    packs = []
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left and packs and packs[0][0] + length <= size:
            used, pattern, count = heapq.heappop(packs)
            taken = min(left, count)
            left -= taken
            if count > taken:
                heapq.heappush(packs, (used, pattern, count - taken))
            heapq.heappush(packs, (used + length, (*pattern, length), taken))
        if left:
            heapq.heappush(packs, (length, (length,), left))
    return [(pattern, count) for _, pattern, count in sorted(packs)]


def places(patterns):
    """Arrays of slots sorted by (length, first rank): first sequence and offset."""
    slots, taken, sequence = [], {}, 0
    for pattern, count in patterns:
        offset = 0
        for length in pattern:
            rank = taken.get(length, 0)
            slots.append((length, rank, sequence, offset))
            taken[length] = rank + count
            offset += length
        sequence += count
    return np.array(sorted(slots), np.int64).reshape(-1, 4)


def _placed(slots):
    # Ranks stay below 2^40, lengths below 2^22.
    key = (slots[:, 0] << 40) + slots[:, 1]

    def run(batches):
        for batch in batches:
            names = batch.schema.names
            length = batch.column(names.index("length")).to_numpy()
            rank = batch.column(names.index("rank")).to_numpy()
            at = np.searchsorted(key, (length << 40) + rank, "right") - 1
            keep = [batch.column(names.index(c)) for c in _PIECE]
            sequence = slots[at, 2] + rank - slots[at, 1]
            yield pa.RecordBatch.from_arrays(
                [*keep, pa.array(sequence, pa.int64()), pa.array(slots[at, 3], pa.int64())],
                [*_PIECE, "sequence_id", "offset"],
            )

    return run


_PIECE = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
_TYPES = ", ".join(f"{c} bigint" for c in _PIECE)


def pack(docs: DataFrame, size: int = SIZE, path: str | None = None) -> DataFrame:
    """One row for each piece of a document, with its sequence and place there.

    ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``. A document
    is its ids (null text: none) and id 0; each id lies in one piece. Offsets of a
    sequence have no gaps. Rows that repeat are packed each;
    an empty table gives no rows, texts are taken whole, however long, and other
    columns are not read. ``path`` is a byte-level BPE vocabulary file.
    """
    path = path or byte_bpe.vocabulary(VOCABULARY)
    cut = stage(docs.select("doc_id", "text").mapInArrow(_cut(path, size), _TYPES), "pieces")
    histogram = {r.length: r["count"] for r in cut.groupBy("length").count().collect()}
    slots = places(shortest_pack_first(histogram, size))
    blocks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    block = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(blocks)).alias("block")
    cut = cut.select("*", block)
    earlier = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = cut.groupBy("length", "block").agg(F.count("*").alias("n")).select(
        "length", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    )
    within = Window.partitionBy("length", "block").orderBy("doc_id", "start", "ids_crc32")
    ranked = (
        cut.withColumn("within", F.row_number().over(within))
        .join(before, ["length", "block"])
        .withColumn("rank", F.col("before") + F.col("within") - 1)
    )
    return ranked.select(*_PIECE, "rank").mapInArrow(
        _placed(slots), f"{_TYPES}, sequence_id bigint, offset bigint"
    )
