"""A Merkle manifest of a table, with a proof of every row.

Rows are hashed to leaves, leaves are ranked within their group, and a node carries
the interval ``lo..hi`` of the leaf ranks below it. A node of level ``k`` starts at a
multiple of ``arity ** k``, which is the bucket its descendants are joined by;
containment of intervals confirms the ancestor, and the parent's interval without
the own one holds the siblings. Ancestors are attached from the top down, level by
level, so what is known of a parent is written once for all rows below it.

Only digests move after the first pass over the rows. Ranks come from a sort over
ranges and a count for each range, so a group of any size spreads over all tasks.
The driver learns the size of the largest group and the root.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from courtstats.sources.shared import stage

ARITY = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_ROWS_OF_A_TASK = 33
_DIGEST = 32
_PATH = "array<struct<before: binary, after: binary>>"


def _text_of(digest):
    return F.lower(F.hex(digest))


def _hash(text):
    return F.unhex(F.sha2(text.cast("binary"), 256))


def row_digest(values) -> F.Column:
    """Digest of some values in a row: each its UTF-8 length, a colon, itself; null: ``-``."""
    parts = []
    for value in values:
        text = value.cast("string")
        held = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
        parts.append(F.coalesce(held, F.lit("-")))
    return _hash(F.concat(*parts))


def _ranked(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """Add ``lo, hi``, the rank of a row in its ``grp``, and ``n``, the rows of that.

    ``rows`` must be stored: ranges are found by sampling them.
    """
    shares = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = ["grp", *order]
    ordered = stage(
        rows.repartitionByRange(shares, *by)
        .sortWithinPartitions(*by)
        .withColumn("at", F.monotonically_increasing_id()),
        name,
    )
    range_ = F.shiftright("at", _ROWS_OF_A_TASK)
    own = Window.partitionBy("_grp")
    before = own.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # At most one row for each group and one more for each range.
    counts = (
        ordered.groupBy(F.col("grp").alias("_grp"), range_.alias("_range"))
        .agg(F.min("at").alias("_first"), F.count("*").alias("_rows"))
        .select(
            "_grp",
            "_range",
            (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
            F.sum("_rows").over(own).alias("n"),
        )
    )
    counts = stage(counts, "counts")
    same = ordered["grp"].eqNullSafe(counts["_grp"]) & (range_ == counts["_range"])
    return (
        ordered.join(counts, same)
        .withColumn("lo", F.col("at") + F.col("_shift"))
        .withColumn("hi", F.col("lo") + 1)
        .drop("at", "_grp", "_range", "_shift")
    )


def _levels(leaves: DataFrame, arity: int) -> list[DataFrame]:
    """The inner nodes of every group, level by level from the leaves up.

    ``grp, lo, hi, digest, kids, n``: the digests of the children are one binary
    value, and ``n`` counts the nodes of the group on this level; one is its root.
    """
    most = leaves.agg(F.max("n")).first()[0] or 0
    levels, nodes, width = [], leaves, 1
    while most > 1:
        width *= arity
        together = F.sort_array(F.collect_list(F.struct("lo", "digest")))
        kids = F.array_join(F.transform(together, lambda k: _text_of(k["digest"])), "")
        nodes = stage(
            nodes.where("n > 1")
            .groupBy("grp", F.expr(f"lo div {width}").alias("bucket"))
            .agg(
                F.min("lo").alias("lo"),
                F.max("hi").alias("hi"),
                kids.alias("kids"),
                F.first("n").alias("n"),
            )
            .select(
                "grp",
                "lo",
                "hi",
                _hash(F.col("kids")).alias("digest"),
                F.unhex("kids").alias("kids"),
                F.expr(f"(n + {arity - 1}) div {arity}").alias("n"),
            ),
            "nodes",
        )
        levels.append(nodes)
        most = -(-most // arity)
    return levels


def _tops(leaves: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """``grp, digest``: the root of each group."""
    tops = [df.where("n = 1").select("grp", "digest") for df in [leaves, *levels]]
    for more in tops[1:]:
        tops[0] = tops[0].unionAll(more)
    return tops[0]


def _with_ancestors(
    leaves: DataFrame, levels: list[DataFrame], roots: DataFrame, arity: int
) -> DataFrame:
    """Add to the leaves what ``roots`` says of their group, and their whole ``path``.

    ``roots`` has ``grp, path`` and other columns; a path lists the siblings before
    and after each node from the own level up.
    """
    facts = [c for c in roots.columns if c not in ("grp", "path")]
    known = None
    for k in range(len(levels), -1, -1):
        nodes = (leaves if k == 0 else levels[k - 1]).withColumn("_grp", F.col("grp"))
        top = roots.withColumnRenamed("grp", "_root")
        found = nodes.where("n = 1").join(top, F.col("_grp").eqNullSafe(F.col("_root")))
        found = found.drop("_root", "_grp")
        if known is not None:
            width = arity ** (k + 1)
            above = known.select(
                F.col("grp").alias("_above"),
                F.expr(f"lo div {width}").alias("_bucket"),
                F.col("lo").alias("_lo"),
                F.col("hi").alias("_hi"),
                F.col("kids").alias("_kids"),
                F.col("path").alias("_path"),
                *facts,
            )
            held = (
                F.col("_grp").eqNullSafe(F.col("_above"))
                & (F.expr(f"lo div {width}") == F.col("_bucket"))
                & (F.col("lo") >= F.col("_lo"))
                & (F.col("hi") <= F.col("_hi"))
            )
            # The parent's interval less the own one: the siblings on both sides.
            first = F.expr(f"cast({_DIGEST} * ((lo - _lo) div {arity**k}) as int)")
            step = F.struct(
                F.substring("_kids", F.lit(1), first).alias("before"),
                F.substring("_kids", first + _DIGEST + 1, F.octet_length("_kids")).alias("after"),
            )
            path = F.concat(F.array(step), F.col("_path"))
            below = nodes.where("n > 1").join(above, held).withColumn("path", path)
            found = found.unionByName(below.select(found.columns))
        known = stage(found, "ancestors") if k else found
    return known


def folded(digest, path) -> F.Column:
    """The root that a digest and the siblings along its path give, as hex text."""
    return F.aggregate(
        path,
        _text_of(digest),
        lambda own, step: F.sha2(
            F.concat(_text_of(step["before"]), own, _text_of(step["after"])).cast("binary"), 256
        ),
    )


def manifest(rows: DataFrame, order: str, arity: int = ARITY) -> DataFrame:
    """Add ``subroot, root, path`` to rows with a ``grp`` and a ``digest``.

    The leaves of a group ascend by ``order`` and then by digest, nulls first; while
    a group has several nodes, every ``arity`` of them become their parent, whose
    digest is that of the children's hex texts. The roots of the groups, ordered by
    group with null first, give the root in the same way. ``path`` lists the
    siblings of the leaf and of its ancestors as binary digests ``before`` and
    ``after``, up to the root. Rows that repeat each other are leaves of their own.
    An empty table gives no rows.
    """
    rows = stage(rows.withColumn("row", F.monotonically_increasing_id()), "leaves")
    leaves = _ranked(rows, [order, "digest", "row"], "ordered")
    levels = _levels(leaves, arity)
    groups = stage(
        _tops(leaves, levels).select(
            F.lit(None).cast("string").alias("grp"), F.col("grp").alias("name"), "digest"
        ),
        "groups",
    )
    leaves_above = _ranked(groups, ["name"], "ordered-groups")
    levels_above = _levels(leaves_above, arity)
    root = _tops(leaves_above, levels_above).select(
        "grp", F.col("digest").alias("root"), F.array().cast(_PATH).alias("path")
    )
    root = stage(root, "root")
    of_groups = _with_ancestors(leaves_above, levels_above, root, arity).select(
        F.col("name").alias("grp"), F.col("digest").alias("subroot"), "root", "path"
    )
    found = _with_ancestors(leaves, levels, stage(of_groups, "groups"), arity)
    return found.drop("lo", "hi", "n", "row", "grp")


def tampered_documents(docs: DataFrame) -> F.Column:
    """True where the check pretends that somebody put the text in lower case."""
    return F.crc32(docs["doc_id"].cast("string").cast("binary")) % 5 == 0


def verified_manifest(docs: DataFrame, arity: int = ARITY) -> DataFrame:
    """One row for each document with its proof, checked against the root.

    ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``. Groups are
    sources. Nulls count as ``-`` in a leaf; a null ``doc_id`` stands before all
    others and is never tampered with. Texts are hashed whole, however long. Rows
    that repeat each other each have a leaf; an empty table gives no rows. Columns
    other than the five of a leaf are not read.
    """
    plain = [docs[c] for c in FIELDS]
    lower = F.translate(docs["text"], "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    rows = docs.select(
        docs["doc_id"],
        docs["source"].cast("string").alias("grp"),
        row_digest(plain).alias("digest"),
        F.when(tampered_documents(docs), row_digest([*plain[:-1], lower])).alias("other"),
    )
    found = manifest(rows, "doc_id", arity)
    siblings = F.transform("path", lambda s: _text_of(F.concat(s["before"], s["after"])))
    return found.select(
        "doc_id",
        _text_of("digest").alias("leaf"),
        _text_of("subroot").alias("subroot"),
        _text_of("root").alias("root"),
        F.sha2(F.array_join(siblings, "").cast("binary"), 256).alias("proof_sha256"),
        folded(F.coalesce("other", "digest"), F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
