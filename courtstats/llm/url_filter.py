"""URL rules by hash prefix.

Each URL is expanded into host suffixes with path prefixes. Their short hash
prefixes are joined with those of the rules; full digests confirm a match and the
longest rule decides. Only suffixes and prefixes of sizes that some rule has are
made, so a URL gives at most (labels of the longest rule) x (different path lengths
of rules) expressions, however long it is.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Hexadecimal digits of a digest that are joined on.
PREFIX_DIGITS = 8


def _place(url):
    """Host and path of a URL column."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, UPPER.lower())
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def _digest(expression):
    return F.sha2(expression.cast("binary"), 256)


def filter_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every row of ``pages`` (page_id, url).

    ``rules`` has ``host, path, verdict``. A rule fits its host and all subdomains if
    the path of the URL starts with its path. The longest rule (host and path
    together, then its host) decides, of equal rules ``block``; without one
    ``default`` does. A null URL, or one without ``://``, has empty host and path.
    Rows that repeat are judged each;
    an empty table gives no rows, URLs are taken whole, however long, and other
    columns are not read.
    """
    rules = rules.select(
        F.coalesce("host", F.lit("")).alias("rule_host"),
        F.coalesce("path", F.lit("")).alias("rule_path"),
        F.col("verdict").alias("rule_verdict"),
    ).withColumn("rule", F.concat("rule_host", "rule_path"))
    sizes = rules.agg(
        F.max(F.size(F.split("rule_host", r"\."))).alias("labels"),
        F.sort_array(F.collect_set(F.char_length("rule_path"))).alias("lengths"),
    ).first()
    host, path = _place(F.coalesce("url", F.lit("")))
    placed = pages.select("page_id", host.alias("host"), path.alias("path"))
    if sizes.labels is None:
        return placed.select("*", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    suffixes = F.array_distinct(
        F.array(*[F.substring_index("host", ".", -k) for k in range(1, sizes.labels + 1)])
    )
    prefixes = F.array_distinct(F.array(*[F.substring("path", 1, n) for n in sizes.lengths]))
    expanded = (
        placed.select("host", "path")
        .distinct()
        .select("host", "path", F.explode(suffixes).alias("suffix"), prefixes.alias("prefixes"))
        .select("host", "path", "suffix", F.explode("prefixes").alias("prefix"))
        .withColumn("digest", _digest(F.concat("suffix", "prefix")))
        .withColumn("short", F.substring("digest", 1, PREFIX_DIGITS))
    )
    keyed = rules.withColumn("rule_digest", _digest(F.col("rule"))).withColumn(
        "short", F.substring("rule_digest", 1, PREFIX_DIGITS)
    )
    rank = F.struct(
        F.char_length("rule").alias("size"),
        F.char_length("rule_host").alias("host_size"),
        (F.col("rule_verdict") == "block").alias("blocks"),
        F.col("rule"),
        F.col("rule_verdict"),
    )
    confirmed = (F.col("digest") == F.col("rule_digest")) & (F.col("suffix") == F.col("rule_host"))
    best = (
        expanded.join(keyed, "short")
        .where(confirmed)
        .groupBy("host", "path")
        .agg(F.max(rank).alias("best"))
    )
    return placed.join(best, ["host", "path"], "left").select(
        "page_id",
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.rule_verdict", F.lit(default)).alias("verdict"),
    )
