"""Stored game pages are read in small parts."""

import glob

import duckdb

from courtstats.catalog import games
from courtstats.sources.shared import FOLDER_SETTING, stage


def unpacked(folder):
    """Bytes that the row groups of a Parquet folder hold, and their number."""
    sql = "select max(n), count(*) from (select sum(total_uncompressed_size) as n from parquet_metadata('{}') group by file_name, row_group_id)"
    return duckdb.sql(sql.format(f"{folder}/*.parquet")).fetchall()[0]


def test_row_groups_of_pages_are_small(spark, tmp_path):
    """A task unpacks a row group's pages at once: 12,000 pages are 60 MB in each of 8 files."""
    path = str(tmp_path / "far")
    spark.range(12000).selectExpr("id as c_custkey", "id % 1000 - 0.25D as c_acctbal").write.parquet(f"{path}/customer.parquet")
    shared = f"{spark.conf.get(FOLDER_SETTING)}/pages-*"
    before = set(glob.glob(shared))
    pages = games.game_pages(spark, path)
    (stored,) = set(glob.glob(shared)) - before
    assert unpacked(stored)[0] < 48 << 20
    assert pages.count() == 12000


def test_writer_options_of_a_stage(spark):
    rows = spark.range(0, 20000, 1, 1).selectExpr("id", "sha2(cast(id as string), 256) as text")
    shared = f"{spark.conf.get(FOLDER_SETTING)}/groups-*"
    assert sorted(stage(rows, "groups", **{"parquet.block.size": 1 << 18}).collect()) == sorted(rows.collect())
    assert unpacked(glob.glob(shared)[0])[1] > 1
