"""One step that puts the season folders of a run in the place of earlier ones.

The tables of a run are written beside the published folders first, where readers
do not look. Then a journal names them and the folders are moved. A run that fails
before the journal leaves everything as it was; one that fails later is finished
by the next call of ``finish``.
"""

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

JOURNAL = "_publish"
NO_SEASON = "__HIVE_DEFAULT_PARTITION__"


def _files(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def _exists(spark, path):
    files, folder = _files(spark, path)
    return files.exists(folder)


def _delete(spark, path):
    files, folder = _files(spark, path)
    files.delete(folder, True)


def _move(spark, old, new):
    files, folder = _files(spark, old)
    target = _files(spark, new)[1]
    files.mkdirs(target.getParent())
    files.delete(target, True)
    if not files.rename(folder, target):
        raise OSError(f"{old} could not be moved to {new}")


def publish(
    spark: SparkSession,
    journal: str,
    tables: dict[str, DataFrame],
    seasons: dict[str, list],
    season: str = "Season",
) -> None:
    """Write tables by season and replace the seasons listed for each path.

    A listed season without rows ends up empty, others stay as they are.
    ``journal`` is the folder that holds the journal, one for all tables.
    """
    finish(spark, journal)
    run = f"_new-{uuid.uuid4().hex}"
    moves = []
    try:
        for path, df in tables.items():
            (
                df.hint("rebalance", season)
                .write.partitionBy(season)
                .parquet(f"{path}/{run}")
            )
            for value in seasons[path]:
                name = f"{season}={NO_SEASON if value is None else value}"
                files, folder = _files(spark, f"{path}/{run}/{name}")
                files.mkdirs(folder)
                moves.append([f"{path}/{run}/{name}", f"{path}/{name}"])
        folders = [f"{path}/{run}" for path in tables]
        _write(spark, f"{journal}/{JOURNAL}", {"moves": moves, "folders": folders})
    except BaseException:
        for path in tables:
            _delete(spark, f"{path}/{run}")
        raise
    finish(spark, journal)


def finish(spark: SparkSession, journal: str) -> None:
    """Carry out what the journal still names, if there is one."""
    path = f"{journal}/{JOURNAL}"
    if not _exists(spark, path):
        return
    plan = json.loads(_read(spark, path))
    for new, place in plan["moves"]:
        # A folder that is gone was moved before.
        if _exists(spark, new):
            _move(spark, new, place)
    for folder in plan["folders"]:
        _delete(spark, folder)
    _delete(spark, path)


def _read(spark, path):
    files, folder = _files(spark, path)
    stream = files.open(folder)
    held = bytes(stream.readAllBytes())
    stream.close()
    return held


def _write(spark, path, value):
    """A file that is there whole or not at all."""
    files, folder = _files(spark, path)
    part = _files(spark, path + ".part")[1]
    out = files.create(part, True)
    out.write(bytearray(json.dumps(value).encode()))
    out.close()
    if not files.rename(part, folder):
        raise OSError(f"{path} could not be written")
