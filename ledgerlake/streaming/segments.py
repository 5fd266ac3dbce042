"""Compaction of tables that get a folder for each micro-batch.

Complete batches are gathered in segments: a segment of level k holds the rows of ``FANOUT``
to the power k consecutive batches, and ``FANOUT`` segments become one of the next level, so the
number of folders to read grows with the logarithm of the batches. The rows themselves stay as
they are, hence everything that is folded from them does too.

A cover is the list of segments that count, and up to which batch they reach. It is written under
a number of its own after the segments it names, and is what a reader looks at first: until then
it reads the old one, after that it no longer looks at the folders behind it, whether they have
been deleted or not. The newest batch of a phase is never compacted, as it may be replayed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.sinks.tables import overwrite_partitions
from ledgerlake.workspace import literal_rows, read_if_any

FANOUT = 16
COVER = "phase string, level int, first_batch bigint, last_batch bigint, folder string"


def _files(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def _names(spark: SparkSession, path: str, key: str) -> list[str]:
    """Values of the partition folders ``key=…`` below a path."""
    folder, files = _files(spark, path)
    found = files.listStatus(folder) if files.exists(folder) else []
    names = [f.getPath().getName() for f in found]
    return [n.partition("=")[2] for n in names if n.startswith(f"{key}=")]


def _delete(spark: SparkSession, path: str) -> None:
    folder, files = _files(spark, path)
    files.delete(folder, True)


def cover(spark: SparkSession, path: str) -> tuple[int, list[tuple]]:
    """Number and segments of the newest cover; a cover has a few dozen rows at most."""
    numbers = [int(n) for n in _names(spark, f"{path}_covers", "number")]
    if not numbers:
        return 0, []
    newest = max(numbers)
    rows = spark.read.schema(COVER).parquet(f"{path}_covers/number={newest}").collect()
    return newest, sorted((r["phase"], r["first_batch"], r["level"], r["last_batch"], r["folder"]) for r in rows)


def read_all(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All rows of a table: its segments, and the batches behind them."""
    number, segments = cover(spark, path)
    reached: dict[str, int] = {}
    for phase, _, _, last, _ in segments:
        reached[phase] = max(last, reached.get(phase, -1))
    columns = [c.split(" ")[0] for c in schema.split(", ")]
    late = read_if_any(spark, path, schema)
    for phase, last in reached.items():
        late = late.where((F.col("phase") != phase) | (F.col("ingest_batch") > last))
    if not segments:
        return late
    kept = spark.read.schema(schema).parquet(*[f"{path}_segments/{folder}" for *_, folder in segments])
    return kept.select(*columns).unionByName(late.select(*columns))


def _merged(segments: list[tuple], fanout: int) -> list[list[tuple]]:
    """Runs of segments of one phase to be gathered: whenever the newest ones of a level are ``fanout`` many."""
    stack: list[list[tuple]] = []
    for s in segments:
        stack.append([s])
        while len(stack) >= fanout:
            last = stack[-fanout:]
            if len({(x[0][0], max(y[2] for y in x) + (len(x) > 1)) for x in last}) > 1:
                break
            stack[-fanout:] = [[y for x in last for y in x]]
    return stack


def compact(spark: SparkSession, path: str, schema: str, fanout: int = FANOUT) -> int:
    """Gathers what can be gathered; returns the number of folders that a reader then looks at.

    Batches that a cover holds are deleted one compaction later, and so are replaced segments, so a
    reader that still has the cover before finds what it names.
    """
    number, segments = cover(spark, path)
    for old in (int(n) for n in _names(spark, f"{path}_covers", "number")):
        if old < number:
            _delete(spark, f"{path}_covers/number={old}")
    live = {folder for *_, folder in segments}
    for folder in _names(spark, f"{path}_segments", "segment"):
        if f"segment={folder}" not in live:
            _delete(spark, f"{path}_segments/segment={folder}")
    now, late = list(segments), 0
    for phase in _names(spark, path, "phase"):
        reached = max([s[3] for s in segments if s[0] == phase], default=-1)
        batches = sorted(int(n) for n in _names(spark, f"{path}/phase={phase}", "ingest_batch"))
        for batch in batches:
            if batch <= reached:
                _delete(spark, f"{path}/phase={phase}/ingest_batch={batch}")
        fresh = [b for b in batches if b > reached]
        now += [(phase, b, 0, b, None) for b in fresh[:-1]]
        late += len(fresh) - len(fresh[:-1])
    made, left = [], 0
    for run in _merged(sorted(now, key=lambda s: (s[0], s[1])), fanout):
        if len(run) == 1 and run[0][4] is None:
            left += 1  # waits for more of its kind
        elif len(run) == 1:
            made.append(run[0])
        else:
            phase, first, last = run[0][0], run[0][1], run[-1][3]
            level = max(s[2] for s in run) + 1
            folder = f"segment={phase}-{first}-{last}-{number + 1}"
            stored = [f"{path}_segments/{s[4]}" for s in run if s[4]]
            loose = [f"{path}/phase={phase}/ingest_batch={s[1]}" for s in run if not s[4]]
            parts = [spark.read.schema(schema).parquet(*stored)] if stored else []
            parts += [spark.read.schema(schema).option("basePath", path).parquet(*loose)] if loose else []
            reduce(DataFrame.unionByName, parts).coalesce(1).write.mode("overwrite").parquet(f"{path}_segments/{folder}")
            made.append((phase, first, level, last, folder))
    if made != segments:
        rows = literal_rows(spark, COVER, [(p, level, first, last, folder) for p, first, level, last, folder in made])
        overwrite_partitions(rows.withColumn("number", F.lit(number + 1)), f"{path}_covers", ["number"])
    return len(made) + left + late
