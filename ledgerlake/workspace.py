"""Tables written to the shared folder, where lineage has to be cut.

The folder is the one the cluster names in ``spark.checkpoint.dir``. Written tables
survive the loss of any executor, and reading them back gives the planner real sizes, so
small ones are broadcast only when they are proven small.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_own_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not re.match(r"local(\[|$)", spark.conf.get("spark.master", "")):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.conf.get("spark.app.id", "local")
    if app not in _own_folders:
        _own_folders[app] = tempfile.mkdtemp(prefix="ledgerlake-")
    return _own_folders[app]


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path nobody has used yet."""
    return f"{shared_folder(spark)}/ledgerlake/{name}-{uuid.uuid4().hex}"


def literal_rows(spark: SparkSession, columns: str, rows: Sequence[tuple]) -> DataFrame:
    """A few known values as a table: ``literal_rows(spark, "n int, name string", [(1, "a")])``.

    Made of literals in the JVM; handing Python rows over would start a Python worker per core.
    """
    fields = [field.split(" ", 1) for field in columns.split(", ")]
    one = spark.range(0, 1, 1, 1)
    if not rows:
        return one.limit(0).select(*[F.lit(None).cast(kind).alias(name) for name, kind in fields])
    structs = [F.struct(*[F.lit(v).cast(kind).alias(name) for v, (name, kind) in zip(row, fields)]) for row in rows]
    return one.select(F.inline(F.array(*structs)))


def read_if_any(spark: SparkSession, path: str, schema: StructType | str, base: str | None = None) -> DataFrame:
    """A written table, or an empty one when nothing has been written yet.

    ``base`` is the table that ``path`` is a partition of.
    """
    try:
        return spark.read.schema(schema).option("basePath", base or path).parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        columns = schema if isinstance(schema, str) else ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
        return literal_rows(spark, columns, [])


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and return a DataFrame that reads the written table."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
