"""Replacing a table or folder so that the old content stays until the new is whole.

New content is written aside, into a folder of its own, and only then made
current: by one row in the folder's log, or by the catalog entry's location. A
writer that fails half-way leaves a folder that nothing points to. Older versions
stay readable for queries that began before; drop them as your storage does.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOG = "seq bigint, version string, written timestamp"


def _log(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.schema(LOG).json(f"{path}/log")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _current(spark: SparkSession, path: str):
    log = _log(spark, path)
    return log.orderBy(F.desc("seq"), F.desc("version")).first() if log is not None else None


def current_folder(spark: SparkSession, path: str) -> str:
    """The folder of the content that ``replace_folder`` made current last."""
    row = _current(spark, path)
    if row is None:
        raise FileNotFoundError(f"nothing was written to {path}")
    return f"{path}/{row['version']}"


def replace_folder(df: DataFrame, path: str, fmt: str = "parquet", **options: str) -> str:
    """Make ``df`` the content of ``path``; returns the new version's folder.

    The switch is one small file that the writer's commit moves into the log: a
    reader sees the old version or the new one. Of two writers at once, one wins.
    """
    spark = df.sparkSession
    version = uuid.uuid4().hex
    df.write.format(fmt).options(**options).save(f"{path}/{version}")
    before = _current(spark, path)
    (spark.range(1).coalesce(1)
        .select(F.lit(before["seq"] + 1 if before else 1).alias("seq"), F.lit(version).alias("version"),
                F.current_timestamp().alias("written"))
        .write.mode("append").json(f"{path}/log"))
    return f"{path}/{version}"


def read_folder(spark: SparkSession, path: str, fmt: str = "parquet", schema=None) -> DataFrame:
    """The current content of ``path``."""
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if schema else reader).load(current_folder(spark, path))


def replace_table(df: DataFrame, table: str, folder: str, fmt: str = "parquet") -> None:
    """Make ``df`` the content of a catalog table whose data lie under ``folder``.

    The rows take the declared columns by name, cast as they are declared; then the
    table's location is switched. A table that is not there yet is created.
    """
    spark = df.sparkSession
    target = f"{folder}/{uuid.uuid4().hex}"
    if spark.catalog.tableExists(table):
        declared = spark.table(table).schema
        df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in declared]).write.format(fmt).save(target)
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{target}'")
    else:
        df.write.format(fmt).save(target)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
        spark.sql(f"CREATE TABLE {table} ({columns}) USING {fmt} LOCATION '{target}'")
    spark.catalog.refreshTable(table)


def replace_key_value_text(df: DataFrame, path: str, key: str, value: str) -> str:
    """``key<TAB>value`` lines in key order as the new content of ``path``."""
    line = F.concat_ws("\t", F.col(key).cast("string"), F.col(value).cast("string"))
    return replace_folder(df.orderBy(key).select(line.alias("value")), path, "text")
