"""Sinks: truncate, and a replacement of a table's rows that a failed job does not harm.

New rows are written beside the old ones, and the table changes over when all are written: by one change of its location
if its columns stay, else by renaming the old table away and the new one in its place.
"""

from __future__ import annotations

import logging
import re
import uuid

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger(__name__)


def truncate(spark: SparkSession, name: str) -> bool:
    """Empty a table before a reload; whatever stands in the way only warns."""
    try:
        spark.sql(f"TRUNCATE TABLE {name}")
    except PySparkException as error:
        log.warning("not truncated: %s: %s", name, error)
        return False
    return True


def keep_old_columns(df: DataFrame, old_schema) -> DataFrame:
    """df plus the old schema's columns it lacks, as nulls at the end."""
    have = {c.lower() for c in df.columns}
    gone = [f for f in old_schema.fields if f.name.lower() not in have]
    return df.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in gone])


def _described(spark: SparkSession, name: str) -> dict:
    """What the catalogue says of a table: Location, Provider, Type, ..."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    begin = next((i for i, r in enumerate(rows) if r.col_name.startswith("# Detailed Table")), len(rows))
    return {r.col_name: r.data_type for r in rows[begin + 1 :]} | {"partitioned": any(r.col_name.startswith("# Partition") for r in rows)}


def _delete(spark: SparkSession, path: str) -> None:
    """Remove a folder; what stands in the way only warns, the table no longer needs it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    try:
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    except Exception as error:  # any store's own errors
        log.warning("not deleted: %s: %s", path, error)


def _beside(name: str, mark: str) -> str:
    """The name of a table next to this one."""
    return f"{name[:-1]}__{mark}`" if name.endswith("`") else f"{name}__{mark}"


def put_back(spark: SparkSession, name: str) -> bool:
    """Give a table back the rows that a job had moved aside when it was ended between its two renames."""
    old = _beside(name, "old")
    if not spark.catalog.tableExists(old):
        return False
    if spark.catalog.tableExists(name):  # the new rows are in place
        spark.sql(f"DROP TABLE {old}")
        return False
    spark.sql(f"ALTER TABLE {old} RENAME TO {name}")
    log.warning("put back: %s", name)
    return True


def _same_columns(df: DataFrame, spark: SparkSession, name: str) -> bool:
    shape = lambda schema: [(f.name, f.dataType.simpleString()) for f in schema.fields]
    return shape(df.schema) == shape(spark.table(name).schema)


def _buckets(about: dict) -> tuple[int, tuple]:
    """How a described table is bucketed: number and columns; 0 if it is not."""
    found = re.findall(r"`([^`]*)`", about.get("Bucket Columns", ""))
    return (int(about["Num Buckets"]), tuple(found)) if found else (0, ())


def overwrite(
    df: DataFrame, name: str, fmt: str = "parquet", merge_schema: bool = True, partition_by=(), accept=None, bucket_by=(0, ()),
) -> int:
    """Replace a table's rows and return how many were written; a table that does not exist is made.

    Until all new rows are written the table is as it was, and so it stays if the job fails or accept(rows), called
    with the number of rows before they show, raises. df may read the table itself. The count is observed by the write,
    so the input is read once. Formats that merge schemas on their own replace in one commit and get the write option;
    others get the old columns here. A partitioned table has its files under a location of its own (EXTERNAL), as the
    catalogue holds the place of every partition and these must not move. bucket_by is a number of buckets and their
    columns; a table that has buckets keeps them if none are given.
    """
    spark = df.sparkSession
    if fmt == "delta":
        return _counted(df, lambda d: d.write.format(fmt).mode("overwrite").option("mergeSchema", str(merge_schema).lower()).saveAsTable(name))
    put_back(spark, name)
    exists = spark.catalog.tableExists(name)
    if exists and merge_schema:
        df = keep_old_columns(df, spark.table(name).schema)
    mark = uuid.uuid4().hex
    if exists:
        about = _described(spark, name)
        bucket_by = bucket_by if bucket_by[0] else _buckets(about)
        if not bucket_by[0] and not partition_by and not about["partitioned"] and about.get("Provider") == fmt and _same_columns(df, spark, name):
            old = about["Location"]
            new = f"{re.sub('-[0-9a-f]{32}$', '', old.rstrip('/'))}-{mark}"
            try:
                rows = _counted(df, lambda d: d.write.format(fmt).save(new))
                if accept:
                    accept(rows)
                spark.sql(f"ALTER TABLE {name} SET LOCATION '{_quoted(new)}'")
            except BaseException:
                _delete(spark, new)
                raise
            spark.catalog.refreshTable(name)
            _delete(spark, old)
            return rows
    staged, old = _beside(name, mark), _beside(name, "old")
    place = f"{_folder(spark, name)}-{mark}" if partition_by else None
    before = about["Location"] if exists and about.get("Type") == "EXTERNAL" else None
    try:
        options = {"path": place} if place else {}

        def write(d):
            writer = d.write.format(fmt).options(**options).partitionBy(*partition_by)
            (writer.bucketBy(bucket_by[0], *bucket_by[1]) if bucket_by[0] else writer).saveAsTable(staged)

        rows = _counted(df, write)
        if accept:
            accept(rows)
        if exists:
            spark.sql(f"ALTER TABLE {name} RENAME TO {old}")
        spark.sql(f"ALTER TABLE {staged} RENAME TO {name}")
    except BaseException:
        put_back(spark, name)
        spark.sql(f"DROP TABLE IF EXISTS {staged}")
        _delete(spark, place or _folder(spark, staged))
        raise
    if exists:
        spark.sql(f"DROP TABLE {old}")
        if before:
            _delete(spark, before)
    return rows


def _counted(df: DataFrame, write) -> int:
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    return seen.get["rows"]


def _quoted(path: str) -> str:
    return path.replace("\\", "\\\\").replace("'", "\\'")


def _folder(spark: SparkSession, name: str) -> str:
    """Where a managed table of this name has its files."""
    *database, table = name.replace("`", "").split(".")
    about = spark.sql(f"DESCRIBE DATABASE {database[-1] if database else spark.catalog.currentDatabase()}").collect()
    return f"{next(r[1] for r in about if r[0] == 'Location').rstrip('/')}/{table}"
