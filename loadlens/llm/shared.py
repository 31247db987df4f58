"""What several operators use: tables in the shared folder, and the words of a text as an expression."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word, everywhere in this package: a run of characters other than these six.
SPACES = "\\x20\\x09-\\x0D"
WORD = f"[^{SPACES}]+"


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Where it is unset, a session on one machine gets a folder of its own; on a cluster, whose executors would not see
    it, that is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="loadlens-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


#: Spark removes the shuffle files of a query when it ends, instead of some time after its plan is out of use.
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str, partition_by=(), release: bool = False) -> DataFrame:
    """df as a table in the shared folder: computed once, and still there when an executor is lost.

    release: what was shuffled for it is given back as soon as it is written.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(RELEASE, None)
    if release:
        spark.conf.set(RELEASE, "true")
    try:
        df.write.partitionBy(*partition_by).parquet(path)
    finally:
        if release:
            spark.conf.unset(RELEASE) if before is None else spark.conf.set(RELEASE, before)
    return spark.read.schema(df.schema).parquet(path)


def word_count(text: Column) -> Column:
    """Number of words; null text has none."""
    spaced = F.trim(F.translate(F.coalesce(text, F.lit("")), "\t\n\u000b\f\r", "     "))
    return F.when(spaced == "", F.lit(0)).otherwise(F.size(F.split(spaced, " +"))).cast("long")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
