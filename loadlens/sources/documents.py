"""Readers: text files, binary files, vendor directories, PDF listings, truth rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import PATH_STEPS, canonical_path


def read_text(spark: SparkSession, path: str, path_steps: str = "current", glob: str = "*.txt") -> DataFrame:
    """One row per text file of a directory: source_file, text."""
    files = spark.read.format("text").option("wholetext", "true").option("pathGlobFilter", glob).load(path)
    return files.select(
        canonical_path(F.col("_metadata.file_path"), PATH_STEPS[path_steps]).alias("source_file"),
        F.col("value").alias("text"),
    )


def read_binary(
    spark: SparkSession,
    path: str,
    path_steps: str = "raw",
    glob: str = "*.txt",
    recursive: bool = False,
    encoded_path: bool = True,
    file_columns: bool = False,
) -> DataFrame:
    """One row per file, bytes read as UTF-8; bad bytes become U+FFFD.

    encoded_path takes the percent-encoded metadata path, otherwise the plain path.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", str(recursive).lower())
        .load(path)
    )
    name = F.col("_metadata.file_path") if encoded_path else F.col("path")
    extra = FILE_COLUMNS if file_columns else ()
    return files.select(
        canonical_path(name, PATH_STEPS[path_steps]).alias("source_file"),
        F.col("content").cast("string").alias("text"),
        *extra,
    )


@dataclass(frozen=True)
class Reader:
    """How the documents of a rule set are read, and whether its table keeps columns it no longer writes."""

    binary: bool = False
    path_steps: str = "current"
    glob: str = "*.txt"
    encoded_path: bool = True
    file_columns: bool = False
    merge_schema: bool = True

    def read(self, spark: SparkSession, path: str) -> DataFrame:
        if not self.binary:
            return read_text(spark, path, self.path_steps, self.glob)
        return read_binary(
            spark, path, self.path_steps, self.glob, encoded_path=self.encoded_path, file_columns=self.file_columns
        )


#: What binary files bring beside their content.
FILE_COLUMNS = ("path", "modificationTime", "length")


def read_vendors(spark: SparkSession, base: str, path_steps: str = "current", glob: str = "*.txt") -> DataFrame:
    """Files under source=<vendor> directories, with the vendor in the source column."""
    files = (
        spark.read.format("text")
        .option("wholetext", "true")
        .option("pathGlobFilter", glob)
        .option("basePath", base)
        .load(base)
    )
    return files.select(
        canonical_path(F.col("_metadata.file_path"), PATH_STEPS[path_steps]).alias("source_file"),
        F.col("value").alias("text"),
        F.col("source").cast("string").alias("source"),
    )


def list_pdfs(spark: SparkSession, root: str) -> DataFrame:
    """Every PDF below root, any case of the extension; file contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.[pP][dD][fF]")
        .load(root)
        .select("path", "modificationTime", "length")
    )


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def truth_rows(spark: SparkSession, rows, fields) -> DataFrame:
    """Hand-written truth rows with an all-string schema."""
    schema = T.StructType([T.StructField(f, T.StringType()) for f in fields])
    return spark.createDataFrame([tuple(r.get(f) for f in fields) for r in rows], schema)
