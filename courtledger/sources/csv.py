"""Typed CSV reading."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtledger.session import stored

CORRUPT = "_corrupt_record"


def scan_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType,
    keep_malformed: bool = False,
    strict_header: bool = False,
    source_file: bool = False,
) -> DataFrame:
    """Files with a header line, columns bound by position, bad fields read as NULL.

    ``keep_malformed`` adds the raw text of rows that did not fit the schema;
    ``strict_header`` fails on a header that differs from it; ``source_file`` adds
    the name of the file a row came from.
    """
    wanted = schema
    if keep_malformed:
        wanted = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    rows = (
        spark.read.schema(wanted)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("enforceSchema", not strict_header)
        .csv(list(paths) if not isinstance(paths, str) else paths)
    )
    if source_file:
        rows = rows.select("*", F.col("_metadata.file_name").alias("source_file"))
    return rows


def split_malformed(scanned: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(rows that fit, rows that did not)`` of a scan that kept malformed text.

    A row that does not fit is still in the scan, with NULL where a field was bad. The
    CSV reader judges a row by the columns a query asks for, so the scan is stored whole
    first: both sides then agree, and the text is parsed once for the two of them.
    """
    rows = stored(scanned, "scanned")
    bad = F.col(CORRUPT).isNotNull()
    return rows.filter(~bad).drop(CORRUPT), rows.filter(bad)


def read_optional(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """A file for exploration, or None where it does not exist. Types are inferred if not given."""
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    try:
        return reader.csv(path)
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_present(spark: SparkSession, folder: str, names: Sequence[str]) -> dict[str, DataFrame]:
    """Those of the named files that exist in a folder, for exploration."""
    found = {name: read_optional(spark, f"{folder.rstrip('/')}/{name}") for name in names}
    return {name: df for name, df in found.items() if df is not None}
