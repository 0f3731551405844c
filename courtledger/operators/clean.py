"""Cleaning that applies to every input, and the audit columns of every output."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtledger.functions import blank_to_null, strip


def _string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def trim_strings(df: DataFrame, all_whitespace: bool = False) -> DataFrame:
    return df.withColumns({c: strip(F.col(c), all_whitespace) for c in _string_columns(df)})


def nullify_blanks(df: DataFrame) -> DataFrame:
    return df.withColumns({c: blank_to_null(F.col(c)) for c in _string_columns(df)})


def clean_strings(df: DataFrame, all_whitespace: bool = False) -> DataFrame:
    """Trim, then turn what is left empty into NULL, in a single projection."""
    return df.withColumns(
        {c: blank_to_null(strip(F.col(c), all_whitespace)) for c in _string_columns(df)}
    )


def add_audit_columns(
    df: DataFrame, source_file: str | Column, loaded_at: datetime | Column | None = None
) -> DataFrame:
    """Where a row came from and when it was loaded.

    Without ``loaded_at`` the time of the query is taken. A run that writes several
    tables passes one value, so that all of them carry the same load time.
    """
    source = F.lit(source_file) if isinstance(source_file, str) else source_file
    if loaded_at is None:
        loaded_at = F.current_timestamp()
    elif isinstance(loaded_at, datetime):
        loaded_at = F.lit(loaded_at)
    at = loaded_at.cast("timestamp")
    return df.withColumns({"source_file": source, "loaded_at": at, "updated_at": at})
