"""Rows that do not fit their schema: which field, why, and what can be loaded all the same."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtledger.sources.csv import CORRUPT

# Quoted fields, whose commas separate nothing; a quote inside is doubled or follows a backslash.
_QUOTED = r'"(?:[^"\\]|\\.|"")*"'
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_REASON = "struct<field: string, value: string, reason: string>"


def _ddl(schema: T.StructType, as_text: bool = False) -> str:
    return ", ".join(f"`{f.name}` {'string' if as_text else f.dataType.simpleString()}" for f in schema.fields)


def _parsed(bad: DataFrame, schema: T.StructType) -> DataFrame:
    """Adds the row's fields as text and as typed, read by the rules of the scan, and their number."""
    unquoted = F.regexp_replace(CORRUPT, _QUOTED, "")
    return bad.withColumns(
        {
            "_text": F.from_csv(CORRUPT, _ddl(schema, as_text=True)),
            "_typed": F.from_csv(CORRUPT, _ddl(schema)),
            "_fields": F.size(F.split(unquoted, ",")),
        }
    )


def _typed_columns(schema: T.StructType) -> list[T.StructField]:
    return [f for f in schema.fields if not isinstance(f.dataType, T.StringType)]


def _text(field: T.StructField) -> Column:
    return F.col("_text")[field.name]


def _failed(field: T.StructField) -> Column:
    return _text(field).isNotNull() & F.col("_typed")[field.name].isNull()


def diagnose(bad: DataFrame, schema: T.StructType, keep: Sequence[str] = ()) -> DataFrame:
    """One row for each fault of each malformed row: ``field, value, reason``, text and ``keep``.

    ``bad``: rows whose text a scan kept. A wrong number of fields is a fault without a field; a
    row in which none is found has the reason ``unreadable``.
    """

    def fault(field: str | None, value: Column, reason: Column, present: Column) -> Column:
        found = F.struct(F.lit(field).alias("field"), value.alias("value"), reason.alias("reason"))
        return F.when(present, found.cast(_REASON))

    many = F.concat(F.col("_fields").cast("string"), F.lit(f" fields of {len(schema.fields)}"))
    nothing = F.lit(None).cast("string")
    faults = [fault(None, nothing, many, F.col("_fields") != len(schema.fields))]
    for field in _typed_columns(schema):
        reason = F.lit(f"not {field.dataType.simpleString()}")
        faults.append(fault(field.name, _text(field), reason, _failed(field)))
    unreadable = F.array(F.struct(nothing, nothing, F.lit("unreadable")).cast(_REASON))
    found = F.array_compact(F.array(*faults))
    return (
        _parsed(bad, schema)
        .select(*keep, F.col(CORRUPT).alias("malformed_text"), found.alias("_found"))
        .select(
            *keep, "malformed_text", F.inline(F.when(F.size("_found") == 0, unreadable).otherwise(F.col("_found")))
        )
    )


def _repaired(field: T.StructField) -> Column:
    """The value the text stands for if nothing is lost: blanks around it, a whole number as ``180.0``."""
    typed = F.col("_typed")[field.name]
    trimmed = F.trim(_text(field))
    if isinstance(field.dataType, _WHOLE):
        number = trimmed.try_cast("decimal(38,10)")
        whole = number.try_cast(field.dataType)
        value = F.when(number == whole, whole)
    else:
        value = trimmed.try_cast(field.dataType)
    return F.coalesce(typed, value)


def repair(bad: DataFrame, schema: T.StructType, keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """``(rows repaired, rows left)``: the first typed by the schema, the second as they came.

    A row is repaired when it has the right number of fields and every one that does not fit
    stands for a value all the same. Nothing is guessed: other rows are left whole.
    """
    fits = F.col("_fields") == len(schema.fields)
    for field in _typed_columns(schema):
        blank = F.trim(_text(field)) == ""
        fits = fits & (~_failed(field) | blank | _repaired(field).isNotNull())
    checked = _parsed(bad, schema).withColumn("_fits", F.coalesce(fits, F.lit(False)))
    typed = {f.name for f in _typed_columns(schema)}
    values = [(_repaired(f) if f.name in typed else _text(f)).alias(f.name) for f in schema.fields]
    fixed = checked.filter("_fits").select(*[F.col(c).alias(f"_kept_{c}") for c in keep], *values)
    fixed = fixed.select(*[F.col(f"_kept_{c}").alias(c) for c in keep], *schema.fieldNames())
    return fixed, checked.filter(~F.col("_fits")).select(*bad.columns)
