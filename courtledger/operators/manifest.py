"""File manifests: which files are new or changed, and which landing of a file is current."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_DIGITS = 64
# Of the hexadecimal digits of a SHA-256, so many are added up as one number.
_LANE = 15
# Each number is summed in pieces of so many bits, as bigint: no sum overflows below 2 ** 43 rows.
_PIECE_BITS = 20


def digest_lanes(digests: Column) -> dict[str, Column]:
    """The numbers a digest is taken apart into, as columns for ``combined_lanes``."""
    starts = range(1, _DIGITS + 1, _LANE)
    return {f"lane_{n}": F.conv(F.substring(digests, n, _LANE), 16, 10).cast("bigint") for n in starts}


def _lane_sum(number: Column) -> Column:
    total = None
    for low in range(0, 4 * _LANE, _PIECE_BITS):
        piece = F.shiftright(number, low).bitwiseAND(F.lit((1 << _PIECE_BITS) - 1))
        part = F.sum(piece).cast("decimal(20,0)") * F.lit(1 << low).cast("decimal(18,0)")
        total = part if total is None else total + part
    return total.cast("decimal(38,0)").cast("string")


def combined_lanes(lanes: Iterable[Column]) -> Column:
    """Aggregate: ``combined_digest`` of digests taken apart before.

    Where digests are many, so that each is taken apart once and not for each sum.
    """
    sums = [_lane_sum(lane) for lane in lanes]
    return F.sha2(F.concat_ws(":", F.count("*").cast("string"), *sums), 256)


def combined_digest(digests: Column) -> Column:
    """Aggregate: one digest for a bag of SHA-256 digests, whatever their order.

    Count and sums per slice of the digest are combined map-side, so the parts of a
    file of any size never meet in one task.
    """
    return combined_lanes(digest_lanes(digests).values())


def manifest_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """Every path of either manifest as new, changed, unchanged or removed."""
    before = F.col("old_sha")
    after = F.col("new_sha")
    return (
        old.select("path", F.col("sha256").alias("old_sha"))
        .join(new.select("path", F.col("sha256").alias("new_sha")), "path", "full")
        .withColumn(
            "status",
            F.when(before.isNull(), "new")
            .when(after.isNull(), "removed")
            .when(before != after, "changed")
            .otherwise("unchanged"),
        )
    )


def new_or_changed(old: DataFrame, new: DataFrame) -> DataFrame:
    """The entries of ``new`` that ``old`` lacks or has with another digest.

    The part of the diff a landing needs; ``new`` is evaluated once, which matters when
    it hashes the content of every file.
    """
    before = old.select("path", F.col("sha256").alias("old_sha"))
    return (
        new.join(before, "path", "left")
        .filter(~F.col("sha256").eqNullSafe(F.col("old_sha")))
        .drop("old_sha")
    )


def manifest_merge(old: DataFrame, new: DataFrame) -> DataFrame:
    """Old entries overlaid by new ones; paths gone from the source stay."""
    return (
        old.select("path", F.col("sha256").alias("old_sha"))
        .join(new.select("path", F.col("sha256").alias("new_sha")), "path", "full")
        .select("path", F.coalesce("new_sha", "old_sha").alias("sha256"))
    )


def latest_per_path(landed: DataFrame, as_of: date | None = None) -> DataFrame:
    """The newest landing of each path, not later than ``as_of``.

    ``landed``: ``path, dt`` and any further columns, by which landings of one date are
    ordered. Taken as a maximum, which is combined map-side, so that a path landed very
    often is no burden.
    """
    if as_of is not None:
        landed = landed.filter(F.col("dt") <= F.lit(as_of))
    rest = [c for c in landed.columns if c not in ("path", "dt")]
    newest = F.max(F.struct("dt", *rest))
    return landed.groupBy("path").agg(newest.alias("newest")).select("path", "newest.*")


def resolve_processing_date(
    explicit: str | None, events: DataFrame | None, run_date: date
) -> date:
    """The given date, else the date of the newest landing event, else the run date."""
    if explicit:
        try:
            return datetime.strptime(explicit, "%Y-%m-%d").date()
        except ValueError:
            raise ValueError(f"not a date of the form YYYY-MM-DD: {explicit!r}") from None
    if events is not None:
        newest = events.agg(F.max("dt")).first()[0]
        if newest is not None:
            return newest
    return run_date
