"""Incremental landing of source files into dated bronze partitions.

A source file is a CSV file, or a folder of part files carrying its name. Files are
compared by content. Changed ones are parsed once and stored as typed parquet under
``bronze/<kind>/dt=<date>/landing=<id>``, malformed text included, with the source file of each
row in the column ``path``; later steps read pruned columns from there instead of parsing text
again. Files of the store are of about equal size, whether the sources are few and large or many
and small. A landing has an id of its own and never touches rows landed before. The manifest log
says which landing of each file is current and is written last: until then readers see the
landing before, and a file whose landing was cut off stays "changed".
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import batched
from datetime import date, datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from courtledger.operators.manifest import combined_digest, combined_lanes, digest_lanes, latest_per_path, new_or_changed
from courtledger.schemas import CSV_SCHEMAS, FILE_PATTERNS
from courtledger.session import stored
from courtledger.sources.csv import scan_csv

_NAMES = "|".join(f"(?:{pattern})" for pattern in FILE_PATTERNS.values())
# Directories, then the file name; part files of a folder so named may follow.
_SOURCE_FILE = rf"^((?:.*/)?(?:[^/=]+=)?(?:{_NAMES}))(?:/.*)?$"

MANIFEST_LOG = "_manifest"
EVENT_LOG = "_events"
# Of several landings of a file on one date, the one landed last is current.
MANIFEST_SCHEMA = (
    "path string, dt date, landed_at timestamp, landing string, sha256 string, size bigint, "
    "kind string"
)
EVENT_SCHEMA = "dt date, prefix string, file_count bigint, removed_count bigint"
#: Source files that one job reads: Spark lists them on the driver, so many at a time, not all.
FILES_TOGETHER = 10_000
#: Row groups of stored digests of lines: about 100,000 lines, where tasks can be cut.
DIGEST_GROUP_BYTES = 4 * 1024 * 1024


def _relative(spark: SparkSession, file_path: Column, root: str) -> Column:
    """The part of a file URI below the root, percent signs decoded."""
    place = spark._jvm.org.apache.hadoop.fs.Path(root)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    base = system.makeQualified(place).toUri().getPath().rstrip("/") + "/"
    decoded = F.url_decode(F.replace(file_path, F.lit("+"), F.lit("%2B")))
    # Once, at the start: a folder below may well carry the name of the root again.
    path = F.regexp_replace(decoded, r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
    return F.when(path.startswith(base), F.substring(path, F.lit(len(base) + 1), F.length(path)))


def _file_kind(path: Column) -> Column:
    kind = F.lit(None).cast("string")
    for name, pattern in FILE_PATTERNS.items():
        kind = F.when(path.rlike(rf"(^|/)([^/=]+=)?{pattern}$"), name).otherwise(kind)
    return kind


def _source_file(path: Column) -> Column:
    """The source file a file belongs to; empty for files that are not recognised."""
    return F.regexp_extract(path, _SOURCE_FILE, 1)


def fingerprint(spark: SparkSession, root: str, files_named: str = "*.csv") -> DataFrame:
    """``path, sha256, size, kind`` of the recognised files below ``root``.

    One rule for files of any size: the digests of all lines, each with its number in the
    file, are added up, and the sum is hashed with the size. Lines end at line feeds only. So
    a changed byte, a changed order and changed line ends are all seen, while a file is read
    in splits by many tasks and never has to fit into one. A line's number is its place in
    its split and the lines of the splits before it, whatever the size of splits. Digests of
    lines are stored, so text is read once, and in small row groups: a split of short lines has
    many times the lines of another. The few splits come to the lines by broadcast.
    """
    options = {"recursiveFileLookup": True, "pathGlobFilter": files_named}
    files = spark.read.format("binaryFile").options(**options).load(root).select(
        F.col("_metadata.file_path").alias("file"), F.col("length").alias("size")
    )
    lines = stored(
        spark.read.options(**options, lineSep="\n").text(root).select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("place"),
            F.unhex(F.sha2("value", 256)).alias("digest"),
        ),
        "line-digests",
        {"parquet.block.size": DIGEST_GROUP_BYTES},
    )
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each split of a file. Stored, so that its size is known: unless files are very
    # many, it is broadcast, and lines are not dealt by split.
    splits = stored(
        lines.groupBy("file", "block")
        .agg(F.min("place").alias("first"), F.count("*").alias("n"))
        .select("file", "block", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift")),
        "splits",
    )
    line = F.lower(F.hex("digest"))
    numbered = F.sha2(F.concat_ws(":", F.col("place") + F.col("shift"), line), 256)
    # Columns one after the other: within the sums each would be computed anew for every part.
    placed = lines.join(splits, ["file", "block"]).select("file", numbered.alias("numbered"))
    lanes = digest_lanes(F.col("numbered"))
    contents = placed.select("file", *[lane.alias(name) for name, lane in lanes.items()])
    contents = contents.groupBy("file").agg(combined_lanes(map(F.col, lanes)).alias("lines"))
    digest = F.sha2(F.concat_ws(":", "size", F.coalesce("lines", F.lit(""))), 256)
    found = files.join(contents, "file", "left").select(
        _source_file(_relative(spark, F.col("file"), root)).alias("path"), digest.alias("digest"), "size"
    )
    digests = F.when(F.count("*") == 1, F.max("digest")).otherwise(combined_digest(F.col("digest")))
    return (
        found.filter("path <> ''")
        .groupBy("path")
        .agg(digests.alias("sha256"), F.sum("size").alias("size"))
        .withColumn("kind", _file_kind(F.col("path")))
    )


def _open_log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    spark.createDataFrame([], schema).write.mode("ignore").parquet(path)
    return spark.read.schema(schema).parquet(path)


def manifest_log(spark: SparkSession, bronze: str) -> DataFrame:
    return _open_log(spark, f"{bronze}/{MANIFEST_LOG}", MANIFEST_SCHEMA)


def landing_events(spark: SparkSession, bronze: str) -> DataFrame:
    return _open_log(spark, f"{bronze}/{EVENT_LOG}", EVENT_SCHEMA)


def current_manifest(spark: SparkSession, bronze: str, as_of: date | None = None) -> DataFrame:
    return latest_per_path(manifest_log(spark, bronze), as_of)


@dataclass(frozen=True)
class Landing:
    """One landing: how many files it brought and how many of the manifest are gone."""

    dt: date
    prefix: str
    count: int
    removed: int
    changed: DataFrame

    @property
    def files(self) -> list[str]:
        """Names of the files, for reports."""
        return [row.path for row in self.changed.select("path").orderBy("path").toLocalIterator()]

    def summary(self, spark: SparkSession) -> DataFrame:
        """The landing event; no row when nothing changed."""
        rows = [(self.dt, self.prefix, self.count, self.removed)] if self.count else []
        return spark.createDataFrame(rows, EVENT_SCHEMA)


def _read_changed(spark: SparkSession, root: str, kind: str, paths: Sequence[str]) -> DataFrame:
    """Rows of source files, each with the ``path`` of its own, which is found out once for a file."""
    files = [f"{root.rstrip('/')}/{path}" for path in paths]
    file = F.col("_metadata.file_path").alias("file")
    # Their contents are not read for this.
    named = spark.read.format("binaryFile").load(files).select(file)
    named = stored(named.withColumn("path", _source_file(_relative(spark, F.col("file"), root))), "named")
    rows = scan_csv(spark, files, CSV_SCHEMAS[kind], keep_malformed=True).select("*", file)
    return rows.join(named, "file", "left").drop("file")


def _new_id(at: datetime) -> str:
    return f"{at:%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:12]}"


def _store(rows: DataFrame, bronze: str, kind: str) -> None:
    """Appends rows in files of balanced size: rows of small sources together, large ones split."""
    # The order the writer needs for its folders, so that it does not sort once more.
    rows.hint("rebalance", "path").sortWithinPartitions("dt", "landing", "path").write.mode("append").partitionBy(
        "dt", "landing"
    ).parquet(f"{bronze}/{kind}")


def _append_manifest(entries: DataFrame, bronze: str) -> None:
    schema = [f.strip().split()[0] for f in MANIFEST_SCHEMA.split(",")]
    entries.select(*schema).hint("rebalance").write.mode("append").parquet(f"{bronze}/{MANIFEST_LOG}")


def _paths(changed: DataFrame, kind: str) -> Iterator[tuple[str, ...]]:
    """The changed files of a kind, so many at a time as one job reads."""
    names = changed.filter(F.col("kind") == kind).select("path").orderBy("path").toLocalIterator()
    return batched((row.path for row in names), FILES_TOGETHER)


def land(
    spark: SparkSession, root: str, bronze: str, dt: date, landed_at: datetime | None = None
) -> Landing:
    """Stores the new and changed files below ``root`` as a landing of ``dt``.

    What changed stays a table. Names of files pass the driver in shares, since that is where
    Spark opens files by name; rows, digests and the manifest do not. Files of the manifest that
    are gone are counted; their rows stay.
    """
    before, now = current_manifest(spark, bronze), stored(fingerprint(spark, root), "fingerprints")
    changed = stored(new_or_changed(before, now), "changed")
    removed = before.join(now, "path", "left_anti").count()
    at = landed_at or datetime.now(timezone.utc)
    place = {"dt": F.lit(dt), "landing": F.lit(_new_id(at))}
    for kind in CSV_SCHEMAS:
        for paths in _paths(changed, kind):
            _store(_read_changed(spark, root, kind, paths).withColumns(place), bronze, kind)
    result = Landing(dt, bronze, changed.count(), removed, changed)
    if result.count:
        _append_manifest(changed.withColumns({**place, "landed_at": F.lit(at)}), bronze)
        result.summary(spark).coalesce(1).write.mode("append").parquet(f"{bronze}/{EVENT_LOG}")
    return result


def stored_rows(spark: SparkSession, bronze: str, kind: str) -> DataFrame:
    """All rows of a kind ever landed, current or not, with ``path``, ``dt`` and ``landing``."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in CSV_SCHEMAS[kind].fields)
    schema = f"{fields}, _corrupt_record string, path string, dt date, landing string"
    try:
        return spark.read.schema(schema).parquet(f"{bronze}/{kind}")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)  # no file of the kind has ever been landed


def _current_rows(spark: SparkSession, bronze: str, kind: str, current: DataFrame) -> DataFrame:
    place = ["dt", "landing", "path"]
    wanted = current.filter(F.col("kind") == kind).select(*place)
    return stored_rows(spark, bronze, kind).join(wanted, place, "left_semi")


def read_bronze(
    spark: SparkSession, bronze: str, kind: str, as_of: date | None = None
) -> DataFrame:
    """All rows of a kind: of each file its newest landing up to ``as_of``.

    Incremental landings hold changed files only, so one date alone is not the table.
    The landings wanted prune the partitions that are read; a file that was emptied has a
    current landing without rows.
    """
    return _current_rows(spark, bronze, kind, current_manifest(spark, bronze, as_of)).drop("landing")


def landed_counts(spark: SparkSession, bronze: str, as_of: date | None = None) -> DataFrame:
    """``path, dt, row_count`` of every file's current landing, emptied files included."""
    current = current_manifest(spark, bronze, as_of)
    place = ["dt", "landing", "path"]
    counts = None
    for kind in CSV_SCHEMAS:
        rows = stored_rows(spark, bronze, kind).groupBy(*place).agg(F.count("*").alias("n"))
        counts = rows if counts is None else counts.unionByName(rows)
    return current.join(counts, place, "left").select(
        "path", "dt", F.coalesce("n", F.lit(0)).alias("row_count")
    )


def compact(spark: SparkSession, bronze: str, kind: str, landed_at: datetime | None = None) -> int:
    """Stores the current rows of a kind anew as one landing, each under the date it had.

    Many small landings become few files of balanced size. Readers go over to them when the
    manifest is written; contents and dates stay. Returns the number of files now in that landing.
    """
    current = stored(current_manifest(spark, bronze).filter(F.col("kind") == kind), "compacted")
    at = landed_at or datetime.now(timezone.utc)
    place = {"landing": F.lit(_new_id(at))}
    _store(_current_rows(spark, bronze, kind, current).withColumns(place), bronze, kind)
    _append_manifest(current.withColumns({**place, "landed_at": F.lit(at)}), bronze)
    return current.count()
