"""Tables whose contents change all at once.

``<table>/data/snapshot=<id>/[<year column>=<year>/]*.parquet`` holds rows, each write in a folder
of its own. ``<table>/index/snapshot=<id>`` holds, for each of those files, its rows and the smallest
and largest values of the columns that are looked up. ``<table>/commits/<number>.json`` says which snapshot holds each partition, with its
rows and bytes; the newest commit is the table. A write stages its files first and commits last,
by renaming one finished file, so readers see the table before or the table after. A write that
was cut off leaves a folder nobody refers to, and commits made meanwhile by another writer make
this one fail instead of being lost.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtledger.files import Files

#: The partition of a table without a partition column, and that of rows without a year.
WHOLE, NO_YEAR = "", "null"
DAY_MILLIS = 24 * 3600 * 1000


class ConcurrentWrite(RuntimeError):
    """Another writer has committed since this one looked."""


@dataclass(frozen=True)
class Part:
    """Where a partition lies, and what is in it."""

    snapshot: str
    rows: int
    bytes: int


@dataclass(frozen=True)
class Commit:
    number: int
    at: int
    parts: dict[str, Part]

    @property
    def rows(self) -> int:
        return sum(part.rows for part in self.parts.values())

    @property
    def bytes(self) -> int:
        return sum(part.bytes for part in self.parts.values())

    @property
    def snapshots(self) -> dict[str, list[str]]:
        """The partitions that each snapshot holds."""
        found: dict[str, list[str]] = {}
        for name, part in self.parts.items():
            found.setdefault(part.snapshot, []).append(name)
        return found


class SnapshotTable:
    """``schema`` ends in the partition column, if there is one; ``indexed`` columns can be looked up."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        partition: str | None,
        indexed: Sequence[str] = (),
    ):
        self.spark, self.path, self.schema, self.partition = spark, path.rstrip("/"), schema, partition
        self.indexed = list(indexed)
        self.files = Files(spark, path)

    # ---- commits

    def _numbers(self) -> list[int]:
        names = self.files.names(f"{self.path}/commits")
        return [int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0].isdigit()]

    def _commit_path(self, number: int) -> str:
        return f"{self.path}/commits/{number:012d}.json"

    def commit_of(self, number: int) -> Commit:
        record = json.loads(self.files.read(self._commit_path(number)))
        parts = {name: Part(**part) for name, part in record["parts"].items()}
        return Commit(number, record["at"], parts)

    def current(self) -> Commit | None:
        numbers = self._numbers()
        return self.commit_of(numbers[-1]) if numbers else None

    def commit(self, base: Commit | None, parts: dict[str, Part]) -> Commit:
        """Makes ``parts`` the table, if it is still what ``base`` says."""
        number = base.number + 1 if base else 1
        at = int(datetime.now(timezone.utc).timestamp() * 1000)
        record = {"at": at, "parts": {name: asdict(part) for name, part in parts.items()}}
        draft = f"{self.path}/commits/.draft-{uuid.uuid4().hex}"
        self.files.write(draft, json.dumps(record))
        if not self.files.rename(draft, self._commit_path(number)):
            self.files.delete(draft)
            raise ConcurrentWrite(f"{self.path}: commit {number} exists already")
        return Commit(number, at, parts)

    # ---- rows

    def _folder(self, snapshot: str) -> str:
        return f"{self.path}/data/snapshot={snapshot}"

    def _read_folder(self, snapshot: str) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self._folder(snapshot))

    def stage(self, df: DataFrame, options: dict[str, str] | None = None) -> dict[str, Part]:
        """Writes rows that nobody sees yet, and the index of their files, which has their counts."""
        snapshot = f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:12]}"
        folder = self._folder(snapshot)
        writer = df.write.options(**(options or {}))
        (writer.partitionBy(self.partition) if self.partition else writer).parquet(folder)
        self._write_index(snapshot)
        index = self._read_index(snapshot)
        if not self.partition:
            rows = index.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
            return {WHOLE: Part(snapshot, rows, self.files.size(folder))}
        # One row for each year.
        counts = index.groupBy(self.partition).agg(F.sum("rows")).collect()
        parts = {}
        for year, rows in counts:
            name, value = (NO_YEAR, "__HIVE_DEFAULT_PARTITION__") if year is None else (str(year), year)
            parts[name] = Part(snapshot, rows, self.files.size(f"{folder}/{self.partition}={value}"))
        return parts

    # ---- files

    def _index_path(self, snapshot: str) -> str:
        return f"{self.path}/index/snapshot={snapshot}"

    def _write_index(self, snapshot: str) -> None:
        # Only the looked-up columns are read; a file is one row, added up where it was read.
        path = F.substring_index("_metadata.file_path", f"/snapshot={snapshot}/", -1)
        bounds = [f(c).alias(f"{f.__name__}_{c}") for c in self.indexed for f in (F.min, F.max)]
        keys = [path.alias("path"), *([self.partition] if self.partition else [])]
        index = self._read_folder(snapshot).groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), *bounds)
        index.write.parquet(self._index_path(snapshot))

    def _read_index(self, snapshot: str) -> DataFrame:
        schema = T.StructType([T.StructField("path", T.StringType()), T.StructField("rows", T.LongType())])
        if self.partition:
            schema = schema.add(self.schema[self.partition])
        for column in self.indexed:
            kind = self.schema[column].dataType
            schema = schema.add(f"min_{column}", kind).add(f"max_{column}", kind)
        return self.spark.read.schema(schema).parquet(self._index_path(snapshot))

    def _current(self) -> Commit:
        commit = self.current()
        if commit is None:
            raise LookupError(f"no table at {self.path}")
        return commit

    def _files_of(self, snapshot: str, names: list[str]) -> DataFrame:
        files = self._read_index(snapshot)
        return files.filter(self._of_parts(names)) if self.partition else files

    def file_count(self) -> int:
        return sum(self._files_of(*held).count() for held in self._current().snapshots.items())

    def files_with(self, equal: dict) -> dict[str, list[str]]:
        """By snapshot, the files of the table that may hold rows with all the given values.

        Names come to the driver, which opens the files: those of one lookup, not of the table.
        """
        unknown = set(equal) - set(self.indexed)
        if unknown or not equal:
            raise ValueError(f"{self.path} is looked up by {self.indexed}, not by {sorted(equal)}")
        found = {}
        for snapshot, names in self._current().snapshots.items():
            files = self._files_of(snapshot, names)
            for column, value in equal.items():
                files = files.filter(F.lit(value).between(F.col(f"min_{column}"), F.col(f"max_{column}")))
            found[snapshot] = sorted(row.path for row in files.select("path").collect())
        return found

    def lookup(self, equal: dict) -> DataFrame:
        """Rows that have all the given values. Inside its files, row groups are passed over by
        their own bounds, dictionaries and Bloom filters."""
        result = self.spark.createDataFrame([], self.schema)
        for snapshot, names in self.files_with(equal).items():
            if names:
                folder = self._folder(snapshot)
                reader = self.spark.read.schema(self.schema).option("basePath", folder)
                result = result.unionByName(reader.parquet(*[f"{folder}/{name}" for name in names]))
        for column, value in equal.items():
            result = result.filter(F.col(column) == F.lit(value))
        return result

    # ---- the table

    def _of_parts(self, names: list[str]) -> Column:
        year = F.col(self.partition)
        years = [int(n) for n in names if n != NO_YEAR]
        return year.isin(years) | year.isNull() if NO_YEAR in names else year.isin(years)

    def read(self, number: int | None = None) -> DataFrame:
        """The table, or what it was after an earlier commit that is still kept."""
        commit = self.current() if number is None else self.commit_of(number)
        if commit is None:
            raise LookupError(f"no table at {self.path}")
        result = None
        for snapshot, names in commit.snapshots.items():
            rows = self._read_folder(snapshot)
            if self.partition and len(commit.snapshots) > 1:
                rows = rows.filter(self._of_parts(names))
            result = rows if result is None else result.unionByName(rows)
        return self.spark.createDataFrame([], self.schema) if result is None else result

    def select_sql(self, commit: Commit) -> str:
        """The table as SQL text, for a view."""
        columns = ", ".join(f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in self.schema)
        filled = {s: names for s, names in commit.snapshots.items() if any(commit.parts[n].rows for n in names)}
        if not filled:
            empty = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in self.schema)
            return f"SELECT {empty} WHERE false"
        selects = []
        for snapshot, names in filled.items():
            where = ""
            if self.partition and len(filled) > 1:
                years = [f"`{self.partition}` = {int(n)}" for n in names if n != NO_YEAR]
                years += [f"`{self.partition}` IS NULL"] * (NO_YEAR in names)
                where = f" WHERE {' OR '.join(years)}"
            selects.append(f"SELECT {columns} FROM parquet.`{self._folder(snapshot)}`{where}")
        return " UNION ALL ".join(selects)

    def expire(self, keep: int = 1, older_than: int = 7 * DAY_MILLIS) -> list[str]:
        """Deletes all commits but the last ``keep``, and the snapshots that only those refer to.

        Folders changed within ``older_than`` milliseconds stay: a write under way may own them.
        Returns the snapshots deleted.
        """
        numbers = self._numbers()
        kept = {s for n in numbers[-keep:] for s in self.commit_of(n).snapshots}
        for number in numbers[:-keep]:
            self.files.delete(self._commit_path(number))
        now = datetime.now(timezone.utc).timestamp() * 1000
        gone = []
        for name in self.files.names(f"{self.path}/data"):
            snapshot, folder = name.removeprefix("snapshot="), f"{self.path}/data/{name}"
            if name.startswith("snapshot=") and snapshot not in kept and now - self.files.modified(folder) >= older_than:
                self.files.delete(folder)
                self.files.delete(self._index_path(snapshot))
                gone.append(snapshot)
        return gone
