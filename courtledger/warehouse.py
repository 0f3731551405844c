"""The five tables: definition, clustered writes, metadata and status."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from courtledger.layout import along_curve, bloom_options
from courtledger.schemas import TABLES, TableSpec
from courtledger.session import stored
from courtledger.snapshots import SnapshotTable

_METADATA_SCHEMA = "table_id string, row_count bigint, size_bytes bigint, last_modified_time bigint"


def conform(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Exactly the stored columns of a table: declared types, declared order."""
    if spec.year_of:
        df = df.withColumn(spec.year_column, F.year(spec.year_of))
    missing = {c: F.lit(None) for c in spec.unfilled if c not in df.columns}
    if missing:
        df = df.withColumns(missing)
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in spec.stored.fields])


def clustered(df: DataFrame, spec: TableSpec, files: int | None = None, curve: bool = True) -> DataFrame:
    """Rows ranged over tasks by year, place on the table's curve and cluster columns, and sorted so.

    The cluster columns end in the table key, so the range cuts also run through a
    year or a cluster value that holds much of the table. Without a curve, or with
    ``curve=False``, rows lie in the order of the cluster columns alone.
    """
    year = [spec.year_column] if spec.year_of else []
    if curve and spec.curve:
        return along_curve(stored(df, f"conformed-{spec.name}"), spec.curve, year, spec.cluster, files)
    order = year + spec.cluster
    ranged = df.repartitionByRange(files, *order) if files else df.repartitionByRange(*order)
    return ranged.sortWithinPartitions(*order)


class Warehouse:
    """The five tables below one shared path, and a database with a view of each.

    The path is the truth: a table is what its newest commit says, whether or not a catalog
    knows of it. The views are for SQL users and follow each commit.
    """

    def __init__(self, spark: SparkSession, database: str, path: str):
        self.spark = spark
        self.database = database
        self.path = path.rstrip("/")

    def _name(self, table: str) -> str:
        return f"`{self.database}`.`{table}`"

    def snapshots(self, name: str) -> SnapshotTable:
        spec = TABLES[name]
        return SnapshotTable(self.spark, f"{self.path}/{name}", spec.stored, spec.year_column, spec.looked_up)

    def _register(self, name: str) -> None:
        table = self.snapshots(name)
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.database}` LOCATION '{self.path}'")
        self.spark.sql(f"CREATE OR REPLACE VIEW {self._name(name)} AS {table.select_sql(table.current())}")

    def create(self, tables: list[str] | None = None) -> None:
        """Database and tables where they do not exist."""
        for name in tables if tables is not None else TABLES:
            if not self.exists(name):
                self.snapshots(name).commit(None, {})
            self._register(name)

    def attach(self) -> None:
        """Registers the tables found below the path, for sessions without a metastore."""
        for name in TABLES:
            if self.exists(name):
                self._register(name)

    def table(self, name: str) -> DataFrame:
        return self.snapshots(name).read()

    def tables(self) -> dict[str, DataFrame]:
        return {name: self.table(name) for name in TABLES}

    def lookup(self, name: str, **equal) -> DataFrame:
        """The rows of a table that have the given values, from the files that may hold them."""
        return self.snapshots(name).lookup(equal)

    def write(
        self,
        name: str,
        df: DataFrame,
        replace_all: bool = True,
        files: int | None = None,
        curve: bool = True,
    ) -> Observation:
        """Replaces a table, or with ``replace_all=False`` only the years present in ``df``.

        The new rows are staged beside the old ones and become the table in one step; a failure
        before that leaves the table as it was. Returns the row count ``n``, observed during the
        write. It is taken after the range exchange, whose sampling reads everything before it a
        second time. ``files`` and ``curve``: see ``clustered``.
        """
        spec, table = TABLES[name], self.snapshots(name)
        written = Observation()
        base = table.current()
        rows = clustered(conform(df, spec), spec, files, curve)
        rows = rows.observe(written, F.count(F.lit(1)).alias("n"))
        parts = table.stage(rows, bloom_options([c for c in spec.looked_up if c.endswith("_id")]))
        if base and spec.year_of and not replace_all:
            parts = base.parts | parts
        table.commit(base, parts)
        self._register(name)
        return written

    def publish(self, name: str, fmt: str, mode: str = "overwrite", **options: str) -> None:
        """Copies a table to another system through whatever connector the session has."""
        self.table(name).write.format(fmt).options(**options).mode(mode).save()

    def exists(self, name: str) -> bool:
        return self.snapshots(name).current() is not None

    def preflight(self) -> DataFrame:
        """Expected tables and whether each is present."""
        rows = [(name, self.exists(name)) for name in TABLES]
        return self.spark.createDataFrame(rows, "table_name string, present boolean")

    def metadata(self) -> DataFrame:
        """Rows, bytes and modification time (epoch milliseconds) of existing tables.

        All of it was recorded by the commits; no file is opened.
        """
        rows = []
        for name in TABLES:
            commit = self.snapshots(name).current()
            if commit:
                rows.append((name, commit.rows, commit.bytes, commit.at))
        return self.spark.createDataFrame(rows, _METADATA_SCHEMA)

    def _unmanaged(self) -> DataFrame:
        """The same of other tables of the database, from their files."""
        result = self.spark.createDataFrame([], _METADATA_SCHEMA)
        if not self.spark.catalog.databaseExists(self.database):
            return result
        others = self.spark.catalog.listTables(self.database)
        for name in sorted(t.name for t in others if not t.isTemporary and t.name not in TABLES):
            files = (
                self.spark.table(self._name(name))
                .select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time")
                .groupBy("file_path", "file_size", "file_modification_time")
                .agg(F.count("*").alias("n"))
            )
            result = result.unionByName(
                files.agg(
                    F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
                    F.coalesce(F.sum("file_size"), F.lit(0)).alias("size_bytes"),
                    F.unix_millis(F.max("file_modification_time")).alias("last_modified_time"),
                ).select(F.lit(name).alias("table_id"), "row_count", "size_bytes", "last_modified_time")
            )
        return result

    def status(self) -> DataFrame:
        """Every managed table, found or not, and tables of the database that are not managed."""
        expected = self.spark.createDataFrame([(n,) for n in TABLES], "table_id string").withColumn(
            "managed", F.lit(True)
        )
        known = F.coalesce("managed", F.lit(False))
        return (
            self.metadata()
            .unionByName(self._unmanaged())
            .withColumn("found", F.lit(True))
            .join(expected, "table_id", "full")
            .select(
                F.col("table_id").alias("table_name"),
                F.when(~known, "unmanaged")
                .when(F.col("found"), "ok")
                .otherwise("not found")
                .alias("status"),
                "row_count",
                F.round(F.col("size_bytes") / F.lit(1024.0 * 1024.0), 2).alias("size_mb"),
                F.timestamp_millis("last_modified_time").alias("last_modified"),
            )
        )
