"""The registered queries: every operator applied to tables derived from the test data."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime
from functools import cached_property, reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtledger.operators import (
    audits,
    clean,
    integrity,
    manifest,
    match_stats as stats_ops,
    matches as match_ops,
    monitoring,
    profile,
    rankings as ranking_ops,
)
from courtledger.functions import compact_date
from courtledger.operators.players import transform_players
from courtledger.plans.fixtures import raw_matches, raw_players, raw_rankings, read_table
from courtledger.plans.pipeline import counted, run_landing, run_transform
from courtledger.plans.report_log import ReportLog
from courtledger.schemas import (
    CSV_SCHEMAS,
    MATCHES_CSV,
    PLAYERS_CSV,
    RANKINGS_CSV,
    SOURCE_LABELS,
    TABLES,
)
from courtledger.session import scratch_path, stored
from courtledger.sources import fingerprint, land, landed_counts, scan_csv
from courtledger.sources.csv import CORRUPT
from courtledger.sources.landing import MANIFEST_LOG
from courtledger.sources.quarantine import diagnose, repair
from courtledger.sources.summaries import LandedCounts
from courtledger.streaming.changes import watch_changes
from courtledger.warehouse import Warehouse

LOADED_AT = datetime(2025, 2, 1, 2, 0, 0)
HEALTH_AS_OF = datetime(2024, 1, 30, 23, 59, 59)
POSTLOAD_AS_OF = datetime(2024, 1, 30, 1, 30, 0)
BRONZE_AS_OF = date(2025, 1, 20)
LANDING_DATE = date(2025, 2, 1)
SECOND_LANDING = date(2025, 2, 8)
DELIVERED_AT = datetime(2025, 3, 20)
LOOKUP_FILES = 64
LOOKED_UP = {
    "winner_id": [8, 41],
    "loser_id": [15, 60],
    "tourney_date": [date(1995, 6, 15), date(1997, 2, 10)],
    "tourney_id": ["1996-0012", "1997-0033"],
}


class Inputs:
    """Raw inputs and tables of one query, each declared once however often it is used."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    @cached_property
    def raw_players(self) -> DataFrame:
        return raw_players(self.spark, self.sf_dir)

    @cached_property
    def raw_matches(self) -> DataFrame:
        return raw_matches(self.spark, self.sf_dir)

    @cached_property
    def raw_rankings(self) -> DataFrame:
        return raw_rankings(self.spark, self.sf_dir)

    @cached_property
    def cleaned_matches(self) -> DataFrame:
        return match_ops.clean_matches(self.raw_matches)

    @cached_property
    def deduped_rankings(self) -> DataFrame:
        return ranking_ops.dedup_rankings(self.raw_rankings)

    @cached_property
    def players(self) -> DataFrame:
        return transform_players(self.raw_players)

    @cached_property
    def matches(self) -> DataFrame:
        return match_ops.project_matches(self.cleaned_matches)

    @cached_property
    def tournaments(self) -> DataFrame:
        return match_ops.derive_tournaments(self.cleaned_matches)

    @cached_property
    def stats(self) -> DataFrame:
        return stats_ops.drop_empty_stats(stats_ops.unpivot_stats(self.cleaned_matches))

    @cached_property
    def rankings(self) -> DataFrame:
        return ranking_ops.sequence_rankings(self.deduped_rankings)

    @cached_property
    def tables(self) -> dict[str, DataFrame]:
        return {
            "dim_players": self.players,
            "dim_tournaments": self.tournaments,
            "fact_matches": self.matches,
            "fact_match_stats": self.stats,
            "fact_rankings": self.rankings,
        }


# ---- scans, sinks, landing ---------------------------------------------------


def _write_csv(df: DataFrame, schema: T.StructType, path: str, by: str | None = None) -> None:
    columns = list(schema.fieldNames()) + ([by] if by else [])
    writer = (
        df.select(*columns)
        .write.option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
    )
    (writer.partitionBy(by) if by else writer).csv(path)


def _written_and_scanned(spark, df, schema, **options) -> DataFrame:
    path = scratch_path(spark, "csv")
    _write_csv(df, schema, path)
    return scan_csv(spark, path, schema, **options)


def scan_players(inp: Inputs):
    scanned = _written_and_scanned(inp.spark, inp.raw_players, PLAYERS_CSV)
    return scanned.withColumn("source_file", F.lit(SOURCE_LABELS["players"]))


def scan_matches(inp: Inputs):
    return _written_and_scanned(inp.spark, inp.raw_matches, MATCHES_CSV)


def scan_rankings(inp: Inputs):
    return _written_and_scanned(inp.spark, inp.raw_rankings, RANKINGS_CSV)


def scan_quarantine(inp: Inputs):
    heights = F.when(F.col("player_id") % 9 == 0, F.concat("height", F.lit(".0"))).otherwise(
        F.col("height").cast("string")
    )
    damaged = inp.raw_players.withColumn("height", heights)
    scanned = _written_and_scanned(inp.spark, damaged, PLAYERS_CSV, keep_malformed=True)
    return scanned.select("player_id", "height", F.col(CORRUPT).alias("malformed_text"))


def quarantine_reasons(inp: Inputs):
    """Players as lines with bad numbers, lost and surplus fields: every fault, and if the row is repaired."""
    player = F.col("player_id")
    damaged = inp.raw_players.withColumns(
        {
            "id": player,
            "player_id": F.when(player % 50 == 0, F.concat(F.lit("p"), player)).otherwise(player.cast("string")),
            "height": F.when(player % 7 == 0, F.concat("height", F.lit(".0"))).otherwise(F.col("height").cast("string")),
        }
    )
    line = F.to_csv(F.struct(*PLAYERS_CSV.fieldNames()))
    line = F.when(F.col("id") % 77 == 0, F.substring_index(line, ",", 5)).when(
        F.col("id") % 91 == 0, F.concat(line, F.lit(",more"))
    ).otherwise(line)
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in PLAYERS_CSV.fields)
    options = {"columnNameOfCorruptRecord": CORRUPT}
    scanned = damaged.select("id", F.from_csv(line, f"{fields}, {CORRUPT} string", options).alias("row"))
    bad = stored(scanned.select("id", "row.*").filter(F.col(CORRUPT).isNotNull()), "malformed")
    fixed, _ = repair(bad, PLAYERS_CSV, ["id"])
    found = diagnose(bad, PLAYERS_CSV, ["id"]).drop("malformed_text")
    outcome = fixed.select("id", F.col("height").alias("repaired_height"))
    return found.join(outcome, "id", "left")


def _warehouse(spark, tables: dict[str, DataFrame]) -> Warehouse:
    path = scratch_path(spark, "warehouse")
    warehouse = Warehouse(spark, path.rsplit("/", 1)[-1].replace("-", "_"), path)
    for name, df in tables.items():
        warehouse.write(name, clean.add_audit_columns(df, name, LOADED_AT))
    return warehouse


def sink_roundtrip(inp: Inputs):
    warehouse = _warehouse(inp.spark, {"fact_matches": inp.matches})
    return warehouse.table("fact_matches").select(*TABLES["fact_matches"].columns.fieldNames())


def _lookups() -> list[tuple[str, object]]:
    return [(column, value) for column, values in LOOKED_UP.items() for value in values]


def sink_lookups(inp: Inputs):
    """Matches looked up in the sink by players, dates and tournaments: rows of each lookup."""
    warehouse = _warehouse(inp.spark, {})
    rows = clean.add_audit_columns(inp.matches, "fact_matches", LOADED_AT)
    warehouse.write("fact_matches", rows, files=LOOKUP_FILES)
    found = [
        warehouse.lookup("fact_matches", **{column: value}).agg(
            F.lit(column).alias("column_name"),
            F.lit(str(value)).alias("value"),
            F.count(F.lit(1)).alias("row_count"),
            F.sum("match_num").alias("match_nums"),
        )
        for column, value in _lookups()
    ]
    return reduce(DataFrame.unionByName, found)


def sink_lookup_files(inp: Inputs):
    """Files each of those lookups opens, with the sink in key order and along its curve."""
    warehouse = _warehouse(inp.spark, {})
    rows = stored(clean.add_audit_columns(inp.matches, "fact_matches", LOADED_AT), "matches")
    table = warehouse.snapshots("fact_matches")
    opened, files = {}, {}
    for curve in (False, True):
        warehouse.write("fact_matches", rows, files=LOOKUP_FILES, curve=curve)
        files[curve] = table.file_count()
        for column, value in _lookups():
            opened[curve, column, value] = sum(map(len, table.files_with({column: value}).values()))
    result = [
        (column, str(value), opened[False, column, value], files[False], opened[True, column, value], files[True])
        for column, value in _lookups()
    ]
    schema = "column_name string, value string, opened_key_order int, files_key_order int, opened_curve int, files_curve int"
    return inp.spark.createDataFrame(result, schema)


def table_status(inp: Inputs):
    written = {"dim_players": inp.players, "fact_rankings": inp.rankings}
    warehouse = _warehouse(inp.spark, written)
    inp.stats.write.option("path", f"{warehouse.path}/scratch").saveAsTable(
        f"`{warehouse.database}`.`scratch_stats`"
    )
    return warehouse.status().select("table_name", "status", "row_count")


def stage_metrics(inp: Inputs):
    """Row counts of each stage, observed while the ranking stages are written."""
    metrics: list[tuple[str, Observation]] = []
    raw = counted(inp.raw_rankings, "read", metrics)
    deduped = stored(
        counted(ranking_ops.dedup_rankings(raw), "deduplicated", metrics), "deduplicated"
    )
    sequenced = ranking_ops.sequence_rankings(deduped)
    stored(counted(sequenced, "written", metrics), "sequenced")
    rows = [(name, seen.get["n"]) for name, seen in metrics]
    return inp.spark.createDataFrame(rows, "stage string, row_count bigint")


def _source_files(inp: Inputs) -> dict[str, DataFrame]:
    """The derived inputs with the source file of each row: one per year, decade and table."""
    year = F.when(F.col("tourney_date") == "n/a", "1990").otherwise(F.substring("tourney_date", 1, 4))
    decade = F.substring("ranking_date", 3, 1)
    return {
        "players": inp.raw_players.withColumn("file", F.lit("atp_players.csv")),
        "matches": inp.raw_matches.withColumn(
            "file", F.concat(F.lit("atp_matches_"), year, F.lit(".csv"))
        ),
        "rankings": inp.raw_rankings.withColumn(
            "file", F.concat(F.lit("atp_rankings_"), decade, F.lit("0s.csv"))
        ),
    }


_MATCH_FILE = "atp_matches_{}.csv".format


def _edited_matches(matches: DataFrame) -> DataFrame:
    """Files of matches a week later: 1996 edited, 1997 without rows, 1998 gone, 1999 copied."""
    file = F.col("file")
    edited = matches.filter(
        ~file.isin(_MATCH_FILE(1997), _MATCH_FILE(1998))
        & ((file != _MATCH_FILE(1996)) | (F.col("match_num") % 2 == 0))
    )
    copied = matches.filter(file == _MATCH_FILE(1999)).withColumn("file", F.lit(_MATCH_FILE(2030)))
    return edited.unionByName(copied)


def _written_sources(spark, sources: dict[str, DataFrame], later: dict[str, DataFrame]):
    """Two folders of source files and the dates they are landed."""
    roots = [scratch_path(spark, "source") for _ in range(2)]
    for root, tables in zip(roots, (sources, later)):
        for kind, df in tables.items():
            _write_csv(df, CSV_SCHEMAS[kind], f"{root}/{kind}", by="file")
    emptied = spark.createDataFrame([], MATCHES_CSV).coalesce(1)
    _write_csv(emptied, MATCHES_CSV, f"{roots[1]}/matches/file={_MATCH_FILE(1997)}")
    return list(zip(roots, (LANDING_DATE, SECOND_LANDING)))


def land_changed(inp: Inputs):
    """Two landings of the derived inputs, and what each left as the current rows of every file.

    Before the second one the matches of 1996 are edited, those of 1997 emptied, those of 1998
    removed, and those of 1999 copied to a new file; all other files stay as they are.
    """
    spark, bronze = inp.spark, scratch_path(inp.spark, "bronze")
    sources = {kind: stored(df, f"source-{kind}") for kind, df in _source_files(inp).items()}
    later = {**sources, "matches": _edited_matches(sources["matches"])}
    landings = []
    for number, (root, day) in enumerate(_written_sources(spark, sources, later), 1):
        landed = land(spark, root, bronze, day)
        counts = stored(landed_counts(spark, bronze, day), "landed")
        landings.append(
            counts.select(
                F.lit(number).alias("landing"),
                "path",
                "dt",
                "row_count",
                F.lit(landed.count).cast("bigint").alias("changed_files"),
                F.lit(landed.removed).cast("bigint").alias("removed_files"),
            )
        )
    return landings[0].unionByName(landings[1])


def load_counts(inp: Inputs):
    """The derived inputs landed and loaded into all five tables: what each load logged."""
    spark = inp.spark
    root, bronze = scratch_path(spark, "source"), scratch_path(spark, "bronze")
    for kind, df in _source_files(inp).items():
        _write_csv(df, CSV_SCHEMAS[kind], f"{root}/{kind}", by="file")
    run_landing(spark, root, bronze, LANDING_DATE)
    warehouse = _warehouse(spark, {})
    run_transform(bronze, warehouse, loaded_at=LOADED_AT)
    return ReportLog(spark, warehouse.path).counts().drop("run")


def _document_paths(inp: Inputs):
    path = F.concat("source", F.lit("/"), F.col("doc_id").cast("string"))
    return read_table(inp.spark, inp.sf_dir, "documents").select("doc_id", path.alias("path"), "text")


def content_fingerprint(inp: Inputs):
    """All documents written as source files, dealt by number, and fingerprinted."""
    root = scratch_path(inp.spark, "files")
    docs = read_table(inp.spark, inp.sf_dir, "documents").select(
        F.concat(F.lit("atp_matches_"), 1900 + F.col("doc_id") % 100, F.lit(".csv")).alias("file"),
        "doc_id",
        F.coalesce("text", F.lit("")).alias("text"),
    )
    docs = docs.repartition("file").sortWithinPartitions("file", "doc_id")
    docs.select("file", "text").write.partitionBy("file").text(root)
    return fingerprint(inp.spark, root, files_named="*.txt")


def _manifests(inp: Inputs):
    """All documents before and after: some edited, some moved to another path."""
    docs = _document_paths(inp)
    doc = F.col("doc_id")
    moved = F.when(doc % 10 == 0, F.concat("path", F.lit("-moved"))).otherwise(F.col("path"))
    edited = F.when(doc % 7 == 0, F.concat("text", F.lit("x"))).otherwise(F.col("text"))
    return (
        docs.select("path", F.sha2("text", 256).alias("sha256")),
        docs.select(moved.alias("path"), F.sha2(edited, 256).alias("sha256")),
    )


def manifest_diff(inp: Inputs):
    return manifest.manifest_diff(*_manifests(inp))


def manifest_merge(inp: Inputs):
    return manifest.manifest_merge(*_manifests(inp))


def bronze_latest(inp: Inputs):
    """Documents stand for landings: every source is landed again on many dates."""
    docs = read_table(inp.spark, inp.sf_dir, "documents")
    landed = docs.select(
        F.col("source").alias("path"),
        F.date_add(F.lit(date(2025, 1, 1)), (F.col("doc_id") % 28).cast("int")).alias("dt"),
        F.sha2("text", 256).alias("sha256"),
    )
    return manifest.latest_per_path(landed, BRONZE_AS_OF)


def _landed_twice(inp: Inputs, report: Callable[[LandedCounts], DataFrame]) -> DataFrame:
    """A report from counts by file after each of two landings in which every kind changes.

    Half the rankings of each 15th stand in a second file too. A week later matches are edited as
    for ``land_changed``, a quarter of that second file has other points, and of the players one
    in ten is gone and one in ten is doubled.
    """
    spark, bronze = inp.spark, scratch_path(inp.spark, "bronze")
    sources = {kind: stored(df, f"source-{kind}") for kind, df in _source_files(inp).items()}
    rankings, players, rank, player = sources["rankings"], sources["players"], F.col("rank"), F.col("player_id")
    again = rankings.filter(F.col("ranking_date").endswith("15") & (rank % 2 == 0)).withColumn(
        "file", F.lit("atp_rankings_current.csv")
    )
    other = again.withColumn("points", F.when(rank % 4 == 0, F.col("points") + 1).otherwise(F.col("points")))
    later = {
        "players": players.filter(player % 10 != 3).unionByName(players.filter(player % 10 == 4)),
        "matches": _edited_matches(sources["matches"]),
        "rankings": rankings.unionByName(other),
    }
    sources["rankings"] = rankings.unionByName(again)
    reports = []
    for number, (root, day) in enumerate(_written_sources(spark, sources, later), 1):
        land(spark, root, bronze, day)
        found = report(LandedCounts(spark, bronze, day))
        reports.append(stored(found.select(F.lit(number).alias("landing"), "*"), "landed-report"))
    return reports[0].unionByName(reports[1])


def _deliveries(inp: Inputs) -> list[DataFrame]:
    """Documents as files, delivered four times: whole, half repeated or edited, late, restored."""
    docs = read_table(inp.spark, inp.sf_dir, "documents").filter("doc_id IS NOT NULL")
    doc, text = F.col("doc_id"), F.coalesce("text", F.lit(""))
    late = F.when(doc % 3 == 0, F.lit(date(2025, 3, 5))).otherwise(F.lit(date(2025, 2, 20)))
    edited = F.when(doc % 6 == 0, F.concat(text, F.lit("+"))).otherwise(text)
    parts = [
        (F.lit(True), F.lit(date(2025, 3, 1)), text),
        (doc % 2 == 0, F.lit(date(2025, 3, 8)), edited),
        (doc % 5 == 0, late, F.concat(text, F.lit("-"))),
        (doc % 3 == 0, F.lit(date(2025, 3, 15)), text),
    ]
    return [
        docs.filter(delivered).select(
            F.concat(F.lit("documents/"), doc.cast("string")).alias("path"),
            dt.alias("dt"),
            F.lit(DELIVERED_AT).alias("landed_at"),
            F.lit(str(number)).alias("landing"),
            F.sha2(content, 256).alias("sha256"),
            F.octet_length(content).cast("bigint").alias("size"),
            F.lit("documents").alias("kind"),
        )
        for number, (delivered, dt, content) in enumerate(parts, 1)
    ]


def content_changes(inp: Inputs):
    """What the stream over the manifest log reports after each delivery, repeats and late ones among them."""
    bronze, progress, found = (scratch_path(inp.spark, n) for n in ("bronze", "progress", "changes"))

    def keep(changes: DataFrame, batch_id: int) -> None:
        changes.write.mode("overwrite").parquet(f"{found}/batch={batch_id}")

    for delivery in _deliveries(inp):
        delivery.write.mode("append").parquet(f"{bronze}/{MANIFEST_LOG}")
        watch_changes(inp.spark, bronze, keep, progress).awaitTermination()
    return inp.spark.read.parquet(found).drop("batch", "kind")


# ---- cleaning and transforms -------------------------------------------------


def clean_strings(inp: Inputs):
    return clean.clean_strings(inp.raw_players)


def audit_columns(inp: Inputs):
    return clean.add_audit_columns(inp.players, SOURCE_LABELS["players"], LOADED_AT)


def parse_dates(inp: Inputs):
    return inp.raw_matches.select(
        "match_num", "tourney_date", compact_date(F.col("tourney_date")).alias("parsed_date")
    )


def unpivot_stats(inp: Inputs):
    return stats_ops.unpivot_stats(inp.cleaned_matches)


# ---- audits ------------------------------------------------------------------


def audit_tournaments(inp: Inputs):
    audited = audits.audit_tournaments(inp.cleaned_matches)
    return audited.withColumns(
        {
            f.name: F.array_join(F.col(f.name).cast("array<string>"), "|")
            for f in audited.schema.fields
            if isinstance(f.dataType, T.ArrayType)
        }
    )


# ---- integrity and monitoring ------------------------------------------------


def _metadata(inp: Inputs):
    """Table metadata with sizes and modification times that follow from the rows."""
    newest = {
        "dim_players": "dob",
        "dim_tournaments": "last_seen_date",
        "fact_matches": "tourney_date",
        "fact_match_stats": "tourney_date",
        "fact_rankings": "ranking_date",
    }
    parts = [
        df.agg(F.count("*").alias("row_count"), F.max(newest[name]).alias("newest")).select(
            F.lit(name).alias("table_id"),
            "row_count",
            (F.col("row_count") * 1000).alias("size_bytes"),
            F.unix_millis(F.col("newest").cast("timestamp")).alias("last_modified_time"),
        )
        for name, df in inp.tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def load_history(inp: Inputs):
    loads = {
        "dim_players": F.lit(LOADED_AT),
        "dim_tournaments": F.date_trunc("YEAR", "last_seen_date"),
        "fact_matches": F.date_trunc("MONTH", "tourney_date"),
        "fact_match_stats": F.date_trunc("MONTH", "tourney_date"),
        "fact_rankings": F.date_trunc("WEEK", "ranking_date"),
    }
    tables = {
        name: clean.add_audit_columns(df, name, loads[name])
        for name, df in inp.tables.items()
    }
    return monitoring.load_history(tables)


def orphan_tournaments(inp: Inputs):
    facts = {"fact_matches": inp.matches, "fact_match_stats": inp.stats}
    return integrity.orphan_tournaments(facts, inp.tournaments)


# ---- profiling ---------------------------------------------------------------


def _rounded(df: DataFrame) -> DataFrame:
    """Doubles to six digits, so that summation order does not show."""
    return df.withColumns(
        {
            f.name: F.round(f.name, 6)
            for f in df.schema.fields
            if isinstance(f.dataType, T.DoubleType)
        }
    )


def value_counts(inp: Inputs):
    columns = ["surface", "tourney_level", "round", "tourney_name", "winner_hand", "winner_ioc", "score"]
    return profile.value_counts(inp.cleaned_matches, columns, top=10)


_QUERIES: dict[str, Callable[[Inputs], DataFrame]] = {
    # scans, sinks, landing
    "scan_players": scan_players,
    "scan_matches": scan_matches,
    "scan_rankings": scan_rankings,
    "scan_quarantine": scan_quarantine,
    "quarantine_reasons": quarantine_reasons,
    "sink_roundtrip": sink_roundtrip,
    "sink_lookups": sink_lookups,
    "sink_lookup_files": sink_lookup_files,
    "table_status": table_status,
    "stage_metrics": stage_metrics,
    "content_fingerprint": content_fingerprint,
    "manifest_diff": manifest_diff,
    "manifest_merge": manifest_merge,
    "bronze_latest": bronze_latest,
    "land_changed": land_changed,
    "load_counts": load_counts,
    "content_changes": content_changes,
    "landed_quality": lambda inp: _landed_twice(inp, LandedCounts.quality_summary),
    "landed_history": lambda inp: _landed_twice(inp, LandedCounts.load_history),
    # cleaning and transforms
    "clean_strings": clean_strings,
    "audit_columns": audit_columns,
    "parse_dates": parse_dates,
    "transform_players": lambda inp: inp.players,
    "transform_matches": lambda inp: inp.matches,
    "dim_tournaments": lambda inp: inp.tournaments,
    "unpivot_stats": unpivot_stats,
    "match_stats": lambda inp: inp.stats,
    "dedup_rankings": lambda inp: inp.deduped_rankings,
    "transform_rankings": lambda inp: inp.rankings,
    # audits
    "audit_tournaments": audit_tournaments,
    "audit_rank_dupes": lambda inp: audits.audit_rank_dupes(inp.deduped_rankings),
    "audit_rank_gaps": lambda inp: audits.audit_rank_gaps(inp.deduped_rankings),
    "audit_point_inversions": lambda inp: audits.audit_point_inversions(inp.deduped_rankings),
    "audit_invalid_ranks": lambda inp: audits.audit_invalid_ranks(inp.rankings),
    "audit_stat_ranges": lambda inp: audits.audit_stat_ranges(inp.stats),
    # integrity
    "orphan_players": lambda inp: integrity.orphan_players(inp.matches, inp.players),
    "orphan_match_ids": lambda inp: integrity.orphan_match_ids(inp.matches, inp.players),
    "orphan_ranking_ids": lambda inp: integrity.orphan_ranking_ids(inp.deduped_rankings, inp.players),
    "orphan_stats": lambda inp: integrity.orphan_stats(inp.stats, inp.matches),
    "orphan_tournaments": orphan_tournaments,
    "null_fks": lambda inp: integrity.null_fks(inp.matches),
    "required_columns": lambda inp: integrity.required_columns(inp.tables),
    "player_matches": lambda inp: match_ops.player_matches(
        inp.matches, inp.players, inp.tournaments
    ),
    # monitoring
    "role_balance": lambda inp: monitoring.role_balance(inp.stats),
    "quality_summary": lambda inp: monitoring.quality_summary(inp.tables),
    "pipeline_health": lambda inp: monitoring.pipeline_health(_metadata(inp), HEALTH_AS_OF),
    "load_history": load_history,
    "postload_validation": lambda inp: monitoring.postload_validation(
        inp.tables, _metadata(inp), POSTLOAD_AS_OF
    ),
    # profiling
    "null_profile": lambda inp: profile.null_profile(inp.cleaned_matches),
    "describe_numeric": lambda inp: _rounded(profile.describe_numeric(inp.raw_matches)),
    "describe_categorical": lambda inp: profile.describe_categorical(inp.cleaned_matches),
    "value_counts": value_counts,
    "key_uniqueness": lambda inp: profile.key_uniqueness(inp.raw_players, "player_id"),
    "grain_check": lambda inp: profile.grain_check(inp.raw_rankings, ["ranking_date", "player"]),
    "date_coverage": lambda inp: profile.date_coverage(
        ranking_ops.clean_rankings(inp.raw_rankings), "ranking_date"
    ),
    "participation": lambda inp: profile.participation(inp.cleaned_matches),
    "duplicate_rows": lambda inp: profile.duplicate_rows(
        inp.deduped_rankings, ["ranking_date", "player_id"]
    ),
    "score_tokens": lambda inp: profile.score_tokens(inp.cleaned_matches),
    "hand_distribution": lambda inp: profile.hand_distribution(inp.players),
    "head_to_head": lambda inp: match_ops.find_matches(
        inp.cleaned_matches, winner_id=8, loser_id=15, tourney_name="Tourney 8"
    ),
    "issue_summary": lambda inp: profile.issue_summary(
        clean.clean_strings(inp.raw_players), inp.cleaned_matches
    ),
}


def _registered(query: Callable[[Inputs], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: query(Inputs(spark, sf_dir))


QUERIES = {name: _registered(query) for name, query in _QUERIES.items()}
