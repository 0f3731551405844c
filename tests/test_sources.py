"""CSV reading, landing, manifests and the processing date."""

import hashlib
from datetime import date

import pytest
from pyspark.sql import functions as F

from courtledger.operators import manifest
from courtledger.schemas import MATCHES_CSV, PLAYERS_CSV, struct
from courtledger.sources import (
    current_manifest,
    fingerprint,
    land,
    read_bronze,
    read_optional,
    read_present,
    scan_csv,
    split_malformed,
)
from courtledger.sources import compact, landed_counts, landing
from courtledger.sources.landing import landing_events

DAY1, DAY2, DAY3 = date(2025, 2, 1), date(2025, 2, 8), date(2025, 2, 15)
PLAYERS_HEADER = ",".join(PLAYERS_CSV.fieldNames())
RANKINGS_HEADER = "ranking_date,rank,player,points"


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def test_matches_file_has_49_columns():
    assert len(MATCHES_CSV) == 49 and len(set(MATCHES_CSV.fieldNames())) == 49


@pytest.fixture
def odd_csv(tmp_path):
    lines = ["b,a,c", "1,x,185", " 2, y ,185.0", 'bad,"",3', "4,\tz\t,", "5", "6,p,7,8"]
    path = tmp_path / "odd.csv"
    path.write_text("\n".join(lines) + "\n")
    return str(path)


ODD = struct("a int, b string, c int")


def test_bad_fields_are_null_and_columns_bind_by_position(spark, odd_csv):
    assert sorted(rows(scan_csv(spark, odd_csv, ODD)), key=repr) == sorted(
        [
            (1, "x", 185),
            (None, " y ", None),
            (None, None, 3),
            (4, "\tz\t", None),
            (5, None, None),
            (6, "p", 7),
        ],
        key=repr,
    )


def test_malformed_rows_are_kept_apart_with_their_text(spark, odd_csv):
    scanned = scan_csv(spark, odd_csv, ODD, keep_malformed=True, source_file=True)
    good, bad = split_malformed(scanned)
    assert sorted(r.a for r in good.collect()) == [1, 4]
    assert sorted(r._corrupt_record for r in bad.collect()) == sorted(
        [" 2, y ,185.0", 'bad,"",3', "5", "6,p,7,8"]
    )
    # a projection of few columns does not change which rows fit
    assert bad.select("a").count() == 4 and good.select("a").count() == 2
    assert {r.source_file for r in scanned.collect()} == {"odd.csv"}


def test_strict_header_fails(spark, odd_csv):
    with pytest.raises(Exception, match="header|schema"):
        scan_csv(spark, odd_csv, ODD, strict_header=True).collect()


def test_missing_optional_file_is_skipped(spark, odd_csv, tmp_path):
    assert read_optional(spark, str(tmp_path / "none.csv")) is None
    assert read_optional(spark, odd_csv).count() == 6
    assert list(read_present(spark, str(tmp_path), ["odd.csv", "none.csv"])) == ["odd.csv"]


@pytest.fixture
def source(tmp_path):
    root = tmp_path / "source"
    (root / "old").mkdir(parents=True)
    (root / "atp_players.csv").write_text(f"{PLAYERS_HEADER}\n1,Ana,Lu,R,19870522,ESP,180,Q1\nx,Bad,Row,R,,,,\n")
    (root / "atp_rankings_20s.csv").write_text(f"{RANKINGS_HEADER}\n20240101,1,1,100\n")
    (root / "atp_rankings_current.csv").write_text(f"{RANKINGS_HEADER}\n20250101,1,1,100\n20250101,2,2,90\n")
    (root / "atp_matches_2024.csv").write_text(",".join(MATCHES_CSV.fieldNames()) + "\nT1,Open,Hard\n")
    (root / "old" / "atp_matches_1999.csv").write_text(",".join(MATCHES_CSV.fieldNames()) + "\nT0,Cup,Clay\n")
    (root / "atp_matches_doubles_2020.csv").write_text("not,landed\n")
    (root / "atp_rankings_1x.csv").write_text("not,landed\n")
    (root / "README.md").write_text("not landed")
    return root


def test_fingerprint_finds_known_names_and_hashes_bytes(spark, source):
    found = {r.path: r for r in fingerprint(spark, str(source)).collect()}
    assert {path: r.kind for path, r in found.items()} == {
        "atp_players.csv": "players",
        "atp_rankings_20s.csv": "rankings",
        "atp_rankings_current.csv": "rankings",
        "atp_matches_2024.csv": "matches",
        "old/atp_matches_1999.csv": "matches",
    }
    for path, row in found.items():
        content = (source / path).read_bytes()
        assert (row.sha256, row.size) == (content_digest(content), len(content))


def content_digest(content):
    sha = lambda x: hashlib.sha256(x.encode() if isinstance(x, str) else x).hexdigest()
    lines = content.split(b"\n")
    lines = lines[:-1] if lines[-1] == b"" else lines
    numbered = [sha(f"{n}:{sha(line)}") for n, line in enumerate(lines)]
    lanes = [str(sum(int(d[k : k + 15], 16) for d in numbered)) for k in range(0, 64, 15)]
    return sha(f"{len(content)}:{sha(':'.join([str(len(lines)), *lanes]))}")


def test_content_is_seen_whatever_the_splits(spark, source):
    path = source / "atp_rankings_current.csv"
    body = [f"2024{k % 12 + 1:02d}01,{k},{k},{k}" for k in range(4000)]

    def digest(lines, end="\n", split=None):
        path.write_bytes(end.join([RANKINGS_HEADER, *lines, ""]).encode())
        before = spark.conf.get("spark.sql.files.maxPartitionBytes")
        spark.conf.set("spark.sql.files.maxPartitionBytes", split or before)
        spark.conf.set("spark.sql.files.minPartitionNum", 1)
        try:
            found = {r.path: r.sha256 for r in fingerprint(spark, str(source)).collect()}
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)
            spark.conf.unset("spark.sql.files.minPartitionNum")
        assert found[path.name] == content_digest(path.read_bytes())
        return found[path.name]

    first = digest(body)
    assert digest(body, split="7000") == first
    changed = [*body[:3000], body[3000].replace("3000", "3001"), *body[3001:]]
    swapped = [body[1], body[0], *body[2:]]
    assert len({first, digest(changed), digest(swapped, split="7000"), digest(body, end="\r\n")}) == 4


def test_a_folder_named_like_the_root_is_another_file(spark, source):
    inner = source / "x" / str(source).lstrip("/")
    inner.mkdir(parents=True)
    (inner / "atp_players.csv").write_text(f"{PLAYERS_HEADER}\n")
    paths = [r.path for r in fingerprint(spark, str(source)).collect()]
    assert len(paths) == len(set(paths)) == 6


def test_an_emptied_file_has_no_rows_left(spark, source, tmp_path):
    root, bronze = str(source), str(tmp_path / "bronze")
    land(spark, root, bronze, DAY1)
    (source / "atp_rankings_current.csv").write_text(f"{RANKINGS_HEADER}\n")
    (source / "atp_rankings_20s.csv").unlink()
    again = land(spark, root, bronze, DAY1)
    assert again.files == ["atp_rankings_current.csv"] and again.removed == 1
    assert [r.points for r in read_bronze(spark, bronze, "rankings").collect()] == [100]


def test_folder_of_part_files_is_one_source_file(spark, source):
    folder = source / "atp_rankings_10s.csv"
    folder.mkdir()
    (folder / "part-0.csv").write_text(f"{RANKINGS_HEADER}\n20110101,1,1,1\n")
    (folder / "part-1.csv").write_text(f"{RANKINGS_HEADER}\n20120101,1,1,1\n")
    paths = [r.path for r in fingerprint(spark, str(source)).collect()]
    assert sorted(paths).count("atp_rankings_10s.csv") == 1 and len(paths) == 6


def test_landing_is_incremental_and_repeatable(spark, source, tmp_path):
    root, bronze = str(source), str(tmp_path / "bronze")
    assert len(land(spark, root, bronze, DAY1).files) == 5
    # nothing changed: nothing lands, no event
    again = land(spark, root, bronze, DAY2)
    assert again.files == [] and again.summary(spark).isEmpty()

    (source / "atp_rankings_current.csv").write_text(f"{RANKINGS_HEADER}\n20250108,1,1,110\n")
    assert land(spark, root, bronze, DAY3).files == ["atp_rankings_current.csv"]
    assert rows(landing_events(spark, bronze).select("dt", "file_count"), "dt") == [(DAY1, 5), (DAY3, 1)]

    # the newest landing of each file, not just the last date
    current = read_bronze(spark, bronze, "rankings")
    assert rows(current.select("ranking_date", "points"), "ranking_date") == [("20240101", 100), ("20250108", 110)]
    before = read_bronze(spark, bronze, "rankings", DAY2)
    assert before.count() == 3
    assert read_bronze(spark, bronze, "matches").count() == 2
    assert current_manifest(spark, bronze).count() == 5

    # malformed text travels along
    assert read_bronze(spark, bronze, "players").filter("_corrupt_record IS NOT NULL").count() == 1


def test_odd_folder_names_land_whole(spark, source, tmp_path):
    bronze = str(tmp_path / "bronze")
    nested = source / "archive 50%+x.csv"
    nested.mkdir()
    (nested / "atp_rankings_00s.csv").write_text(f"{RANKINGS_HEADER}\n20010101,1,1,1\n")
    landed = land(spark, str(source), bronze, DAY1)
    assert "archive 50%+x.csv/atp_rankings_00s.csv" in landed.files
    assert read_bronze(spark, bronze, "rankings").count() == 4
    assert land(spark, str(source), bronze, DAY2).files == []


def test_repeating_a_landing_of_the_same_day_replaces_it(spark, source, tmp_path):
    root, bronze = str(source), str(tmp_path / "bronze")
    land(spark, root, bronze, DAY1)
    (source / "atp_rankings_current.csv").write_text(f"{RANKINGS_HEADER}\n20250108,1,1,110\n")
    land(spark, root, bronze, DAY1)
    assert read_bronze(spark, bronze, "rankings").count() == 2
    # the landing before is still there, for readers that began with it
    assert spark.read.parquet(f"{bronze}/rankings").count() == 4
    assert land(spark, root, bronze, DAY1).files == []


def test_many_small_files_share_files_of_the_store(spark, tmp_path, monkeypatch):
    """Sources read a few at a time, and stored together however many they are."""
    monkeypatch.setattr(landing, "FILES_TOGETHER", 20)
    root, bronze = tmp_path / "many", str(tmp_path / "bronze")
    for k in range(50):
        (root / f"d{k}").mkdir(parents=True)
        (root / f"d{k}" / "atp_rankings_00s.csv").write_text(f"{RANKINGS_HEADER}\n20010101,1,{k},1\n20010101,2,{k},1\n")
    landed = land(spark, str(root), bronze, DAY1)
    assert (landed.count, landed.removed) == (50, 0)
    assert len(spark.read.parquet(f"{bronze}/rankings").inputFiles()) <= 5
    counts = landed_counts(spark, bronze).collect()
    assert len(counts) == 50 and {r.row_count for r in counts} == {2}
    assert read_bronze(spark, bronze, "matches").isEmpty()


def test_compaction_keeps_rows_dates_and_history(spark, source, tmp_path):
    root, bronze = str(source), str(tmp_path / "bronze")
    land(spark, root, bronze, DAY1)
    (source / "atp_rankings_current.csv").write_text(f"{RANKINGS_HEADER}\n20250108,1,1,110\n")
    (source / "atp_rankings_20s.csv").write_text(f"{RANKINGS_HEADER}\n")
    land(spark, root, bronze, DAY3)

    def seen(as_of=None):
        return (
            sorted(map(str, read_bronze(spark, bronze, "rankings", as_of).collect())),
            sorted(map(str, landed_counts(spark, bronze, as_of).collect())),
        )

    now, then = seen(), seen(DAY2)
    n = compact(spark, bronze, "rankings")
    assert n == current_manifest(spark, bronze).filter("kind = 'rankings'").count()
    assert seen() == now and seen(DAY2) == then
    landings = current_manifest(spark, bronze).filter("kind = 'rankings'").select("landing").distinct()
    assert landings.count() == 1
    # nothing is taken for changed afterwards
    assert land(spark, root, bronze, DAY3).count == 0


def test_removed_files_are_in_the_event(spark, source, tmp_path):
    root, bronze = str(source), str(tmp_path / "bronze")
    land(spark, root, bronze, DAY1)
    (source / "atp_rankings_20s.csv").unlink()
    (source / "atp_rankings_current.csv").write_text(f"{RANKINGS_HEADER}\n")
    land(spark, root, bronze, DAY2)
    assert rows(landing_events(spark, bronze).select("dt", "file_count", "removed_count"), "dt") == [(DAY1, 5, 0), (DAY2, 1, 1)]


def test_manifest_diff_and_merge(spark):
    old = spark.createDataFrame([("a", "1"), ("b", "1"), ("c", "1")], "path string, sha256 string")
    new = spark.createDataFrame([("a", "1"), ("b", "2"), ("d", "1")], "path string, sha256 string")
    diff = manifest.manifest_diff(old, new)
    assert rows(diff.select("path", "status"), "path") == [
        ("a", "unchanged"), ("b", "changed"), ("c", "removed"), ("d", "new"),
    ]
    assert rows(manifest.new_or_changed(old, new), "path") == [("b", "2"), ("d", "1")]
    assert rows(manifest.manifest_merge(old, new), "path") == [("a", "1"), ("b", "2"), ("c", "1"), ("d", "1")]
    # a first run finds everything new
    first = manifest.manifest_diff(old.limit(0), new)
    assert {r.status for r in first.collect()} == {"new"}


def test_combined_digest_ignores_order_but_not_counts(spark):
    def digest(values):
        df = spark.createDataFrame([(v,) for v in values], "v string").repartition(3)
        return df.agg(manifest.combined_digest(F.sha2("v", 256))).first()[0]

    assert digest(["a", "b", "c"]) == digest(["c", "a", "b"])
    assert len({digest(["a", "b"]), digest(["a", "b", "b"]), digest(["a", "c"]), digest(["a"])}) == 4


def test_processing_date(spark):
    events = spark.createDataFrame([(DAY1,), (DAY2,)], "dt date")
    assert manifest.resolve_processing_date("2025-01-05", events, DAY3) == date(2025, 1, 5)
    assert manifest.resolve_processing_date(None, events, DAY3) == DAY2
    assert manifest.resolve_processing_date(None, events.limit(0), DAY3) == DAY3
    with pytest.raises(ValueError, match="YYYY-MM-DD"):
        manifest.resolve_processing_date("05.01.2025", events, DAY3)
