"""The registered queries as SQL for the checking engine, written apart from the operators."""

from __future__ import annotations

from courtledger.plans.fixtures import MATCHES_SQL, PLAYERS_SQL, RANKINGS_SQL
from courtledger.schemas import MATCHES_CSV, PLAYERS_CSV, STAT_SUFFIXES, TABLES

_PLAIN = {t: t for t in ("customer", "nation", "orders", "lineitem", "events")}


def _names(schema, kind: str) -> list[str]:
    return [f.name for f in schema.fields if f.dataType.simpleString() == kind]


def _q(name: str) -> str:
    return f'"{name}"'


def _replaced(columns: list[str], expression: str) -> str:
    return ", ".join(f"{expression.format(_q(c))} AS {_q(c)}" for c in columns)


_BLANK = "nullif({}, '')"
_CLEAN = "nullif(trim({}), '')"
_DATE = "CAST(try_strptime({}, '%Y%m%d') AS DATE)"
_PLAYER_TEXT = _names(PLAYERS_CSV, "string")
_MATCH_TEXT = _names(MATCHES_CSV, "string")
_MATCH_NUMBERS = _names(MATCHES_CSV, "int") + _names(MATCHES_CSV, "float")


def _side(who: str) -> str:
    return (
        f"{who}_seed, {who}_entry, {who}_rank, {who}_rank_points, "
        f"CAST(trunc({who}_age) AS INT) AS {who}_age, {who}_ht, {who}_hand, {who}_ioc"
    )


def _stat_rows(who: str, prefix: str) -> str:
    stats = ", ".join(f'"{prefix}_{suffix}" AS {stat}' for stat, suffix in STAT_SUFFIXES.items())
    return (
        f"SELECT tourney_id, match_num, tourney_date, {who}_id AS player_id, "
        f"'{who}' AS player_role, {stats} FROM cm"
    )


# Each step of the derivation by name; a query lists the steps it needs, in order.
_STEPS = {
    "fx_players": PLAYERS_SQL.format(**_PLAIN),
    "fx_matches": MATCHES_SQL.format(**_PLAIN),
    "fx_rankings": RANKINGS_SQL.format(**_PLAIN),
    "cp": f"SELECT * REPLACE ({_replaced(_PLAYER_TEXT, _CLEAN)}) FROM fx_players",
    "tp": f"""
        SELECT player_id, name_first, name_last,
          CASE WHEN name_first IS NULL THEN name_last WHEN name_last IS NULL THEN name_first
               ELSE name_first || ' ' || name_last END AS full_name,
          CASE WHEN upper(hand) IN ('R', 'L', 'A', 'U') THEN upper(hand) ELSE 'U' END AS hand,
          {_DATE.format("split_part(dob, '.', 1)")} AS dob, ioc AS country_code, height AS height_cm
        FROM cp""",
    "ctext": f"SELECT * REPLACE ({_replaced(_MATCH_TEXT, _CLEAN)}) FROM fx_matches",
    "cm": f"SELECT * REPLACE ({_DATE.format('tourney_date')} AS tourney_date) FROM ctext",
    "tm": f"""
        SELECT tourney_id, match_num, tourney_date, winner_id, loser_id, surface, draw_size,
          tourney_level, upper("round") AS match_round, 'BO' || CAST(best_of AS VARCHAR) AS best_of,
          score, minutes AS match_minutes, {_side('winner')}, {_side('loser')}
        FROM cm""",
    "dt": """
        SELECT tourney_id, tourney_name, tourney_level, typical_surface, typical_draw_size,
          first_seen_date, last_seen_date
        FROM (
          SELECT tourney_id, tourney_name, tourney_level, surface AS typical_surface,
            draw_size AS typical_draw_size,
            row_number() OVER (PARTITION BY tourney_id ORDER BY count(*) DESC,
              tourney_name NULLS LAST, surface NULLS LAST, tourney_level NULLS LAST,
              draw_size NULLS LAST) AS rn
          FROM cm GROUP BY tourney_id, tourney_name, surface, tourney_level, draw_size) combos
        JOIN (
          SELECT tourney_id, min(tourney_date) AS first_seen_date,
            max(tourney_date) AS last_seen_date
          FROM cm GROUP BY tourney_id) ranges USING (tourney_id)
        WHERE rn = 1""",
    "us": f"{_stat_rows('winner', 'w')} UNION ALL {_stat_rows('loser', 'l')}",
    "ts": f"SELECT * FROM us WHERE coalesce({', '.join(STAT_SUFFIXES)}) IS NOT NULL",
    "cr": f"""
        SELECT {_DATE.format(_CLEAN.format('ranking_date'))} AS ranking_date,
          TRY_CAST({_CLEAN.format('player')} AS INT) AS player_id, rank, points
        FROM fx_rankings""",
    "dr": "SELECT DISTINCT ranking_date, player_id, rank, points FROM cr",
    "tr": """
        SELECT ranking_date, player_id, rank, points,
          CAST(row_number() OVER (PARTITION BY ranking_date, player_id
            ORDER BY rank NULLS LAST, points DESC NULLS LAST) AS INT) AS ranking_sequence
        FROM dr""",
}

_NEEDS = {
    "cp": ["fx_players"],
    "tp": ["cp"],
    "ctext": ["fx_matches"],
    "cm": ["ctext"],
    "tm": ["cm"],
    "dt": ["cm"],
    "us": ["cm"],
    "ts": ["us"],
    "cr": ["fx_rankings"],
    "dr": ["cr"],
    "tr": ["dr"],
}

_ALIAS = {
    "dim_players": "tp",
    "dim_tournaments": "dt",
    "fact_matches": "tm",
    "fact_match_stats": "ts",
    "fact_rankings": "tr",
}


def _with(steps: str, body: str, **instead: str) -> str:
    """The body after its steps; ``instead`` gives steps another text."""
    ordered: list[str] = []

    def add(step: str) -> None:
        for need in _NEEDS.get(step, []):
            add(need)
        if step not in ordered:
            ordered.append(step)

    for step in steps.split():
        add(step)
    texts = _STEPS | instead
    ctes = ",\n".join(f"{step} AS ({texts[step]})" for step in ordered)
    return f"WITH {ctes}\n{body}"


def _bigint(expression: str) -> str:
    return f"CAST({expression} AS BIGINT)"


def _stat_checks() -> str:
    rules = {f"negative_{s}": f"{s} < 0" for s in STAT_SUFFIXES}
    rules["first_serves_in_gt_service_points"] = "first_serves_in > service_points"
    rules["first_serves_won_gt_first_serves_in"] = "first_serves_won > first_serves_in"
    rules["break_points_saved_gt_break_points_faced"] = "break_points_saved > break_points_faced"
    parts = [
        f"SELECT '{name}' AS check_name, count(*) AS violations FROM ts WHERE {rule}"
        for name, rule in rules.items()
    ]
    return f"SELECT * FROM ({' UNION ALL '.join(parts)}) WHERE violations > 0"


def _required() -> str:
    parts = [
        f"SELECT '{spec.name}' AS table_name, '{c}' AS column_name, "
        f"count(*) FILTER (WHERE {c} IS NULL) AS null_count FROM {_ALIAS[spec.name]}"
        for spec in TABLES.values()
        for c in spec.required
    ]
    return (
        "SELECT *, CASE WHEN null_count > 0 THEN 'FAIL' ELSE 'PASS' END AS status "
        f"FROM ({' UNION ALL '.join(parts)})"
    )


_BALANCE = """
    SELECT w AS winner_count, l AS loser_count,
      CAST(least(w, l) AS DOUBLE) / nullif(greatest(w, l), 0) AS ratio
    FROM (SELECT count(*) FILTER (WHERE player_role = 'winner') AS w,
                 count(*) FILTER (WHERE player_role = 'loser') AS l FROM ts)"""

_ORPHANS = f"""
    SELECT count(*) FILTER (WHERE winner_id IS NULL OR winner_id NOT IN (SELECT player_id FROM tp)) AS orphaned_winners,
      count(*) FILTER (WHERE loser_id IS NULL OR loser_id NOT IN (SELECT player_id FROM tp)) AS orphaned_losers,
      count(*) FILTER (WHERE winner_id IS NULL) AS null_winners,
      count(*) FILTER (WHERE loser_id IS NULL) AS null_losers,
      count(*) AS total_rows
    FROM tm"""

_QUALITY = f"""
    SELECT 'fact_match_stats' AS table_name, 'player_role_balance' AS check_name,
      CASE WHEN winner_count = 0 OR loser_count = 0 THEN 'FAIL' WHEN ratio < 0.9 THEN 'WARN' ELSE 'PASS' END AS status,
      'winner=' || winner_count || ', loser=' || loser_count AS detail FROM ({_BALANCE})
    UNION ALL
    SELECT 'fact_matches', 'null_foreign_keys', CASE WHEN w + l > 0 THEN 'FAIL' ELSE 'PASS' END,
      'null winner_id=' || w || ', null loser_id=' || l
    FROM (SELECT count(*) - count(winner_id) AS w, count(*) - count(loser_id) AS l FROM tm)
    UNION ALL
    SELECT 'dim_players', 'duplicate_ids', CASE WHEN d > 0 THEN 'FAIL' ELSE 'PASS' END, 'duplicate_player_ids=' || d
    FROM (SELECT count(*) - count(DISTINCT player_id) AS d FROM tp)
    UNION ALL
    SELECT 'fact_rankings', 'duplicate_date_player', CASE WHEN d > 0 THEN 'WARN' ELSE 'PASS' END,
      'duplicate (date, player) pairs=' || d
    FROM (SELECT count(*) - count(DISTINCT CAST(ranking_date AS VARCHAR) || '_' || CAST(player_id AS VARCHAR)) AS d FROM tr)
    UNION ALL
    SELECT 'fact_matches', 'missing_scores', CASE WHEN m * 1.0 / nullif(n, 0) > 0.05 THEN 'WARN' ELSE 'PASS' END,
      m || ' of ' || n || ' matches missing scores'
    FROM (SELECT count(*) - count(score) AS m, count(*) AS n FROM tm)
    UNION ALL
    SELECT 'dim_players', 'missing_names', CASE WHEN m * 1.0 / nullif(n, 0) > 0.05 THEN 'WARN' ELSE 'PASS' END,
      m || ' of ' || n || ' players missing full_name (' || round(CAST(m AS DOUBLE) / n * 100, 1) || '%)'
    FROM (SELECT count(*) FILTER (WHERE full_name IS NULL OR full_name = '') AS m, count(*) AS n FROM tp)"""

_METADATA = " UNION ALL ".join(
    f"SELECT '{table}' AS table_id, count(*) AS row_count, "
    f"CAST(max({newest}) AS TIMESTAMP) AS last_modified, {TABLES[table].min_rows} AS expected_min "
    f"FROM {_ALIAS[table]}"
    for table, newest in {
        "dim_players": "dob",
        "dim_tournaments": "last_seen_date",
        "fact_matches": "tourney_date",
        "fact_match_stats": "tourney_date",
        "fact_rankings": "ranking_date",
    }.items()
)

_HEALTH = f"""
    SELECT table_id, row_count, round(row_count * 1000 / (1024.0 * 1024.0), 2) AS size_mb, last_modified,
      date_sub('minute', last_modified, now_at) AS minutes_since_update,
      CASE WHEN date_sub('hour', last_modified, now_at) > 24 THEN 'STALE' ELSE 'FRESH' END AS freshness_status,
      CASE WHEN row_count = 0 THEN 'EMPTY' WHEN row_count < expected_min THEN 'LOW' ELSE 'OK' END AS row_count_status,
      CAST(expected_min AS INT) AS expected_min
    FROM (SELECT *, TIMESTAMP '2024-01-30 23:59:59' AS now_at FROM ({_METADATA}))"""

_POSTLOAD = f"""
    SELECT 'minimum_rows' AS check_name, table_id AS table_name,
      CASE WHEN row_count >= expected_min THEN 'PASS' ELSE 'FAIL' END AS status,
      row_count || ' rows (expected >= ' || expected_min || ')' AS detail FROM ({_METADATA})
    UNION ALL
    SELECT 'null_foreign_keys', 'fact_matches', CASE WHEN null_winners + null_losers > 0 THEN 'FAIL' ELSE 'PASS' END,
      'winner_id nulls=' || null_winners || ', loser_id nulls=' || null_losers || ', rows=' || total_rows FROM ({_ORPHANS})
    UNION ALL
    SELECT 'role_balance', 'fact_match_stats',
      CASE WHEN winner_count = 0 OR loser_count = 0 OR ratio < 0.95 THEN 'FAIL' ELSE 'PASS' END,
      CASE WHEN winner_count = 0 OR loser_count = 0 THEN 'missing roles' WHEN ratio < 0.95 THEN 'imbalance'
           WHEN ratio < 0.999 THEN 'roughly balanced' ELSE 'balanced' END
      || ': winners=' || winner_count || ', losers=' || loser_count FROM ({_BALANCE})
    UNION ALL
    SELECT 'orphaned_players', 'fact_matches',
      CASE WHEN orphaned_winners + orphaned_losers > 0 THEN 'FAIL' ELSE 'PASS' END,
      'winner_id orphans=' || orphaned_winners || ', loser_id orphans=' || orphaned_losers || ', rows=' || total_rows
    FROM ({_ORPHANS})
    UNION ALL
    SELECT 'freshness', table_id,
      CASE WHEN last_modified >= TIMESTAMP '2024-01-29 23:30:00' THEN 'PASS' ELSE 'FAIL' END,
      'last modified ' || date_sub('second', last_modified, TIMESTAMP '2024-01-30 01:30:00') || ' s ago' FROM ({_METADATA})"""

_LOADS = """
    SELECT table_name, loaded_at, count(*) AS rows_loaded FROM (
      SELECT 'dim_players' AS table_name, TIMESTAMP '2025-02-01 02:00:00' AS loaded_at FROM tp
      UNION ALL SELECT 'dim_tournaments', CAST(date_trunc('year', last_seen_date) AS TIMESTAMP) FROM dt
      UNION ALL SELECT 'fact_matches', CAST(date_trunc('month', tourney_date) AS TIMESTAMP) FROM tm
      UNION ALL SELECT 'fact_match_stats', CAST(date_trunc('month', tourney_date) AS TIMESTAMP) FROM ts
      UNION ALL SELECT 'fact_rankings', CAST(date_trunc('week', ranking_date) AS TIMESTAMP) FROM tr)
    GROUP BY table_name, loaded_at"""

_HISTORY_ATTRIBUTES = {
    "tourney_name": ("distinct_names", "name_values"),
    "surface": ("distinct_surfaces", "surface_values"),
    "tourney_level": ("distinct_levels", "level_values"),
    "draw_size": ("distinct_draw_sizes", "draw_size_values"),
}


def _tournament_audit() -> str:
    columns = ", ".join(
        f"CAST(count(DISTINCT {a}) AS INT) AS {n}, "
        f"coalesce(string_agg(DISTINCT CAST({a} AS VARCHAR), '|' ORDER BY CAST({a} AS VARCHAR)), '') AS {v}"
        for a, (n, v) in _HISTORY_ATTRIBUTES.items()
    )
    counts = ", ".join(n for n, _ in _HISTORY_ATTRIBUTES.values())
    return (
        f"SELECT * FROM (SELECT tourney_id, count(*) AS total_matches, {columns} FROM cm GROUP BY tourney_id) "
        f"WHERE greatest({counts}) > 1"
    )


def _null_profile() -> str:
    parts = [
        f"SELECT '{c}' AS column_name, count(*) - count({_q(c)}) AS missing_count, "
        f"round(CAST(count(*) - count({_q(c)}) AS DOUBLE) / count(*) * 100, 2) AS missing_pct FROM cm"
        for c in MATCHES_CSV.fieldNames()
    ]
    return f"SELECT * FROM ({' UNION ALL '.join(parts)}) WHERE missing_count > 0"


def _describe_numeric() -> str:
    parts = []
    for c in _MATCH_NUMBERS:
        v = f"CAST({_q(c)} AS DOUBLE)"
        quartiles = ", ".join(
            f"round(quantile_cont({v}, {q}), 6) AS {n}" for n, q in [("p25", 0.25), ("p50", 0.5), ("p75", 0.75)]
        )
        parts.append(
            f"SELECT '{c}' AS column_name, count({v}) AS count, round(avg({v}), 6) AS mean, "
            f"round(stddev_samp({v}), 6) AS std, round(min({v}), 6) AS min, {quartiles}, round(max({v}), 6) AS max FROM fx_matches"
        )
    return " UNION ALL ".join(parts)


def _histogram(columns: list[str], source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST({_q(c)} AS VARCHAR) AS value, count(*) AS n "
        f"FROM {source} WHERE {_q(c)} IS NOT NULL GROUP BY {_q(c)}"
        for c in columns
    )


# The 64 digits of a digest, in numbers that can be added up.
_LANES = ", ".join(
    f"CAST(sum(CAST('0x' || substr(d, {k}, 15) AS BIGINT)) AS VARCHAR)" for k in range(1, 65, 15)
)
_PATH = "source || '/' || CAST(doc_id AS VARCHAR)"
_MANIFESTS = f"""
    WITH old AS (SELECT {_PATH} AS path, sha256(text) AS old_sha FROM documents),
    new AS (SELECT {_PATH} || CASE WHEN doc_id % 10 = 0 THEN '-moved' ELSE '' END AS path,
              sha256(CASE WHEN doc_id % 7 = 0 THEN text || 'x' ELSE text END) AS new_sha
            FROM documents)"""

_COUNTED_TOP = ["surface", "tourney_level", "round", "tourney_name", "winner_hand", "winner_ioc", "score"]

# The files of two landings, rows with the date theirs was landed.
_FIRST, _SECOND = "DATE '2025-02-01'", "DATE '2025-02-08'"
_FX = {"players": PLAYERS_SQL.format(**_PLAIN), "matches": MATCHES_SQL.format(**_PLAIN), "rankings": RANKINGS_SQL.format(**_PLAIN)}
_AGAIN = "ranking_date LIKE '%15' AND rank % 2 = 0"
_LANDED = {
    1: {
        "fx_players": f"SELECT *, {_FIRST} AS dt FROM ({_FX['players']})",
        "fx_matches": f"SELECT *, {_FIRST} AS dt FROM ({_FX['matches']})",
        "fx_rankings": f"""WITH r AS MATERIALIZED ({_FX['rankings']})
            SELECT *, {_FIRST} AS dt FROM r UNION ALL SELECT *, {_FIRST} FROM r WHERE {_AGAIN}""",
    },
    2: {
        "fx_players": f"""WITH p AS ({_FX['players']})
            SELECT *, {_SECOND} AS dt FROM p WHERE player_id % 10 <> 3
            UNION ALL SELECT *, {_SECOND} FROM p WHERE player_id % 10 = 4""",
        "fx_matches": f"""
            WITH f AS (SELECT *, CASE WHEN tourney_date = 'n/a' THEN '1990' ELSE left(tourney_date, 4) END AS y
              FROM ({_FX['matches']}))
            SELECT * EXCLUDE (y), CASE WHEN y = '1996' THEN {_SECOND} ELSE {_FIRST} END AS dt FROM f
            WHERE y <> '1997' AND (y <> '1996' OR match_num % 2 = 0)
            UNION ALL SELECT * EXCLUDE (y), {_SECOND} FROM f WHERE y = '1999'""",
        "fx_rankings": f"""WITH r AS MATERIALIZED ({_FX['rankings']})
            SELECT *, {_FIRST} AS dt FROM r UNION ALL
            SELECT * REPLACE (CAST(CASE WHEN rank % 4 = 0 THEN points + 1 ELSE points END AS INT) AS points), {_SECOND}
            FROM r WHERE {_AGAIN}""",
    },
}


def _any_stat(prefix: str) -> str:
    return f"CASE WHEN coalesce({', '.join(_q(f'{prefix}_{s}') for s in STAT_SUFFIXES.values())}) IS NULL THEN 0 ELSE 1 END"


_LANDED_ROWS = f"""
    SELECT 'dim_players' AS table_name, dt, count(*) AS rows_loaded FROM cp GROUP BY dt
    UNION ALL SELECT 'dim_tournaments', dt, count(*) FROM (SELECT max(dt) AS dt FROM cm GROUP BY tourney_id) GROUP BY dt
    UNION ALL SELECT 'fact_matches', dt, count(*) FROM cm GROUP BY dt
    UNION ALL SELECT 'fact_match_stats', dt, {_bigint(f"sum({_any_stat('w')} + {_any_stat('l')})")} FROM cm GROUP BY dt
    UNION ALL SELECT 'fact_rankings', dt, count(*) FROM (
      SELECT max(dt) AS dt FROM (SELECT {_DATE.format(_CLEAN.format('ranking_date'))} AS ranking_date,
        TRY_CAST({_CLEAN.format('player')} AS INT) AS player_id, rank, points, dt FROM fx_rankings)
      GROUP BY ranking_date, player_id, rank, points) GROUP BY dt"""


def _landed(steps: str, body: str) -> str:
    return " UNION ALL ".join(
        f"SELECT {number} AS landing, * FROM ({_with(steps, body, **files)})" for number, files in _LANDED.items()
    )


def _load_counts() -> str:
    """Rows by load and stage; audits count the rows of the SQL of their own queries' rules."""
    whole = {"players": "fx_players", "matches": "fx_matches", "match_stats": "fx_matches", "rankings": "fx_rankings"}
    stages = {(load, "read"): f"SELECT count(*) FROM {files}" for load, files in whole.items()}
    for load, tables in {
        "players": ["dim_players"],
        "matches": ["dim_tournaments", "fact_matches"],
        "match_stats": ["fact_match_stats"],
        "rankings": ["fact_rankings"],
    }.items():
        stages |= {(load, table): f"SELECT count(*) FROM {_ALIAS[table]}" for table in tables}
        stages |= {(load, name): "SELECT 0" for name in ("malformed", "audit: malformed")}
    by_date = "SELECT ranking_date, count(*) AS n, max(rank) AS top FROM dr GROUP BY ranking_date"
    stages |= {
        ("match_stats", "unpivoted"): "SELECT count(*) FROM us",
        ("match_stats", "empty stats dropped"): "SELECT (SELECT count(*) FROM us) - count(*) FROM ts",
        ("match_stats", "audit: stat_ranges"): f"SELECT count(*) FROM ({_stat_checks()})",
        ("matches", "audit: inconsistent_tournaments"): f"SELECT count(*) FROM ({_tournament_audit()})",
        ("rankings", "rejected"): "SELECT 0",
        ("rankings", "audit: rejected"): "SELECT 0",
        ("rankings", "copies dropped"): "SELECT (SELECT count(*) FROM fx_rankings) - count(*) FROM dr",
        ("rankings", "audit: duplicates"): """SELECT count(*) FROM
            (SELECT 1 FROM dr GROUP BY ranking_date, player_id HAVING count(*) > 1)""",
        ("rankings", "audit: gappy_snapshots"): f"SELECT count(*) FROM ({by_date}) WHERE CAST(top AS DOUBLE) / n > 1.5",
        ("rankings", "audit: point_inversions"): """SELECT count(*) FROM (SELECT 1 FROM dr GROUP BY ranking_date
            HAVING max(points) FILTER (WHERE rank = 1) < max(points) FILTER (WHERE rank = 2))""",
        ("rankings", "audit: invalid_ranks"): "SELECT count(*) FROM tr WHERE rank <= 0",
    }
    return " UNION ALL ".join(
        f"SELECT TIMESTAMP '2025-02-01 02:00:00' AS loaded_at, '{load}' AS load, '{stage}' AS stage, "
        f"{_bigint(f'({sql})')} AS n"
        for (load, stage), sql in stages.items()
    )


ORACLE = {
    "scan_players": _with(
        "fx_players",
        f"SELECT * REPLACE ({_replaced(_PLAYER_TEXT, _BLANK)}), 'atp_players.csv' AS source_file FROM fx_players",
    ),
    "scan_matches": _with(
        "fx_matches", f"SELECT * REPLACE ({_replaced(_MATCH_TEXT, _BLANK)}) FROM fx_matches"
    ),
    "scan_rankings": _with("fx_rankings", "SELECT * FROM fx_rankings"),
    "scan_quarantine": _with(
        "fx_players",
        """SELECT player_id, CASE WHEN player_id % 9 <> 0 THEN height END AS height,
             CASE WHEN player_id % 9 = 0 AND height IS NOT NULL THEN
               player_id || ',' || coalesce(name_first, '') || ',' || coalesce(name_last, '') || ',' ||
               coalesce(hand, '') || ',' || coalesce(dob, '') || ',' || coalesce(ioc, '') || ',' ||
               height || '.0,' || wikidata_id END AS malformed_text
           FROM fx_players""",
    ),
    "sink_roundtrip": _with("tm", "SELECT * FROM tm"),
    "sink_lookups": _with(
        "tm",
        """SELECT l.column_name, l.value, count(match_num) AS row_count,
             CAST(sum(match_num) AS BIGINT) AS match_nums
           FROM (VALUES ('winner_id', '8'), ('winner_id', '41'), ('loser_id', '15'), ('loser_id', '60'),
               ('tourney_date', '1995-06-15'), ('tourney_date', '1997-02-10'),
               ('tourney_id', '1996-0012'), ('tourney_id', '1997-0033')) l(column_name, value)
             LEFT JOIN tm ON l.value = CASE l.column_name WHEN 'winner_id' THEN CAST(winner_id AS VARCHAR)
               WHEN 'loser_id' THEN CAST(loser_id AS VARCHAR)
               WHEN 'tourney_date' THEN CAST(tourney_date AS VARCHAR) ELSE tourney_id END
           GROUP BY l.column_name, l.value""",
    ),
    "table_status": _with(
        "tp tr ts",
        """SELECT 'dim_players' AS table_name, 'ok' AS status, count(*) AS row_count FROM tp
           UNION ALL SELECT 'fact_rankings', 'ok', count(*) FROM tr
           UNION ALL SELECT 'scratch_stats', 'unmanaged', count(*) FROM ts
           UNION ALL SELECT unnest(['dim_tournaments', 'fact_matches', 'fact_match_stats']), 'not found', NULL""",
    ),
    "stage_metrics": _with(
        "fx_rankings dr tr",
        """SELECT 'read' AS stage, count(*) AS row_count FROM fx_rankings
           UNION ALL SELECT 'deduplicated', count(*) FROM dr UNION ALL SELECT 'written', count(*) FROM tr""",
    ),
    "content_fingerprint": f"""
        WITH docs AS (
          SELECT 'file=atp_matches_' || CAST(1900 + doc_id % 100 AS VARCHAR) || '.csv' AS path, doc_id,
            coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
        split AS (SELECT path, doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS i FROM docs),
        numbered AS (
          SELECT path, sha256(CAST(row_number() OVER (PARTITION BY path ORDER BY doc_id, i) - 1 AS VARCHAR)
            || ':' || sha256(line)) AS d FROM split),
        summed AS (
          SELECT path, sha256(concat_ws(':', CAST(count(*) AS VARCHAR), {_LANES})) AS lines
          FROM numbered GROUP BY path),
        sized AS (SELECT path, CAST(sum(octet_length(encode(text)) + 1) AS BIGINT) AS size FROM docs GROUP BY path)
        SELECT path, sha256(CAST(size AS VARCHAR) || ':' || lines) AS sha256, size, 'matches' AS kind
        FROM summed JOIN sized USING (path)""",
    "manifest_diff": f"""{_MANIFESTS}
        SELECT path, old_sha, new_sha,
          CASE WHEN old_sha IS NULL THEN 'new' WHEN new_sha IS NULL THEN 'removed'
               WHEN old_sha <> new_sha THEN 'changed' ELSE 'unchanged' END AS status
        FROM old FULL JOIN new USING (path)""",
    "manifest_merge": f"""{_MANIFESTS}
        SELECT path, coalesce(new_sha, old_sha) AS sha256 FROM old FULL JOIN new USING (path)""",
    "bronze_latest": """
        SELECT path, dt, sha256 FROM (
          SELECT *, row_number() OVER (PARTITION BY path ORDER BY dt DESC, sha256 DESC) AS rn FROM (
            SELECT source AS path, DATE '2025-01-01' + CAST(doc_id % 28 AS INT) AS dt, sha256(text) AS sha256
            FROM documents) WHERE dt <= DATE '2025-01-20')
        WHERE rn = 1""",
    "land_changed": _with(
        "fx_players fx_matches fx_rankings",
        """, files AS (
             SELECT 'players/file=atp_players.csv' AS path, count(*) AS n, 0 AS even FROM fx_players
             UNION ALL SELECT 'matches/file=atp_matches_' || CASE WHEN tourney_date = 'n/a' THEN '1990'
               ELSE left(tourney_date, 4) END || '.csv' AS file, count(*), count(*) FILTER (WHERE match_num % 2 = 0)
               FROM fx_matches GROUP BY file
             UNION ALL SELECT 'rankings/file=atp_rankings_' || substr(ranking_date, 3, 1) || '0s.csv' AS file, count(*), 0
               FROM fx_rankings GROUP BY file),
           second AS (
             SELECT path, CASE WHEN path LIKE '%_1996.csv' OR path LIKE '%_1997.csv' THEN DATE '2025-02-08'
                 ELSE DATE '2025-02-01' END AS dt,
               CASE WHEN path LIKE '%_1996.csv' THEN even WHEN path LIKE '%_1997.csv' THEN 0 ELSE n END AS row_count FROM files
             UNION ALL SELECT 'matches/file=atp_matches_2030.csv', DATE '2025-02-08', n FROM files WHERE path LIKE '%_1999.csv')
           SELECT 1 AS landing, path, DATE '2025-02-01' AS dt, n AS row_count, count(*) OVER () AS changed_files,
             CAST(0 AS BIGINT) AS removed_files FROM files
           UNION ALL SELECT 2, path, dt, row_count, CAST(3 AS BIGINT), CAST(1 AS BIGINT) FROM second""",
    ),
    "quarantine_reasons": _with(
        "fx_players",
        """, p AS (SELECT player_id AS id, player_id % 50 = 0 AS named, player_id % 77 = 0 AS cut,
               player_id % 91 = 0 AND player_id % 77 <> 0 AS longer,
               CASE WHEN player_id % 7 = 0 AND player_id % 77 <> 0 THEN height END AS height FROM fx_players)
           SELECT id, field, value, reason, CASE WHEN NOT (named OR cut OR longer) THEN height END AS repaired_height
           FROM (
             SELECT *, 'player_id' AS field, 'p' || id AS value, 'not int' AS reason FROM p WHERE named
             UNION ALL SELECT *, 'height', height || '.0', 'not int' FROM p WHERE height IS NOT NULL
             UNION ALL SELECT *, NULL, NULL, CASE WHEN cut THEN '5' ELSE '9' END || ' fields of 8' FROM p WHERE cut OR longer)""",
    ),
    "load_counts": _with("fx_players tp fx_matches cm dt tm us ts fx_rankings dr tr", _load_counts()),
    "landed_quality": _landed("ts tm tp tr", _QUALITY),
    "landed_history": _landed("cp cm fx_rankings", _LANDED_ROWS),
    "content_changes": """
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents WHERE doc_id IS NOT NULL),
        log AS (
          SELECT 1 AS n, doc_id, DATE '2025-03-01' AS dt, t FROM d
          UNION ALL SELECT 2, doc_id, DATE '2025-03-08', CASE WHEN doc_id % 6 = 0 THEN t || '+' ELSE t END
            FROM d WHERE doc_id % 2 = 0
          UNION ALL SELECT 3, doc_id, CASE WHEN doc_id % 3 = 0 THEN DATE '2025-03-05' ELSE DATE '2025-02-20' END, t || '-'
            FROM d WHERE doc_id % 5 = 0
          UNION ALL SELECT 4, doc_id, DATE '2025-03-15', t FROM d WHERE doc_id % 3 = 0),
        timely AS (
          SELECT * FROM (SELECT *, max(dt) OVER (PARTITION BY doc_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING
            AND 1 PRECEDING) AS known FROM log) WHERE known IS NULL OR dt >= known),
        steps AS (
          SELECT 'documents/' || doc_id AS path, dt, CAST(n AS VARCHAR) AS landing, sha256(t) AS sha256,
            lag(sha256(t)) OVER (PARTITION BY doc_id ORDER BY n) AS old_sha256 FROM timely)
        SELECT path, dt, landing, sha256, old_sha256, CASE WHEN old_sha256 IS NULL THEN 'new' ELSE 'changed' END AS status
        FROM steps WHERE old_sha256 IS DISTINCT FROM sha256""",
    "clean_strings": _with("cp", "SELECT * FROM cp"),
    "audit_columns": _with(
        "tp",
        """SELECT *, 'atp_players.csv' AS source_file, TIMESTAMP '2025-02-01 02:00:00' AS loaded_at,
             TIMESTAMP '2025-02-01 02:00:00' AS updated_at FROM tp""",
    ),
    "parse_dates": _with(
        "fx_matches",
        f"SELECT match_num, tourney_date, {_DATE.format('tourney_date')} AS parsed_date FROM fx_matches",
    ),
    "transform_players": _with("tp", "SELECT * FROM tp"),
    "transform_matches": _with("tm", "SELECT * FROM tm"),
    "dim_tournaments": _with("dt", "SELECT * FROM dt"),
    "unpivot_stats": _with("us", "SELECT * FROM us"),
    "match_stats": _with("ts", "SELECT * FROM ts"),
    "dedup_rankings": _with("dr", "SELECT * FROM dr"),
    "transform_rankings": _with("tr", "SELECT * FROM tr"),
    "audit_tournaments": _with("cm", _tournament_audit()),
    "audit_rank_dupes": _with(
        "dr",
        "SELECT ranking_date, player_id, count(*) AS occurrences FROM dr GROUP BY ALL HAVING count(*) > 1",
    ),
    "audit_rank_gaps": _with(
        "dr",
        """SELECT * FROM (SELECT ranking_date, count(*) AS player_count, max(rank) AS max_rank,
             min(rank) AS min_rank, CAST(max(rank) AS DOUBLE) / count(*) AS gap_ratio
           FROM dr GROUP BY ranking_date) WHERE gap_ratio > 1.5""",
    ),
    "audit_point_inversions": _with(
        "dr",
        """SELECT * FROM (SELECT ranking_date, max(points) FILTER (WHERE rank = 1) AS rank1_points,
             max(points) FILTER (WHERE rank = 2) AS rank2_points FROM dr GROUP BY ranking_date)
           WHERE rank1_points < rank2_points""",
    ),
    "audit_invalid_ranks": _with("tr", "SELECT * FROM tr WHERE rank <= 0"),
    "audit_stat_ranges": _with("ts", _stat_checks()),
    "orphan_players": _with("tm tp", _ORPHANS),
    "orphan_match_ids": _with(
        "tm tp",
        """SELECT player_id FROM (SELECT winner_id AS player_id FROM tm UNION SELECT loser_id FROM tm)
           WHERE player_id IS NOT NULL AND player_id NOT IN (SELECT player_id FROM tp)""",
    ),
    "orphan_ranking_ids": _with(
        "dr tp", "SELECT player_id FROM dr WHERE player_id IS NOT NULL EXCEPT SELECT player_id FROM tp"
    ),
    "orphan_stats": _with(
        "ts tm",
        """SELECT tourney_id, match_num, tourney_date, count(*) AS stat_rows FROM ts
           WHERE NOT EXISTS (SELECT 1 FROM tm WHERE tm.tourney_id = ts.tourney_id
             AND tm.match_num = ts.match_num AND tm.tourney_date = ts.tourney_date)
           GROUP BY ALL""",
    ),
    "orphan_tournaments": _with(
        "tm ts dt",
        f"""SELECT table_name, count(DISTINCT tourney_id) AS referenced_ids,
              count(DISTINCT tourney_id) FILTER (WHERE tourney_id NOT IN (SELECT tourney_id FROM dt)) AS orphaned_ids,
              count(*) FILTER (WHERE tourney_id NOT IN (SELECT tourney_id FROM dt)) AS orphaned_rows,
              count(*) AS total_rows
            FROM (SELECT 'fact_matches' AS table_name, tourney_id FROM tm
                  UNION ALL SELECT 'fact_match_stats', tourney_id FROM ts)
            GROUP BY table_name""",
    ),
    "null_fks": _with(
        "tm",
        """SELECT count(*) - count(winner_id) AS null_winners, count(*) - count(loser_id) AS null_losers,
             count(*) AS total_rows FROM tm""",
    ),
    "required_columns": _with("tp dt tm ts tr", _required()),
    "player_matches": _with(
        "tm tp dt",
        """SELECT m.tourney_date, m.tourney_id, t.tourney_name, m.surface, m.match_round, m.winner_id,
             w.full_name AS winner_name, w.country_code AS winner_country, m.winner_rank, m.loser_id,
             l.full_name AS loser_name, l.country_code AS loser_country, m.loser_rank, m.score,
             m.match_minutes, m.best_of
           FROM tm m LEFT JOIN tp w ON m.winner_id = w.player_id LEFT JOIN tp l ON m.loser_id = l.player_id
           LEFT JOIN dt t ON m.tourney_id = t.tourney_id""",
    ),
    "role_balance": _with(
        "ts",
        f"""SELECT winner_count, loser_count, ratio,
              CASE WHEN winner_count = 0 OR loser_count = 0 THEN 'FAIL' WHEN ratio < 0.9 THEN 'WARN'
                   ELSE 'PASS' END AS view_status,
              CASE WHEN winner_count = 0 OR loser_count = 0 THEN 'missing roles'
                   WHEN ratio < 0.95 THEN 'imbalance' WHEN ratio < 0.999 THEN 'roughly balanced'
                   ELSE 'balanced' END AS postload_status
            FROM ({_BALANCE})""",
    ),
    "quality_summary": _with("ts tm tp tr", _QUALITY),
    "pipeline_health": _with("tp dt tm ts tr", _HEALTH),
    "load_history": _with("tp dt tm ts tr", _LOADS),
    "postload_validation": _with("tp dt tm ts tr", _POSTLOAD),
    "null_profile": _with("cm", _null_profile()),
    "describe_numeric": _with("fx_matches", _describe_numeric()),
    "describe_categorical": _with(
        "ctext cm",
        f"""SELECT column_name, CAST(sum(n) AS BIGINT) AS count, count(*) AS "unique",
              arg_min(value, place) AS top, max(n) AS freq
            FROM (SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY n DESC, value) AS place
                  FROM ({_histogram([c for c in _MATCH_TEXT if c != 'tourney_date'], 'cm')}))
            GROUP BY column_name""",
    ),
    "value_counts": _with(
        "cm",
        f"""SELECT column_name, value, n
            FROM (SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY n DESC, value) AS place
                  FROM ({_histogram(_COUNTED_TOP, 'cm')}))
            WHERE place <= 10""",
    ),
    "key_uniqueness": _with(
        "fx_players",
        """SELECT count(*) AS total, count(DISTINCT player_id) AS unique_keys,
             count(*) - count(DISTINCT player_id) AS duplicates,
             count(*) = count(DISTINCT player_id) AS is_unique FROM fx_players""",
    ),
    "grain_check": _with(
        "fx_rankings",
        """SELECT total, unique_combinations, total = unique_combinations AS is_grain
           FROM (SELECT count(*) AS total FROM fx_rankings),
             (SELECT count(*) AS unique_combinations FROM (SELECT DISTINCT ranking_date, player FROM fx_rankings
                WHERE ranking_date IS NOT NULL AND player IS NOT NULL))""",
    ),
    "date_coverage": _with(
        "cr",
        """SELECT min(ranking_date) AS first_date, max(ranking_date) AS last_date,
             CAST(max(ranking_date) - min(ranking_date) AS INT) AS span_days,
             count(DISTINCT ranking_date) AS distinct_dates,
             CAST(count(*) AS DOUBLE) / count(DISTINCT ranking_date) AS avg_rows_per_date FROM cr""",
    ),
    "participation": _with(
        "cm",
        """SELECT player_name, count(*) AS matches
           FROM (SELECT winner_name AS player_name FROM cm UNION ALL SELECT loser_name FROM cm)
           WHERE player_name IS NOT NULL GROUP BY player_name""",
    ),
    "duplicate_rows": _with(
        "dr",
        """SELECT ranking_date, player_id, rank, points
           FROM (SELECT *, count(*) OVER (PARTITION BY ranking_date, player_id) AS n FROM dr) WHERE n > 1""",
    ),
    "score_tokens": _with(
        "cm",
        """SELECT token, count(*) AS matches
           FROM (SELECT translate(score, '0123456789-() ', '') AS token FROM cm)
           WHERE token IS NOT NULL AND token <> '' GROUP BY token""",
    ),
    "hand_distribution": _with(
        "tp",
        """SELECT r AS right_handed, l AS left_handed, CAST(r AS DOUBLE) / nullif(l, 0) AS right_left_ratio
           FROM (SELECT count(*) FILTER (WHERE hand = 'R') AS r, count(*) FILTER (WHERE hand = 'L') AS l FROM tp)""",
    ),
    "head_to_head": _with(
        "cm", "SELECT * FROM cm WHERE winner_id = 8 AND loser_id = 15 AND tourney_name = 'Tourney 8'"
    ),
    "issue_summary": _with(
        "cp cm",
        """SELECT table_name, issue, issue_rows, round(CAST(issue_rows AS DOUBLE) / total * 100, 1) AS share_pct FROM (
             SELECT 'players' AS table_name, 'duplicate player_id' AS issue,
               count(*) - count(DISTINCT player_id) AS issue_rows, count(*) AS total FROM cp
             UNION ALL SELECT 'players', 'missing player_id', count(*) - count(player_id), count(*) FROM cp
             UNION ALL SELECT 'players', 'missing name_first', count(*) - count(name_first), count(*) FROM cp
             UNION ALL SELECT 'players', 'missing name_last', count(*) - count(name_last), count(*) FROM cp
             UNION ALL SELECT 'matches', 'missing score', count(*) - count(score), count(*) FROM cm)
           WHERE issue_rows > 0""",
    ),
}
