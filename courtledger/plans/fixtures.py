"""Sports-shaped inputs derived from the general test tables.

The test tables hold no matches or rankings, so the raw files of the pipeline are
expressed over them, with the blanks, bad dates, copies and unknown ids that the
operators have to deal with. Players and matches are the same portable SQL in Spark and
in the checking engine. Rankings differ in form: Spark numbers the events of a day
without sending a busy day to one task, and makes the copies in one pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtledger.operators.numbering import number_rows

PLAYERS_SQL = """
SELECT CAST(c_custkey AS INT) AS player_id,
 CASE WHEN c_custkey % 17 = 0 THEN NULL WHEN c_custkey % 19 = 0 THEN '   ' ELSE '  First' || CAST(c_custkey AS STRING) || ' ' END AS name_first,
 CASE WHEN c_custkey % 34 = 0 THEN NULL ELSE c_name END AS name_last,
 CASE c_custkey % 7 WHEN 0 THEN 'r' WHEN 1 THEN 'L' WHEN 2 THEN 'a' WHEN 3 THEN 'U' WHEN 4 THEN 'X' WHEN 5 THEN NULL ELSE 'R' END AS hand,
 CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 13 = 0 THEN 'unknown'
  ELSE CAST(1960 + c_custkey % 45 AS STRING) || LPAD(CAST(1 + c_custkey % 12 AS STRING), 2, '0') || LPAD(CAST(1 + c_custkey % 28 AS STRING), 2, '0') || CASE WHEN c_custkey % 2 = 0 THEN '.0' ELSE '' END END AS dob,
 n_name AS ioc,
 CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE CAST(160 + c_custkey % 50 AS INT) END AS height,
 'Q' || CAST(c_custkey AS STRING) AS wikidata_id
FROM {customer} LEFT JOIN {nation} ON c_nationkey = n_nationkey
"""

MATCHES_SQL = """
WITH li AS (
 SELECT l_orderkey,
  SUM(CASE WHEN l_returnflag='A' THEN 1 ELSE 0 END) AS a, SUM(CASE WHEN l_returnflag='R' THEN 1 ELSE 0 END) AS r,
  SUM(CASE WHEN l_linestatus='F' THEN 1 ELSE 0 END) AS f, COUNT(*) AS n, CAST(SUM(l_quantity) AS BIGINT) AS q
 FROM {lineitem} GROUP BY l_orderkey),
b AS (SELECT o_orderkey AS k, o_custkey AS c, o_custkey % 40 AS t, o_orderdate AS d, o_orderstatus AS s, o_orderpriority AS p, o_totalprice AS v, a, r, f, n, q
 FROM {orders} LEFT JOIN li ON o_orderkey = l_orderkey)
SELECT CASE WHEN k % 1500 < 2 THEN '2002-T' || CAST(k - k % 1500 AS STRING) ELSE CAST(year(d) AS STRING) || '-' || LPAD(CAST(t AS STRING), 4, '0') END AS tourney_id,
 ' Tourney ' || CAST(t AS STRING) || CASE WHEN t % 4 = 0 AND k % 50 = 0 THEN ' (alt)' ELSE '' END AS tourney_name,
 CASE WHEN t % 5 = 1 AND k % 37 = 0 THEN 'Carpet' WHEN t % 5 = 2 AND k % 41 = 0 THEN '  ' WHEN t = 39 AND k % 2 = 0 THEN 'Indoor' WHEN t % 3 = 0 THEN 'Hard' WHEN t % 3 = 1 THEN 'Clay' ELSE 'Grass' END AS surface,
 CAST(CASE WHEN t % 2 = 0 THEN 32 ELSE 64 END AS INT) AS draw_size,
 CASE WHEN t % 4 = 0 THEN 'G' WHEN t % 4 = 1 THEN 'M' ELSE 'A' END AS tourney_level,
 CASE WHEN k % 211 = 0 THEN 'n/a' ELSE CAST(year(d) AS STRING) || LPAD(CAST(month(d) AS STRING), 2, '0') || LPAD(CAST(day(d) AS STRING), 2, '0') END AS tourney_date,
 CAST(k AS INT) AS match_num,
 CASE WHEN k % 997 = 0 THEN NULL ELSE CAST(c AS INT) END AS winner_id,
 CASE WHEN k % 499 = 0 THEN CAST(1000000 + k AS INT) ELSE CAST((c + 1 + k % 100) % (SELECT COUNT(*) FROM {customer}) AS INT) END AS loser_id,
 CASE WHEN k % 8 = 1 THEN CAST(1 + k % 32 AS INT) END AS loser_seed,
 CASE p WHEN '3-MEDIUM' THEN 'LL' ELSE NULL END AS loser_entry,
 ' Player ' || CAST(c + 1 AS STRING) AS loser_name,
 CASE k % 4 WHEN 0 THEN 'L' WHEN 1 THEN 'U' ELSE 'R' END AS loser_hand,
 CASE WHEN k % 6 = 0 THEN NULL ELSE CAST(165 + k % 40 AS INT) END AS loser_ht,
 'NATION_' || CAST(k % 25 AS STRING) AS loser_ioc,
 CAST(17 + (k % 220) / 10.0 AS FLOAT) AS loser_age,
 CASE WHEN k % 12 = 0 THEN NULL ELSE CAST(1 + c % 500 AS INT) END AS winner_rank,
 CASE WHEN k % 12 = 0 THEN NULL ELSE CAST(10000 - (c % 500) * 19 AS INT) END AS winner_rank_points,
 CASE WHEN k % 14 = 0 THEN NULL ELSE CAST(1 + k % 700 AS INT) END AS loser_rank,
 CASE WHEN k % 14 = 0 THEN NULL ELSE CAST(9000 - (k % 700) * 12 AS INT) END AS loser_rank_points,
 CASE WHEN k % 8 = 0 THEN CAST(1 + k % 32 AS INT) END AS winner_seed,
 CASE p WHEN '1-URGENT' THEN 'WC' WHEN '2-HIGH' THEN 'Q' ELSE '' END AS winner_entry,
 'Player ' || CAST(c AS STRING) AS winner_name,
 CASE c % 7 WHEN 1 THEN 'L' WHEN 2 THEN 'A' WHEN 3 THEN 'U' ELSE 'R' END AS winner_hand,
 CASE WHEN c % 3 = 0 THEN NULL ELSE CAST(160 + c % 50 AS INT) END AS winner_ht,
 'NATION_' || CAST(c % 25 AS STRING) AS winner_ioc,
 CAST(18 + (c % 200) / 10.0 AS FLOAT) AS winner_age,
 CASE WHEN k % 23 = 0 THEN NULL WHEN k % 29 = 0 THEN '6-3 RET' WHEN k % 31 = 0 THEN 'W/O' WHEN k % 43 = 0 THEN '6-4 2-1 DEF' ELSE '6-4 7-6(' || CAST(k % 8 AS STRING) || ')' END AS score,
 CAST(CASE WHEN t % 4 = 0 THEN 5 ELSE 3 END AS INT) AS best_of,
 CASE s WHEN 'F' THEN 'f' WHEN 'O' THEN 'r16' ELSE 'QF' END AS round,
 CASE WHEN k % 10 = 0 THEN NULL ELSE CAST(60 + k % 200 AS INT) END AS minutes,
 CAST(a AS INT) AS w_ace, CAST(CASE WHEN k % 503 = 0 THEN -1 ELSE r END AS INT) AS w_df, CAST(q AS INT) AS w_svpt,
 CAST(CASE WHEN k % 301 = 0 THEN q + 5 ELSE q - n END AS INT) AS w_1stIn, CAST(q - n - f AS INT) AS w_1stWon,
 CAST(n AS INT) AS w_2ndWon, CAST(f AS INT) AS w_SvGms, CAST(r AS INT) AS w_bpSaved, CAST(r + k % 3 - CASE WHEN k % 401 = 0 THEN 3 ELSE 0 END AS INT) AS w_bpFaced,
 CAST(r AS INT) AS l_ace, CASE WHEN k % 2 = 0 THEN CAST(f AS INT) END AS l_df, CASE WHEN k % 5 = 0 THEN NULL ELSE CAST(q AS INT) END AS l_svpt,
 CAST(q - 1 AS INT) AS l_1stIn, CAST(q - 1 + CASE WHEN k % 307 = 0 THEN 2 ELSE 0 END AS INT) AS l_1stWon, CAST(a AS INT) AS l_2ndWon, CAST(n AS INT) AS l_SvGms, CAST(a AS INT) AS l_bpSaved, CAST(a + 1 AS INT) AS l_bpFaced
FROM b
"""

RANKINGS_SQL = """
WITH e AS (SELECT event_id, user_id, ts, CAST(ts AS DATE) AS d, CAST(ROUND(value * 100) AS INT) AS pts, row_number() OVER (PARTITION BY CAST(ts AS DATE) ORDER BY value DESC, event_id) AS rk FROM {events}),
x AS (SELECT CAST(year(d) AS STRING) || LPAD(CAST(month(d) AS STRING), 2, '0') || LPAD(CAST(day(d) AS STRING), 2, '0') AS ranking_date,
 CAST(CASE WHEN event_id % 701 = 0 THEN 0 ELSE rk END AS INT) AS rank,
 CASE WHEN event_id % 601 = 0 THEN CAST(100000 + user_id AS STRING) ELSE ' ' || CAST(user_id AS STRING) END AS player,
 CASE WHEN rk = 1 AND day(d) % 7 = 0 THEN CAST(0 AS INT) ELSE pts END AS points, event_id
 FROM e WHERE NOT (day(d) % 6 = 0 AND rk % 2 = 0 AND rk > 2))
SELECT ranking_date, rank, player, points FROM x UNION ALL SELECT ranking_date, rank, player, points FROM x WHERE event_id % 20 = 0
UNION ALL SELECT ranking_date, rank, player, points + 1 FROM x WHERE event_id % 83 = 0
UNION ALL SELECT ranking_date, rank, player || '  ', points FROM x WHERE event_id % 90 = 0
"""


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _from_sql(spark: SparkSession, sf_dir: str, sql: str, tables: list[str]) -> DataFrame:
    return spark.sql(sql, **{name: read_table(spark, sf_dir, name) for name in tables})


def raw_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _from_sql(spark, sf_dir, PLAYERS_SQL, ["customer", "nation"])


def raw_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _from_sql(spark, sf_dir, MATCHES_SQL, ["customer", "orders", "lineitem"])


def raw_rankings(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read_table(spark, sf_dir, "events").select(
        "event_id", "user_id", "value", F.to_date("ts").alias("day")
    )
    numbered = number_rows(
        events,
        keys=["day"],
        order=[F.desc("value"), F.col("event_id")],
        name="place",
    )
    event, place, user = F.col("event_id"), F.col("place"), F.col("user_id").cast("string")
    zeroed = (place == 1) & (F.dayofmonth("day") % 7 == 0)
    kept = numbered.filter(
        ~((F.dayofmonth("day") % 6 == 0) & (place % 2 == 0) & (place > 2))
    ).select(
        "event_id",
        F.date_format("day", "yyyyMMdd").alias("ranking_date"),
        F.when(event % 701 == 0, 0).otherwise(place).cast("int").alias("rank"),
        F.when(event % 601 == 0, (F.col("user_id") + 100000).cast("string"))
        .otherwise(F.concat(F.lit(" "), user))
        .alias("player"),
        F.when(zeroed, 0).otherwise(F.round(F.col("value") * 100).cast("int")).alias("points"),
    )

    def copy(made, player, points):
        return F.struct(
            made.alias("made"), player.alias("player"), points.alias("points")
        )

    player, points = F.col("player"), F.col("points")
    copies = F.array(
        copy(F.lit(True), player, points),
        copy(event % 20 == 0, player, points),
        copy(event % 83 == 0, player, points + 1),
        copy(event % 90 == 0, F.concat(player, F.lit("  ")), points),
    )
    return (
        kept.select("ranking_date", "rank", F.inline(copies))
        .filter("made")
        .select("ranking_date", "rank", "player", "points")
    )
