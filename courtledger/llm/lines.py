"""Removal of repeated passages of several lines, cut into chunks by their content.

A text is cut after every line at which a rolling hash over that line and the one before is
a multiple of ``DIVISOR``. The cuts depend on two lines only, so a passage is cut alike
wherever it stands. Chunks of two lines or more that occur more than once in the table are
removed but for their first occurrence.

Only hashes meet at first. Texts of chunks move when their hash occurs twice, and are then
grouped by their bytes: a chunk is removed because it equals another, not because its hash
does. DataFrame expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtledger.llm.common import fresh, row_id, stored, text_hash

DIVISOR = 4
#: Of the line before, in the rolling hash.
WEIGHT = 31

_CHUNK = "array_join(slice(lines, {start} + 1, {end} - {start} + 1), '\\n')"
_START = "CASE WHEN {k} = 0 THEN 0 ELSE ends[{k} - 1] + 1 END"


def _chunk(k: str) -> str:
    return _CHUNK.format(start=f"({_START.format(k=k)})", end=f"ends[{k}]")


def _chunked(rows: DataFrame) -> DataFrame:
    """Adds ``lines`` and ``ends``, the last line of each chunk."""
    return (
        rows.withColumn("lines", F.split("text", "\n"))
        .withColumn(
            "line_hashes",
            F.expr("transform(lines, l -> cast(conv(substring(md5(l), 1, 7), 16, 10) AS bigint))"),
        )
        .withColumn(
            "ends",
            F.expr(
                "filter(sequence(0, size(lines) - 1), i -> i = size(lines) - 1 OR "
                f"(line_hashes[i] + {WEIGHT} * CASE WHEN i = 0 THEN 0 ELSE line_hashes[i - 1] END)"
                f" % {DIVISOR} = 0)"
            ),
        )
        .drop("line_hashes")
    )


def _first() -> Column:
    return F.min(F.struct("rid", "rth", "no")).alias("first")


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(
        row_id(docs).alias("rid"), text_hash(docs).alias("rth"), F.coalesce(docs["text"], F.lit("")).alias("text")
    )


def repeated_chunks(docs: DataFrame) -> DataFrame:
    """``rid, rth, removed``: rows that lose chunks, and the numbers of these chunks.

    The first occurrence is the one with the smallest id, then text hash, then place. Rows
    that repeat id and text are one row here. Null texts have one empty line.
    """
    rows = _rows(docs)
    hashed = F.expr(
        "transform(sequence(0, size(ends) - 1), k -> named_struct('no', k, "
        f"'n', ends[k] - ({_START.format(k='k')}) + 1, 'hash', xxhash64({_chunk('k')})))"
    )
    chunks = (
        _chunked(rows).select("rid", "rth", F.inline(hashed)).filter("n > 1").drop("n").distinct()
    )
    chunks = stored(chunks, "chunks")
    several = (
        chunks.groupBy("hash").agg(F.count("*").alias("times")).filter("times > 1").select("hash")
    )
    candidates = stored(chunks.join(several, "hash"), "candidates")

    wanted = candidates.groupBy("rid", "rth").agg(F.collect_list(F.struct("no", "hash")).alias("wanted"))
    found = F.expr(
        f"transform(wanted, w -> named_struct('no', w.no, 'hash', w.hash, 'chunk', {_chunk('w.no')}))"
    )
    # Lists of rows grow with the table, so they are merged with it at every size.
    texts = _chunked(rows.join(wanted.hint("merge"), ["rid", "rth"])).select("rid", "rth", F.inline(found))
    texts = stored(texts, "chunk-texts")
    equal = stored(
        texts.groupBy("hash", "chunk").agg(F.count("*").alias("times"), _first()), "equal-chunks"
    )
    kinds = equal.groupBy("hash").agg(F.count("*").alias("kinds"), F.min("first").alias("first"))
    later = F.struct("rid", "rth", "no") != F.col("first")
    by_hash = candidates.join(kinds.filter("kinds = 1"), "hash").filter(later)
    # Different chunks of one hash: each is held against its own bytes.
    clashing = kinds.filter("kinds > 1").select("hash")
    by_bytes = (
        texts.join(clashing, "hash").join(equal.filter("times > 1"), ["hash", "chunk"]).filter(later)
    )
    columns = ["rid", "rth", "no"]
    return (
        by_hash.select(columns)
        .unionByName(by_bytes.select(columns))
        .groupBy("rid", "rth")
        .agg(F.collect_set("no").alias("removed"))
    )


def drop_repeated_lines(docs: DataFrame, counts: bool = False) -> DataFrame:
    """The documents without repeated chunks, with all their columns.

    A text of which nothing is left is empty; a null text stays null. With ``counts`` the
    columns ``n_lines`` and ``n_removed`` are added, which replace columns so named.
    """
    names = {c: fresh(docs, f"_{c}") for c in ("rid", "rth", "removed", "left")}
    marked = docs.withColumns({names["rid"]: row_id(docs), names["rth"]: text_hash(docs)})
    removed = repeated_chunks(docs)
    removed = removed.select(*(F.col(c).alias(names[c]) for c in removed.columns))
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("whole")
    joined = marked.join(removed.hint("merge"), [names["rid"], names["rth"]], "left").select(
        whole, F.coalesce("text", F.lit("")).alias("text"), F.col(names["removed"]).alias("removed")
    )
    some = F.col("removed").isNotNull()
    cut = _chunked(joined)
    kept = F.expr(
        f"array_join(transform(array_except(sequence(0, size(ends) - 1), removed), k -> {_chunk('k')}), '\\n')"
    )
    gone = F.expr(f"aggregate(removed, 0L, (n, k) -> n + ends[k] - ({_START.format(k='k')}) + 1)")
    columns = [
        (F.when(some, kept).otherwise(F.col("whole.text")).alias(c) if c == "text" else F.col(f"whole.`{c}`"))
        for c in docs.columns
    ]
    if counts:
        columns = [x for x, c in zip(columns, docs.columns) if c not in ("n_lines", "n_removed")]
        columns += [
            F.size("lines").cast("bigint").alias("n_lines"),
            F.coalesce(F.when(some, gone), F.lit(0).cast("bigint")).alias("n_removed"),
        ]
    return cut.select(*columns)


ORACLE = f"""
WITH docs AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
),
numbered AS (
  SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS i, len(lines) AS n FROM docs
),
hashed AS (
  SELECT *, CAST('0x' || substr(md5(line), 1, 7) AS BIGINT) AS h FROM numbered
),
cuts AS (
  SELECT *, CASE WHEN (h + {WEIGHT} * coalesce(lag(h) OVER (PARTITION BY doc_id ORDER BY i), 0)) % {DIVISOR} = 0
    THEN 1 ELSE 0 END AS last FROM hashed
),
placed AS (
  SELECT *, coalesce(sum(last) OVER (
    PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS no
  FROM cuts
),
chunks AS (
  SELECT doc_id, no, n, count(*) AS size, string_agg(line, chr(10) ORDER BY i) AS chunk
  FROM placed GROUP BY doc_id, no, n
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY chunk, size > 1 ORDER BY doc_id, no) AS seen FROM chunks
),
marked AS (SELECT *, size > 1 AND seen > 1 AS gone FROM ranked)
SELECT doc_id, n AS n_lines,
  CAST(coalesce(sum(size) FILTER (WHERE gone), 0) AS BIGINT) AS n_removed,
  coalesce(string_agg(chunk, chr(10) ORDER BY no) FILTER (WHERE NOT gone), '') AS text
FROM marked GROUP BY doc_id, n
"""
