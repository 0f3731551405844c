"""Quality rules: counts of words, lines and signs, and divergence from language references.

The verdict compares two histograms of a text with the reference of its language by
Jensen-Shannon distance: classes of characters, and the language's most common words. The
references are sums over all rows of the table, one small row for each language. Short texts
have histograms too coarse to judge, so each comparison has a minimum length.

DataFrame expressions only, one row for a text throughout: no text is taken apart over tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtledger.llm.common import fresh, row_id, stored, text_hash

#: Frequent words of each language.
COMMON_WORDS = {
    "de": "der die das und zu in den von mit ist des im dem nicht ein eine als auch es an auf für sich er so wie wird war bei oder",
    "en": "the of and to in a is that it for was on as with be by at this are or from have not he you an they which his her",
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más o pero sus le ha me si",
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce il sont avec son mais ou",
}
OTHER = "other"

#: Largest distances (base 2, 0 to 1) and smallest lengths at which they count.
MAX_CHAR_DISTANCE, MIN_CHARS = 0.33, 200
MAX_WORD_DISTANCE, MIN_WORDS = 0.32, 100

WHITE = r"[ \t\n\x0B\f\r]"
#: Places of words are kept in so many bits beside hash bits, in texts with fewer words.
PLACE_BITS = 24
CLASSES = ["upper", "digit", "stop", "symbols", "white", "accent", "rest"]


def _languages(docs: DataFrame) -> Column:
    lang = docs["lang"] if "lang" in docs.columns else F.lit(None).cast("string")
    return F.when(lang.isin(*COMMON_WORDS), lang).otherwise(F.lit(OTHER))


def _without(pattern: str) -> Column:
    """How many characters of the text match."""
    return F.length("text") - F.length(F.regexp_replace("text", pattern, ""))


def _basics(docs: DataFrame) -> DataFrame:
    """Words, lines and counts of characters, as columns of each text."""
    words = sorted({w for line in COMMON_WORDS.values() for w in line.split()})
    common = ", ".join(f"'{w}'" for w in words)
    return (
        docs.withColumn("words", F.array_remove(F.split("text", WHITE + "+"), ""))
        .withColumns(
            {
                "n_words": F.size("words").cast("bigint"),
                "word_chars": F.length(F.array_join("words", "")).cast("bigint"),
                "n_symbols": _without("[#*$%&|<>]+").cast("bigint"),
                "n_upper": _without("[A-Z]+").cast("bigint"),
                "n_digit": _without("[0-9]+").cast("bigint"),
                "n_stop": _without("[.,;:!?'\"()-]+").cast("bigint"),
                "n_chars_": F.length("text").cast("bigint"),
                "n_accent": (F.octet_length("text") - F.length("text")).cast("bigint"),
                "common": F.expr(f"sort_array(transform(filter(words, w -> lower(w) IN ({common})), w -> lower(w)))"),
            }
        )
        .withColumns(
            {
                "n_white": F.col("n_chars_") - F.col("word_chars"),
                "n_rest": F.greatest(
                    F.lit(0).cast("bigint"),
                    F.col("word_chars") - F.col("n_symbols") - F.col("n_upper") - F.col("n_digit") - F.col("n_stop"),
                ),
            }
        )
    )


def references(docs: DataFrame) -> DataFrame:
    """``lang, r_<class>..., r_words, r_total``: sums over all texts of each known language,
    and over all texts as ``other`` for texts of no known language."""
    basics = _basics(_texts(docs))
    # One pass over the texts: sums of each class, named apart from words by a space, and
    # listed words one by one. At most one row for each task, language and name is exchanged.
    classes = [F.struct(F.lit(f" {c}").alias("name"), F.col(f"n_{c}").alias("n")) for c in CLASSES]
    classes.append(F.struct(F.lit(" total").alias("name"), F.col("n_words").alias("n")))
    words = F.transform("common", lambda w: F.struct(w.alias("name"), F.lit(1).cast("bigint").alias("n")))
    sums = stored(
        basics.select("lang", F.inline(F.concat(F.array(*classes), words)))
        .groupBy("lang", "name")
        .agg(F.sum("n").alias("n")),
        "references",
    )
    listed = F.col("name").startswith(" ") | (F.col("lang") == OTHER)
    for lang, line in COMMON_WORDS.items():
        listed = listed | ((F.col("lang") == lang) & F.col("name").isin(*line.split()))
    everywhere = sums.groupBy("name").agg(F.sum("n").alias("n")).withColumn("lang", F.lit(OTHER))
    rows = sums.filter(F.col("lang") != OTHER).unionByName(everywhere).filter(listed)
    is_class = F.col("name").startswith(" ")
    names = {f"r_{c}": f" {c}" for c in [*CLASSES, "total"]}
    return rows.groupBy("lang").agg(
        *[F.max(F.when(F.col("name") == name, F.col("n"))).alias(r) for r, name in names.items()],
        F.map_from_entries(F.collect_list(F.when(~is_class, F.struct("name", "n")))).alias("r_words"),
    )


def _texts(docs: DataFrame, *more: Column) -> DataFrame:
    return docs.select(
        *more, F.coalesce(docs["text"], F.lit("")).alias("text"), _languages(docs).alias("lang")
    )


def _term(p: Column, q: Column) -> Column:
    """Share of one bin in twice the divergence."""
    m = p + q
    return F.when(p > 0, p * F.log2(2 * p / m)).otherwise(0.0) + F.when(
        q > 0, q * F.log2(2 * q / m)
    ).otherwise(0.0)


def _char_distance() -> Column:
    total = sum((F.col(f"n_{c}") for c in CLASSES), F.lit(0))
    expected = sum((F.col(f"r_{c}") for c in CLASSES), F.lit(0))
    parts = [
        _term(F.try_divide(f"n_{c}", total), F.try_divide(f"r_{c}", expected)) for c in CLASSES
    ]
    return F.sqrt(F.greatest(F.lit(0.0), sum(parts, F.lit(0.0)) / 2))


# The listed words of a text stand in order; where a run of one word ends, its length is known.
# A bin that the text lacks adds its reference share, so only bins it has are visited.
_WORD_TERMS = """
aggregate(
  transform(
    filter(sequence(0, size(listed) - 1), i -> i = size(listed) - 1 OR listed[i] <> listed[i + 1]),
    i -> named_struct('end', i + 1, 'q', r_words[listed[i]] / r_total)
  ),
  named_struct('last', 0, 'sum', 0.0D, 'q', 0.0D),
  (acc, x) -> named_struct(
    'last', x.end,
    'sum', acc.sum
      + (x.end - acc.last) / n_words * log2(2 * ((x.end - acc.last) / n_words) / ((x.end - acc.last) / n_words + x.q))
      + x.q * log2(2 * x.q / ((x.end - acc.last) / n_words + x.q)) - x.q,
    'q', acc.q + x.q
  )
)
"""


def _word_distance() -> Column:
    share = F.aggregate(F.map_values("r_words"), F.lit(0).cast("bigint"), lambda a, n: a + n) / F.col("r_total")
    p = F.lit(1.0) - F.size("listed") / F.col("n_words")
    rest = _term(p, F.lit(1.0) - share)
    divergence = (F.coalesce(F.col("terms.sum"), F.lit(0.0)) + share + rest) / 2
    return F.sqrt(F.greatest(F.lit(0.0), divergence))


# Windows of three words, as hash bits and the place of the first word in one number: sorted,
# equal windows are neighbours. Words are compared wherever the bits agree.
_SAME_WORDS = """(words[{a}] = words[{b}] AND words[{a} + 1] = words[{b} + 1] AND words[{a} + 2] = words[{b} + 2])"""
_PACKED = f"""
sort_array(transform(hashes, (h, i) -> (shiftleft(h, {PLACE_BITS}) | i)))
"""
_PLACES = f"""
transform(
  filter(windows, (x, i) ->
    (i > 0 AND shiftrightunsigned(x, {PLACE_BITS}) = shiftrightunsigned(windows[i - 1], {PLACE_BITS})
      AND {_SAME_WORDS.format(a="cast(x & %d AS int)", b="cast(windows[i - 1] & %d AS int)")})
    OR (i < size(windows) - 1 AND shiftrightunsigned(x, {PLACE_BITS}) = shiftrightunsigned(windows[i + 1], {PLACE_BITS})
      AND {_SAME_WORDS.format(a="cast(x & %d AS int)", b="cast(windows[i + 1] & %d AS int)")})
  ),
  x -> cast(x & {(1 << PLACE_BITS) - 1} AS int)
)
""".replace("%d", str((1 << PLACE_BITS) - 1))
# Texts with more words than places fit beside hash bits sort whole hashes with their places.
_LONG_PLACES = f"""
transform(
  filter(long_windows, (x, i) ->
    (i > 0 AND x.h = long_windows[i - 1].h AND {_SAME_WORDS.format(a="x.i", b="long_windows[i - 1].i")})
    OR (i < size(long_windows) - 1 AND x.h = long_windows[i + 1].h
      AND {_SAME_WORDS.format(a="x.i", b="long_windows[i + 1].i")})
  ),
  x -> x.i
)
"""
# A window covers three words, or as many as there are before the next repeated window.
_COVERED = """
aggregate(places, named_struct('n', 0L, 'end', 0),
  (acc, p) -> named_struct('n', acc.n + 3 - greatest(acc.end - p, 0), 'end', p + 3)).n
"""
_MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _repeats(rows: DataFrame) -> DataFrame:
    """Adds ``n_repeat_words`` and ``n_dup_lines``."""
    long = F.col("n_words") >= (1 << PLACE_BITS)
    lines = F.expr(r"filter(split(text, '\n'), l -> l RLIKE '[^ \\t\\n\\x0B\\f\\r]')")
    return (
        rows.withColumn("lines", lines)
        .withColumn("word_hashes", F.expr("transform(words, w -> xxhash64(w))"))
        .withColumn(
            "hashes",
            F.expr(
                "CASE WHEN n_words >= 3 THEN transform(sequence(0, size(words) - 3), i -> "
                "xxhash64(word_hashes[i], word_hashes[i + 1], word_hashes[i + 2])) ELSE array() END"
            ),
        )
        .withColumn("windows", F.when(~long, F.expr(_PACKED)))
        .withColumn(
            "long_windows", F.when(long, F.expr("array_sort(transform(hashes, (h, i) -> struct(h, i)))"))
        )
        .withColumn(
            "places", F.sort_array(F.when(long, F.expr(_LONG_PLACES)).otherwise(F.expr(_PLACES)))
        )
        .withColumn("n_repeat_words", F.expr(_COVERED).cast("bigint"))
        .withColumn("n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint"))
        .drop("lines", "word_hashes", "hashes", "windows", "long_windows", "places")
    )


def measures(docs: DataFrame, *more: Column) -> DataFrame:
    """The given columns, five counts, ``base_failed``, both distances and ``kept``.

    A null or empty text has no words and fails the base rules. A text of a language without
    a reference, or of none, is held against the sum of all languages. Rows are judged one by
    one, so ties and repeated rows have equal results. A distance is null where the text is
    too short for it. Other columns of ``docs`` are not read.
    """
    names = [f"k{i}" for i in range(len(more))]
    rows = _texts(docs, *(c.alias(n) for c, n in zip(more, names)))
    # One row for each listed language and one for all others.
    reference = F.broadcast(references(docs))
    joined = _repeats(_basics(rows)).join(reference, "lang", "left")
    terms = F.when(F.size("listed") > 0, F.expr(_WORD_TERMS))
    judged = (
        joined.withColumn("listed", F.expr("filter(common, w -> map_contains_key(r_words, w))"))
        .withColumn("terms", terms)
        .withColumns(
            {
                "char_distance": F.when(F.col("n_chars_") >= MIN_CHARS, _char_distance()),
                "word_distance": F.when(F.col("n_words") >= MIN_WORDS, _word_distance()),
                "base_failed": (F.col("n_words") < 50)
                | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")),
            }
        )
    )
    strange = F.coalesce(F.col("char_distance") > MAX_CHAR_DISTANCE, F.lit(False)) | F.coalesce(
        F.col("word_distance") > MAX_WORD_DISTANCE, F.lit(False)
    )
    return judged.select(
        *names,
        *_MEASURES,
        "base_failed",
        "char_distance",
        "word_distance",
        (~F.col("base_failed") & ~strange).alias("kept"),
    )


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that pass, with all their columns.

    Verdicts are stored before they select: a filter over the chain of columns that leads to
    them would be carried down through it by the optimizer, with every use of a column.
    """
    names = [fresh(docs, "_rid"), fresh(docs, "_rth")]
    verdicts = stored(measures(docs, row_id(docs), text_hash(docs)).select("k0", "k1", "kept"), "verdicts")
    kept = verdicts.filter("kept").select(F.col("k0").alias(names[0]), F.col("k1").alias(names[1]))
    marked = docs.withColumns(dict(zip(names, (row_id(docs), text_hash(docs)))))
    return marked.join(kept.hint("merge"), names, "left_semi").drop(*names)
