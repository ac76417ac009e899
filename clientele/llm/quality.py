"""Quality rules whose limits come from quantile sketches of each language and source.

Base counts come from the whole text. Four measures of a document, as integers in thousandths,
go into a mergeable sketch of its group: values are rounded down to seven significant bits, as in
HDR histograms, and counted per rounded value. Sketches of groups merge by adding counts, so the
sketch of a language is the sum over its sources. A quantile is exact up to 1/64 of its value.
Word length has limits on both sides: the median and ``spread`` times the distance from there to
the quartile beyond it, plus a slack. The other measures are zero in most texts of most groups, so
their quartiles say nothing; their limit is the median and ``TAIL_SPREAD`` times the distance from
there to a high percentile (``TAILS``), plus a slack below which a value is never odd. So a source
in which one text in ten has symbols, or one in twenty repeated lines or words, sets the limit
itself, and fewer odd texts do not move it. A group of fewer than ``least`` documents takes the limits of its
language, and a language of fewer those of all documents. Documents that fail the base rules
take no part in the sketches.

Main path: DataFrame functions only.

Nulls and ties: a null text has no words and fails the base rules; null languages and sources
are groups of their own. Repeated rows count as often as they come. Windows are told apart by a
64-bit hash of their words. Other columns are not read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from clientele.llm.common import GAP, documents, store

WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED = 30
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\f\r"
#: Spread of the quartile distance that a measure may have around its median.
SPREAD = 6
#: The same for measures that are mostly zero, whose distance goes to a percentile of TAILS.
TAIL_SPREAD = 3
#: Documents of a group that has limits of its own.
LEAST_ROWS = 50
#: Measures in thousandths with the slack of their lower and upper limit; None: no limit there.
MEASURES = {
    "word_length": (1000, 2000),
    "symbols": (None, 100),
    "dup_lines": (None, 300),
    "repeats": (None, 100),
}
#: The percentile that the limit of a mostly zero measure is taken from.
TAILS = {"symbols": 90, "dup_lines": 95, "repeats": 95}


QUANTILES = {"q1": 25, "q2": 50, "q3": 75, **{f"p{p}": p for p in sorted(set(TAILS.values()))}}


def _words(text: Column) -> Column:
    inner = F.btrim(text, F.lit(SPACES))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, GAP))


def _without(text: Column, signs: str) -> Column:
    return F.translate(text, signs, "")


def base_counts(df: DataFrame, id_col: str, text_col: str, lang_col: str, source_col: str):
    """doc_id, lang, source and the counts of the whole text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    split = df.select(
        F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang"),
        F.col(source_col).alias("source"),
        F.length(_without(text, SPACES)).cast("bigint").alias("word_chars"),
        (F.length(text) - F.length(_without(text, SYMBOLS))).cast("bigint").alias("n_symbols"),
        F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
        _words(text).alias("words"),
    )
    n = F.size("words")
    places = F.when(n >= WINDOW, F.sequence(F.lit(1), n - (WINDOW - 1))).otherwise(
        F.array().cast("array<int>")
    )
    hashed = split.select(
        "doc_id", "lang", "source", "word_chars", "n_symbols",
        n.cast("bigint").alias("n_words"),
        F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.transform(places, lambda i: F.xxhash64(F.slice("words", i, WINDOW))).alias("windows"),
    )
    # Only texts with a window that comes again are sorted.
    again = F.size("windows") > F.size(F.array_distinct("windows"))
    numbered = F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    ordered = hashed.withColumn(
        "ordered", F.when(again, F.array_sort(numbered))
    ).drop("windows")

    def same(x: Column, at: Column) -> Column:
        return F.coalesce(F.get("ordered", at)["h"] == x["h"], F.lit(False))

    found = F.filter("ordered", lambda x, at: same(x, at - 1) | same(x, at + 1))
    places = ordered.withColumn(
        "places", F.array_sort(F.transform(found, lambda x: x["i"]))
    ).drop("ordered")
    covered = F.aggregate(
        "places",
        F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda seen, p: F.struct(
            (p + WINDOW).alias("end"),
            (seen["n"] + p + WINDOW - F.greatest(seen["end"], p)).alias("n"),
        ),
        lambda seen: seen["n"],
    )
    return places.withColumn(
        "n_repeat_words", F.coalesce(covered, F.lit(0)).cast("bigint")
    ).drop("places").withColumn(
        "base_failed",
        (F.col("n_words") < LEAST_WORDS)
        | (F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED),
    )


def _measures() -> dict[str, Column]:
    def per(part: str, whole: str) -> Column:
        return F.expr(f"CASE WHEN {whole} > 0 THEN ({part} * 1000) div {whole} ELSE 0 END")

    return {
        "word_length": per("word_chars", "n_words"), "symbols": per("n_symbols", "n_words"),
        "dup_lines": per("n_dup_lines", "n_lines"), "repeats": per("n_repeat_words", "n_words"),
    }


def _rounded(value: Column) -> Column:
    """The value with its seven leading bits kept."""
    bits = F.greatest(F.length(F.bin(value)) - 7, F.lit(0))
    step = F.call_function("shiftleft", F.lit(1).cast("bigint"), bits)
    return value - value % step


def _limits(sketch: DataFrame, keys: list[str], spread: int, least: int) -> DataFrame:
    """Limits of each group of ``keys`` that has documents enough, from counts of values."""
    merged = sketch.groupBy(*keys, "measure", "value").agg(F.sum("n").alias("n"))
    group = [*keys, "measure"]
    below = Window.partitionBy(*group).orderBy("value")
    placed = merged.withColumn("upto", F.sum("n").over(below)).withColumn(
        "all", F.sum("n").over(Window.partitionBy(*group))
    ).where(F.col("all") >= least)

    def quantile(percent: int) -> Column:
        return F.min(F.when(F.col("upto") * 100 >= F.col("all") * percent, F.col("value")))

    quarters = placed.groupBy(*group).agg(
        *[quantile(p).alias(q) for q, p in QUANTILES.items()]
    )
    low = F.col("q2") - spread * (F.col("q2") - F.col("q1"))
    columns = []
    for name, (down, up) in MEASURES.items():
        own = F.col("measure") == name
        if down is not None:
            columns.append(F.max(F.when(own, low - down)).alias(f"least_{name}"))
            high = F.col("q2") + spread * (F.col("q3") - F.col("q2"))
        else:
            high = F.col("q2") + TAIL_SPREAD * (F.col(f"p{TAILS[name]}") - F.col("q2"))
        columns.append(F.max(F.when(own, high + up)).alias(f"most_{name}"))
    if keys:
        return quarters.groupBy(*keys).agg(*columns)
    return quarters.agg(*columns)


def adaptive_limits(counts: DataFrame, spread: int = SPREAD, least: int = LEAST_ROWS):
    """One row per language and source: the limits that its documents must keep."""
    values = counts.where(~F.col("base_failed")).select(
        "lang", "source",
        F.explode(F.array(*[
            F.struct(F.lit(name).alias("measure"), _rounded(m).alias("value"))
            for name, m in _measures().items()
        ])).alias("m"),
    )
    sketch = store(
        values.groupBy("lang", "source", F.col("m.measure").alias("measure"),
                       F.col("m.value").alias("value")).agg(F.count("*").alias("n")),
        "sketch",
    )
    groups = counts.select("lang", "source").distinct()
    names = [f"{side}_{m}" for m, (down, _) in MEASURES.items()
             for side in (("least", "most") if down is not None else ("most",))]
    found = groups
    for level, keys in enumerate((["lang", "source"], ["lang"], [])):
        limits = _limits(sketch, keys, spread, least if keys else 0)
        limits = limits.select(
            *[F.col(k).alias(f"{k}_{level}") for k in keys],
            *[F.col(c).alias(f"{c}_{level}") for c in names],
        )
        if keys:
            same = [F.col(k).eqNullSafe(F.col(f"{k}_{level}")) for k in keys]
            found = found.join(limits, same, "left")
        else:
            found = found.crossJoin(F.broadcast(limits))
    return found.select(
        "lang", "source",
        *[F.coalesce(*[F.col(f"{c}_{level}") for level in range(3)]).alias(c) for c in names],
    )


def quality_rules(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    source_col: str = "source", spread: int = SPREAD, least: int = LEAST_ROWS,
) -> DataFrame:
    """One row per document with its counts, base_failed, and kept: whether it meets all limits."""
    counts = store(base_counts(df, id_col, text_col, lang_col, source_col), "counts")
    limits = store(adaptive_limits(counts, spread, least), "limits")
    limits = limits.withColumnsRenamed({"lang": "of_lang", "source": "of_source"})
    rows = counts.join(
        limits, F.col("lang").eqNullSafe(F.col("of_lang"))
        & F.col("source").eqNullSafe(F.col("of_source")), "left",
    )
    kept = ~F.col("base_failed")
    for name, value in _measures().items():
        if MEASURES[name][0] is not None:
            kept &= value >= F.col(f"least_{name}")
        kept &= value <= F.col(f"most_{name}")
    return rows.select(*counts.columns, F.coalesce(kept, F.lit(False)).alias("kept"))


def op7_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules(documents(spark, folder)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


def _sql_limits(name: str, keys: str, least: int) -> str:
    by = f"{keys}, " if keys else ""
    columns = []
    for measure, (down, up) in MEASURES.items():
        own = f"CASE WHEN measure = '{measure}' THEN"
        if down is not None:
            columns.append(f"max({own} q2 - {SPREAD} * (q2 - q1) - {down} END) AS least_{measure}")
            high = f"{SPREAD} * (q3 - q2)"
        else:
            high = f"{TAIL_SPREAD} * (p{TAILS[measure]} - q2)"
        columns.append(f"max({own} q2 + {high} + {up} END) AS most_{measure}")
    quarters = ", ".join(
        f"min(CASE WHEN upto * 100 >= total * {p} THEN value END) AS {q}"
        for q, p in QUANTILES.items()
    )
    return f"""
{name} AS (
  SELECT {by}{", ".join(columns)} FROM (
    SELECT {by}measure, {quarters} FROM (
      SELECT {by}measure, value, sum(n) OVER (PARTITION BY {by}measure ORDER BY value) AS upto,
             sum(n) OVER (PARTITION BY {by}measure) AS total
      FROM (SELECT {by}measure, value, sum(n) AS n FROM sketch GROUP BY {by}measure, value))
    WHERE total >= {least} GROUP BY {by}measure)
  {f"GROUP BY {keys}" if keys else ""})"""


def _sql_kept() -> str:
    tests = []
    for measure, (down, _) in MEASURES.items():
        limit = f"coalesce(a.{{}}_{measure}, b.{{}}_{measure}, c.{{}}_{measure})"
        if down is not None:
            tests.append(f"{measure} >= {limit.replace('{}', 'least')}")
        tests.append(f"{measure} <= {limit.replace('{}', 'most')}")
    return " AND ".join(tests)


SQL = rf"""
WITH texts AS (
  SELECT row_number() OVER () AS row, doc_id, lang, source, coalesce(text, '') AS t FROM documents),
split AS (
  SELECT row, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM texts),
windows AS (
  SELECT row, i, array_to_string(words[i:i + {WINDOW - 1}], ' ') AS w
  FROM (SELECT row, words, unnest(generate_series(1, len(words) - {WINDOW - 1})) AS i FROM split)),
again AS (
  SELECT row, i FROM (SELECT row, i, count(*) OVER (PARTITION BY row, w) AS n FROM windows)
  WHERE n > 1),
repeats AS (
  SELECT row, sum(least({WINDOW}, coalesce(next - i, {WINDOW}))) AS n
  FROM (SELECT row, i, lead(i) OVER (PARTITION BY row ORDER BY i) AS next FROM again) GROUP BY row),
counts AS (
  SELECT t.row, doc_id, lang, source, len(words) AS n_words,
         coalesce(list_sum(list_transform(words, lambda w: length(w))), 0)::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         coalesce(r.n, 0)::BIGINT AS n_repeat_words
  FROM texts t JOIN split s USING (row) LEFT JOIN repeats r ON r.row = t.row),
judged AS (
  SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed,
         CASE WHEN n_words > 0 THEN word_chars * 1000 // n_words ELSE 0 END AS word_length,
         CASE WHEN n_words > 0 THEN n_symbols * 1000 // n_words ELSE 0 END AS symbols,
         CASE WHEN n_lines > 0 THEN n_dup_lines * 1000 // n_lines ELSE 0 END AS dup_lines,
         CASE WHEN n_words > 0 THEN n_repeat_words * 1000 // n_words ELSE 0 END AS repeats
  FROM counts),
sketch AS (
  SELECT lang, source, measure,
         value - value % (1::BIGINT << greatest(length(bin(value)) - 7, 0)::INTEGER) AS value,
         count(*) AS n
  FROM (UNPIVOT (SELECT lang, source, word_length::BIGINT AS word_length, symbols::BIGINT AS symbols,
                        dup_lines::BIGINT AS dup_lines, repeats::BIGINT AS repeats
                 FROM judged WHERE NOT base_failed)
        ON {", ".join(MEASURES)} INTO NAME measure VALUE value)
  GROUP BY 1, 2, 3, 4),
{_sql_limits("own", "lang, source", LEAST_ROWS)},
{_sql_limits("of_lang", "lang", LEAST_ROWS)},
{_sql_limits("of_all", "", 0)}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       coalesce(NOT base_failed AND {_sql_kept()}, false) AS kept
FROM judged j
LEFT JOIN own a ON j.lang IS NOT DISTINCT FROM a.lang AND j.source IS NOT DISTINCT FROM a.source
LEFT JOIN of_lang b ON j.lang IS NOT DISTINCT FROM b.lang
CROSS JOIN of_all c
"""
