"""Quality rules whose thresholds follow the documents of a language and source.

A fixed cutoff that suits prose throws away a source of code or of tables, and one that
suits both throws away nothing. So each language and source has thresholds of its own:
every document is measured, the measures of a group are summed up in quantile sketches, and
a document fails where a measure lies far outside of what its group is like.

A sketch is a histogram whose buckets grow with the value, at most 1/64 of it wide, so any
quantile of it is that near. Sketches are merged by adding counts: the result does not
depend on the order of rows or on which task had them, a group that holds a third of all
rows is added up in the tasks first, and the sketch of a language, which stands in for a
source with few documents, is the sum of those of its sources. All numbers are integers,
and all of it is built-in functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cabtally.llm.common import BLANKS, WORD, free_name, stored, table

#: Documents that a group has to have for thresholds of its own.
LEAST_DOCUMENTS = 50
#: Values below it have buckets of their own; above, buckets keep that many steps a power of 2.
STEPS = 128
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: How many times the spread of a group a measure may lie beyond its median.
SPREADS = 4
#: Measures, and how far beyond the median they may lie at least: up, and down if at all.
#: All are in thousandths: code points per word, the others for each word.
MEASURES = {
    "word_length": (2000, 2000),
    "symbols": (100, None),
    "dup_lines": (100, None),
    "repeats": (300, None),
}

FENCES = [f"{m}_{side}" for m in MEASURES for side in ("low", "high")]
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _windows(words: Column) -> Column:
    """The windows of three words with the places where they start, sorted, of a text that
    may have equal ones: equal hashes are rare otherwise, and no hash tells equality here."""
    n = F.size(words)
    starts = F.when(n > 3, F.sequence(F.lit(0), n - 3))
    hashes = F.transform(starts, lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
    triples = F.arrays_zip(
        F.slice(words, 1, n - 2).alias("a"), F.slice(words, 2, n - 2).alias("b"), F.slice(words, 3, n - 2).alias("c")
    )
    windows = F.sort_array(F.arrays_zip(triples.alias("triple"), F.sequence(F.lit(0), n - 3).alias("at")))
    return F.when(F.size(F.array_distinct(hashes)) < n - 2, windows)


def _repeated(windows: Column) -> Column:
    """How many words are in windows that are found twice or more: equal ones are neighbours."""
    beside = F.arrays_zip(windows.alias("x"), F.slice(windows, 2, F.size(windows)).alias("y"))
    same = F.filter(beside, lambda p: p.x.triple == p.y.triple)
    covered = F.flatten(
        F.transform(same, lambda p: F.array(*[w.at + k for w in (p.x, p.y) for k in range(3)]))
    )
    return F.coalesce(F.size(F.array_distinct(covered)), F.lit(0))


def measured(documents: DataFrame, prefix: str = "") -> DataFrame:
    """``documents`` with the counts ``n_words``, ``word_chars`` (code points in words),
    ``n_symbols``, ``n_dup_lines`` (lines with a word that equal an earlier line) and
    ``n_repeat_words`` of the column ``text``, each named with ``prefix``. A null text has no words."""
    words, lines, windows = (free_name(documents, name) for name in ("words", "lines", "windows"))
    text = F.coalesce("text", F.lit(""))
    bare = F.btrim(text, F.lit(BLANKS))
    blank = WORD.replace("^", "")
    # Columns that are used several times stand in a projection of their own, where Spark
    # works them out once.
    rows = documents.withColumns(
        {
            words: F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, blank)),
            lines: F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(BLANKS)) != ""),
        }
    ).withColumn(windows, _windows(F.col(words)))
    counts = (
        F.size(words),
        F.length(F.array_join(words, "")),
        F.length(text) - F.length(F.regexp_replace(text, r"[#*$%&|<>]+", "")),
        F.size(lines) - F.size(F.array_distinct(lines)),
        _repeated(F.col(windows)),
    )
    rows = rows.withColumns({prefix + name: n.cast("long") for name, n in zip(COUNTS, counts, strict=True)})
    return rows.drop(words, lines, windows)


def base_failed(prefix: str = "") -> Column:
    n, repeated = F.col(f"{prefix}n_words"), F.col(f"{prefix}n_repeat_words")
    return (n < MIN_WORDS) | (100 * repeated > MAX_REPEAT_PERCENT * n)


def _measure(name: str, prefix: str = "") -> Column:
    """A measure of a document in thousandths; null if it has no words."""
    of = {"word_length": "word_chars", "symbols": "n_symbols", "dup_lines": "n_dup_lines", "repeats": "n_repeat_words"}
    return F.floor(F.try_divide(1000 * F.col(prefix + of[name]), F.col(f"{prefix}n_words")))


def bucket(value: Column) -> Column:
    """The least value of the bucket that ``value``, which is not negative, falls into."""
    bits = F.greatest(F.length(F.bin(value)) - (STEPS.bit_length() - 1), F.lit(0))
    width = F.call_function("shiftleft", F.lit(1).cast("long"), bits)
    return value - value % width


def sketches(rows: DataFrame, prefix: str = "") -> DataFrame:
    """``(lang, source, measure, low, n)``: for each group and measure, how many of the
    measured ``rows`` that pass the base rules fall into which bucket."""
    values = F.explode(
        F.array(*[F.struct(F.lit(m).alias("measure"), bucket(_measure(m, prefix)).alias("low")) for m in MEASURES])
    )
    passed = rows.where(~base_failed(prefix))
    return (
        passed.select("lang", "source", values.alias("v"))
        .groupBy("lang", "source", "v.measure", "v.low")
        .agg(F.count("*").alias("n"))
    )


def merged(parts: DataFrame, *keys: str) -> DataFrame:
    """The sketches of ``parts`` added up by ``keys``."""
    return parts.groupBy(*keys, "measure", "low").agg(F.sum("n").alias("n"))


def quantiles(sketch: DataFrame, *keys: str) -> DataFrame:
    """``(keys, measure, documents, q10, q50, q90)`` of each sketch."""
    order = F.struct("low", "n")
    found = sketch.groupBy(*keys, "measure").agg(
        F.sum("n").alias("documents"), F.sort_array(F.collect_list(order)).alias("buckets")
    )

    def at(percent: int) -> Column:
        step = F.aggregate(
            "buckets",
            F.struct(F.lit(0).cast("long").alias("n"), F.lit(None).cast("long").alias("low")),
            lambda s, b: F.struct(
                (s.n + b.n).alias("n"),
                F.coalesce(s.low, F.when((s.n + b.n) * 100 >= F.col("documents") * percent, b.low)).alias("low"),
            ),
            lambda s: s.low,
        )
        return step.alias(f"q{percent}")

    return found.select(*keys, "measure", "documents", at(10), at(50), at(90))


def _fences(found: DataFrame, *keys: str) -> DataFrame:
    """One row for each group: ``documents`` and, as ``fences``, the least and the greatest
    passing value of each measure. What lies above the median tells how far values may lie
    below it, and the other way round: so up to half of a group may be bad on one side."""
    columns = []
    for name, (up, down) in MEASURES.items():
        high = F.col("q50") + F.greatest(SPREADS * (F.col("q50") - F.col("q10")), F.lit(up))
        low = F.lit(None).cast("long")
        if down is not None:
            low = F.col("q50") - F.greatest(SPREADS * (F.col("q90") - F.col("q50")), F.lit(down))
        own = F.col("measure") == name
        columns += [F.max(F.when(own, low)).alias(f"{name}_low"), F.max(F.when(own, high)).alias(f"{name}_high")]
    one = found.groupBy(*keys).agg(F.max("documents").alias("documents"), *columns)
    return one.select(*keys, "documents", F.struct(*FENCES).alias("fences"))


def thresholds(parts: DataFrame) -> DataFrame:
    """``(lang, source, documents, fences)`` of each group of the sketches ``parts``. A group
    of fewer than ``LEAST_DOCUMENTS`` takes its language's, and if that has as few, those of all."""
    of_group = _fences(quantiles(parts, "lang", "source"), "lang", "source")
    of_lang = _fences(quantiles(merged(parts, "lang"), "lang"), "lang")
    # The sketch of all documents is a few hundred rows; its fences are eight numbers.
    every = _fences(quantiles(merged(parts))).select("fences.*").first()
    every = F.struct(*[F.lit(None if every is None else every[n]).cast("long").alias(n) for n in FENCES])
    enough = lambda frame: F.when(F.col(f"{frame}.documents") >= LEAST_DOCUMENTS, F.col(f"{frame}.fences"))
    both = of_group.alias("g").join(of_lang.alias("l"), F.col("g.lang").eqNullSafe(F.col("l.lang")))
    return both.select("g.lang", "g.source", "g.documents", F.coalesce(enough("g"), enough("l"), every).alias("fences"))


def judged(rows: DataFrame, limits: DataFrame, prefix: str = "") -> DataFrame:
    """The measured ``rows`` with ``base_failed`` and ``kept``, named with ``prefix``. The
    join adds at most one row of ``limits``, whose number is that of the groups, to each."""
    fences, lang, source = (free_name(rows, n) for n in ("fences", "lang_of", "source_of"))
    limits = limits.select(F.col("lang").alias(lang), F.col("source").alias(source), F.col("fences").alias(fences))
    inside = F.lit(True)
    for name in MEASURES:
        value = _measure(name, prefix)
        inside = inside & F.coalesce(value <= F.col(f"{fences}.{name}_high"), F.lit(True))
        inside = inside & F.coalesce(value >= F.col(f"{fences}.{name}_low"), F.lit(True))
    same = F.col("lang").eqNullSafe(F.col(lang)) & F.col("source").eqNullSafe(F.col(source))
    return (
        rows.join(limits, same, "left")
        .withColumn(f"{prefix}base_failed", base_failed(prefix))
        .withColumn(f"{prefix}kept", ~base_failed(prefix) & inside)
        .drop(fences, lang, source)
    )


def quality(documents: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, its counts, ``base_failed`` and ``kept``.

    ``documents`` needs ``doc_id``, ``text``, ``lang`` and ``source``; other columns are not
    read. A null text counts as empty and fails the base rules, as all texts below
    ``MIN_WORDS`` words do; a null language or source is a group of its own. Repeated rows
    and null ids are documents of their own. An empty table gives an empty result. A text
    is taken as a whole, in one row, however long.
    """
    rows = stored(measured(documents.select("doc_id", "lang", "source", "text")).drop("text"), "measured")
    limits = stored(thresholds(stored(sketches(rows), "sketches")), "thresholds")
    return judged(rows, limits).select("doc_id", *COUNTS, "base_failed", "kept")


def good_documents(documents: DataFrame) -> DataFrame:
    """Those ``documents`` that are kept, all their columns. They are read and measured
    twice, as nothing but counts is written."""
    prefix = free_name(documents, "quality_")
    while any(name.startswith(prefix) for name in documents.columns):
        prefix += "_"
    rows = measured(documents, prefix)
    limits = stored(thresholds(stored(sketches(rows, prefix), "sketches")), "thresholds")
    return judged(rows, limits, prefix).where(F.col(f"{prefix}kept")).select(*[F.col(f"`{c}`") for c in documents.columns])


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source"))


def _sql() -> str:
    of = {"word_length": "word_chars", "symbols": "n_symbols", "dup_lines": "n_dup_lines", "repeats": "n_repeat_words"}
    values = " UNION ALL ".join(
        f"SELECT lang, source, '{m}' AS measure, (1000 * {of[m]}) // n_words AS v FROM b WHERE NOT base_failed" for m in MEASURES
    )
    tests = " AND ".join(
        f"coalesce((1000 * {of[m]}) // nullif(n_words, 0) <= {m}_high, true)"
        + ("" if down is None else f" AND coalesce((1000 * {of[m]}) // nullif(n_words, 0) >= {m}_low, true)")
        for m, (_, down) in MEASURES.items()
    )
    limits = ", ".join(
        f"max(q50 + greatest({SPREADS} * (q50 - q10), {up})) FILTER (measure = '{m}') AS {m}_high"
        + ("" if down is None else f", max(q50 - greatest({SPREADS} * (q90 - q50), {down})) FILTER (measure = '{m}') AS {m}_low")
        for m, (up, down) in MEASURES.items()
    )

    def quantiles_of(name: str, keys: str) -> str:
        by = f"{keys}, " if keys else ""
        percentiles = ", ".join(f"min(low) FILTER (cum * 100 >= {p} * total) AS q{p}" for p in (10, 50, 90))
        group = f"GROUP BY {keys}" if keys else ""
        return f"""
  {name} AS (SELECT {by}max(total) AS documents, {limits} FROM (
    SELECT {by}measure, max(total) AS total, {percentiles} FROM (
      SELECT {by}measure, low, sum(n) OVER (PARTITION BY {by}measure) AS total,
             sum(n) OVER (PARTITION BY {by}measure ORDER BY low) AS cum
      FROM (SELECT {by}measure, low, count(*) AS n FROM k GROUP BY {by}measure, low)) GROUP BY {by}measure) {group})"""

    names = [f"{m}_high" for m in MEASURES] + [f"{m}_low" for m, (_, down) in MEASURES.items() if down is not None]
    chosen = ", ".join(
        f"CASE WHEN g.documents >= {LEAST_DOCUMENTS} THEN g.{n} WHEN l.documents >= {LEAST_DOCUMENTS} THEN l.{n} ELSE e.{n} END AS {n}"
        for n in names
    )
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS t FROM documents),
  w AS (SELECT r, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words FROM d),
  x AS (SELECT r, i, words[i] AS a, words[i + 1] AS b, words[i + 2] AS c
        FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
  y AS (SELECT r, i FROM (SELECT *, count(*) OVER (PARTITION BY r, a, b, c) AS n FROM x) WHERE n > 1),
  z AS (SELECT r, count(DISTINCT i + j) AS n FROM y, range(3) AS s(j) GROUP BY r),
  n AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d)
        WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
  m AS (SELECT d.r, doc_id, lang, source, len(words)::BIGINT AS n_words,
               length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
               (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
               coalesce(n.n, 0)::BIGINT AS n_dup_lines, coalesce(z.n, 0)::BIGINT AS n_repeat_words
        FROM d JOIN w USING (r) LEFT JOIN n USING (r) LEFT JOIN z USING (r)),
  b AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM m),
  k AS (SELECT lang, source, measure,
               v - v % (1::BIGINT << greatest(length(bin(v)) - {STEPS.bit_length() - 1}, 0)) AS low FROM ({values})),
  {quantiles_of("g", "lang, source")}, {quantiles_of("l", "lang")}, {quantiles_of("e", "")},
  f AS (SELECT g.lang, g.source, {chosen} FROM g JOIN l ON g.lang IS NOT DISTINCT FROM l.lang CROSS JOIN e)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {tests} AS kept
FROM b LEFT JOIN f ON b.lang IS NOT DISTINCT FROM f.lang AND b.source IS NOT DISTINCT FROM f.source
"""


SQL = _sql()
