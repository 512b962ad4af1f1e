"""Quality rules as one native projection (operator 5).

Everything is a Spark expression: no Python runs on the executors.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.common import SEPARATORS, pack, table

SYMBOLS = "[#*$%&|<>]"
#: Frequent function words of the languages served; sentence-initial capitals are not counted.
STOP_WORDS = {
    "en": ("the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "as", "was", "with", "be", "by", "on"),
    "de": ("der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "ist", "im", "eine"),
    "fr": ("de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans"),
    "es": ("de", "la", "que", "el", "en", "y", "a", "los", "se", "del", "las", "un", "por", "con", "no", "una"),
}


@dataclass(frozen=True)
class Threshold:
    """A document fails unless ``least`` <= ``ratio`` <= ``most``; a bound may be absent."""

    name: str
    ratio: str
    least: float | None = None
    most: float | None = None


#: Ratios are SQL over the measured columns; an undefined ratio (0 / 0) passes.
THRESHOLDS = (
    Threshold("mean_word_length", "word_chars / n_words", 2.0, 15.0),
    Threshold("symbol_ratio", "n_symbols / n_words", most=0.1),
    Threshold("stop_word_ratio", "n_stop_words / n_words", least=0.02),
    Threshold("duplicate_line_ratio", "n_dup_lines / n_lines", most=0.5),
    Threshold("bullet_line_ratio", "n_bullet_lines / n_lines", most=0.9),
    Threshold("ellipsis_line_ratio", "n_ellipsis_lines / n_lines", most=0.3),
)


def measure(docs: DataFrame, window: int = 8) -> DataFrame:
    """``docs`` with its measures; every one is a long, and 0 for null text.

    Columns: n_words, word_chars, n_symbols, n_stop_words,
    n_lines and n_dup_lines (lines with a word; those equal to an earlier one),
    n_bullet_lines, n_ellipsis_lines, n_repeat_words. The last counts the words
    inside any run of ``window`` words that the text holds twice or more. Runs
    are compared by 64-bit hashes within one text. Only texts that have equal
    hashes pay for finding where: their runs are sorted by hash, those equal to
    a neighbour are put in order of place, and each covers the words up to the
    next one, ``window`` at most. Input columns of these names are replaced.
    """
    bare, unpack = pack(docs, "text")
    separators = F.lit(SEPARATORS)
    words = F.when(F.btrim("text", separators) == "", F.array().cast("array<string>")).otherwise(
        F.split(F.btrim("text", separators), r"[\x20\x09-\x0D]+")
    )
    lines = F.filter(F.split("text", "\n"), lambda x: F.btrim(x, separators) != "")
    none = F.array().cast("array<bigint>")
    runs = F.when(
        F.size("_words") >= window,
        F.transform(
            F.sequence(F.lit(1), F.size("_words") - (window - 1)), lambda i: F.xxhash64(F.slice("_words", i, window))
        ),
    ).otherwise(none)
    split = bare.select(
        *bare.columns,
        F.coalesce(words, F.array().cast("array<string>")).alias("_words"),
        F.coalesce(lines, F.array().cast("array<string>")).alias("_lines"),
    ).select("*", runs.alias("_runs"))
    repeated = F.size(F.array_distinct("_runs")) < F.size("_runs")
    ordered = split.select(
        "*",
        F.when(
            repeated,
            F.array_sort(F.transform("_runs", lambda h, i: F.struct(h.alias("h"), i.cast("long").alias("i")))),
        ).alias("_ordered"),
    )
    equal = lambda x, k: F.get("_ordered", k)["h"].eqNullSafe(x["h"])
    places = ordered.select(
        "*",
        F.when(
            F.col("_ordered").isNotNull(),
            F.sort_array(
                F.transform(
                    F.filter("_ordered", lambda x, k: equal(x, k - 1) | equal(x, k + 1)), lambda x: x["i"]
                )
            ),
        ).alias("_places"),
    )
    covered = F.aggregate(
        F.transform(
            "_places",
            lambda p, k: F.least(F.lit(window).cast("long"), F.coalesce(F.get("_places", k + 1) - p, F.lit(window))),
        ),
        F.lit(0).cast("long"),
        lambda total, x: total + x,
    )
    counts = {
        "n_words": F.size("_words"),
        "word_chars": F.length(F.array_join("_words", "")),
        "n_symbols": F.coalesce(F.regexp_count("text", F.lit(SYMBOLS)), F.lit(0)),
        "n_stop_words": F.size(F.filter("_words", lambda w: w.isin(*_stop_words()))),
        "n_lines": F.size("_lines"),
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "n_bullet_lines": F.size(F.filter("_lines", lambda x: x.rlike(r"^\s*[-*•]"))),
        "n_ellipsis_lines": F.size(F.filter("_lines", lambda x: x.rlike(r"(\.\.\.|…)\s*$"))),
        "n_repeat_words": F.coalesce(covered, F.lit(0)),
    }
    return unpack(places.select(*bare.columns, *[c.cast("long").alias(n) for n, c in counts.items()]), *MEASURES)


MEASURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_stop_words",
    "n_lines",
    "n_dup_lines",
    "n_bullet_lines",
    "n_ellipsis_lines",
    "n_repeat_words",
)


def _stop_words() -> list[str]:
    return sorted(set().union(*STOP_WORDS.values()))


def compiled(thresholds: tuple[Threshold, ...]) -> Column:
    """The table as one condition, true for what passes every row of it."""

    def passes(row: Threshold) -> Column:
        bounds = [F.lit(True)]
        if row.least is not None:
            bounds.append(F.expr(f"({_safe(row.ratio)}) >= {row.least}"))
        if row.most is not None:
            bounds.append(F.expr(f"({_safe(row.ratio)}) <= {row.most}"))
        return F.coalesce(reduce(Column.__and__, bounds), F.lit(True))

    return reduce(Column.__and__, map(passes, thresholds), F.lit(True))


def _safe(ratio: str) -> str:
    """Division by zero gives null, in ANSI mode too."""
    top, slash, bottom = ratio.partition(" / ")
    return f"{top} / nullif({bottom}, 0)" if slash else ratio


def judge(docs: DataFrame, thresholds: tuple[Threshold, ...] = THRESHOLDS, least_words: int = 20) -> DataFrame:
    """``docs`` with measures, base_failed and kept.

    base_failed: fewer than ``least_words`` words, or over 30 % of the words in
    repeated runs. kept: not base_failed, and within all ``thresholds``. Null,
    empty and blank texts have no words and fail. Rows are judged one by one:
    repeated rows get equal verdicts, no order matters, an empty table stays
    empty, and a text of any length is read whole.
    """
    measured = measure(docs.drop("base_failed", "kept"))
    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return measured.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & compiled(thresholds)
    )


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return judge(docs).select("doc_id", *MEASURES, "base_failed", "kept")


OP5_SQL = r"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents
),
runs AS (
  SELECT r, k, array_to_string(w[k : k + 7], ' ') AS run
  FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS k FROM doc WHERE len(w) >= 8)
),
again AS (SELECT r, k FROM (SELECT r, k, count(*) OVER (PARTITION BY r, run) AS n FROM runs) WHERE n > 1),
covered AS (
  SELECT r, count(DISTINCT pos) AS n FROM (SELECT r, unnest(range(k, k + 8)) AS pos FROM again) GROUP BY r
),
measured AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
    CAST(len(list_filter(w, lambda x: x IN (
      'the', 'of', 'and', 'to', 'in', 'a', 'is', 'that', 'for', 'it', 'as', 'was', 'with', 'be', 'by', 'on',
      'der', 'die', 'und', 'den', 'von', 'zu', 'das', 'mit', 'sich', 'des', 'auf', 'ist', 'im', 'eine',
      'de', 'la', 'le', 'et', 'les', 'en', 'un', 'du', 'une', 'que', 'est', 'pour', 'qui', 'dans',
      'el', 'y', 'los', 'se', 'del', 'las', 'por', 'con', 'no', 'una'))) AS BIGINT) AS n_stop_words,
    CAST(len(l) AS BIGINT) AS n_lines, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
    CAST(len(list_filter(l, lambda x: regexp_matches(x, '^\s*[-*•]'))) AS BIGINT) AS n_bullet_lines,
    CAST(len(list_filter(l, lambda x: regexp_matches(x, '(\.\.\.|…)\s*$'))) AS BIGINT) AS n_ellipsis_lines,
    CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words
  FROM doc LEFT JOIN covered USING (r)
)
SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  n_words >= 20 AND 100 * n_repeat_words <= 30 * n_words
    AND coalesce(word_chars / nullif(n_words, 0) BETWEEN 2.0 AND 15.0, true)
    AND coalesce(n_symbols / nullif(n_words, 0) <= 0.1, true)
    AND coalesce(n_stop_words / nullif(n_words, 0) >= 0.02, true)
    AND coalesce(n_dup_lines / nullif(n_lines, 0) <= 0.5, true)
    AND coalesce(n_bullet_lines / nullif(n_lines, 0) <= 0.9, true)
    AND coalesce(n_ellipsis_lines / nullif(n_lines, 0) <= 0.3, true) AS kept
FROM measured
"""
