"""Quality rules: one threshold table compiled to one Spark projection, without user functions.

Words are runs of ``[^\x20\x09-\x0D]``.  A rule names a measure and the closed range it must lie
in; the table is compiled to one array of failing rule names, so adding a rule adds an expression,
not a pass.  Everything is computed inside a row: no shuffle, no limit on the length of a text.

Repeated windows are found by sorting the 64-bit hashes of a text's windows, n log n in its words,
and only in texts where two windows are equal at all.  Two different windows of one text of n words
share a hash with probability n*n/2**65.

Defined cases: null and empty texts have no words, so they fail the base rule of 20 words; ratios
of texts without words or lines are 0; equal texts get equal verdicts and every row stays; input
columns named like an output column are replaced, others are passed through.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import quoted, read_table, settled, without

_SPACE = r"[ \t\n\x0B\f\r]+"
_SYMBOLS = r"[#*$%&|<>]"
WINDOW = 8

#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in a is that it was for on with as be at by from are this not or an have "
    "der die und den von zu das mit sich des auf ist im dem nicht ein eine als auch es "
    "de la le les et un une du que est pour qui dans en sur au par pas il "
    "el los y se del las por con una su para no lo al"
).split()


@dataclass(frozen=True)
class Rule:
    """A measure and the closed range it must lie in."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None


#: Production thresholds.
RULES = (
    Rule("too_long", "n_words", high=1_000_000),
    Rule("odd_word_length", "mean_word_chars", low=1.5, high=30.0),
    Rule("symbols", "symbol_word_ratio", high=0.5),
    Rule("few_stop_words", "stop_word_ratio", low=0.01),
    Rule("bullet_lines", "bullet_line_ratio", high=0.9),
    Rule("ellipsis_lines", "ellipsis_line_ratio", high=0.3),
    Rule("repeated_lines", "dup_line_ratio", high=0.5),
)
OUTPUTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "mean_word_chars", "symbol_word_ratio", "stop_word_ratio", "bullet_line_ratio", "ellipsis_line_ratio", "dup_line_ratio", "base_failed", "failed_rules", "kept"]


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def _compile(rules: tuple[Rule, ...]) -> Column:
    """The table as one expression: names of the rules that fail."""
    checks = []
    for r in rules:
        bad = F.lit(False)
        if r.low is not None:
            bad = bad | (F.col(r.measure) < F.lit(r.low))
        if r.high is not None:
            bad = bad | (F.col(r.measure) > F.lit(r.high))
        checks.append(F.when(bad, F.lit(r.name)))
    return F.array_compact(F.array(*checks)) if checks else F.array().cast("array<string>")


def quality_rules(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``df`` with counts, ratios, the names of the failed rules and the verdict ``kept``."""
    base = without(df, OUTPUTS)
    rest = base.columns
    body = F.coalesce(quoted(text), F.lit(""))
    words, lines, hashes = F.col("__tm_words"), F.col("__tm_lines"), F.col("__tm_hashes")
    step = (df if text not in rest else base).withColumn("__tm_text", body)
    step = step.withColumns(
        {
            "__tm_words": F.filter(F.split("__tm_text", _SPACE, -1), lambda w: w != ""),
            "__tm_lines": F.filter(F.split("__tm_text", "\n", -1), lambda x: x.rlike(r"[^ \t\n\x0B\f\r]")),
            "n_symbols": (F.length("__tm_text") - F.length(F.regexp_replace("__tm_text", _SYMBOLS, ""))).cast("long"),
        }
    )
    step = step.withColumns(
        {
            "n_words": F.size(words).cast("long"),
            "word_chars": F.length(F.array_join(words, "")).cast("long"),
            "__tm_n_lines": F.size(lines).cast("long"),
            "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
            "__tm_hashes": F.when(
                F.size(words) >= WINDOW, F.transform(F.sequence(F.lit(1), F.size(words) - F.lit(WINDOW - 1)), lambda i: F.xxhash64(F.slice(words, i, WINDOW)))
            ).otherwise(F.array().cast("array<bigint>")),
            "__tm_stops": F.size(F.filter(words, lambda w: F.lower(w).isin(STOP_WORDS))).cast("long"),
            "__tm_bullets": F.size(F.filter(lines, lambda x: x.rlike(r"^\s*[-*•‣▪]"))).cast("long"),
            "__tm_dots": F.size(F.filter(lines, lambda x: x.rlike(r"(\.\.\.|…)\s*$"))).cast("long"),
        }
    )
    # windows by (hash, place), sorted: a window repeats if a neighbour has its hash
    step = step.withColumn(
        "__tm_sorted",
        F.when(
            F.size(F.array_distinct(hashes)) < F.size(hashes),
            F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    )
    ordered = F.col("__tm_sorted")
    step = step.withColumn(
        "__tm_places",
        F.array_sort(
            F.transform(
                F.filter(
                    ordered,
                    lambda x, k: ((k > 0) & (F.get(ordered, k - F.lit(1))["h"] == x["h"])) | F.coalesce(F.get(ordered, k + F.lit(1))["h"] == x["h"], F.lit(False)),
                ),
                lambda x: x["i"],
            )
        ),
    )
    places = F.col("__tm_places")
    step = step.withColumn(
        "n_repeat_words",
        F.when(
            places.isNotNull(),
            F.aggregate(
                places,
                F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last")),
                lambda a, p: F.struct((a["n"] + F.least(F.lit(WINDOW), p - a["last"])).cast("long").alias("n"), p.alias("last")),
                lambda a: a["n"],
            ),
        ).otherwise(F.lit(0).cast("long")),
    )
    step = step.withColumns(
        {
            "mean_word_chars": _ratio(F.col("word_chars"), F.col("n_words")),
            "symbol_word_ratio": _ratio(F.col("n_symbols"), F.col("n_words")),
            "stop_word_ratio": _ratio(F.col("__tm_stops"), F.col("n_words")),
            "bullet_line_ratio": _ratio(F.col("__tm_bullets"), F.col("__tm_n_lines")),
            "ellipsis_line_ratio": _ratio(F.col("__tm_dots"), F.col("__tm_n_lines")),
            "dup_line_ratio": _ratio(F.col("n_dup_lines"), F.col("__tm_n_lines")),
        }
    )
    step = step.withColumns({"base_failed": (F.col("n_words") < 20) | (F.lit(100) * F.col("n_repeat_words") > F.lit(30) * F.col("n_words")), "failed_rules": _compile(rules)})
    step = step.withColumn("kept", settled(~F.col("base_failed") & (F.size("failed_rules") == 0)))
    return step.select(*[quoted(c) for c in rest], *OUTPUTS)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _sql_rules() -> str:
    tests = []
    for r in RULES:
        if r.low is not None:
            tests.append(f"{r.measure} < {r.low}")
        if r.high is not None:
            tests.append(f"{r.measure} > {r.high}")
    return " OR ".join(tests)


_STOPS = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))
OP3_SQL = rf"""
WITH base AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS body FROM documents
), parts AS (
  SELECT rid, doc_id, body, regexp_extract_all(body, '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(body, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM base
), windows AS (
  SELECT rid, i, list_slice(words, i, i + {WINDOW - 1}) AS w
  FROM (SELECT rid, words, unnest(range(1, len(words) - {WINDOW - 2})) AS i FROM parts WHERE len(words) >= {WINDOW})
), twice AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, w) AS n FROM windows) WHERE n > 1
), gaps AS (
  SELECT rid, least({WINDOW}, i - lag(i, 1, -{WINDOW}) OVER (PARTITION BY rid ORDER BY i)) AS g FROM twice
), repeats AS (
  SELECT rid, sum(g)::BIGINT AS n FROM gaps GROUP BY rid
), counts AS (
  SELECT p.rid, doc_id, len(words)::BIGINT AS n_words, coalesce(length(array_to_string(words, '')), 0)::BIGINT AS word_chars,
         len(regexp_extract_all(body, '[#*$%&|<>]'))::BIGINT AS n_symbols, len(lines)::BIGINT AS n_lines,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words,
         len(list_filter(words, lambda x: lower(x) IN ({_STOPS})))::BIGINT AS n_stops,
         len(list_filter(lines, lambda x: regexp_matches(x, '^\s*[-*•‣▪]')))::BIGINT AS n_bullets,
         len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)\s*$')))::BIGINT AS n_dots
  FROM parts p LEFT JOIN repeats r ON p.rid = r.rid
), measured AS (
  SELECT *, CASE WHEN n_words > 0 THEN word_chars / n_words ELSE 0 END AS mean_word_chars,
         CASE WHEN n_words > 0 THEN n_symbols / n_words ELSE 0 END AS symbol_word_ratio,
         CASE WHEN n_words > 0 THEN n_stops / n_words ELSE 0 END AS stop_word_ratio,
         CASE WHEN n_lines > 0 THEN n_bullets / n_lines ELSE 0 END AS bullet_line_ratio,
         CASE WHEN n_lines > 0 THEN n_dots / n_lines ELSE 0 END AS ellipsis_line_ratio,
         CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0 END AS dup_line_ratio,
         n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed
  FROM counts
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT ({_sql_rules()}) AS kept FROM measured
"""
