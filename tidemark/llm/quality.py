"""Quality rules as a short-circuit cascade of Spark expressions.

Every rule is a condition on columns. On a bounded sample the engine measures what each rule costs and which share
of rows it rejects; rules then run by rejections per second, and ``CASE`` stops at the first that rejects. The
order decides how much work is done, never the verdict, which is that all rules pass.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows the order of the rules is estimated on.
SAMPLE_ROWS = 1000
#: White space of the word contract, as characters and as a pattern.
BLANKS = " \t\n\x0b\x0c\r"
GAP = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
BULLETS = r"^[\x20\x09-\x0D]*[-*•‣▪●·]"
SPAN = 5
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """A row passes if ``passes`` is true; NULL counts as a rejection."""

    name: str
    passes: Column


def bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text as an array; NULL and blank texts have none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, GAP))


def word_count(text: Column) -> Column:
    return F.size(words_of(text)).cast("bigint")


def _covered(windows: Column) -> Column:
    """Words in windows that occur twice or more, from the windows' hashes in text order."""

    def among(pairs: Column) -> Column:
        def place(pair: Column, at: Column) -> Column:
            same = (F.get(pairs, at - 1)["key"] == pair["key"]) | (F.get(pairs, at + 1)["key"] == pair["key"])
            return F.when(same, pair["at"])

        places = F.sort_array(F.filter(F.transform(pairs, place), lambda p: p.isNotNull()))
        start = F.struct(F.lit(0).cast("bigint").alias("words"), F.lit(-SPAN).alias("last"))
        step = lambda state, p: F.struct(
            (state["words"] + F.least(F.lit(SPAN), p - state["last"])).alias("words"), p.alias("last")
        )
        return F.aggregate(places, start, step, lambda state: state["words"])

    pairs = F.sort_array(F.transform(windows, lambda key, at: F.struct(key.alias("key"), at.alias("at"))))
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("bigint")).otherwise(bind(pairs, among))


def repeated_words(words: Column) -> Column:
    """Words inside 5-word windows that occur twice or more in the text, the first occurrence included."""
    hashes = F.transform(
        F.sequence(F.lit(0), F.size(words) - SPAN), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(SPAN)])
    )
    return F.when(F.size(words) <= SPAN, F.lit(0).cast("bigint")).otherwise(bind(hashes, _covered))


def base_measures(docs: DataFrame, text: str, prefix: str = "") -> DataFrame:
    """``docs`` with the measures that the base verdict needs, and ``n_lines``, lines that hold a word.

    NULL text has zero of everything. All counts are of whole texts.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    with_word = F.filter(F.split(whole, "\n"), lambda line: F.btrim(line, F.lit(BLANKS)) != "")
    of_words = bind(words_of(whole), lambda w: F.struct(F.size(w).cast("bigint").alias("n"), repeated_words(w).alias("repeat")))
    of_lines = bind(with_word, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup")))
    without = lambda marks: F.length(F.translate(whole, marks, ""))
    words, lines = f"{prefix}_words", f"{prefix}_lines"
    measured = docs.withColumns({words: of_words, lines: of_lines})
    return measured.withColumns(
        {
            f"{prefix}n_words": F.col(words)["n"],
            f"{prefix}word_chars": without(BLANKS).cast("bigint"),
            f"{prefix}n_symbols": (F.length(whole) - without(SYMBOLS)).cast("bigint"),
            f"{prefix}n_dup_lines": F.col(lines)["dup"].cast("bigint"),
            f"{prefix}n_repeat_words": F.col(words)["repeat"],
            f"{prefix}n_lines": F.col(lines)["n"].cast("bigint"),
        }
    ).drop(words, lines)


def base_failed(prefix: str = "") -> Column:
    n, repeat = F.col(f"{prefix}n_words"), F.col(f"{prefix}n_repeat_words")
    return (n < 10) | (100 * repeat > 20 * n)


def default_rules(text: str, prefix: str = "") -> list[Rule]:
    """Rules on the measures, and on the text itself. They allow for any language written with spaces."""
    whole = F.coalesce(F.col(text), F.lit(""))
    n, lines = F.col(f"{prefix}n_words"), F.col(f"{prefix}n_lines")
    letters = F.length(F.regexp_replace(whole, r"[^\p{L}]", ""))
    capitals = F.length(F.regexp_replace(whole, r"[^\p{Lu}]", ""))
    bullets = F.size(F.filter(F.split(whole, "\n"), lambda line: line.rlike(BULLETS)))
    return [
        Rule("symbols", 10 * F.col(f"{prefix}n_symbols") <= n),
        Rule("duplicate lines", 10 * F.col(f"{prefix}n_dup_lines") <= 3 * lines),
        Rule("word length", (F.col(f"{prefix}word_chars") >= 2 * n) & (F.col(f"{prefix}word_chars") <= 15 * n)),
        Rule("letters", 10 * letters >= 6 * F.col(f"{prefix}word_chars")),
        Rule("capitals", 2 * capitals <= letters),
        Rule("bullets", 10 * bullets <= 9 * lines),
    ]


def measured_order(docs: DataFrame, rules: list[Rule], sample_rows: int = SAMPLE_ROWS, repeats: int = 2) -> list[Rule]:
    """``rules`` by rejections per second on the first ``sample_rows`` rows of ``docs``, ties as given.

    The rows come from few partitions and may be no fair sample; that costs time, not results.
    """
    rows = docs.take(sample_rows)
    if not rows or len(rules) < 2:
        return list(rules)
    sample = docs.sparkSession.createDataFrame(rows, docs.schema).coalesce(1)
    fails = [F.avg(F.when(rule.passes, 0.0).otherwise(1.0)) for rule in rules]
    rejected = sample.agg(*[f.alias(str(i)) for i, f in enumerate(fails)]).first()

    def seconds(*columns: Column) -> float:
        taken = []
        for _ in range(repeats):
            began = time.perf_counter()
            sample.select(F.lit(0).alias("z"), *columns).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - began)
        return min(taken)

    empty = seconds()
    costs = [max(seconds(rule.passes.alias("p")) - empty, 1e-4) for rule in rules]
    return [rules[i] for i in sorted(range(len(rules)), key=lambda i: (-rejected[i] / costs[i], i))]


def verdict(rules: list[Rule]) -> Column:
    """True if all rules pass; the first that rejects ends the evaluation."""
    kept = F.lit(True)
    for rule in reversed(rules):
        kept = F.when(F.coalesce(rule.passes, F.lit(False)), kept).otherwise(F.lit(False))
    return kept


def _judged(docs: DataFrame, text: str, rules: list[Rule] | None, sample_rows: int) -> tuple[DataFrame, str]:
    """``docs`` with measures and verdicts under a prefix that no column of ``docs`` has, and the prefix."""
    prefix = "_"
    while any(c.startswith(prefix) for c in docs.columns):
        prefix += "_"
    measured = base_measures(docs, text, prefix)
    rules = default_rules(text, prefix) if rules is None else rules
    sampled = measured.select(F.col(text), *[f"{prefix}{n}" for n in (*MEASURES, "n_lines")])
    order = measured_order(sampled, rules, sample_rows)
    kept = F.when(base_failed(prefix), F.lit(False)).otherwise(verdict(order))
    return measured.withColumns({f"{prefix}base_failed": base_failed(prefix), f"{prefix}kept": kept}), prefix


def assess(docs: DataFrame, *, text: str = "text", rules: list[Rule] | None = None, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``docs`` with ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept``.

    Columns of ``docs`` with these names are replaced. NULL and empty texts have no words, fail the base and are
    not kept. Rows that repeat get equal verdicts. No rows: no rows.
    """
    judged, prefix = _judged(docs, text, rules, sample_rows)
    out = [*MEASURES, "base_failed", "kept"]
    own = [F.col(c) for c in docs.columns if c not in out]
    return judged.select(*own, *[F.col(f"{prefix}{n}").alias(n) for n in out])


def kept_rows(docs: DataFrame, *, text: str = "text", rules: list[Rule] | None = None, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of ``docs`` that :func:`assess` keeps, with their own columns."""
    judged, prefix = _judged(docs, text, rules, sample_rows)
    return judged.where(f"`{prefix}kept`").select(*docs.columns)


ORACLE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents
), wins AS (
  SELECT rid, i, list_slice(w, i, i + 4) AS k FROM (SELECT rid, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)
), twice AS (
  SELECT rid, i FROM wins QUALIFY count(*) OVER (PARTITION BY rid, k) > 1
), covered AS (
  SELECT rid, count(DISTINCT i + j) AS n FROM twice, (SELECT unnest(range(5)) AS j) GROUP BY rid
), m AS (
  SELECT d.rid, doc_id, t, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(l) - len(list_distinct(l)) AS n_dup_lines, len(l) AS n_lines, coalesce(c.n, 0) AS n_repeat_words,
         length(regexp_replace(t, '[^\p{L}]', '', 'g')) AS letters, length(regexp_replace(t, '[^\p{Lu}]', '', 'g')) AS capitals,
         len(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*•‣▪●·]'))) AS bullets
  FROM d LEFT JOIN covered c USING (rid)
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND 10 * n_symbols <= n_words
         AND 10 * n_dup_lines <= 3 * n_lines AND word_chars BETWEEN 2 * n_words AND 15 * n_words
         AND 10 * letters >= 6 * word_chars AND 2 * capitals <= letters AND 10 * bullets <= 9 * n_lines AS kept
FROM m
"""
