"""Quality rules: a threshold table compiled into one projection of built-in expressions.

Every text is measured as a whole; NULL counts as a text without words. Rows are judged one by
one, so repeated rows get equal verdicts, and only the text and its language are looked at, so other
columns may have any names. Stop words are asked of texts in the languages whose words are listed; a text in another
language, or whose language is NULL or not given, is judged by the other rules.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartflow.llm.common import let, table, words

SYMBOLS = "#*$%&|<>"
BULLETS = ("-", "*", "•", "‣", "·", "|")
#: Languages whose stop words are listed.
LANGUAGES = ("en", "fr", "de", "es")
#: Frequent function words of these languages, as they stand inside and at the start of sentences and in capitals.
STOP_WORDS = tuple(
    form
    for word in (
        "the be to of and that have with in is it for as was by on are an a "
        "le la les de des du et un une que qui en est pour dans sur par au "
        "der die das und ist ein eine zu von den mit für auf nicht im dem "
        "el los las del y se no con una su para es por lo como"
    ).split()
    for form in dict.fromkeys((word, word.capitalize(), word.upper()))
)


@dataclass(frozen=True)
class Rule:
    """``measure`` must lie between ``low`` and ``high`` times ``per`` (a measure, or one if None).

    A rule with ``langs`` holds for texts in these languages only. Bounds are compared as products, so a text without words or lines divides by nothing.
    """

    name: str
    measure: str
    per: str | None = None
    low: float | None = None
    high: float | None = None
    langs: tuple[str, ...] | None = None


#: Rejected by the base: short texts, and texts most of whose words stand in repeated 3-word windows.
BASE_RULES = (
    Rule("few_words", "n_words", low=50),
    Rule("repeated_words", "n_repeat_words", "n_words", high=0.5),
)
#: Thresholds in wide use for web text; all are per text and independent of the corpus.
METHOD_RULES = (
    Rule("word_length", "word_chars", "n_words", low=2.5, high=15.0),
    Rule("symbols", "n_symbols", "n_words", high=0.1),
    Rule("stop_words", "n_stop_words", low=2, langs=LANGUAGES),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", high=0.5),
    Rule("bullet_lines", "n_bullet_lines", "n_lines", high=0.9),
    Rule("ellipsis_lines", "n_ellipsis_lines", "n_lines", high=0.3),
)
MEASURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_stop_words",
    "n_bullet_lines",
    "n_ellipsis_lines",
)


def _repeat_words(tokens: Column) -> Column:
    """Words inside 3-word windows that stand twice or more in ``tokens``.

    Windows are sorted with their places; equal neighbours are repeats. Words hold no blanks, so
    joined windows are equal only if their words are.
    """

    def of_windows(windows: Column) -> Column:
        def of_sorted(ordered: Column) -> Column:
            last = F.size(ordered) - 1
            repeated = F.filter(
                ordered,
                lambda x, j: ((j > 0) & (F.get(ordered, j - 1)["w"] == x["w"]))
                | ((j < last) & (F.get(ordered, j + 1)["w"] == x["w"])),
            )
            places = F.flatten(F.transform(repeated, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))
            return F.size(F.array_distinct(places))

        pairs = F.sort_array(F.transform(windows, lambda w, i: F.struct(w.alias("w"), i.alias("i"))))
        return let(pairs, of_sorted)

    windows = F.transform(
        F.sequence(F.lit(0), F.size(tokens) - 3),
        lambda i: F.concat_ws(" ", F.get(tokens, i), F.get(tokens, i + 1), F.get(tokens, i + 2)),
    )
    return F.when(F.size(tokens) < 4, F.lit(0)).otherwise(
        let(windows, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(of_windows(w)))
    )


def measures(text: Column) -> Column:
    """One struct with all ``MEASURES`` of a text, as bigint."""
    whole = F.coalesce(text, F.lit(""))

    def of_lines(lines: Column) -> list[Column]:
        return [
            F.size(lines) - F.size(F.array_distinct(lines)),
            F.size(lines),
            F.size(F.filter(lines, lambda l: F.ltrim(l).rlike("^[" + "".join(BULLETS) + "]"))),
            F.size(F.filter(lines, lambda l: F.rtrim(l).endswith("...") | F.rtrim(l).endswith("…"))),
        ]

    def build(tokens: Column, lines: Column) -> Column:
        dup, n_lines, bullets, ellipses = of_lines(lines)
        found = {
            "n_words": F.size(tokens),
            "word_chars": F.length(F.translate(whole, " \t\n\x0b\x0c\r", "")),
            "n_symbols": F.length(whole) - F.length(F.translate(whole, SYMBOLS, "")),
            "n_dup_lines": dup,
            "n_repeat_words": _repeat_words(tokens),
            "n_lines": n_lines,
            "n_stop_words": F.size(F.array_intersect(tokens, F.array(*[F.lit(w) for w in STOP_WORDS]))),
            "n_bullet_lines": bullets,
            "n_ellipsis_lines": ellipses,
        }
        return F.struct(*[found[name].cast("bigint").alias(name) for name in MEASURES])

    lines = F.filter(F.split(whole, "\n"), lambda l: l.rlike(r"[^\x20\x09-\x0D]"))
    return let(words(text), lambda tokens: let(lines, lambda ls: build(tokens, ls)))


def _fails(rule: Rule, found: Column, lang: Column) -> Column:
    value, unit = found[rule.measure], found[rule.per] if rule.per else F.lit(1)
    low = F.lit(False) if rule.low is None else value < unit * F.lit(rule.low)
    high = F.lit(False) if rule.high is None else value > unit * F.lit(rule.high)
    if rule.langs is None:
        return low | high
    main = F.lower(F.substring_index(lang, "-", 1))  # "en-GB" is English
    return (low | high) & F.coalesce(main.isin(*rule.langs), F.lit(False))


def verdict(
    text: Column, lang: Column | None = None, base: tuple[Rule, ...] = BASE_RULES, method: tuple[Rule, ...] = METHOD_RULES
) -> Column:
    """Struct of the measures, ``base_failed``, ``kept`` and the names of the failed rules in table order."""
    lang = F.lit(None).cast("string") if lang is None else lang.cast("string")

    def judge(found: Column) -> Column:
        failed = F.filter(
            F.array(*[F.when(_fails(r, found, lang), F.lit(r.name)) for r in (*base, *method)]), lambda n: n.isNotNull()
        )
        base_failed = F.exists(F.array(*[_fails(r, found, lang) for r in base]), lambda x: x)
        return let(
            failed,
            lambda names: F.struct(
                *[found[m].alias(m) for m in MEASURES],
                base_failed.alias("base_failed"),
                (F.size(names) == 0).alias("kept"),
                F.array_join(names, ",").alias("failed_rules"),
            ),
        )

    return let(measures(text), judge)


def _lang(docs: DataFrame, name: str) -> Column | None:
    return F.col(name) if name in docs.columns else None


def judged(docs: DataFrame, *keep: str, text: str = "text", lang: str = "lang", **tables: tuple[Rule, ...]) -> DataFrame:
    """Columns ``keep`` of every row with its measures and verdict."""
    result = verdict(F.col(text), _lang(docs, lang), **tables)
    return docs.select(*keep, F.inline(F.array(result)))


def kept_rows(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """Rows that pass all rules, with exactly the columns they came with."""
    return docs.filter(verdict(F.col(text), _lang(docs, lang))["kept"])


def op10_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Measures and verdict of every document."""
    found = judged(table(spark, sf_dir, "documents"), "doc_id")
    return found.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "failed_rules",
    )


def _sql_rule(rule: Rule) -> str:
    unit = rule.per or "1"
    tests = [f"{rule.measure} < {unit} * {rule.low}::DOUBLE"] if rule.low is not None else []
    tests += [f"{rule.measure} > {unit} * {rule.high}::DOUBLE"] if rule.high is not None else []
    test = "(" + " OR ".join(tests) + ")"
    if rule.langs is None:
        return test
    return f"({test} AND coalesce(list_contains({_sql_list(rule.langs)}, lower(split_part(lang, '-', 1))), FALSE))"


def _sql_list(values: tuple[str, ...]) -> str:
    return "[" + ", ".join("'" + v + "'" for v in values) + "]"


def oracle_sql() -> str:
    failed = ", ".join(f"CASE WHEN {_sql_rule(r)} THEN '{r.name}' END" for r in (*BASE_RULES, *METHOD_RULES))
    base = " OR ".join(_sql_rule(r) for r in BASE_RULES)
    return rf"""
WITH split AS (
  SELECT doc_id, lang, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
numbered AS MATERIALIZED (SELECT row_number() OVER () AS row_id, * FROM split),
windows AS (
  SELECT row_id, g AS i, w[g] || ' ' || w[g + 1] || ' ' || w[g + 2] AS k
  FROM (SELECT row_id, w, unnest(range(1, len(w) - 1)) AS g FROM numbered)),
spans AS (
  SELECT row_id, unnest([i, i + 1, i + 2]) AS p
  FROM (SELECT row_id, i, count(*) OVER (PARTITION BY row_id, k) AS c FROM windows) WHERE c > 1),
repeats AS (SELECT row_id, count(DISTINCT p) AS n FROM spans GROUP BY row_id),
measured AS (
  SELECT doc_id, lang, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, len(l) - len(list_distinct(l)) AS n_dup_lines,
         coalesce(n, 0) AS n_repeat_words, len(l) AS n_lines,
         len(list_distinct(list_filter(w, lambda x: list_contains({_sql_list(STOP_WORDS)}, x)))) AS n_stop_words,
         len(list_filter(l, lambda x: list_contains({_sql_list(BULLETS)}, left(ltrim(x, ' '), 1)))) AS n_bullet_lines,
         len(list_filter(l, lambda x: rtrim(x, ' ') LIKE '%...' OR rtrim(x, ' ') LIKE '%…')) AS n_ellipsis_lines
  FROM numbered LEFT JOIN repeats USING (row_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       ({base}) AS base_failed, len(list_filter([{failed}], lambda x: x IS NOT NULL)) = 0 AS kept,
       array_to_string(list_filter([{failed}], lambda x: x IS NOT NULL), ',') AS failed_rules
FROM measured
"""
