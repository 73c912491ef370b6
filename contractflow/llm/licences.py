"""Licence detection with ordered signature rules, in DataFrame functions only.

A text is reduced to its words once. One expression finds the keywords that stand in it; only rules with such a keyword are tried. Each
match becomes an interval of words. Going through a text's intervals from left to right, the furthest end reached so far by each
priority tells whether an interval lies in one of at least its own: those are suppressed, without comparing pairs.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .signatures import Rule, rules

#: Characters between words.
BREAKS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def expression(rule: Rule) -> str:
    """The rule's expression over texts whose every word stands between two spaces of its own."""
    return f" (?:{rule.expression.replace('[^ ]', '[^\x01]').replace(' ', '  ').replace('[^\x01]', '[^ ]')}) "


def keyword_expression(known: Sequence[Rule]) -> str:
    """Any keyword of the rules, by first letter, so that most words are left at their first character."""
    by_letter: dict[str, set[str]] = defaultdict(set)
    for word in {w for rule in known for w in rule.keywords}:
        by_letter[word[0]].add(word[1:])
    return " (" + "|".join(f"{a}(?:{'|'.join(sorted(by_letter[a], key=lambda w: (-len(w), w)))})" for a in sorted(by_letter)) + ") "


def spaced_words(text: Column) -> Column:
    """The words of a text (null: none), A-Z lower-cased, each between two spaces of its own; without words the empty text."""
    text = F.coalesce(text, F.lit(""))
    ascii_only = F.octet_length(text) == F.length(text)
    lowered = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    joined = F.trim(F.regexp_replace(lowered, BREAKS, "  "))
    return F.when(joined == "", joined).otherwise(F.concat(F.lit(" "), joined, F.lit(" ")))


def word_count(spaced: Column) -> Column:
    return F.shiftright(F.length(spaced) - F.length(F.replace(spaced, F.lit(" "), F.lit(""))), 1).cast("long")


def _table(known: Sequence[Rule]) -> Column:
    """The rules as an array of structs, a constant of the plan."""
    one = lambda i, r: F.struct(F.lit(i).alias("rule"), F.array(*map(F.lit, r.keywords)).alias("keywords"), F.lit(expression(r)).alias("expression"))
    return F.array(*[one(i, r) for i, r in enumerate(known)])


def _of(known: Sequence[Rule], field: str) -> Column:
    """A field of the rule whose number stands in ``_rule``; null without one (a null place would not make the element null)."""
    values = F.array(*[F.lit(getattr(r, field)) for r in known])
    return F.when(F.col("_rule").isNotNull(), F.element_at(values, F.coalesce("_rule", F.lit(0)) + 1))


def detections(docs: DataFrame, key: str = "doc_id", text: str = "text", known: Sequence[Rule] = rules()) -> DataFrame:
    """Every match of every rule, and one row without a rule for each document that has none.

    Columns: ``row`` (a number of the input row), the key, n_words, rule, label, priority, confidence, base, start and ``end`` (in words
    from 0, end exclusive; a rule's matches are those from left to right that do not overlap) and ``kept``. A match is not kept if another
    of at least its priority covers all its words; of equal ones the rule that comes first stays. Base rules are always kept. Repeated rows and null keys
    are documents of their own; null and empty texts have no words. Nothing but numbers is shuffled, once, by row.
    """
    words = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(key).alias("_key"), spaced_words(F.col(text)).alias("_words"))
    keyed = words.withColumn("_found", F.array_distinct(F.regexp_extract_all("_words", F.lit(keyword_expression(known)), F.lit(1))))
    tried = F.filter(_table(known), lambda r: F.arrays_overlap(r["keywords"], F.col("_found")))
    matches = lambda r: F.zip_with(
        F.split(F.col("_words"), r["expression"]),
        F.regexp_extract_all(F.col("_words"), r["expression"], F.lit(0)),
        lambda gap, hit: F.struct(r["rule"].alias("rule"), word_count(gap).alias("gap"), word_count(hit).alias("size")),
    )
    hits = F.when(F.size("_found") > 0, F.filter(F.flatten(F.transform(tried, matches)), lambda h: h["size"].isNotNull()))
    found = keyed.select("_row", "_key", word_count(F.col("_words")).alias("_count"), hits.alias("_hits"))
    each = found.select("_row", "_key", "_count", F.posexplode_outer("_hits").alias("_at", "_hit"))
    each = each.select("_row", "_key", "_count", "_at", F.col("_hit.rule").alias("_rule"), F.col("_hit.gap").alias("_gap"), F.col("_hit.size").alias("_size")).repartition("_row")

    upto = Window.partitionBy("_row", "_rule").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    placed = each.withColumn("_end", F.sum(F.col("_gap") + F.col("_size")).over(upto)).withColumn("_start", F.col("_end") - F.col("_size"))
    placed = placed.withColumn("_level", _of(known, "priority"))
    order = [F.asc("_start"), F.desc("_end"), F.desc("_level"), F.asc("_rule")]
    before = Window.partitionBy("_row").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    reach = F.lit(None).cast("long")
    for level in sorted({r.priority for r in known}):
        reach = F.when(F.col("_level") == level, F.max(F.when(F.col("_level") >= level, F.col("_end"))).over(before)).otherwise(reach)
    covered = F.coalesce(reach >= F.col("_end"), F.lit(False))
    return placed.select(
        F.col("_row").alias("row"), F.col("_key").alias(key), F.col("_count").alias("n_words"), _of(known, "name").alias("rule"), _of(known, "label").alias("label"),
        F.col("_level").alias("priority"), _of(known, "confidence").alias("confidence"), _of(known, "base").alias("base"),
        F.col("_start").alias("start"), F.col("_end").alias("end"), (F.col("_rule").isNotNull() & (_of(known, "base") | ~covered)).alias("kept"),
    )


def licences(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per document: key, n_words, n_base, first_word and last_word of the base matches, base_labels, labels, score (the best confidence kept)."""
    base = lambda value: F.when(F.col("base"), value)
    joined = lambda value: F.array_join(F.array_sort(F.collect_set(value)), ",")
    return (
        found.groupBy("row")
        .agg(
            F.first(key).alias(key), F.first("n_words").alias("n_words"), F.count(base(F.lit(1))).alias("n_base"),
            F.min(base(F.col("start"))).alias("first_word"), F.max(base(F.col("start"))).alias("last_word"),
            joined(base(F.col("label"))).alias("base_labels"), joined(F.when(F.col("kept"), F.col("label"))).alias("labels"),
            F.coalesce(F.max(F.when(F.col("kept"), F.col("confidence"))), F.lit(0.0)).alias("score"),
        )
        .drop("row")
    )


def _sql(known: Sequence[Rule]) -> str:
    listed = ",\n    ".join(f"({i}, '{r.label}', [{', '.join(repr(w) for w in r.keywords)}], '{expression(r)}', {r.priority}, {r.confidence}::DOUBLE, {r.base})" for i, r in enumerate(known))
    return rf"""
WITH rules(rule, label, keywords, expression, priority, confidence, base) AS (VALUES
    {listed}
), texts AS (
    SELECT row_number() OVER () AS row, doc_id, trim(regexp_replace(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', '  ', 'g'), ' ') AS joined
    FROM documents
), words AS MATERIALIZED (
    SELECT row, doc_id, CASE WHEN joined = '' THEN '' ELSE ' ' || joined || ' ' END AS spaced FROM texts
), tried AS (
    SELECT row, spaced, rule, expression FROM words, rules WHERE list_has_any(string_split(spaced, ' '), keywords)
), pieces AS (
    SELECT row, rule, regexp_split_to_array(spaced, expression) AS gaps, regexp_extract_all(spaced, expression) AS hits FROM tried
), sizes AS (
    SELECT row, rule, list_transform(gaps, lambda x: (length(x) - length(replace(x, ' ', ''))) // 2) AS gaps, list_transform(hits, lambda x: (length(x) - length(replace(x, ' ', ''))) // 2) AS hits
    FROM pieces WHERE len(hits) > 0
), places AS (
    SELECT row, rule, unnest(list_transform(hits, lambda x, i: list_sum(gaps[1:i]) + coalesce(list_sum(hits[1:i - 1]), 0))) AS start, unnest(hits) AS size FROM sizes
), spans AS (
    SELECT row, rule, start, start + size AS stop, label, priority, confidence, base FROM places JOIN rules USING (rule)
), kept AS (
    SELECT *, base OR NOT EXISTS (SELECT 1 FROM spans o WHERE o.row = s.row AND o.start <= s.start AND o.stop >= s.stop AND o.priority >= s.priority
        AND (o.start, -o.stop, -o.priority, o.rule) < (s.start, -s.stop, -s.priority, s.rule)) AS kept
    FROM spans s
), found AS (
    SELECT row, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word, max(start) FILTER (base) AS last_word,
        string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) FILTER (kept) AS labels, max(confidence) FILTER (kept) AS score
    FROM kept GROUP BY row
)
SELECT doc_id, (length(spaced) - length(replace(spaced, ' ', ''))) // 2 AS n_words, coalesce(n_base, 0) AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
    coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0) AS score
FROM words LEFT JOIN found USING (row)
"""


SQL = _sql(rules())
