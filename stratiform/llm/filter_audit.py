"""How filters act together: what each removes at each step of every order, and its Shapley value.

Every document fails some set of filters, so a part of the table is described by the counts
of its failure sets (32 for five filters). From them follows what every coalition of filters
removes. An order's steps are differences of such removals, and the Shapley values are the
solution of the least squares problem over all coalitions, weighted by the Shapley kernel and
held to the full removal, solved in rationals.

Scale: texts are read once and leave their row as a checksum and four bits. Copies of a text
are found by the smallest doc_id of each checksum, joined back on checksum and doc_id, so a
text that a third of all rows share is no hot key; equal rows are folded before each join.
What reaches one task is a part's failure sets.

Defined results: a NULL text is empty, a NULL lang is the empty part. A NULL doc_id is neither
smaller nor larger than another: such a row repeats nothing, is repeated by none, and has no
labels. Rows that repeat doc_id and text repeat each other only if a smaller doc_id has the
text. A document is good (toxic) if any of its label rows says so; without labels it is
neither. Label rows of unknown documents count nowhere. Other columns are ignored, and an empty
table gives an empty result. Texts are equal when their SHA-256 is.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from fractions import Fraction
from itertools import permutations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratiform.session import cut_lineage

# The signs that separate words.
BLANKS = " \t\n\v\f\r"

MIN_WORDS = 100
MIN_DISTINCT_PERCENT = 80
MAX_CAPITAL_PERCENT = 10
SIGNS = "[#$%&*|]"


def short_text(text: Column, words: Column) -> Column:
    return F.size(words) < MIN_WORDS


def repeated_words(text: Column, words: Column) -> Column:
    return 100 * F.size(F.array_distinct(words)) < MIN_DISTINCT_PERCENT * F.size(words)


def many_capitals(text: Column, words: Column) -> Column:
    length = F.length(text)
    return 100 * (length - F.length(F.regexp_replace(text, "[A-Z]+", ""))).cast("long") > MAX_CAPITAL_PERCENT * length.cast("long")


def odd_signs(text: Column, words: Column) -> Column:
    return text.rlike(SIGNS)


# Conditions a text fails by itself; the last filter, REPEATS, is failed by copies.
CONDITIONS = {"A": short_text, "B": repeated_words, "C": many_capitals, "D": odd_signs}
REPEATS = "E"


def _words(text: Column) -> Column:
    bare = F.btrim(text, F.lit(BLANKS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, f"[{BLANKS}]+"))


def failure_sets(docs: DataFrame, conditions: Mapping = CONDITIONS, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """``(doc_id, part, fails, n)``: rows that agree in all three, counted. Bit i of ``fails`` is
    the i-th condition; the bit after the last is set if a smaller doc_id has the same text."""
    texts = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    ).withColumn("words", _words(F.col("text")))
    bits = sum((F.when(test(F.col("text"), F.col("words")), 1 << i).otherwise(0) for i, test in enumerate(conditions.values())), F.lit(0))
    rows = cut_lineage(texts.select("doc_id", "part", bits.cast("int").alias("fails"), F.unhex(F.sha2("text", 256)).alias("digest")))
    named = rows.filter(F.col("doc_id").isNotNull())
    first = named.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("is_first", F.lit(True))
    folded = named.groupBy("digest", "doc_id", "part", "fails").agg(F.count(F.lit(1)).alias("n"))
    judged = folded.join(first, ["digest", "doc_id"], "left").withColumn("fails", F.col("fails") + F.when(F.col("is_first"), 0).otherwise(1 << len(conditions)))
    nameless = rows.filter(F.col("doc_id").isNull()).groupBy("part", "fails").agg(F.count(F.lit(1)).alias("n")).withColumn("doc_id", F.lit(None).cast("long"))
    columns = ["doc_id", "part", "fails"]
    return judged.groupBy(*columns).agg(F.sum("n").alias("n")).unionByName(nameless.select(*columns, "n"))


def coalition_removals(counts: Mapping[int, int], filters: int) -> list[int]:
    """For every coalition (a bit set of filters) the documents that fail one of them."""
    return [sum(n for fails, n in counts.items() if fails & coalition) for coalition in range(1 << filters)]


def solve(matrix: Sequence[Sequence[Fraction]], right: Sequence[Fraction]) -> list[Fraction]:
    """The solution of a regular square system, exactly."""
    rows = [[*r, b] for r, b in zip(matrix, right)]
    for i in range(len(rows)):
        pivot = next(r for r in range(i, len(rows)) if rows[r][i])
        rows[i], rows[pivot] = rows[pivot], rows[i]
        rows[i] = [x / rows[i][i] for x in rows[i]]
        for r in range(len(rows)):
            if r != i and rows[r][i]:
                rows[r] = [x - rows[r][i] * y for x, y in zip(rows[r], rows[i])]
    return [r[-1] for r in rows]


def shapley_values(value: Sequence[int], filters: int) -> list[Fraction]:
    """Shares phi that minimise the kernel-weighted squares of ``value(S) - sum of phi over S``
    over all proper coalitions, subject to ``sum of phi = value(all)``; these are the Shapley
    values. The normal equations carry the constraint as one more row (its multiplier)."""
    everyone = (1 << filters) - 1
    kernel = {s: Fraction(filters - 1, math.comb(filters, s) * s * (filters - s)) for s in range(1, filters)}
    proper = [(c, kernel[c.bit_count()]) for c in range(1, everyone)]
    matrix = [[sum((w for c, w in proper if c >> i & 1 and c >> j & 1), Fraction(0)) for j in range(filters)] + [Fraction(1)] for i in range(filters)]
    matrix.append([Fraction(1)] * filters + [Fraction(0)])
    right = [sum((w * value[c] for c, w in proper if c >> i & 1), Fraction(0)) for i in range(filters)] + [Fraction(value[everyone])]
    return solve(matrix, right)[:filters]


def _report(names: Sequence[str]):
    k = len(names)
    orders = list(permutations(range(k)))

    def report(part: pd.DataFrame) -> pd.DataFrame:
        removed, good, toxic = (coalition_removals(dict(zip(part["fails"].tolist(), part[c].tolist())), k) for c in ("n", "good", "toxic"))
        total, everyone = int(part["n"].sum()), (1 << k) - 1
        shapley = [int(phi * math.factorial(k)) for phi in shapley_values(removed, k)]
        rows = []
        for order in orders:
            before = 0
            for step, f in enumerate(order, 1):
                after = before | 1 << f
                here = removed[after] - removed[before]
                rows.append(
                    (part["part"].iloc[0], "".join(names[i] for i in order), step, total - removed[after], here, removed[1 << f] - here,
                     removed[everyone] - removed[everyone & ~(1 << f)], good[after] - good[before], toxic[after] - toxic[before], shapley[f])
                )
                before = after
        return pd.DataFrame(rows, columns=[c.split()[0] for c in SCHEMA.split(", ")])

    return report


SCHEMA = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"


def interaction_report(failures: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row per part, order of the filters and step, from ``(part, fails, n, good, toxic)``
    with any number of rows per failure set. ``shapley`` is the filter's Shapley value times the
    number of orders."""
    sets = failures.groupBy("part", "fails").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])
    return sets.groupBy("part").applyInPandas(_report(names), SCHEMA)


def audit_filters(docs: DataFrame, labels: DataFrame, conditions: Mapping = CONDITIONS, repeats: str = REPEATS, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """The report over ``docs`` for the given conditions and the filter of repeated texts."""
    failures = failure_sets(docs, conditions, id_col, text_col, part_col)
    marks = labels.groupBy(F.col(id_col).cast("long").alias("doc_id")).agg(*[F.max(F.when(F.col(c) == 1, 1).otherwise(0)).alias(to) for c, to in (("quality", "good"), ("toxic", "toxic"))])
    named = failures.filter(F.col("doc_id").isNotNull()).join(marks.filter(F.col("doc_id").isNotNull()), "doc_id", "left")
    nameless = failures.filter(F.col("doc_id").isNull()).withColumns({"good": F.lit(0), "toxic": F.lit(0)})
    marked = named.unionByName(nameless).withColumns({c: F.col("n") * F.coalesce(F.col(c), F.lit(0)) for c in ("good", "toxic")})
    return interaction_report(marked, [*conditions, repeats])


ORACLE = r"""
WITH texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), marks AS (
  SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id
), failed AS (
  SELECT part,
    (len(ws) < 100)::INT
    + 2 * (100 * len(list_distinct(ws)) < 80 * len(ws))::INT
    + 4 * (100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 10 * length(t))::INT
    + 8 * regexp_matches(t, '[#$%&*|]')::INT
    + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)::INT AS fails,
    coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic
  FROM texts LEFT JOIN marks USING (doc_id)
), cells AS (
  SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failed GROUP BY ALL
), letters AS (
  SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS v(letter, bit)
), orders AS (
  SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31
), steps AS (
  SELECT filter_order, step, letter, bit, coalesce(sum(bit) OVER (PARTITION BY filter_order ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::INT AS before
  FROM orders, (SELECT unnest(range(1, 6))::INT AS step) JOIN letters ON substr(filter_order, step, 1) = letter
), counted AS (
  SELECT part, filter_order, step, letter,
    sum(n) FILTER (WHERE fails & (before | bit) = 0) AS kept,
    sum(n) FILTER (WHERE fails & bit <> 0 AND fails & before = 0) AS removed,
    sum(n) FILTER (WHERE fails & bit <> 0 AND fails & before <> 0) AS redundant,
    sum(n) FILTER (WHERE fails = bit) AS unique_fails,
    sum(good) FILTER (WHERE fails & bit <> 0 AND fails & before = 0) AS good_lost,
    sum(toxic) FILTER (WHERE fails & bit <> 0 AND fails & before = 0) AS toxic_lost
  FROM cells, steps GROUP BY ALL
)
SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed, coalesce(redundant, 0)::BIGINT AS redundant,
  coalesce(unique_fails, 0)::BIGINT AS unique_fails, coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
  (sum(coalesce(removed, 0)) OVER (PARTITION BY part, letter))::BIGINT AS shapley
FROM counted
"""
