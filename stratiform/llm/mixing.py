"""Mixing sources to target weights by hierarchical budgeting.

The corpus is a tree: domain, language, source. A token budget is handed down from the
root. Children share their parent's budget by weight; a child never gets more than its
leaves can supply (their tokens times the allowed epochs), and what it cannot take goes
to its siblings by their weights. As a child's supply is that of all leaves below it, a
shortage is made up among siblings first and reaches an aunt only when the whole family
is used up. Each leaf then takes a prefix of its token stream: all its documents in the
seeded order of epoch 0, again in that of epoch 1, and so on; the last one is cut.

Everything is whole-number arithmetic, so the result is the same on any cluster.

Scale: the tree is one row per leaf. Positions within a leaf come from two levels of
prefix sums (over hash buckets of a leaf, then inside one bucket), so a leaf that holds
a third of all rows is spread over ``BUCKETS`` groups for each epoch.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Target weights. Domains are named d0 to d3; languages not listed weigh 1.
DOMAIN_WEIGHTS = {"d0": 4, "d1": 3, "d2": 2, "d3": 1}
LANGUAGE_WEIGHTS = {"en": 5, "de": 2, "fr": 2, "es": 1}

BUDGET_PERCENT = 60
EPOCHS = 2
SEED = 17
BUCKET_DIGITS = 3
BUCKETS = 16**BUCKET_DIGITS
LEVELS = ("domain", "language", "source")


def default_domain(source: Column) -> Column:
    """Sources are dealt to four domains by the checksum of their name."""
    return F.concat(F.lit("d"), (F.crc32(source) % 4).cast("string"))


def words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def _weight(level: str, weights: Mapping[str, int]) -> Column:
    if not weights:
        return F.lit(1).cast("long")
    table = F.create_map(*[F.lit(x) for kv in weights.items() for x in kv])
    return F.coalesce(F.try_element_at(table, F.col(level)), F.lit(1)).cast("long")


def _hand_down(parents: DataFrame, children: DataFrame, over: list[str]) -> DataFrame:
    """Share each parent's ``budget`` among its children (``weight``, ``supply``).

    Children are served in order of supply for each unit of weight. One whose supply is
    below its share of what is left takes all of it; from the first that is not short,
    everyone takes its share of the rest (rounded down).
    """
    ahead = W.partitionBy(*over).orderBy(F.col("supply") / F.col("weight"), "name").rowsBetween(W.unboundedPreceding, -1)
    family = W.partitionBy(*over)
    rows = children.join(parents, over).withColumns(
        {
            "left": F.col("budget") - F.coalesce(F.sum("supply").over(ahead), F.lit(0)),
            "load": F.sum("weight").over(family) - F.coalesce(F.sum("weight").over(ahead), F.lit(0)),
        }
    )
    short = F.col("supply") * F.col("load") <= F.col("left") * F.col("weight")
    first_full = F.min(F.when(~short, F.struct(F.col("supply") / F.col("weight"), F.col("name"), F.col("left"), F.col("load")))).over(family)
    rest = F.expr("stop.left * weight div stop.load")
    return rows.withColumn("stop", first_full).withColumn("budget", F.when(short, F.col("supply")).otherwise(rest)).drop("left", "load", "stop")


def _leaves(sized: DataFrame, epochs: int) -> DataFrame:
    return sized.groupBy(F.lit(0).alias("root"), *LEVELS).agg((F.sum("tokens") * epochs).alias("supply"))


def budgets(sized: DataFrame, percent: int, epochs: int, weights: Mapping[str, Mapping[str, int]]) -> DataFrame:
    """``domain, language, source, budget`` for every leaf of ``(..., tokens)`` rows."""
    leaves = _leaves(sized, epochs)
    handed = sized.groupBy(F.lit(0).alias("root")).agg(F.expr(f"sum(tokens) * {percent} div 100").alias("budget"))
    for depth, level in enumerate(LEVELS):
        over = ["root", *LEVELS[:depth]]
        keys = [*over, level]
        children = leaves.groupBy(*keys).agg(F.sum("supply").alias("supply")).withColumns({"weight": _weight(level, weights.get(level, {})), "name": F.col(level)})
        handed = _hand_down(handed, children, over).select(*keys, F.least("budget", "supply").alias("budget"))
    return handed.drop("root")


def _sized(docs: DataFrame, domain, id_col: str, text_col: str) -> DataFrame:
    source = F.coalesce(F.col("source").cast("string"), F.lit(""))
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        domain(source).alias("domain"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("language"),
        source.alias("source"),
        words(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("tokens"),
    )


def mix(
    docs: DataFrame, percent: int = BUDGET_PERCENT, epochs: int = EPOCHS, seed: int = SEED,
    weights: Mapping[str, Mapping[str, int]] | None = None, domain=default_domain, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per document and epoch that contributes tokens:
    ``domain, language, source, doc_id, epoch, tokens, start, taken``.

    ``start`` is the place of the document in its leaf's stream, ``taken`` how many of its
    tokens (words) are used: all but for the last of a leaf. ``percent`` of the corpus'
    tokens is the budget; it may exceed 100 as long as ``epochs`` allow. Documents without
    words contribute nothing. NULL lang or source is a leaf of its own, named ''. Rows
    that repeat a doc_id each count; their order among each other follows their sizes. An
    empty table gives no row; other columns are ignored.
    """
    weights = weights if weights is not None else {"domain": DOMAIN_WEIGHTS, "language": LANGUAGE_WEIGHTS}
    sized = _sized(docs, domain, id_col, text_col)
    leaf_budget = budgets(sized, percent, epochs, weights)
    place = F.md5(F.concat_ws(":", F.lit(seed), F.col("epoch"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    rows = (
        sized.filter("tokens > 0")
        .withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
        .withColumn("place", place)
        .withColumn("bucket", F.substring("place", 1, BUCKET_DIGITS))
    )
    inside = W.partitionBy(*LEVELS, "epoch", "bucket").orderBy("place", "tokens").rowsBetween(W.unboundedPreceding, -1)
    before = W.partitionBy(*LEVELS).orderBy("epoch", "bucket").rowsBetween(W.unboundedPreceding, -1)
    buckets = rows.groupBy(*LEVELS, "epoch", "bucket").agg(F.sum("tokens").alias("held"))
    # What a leaf's buckets need to know: tokens before them and the leaf's budget. Buckets
    # that start beyond the budget fall out here.
    wanted = buckets.withColumn("base", F.coalesce(F.sum("held").over(before), F.lit(0))).join(leaf_budget, list(LEVELS)).filter("base < budget")
    taken = rows.join(wanted.drop("held"), [*LEVELS, "epoch", "bucket"]).withColumn("start", F.col("base") + F.coalesce(F.sum("tokens").over(inside), F.lit(0)))
    return taken.filter("start < budget").select(*LEVELS, "doc_id", "epoch", "tokens", "start", F.least("tokens", F.col("budget") - F.col("start")).alias("taken"))


def select_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents that a one-epoch mix uses, whole rows in all columns. A document of
    which the budget covers a part stays whole: its leaf overruns by less than one text."""
    chosen = mix(docs, epochs=1, **options).select(F.col("doc_id").alias("__id")).distinct()
    return docs.join(chosen, docs["doc_id"].cast("long").eqNullSafe(F.col("__id")), "left_semi")


def _sql_weight(level: str, weights: Mapping[str, int]) -> str:
    return f"CASE {level} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in weights.items()) + " ELSE 1 END" if weights else "1"


def _sql_level(depth: int, weights: Mapping[str, int]) -> str:
    keys, over = ", ".join(LEVELS[: depth + 1]), ", ".join(LEVELS[:depth])
    part = f"PARTITION BY {over} " if over else ""
    using = f"JOIN b{depth} USING ({over})" if over else f"CROSS JOIN b{depth}"
    return f"""c{depth} AS (SELECT {keys}, CAST(sum(supply) AS BIGINT) AS supply, CAST({_sql_weight(LEVELS[depth], weights)} AS BIGINT) AS weight FROM leaves GROUP BY {keys}),
r{depth} AS (SELECT *, budget - coalesce(sum(supply) OVER a, 0) AS lft, sum(weight) OVER f - coalesce(sum(weight) OVER a, 0) AS load
  FROM c{depth} {using} WINDOW f AS ({part}), a AS ({part}ORDER BY CAST(supply AS DOUBLE) / weight, {LEVELS[depth]} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
s{depth} AS (SELECT *, supply * load <= lft * weight AS short,
  arg_min(CASE WHEN supply * load > lft * weight THEN {{'l': lft, 'w': load}} END, CASE WHEN supply * load > lft * weight THEN {{'q': CAST(supply AS DOUBLE) / weight, 'n': {LEVELS[depth]}}} END) OVER ({part}) AS stop FROM r{depth}),
b{depth + 1} AS (SELECT {keys}, CAST(least(supply, CASE WHEN short THEN supply ELSE stop.l * weight // stop.w END) AS BIGINT) AS budget FROM s{depth})"""


# The domains of the sources src0 to src19 by the rule of ``default_domain``,
# which DuckDB has no function for.
def _sql_domain() -> str:
    import zlib

    names = ["", *(f"src{i}" for i in range(20))]
    return "CASE coalesce(source, '') " + " ".join(f"WHEN '{n}' THEN 'd{zlib.crc32(n.encode()) % 4}'" for n in names) + " END"


def oracle() -> str:
    return f"""WITH sized AS MATERIALIZED (SELECT doc_id, {_sql_domain()} AS domain, coalesce(lang, '') AS language, coalesce(source, '') AS source,
  len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS tokens FROM documents),
leaves AS (SELECT domain, language, source, CAST(sum(tokens) * {EPOCHS} AS BIGINT) AS supply FROM sized GROUP BY ALL),
b0 AS (SELECT CAST(coalesce(sum(tokens), 0) * {BUDGET_PERCENT} // 100 AS BIGINT) AS budget FROM sized),
{_sql_level(0, DOMAIN_WEIGHTS)},
{_sql_level(1, LANGUAGE_WEIGHTS)},
{_sql_level(2, {})},
stream AS (SELECT *, coalesce(sum(tokens) OVER (PARTITION BY domain, language, source ORDER BY epoch, md5('{SEED}:' || epoch || ':' || doc_id)
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM sized CROSS JOIN (SELECT unnest(range({EPOCHS})) AS epoch) WHERE tokens > 0)
SELECT domain, language, source, doc_id, CAST(epoch AS INTEGER) AS epoch, CAST(tokens AS BIGINT) AS tokens, CAST(start AS BIGINT) AS start,
  CAST(least(tokens, budget - start) AS BIGINT) AS taken FROM stream JOIN b3 USING (domain, language, source) WHERE start < budget"""
