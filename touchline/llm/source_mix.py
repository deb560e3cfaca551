"""Mixing sources to target weights by hierarchical budgeting.

Leaves are the combinations of the levels' values (domain, language, source), and every value of a level has a weight
among its siblings. The budget of tokens goes down the tree: each node divides what it gets among its children by
weight. A child that has too little (its tokens times ``max_epochs``, over all its leaves) takes what it has, and the
shortage goes to its siblings by weight; only what all siblings cannot take stays with the parent's siblings, since
the parent's own supply was counted before. Within a level this is water filling, solved with sums over siblings in
order of supply per weight.

A leaf that gets more than its tokens is repeated: whole epochs first, then a prefix of the next one. An epoch is the
leaf's documents in the order of a hash of seed, epoch and id. The prefix is found in three steps: tokens are summed by
ranges of the hash, so that a range holds about ``RANGE_ROWS`` documents; ranges are summed by blocks of
``BLOCK_RANGES`` neighbours; and only the range where the budget ends is summed document by document. So no task holds a
leaf or all ranges of one, also where one has a third of all rows: with seventy billion documents in a leaf, a running
sum is over some 4,096 blocks, 4,096 ranges or 4,096 documents.

All amounts are whole numbers. Divisions round down, so at most one token for each child is left over. All is done in
columns: no Python in tasks; nothing but the number of rows and tokens comes to the driver.

Null texts have no tokens; such documents are never in the prefix's way and come with whole epochs. Null level values
are a value of their own. Values without a stated weight have weight 1; weight 0 excludes. Documents with equal ids
are taken in order of a hash of their text; rows that repeat get equal copies.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.llm.common import SPACES, staged

SEED = 42
MAX_EPOCHS = 2
#: Documents that one range of the hash holds, about.
RANGE_ROWS = 4096
#: Ranges that are summed together before the running sum over a leaf.
BLOCK_RANGES = 4096
#: Hexadecimal digits of the hash that ranges are made of.
_DIGITS = 8
_SPACE = 16**_DIGITS


def n_tokens(text: str) -> Column:
    """Words of a text."""
    return F.size(F.filter(F.split(F.coalesce(F.col(text), F.lit("")), SPACES), lambda word: word != "")).cast("long")


def _weight(level: str, weights: Mapping[str, int]) -> Column:
    found = F.lit(None).cast("long")
    for value, weight in weights.items():
        found = F.when(F.col(level) == value, F.lit(int(weight)).cast("long")).otherwise(found)
    return F.coalesce(found, F.lit(1).cast("long"))


def _join_same(left: DataFrame, right: DataFrame, names: list[str]) -> DataFrame:
    """Inner join on columns that are equal or both null; ``right`` adds its other columns."""
    renamed = right.withColumnsRenamed({name: f"_of_{name}" for name in names})
    same = [F.col(name).eqNullSafe(F.col(f"_of_{name}")) for name in names]
    return left.join(renamed, same).drop(*[f"_of_{name}" for name in names])


def budgets(
    leaves: DataFrame, levels: Mapping[str, Mapping[str, int]], total: Column, max_epochs: int = MAX_EPOCHS
) -> DataFrame:
    """Add ``budget`` to the leaves (the levels' columns and ``tokens``). ``total`` is the whole budget.

    Work is on one row per leaf or inner node, never on documents.
    """
    names = list(levels)
    supply = leaves.withColumn("_supply", F.col("tokens") * max_epochs)
    for name, weights in levels.items():
        supply = supply.withColumn(f"_w_{name}", _weight(name, weights))
    # Leaves under a weight of zero supply nothing.
    allowed = F.lit(True)
    for name in names:
        allowed = allowed & (F.col(f"_w_{name}") > 0)
    supply = supply.withColumn("_supply", F.when(allowed, F.col("_supply")).otherwise(0))
    given = None
    for depth, name in enumerate(names, 1):
        parents = names[: depth - 1]
        nodes = supply.groupBy(*names[:depth]).agg(
            F.sum("_supply").alias("_supply"), F.first(f"_w_{name}").alias("_weight")
        )
        if given is None:
            nodes = nodes.withColumn("_from", total.cast("long"))
        else:
            nodes = _join_same(nodes, given.withColumnRenamed("_given", "_from"), parents)
        given = _water_filled(nodes, parents, names[:depth])
    return _join_same(leaves, given.withColumnRenamed("_given", "budget"), names)


def _water_filled(nodes: DataFrame, parents: list[str], path: list[str]) -> DataFrame:
    """Divide ``_from`` among the nodes of each parent by ``_weight``, none above its ``_supply``."""
    wide = "decimal(38,0)"
    part = Window.partitionBy(*parents) if parents else Window.partitionBy(F.lit(0))
    # Supply per weight in order, compared exactly enough: ties and near ties fill alike.
    fill = F.col("_supply").cast("double") / F.nullif(F.col("_weight"), F.lit(0))
    order = part.orderBy(F.coalesce(fill, F.lit(-1.0)), *path)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    ranked = nodes.select(
        "*",
        (F.col("_from") - F.coalesce(F.sum("_supply").over(before), F.lit(0))).alias("_left"),
        (F.sum("_weight").over(part) - F.coalesce(F.sum("_weight").over(before), F.lit(0))).alias("_weights"),
    )
    # A node is full if an equal level for it and all after it would exceed what it has. In this order the full ones
    # come first.
    full = F.col("_supply").cast(wide) * F.col("_weights") <= F.col("_weight").cast(wide) * F.greatest("_left", F.lit(0))
    marked = ranked.withColumn("_full", full)
    open_ = lambda name: F.when(~F.col("_full"), F.col(name))
    spread = marked.select(
        "*",
        F.max(open_("_left")).over(part).alias("_open_left"),
        F.max(open_("_weights")).over(part).alias("_open_weights"),
    )
    share = F.expr("cast(cast(_weight as decimal(38,0)) * greatest(_open_left, 0L) div _open_weights as bigint)")
    given = F.when(F.col("_weight") == 0, F.lit(0)).when(F.col("_full"), F.col("_supply")).otherwise(share)
    return spread.select(*path, given.cast("long").alias("_given"))


def _sum_before(value: str, part: list[str], order: str) -> Column:
    """The sum of a column over the rows before this one in its part."""
    before = Window.partitionBy(*part).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(before), F.lit(0).cast("long"))


def mix(
    docs: DataFrame,
    levels: Mapping[str, Mapping[str, int]],
    total_tokens: int | None = None,
    share: tuple[int, int] = (1, 1),
    max_epochs: int = MAX_EPOCHS,
    seed: int = SEED,
    key: str = "doc_id",
    text: str = "text",
    keep: list[str] | None = None,
) -> DataFrame:
    """The key, the columns ``keep``, the levels, ``n_tokens`` and ``copies``: how often a document is in the mixture.

    The budget is ``total_tokens``, or the fraction ``share`` of all tokens there are. Kept columns may have any name; one
    called ``n_tokens`` or ``copies`` comes back as ``kept_n_tokens`` or ``kept_copies``. An empty table has an empty mixture.
    """
    names = list(levels)
    others = [name for name in dict.fromkeys(keep or []) if name not in (key, *names)]
    # In one column, so that no name clashes with those used here.
    packed = [F.struct(*others).alias("_kept")] if others else []
    columns = [*dict.fromkeys([key, *names]), *(["_kept"] if others else [])]
    rows = staged(
        docs.select(
            *dict.fromkeys([key, *names]), *packed, n_tokens(text).alias("n_tokens"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("_text_hash")
        ),
        "mix-rows",
    )
    leaves = rows.groupBy(*names).agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("_rows"))
    leaves = staged(leaves, "mix-leaves")
    every = leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    total = F.lit(total_tokens if total_tokens is not None else every * share[0] // share[1]).cast("long")
    planned = budgets(leaves, levels, total, max_epochs)
    plan = planned.select(
        *names,
        F.expr("if(tokens > 0, budget div tokens, 0L)").alias("_whole"),
        F.expr("if(tokens > 0, budget % tokens, 0L)").alias("_rest"),
        # Ranges of the hash, each with about RANGE_ROWS documents of this leaf.
        F.ceil(F.col("_rows") / RANGE_ROWS).cast("long").alias("_ranges"),
    )
    plan = staged(plan, "mix-plan")
    joined = _join_same(rows, plan, names)
    # The order in the epoch after the whole ones.
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("_whole"), F.coalesce(F.col(key).cast("string"), F.lit(""))))
    ordered = joined.withColumn("_order", digest).withColumn(
        "_range",
        (F.conv(F.substring("_order", 1, _DIGITS), 16, 10).cast("long") * F.col("_ranges") / _SPACE).cast("long"),
    )
    ordered = staged(ordered, "mix-ordered")
    sums = ordered.groupBy(*names, "_range").agg(F.sum("n_tokens").alias("_in_range"), F.first("_rest").alias("_rest"))
    sums = staged(sums.withColumn("_block", F.floor(F.col("_range") / BLOCK_RANGES)), "mix-sums")
    blocks = sums.groupBy(*names, "_block").agg(F.sum("_in_range").alias("_in_block"))
    blocks = blocks.select(*names, "_block", _sum_before("_in_block", names, "_block").alias("_before_block"))
    sums = _join_same(sums, blocks, [*names, "_block"])
    in_block = _sum_before("_in_range", [*names, "_block"], "_range")
    sums = sums.withColumn("_before", F.col("_before_block") + in_block)
    # Whether a range is in the prefix: all of it, none of it, or up to what is left at its beginning.
    sums = sums.select(
        *names,
        "_range",
        (F.col("_rest") - F.col("_before")).alias("_room"),
        (F.col("_before") + F.col("_in_range") <= F.col("_rest")).alias("_all"),
    )
    placed = _join_same(ordered, sums, [*names, "_range"])
    ends = ~F.col("_all") & (F.col("_room") >= 0)
    within = Window.partitionBy(*names, "_range").orderBy("_order", "_text_hash").rangeBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    kept = [F.col("_kept")[name].alias(f"kept_{name}" if name in ("n_tokens", "copies") else name) for name in others]
    result = [key, *kept, *[name for name in names if name != key], "n_tokens"]
    easy = placed.where(~ends).select(*result, (F.col("_whole") + F.col("_all").cast("long")).alias("copies"))
    hard = placed.where(ends).withColumn("_upto", F.sum("n_tokens").over(within))
    hard = hard.select(*result, (F.col("_whole") + (F.col("_upto") <= F.col("_room")).cast("long")).alias("copies"))
    return easy.unionByName(hard)


#: Weights of the registered query. Domains group the sources by the last digit of their number.
DOMAIN_WEIGHTS = {"web": 4, "news": 3, "books": 2, "code": 1}
LANGUAGE_WEIGHTS = {"en": 5, "de": 2, "fr": 2, "es": 1}
LEVELS = {"domain": DOMAIN_WEIGHTS, "lang": LANGUAGE_WEIGHTS, "source": {}}


def with_domain(docs: DataFrame) -> DataFrame:
    """Add the ``domain`` of a document's source: by its number's remainder by four; ``other`` without a number."""
    number = F.regexp_extract(F.coalesce("source", F.lit("")), r"([0-9]{1,9})$", 1)
    remainder = F.when(number != "", number.cast("int") % 4)
    domain = F.coalesce(F.get(F.array(*map(F.lit, DOMAIN_WEIGHTS)), remainder), F.lit("other"))
    return docs.withColumn("domain", domain)
