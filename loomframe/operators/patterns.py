"""Frequent itemsets, rules and sequences."""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth, FPGrowthModel, PrefixSpan
from pyspark.sql import DataFrame, functions as F

from loomframe.operators.relational import item_key, lookup, top_k_per_key
from loomframe.session import materialise


#: Baskets of one task that meets them with rules, at most about.
TASK_BASKETS = 50_000


def baskets(df: DataFrame, basket: str, item: str, min_support: float | None = None) -> DataFrame:
    """``(basket, items)`` with distinct items.

    With ``min_support`` the items below it are left out before baskets are collected: they are in no frequent
    itemset, and what remains of a basket is then at most (mean basket size / support) items long, however
    many rows the basket had. Baskets that end up empty stay, as the support is a share of all baskets.
    """
    pairs = df.select(basket, item).distinct()
    if min_support is None:
        return pairs.groupBy(basket).agg(F.collect_list(item).alias("items"))
    pairs = materialise(pairs, "baskets")
    total = pairs.agg(F.count_distinct(basket)).first()[0]
    frequent = pairs.groupBy(item).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= F.ceil(F.lit(min_support * total)))
    marked = lookup(pairs, frequent, item)
    return marked.groupBy(basket).agg(F.collect_list(F.when(F.col("_n").isNotNull(), F.col(item))).alias("items"))


def mine(df: DataFrame, min_support: float, min_confidence: float, partitions: int | None = None) -> FPGrowthModel:
    """FP-growth over an ``items`` column."""
    stage = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence)
    if partitions:
        stage.setNumPartitions(partitions)
    return stage.fit(df)


def itemset_rows(model: FPGrowthModel) -> DataFrame:
    """``(items, size, freq)`` with items as an order-free text key."""
    return model.freqItemsets.select(item_key("items").alias("items"), F.size("items").alias("size"), "freq")


def rule_rows(model: FPGrowthModel) -> DataFrame:
    """``(antecedent, size, consequent, confidence, lift, support)`` with text keys."""
    return model.associationRules.select(
        item_key("antecedent").alias("antecedent"),
        F.size("antecedent").alias("size"),
        item_key("consequent").alias("consequent"),
        "confidence",
        "lift",
        "support",
    )


def implied_items(df: DataFrame, model: FPGrowthModel, key: str) -> DataFrame:
    """``df (key, items)`` with ``prediction``: consequents of all rules whose antecedent a basket holds, but for its own items.

    Baskets meet the rules on the antecedents' items, and a rule fires where as many of them met as it has; the rules
    stay a table, and no basket is tested against a rule that it shares nothing with. What meets is a row for each basket,
    rule and item, so baskets are dealt once, into parts of bounded size, and counted where they are.
    """
    rules = model.associationRules.select("antecedent", F.get("consequent", F.lit(0)).alias("_then"))
    rules = rules.withColumn("_rule", F.monotonically_increasing_id())
    parts = rules.select("_rule", F.size("antecedent").alias("_need"), "_then", F.explode("antecedent").alias("_item"))
    parts = materialise(parts, "rules")
    whole = materialise(df, "asked")
    dealt = whole.repartition(max(1, math.ceil(whole.count() / TASK_BASKETS)), key)
    held = dealt.select(key, F.explode("items").alias("_item")).distinct()
    met = lookup(held, parts, "_item", missing="drop").groupBy(key, "_rule", "_then", "_need").agg(F.count(F.lit(1)).alias("_met"))
    implied = met.where(F.col("_met") == F.col("_need")).groupBy(key).agg(F.collect_set("_then").alias("_implied"))
    own = held.groupBy(key).agg(F.collect_list("_item").alias("_own"))
    new = implied.join(own, key).select(key, F.array_sort(F.array_except("_implied", "_own")).alias("prediction"))
    joined = dealt.join(new, key, "left")
    return joined.withColumn("prediction", F.coalesce("prediction", F.slice("items", 1, 0)))


def also_viewed(model: FPGrowthModel, k: int = 5, ascending: bool = False) -> DataFrame:
    """``(item, rank, other, confidence)``: up to k consequents of every one-item antecedent, best first."""
    single = rule_rows(model).filter(F.col("size") == 1)
    top = top_k_per_key(single, "antecedent", "confidence", "consequent", k, ascending)
    rows = top.select(F.col("antecedent").alias("item"), F.posexplode("top").alias("place", "e"))
    return rows.select(
        "item",
        (F.col("place") + 1).alias("rank"),
        F.col("e.consequent").alias("other"),
        F.col("e.confidence").alias("confidence"),
    )


def frequent_sequences(df: DataFrame, min_support: float, max_length: int = 5, column: str = "sequence") -> DataFrame:
    """``(sequence, freq)`` over a column of itemset sequences."""
    stage = PrefixSpan(minSupport=min_support, maxPatternLength=max_length, sequenceCol=column)
    return stage.findFrequentSequentialPatterns(df)


def frequent_event_sequences(
    events: DataFrame, key: list[str], order: list[str], item: str, min_support: float, max_length: int = 5, per_shard: int = 100_000
) -> DataFrame:
    """``(pattern, freq)`` of single-item steps, straight from an event table.

    No sequence is ever collected. A pattern is kept per sequence as the earliest place it can end; one step
    longer is the earliest later event of each item. Only sequences of more than ``per_shard`` events are spread, over a
    join key for each so many of them, and minima are taken before the shuffle, so a sequence with a third of all
    events is no bottleneck and short ones carry one copy of their state.
    The per-sequence state is one row with at most as many ends as there are frequent patterns.
    """
    rows = events.select(*key, F.struct(*order).alias("_at"), F.col(item).alias("_item"))
    rows = materialise(rows, "events")
    sizes = rows.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / per_shard).cast("int").alias("_shards")).where("_shards > 1")
    sizes = materialise(sizes, "sizes")
    shards = F.coalesce("_shards", F.lit(1))
    rows = lookup(rows, sizes, key).withColumn("_shard", F.pmod(F.xxhash64("_at"), shards).cast("int")).drop("_shards")
    needed = F.ceil(F.lit(min_support) * F.lit(rows.select(*key).distinct().count()))
    ends = rows.groupBy(*key, F.array("_item").alias("pattern")).agg(F.min("_at").alias("_end"))
    levels = []
    for length in range(1, max_length + 1):
        ends = materialise(ends, "ends")
        counted = ends.groupBy("pattern").agg(F.count(F.lit(1)).alias("freq")).filter(F.col("freq") >= needed)
        counted = materialise(counted, "patterns")
        levels.append(counted)
        if length == max_length or counted.isEmpty():
            break
        alive = ends.join(counted.select("pattern"), "pattern", "left_semi")
        state = alive.groupBy(*key).agg(F.collect_list(F.struct("pattern", "_end")).alias("_state"))
        spread = lookup(state, sizes, key).withColumn("_shard", F.explode(F.sequence(F.lit(0), shards - 1))).drop("_shards")
        if length == 1:
            frequent_items = counted.select(F.col("pattern")[0].alias("_item"))
            rows = rows.join(frequent_items, "_item", "left_semi")
        reached = rows.join(spread, [*key, "_shard"]).select(*key, "_item", "_at", F.explode("_state").alias("_s"))
        later = reached.filter(F.col("_s._end") < F.col("_at"))
        ends = later.groupBy(*key, F.concat(F.col("_s.pattern"), F.array("_item")).alias("pattern")).agg(
            F.min("_at").alias("_end")
        )
    out = levels[0]
    for level in levels[1:]:
        out = out.unionByName(level)
    return out


def frequent_itemset_sequences(
    events: DataFrame, key: list[str], step: str, item: str, min_support: float, max_items: int = 3, per_shard: int = 100_000
) -> DataFrame:
    """``(pattern, freq)`` of sequences of itemsets, straight from an event table: the items of a key's equal ``step``
    are one itemset, and steps follow in their order.

    No sequence is collected. Kept are the steps at which a pattern's last itemset can stand in each sequence. An item
    more in that itemset is a join on the same step, with items in their order so that each itemset is met once; an
    itemset more is a join with the steps behind the earliest. Steps of sequences of more than ``per_shard`` events are
    spread over a join key for each so many of them. Rows with a null step or item are left out; repeated events count
    once. The support is a share of the sequences that are left.
    """
    rows = events.select(*key, F.col(step).alias("_at"), F.col(item).alias("_item")).where("_at IS NOT NULL AND _item IS NOT NULL")
    rows = materialise(rows.distinct(), "events")
    sizes = rows.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / per_shard).cast("int").alias("_shards")).where("_shards > 1")
    sizes = materialise(sizes, "sizes")
    shards = F.coalesce("_shards", F.lit(1))
    needed = max(1, math.ceil(min_support * rows.select(*key).distinct().count() - 1e-9))
    rows = lookup(rows, sizes, key).withColumn("_shard", F.pmod(F.xxhash64("_at"), shards).cast("int")).drop("_shards")
    at = [*key, "_shard", "_at"]
    ends = rows.select(*at, F.array(F.array("_item")).alias("pattern"))
    levels = []
    for size in range(1, max_items + 1):
        ends = materialise(ends, "ends")
        counted = ends.select(*key, "pattern").distinct().groupBy("pattern").agg(F.count(F.lit(1)).alias("freq"))
        counted = materialise(counted.where(F.col("freq") >= needed), "patterns")
        levels.append(counted)
        if size == max_items or counted.isEmpty():
            break
        ends = ends.join(counted.select("pattern"), "pattern", "left_semi")
        if size == 1:
            rows = materialise(rows.join(counted.select(F.col("pattern")[0][0].alias("_item")), "_item", "left_semi"), "events")
        last = F.element_at("pattern", -1)
        within = ends.join(rows, at).where(F.col("_item") > F.element_at(last, -1))
        grown = F.concat(F.slice("pattern", 1, F.size("pattern") - 1), F.array(F.concat(last, F.array("_item"))))
        within = within.select(*at, grown.alias("pattern"))
        first = ends.groupBy(*key, "pattern").agg(F.min("_at").alias("_first"))
        spread = lookup(first, sizes, key).withColumn("_shard", F.explode(F.sequence(F.lit(0), shards - 1))).drop("_shards")
        behind = rows.join(spread, [*key, "_shard"]).where(F.col("_at") > F.col("_first"))
        behind = behind.select(*at, F.concat("pattern", F.array(F.array("_item"))).alias("pattern"))
        ends = within.unionByName(behind)
    out = levels[0]
    for level in levels[1:]:
        out = out.unionByName(level)
    return out
