"""Filters, casts, encodings, lookups and grouped reductions on plain columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import SQLTransformer
from pyspark.sql import Column, DataFrame, Window, functions as F

BROADCAST_ROWS = 100_000


def to_double(df: DataFrame, *columns: str) -> DataFrame:
    """Text columns to doubles; text that is no number becomes null."""
    return df.withColumns({c: F.col(c).try_cast("double") for c in columns})


def fill_with_mean(df: DataFrame, *columns: str) -> DataFrame:
    """Replace nulls by the column mean (a scalar subquery, one aggregate for each column)."""
    return df.withColumns({c: F.coalesce(F.col(c), df.agg(F.avg(c)).scalar()) for c in columns})


def flag(column: str, value) -> Column:
    """1.0 where the column equals ``value``, else 0.0."""
    return F.when(F.col(column) == F.lit(value), 1.0).otherwise(0.0)


def band(column: str, lower_bounds: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """Name of the first band whose exclusive lower bound the value exceeds, highest bound first."""
    ordered = sorted(lower_bounds, key=lambda bound: -bound[0])
    chain = F.when(F.col(column) > ordered[0][0], ordered[0][1])
    for bound, name in ordered[1:]:
        chain = chain.when(F.col(column) > bound, name)
    return chain.otherwise(otherwise)


def item_key(items: str | Column, sep: str = "_") -> Column:
    """Order-free text key of an item array."""
    return F.concat_ws(sep, F.array_sort(items))


def rows_at_max(df: DataFrame, column: str) -> DataFrame:
    """All rows where ``column`` reaches its maximum."""
    return df.filter(F.col(column) == df.agg(F.max(column)).scalar())


def sql_stage(df: DataFrame, statement: str) -> DataFrame:
    """A SQL statement over ``__THIS__`` as a transformer."""
    return SQLTransformer(statement=statement).transform(df)


def small_enough(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows; reads no more than one row beyond that."""
    return df.limit(max_rows + 1).count() <= max_rows


def lookup(
    fact: DataFrame, dim: DataFrame, on: str | Sequence[str], missing: str = "null", max_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Attach dictionary columns to a fact table.

    The dictionary is broadcast when its checked size allows; past that bound the planner shuffles both
    sides and AQE splits skewed keys. ``missing`` is ``null``, ``drop`` or ``error``.
    """
    keys = [on] if isinstance(on, str) else list(on)
    extra = [c for c in dim.columns if c not in keys]
    side = dim
    if missing == "error":
        side = side.withColumn("_hit", F.lit(True))
    if small_enough(dim, max_rows):
        side = F.broadcast(side)
    joined = fact.join(side, keys, "inner" if missing == "drop" else "left")
    if missing != "error":
        return joined
    text = F.concat_ws(",", *[F.col(k).cast("string") for k in keys])
    fail = F.raise_error(F.concat(F.lit("no dictionary entry for "), text))
    first = extra[0]
    kind = dim.schema[first].dataType
    checked = joined.withColumn(first, F.when(F.col("_hit").isNull(), fail.cast(kind)).otherwise(F.col(first)))
    return checked.drop("_hit")


def match_predictions(predicted: DataFrame, actual: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join of predicted and actual values on a compound key."""
    return predicted.join(actual, list(keys))


def top_k_per_key(
    df: DataFrame, key: str | Sequence[str], score: str, item: str, k: int = 5, ascending: bool = False
) -> DataFrame:
    """The ``k`` best-scored items of every key as an ordered list of ``(item, score)``.

    Rank-and-filter lets Spark cut each task's rows to ``k`` per key before the shuffle, so a hot key
    costs ``k`` rows per task. Equal scores are ordered by item.
    """
    keys = [key] if isinstance(key, str) else list(key)
    order = [F.col(score).asc() if ascending else F.col(score).desc(), F.col(item).asc()]
    ranked = df.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(
        F.col("rank") <= k
    )
    packed = ranked.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("rank", item, score))).alias("_top"))
    return packed.select(
        *keys, F.transform("_top", lambda e: F.struct(e[item].alias(item), e[score].alias(score))).alias("top")
    )


def split_by_key(df: DataFrame, key: str, train_share: float = 0.8, buckets: int = 100) -> tuple[DataFrame, DataFrame]:
    """Train and test parts by hash of the key: the same on any partitioning."""
    slot = F.pmod(F.xxhash64(F.col(key).cast("bigint")), F.lit(buckets))
    cut = round(train_share * buckets)
    return df.filter(slot < cut), df.filter(slot >= cut)


def split_by_modulus(df: DataFrame, key: str, modulus: int, train: int) -> tuple[DataFrame, DataFrame]:
    """Train and test parts by the remainder of an integer key."""
    slot = F.pmod(F.col(key), F.lit(modulus))
    return df.filter(slot < train), df.filter(slot >= train)


def split_random(df: DataFrame, weights: Sequence[float], seed: int) -> list[DataFrame]:
    """Weighted random parts."""
    return df.randomSplit(list(weights), seed=seed)
