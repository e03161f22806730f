"""Mixing sources to target weights along a time-varying curriculum, with DataFrame functions only.

Every source has a weight schedule over training time t in [0, 1]: straight lines between equally spaced knots. Its
integral gives the source's target words; its running integral, inverted, turns "so many of this source's words have
come before" into the time, or position, of a document. Copies of documents are then range-sorted by position.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from loomframe.session import materialise

SEED = 11
WORD = r"[^\x20\x09-\x0D]+"


def words_in(text: str | Column) -> Column:
    """The number of words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text) if isinstance(text, str) else text, F.lit(WORD)), F.lit(0)).cast("long")


def _area(knots: Sequence[float]) -> float:
    return sum((a + b) / 2 for a, b in zip(knots, knots[1:])) / (len(knots) - 1) if len(knots) > 1 else knots[0]


def targets(sizes: DataFrame, share: float, cap: float) -> DataFrame:
    """Add ``target`` to ``sizes (source, source_size, weight)``, one row per source.

    All targets sum to ``share`` of all sizes, by weight; none is above ``cap`` times its source's size, and what a
    full source cannot take is shared among the others by weight. Sources fill in the order of size over weight: a
    source is full if the level it fills at is no higher than the level at which the rest is used up.
    """
    demand = F.lit(share) * F.sum("source_size").over(Window.partitionBy())
    fill = F.lit(cap) * F.col("source_size")
    # One row per source: a window over all of them is small however large the corpus is.
    order = Window.orderBy((F.col("source_size") / F.col("weight")), F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum(fill).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    weight_left = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    level = (demand - before) / weight_left
    full = F.when(fill <= level * F.col("weight"), True).otherwise(False)
    marked = sizes.withColumns({"_fill": fill, "_full": full, "_demand": demand})
    # Full sources are the first ones of the order, so what is left is a sum over all rows.
    left = F.col("_demand") - F.coalesce(F.sum(F.when(F.col("_full"), F.col("_fill"))).over(Window.partitionBy()), F.lit(0.0))
    rest = F.sum(F.when(~F.col("_full"), F.col("weight"))).over(Window.partitionBy())
    target = F.when(F.col("_full"), F.col("_fill")).otherwise(left * F.col("weight") / rest)
    return marked.withColumn("target", target).drop("_fill", "_full", "_demand")


def position(knots: Column, done: Column) -> Column:
    """The time at which a source has given the fraction ``done`` of its target: the inverse of its running integral.

    On a straight piece from weight a to weight b the integral is quadratic, so the time is a root of it.
    """
    pieces = F.size(knots) - 1
    area = F.transform(
        F.sequence(F.lit(0), F.greatest(pieces - 1, F.lit(0))),
        lambda i: F.when(pieces < 1, F.lit(1.0)).otherwise((knots[i] + knots[i + 1]) / 2),
    )
    whole = F.aggregate(area, F.lit(0.0), lambda s, x: s + x)
    wanted = done * whole
    upto = F.transform(
        F.sequence(F.lit(1), F.size(area)), lambda k: F.aggregate(F.slice(area, F.lit(1), k), F.lit(0.0), lambda s, x: s + x)
    )
    i = F.least(F.size(F.filter(upto, lambda c: c < wanted)), F.size(area) - 1)
    rest = F.greatest(wanted - F.when(i > 0, F.get(upto, i - 1)).otherwise(0.0), F.lit(0.0))
    a, b = knots[i], F.coalesce(F.get(knots, i + 1), knots[i])
    root = F.sqrt(F.greatest(a * a + 2 * (b - a) * rest, F.lit(0.0)))
    inside = F.when(pieces < 1, rest).when(a + root > 0, 2 * rest / (a + root)).otherwise(F.lit(0.0))
    return (i + F.least(inside, F.lit(1.0))) / F.greatest(pieces, F.lit(1))


def rank_of(key: str, text: str) -> Column:
    """A seeded hash of key and text below 2^60, from the digits of a digest that every SQL engine has."""
    seen = F.concat_ws("|", F.lit(SEED), F.coalesce(F.col(key).cast("string"), F.lit("")), F.coalesce(F.col(text), F.lit("")))
    return F.conv(F.substring(F.md5(seen), 1, 15), 16, 10).cast("long")


def measured(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """``(key, source, size, rank)``; equal keys are told apart by text. ``rank`` is a seeded hash that orders a source."""
    return docs.select(
        F.col(key).alias("key"), F.col(source).alias("source"), words_in(text).alias("size"), rank_of(key, text).alias("rank")
    )


def plan(sized: DataFrame, schedules: Sequence[Sequence[float]], share: float, cap: int) -> DataFrame:
    """``(key, source, size, rank, source_size, target, done, taken, copies, knots)`` of every row of :func:`measured`.

    Sources in code-point order (null last) take the schedules in turn. A source's documents come in the order of
    their hash, as often as the target asks: copy k of a document starts after k times the source's size and the
    words before it, and is taken whole if the middle of it lies below the target. So the words taken miss the target
    by half a document at most, and no document comes more than ``cap`` times. Sizes of 0 take nothing.
    """
    sized = materialise(sized, "sized")
    knots = F.array(*[F.array(*[F.lit(float(x)) for x in s]) for s in schedules])
    areas = F.array(*[F.lit(float(_area(s))) for s in schedules])
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = F.pmod(F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1, F.lit(len(schedules)))
    sizes = sizes.withColumn("_turn", turn).withColumns({"weight": areas[F.col("_turn")], "knots": knots[F.col("_turn")]})
    goals = targets(sizes, share, cap).drop("_turn", "weight")
    # Running sums in two steps: totals of (source, stretch of hashes), then inside each stretch. The hash is uniform,
    # so a source with any share of the rows is spread over all stretches.
    stretches = 4 * int(sized.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    stretch = F.floor(F.col("rank") / F.lit(float(1 << 60)) * F.lit(stretches))
    placed = sized.withColumn("_stretch", stretch)
    sums = placed.groupBy("source", "_stretch").agg(F.sum("size").alias("n"))
    earlier = Window.partitionBy("source").orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("source", "_stretch", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_offset"))
    offsets = offsets.join(goals, offsets["source"].eqNullSafe(goals["source"])).drop(goals["source"])
    on = placed["source"].eqNullSafe(offsets["source"]) & (placed["_stretch"] == offsets["_stretch"])
    joined = placed.join(offsets, on).drop(offsets["source"]).drop(offsets["_stretch"])
    inside = Window.partitionBy("source", "_stretch").orderBy("rank", "key", "size").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("_offset") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    out = joined.withColumn("done", before)
    return out.withColumn("copies", _copies(cap)).withColumn("taken", F.col("copies") * F.col("size")).drop("_stretch", "_offset")


def _copies(cap: int, of: Callable[[str], Column] = F.col) -> Column:
    """How often a row is taken that has ``done`` words of its source before it; ``of`` gives its columns by name."""
    middle = of("done") + of("size") / 2
    copies = F.ceil((of("target") - middle) / of("source_size"))
    return F.when(of("size") > 0, F.greatest(F.lit(0), F.least(F.lit(cap), copies))).otherwise(F.lit(0)).cast("int")


def _times(of: Callable[[str], Column] = F.col) -> Column:
    """``(position, copy)`` of each copy that a row of :func:`plan` is taken as; none for rows not taken."""
    passed = lambda copy: copy * of("source_size") + of("done") + of("size") / 2
    time = lambda copy: position(of("knots"), F.least(passed(copy) / of("target"), F.lit(1.0)))
    copies = F.filter(F.sequence(F.lit(0), of("copies")), lambda c: c < of("copies"))
    return F.transform(copies, lambda c: F.struct(time(c).alias("position"), c.alias("copy")))


def in_order(planned: DataFrame) -> DataFrame:
    """All rows of :func:`plan` with ``position``, that of their first copy, range-sorted by it, those not taken last."""
    planned = materialise(planned.withColumn("position", F.get(_times(), 0)["position"]), "planned")
    parts = int(planned.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("position").asc_nulls_last(), F.col("key").asc(), F.col("rank").asc()]
    return planned.repartitionByRange(parts, *order).sortWithinPartitions(*order)


def mixed(
    docs: DataFrame, schedules: Sequence[Sequence[float]], share: float, cap: int = 2,
    key: str = "doc_id", source: str = "source", text: str = "text", ordered: bool = True,
) -> DataFrame:
    """The training sequence: the columns of ``docs`` plus ``position`` and ``copy``, range-sorted by position if ``ordered``.

    A document comes once for each copy taken. Columns of ``docs`` named like the two are replaced. Documents without
    words are left out, as the mix counts words; an empty table gives an empty sequence.
    """
    planned = plan(measured(docs, key, source, text), schedules, share, cap).where("copies > 0")
    place = lambda rank, of: F.xxhash64(rank, of).alias("_place")
    # Repeated rows share hash and size and follow each other, so the first one's place gives those of all. Grouped like
    # this, and numbered by the same key below, the documents are dealt once.
    same = planned.groupBy(place("rank", "source"), "size", "source_size", "target", "knots").agg(F.min("done").alias("done"))
    firsts = same.select("_place", F.struct("done", "size", "source_size", "target", "knots").alias("_first"))
    firsts = materialise(firsts, "mix")
    columns = [f"`{c}`" for c in docs.drop("position", "copy").columns]
    rows = docs.select(*columns, place(rank_of(key, text), F.col(source)))
    rows = rows.withColumn("_nth", F.row_number().over(Window.partitionBy("_place").orderBy(F.lit(0))))
    first = lambda name: F.col(f"_first.{name}")
    kept = rows.join(firsts, "_place").withColumn("_done", first("done") + (F.col("_nth") - 1) * first("size"))
    shifted = lambda name: F.col("_done") if name == "done" else first(name)
    kept = kept.withColumn("_copies", _copies(cap, shifted))
    timed = lambda name: F.col("_copies") if name == "copies" else shifted(name)
    out = kept.withColumn("_t", F.explode(_times(timed))).select(*columns, "_t.position", "_t.copy")
    if not ordered:
        return out
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return out.repartitionByRange(parts, "position", key).sortWithinPartitions("position", key)
