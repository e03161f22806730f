"""A Merkle manifest of a table: trees per group under one root, and proofs by a recursive query.

Nodes are rows that link to their parents. A built level is stored for every eight: a node's row holds its ancestor
eight levels up (or the top of its tree), what stands before and after it at each level on the way, and that
ancestor's digest. A recursive query starts at every leaf, joins it with the row of the node it has reached, folds the
digest that it carries over the row's siblings and goes on from the ancestor, until there is no parent; each of its
rows holds the siblings of one step. So a proof takes a step per eight levels, and no step depends on how many leaves
a tree has.

Digests are SHA-256 of the lower-case hex text of the digests below, 32 bytes in tables. Runs have two nodes, the last
of a level may have one. Leaves are ordered by group, order column and digest, nulls first; equal rows are leaves of
their own, which differ in nothing but their place. All rows of a group of any size are spread: equal rows are counted
before they are ranked, ranks come from ranges, and the upper nodes that many leaves climb through have a copy for
every SHARE of them. A table without rows has no nodes and no proofs. Only the named columns are looked at.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from loomframe.llm.common import width
from loomframe.operators.ordering import running_totals
from loomframe.session import materialise

#: Levels between the stored ones; a block has 2 to that power of nodes.
STRIDE = 8
#: Leaves that climb through one copy of a node's row; equal leaves that are ranked as one row.
SHARE = 4096
#: The tree of the groups' roots.
TOP = -1
#: What a leaf holds.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def encoded_field(value: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, ``:``, value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*texts: Column) -> Column:
    """SHA-256 of texts one behind the other, as 32 bytes."""
    return F.unhex(F.sha2(F.concat(*texts), 256))


def hex_text(value: Column) -> Column:
    return F.lower(F.hex(value))


def leaf_digest(**changed: Column) -> Column:
    """The digest of a row of documents; named columns are replaced."""
    return digest(*[encoded_field(changed.get(c, F.col(c))) for c in FIELDS])


def ranked(leaves: DataFrame) -> DataFrame:
    """``(tree, idx, n, key, leaf, start)`` from ``(grp, key, leaf, start)``: every row's place in its group, of n rows.

    Trees are numbered in the order of the groups.
    """
    spark = leaves.sparkSession
    same = leaves.groupBy("grp", "key", "leaf").agg(F.min("start").alias("start"), F.count(F.lit(1)).alias("many"))
    cut = same.select("grp", "key", "leaf", "start", "many", F.explode(F.expr(f"sequence(0, many - 1, {SHARE})")).alias("at"))
    cut = cut.withColumn("many", F.least(F.lit(SHARE), F.col("many") - F.col("at")))
    order = [F.col(c).asc_nulls_first() for c in ("grp", "key", "leaf", "at")]
    ranged = cut.repartitionByRange(width(leaves), *order).withColumn("_range", F.spark_partition_id())
    rows = materialise(ranged, "merkle-ranges")
    counts = rows.groupBy("grp", "_range").agg(F.sum("many").alias("n"))
    groups = running_totals(counts.groupBy("grp").agg(F.sum("n").alias("n"), F.lit(1).cast("long").alias("one")), "grp", ["one"])
    groups = groups.select(F.col("grp").alias("_grp"), F.col("one_before").alias("tree"), F.col("n").alias("total"))
    earlier = Window.partitionBy("grp").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col("grp"), F.col("_range").alias("_r"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    # A row for each range and group that meet: ranges and groups together at most.
    offsets = offsets.join(groups, offsets["grp"].eqNullSafe(groups["_grp"])).select(F.col("grp").alias("_grp"), "_r", "before", "tree", "total")
    placed = rows.join(offsets, (rows["_range"] == offsets["_r"]) & rows["grp"].eqNullSafe(offsets["_grp"]))
    inside = Window.partitionBy("tree", "_range").orderBy(*order[1:]).rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("first", F.col("before") + F.coalesce(F.sum("many").over(inside), F.lit(0)))
    each = F.explode(F.expr("sequence(0, many - 1)"))
    out = placed.select("tree", "first", F.col("total").alias("n"), "key", "leaf", "start", each.alias("i"))
    return out.select("tree", (F.col("first") + F.col("i")).alias("idx"), "n", "key", "leaf", "start")


def _upper(row: Column) -> Column:
    """The level above: the digests of runs of two."""
    pairs = F.sequence(F.lit(0), F.floor((F.size(row) - 1) / 2).cast("int"))
    both = lambda i: digest(hex_text(F.get(row, i * 2)), F.coalesce(hex_text(F.get(row, i * 2 + 1)), F.lit("")))
    return F.transform(pairs, both)


def _way(i: Column, levels: Column) -> Column:
    """What stands before and after the i-th node and its ancestors, below the last of ``levels``."""

    def beside(k: Column) -> Column:
        at = F.call_function("shiftright", i, k)
        row = F.get(levels, k)
        odd = F.pmod(at, F.lit(2)) == 1
        before = F.when(odd, F.get(row, at - 1))
        return F.struct(before.alias("before"), F.when(~odd, F.get(row, at + 1)).alias("after"))

    below = F.slice(F.sequence(F.lit(0), F.size(levels) - 1), F.lit(1), F.size(levels) - 1)
    return F.transform(below, beside)


def blocks_of(nodes: DataFrame, level: int, name: str) -> DataFrame:
    """The nodes of one stored level in blocks, with the levels built above each; written to the shared folder.

    ``nodes`` are ``(tree, idx, n, digest, weight, key, start)``: n nodes in the tree's level, weight leaves below.
    """
    rows = F.sort_array(F.collect_list(F.struct("idx", "digest", "key", "start", "weight")))
    found = nodes.groupBy("tree", "n", F.expr(f"shiftright(idx, {STRIDE})").alias("block")).agg(rows.alias("nodes"), F.sum("weight").alias("weight"))
    closing = F.col("n") <= 1 << STRIDE
    rest = F.size("nodes") - 1
    rounds = F.when(~closing, F.lit(STRIDE)).when(rest > 0, F.length(F.bin(rest))).otherwise(F.lit(0))
    base = F.array(F.col("nodes.digest"))
    grown = F.aggregate(F.sequence(F.lit(1), F.col("rounds")), base, lambda acc, _: F.concat(acc, F.array(_upper(F.element_at(acc, -1)))))
    found = found.withColumn("rounds", rounds).withColumn("levels", F.when(F.col("rounds") > 0, grown).otherwise(base))
    parent = [
        F.when(~closing, F.col("tree")).when(F.col("tree") != TOP, F.lit(TOP)).cast("long").alias("parent_tree"),
        F.when(closing, F.lit(0)).otherwise(F.lit(level + STRIDE)).alias("parent_level"),
        F.when(closing, F.col("tree")).otherwise(F.col("block")).alias("parent_idx"),
    ]
    reached = F.get(F.element_at(F.col("levels"), -1), F.lit(0)).alias("reached")
    return materialise(found.select("tree", F.lit(level).alias("level"), "n", "block", "nodes", "weight", "levels", *parent, reached), name)


def node_rows(blocks: DataFrame) -> DataFrame:
    """Parent-linked rows of the nodes of blocks."""
    rows = blocks.select("*", F.posexplode("nodes").alias("i", "node"))
    return rows.select(
        "tree", "level", F.col("node.idx").alias("idx"), F.col("node.digest").alias("digest"), F.col("node.key").alias("key"),
        F.col("node.start").alias("start"), _way(F.col("i"), F.col("levels")).alias("way"), "parent_tree", "parent_level", "parent_idx",
        F.col("node.weight").alias("weight"), F.col("weight").alias("parent_weight"), "reached",
    )


def manifest(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(leaf rows, rows of the nodes above)`` from ``(grp, key, leaf, start)``, both in the shared folder.

    Leaf rows hold ``key`` and ``start``, the digest that their climb begins with (null: their own).
    """
    placed = ranked(leaves)
    nodes = placed.select("tree", "idx", "n", F.col("leaf").alias("digest"), F.lit(1).cast("long").alias("weight"), "key", "start")
    lowest, upper, roots = None, [], []
    for tree in ("groups", "top"):
        level = 0
        while level == 0 or not nodes.isEmpty():
            blocks = blocks_of(nodes, level, f"merkle-{tree}-{level}")
            if lowest is None:
                lowest = blocks
            else:
                upper.append(blocks)
            closed = F.col("n") <= 1 << STRIDE
            roots.append(blocks.where(closed).select("tree", "reached", "weight"))
            above = blocks.where(~closed).select("tree", F.col("block").alias("idx"), F.ceil(F.col("n") / (1 << STRIDE)).alias("n"), F.col("reached").alias("digest"), "weight")
            nodes = above.withColumns({"key": F.lit(None).cast("long"), "start": F.lit(None).cast("binary")})
            level += STRIDE
        if tree == "groups":
            every = roots[0]
            for more in roots[1:]:
                every = every.union(more)
            nodes = every.select(
                F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("idx"), F.lit(every.count()).alias("n"), F.col("reached").alias("digest"), "weight",
                F.lit(None).cast("long").alias("key"), F.lit(None).cast("binary").alias("start"),
            )
    links = node_rows(upper[0])
    for more in upper[1:]:
        links = links.union(node_rows(more))
    return materialise(node_rows(lowest), "merkle-leaves"), materialise(links.drop("key", "start"), "merkle-nodes")


@contextmanager
def _any_rows(spark: SparkSession):
    """Let recursive queries return any number of rows."""
    name = "spark.sql.cteRecursionRowLimit"
    old = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        yield
    finally:
        spark.conf.set(name, old)


#: A step's fold of a carried digest over what stands before and after, and what it appends to the proof.
FOLD = "aggregate(way, {carried}, (h, s) -> unhex(sha2(concat(lower(hex(coalesce(s.before, X''))), lower(hex(h)), lower(hex(coalesce(s.after, X'')))), 256)))"
APPEND = "aggregate(way, X'', (h, s) -> concat(h, coalesce(s.before, X''), coalesce(s.after, X'')))"
CLIMB = f"""
WITH RECURSIVE climb(tree, idx, step, key, leaf, at_tree, at_level, at_idx, copies, carried, siblings, reached) AS (
    SELECT tree, idx, 0, key, digest, parent_tree, parent_level, parent_idx, CAST(ceil(parent_weight / {SHARE}) AS BIGINT),
           {FOLD.format(carried="coalesce(start, digest)")}, {APPEND}, reached
    FROM {{leaves}}
    UNION ALL
    SELECT c.tree, c.idx, c.step + 1, CAST(NULL AS BIGINT), CAST(NULL AS BINARY), n.parent_tree, n.parent_level, n.parent_idx, n.parent_copies,
           {FOLD.format(carried="c.carried").replace("(way", "(n.way")}, {APPEND.replace("(way", "(n.way")}, n.reached
    FROM climb c JOIN {{nodes}} n
      ON c.at_tree = n.tree AND c.at_level = n.level AND c.at_idx = n.idx AND pmod(c.idx, c.copies) = n.copy
)
SELECT * FROM climb
"""


def climbed(leaves: DataFrame, nodes: DataFrame) -> DataFrame:
    """``(tree, idx, step, key, leaf, carried, siblings, reached, ...)``: every leaf's steps to the root.

    ``carried`` is the digest that the leaf's own climb has, ``reached`` the stored one, after the step; ``key`` and
    ``leaf`` stand in a leaf's first row. The rows are written to the shared folder.
    """
    spark = leaves.sparkSession
    copies = lambda weight: F.ceil(F.col(weight) / SHARE)
    linked = nodes.withColumn("parent_copies", copies("parent_weight")).withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), copies("weight") - 1)))
    rows = materialise(linked.select("tree", "level", "idx", "copy", "way", "parent_tree", "parent_level", "parent_idx", "parent_copies", "reached"), "merkle-links")
    with _any_rows(spark):
        return materialise(spark.sql(CLIMB, leaves=leaves, nodes=rows), "merkle-climb")


def proofs(docs: DataFrame, tampered: Column) -> DataFrame:
    """``(key, leaf, subroot, root, proof, folded_root, verified)`` of every row of documents, digests as 32 bytes.

    ``tampered`` is the digest that a row's climb begins with; where it is null, the row's own. ``proof`` holds the
    siblings one behind the other.
    """
    leaves = docs.select(F.col("lang").cast("string").alias("grp"), F.col("doc_id").cast("long").alias("key"), leaf_digest().alias("leaf"), tampered.alias("start"))
    steps = climbed(*manifest(leaves))
    last = F.col("at_tree").isNull()
    piece = F.when(F.length("siblings") > 0, F.struct("step", "siblings"))
    found = steps.groupBy("tree", "idx").agg(
        F.max("key").alias("key"),
        F.max("leaf").alias("leaf"),
        F.max(F.when((F.col("at_tree") == TOP) & (F.col("at_level") == 0), F.col("reached"))).alias("subroot"),
        F.max(F.when(last, F.col("reached"))).alias("root"),
        F.max(F.when(last, F.col("carried"))).alias("folded_root"),
        F.sort_array(F.collect_list(piece)).alias("pieces"),
    )
    proof = F.aggregate("pieces", F.lit(b""), lambda whole, p: F.concat(whole, p["siblings"])).alias("proof")
    return found.select("key", "leaf", "subroot", "root", proof, "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
