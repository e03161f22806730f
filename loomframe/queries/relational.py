"""Projections, filters, scalar expressions, joins, aggregates, sorts, splits, registered functions."""

from __future__ import annotations

from pyspark.ml.stat import Summarizer
from pyspark.sql import functions as F

from loomframe.functions import vectors as V
from loomframe.operators import ordering, relational as rel
from loomframe.queries.registry import none_broken, query, r6, table, violations


@query("rel_select", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def select(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")


@query(
    "rel_filter",
    "SELECT event_id, user_id, event_type, value FROM events WHERE event_type <> 'error' AND value > 20",
)
def filter_rows(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    return events.filter((F.col("event_type") != "error") & (F.col("value") > 20))


@query(
    "rel_where_eq_max",
    "SELECT p_partkey, p_brand, p_retailprice FROM part WHERE p_retailprice = (SELECT max(p_retailprice) FROM part)",
)
def where_eq_max(spark, sf):
    return rel.rows_at_max(table(spark, sf, "part").select("p_partkey", "p_brand", "p_retailprice"), "p_retailprice")


@query(
    "rel_cast_double",
    """SELECT o_orderkey, TRY_CAST(CASE WHEN o_orderstatus = 'P' THEN '' ELSE CAST(o_totalprice AS VARCHAR) END AS DOUBLE) AS amount,
              TRY_CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) AS priority FROM orders""",
)
def cast_double(spark, sf):
    text = table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", "").otherwise(F.col("o_totalprice").cast("string")).alias("amount"),
        F.substring("o_orderpriority", 1, 1).alias("priority"),
    )
    return rel.to_double(text, "amount", "priority")


@query(
    "rel_null_fill_mean",
    """WITH t AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_quantity END AS q,
                         CASE WHEN l_linestatus = 'F' THEN NULL ELSE l_tax END AS tax FROM lineitem)
       SELECT l_orderkey, l_linenumber, round(coalesce(q, (SELECT avg(q) FROM t)), 6) + 0.0 AS q,
              round(coalesce(tax, (SELECT avg(tax) FROM t)), 6) + 0.0 AS tax FROM t""",
)
def null_fill_mean(spark, sf):
    holes = table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_returnflag") != "N", F.col("l_quantity")).alias("q"),
        F.when(F.col("l_linestatus") != "F", F.col("l_tax")).alias("tax"),
    )
    filled = rel.fill_with_mean(holes, "q", "tax")
    return filled.withColumns({"q": r6("q"), "tax": r6("tax")})


@query(
    "rel_flag_encode",
    "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS finished FROM orders",
)
def flag_encode(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", rel.flag("o_orderstatus", "F").alias("finished"))


@query(
    "rel_band",
    """SELECT c_custkey, CASE WHEN c_acctbal > 5500 THEN 'rich' WHEN c_acctbal > 3000 THEN 'fair'
                              WHEN c_acctbal > 1800 THEN 'low' ELSE 'bare' END AS level FROM customer""",
)
def banded(spark, sf):
    bounds = [(5500.0, "rich"), (3000.0, "fair"), (1800.0, "low")]
    return table(spark, sf, "customer").select("c_custkey", rel.band("c_acctbal", bounds, "bare").alias("level"))


@query("rel_shift_category", "SELECT l_orderkey, l_linenumber - 1 AS slot FROM lineitem")
def shift_category(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", (F.col("l_linenumber") - 1).alias("slot"))


BASKET_KEYS_SQL = """SELECT l_orderkey, array_to_string(list_sort(list(DISTINCT p_type)), '_') AS items
                     FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1"""


def _basket_keys(spark, sf):
    pairs = table(spark, sf, "lineitem").join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    baskets = pairs.select("l_orderkey", "p_type").distinct().groupBy("l_orderkey")
    return baskets.agg(rel.item_key(F.collect_list("p_type")).alias("items"))


@query("rel_concat_items", BASKET_KEYS_SQL)
def concat_items(spark, sf):
    return _basket_keys(spark, sf)


@query(
    "rel_split_size",
    f"WITH b AS ({BASKET_KEYS_SQL}) SELECT l_orderkey, CAST(len(string_split(items, '_')) AS INTEGER) AS n_items FROM b",
)
def split_size(spark, sf):
    return _basket_keys(spark, sf).select("l_orderkey", F.size(F.split("items", "_")).alias("n_items"))


@query("rel_struct_field", "SELECT o_orderkey AS id_a, o_totalprice AS price_a, c_name AS name_b FROM orders JOIN customer ON o_custkey = c_custkey")
def struct_field(spark, sf):
    orders, customer = table(spark, sf, "orders"), table(spark, sf, "customer")
    pairs = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.struct("o_orderkey", "o_totalprice").alias("a"), F.struct("c_name").alias("b")
    )
    return pairs.select(
        F.col("a.o_orderkey").alias("id_a"), F.col("a.o_totalprice").alias("price_a"), F.col("b.c_name").alias("name_b")
    )


@query(
    "rel_with_column",
    "SELECT l_orderkey, l_linenumber, round(l_extendedprice * (1 - l_discount), 4) + 0.0 AS revenue FROM lineitem",
)
def with_column(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_discount")
    return lines.withColumn("revenue", r6(F.col("l_extendedprice") * (1 - F.col("l_discount")), 4)).drop(
        "l_extendedprice", "l_discount"
    )


@query("rel_rename", 'SELECT r_regionkey AS label, r_name AS sentence FROM region')
def rename(spark, sf):
    return table(spark, sf, "region").select("r_regionkey", "r_name").toDF("label", "sentence")


@query(
    "rel_sql_transform",
    """SELECT l_orderkey, l_linenumber, round(l_extendedprice * (1 - l_discount), 6) + 0.0 AS net_price,
              round(l_extendedprice * (1 - l_discount) * l_tax, 6) + 0.0 AS tax_due,
              CAST(floor(l_extendedprice / l_quantity) AS BIGINT) AS unit_price FROM lineitem""",
)
def sql_transform(spark, sf):
    """Net price, tax and unit price of every line, from one statement over whatever frame comes in."""
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"
    )
    statement = """
        WITH priced AS (SELECT l_orderkey, l_linenumber, l_tax, floor(l_extendedprice / l_quantity) AS unit_price,
                               l_extendedprice * (1 - l_discount) AS net_price FROM __THIS__)
        SELECT l_orderkey, l_linenumber, net_price, net_price * l_tax AS tax_due, unit_price FROM priced"""
    out = rel.sql_stage(lines, statement)
    return out.withColumns({c: r6(c) for c in ("net_price", "tax_due")})


@query(
    "rel_vector_build",
    """WITH e AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x FROM embeddings)
       SELECT vec_id, count(*) AS dense_size, round(sum(x), 6) + 0.0 AS dense_sum, count(*) FILTER (x > 0) AS sparse_entries,
              coalesce(round(sum(x) FILTER (x > 0), 6), 0) + 0.0 AS sparse_sum FROM e GROUP BY 1""",
)
def vector_build(spark, sf):
    rows = table(spark, sf, "embeddings").select("vec_id", V.array_vector("embedding").alias("dense"))
    cells = V.explode_vector(rows, ["vec_id"], "dense").filter(F.col("value") > 0)
    sparse = V.sparse_vectors(cells, "vec_id", "pos", "value", 64, "sparse")
    entries = V.explode_vector(sparse, ["vec_id"], "sparse", dense=False).groupBy("vec_id")
    stored = entries.agg(F.count(F.lit(1)).alias("sparse_entries"), r6(F.sum("value")).alias("sparse_sum"))
    total = F.aggregate(V.vector_array("dense"), F.lit(0.0), lambda acc, x: acc + x)
    dense = rows.select(
        "vec_id", F.size(V.vector_array("dense")).cast("bigint").alias("dense_size"), r6(total).alias("dense_sum")
    )
    # A vector without a positive entry has no cells to build from: an empty sparse vector.
    return dense.join(stored, "vec_id", "left").fillna({"sparse_entries": 0, "sparse_sum": 0.0})


@query(
    "join_pred_actual",
    """WITH actual AS (SELECT o_custkey AS u, l_partkey AS i, avg(l_quantity) AS actual FROM lineitem
                       JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2),
            predicted AS (SELECT o_custkey AS u, l_partkey AS i, max(l_linenumber)::DOUBLE AS predicted FROM lineitem
                       JOIN orders ON l_orderkey = o_orderkey WHERE l_discount > 0.05 GROUP BY 1, 2)
       SELECT u, i, round(predicted, 6) + 0.0 AS predicted, round(actual, 6) + 0.0 AS actual
       FROM predicted JOIN actual USING (u, i)""",
)
def pred_actual(spark, sf):
    rated = (
        table(spark, sf, "lineitem")
        .join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .select(F.col("o_custkey").alias("u"), F.col("l_partkey").alias("i"), "l_quantity", "l_linenumber", "l_discount")
    )
    actual = rated.groupBy("u", "i").agg(r6(F.avg("l_quantity")).alias("actual"))
    guess = rated.filter(F.col("l_discount") > 0.05).groupBy("u", "i")
    predicted = guess.agg(r6(F.max("l_linenumber").cast("double")).alias("predicted"))
    return rel.match_predictions(predicted, actual, ["u", "i"])


@query(
    "join_broadcast_lookup",
    """SELECT c_custkey, c_nationkey, n_name, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey""",
)
def broadcast_lookup(spark, sf):
    nation = table(spark, sf, "nation").join(
        table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    ).select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "r_name")
    customers = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    return rel.lookup(customers, nation, "c_nationkey", missing="error")


@query("agg_avg", "SELECT round(avg(l_extendedprice), 4) + 0.0 AS mean_price FROM lineitem")
def average(spark, sf):
    return table(spark, sf, "lineitem").agg(r6(F.avg("l_extendedprice"), 4).alias("mean_price"))


@query("agg_max", "SELECT max(l_extendedprice) AS max_price, max(l_shipdate) AS last_ship FROM lineitem")
def maximum(spark, sf):
    return table(spark, sf, "lineitem").agg(
        F.max("l_extendedprice").alias("max_price"), F.max("l_shipdate").cast("timestamp").alias("last_ship")
    )


@query("agg_count", "SELECT count(*) AS n FROM lineitem")
def count(spark, sf):
    return table(spark, sf, "lineitem").agg(F.count(F.lit(1)).alias("n"))


@query("agg_distinct", "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def distinct(spark, sf):
    return table(spark, sf, "lineitem").select("l_partkey", "l_suppkey").distinct()


@query(
    "agg_dictionary",
    "SELECT DISTINCT p_name, CAST(dense_rank() OVER (ORDER BY p_name) - 1 AS BIGINT) AS \"index\" FROM part",
)
def dictionary(spark, sf):
    return ordering.dictionary(table(spark, sf, "part"), "p_name")


@query(
    "agg_topk_per_key",
    """WITH s AS (SELECT l_suppkey, l_partkey, sum(l_quantity) AS qty FROM lineitem GROUP BY 1, 2),
            r AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY qty DESC, l_partkey) AS rn FROM s)
       SELECT l_suppkey, CAST(rn - 1 AS INTEGER) AS place, l_partkey, qty FROM r WHERE rn <= 5""",
)
def topk_per_key(spark, sf):
    sums = table(spark, sf, "lineitem").groupBy("l_suppkey", "l_partkey").agg(F.sum("l_quantity").alias("qty"))
    top = rel.top_k_per_key(sums, "l_suppkey", "qty", "l_partkey", 5)
    return top.select("l_suppkey", F.posexplode("top").alias("place", "e")).select(
        "l_suppkey", "place", "e.l_partkey", "e.qty"
    )


@query(
    "agg_vector_summary",
    """WITH e AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) - 1 AS pos,
                         1.0 + label AS w FROM embeddings),
            m AS (SELECT pos, avg(x) AS mean, var_samp(x) AS variance, sum(w * x) / sum(w) AS wmean, sum(w) AS sw,
                         sum(w * x * x) AS swxx, sum(w * w) AS sww FROM e GROUP BY 1)
       SELECT CAST(pos AS INTEGER) AS pos, round(mean, 6) + 0.0 AS mean, round(variance, 6) + 0.0 AS variance,
              round(wmean, 6) + 0.0 AS weighted_mean,
              round((swxx - sw * wmean * wmean) / (sw - sww / sw), 6) + 0.0 AS weighted_variance FROM m""",
)
def vector_summary(spark, sf):
    rows = table(spark, sf, "embeddings").select(
        V.array_vector("embedding").alias("features"), (F.lit(1.0) + F.col("label")).alias("w")
    )
    metrics = Summarizer.metrics("mean", "variance")
    stats = rows.agg(
        metrics.summary(F.col("features")).alias("plain"), metrics.summary(F.col("features"), F.col("w")).alias("weighted")
    )
    arrays = stats.select(
        F.arrays_zip(
            V.vector_array("plain.mean").alias("mean"),
            V.vector_array("plain.variance").alias("variance"),
            V.vector_array("weighted.mean").alias("weighted_mean"),
            V.vector_array("weighted.variance").alias("weighted_variance"),
        ).alias("z")
    )
    out = arrays.select(F.posexplode("z").alias("pos", "z")).select("pos", "z.*")
    return out.select("pos", *[r6(c).alias(c) for c in out.columns if c != "pos"])


@query("sort_take_best", "SELECT s_suppkey, s_acctbal FROM supplier ORDER BY s_acctbal, s_suppkey LIMIT 1")
def take_best(spark, sf):
    return table(spark, sf, "supplier").select("s_suppkey", "s_acctbal").orderBy("s_acctbal", "s_suppkey").limit(1)


@query("limit_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def limit_n(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return orders.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10)


@query("split_random", none_broken("orders"))
def random_split(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey")
    parts = rel.split_random(orders, [0.8, 0.2], seed=11)
    tagged = parts[0].withColumn("train", F.lit(1)).unionByName(parts[1].withColumn("train", F.lit(0)))
    seen = tagged.groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("n"))
    return violations(seen, F.col("n") != 1)


@query(
    "split_by_key",
    """SELECT CASE WHEN o_orderkey % 10 < 8 THEN 'train' ELSE 'test' END AS part, count(*) AS n,
              round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1""",
)
def key_split(spark, sf):
    train, test = rel.split_by_modulus(table(spark, sf, "orders"), "o_orderkey", 10, 8)
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return both.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query(
    "udf_register_call",
    r"""SELECT doc_id, CAST(len(string_split_regex(regexp_replace(lower(text), '[ \t\n\x0B\f\r]+$', ''), '[ \t\n\x0B\f\r]')) AS INTEGER) AS tokens
        FROM documents""",
)
def register_call(spark, sf):
    """A registered SQL function: it is inlined into the plan, so no token leaves the JVM."""
    spark.sql(
        r"""CREATE OR REPLACE TEMPORARY FUNCTION countTokens(line STRING) RETURNS INT
            RETURN size(split(regexp_replace(lower(line), '\\s+$', ''), '\\s'))"""
    )
    return table(spark, sf, "documents").select("doc_id", F.call_function("countTokens", F.col("text")).alias("tokens"))
