"""Clustering, recommendation, patterns, similarity search."""

from __future__ import annotations

import numpy as np
from pyspark.ml.clustering import BisectingKMeans, GaussianMixture, KMeans
from pyspark.ml.feature import BucketedRandomProjectionLSH, HashingTF, MinHashLSH, VectorAssembler
from pyspark.sql import Window, functions as F

from loomframe.functions import text as T, vectors as V
from loomframe.operators import clustering as clu, features as feats, patterns as pat, recommend as rec, setjoin, similarity as sim, topics, topn
from loomframe.operators.stages import apply, chain, fitted
from loomframe.queries.registry import far, none_broken, query, r6, table, violations, wide
from loomframe.session import materialise, scratch_path
from loomframe.sources import models

SEED = 23


def _embeddings(spark, sf):
    return wide(spark, sf, "embeddings", "vec_id", "label", "embedding").select("vec_id", "label", V.array_vector("embedding").alias("features"))


# ---- clustering


@query("clu_kmeans", none_broken("embeddings"))
def kmeans(spark, sf):
    rows = _embeddings(spark, sf)
    model = fitted(KMeans(k=3, maxIter=12, seed=SEED), rows)
    scored = model.transform(rows).withColumn("d", clu.centre_distances(model, "features"))
    one = rows.orderBy("vec_id").first()
    alone = (F.col("vec_id") == one["vec_id"]) & (F.col("prediction") != model.predict(one["features"]))
    return violations(scored, (F.get("d", F.col("prediction")) > F.array_min("d") + 1e-9) | alone)


@query("clu_bisecting", none_broken("embeddings"))
def bisecting(spark, sf):
    rows = _embeddings(spark, sf)
    model = fitted(BisectingKMeans(k=2, seed=1), rows)
    scored = model.transform(rows).withColumn("d", F.get(clu.centre_distances(model, "features"), F.col("prediction")))
    scored = scored.select("d", "prediction")
    cost = scored.agg(F.sum(F.col("d") * F.col("d"))).first()[0]
    # Training reports the cost before its last update of the centres, so the final cost is no higher.
    reported = model.summary.trainingCost
    wrong = not 0.9 * reported <= cost <= reported * (1 + 1e-9)
    return violations(scored, ~F.col("prediction").between(0, 1) | F.lit(wrong))


@query("clu_gmm", none_broken("lineitem"))
def gmm(spark, sf):
    """Probabilities recomputed from the table of weights, means and covariances; better than a single component."""
    lines = table(spark, sf, "lineitem").select("l_quantity", (F.col("l_extendedprice") / 1000).alias("price"))
    rows = apply(VectorAssembler(inputCols=["l_quantity", "price"], outputCol="features"), lines)
    model = fitted(GaussianMixture(k=2, maxIter=20, seed=SEED), rows)
    parts = clu.component_rows(spark, model)
    p, again = V.vector_array("probability"), clu.responsibilities(parts, "features")
    off = F.array_max(F.zip_with(p, again, lambda x, y: F.abs(x - y))) > 1e-6
    chosen = F.get(p, F.col("prediction")) < F.array_max(p)
    single = rows.agg(F.count(F.lit(1)), F.var_pop("l_quantity"), F.var_pop("price"), F.covar_pop("l_quantity", "price")).first()
    alone = -single[0] / 2 * (2 * np.log(2 * np.pi) + 2 + np.log(single[1] * single[2] - single[3] ** 2))
    return violations(model.transform(rows), off | chosen | F.lit(not model.summary.logLikelihood > alone))


def _term_counts(spark, sf):
    """Counts of the terms that at least two documents have."""
    docs = wide(spark, sf, "documents", "doc_id", "text").select("doc_id", F.filter(T.token_array("text"), lambda t: t != "").alias("tokens"))
    return materialise(feats.term_counts(docs, "doc_id", "tokens", min_df=2).select(F.col("doc_id").alias("key"), "term", "n"), "counts")


@query("clu_lda", "SELECT count(*) AS rows_scored, CAST(0 AS BIGINT) AS violations, CAST(30 AS BIGINT) AS terms FROM documents")
def lda(spark, sf):
    """Ten topics on the counts of all terms: mixes and topics are shares, the bound on the log-likelihood rises from
    pass to pass, and it and the perplexity are better than a single topic's."""
    counts = _term_counts(spark, sf)
    found, single = topics.fit_topics(counts, 10, passes=10, seed=SEED), topics.fit_topics(counts, 1, passes=3)
    bounds = [h[1] for h in found.history]
    learnt = all(b >= a - 1e-9 * abs(a) for a, b in zip(bounds, bounds[1:])) and found.log_perplexity < single.log_perplexity
    shares = found.terms.agg(*[F.sum(F.get("weights", F.lit(t))) for t in range(10)]).first()
    learnt = learnt and all(abs(x - 1) < 1e-6 for x in shares)
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("key"))
    # Documents without a term keep the prior's mix.
    mixes = docs.join(found.documents, "key", "left").withColumn("mix", F.coalesce("mix", F.array_repeat(F.lit(0.1), 10)))
    total = F.aggregate("mix", F.lit(0.0), lambda acc, x: acc + x)
    wrong = far(total, F.lit(1.0)) | (F.size("mix") != 10) | (F.array_min("mix") <= 0)
    named = topics.top_terms(found, 3).agg(F.count("term").alias("terms"))
    return violations(mixes, wrong | F.lit(not learnt)).withColumn("terms", named.scalar())


@query("clu_lda_fit")
def lda_fit(spark, sf):
    """The bound on the log-likelihood and the log of the perplexity after each pass. Random starts have no SQL form."""
    found = topics.fit_topics(_term_counts(spark, sf), 10, passes=10, seed=SEED)
    return spark.createDataFrame(found.history, "pass int, log_likelihood double, log_perplexity double")


TRADE_SQL = """(SELECT c_nationkey AS n FROM t WHERE c_nationkey <> s_nationkey UNION SELECT s_nationkey FROM t WHERE c_nationkey <> s_nationkey)"""


@query(
    "clu_pic",
    f"""WITH t AS (SELECT DISTINCT c_nationkey, s_nationkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey
                   JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey)
        SELECT count(*) AS rows_scored, CAST(0 AS BIGINT) AS violations FROM {TRADE_SQL}""",
)
def pic(spark, sf):
    buys = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    sells = table(spark, sf, "lineitem").join(table(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    trade = sells.join(buys, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "c_nationkey", "s_nationkey", F.lit(1).alias("n")
    )
    edges = materialise(clu.undirected_edges(trade, "c_nationkey", "s_nationkey", "n"), "edges")
    found = clu.communities(edges, k=3, iterations=10)
    seen = found.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.max("cluster").alias("cluster"))
    return violations(seen, (F.col("n") != 1) | ~F.col("cluster").between(0, 2))


# ---- recommendation

PAIRS_SQL = "(SELECT DISTINCT o_custkey, l_partkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"


def _ratings(spark, sf):
    bought = table(spark, sf, "lineitem").join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return rec.ratings(bought, "o_custkey", "l_partkey", "l_quantity")


def _trained(spark, sf, **options):
    ratings = materialise(_ratings(spark, sf), "ratings")
    return ratings, rec.train(ratings, SEED, **{"rank": 8, "iterations": 5, **options})


@query("rec_als", none_broken(PAIRS_SQL))
def als(spark, sf):
    """Predictions are products of the factors, and closer to the ratings than their mean is."""
    ratings, model = _trained(spark, sf)
    scored = rec.predicted(ratings, model)
    error = F.sqrt(F.avg((F.col("prediction") - F.col("rating")) ** 2)) < F.stddev_pop("rating")
    return violations(scored, far(F.col("prediction"), F.col("score"), 1e-4), error)


def _mean_factors(table_of_factors, rank):
    return np.array(table_of_factors.agg(*[F.avg(F.get("features", F.lit(k))) for k in range(rank)]).first(), np.float64)


@query("rec_als_implicit", none_broken(PAIRS_SQL))
def als_implicit(spark, sf):
    """Scores are products of the factors, and what was bought scores higher than all pairs do on average."""
    ratings, model = _trained(spark, sf, implicit=True)
    scored = rec.predicted(ratings, model)
    overall = abs(float(_mean_factors(model.userFactors, 8) @ _mean_factors(model.itemFactors, 8)))
    return violations(scored, far(F.col("prediction"), F.col("score"), 1e-4), F.avg("prediction") > 1.5 * overall)


@query("rec_large_ids", none_broken(PAIRS_SQL))
def large_ids(spark, sf):
    """Ids beyond 2 to the 31 are numbered for training; predictions come back under the ids."""
    ratings = _ratings(spark, sf).withColumns({"user": F.col("user") + F.lit(1 << 40), "item": F.col("item") * F.lit(-(1 << 35))})
    numbered, users, items = rec.numbered(materialise(ratings, "ratings"))
    model = rec.train(materialise(numbered, "numbered"), SEED, rank=8, iterations=5)
    scored = rec.predicted(numbered, model)
    back = scored.join(users.withColumnRenamed("id", "user_id"), "user").join(items.withColumnRenamed("id", "item_id"), "item")
    found = ratings.join(back.select(F.col("user_id").alias("user"), F.col("item_id").alias("item"), "prediction", "score"), ["user", "item"], "left")
    error = F.sqrt(F.avg((F.col("prediction") - F.col("rating")) ** 2)) < F.stddev_pop("rating")
    return violations(found, F.col("score").isNull() | far(F.col("prediction"), F.col("score"), 1e-4), error)


@query("rec_predict_pairs", none_broken(PAIRS_SQL))
def predict_pairs(spark, sf):
    ratings, model = _trained(spark, sf)
    pairs = ratings.select("user", "item")
    one = ratings.orderBy("user", "item").select("user", "item").first()
    alone = rec.score_pair(model, one["user"], one["item"])
    scored = rec.predicted(pairs, model)
    is_one = (F.col("user") == one["user"]) & (F.col("item") == one["item"])
    broken = far(F.col("prediction"), F.col("score"), 1e-4) | (is_one & far(F.col("prediction"), F.lit(alone), 1e-4))
    return violations(scored, broken)


@query(
    "rec_factors",
    none_broken(
        f"(SELECT DISTINCT 'user', o_custkey FROM {PAIRS_SQL} UNION ALL SELECT DISTINCT 'item', l_partkey FROM {PAIRS_SQL})"
    ),
)
def factors(spark, sf):
    _, model = _trained(spark, sf)
    return violations(rec.factor_rows(model), F.size("factors") != 8)


def _checked_lists(top, model, owner, other, n):
    """Whether ratings are the factors' products and, for owners whose id 50 divides, the lists those of all pairs."""
    owners, others = (model.userFactors, model.itemFactors) if owner == "user" else (model.itemFactors, model.userFactors)
    sides = [side.select("id", F.col("features").alias("factors")) for side in (owners, others)]
    cells = topn.packed_cells(sides[1])
    stated = sides[0].where(F.col("id") % 50 == 0)
    full = topn.every_product(stated, cells, n)
    best = full.groupBy("id").agg(F.slice(F.sort_array(F.collect_list(F.struct("score", (-F.col("other")).alias("other"))), False), 1, n).alias("best"))
    best = best.select(F.col("id").alias(owner), F.posexplode("best").alias("place", "b"))
    best = best.select(owner, (F.col("place") + 1).alias("rank"), (-F.col("b.other")).alias("expected"))
    asked = F.col(owner) % 50 == 0
    scored = rec.with_factor_score(top, model).join(best, [owner, "rank"], "left")
    wrong = asked & ~F.col("expected").eqNullSafe(F.col(other))
    return violations(scored, far(F.col("rating"), F.col("score"), 1e-4) | ~F.col("rank").between(1, n) | wrong)


@query("rec_users_topn", none_broken(f"(SELECT DISTINCT o_custkey FROM {PAIRS_SQL})", "count(*) * 5"))
def users_topn(spark, sf):
    _, model = _trained(spark, sf)
    return _checked_lists(materialise(rec.items_for_users(model, 5), "lists"), model, "user", "item", 5)


@query("rec_items_topn", none_broken(f"(SELECT DISTINCT l_partkey FROM {PAIRS_SQL})", "count(*) * 5"))
def items_topn(spark, sf):
    _, model = _trained(spark, sf)
    return _checked_lists(materialise(rec.users_for_items(model, 5), "lists"), model, "item", "user", 5)


@query(
    "rec_user_subset_topn",
    none_broken(f"(SELECT DISTINCT o_custkey FROM {PAIRS_SQL} JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment = 'BUILDING')", "count(*) * 10"),
)
def user_subset_topn(spark, sf):
    """Lists of ten for the customers of one market segment."""
    _, model = _trained(spark, sf)
    chosen = table(spark, sf, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("user"))
    return _checked_lists(materialise(rec.items_for_users(model, 10, chosen), "lists"), model, "user", "item", 10)


@query(
    "rec_item_subset_topn",
    none_broken(f"(SELECT DISTINCT l_partkey FROM {PAIRS_SQL} JOIN part ON l_partkey = p_partkey WHERE p_size > 40)", "count(*) * 10"),
)
def item_subset_topn(spark, sf):
    """The ten best customers of each large part."""
    _, model = _trained(spark, sf)
    chosen = table(spark, sf, "part").where("p_size > 40").select(F.col("p_partkey").alias("item"))
    return _checked_lists(materialise(rec.users_for_items(model, 10, chosen), "lists"), model, "item", "user", 10)


COLD_SQL = """p AS (SELECT DISTINCT o_custkey AS u, l_partkey AS i FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
              tu AS (SELECT DISTINCT o_custkey AS u FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderstatus = 'F' AND l_discount > 0.09),
              ti AS (SELECT DISTINCT l_partkey AS i FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderstatus = 'F' AND l_discount > 0.09)"""


@query(
    "rec_cold_start",
    f"""WITH {COLD_SQL} SELECT count(*) AS asked, count(*) FILTER (tu.u IS NOT NULL AND ti.i IS NOT NULL) AS kept,
        count(*) FILTER (tu.u IS NULL OR ti.i IS NULL) AS undefined FROM p LEFT JOIN tu USING (u) LEFT JOIN ti USING (i)""",
)
def cold_start(spark, sf):
    bought = table(spark, sf, "lineitem").join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    known = bought.filter((F.col("o_orderstatus") == "F") & (F.col("l_discount") > 0.09))
    model = rec.train(materialise(rec.ratings(known, "o_custkey", "l_partkey", "l_quantity"), "known"), SEED, rank=4, iterations=2)
    pairs = _ratings(spark, sf).select("user", "item")
    kept = model.setColdStartStrategy("drop").transform(pairs).agg(F.count(F.lit(1)).alias("kept"))
    every = model.setColdStartStrategy("nan").transform(pairs)
    undefined = F.sum(F.when(F.isnan("prediction"), 1).otherwise(0)).cast("bigint")
    both = every.agg(F.count(F.lit(1)).alias("asked"), undefined.alias("undefined"))
    return both.withColumn("kept", kept.scalar())


@query("sink_factors", none_broken(PAIRS_SQL))
def sink_factors(spark, sf):
    ratings, model = _trained(spark, sf)
    back = models.load_recommender(models.save(model, scratch_path(spark, "factors")))
    before = model.transform(ratings).withColumnRenamed("prediction", "before")
    # Rows that the loaded model does not know stay, with no number for a prediction.
    after = back.setColdStartStrategy("nan").transform(before)
    return violations(after, F.isnan("prediction") | far(F.col("before"), F.col("prediction"), 1e-9))


# ---- patterns

BASKETS_SQL = """b AS (SELECT DISTINCT l_orderkey AS o, p_type AS i FROM lineitem JOIN part ON l_partkey = p_partkey),
                 n AS (SELECT count(DISTINCT o) AS n FROM b),
                 s1 AS (SELECT i AS a, count(*) AS f FROM b GROUP BY 1),
                 s2 AS (SELECT x.i AS a, y.i AS b, count(*) AS f FROM b x JOIN b y ON x.o = y.o AND x.i < y.i GROUP BY 1, 2),
                 s3 AS (SELECT x.i AS a, y.i AS b, z.i AS c, count(*) AS f FROM b x JOIN b y ON x.o = y.o AND x.i < y.i
                        JOIN b z ON x.o = z.o AND y.i < z.i GROUP BY 1, 2, 3),
                 d AS (SELECT a, b, f FROM s2 UNION ALL SELECT b, a, f FROM s2),
                 rules AS (SELECT d.a, d.b, d.f::DOUBLE / x.f AS confidence, (d.f::DOUBLE / x.f) / (y.f::DOUBLE / n) AS lift, d.f::DOUBLE / n AS support
                           FROM d JOIN s1 x ON d.a = x.a JOIN s1 y ON d.b = y.a, n
                           WHERE d.f >= ceil(0.2 * n) AND d.f::DOUBLE / x.f >= 0.4)"""


def _baskets(spark, sf, item="p_type", min_support=0.2):
    bought = table(spark, sf, "lineitem").join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return pat.baskets(bought, "l_orderkey", item, min_support)


def _mined(spark, sf):
    rows = _baskets(spark, sf)
    return rows, pat.mine(rows, 0.2, 0.4)


@query(
    "fpm_itemsets",
    f"""WITH {BASKETS_SQL} SELECT a AS items, 1 AS size, f AS freq FROM s1, n WHERE f >= ceil(0.2 * n)
        UNION ALL SELECT a || '_' || b, 2, f FROM s2, n WHERE f >= ceil(0.2 * n)
        UNION ALL SELECT a || '_' || b || '_' || c, 3, f FROM s3, n WHERE f >= ceil(0.2 * n)""",
)
def itemsets(spark, sf):
    return pat.itemset_rows(_mined(spark, sf)[1])


@query(
    "fpm_rules",
    f"""WITH {BASKETS_SQL} SELECT a AS antecedent, b AS consequent, round(confidence, 8) AS confidence, round(lift, 8) AS lift,
        round(support, 8) AS support FROM rules""",
)
def rules(spark, sf):
    rows = pat.rule_rows(_mined(spark, sf)[1])
    return rows.select("antecedent", "consequent", *[F.round(c, 8).alias(c) for c in ("confidence", "lift", "support")])


@query(
    "fpm_predict",
    f"""WITH {BASKETS_SQL}, p AS (SELECT DISTINCT x.o, r.b AS i FROM b x JOIN rules r ON x.i = r.a ANTI JOIN b y ON y.o = x.o AND y.i = r.b),
             g AS (SELECT o, array_to_string(list_sort(list(i)), '_') AS implied FROM p GROUP BY 1)
        SELECT o AS l_orderkey, coalesce(implied, '') AS implied FROM (SELECT DISTINCT o FROM b) LEFT JOIN g USING (o)""",
)
def basket_prediction(spark, sf):
    rows, model = _mined(spark, sf)
    found = pat.implied_items(rows, model, "l_orderkey")
    return found.select("l_orderkey", F.concat_ws("_", F.array_sort("prediction")).alias("implied"))


@query(
    "fpm_also_viewed",
    f"""WITH {BASKETS_SQL}, r AS (SELECT a, b, confidence, row_number() OVER (PARTITION BY a ORDER BY confidence DESC, b) AS rank FROM rules)
        SELECT a AS item, CAST(rank AS INTEGER) AS rank, b AS other, round(confidence, 8) AS confidence FROM r WHERE rank <= 5""",
)
def also_viewed(spark, sf):
    rows = pat.also_viewed(_mined(spark, sf)[1])
    return rows.withColumn("confidence", F.round("confidence", 8))


@query(
    "fpm_sequences",
    """WITH e AS (SELECT user_id, CAST(floor(epoch(ts) / 604800) AS BIGINT) AS week, ts, event_id, event_type AS i FROM events),
            n AS (SELECT count(*) AS n FROM (SELECT DISTINCT user_id, week FROM e)),
            s1 AS (SELECT i AS pattern, count(DISTINCT (user_id, week)) AS freq FROM e GROUP BY 1),
            s2 AS (SELECT x.i || '>' || y.i AS pattern, count(DISTINCT (x.user_id, x.week)) AS freq FROM e x
                   JOIN e y ON x.user_id = y.user_id AND x.week = y.week AND (x.ts, x.event_id) < (y.ts, y.event_id) GROUP BY 1),
            s3 AS (SELECT x.i || '>' || y.i || '>' || z.i AS pattern, count(DISTINCT (x.user_id, x.week)) AS freq FROM e x
                   JOIN e y ON x.user_id = y.user_id AND x.week = y.week AND (x.ts, x.event_id) < (y.ts, y.event_id)
                   JOIN e z ON x.user_id = z.user_id AND x.week = z.week AND (y.ts, y.event_id) < (z.ts, z.event_id) GROUP BY 1)
       SELECT pattern, freq FROM (SELECT * FROM s1 UNION ALL SELECT * FROM s2 UNION ALL SELECT * FROM s3), n WHERE freq >= ceil(0.5 * n)""",
)
def sequences(spark, sf):
    events = table(spark, sf, "events").select(
        "user_id", F.floor(F.unix_timestamp("ts") / 604800).alias("week"), "ts", "event_id", "event_type"
    )
    found = pat.frequent_event_sequences(events, ["user_id", "week"], ["ts", "event_id"], "event_type", 0.5, 3)
    return found.select(F.concat_ws(">", "pattern").alias("pattern"), "freq")


@query(
    "fpm_sequences_itemsets",
    """WITH e AS (SELECT DISTINCT user_id AS u, CAST(floor(epoch(ts) / 604800) AS BIGINT) AS w, event_type AS i FROM events),
            n AS (SELECT count(DISTINCT u) AS n FROM e),
            t AS (SELECT x.u, x.w, x.i || '+' || y.i AS i FROM e x JOIN e y USING (u, w) WHERE x.i < y.i),
            p AS (SELECT u, i AS pattern FROM e UNION ALL SELECT u, i FROM t
                  UNION ALL SELECT x.u, x.i || '>' || y.i FROM e x JOIN e y ON x.u = y.u AND x.w < y.w
                  UNION ALL SELECT x.u, x.i || '+' || y.i || '+' || z.i FROM e x JOIN e y USING (u, w) JOIN e z USING (u, w) WHERE x.i < y.i AND y.i < z.i
                  UNION ALL SELECT x.u, x.i || '>' || y.i FROM t x JOIN e y ON x.u = y.u AND x.w < y.w
                  UNION ALL SELECT x.u, x.i || '>' || y.i FROM e x JOIN t y ON x.u = y.u AND x.w < y.w
                  UNION ALL SELECT x.u, x.i || '>' || y.i || '>' || z.i FROM e x JOIN e y ON x.u = y.u AND x.w < y.w JOIN e z ON y.u = z.u AND y.w < z.w)
       SELECT pattern, count(DISTINCT u) AS freq FROM p, n GROUP BY pattern, n HAVING count(DISTINCT u) >= ceil(0.3 * n)""",
)
def itemset_sequences(spark, sf):
    """Up to three event types of each user's weeks, in the same week or in later ones."""
    events = table(spark, sf, "events").select("user_id", F.floor(F.unix_timestamp("ts") / 604800).alias("week"), "event_type")
    found = pat.frequent_itemset_sequences(events, ["user_id"], "week", "event_type", 0.3, 3)
    return found.select(F.concat_ws(">", F.transform("pattern", lambda s: F.concat_ws("+", s))).alias("pattern"), "freq")


# ---- similarity

BRP = dict(inputCol="features", outputCol="hashes", bucketLength=1.0, numHashTables=3, seed=SEED)
SET_WIDTH = 1 << 20


def _token_sets(spark, sf):
    docs = wide(spark, sf, "documents", "doc_id", "text").select("doc_id", T.token_set("text").alias("tokens"))
    return apply(HashingTF(inputCol="tokens", outputCol="features", numFeatures=SET_WIDTH, binary=True), docs)


def _minhash(rows):
    return fitted(MinHashLSH(inputCol="features", outputCol="hashes", numHashTables=5, seed=SEED), rows)


@query("lsh_brp_hash", none_broken("embeddings"))
def brp_hash(spark, sf):
    rows = _embeddings(spark, sf)
    model = fitted(BucketedRandomProjectionLSH(**BRP), rows)
    scored = model.transform(rows).select(sim.hash_values().alias("h"), sim.brp_hashes(model, V.vector_array("features")).alias("own"))
    # Sums in another order may fall on the other side of a whole number.
    same = F.forall(F.zip_with("h", "own", lambda x, y: F.abs(x - y)), lambda d: d <= 1) & (
        F.size(F.filter(F.zip_with("h", "own", lambda x, y: x == y), lambda e: e)) >= 2
    )
    return violations(scored, (F.size("h") != 3) | ~same)


def _checked_links(joined, left, right, threshold, close, inputs):
    """Inputs joined, and what is wrong: pairs whose distance, measured again from the rows, is off or too large; a join
    without links; more than a tenth of the neighbours closer than ``close`` missing from the join, for the left rows
    whose id 50 divides against all right rows."""
    ids = materialise(joined.linked_pairs(), "pairs")
    measured, bad = sim.measured_again(ids, left.select("id", "values"), right.select("id", "values"), threshold)
    bad += ids.count() - measured + ids.isEmpty()
    near = topn.vectors_within(left.where("id % 50 = 0"), right, close).where("id <> other").select("id", "other")
    either = ids.select(F.col("id_a").alias("id"), F.col("id_b").alias("other"))
    if len(joined.sides) == 1:
        either = either.union(ids.select("id_b", "id_a"))
    groups = joined.groups.select("group", "id")
    copies = groups.where("id % 50 = 0").join(groups.select("group", F.col("id").alias("other")), "group").select("id", "other")
    near = materialise(near, "near")
    either = either.where("id % 50 = 0")
    found = near.join(either.union(copies), ["id", "other"], "left_semi").count()
    bad += found < 0.9 * near.count()
    return inputs.agg(F.count(F.lit(1)).alias("rows_scored")).withColumn("violations", F.lit(int(bad)).cast("bigint"))


@query("lsh_brp_join", none_broken("embeddings"))
def brp_join(spark, sf):
    rows = _embeddings(spark, sf)
    model = fitted(BucketedRandomProjectionLSH(**BRP), rows)
    joined = sim.similarity_join(model, rows, None, "vec_id", "features", 1.2, "euclidean")
    vectors = materialise(rows.select(F.col("vec_id").alias("id"), V.vector_array("features").alias("values")), "vectors")
    return _checked_links(joined, vectors, vectors, 1.2, 0.35, rows)


@query("join_similarity_euclid", none_broken("embeddings"))
def similarity_euclid(spark, sf):
    """The two-table form: even labels against odd labels, hot buckets cut into blocks of 64."""
    rows = _embeddings(spark, sf)
    odd = F.col("label") % 2 == 1
    model = fitted(BucketedRandomProjectionLSH(**BRP), rows)
    joined = sim.similarity_join(model, rows.filter(~odd), rows.filter(odd), "vec_id", "features", 1.2, "euclidean", block=64)
    vectors = materialise(rows.select("label", F.col("vec_id").alias("id"), V.vector_array("features").alias("values")), "vectors")
    return _checked_links(joined, vectors.where(~odd), vectors.where(odd), 1.2, 0.35, rows)


@query(
    "lsh_brp_nn",
    """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
            d AS (SELECT q.vec_id AS asked, v.vec_id, sqrt(list_sum(list_transform(list_zip(q.e, v.e), lambda p: (p[1] - p[2]) * (p[1] - p[2])))) AS d
                  FROM v q, v WHERE q.vec_id % 50 = 0)
       SELECT asked, CAST(row_number() OVER (PARTITION BY asked ORDER BY round(d, 7), vec_id) AS INTEGER) AS rank, vec_id, round(d, 6) + 0.0 AS distance
       FROM d QUALIFY rank <= 10""",
)
def brp_nn(spark, sf):
    """The ten nearest vectors of every vector whose id 50 divides, all rows searched as far as bounds leave them open."""
    rows = _embeddings(spark, sf).select(F.col("vec_id").alias("id"), V.vector_array("features").alias("values"))
    # A few more than asked for, as distances that agree when rounded are ordered by id.
    found = topn.nearest_vectors(rows.where("id % 50 = 0"), rows, 16)
    order = Window.partitionBy("id").orderBy(F.round("distance", 7), "other")
    best = found.withColumn("rank", F.row_number().over(order)).where("rank <= 10")
    return best.select(F.col("id").alias("asked"), "rank", F.col("other").alias("vec_id"), r6("distance").alias("distance"))


@query("lsh_minhash_hash", none_broken("documents"))
def minhash_hash(spark, sf):
    """Texts without tokens have no hash and are scored as such."""
    every = _token_sets(spark, sf)
    rows = every.where(F.size("tokens") > 0)
    model = _minhash(rows)
    scored = model.transform(rows).select(sim.hash_values().alias("h"), sim.minhash_values(model, sim.jaccard_entries("features")).alias("own"))
    blank = every.where(F.size("tokens") == 0).select(F.lit(None).cast("array<double>").alias("h"), F.lit(None).cast("array<double>").alias("own"))
    return violations(scored.unionByName(blank), ~F.col("h").eqNullSafe(F.col("own")))


SETS_SQL = r"""s AS (SELECT doc_id, list_sort(list_distinct([x FOR x IN string_split_regex(lower(text), '[ \t\n\x0B\f\r]+') IF x <> ''])) AS w FROM documents),
             g AS (SELECT w, min(doc_id) AS id, count(*) AS n, len(w) AS size FROM s GROUP BY w),
             t AS (SELECT id, n, size, unnest(w) AS token FROM g)"""


@query(
    "lsh_minhash_join",
    r"""WITH s AS (SELECT doc_id, coalesce(list_sort(list_distinct([x FOR x IN string_split_regex(lower(text), '[ \t\n\x0B\f\r]+') IF x <> ''])), []) AS w
                   FROM documents WHERE doc_id IS NOT NULL),
             g AS (SELECT w, list_sort(list(doc_id)) AS ids, min(doc_id) AS id, count(*) AS n, len(w) AS size, row_number() OVER (ORDER BY w) AS k FROM s GROUP BY w),
             t AS (SELECT k, size, unnest(w) AS token FROM g),
             m AS (SELECT k, id AS first, n, size, unnest(ids) AS doc, unnest(range(n)) AS i FROM g),
             p AS (SELECT a.k AS x, b.k AS y, count(*) AS shared, any_value(a.size + b.size) AS sizes
                   FROM t a JOIN t b ON a.token = b.token AND a.k < b.k GROUP BY 1, 2),
             l AS (SELECT x, y, round(1 - shared / (sizes - shared), 6) + 0.0 AS distance FROM p WHERE 5 * shared >= 4 * (sizes - shared)
                   UNION ALL SELECT k, k, 0.0 FROM g WHERE n > 1),
             e AS (SELECT a, b, distance, (b.doc, b.first, b.n, b.size) < (a.doc, a.first, a.n, a.size) AS turned
                   FROM l JOIN m a ON a.k = x JOIN m b ON b.k = y WHERE x <> y OR a.i < b.i),
             o AS (SELECT CASE WHEN turned THEN b ELSE a END AS a, CASE WHEN turned THEN a ELSE b END AS b, distance FROM e)
        SELECT a.doc AS id_a, b.doc AS id_b, a.first AS first_a, b.first AS first_b, a.n AS n_a, b.n AS n_b, distance FROM o""",
)
def minhash_join(spark, sf):
    """All pairs of near-duplicate documents, found by prefixes, so none is missed: with each document the first one of
    the same token set and how many have that set. Documents without tokens are copies of each other."""
    rows = wide(spark, sf, "documents", "doc_id", "text").select("doc_id", T.token_set("text").alias("tokens"))
    pairs = setjoin.similar_sets(rows, setjoin.Similarity(4, 5), "doc_id").row_pairs()
    whole = F.col("size_a") + F.col("size_b") - F.col("shared")
    distance = F.when(whole > 0, r6(1 - F.col("shared") / whole)).otherwise(0.0)
    return pairs.select("id_a", "id_b", "first_a", "first_b", "n_a", "n_b", distance.alias("distance"))


@query(
    "join_similarity_jaccard",
    rf"""WITH {SETS_SQL},
             p AS (SELECT a.id AS x, b.id AS y, count(*) AS shared, any_value(a.size + b.size) AS sizes
                   FROM t a JOIN t b ON a.token = b.token AND a.id < b.id GROUP BY 1, 2),
             l AS (SELECT x, y FROM p WHERE 5 * shared > 2 * (sizes - shared)),
             c AS (SELECT id, sum(n) AS n FROM (SELECT x AS id, g.n FROM l JOIN g ON l.y = g.id UNION ALL SELECT y, g.n FROM l JOIN g ON l.x = g.id) GROUP BY 1)
        SELECT s.doc_id, CAST(coalesce(c.n, 0) + CASE WHEN g.size > 0 THEN g.n - 1 ELSE 0 END AS BIGINT) AS n_links
        FROM s JOIN g USING (w) LEFT JOIN c ON c.id = g.id""",
)
def similarity_jaccard(spark, sf):
    """How many other documents have a token set at a distance below 0.6, by an exact join."""
    rows = wide(spark, sf, "documents", "doc_id", "text").select("doc_id", T.token_set("text").alias("tokens"))
    joined = setjoin.similar_sets(rows, setjoin.Similarity(2, 5, strict=True), "doc_id")
    return joined.link_counts().select(F.col("id").alias("doc_id"), "n_links")


@query(
    "lsh_minhash_nn",
    rf"""WITH {SETS_SQL}, k AS (SELECT w FROM s WHERE w <> [] ORDER BY doc_id LIMIT 1),
            d AS (SELECT doc_id, len(list_intersect(s.w, k.w)) AS shared, len(s.w) + len(k.w) AS sizes FROM s, k WHERE s.w <> [])
       SELECT CAST(row_number() OVER (ORDER BY round(1 - shared / (sizes - shared), 9), doc_id) AS INTEGER) AS rank, doc_id,
              round(1 - shared / (sizes - shared), 6) + 0.0 AS distance
       FROM d QUALIFY rank <= 10""",
)
def minhash_nn(spark, sf):
    """The ten documents whose token sets are nearest to the first one's, itself among them: one pass over all sets, as
    hashing them all is, in which none is missed. Texts without tokens have no distance."""
    rows = wide(spark, sf, "documents", "doc_id", "text").select("doc_id", T.token_set("text").alias("tokens")).where(F.size("tokens") > 0)
    key = rows.orderBy("doc_id").first()["tokens"]
    return setjoin.nearest_sets(rows, key, 10, "doc_id").select("rank", F.col("id").alias("doc_id"), r6("distance").alias("distance"))
