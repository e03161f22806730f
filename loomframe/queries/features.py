"""Text, categorical and numeric feature operators."""

from __future__ import annotations

from pyspark.ml.feature import (
    DCT,
    PCA,
    Binarizer,
    Bucketizer,
    ElementwiseProduct,
    FeatureHasher,
    HashingTF,
    Imputer,
    IndexToString,
    Interaction,
    MaxAbsScaler,
    MinMaxScaler,
    NGram,
    Normalizer,
    OneHotEncoder,
    PolynomialExpansion,
    RegexTokenizer,
    RFormula,
    StandardScaler,
    StopWordsRemover,
    StringIndexer,
    Tokenizer,
    VectorAssembler,
    VectorIndexer,
    VectorSizeHint,
    VectorSlicer,
)
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import Summarizer
from pyspark.sql import functions as F

from loomframe.functions import text as T, vectors as V
from loomframe.operators import features as ops, ordering
from loomframe.operators.relational import lookup
from loomframe.operators.stages import apply, chain, fitted
from loomframe.operators.wordvec import WordVectors
from loomframe.queries.registry import far, none_broken, query, r6, table, violations, wide

SPACE = r"[ \t\n\x0B\f\r]"
TOKENS_SQL = rf"string_split_regex(regexp_replace(lower(text), '{SPACE}+$', ''), '{SPACE}')"
STOP_SQL = ", ".join("'" + w.replace("'", "''") + "'" for w in T.ENGLISH_STOP_WORDS)


def _tokens(spark, sf):
    return apply(Tokenizer(inputCol="text", outputCol="tokens"), wide(spark, sf, "documents", "doc_id", "text"))


def _digest(column):
    return F.md5(F.concat_ws("|", column)).alias("digest")


def _lines(spark, sf, *names, out="features"):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *names)
    return apply(VectorAssembler(inputCols=list(names), outputCol=out), lines)


@query(
    "feat_tokenize",
    f"SELECT doc_id, md5(array_to_string({TOKENS_SQL}, '|')) AS digest, CAST(len({TOKENS_SQL}) AS INTEGER) AS n FROM documents",
)
def tokenize(spark, sf):
    return _tokens(spark, sf).select("doc_id", _digest("tokens"), F.size("tokens").alias("n"))


@query(
    "feat_regex_tokenize",
    r"""WITH t AS (SELECT doc_id, [x FOR x IN string_split_regex(lower(text), '[^a-zA-Z0-9_]') IF x <> ''] AS w FROM documents)
        SELECT doc_id, md5(array_to_string(w, '|')) AS digest, CAST(len(w) AS INTEGER) AS n FROM t""",
)
def regex_tokenize(spark, sf):
    docs = wide(spark, sf, "documents", "doc_id", "text")
    words = apply(RegexTokenizer(inputCol="text", outputCol="tokens", pattern=r"\W"), docs)
    return words.select("doc_id", _digest("tokens"), F.size("tokens").alias("n"))


@query(
    "feat_cjk_tokenize",
    r"""WITH t AS (SELECT doc_id, regexp_extract_all(lower(text), '\p{Han}|[\p{L}\p{N}]+') AS w FROM documents),
             b AS (SELECT doc_id, w, [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))] AS g FROM t)
        SELECT doc_id, md5(array_to_string(w, '|')) AS digest, md5(array_to_string(g, '|')) AS bigrams,
               CAST(len(w) AS INTEGER) AS n FROM b""",
)
def cjk_tokenize(spark, sf):
    docs = wide(spark, sf, "documents", "doc_id", "text")
    words = apply(T.han_bigram_stages("text"), docs)
    return words.select(
        "doc_id", _digest("tokens"), F.md5(F.concat_ws("|", "bigrams")).alias("bigrams"), F.size("tokens").alias("n")
    )


@query("feat_token_count", f"SELECT doc_id, CAST(len({TOKENS_SQL}) AS INTEGER) AS tokens FROM documents")
def token_count(spark, sf):
    return wide(spark, sf, "documents", "doc_id", "text").select("doc_id", F.size(T.token_array("text")).alias("tokens"))


@query(
    "feat_stopwords",
    f"""WITH t AS (SELECT doc_id, [x FOR x IN {TOKENS_SQL} IF x NOT IN ({STOP_SQL})] AS w FROM documents)
        SELECT doc_id, md5(array_to_string(w, '|')) AS digest, CAST(len(w) AS INTEGER) AS n FROM t""",
)
def stopwords(spark, sf):
    kept = apply(StopWordsRemover(inputCol="tokens", outputCol="kept"), _tokens(spark, sf))
    return kept.select("doc_id", _digest("kept"), F.size("kept").alias("n"))


@query(
    "feat_ngram",
    f"""WITH t AS (SELECT doc_id, {TOKENS_SQL} AS w FROM documents),
             b AS (SELECT doc_id, [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))] AS g FROM t)
        SELECT doc_id, md5(array_to_string(g, '|')) AS digest, CAST(len(g) AS INTEGER) AS n FROM b""",
)
def ngram(spark, sf):
    grams = apply(NGram(n=2, inputCol="tokens", outputCol="grams"), _tokens(spark, sf))
    return grams.select("doc_id", _digest("grams"), F.size("grams").alias("n"))


@query("feat_hashing_tf", none_broken("documents"))
def hashing_tf(spark, sf):
    tf = apply(HashingTF(inputCol="tokens", outputCol="tf", numFeatures=1000), _tokens(spark, sf))
    values = F.unwrap_udt(F.col("tf"))["values"]
    total = F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)
    whole = F.forall(values, lambda x: (x > 0) & (x == F.floor(x)))
    return violations(tf, (total != F.size("tokens")) | ~whole)


TERMS_SQL = f"""t AS (SELECT doc_id, unnest({TOKENS_SQL}) AS term FROM documents),
                c AS (SELECT doc_id, term, count(*) AS n FROM t GROUP BY 1, 2),
                d AS (SELECT term, count(*) AS df FROM c GROUP BY 1 HAVING count(*) >= 2)"""


@query(
    "feat_count_vectorize",
    f"WITH {TERMS_SQL} SELECT doc_id, term, CAST(n AS DOUBLE) AS n FROM c JOIN d USING (term)",
)
def count_vectorize(spark, sf):
    return ops.term_counts(_tokens(spark, sf), "doc_id", "tokens", min_df=2).select("doc_id", "term", "n")


@query(
    "feat_idf",
    f"""WITH {TERMS_SQL}, m AS (SELECT count(*) AS m FROM documents)
        SELECT doc_id, term, round(n * ln((m + 1.0) / (df + 1.0)), 6) + 0.0 AS weight FROM c JOIN d USING (term), m""",
)
def idf(spark, sf):
    rows = ops.term_weights(_tokens(spark, sf), "doc_id", "tokens", min_df=2)
    return rows.withColumn("weight", r6("weight"))


def _word2vec(spark, sf):
    tokens = _tokens(spark, sf).select("doc_id", "tokens")
    stage = WordVectors(inputCol="tokens", outputCol="features", vectorSize=20, minCount=0, seed=7)
    return tokens, fitted(stage, tokens)


@query("feat_word2vec", none_broken("documents"))
def word2vec(spark, sf):
    tokens, model = _word2vec(spark, sf)
    words = tokens.select("doc_id", F.explode("tokens").alias("word"))
    counted = words.groupBy("doc_id", "word").agg(F.count(F.lit(1)).cast("double").alias("n"))
    placed = lookup(counted, model.getVectors(), "word", missing="drop")
    means = placed.groupBy("doc_id").agg(Summarizer.mean(F.col("vector"), F.col("n")).alias("mean"))
    both = model.transform(tokens).join(means, "doc_id", "left")
    gap = V.euclidean(V.vector_array("features"), V.vector_array("mean"))
    return violations(both, gap > 1e-5)


@query("feat_synonyms", "SELECT CAST(10 AS BIGINT) AS rows_scored, CAST(0 AS BIGINT) AS violations")
def synonyms(spark, sf):
    tokens, model = _word2vec(spark, sf)
    word = tokens.select(F.explode("tokens").alias("w")).groupBy("w").count().orderBy(F.desc("count"), "w").first()["w"]
    near = model.findSynonyms(word, 10)
    vectors = model.getVectors().select("word", V.vector_array("vector").alias("v"))
    key = F.array(*[F.lit(x) for x in vectors.filter(F.col("word") == word).first()["v"]])
    scored = vectors.filter(F.col("word") != word).select(
        "word", (V.dot("v", key) / (V.norm("v") * V.norm(key))).alias("cosine")
    )
    worst = near.agg(F.min("similarity")).scalar()
    missed = scored.filter(F.col("cosine") > worst + 1e-5).join(near, "word", "left_anti").agg(F.count("word")).scalar()
    both = near.join(scored, "word", "left")
    return violations(both, far(F.col("similarity"), F.col("cosine"), 1e-5) | (missed > 0))


@query("feat_feature_hash", none_broken("lineitem"))
def feature_hash(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_quantity", "l_discount", "l_returnflag", "l_linestatus")
    hashed = apply(FeatureHasher(inputCols=lines.columns, outputCol="features", numFeatures=4096), lines)
    total = F.aggregate(F.unwrap_udt(F.col("features"))["values"], F.lit(0.0), lambda acc, x: acc + x)
    return violations(hashed, far(total, F.col("l_quantity") + F.col("l_discount") + 2))


INDEX_SQL = """i AS (SELECT o_orderpriority, CAST(row_number() OVER (ORDER BY count(*) DESC, o_orderpriority) - 1 AS DOUBLE) AS idx
               FROM orders GROUP BY 1)"""


@query("feat_string_index", f"WITH {INDEX_SQL} SELECT o_orderkey, idx FROM orders JOIN i USING (o_orderpriority)")
def string_index(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return apply(StringIndexer(inputCol="o_orderpriority", outputCol="idx"), orders).select("o_orderkey", "idx")


WIDE_INDEX_SQL = """i AS (SELECT l_partkey::VARCHAR AS v, row_number() OVER (ORDER BY count(*) DESC, l_partkey::VARCHAR) - 1 AS idx
                    FROM lineitem GROUP BY 1)"""


@query(
    "feat_string_index_wide",
    f"WITH {WIDE_INDEX_SQL} SELECT l_orderkey, l_linenumber, CAST(idx AS DOUBLE) AS idx FROM lineitem JOIN i ON l_partkey::VARCHAR = v",
)
def string_index_wide(spark, sf):
    """The index of a column of very many values, as a table."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").cast("string").alias("part"))
    return ops.with_index(lines, "part", ops.value_index(lines, "part"), "idx").select("l_orderkey", "l_linenumber", "idx")


@query(
    "feat_one_hot_wide",
    f"""WITH {WIDE_INDEX_SQL}, t AS (SELECT l_orderkey * 8 + l_linenumber AS line, idx FROM lineitem JOIN i ON l_partkey::VARCHAR = v)
        SELECT line, idx AS pos, 1.0::DOUBLE AS value FROM t WHERE idx < (SELECT count(*) - 1 FROM i)""",
)
def one_hot_wide(spark, sf):
    """The stored entries of one-hot vectors over the same values, without the last one."""
    line = (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("line")
    lines = table(spark, sf, "lineitem").select(line, F.col("l_partkey").cast("string").alias("part"))
    index = ops.value_index(lines, "part")
    return ops.hot_rows(ops.with_index(lines, "part", index, "idx"), "line", "idx", index.count())


@query("feat_index_to_string", "SELECT o_orderkey, o_orderpriority AS original, o_orderpriority AS given FROM orders")
def index_to_string(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    indexer = fitted(StringIndexer(inputCol="o_orderpriority", outputCol="idx"), orders)
    back = chain(
        IndexToString(inputCol="idx", outputCol="original"),
        IndexToString(inputCol="idx", outputCol="given", labels=indexer.labels),
    )
    return apply(back, indexer.transform(orders)).select("o_orderkey", "original", "given")


@query(
    "feat_one_hot",
    f"""WITH {INDEX_SQL} SELECT o_orderkey, (idx = 0)::INT::DOUBLE AS v0, (idx = 1)::INT::DOUBLE AS v1,
        (idx = 2)::INT::DOUBLE AS v2, (idx = 3)::INT::DOUBLE AS v3 FROM orders JOIN i USING (o_orderpriority)""",
)
def one_hot(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    stages = chain(
        StringIndexer(inputCol="o_orderpriority", outputCol="idx"), OneHotEncoder(inputCol="idx", outputCol="hot")
    )
    return V.spread(apply(stages, orders).select("o_orderkey", "hot"), "hot", ["v0", "v1", "v2", "v3"])


@query(
    "feat_one_hot_full",
    """SELECT l_orderkey, l_linenumber, (l_returnflag = 'A')::INT::DOUBLE AS flag_a, (l_returnflag = 'N')::INT::DOUBLE AS flag_n,
              (l_returnflag = 'R')::INT::DOUBLE AS flag_r, (l_linestatus = 'F')::INT::DOUBLE AS status_f,
              (l_linestatus = 'O')::INT::DOUBLE AS status_o, l_quantity FROM lineitem""",
)
def one_hot_full(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_quantity")
    stages = ops.one_hot_full(["l_returnflag", "l_linestatus"], numeric=["l_quantity"])
    hot = apply(stages, lines).select("l_orderkey", "l_linenumber", "features")
    return V.spread(hot, "features", ["flag_a", "flag_n", "flag_r", "status_f", "status_o", "l_quantity"])


@query(
    "feat_vector_index",
    """WITH e AS (SELECT 0 AS pos, l_linenumber::DOUBLE AS original FROM lineitem
                  UNION ALL SELECT 1, l_discount FROM lineitem UNION ALL SELECT 2, l_tax FROM lineitem)
       SELECT pos, original, CAST(row_number() OVER (PARTITION BY pos ORDER BY original <> 0, original) - 1 AS INTEGER) AS index,
              count(*) AS n FROM e GROUP BY 1, 2""",
)
def vector_index(spark, sf):
    rows = apply(
        VectorAssembler(inputCols=["l_linenumber", "l_discount", "l_tax", "l_quantity"], outputCol="features"),
        table(spark, sf, "lineitem").select("l_linenumber", "l_discount", "l_tax", "l_quantity"),
    ).select("features")
    model = fitted(VectorIndexer(inputCol="features", outputCol="indexed", maxCategories=20), rows)
    pairs = model.transform(rows).select(
        F.posexplode(
            F.arrays_zip(V.vector_array("features").alias("x"), V.vector_array("indexed").alias("y"))
        ).alias("pos", "e")
    )
    seen = pairs.groupBy("pos", F.col("e.x").alias("original"), F.col("e.y").cast("int").alias("index")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return seen.join(F.broadcast(ops.category_maps(spark, model)), ["pos", "original", "index"])


@query(
    "feat_assemble",
    """SELECT l_orderkey, l_linenumber, l_quantity AS a, l_tax AS b, l_discount AS c, l_tax AS d FROM lineitem""",
)
def assemble(spark, sf):
    lines = apply(
        VectorAssembler(inputCols=["l_tax", "l_discount"], outputCol="inner"),
        table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_tax", "l_discount"),
    )
    whole = apply(VectorAssembler(inputCols=["l_quantity", "inner", "l_tax"], outputCol="features"), lines)
    return V.spread(whole.select("l_orderkey", "l_linenumber", "features"), "features", ["a", "b", "c", "d"])


@query("feat_size_hint", "SELECT vec_id FROM embeddings WHERE label <> 3")
def size_hint(spark, sf):
    short = F.when(F.col("label") == 3, F.slice("embedding", 1, 63)).otherwise(F.col("embedding"))
    rows = table(spark, sf, "embeddings").select("vec_id", V.array_vector(short).alias("features"))
    return apply(VectorSizeHint(inputCol="features", size=64, handleInvalid="skip"), rows).select("vec_id")


@query("feat_slice", "SELECT l_orderkey, l_linenumber, l_discount AS first, l_tax AS second FROM lineitem")
def vector_slice(spark, sf):
    rows = _lines(spark, sf, "l_quantity", "l_discount", "l_tax")
    cut = apply(VectorSlicer(inputCol="features", outputCol="cut", indices=[1], names=["l_tax"]), rows)
    return V.spread(cut.select("l_orderkey", "l_linenumber", "cut"), "cut", ["first", "second"])


@query(
    "feat_binarize",
    "SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity > 25 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS large FROM lineitem",
)
def binarize(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    stage = Binarizer(threshold=25.0, inputCol="l_quantity", outputCol="large")
    return apply(stage, lines).drop("l_quantity")


INF = float("inf")


@query(
    "feat_bucketize",
    """SELECT c_custkey, CASE WHEN c_acctbal >= 5000 THEN 3.0::DOUBLE WHEN c_acctbal >= 1000 THEN 2.0
              WHEN c_acctbal >= 0 THEN 1.0 ELSE 0.0 END AS bucket FROM customer""",
)
def bucketize(spark, sf):
    stage = Bucketizer(splits=[-INF, 0.0, 1000.0, 5000.0, INF], inputCol="c_acctbal", outputCol="bucket")
    return apply(stage, table(spark, sf, "customer").select("c_custkey", "c_acctbal")).drop("c_acctbal")


@query(
    "feat_bucketize_multi",
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity >= 30 THEN 2.0::DOUBLE WHEN l_quantity >= 10 THEN 1.0 ELSE 0.0 END AS q,
              CASE WHEN l_discount >= 0.05 THEN 1.0::DOUBLE ELSE 0.0 END AS d FROM lineitem""",
)
def bucketize_multi(spark, sf):
    stage = Bucketizer(
        splitsArray=[[-INF, 10.0, 30.0, INF], [-INF, 0.05, INF]],
        inputCols=["l_quantity", "l_discount"],
        outputCols=["q", "d"],
    )
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")
    return apply(stage, lines).drop("l_quantity", "l_discount")


@query(
    "feat_quantile_bucket",
    """WITH q AS (SELECT quantile_disc(o_totalprice, [0.25, 0.5, 0.75]) AS c FROM orders)
       SELECT o_orderkey, CASE WHEN o_totalprice >= c[3] THEN 3.0::DOUBLE WHEN o_totalprice >= c[2] THEN 2.0
              WHEN o_totalprice >= c[1] THEN 1.0 ELSE 0.0 END AS bin FROM orders, q""",
)
def quantile_bucket(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return ordering.quantile_bins(orders, "o_totalprice", "bin", 4).drop("o_totalprice")


@query(
    "feat_impute",
    """WITH t AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_quantity END AS a,
                         CASE WHEN l_linestatus = 'O' THEN NULL ELSE l_tax END AS b FROM lineitem)
       SELECT l_orderkey, l_linenumber, round(coalesce(a, avg(a) OVER ()), 6) + 0.0 AS a,
              round(coalesce(b, avg(b) OVER ()), 6) + 0.0 AS b FROM t""",
)
def impute(spark, sf):
    holes = table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_returnflag") == "R", F.lit(float("nan"))).otherwise(F.col("l_quantity")).alias("a_raw"),
        F.when(F.col("l_linestatus") != "O", F.col("l_tax")).alias("b_raw"),
    )
    full = apply(Imputer(inputCols=["a_raw", "b_raw"], outputCols=["a", "b"]), holes)
    return full.select("l_orderkey", "l_linenumber", r6("a").alias("a"), r6("b").alias("b"))


def _scaled(spark, sf, stage):
    rows = _lines(spark, sf, "l_quantity", "l_extendedprice")
    out = V.spread(apply(stage, rows).select("l_orderkey", "l_linenumber", "scaled"), "scaled", ["a", "b"])
    return out.withColumns({"a": r6("a"), "b": r6("b")})


@query(
    "feat_standard_scale",
    """SELECT l_orderkey, l_linenumber, round(l_quantity / (SELECT stddev_samp(l_quantity) FROM lineitem), 6) + 0.0 AS a,
              round(l_extendedprice / (SELECT stddev_samp(l_extendedprice) FROM lineitem), 6) + 0.0 AS b FROM lineitem""",
)
def standard_scale(spark, sf):
    return _scaled(spark, sf, StandardScaler(inputCol="features", outputCol="scaled"))


@query(
    "feat_minmax_scale",
    """WITH m AS (SELECT min(l_quantity) AS q0, max(l_quantity) AS q1, min(l_extendedprice) AS p0, max(l_extendedprice) AS p1 FROM lineitem)
       SELECT l_orderkey, l_linenumber, round((l_quantity - q0) / (q1 - q0), 6) + 0.0 AS a,
              round((l_extendedprice - p0) / (p1 - p0), 6) + 0.0 AS b FROM lineitem, m""",
)
def minmax_scale(spark, sf):
    return _scaled(spark, sf, MinMaxScaler(inputCol="features", outputCol="scaled"))


@query(
    "feat_maxabs_scale",
    """SELECT l_orderkey, l_linenumber, round(l_quantity / (SELECT max(abs(l_quantity)) FROM lineitem), 6) + 0.0 AS a,
              round(l_extendedprice / (SELECT max(abs(l_extendedprice)) FROM lineitem), 6) + 0.0 AS b FROM lineitem""",
)
def maxabs_scale(spark, sf):
    return _scaled(spark, sf, MaxAbsScaler(inputCol="features", outputCol="scaled"))


@query(
    "feat_normalize",
    """SELECT l_orderkey, l_linenumber, round(l_quantity / (abs(l_quantity) + abs(l_tax)), 6) + 0.0 AS a,
              round(l_tax / (abs(l_quantity) + abs(l_tax)), 6) + 0.0 AS b,
              round(l_quantity / greatest(abs(l_quantity), abs(l_tax)), 6) + 0.0 AS a_inf,
              round(l_tax / greatest(abs(l_quantity), abs(l_tax)), 6) + 0.0 AS b_inf FROM lineitem""",
)
def normalize(spark, sf):
    rows = _lines(spark, sf, "l_quantity", "l_tax")
    stage = Normalizer(inputCol="features", outputCol="unit", p=1.0)
    both = apply(stage, apply(stage, rows), {stage.p: INF, stage.outputCol: "unit_inf"})
    out = V.spread(both.select("l_orderkey", "l_linenumber", "unit", "unit_inf"), "unit", ["a", "b"])
    out = V.spread(out, "unit_inf", ["a_inf", "b_inf"])
    return out.withColumns({c: r6(c) for c in ("a", "b", "a_inf", "b_inf")})


@query(
    "feat_elementwise",
    """SELECT l_orderkey, l_linenumber, l_quantity * 0 AS a, l_tax * 1 AS b, round(l_discount * 2, 6) + 0.0 AS c FROM lineitem""",
)
def elementwise(spark, sf):
    rows = _lines(spark, sf, "l_quantity", "l_tax", "l_discount")
    stage = ElementwiseProduct(scalingVec=Vectors.dense([0.0, 1.0, 2.0]), inputCol="features", outputCol="scaled")
    out = V.spread(apply(stage, rows).select("l_orderkey", "l_linenumber", "scaled"), "scaled", ["a", "b", "c"])
    return out.withColumn("c", r6("c"))


@query(
    "feat_interaction",
    """SELECT l_orderkey, l_linenumber, round(l_linenumber * l_quantity * l_discount, 6) + 0.0 AS a,
              round(l_linenumber * l_quantity * l_extendedprice, 4) + 0.0 AS b, round(l_linenumber * l_tax * l_discount, 6) + 0.0 AS c,
              round(l_linenumber * l_tax * l_extendedprice, 4) + 0.0 AS d FROM lineitem""",
)
def interaction(spark, sf):
    lines = table(spark, sf, "lineitem")
    stages = chain(
        VectorAssembler(inputCols=["l_quantity", "l_tax"], outputCol="v1"),
        VectorAssembler(inputCols=["l_discount", "l_extendedprice"], outputCol="v2"),
        Interaction(inputCols=["l_linenumber", "v1", "v2"], outputCol="products"),
    )
    rows = apply(stages, lines).select("l_orderkey", "l_linenumber", "products")
    out = V.spread(rows, "products", ["a", "b", "c", "d"])
    return out.withColumns({"a": r6("a"), "b": r6("b", 4), "c": r6("c"), "d": r6("d", 4)})


@query(
    "feat_poly",
    """WITH t AS (SELECT l_orderkey, l_linenumber, l_quantity AS x, l_discount AS y FROM lineitem)
       SELECT l_orderkey, l_linenumber, x AS p0, x * x AS p1, x * x * x AS p2, y AS p3, round(x * y, 6) + 0.0 AS p4,
              round(x * x * y, 6) + 0.0 AS p5, round(y * y, 6) + 0.0 AS p6, round(x * y * y, 6) + 0.0 AS p7,
              round(y * y * y, 6) + 0.0 AS p8 FROM t""",
)
def poly(spark, sf):
    rows = _lines(spark, sf, "l_quantity", "l_discount")
    grown = apply(PolynomialExpansion(degree=3, inputCol="features", outputCol="poly"), rows)
    names = [f"p{i}" for i in range(9)]
    out = V.spread(grown.select("l_orderkey", "l_linenumber", "poly"), "poly", names)
    return out.withColumns({n: r6(n) for n in names})


@query(
    "feat_dct",
    """WITH e AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) - 1 AS n FROM embeddings),
            k AS (SELECT unnest(range(64)) AS k)
       SELECT vec_id, CAST(k AS INTEGER) AS pos,
              round(sqrt(2.0 / 64) * (CASE WHEN k = 0 THEN 1 / sqrt(2.0) ELSE 1 END) * sum(x * cos(pi() * (n + 0.5) * k / 64)), 5) + 0.0 AS value
       FROM e, k GROUP BY 1, k""",
)
def dct(spark, sf):
    rows = table(spark, sf, "embeddings").select("vec_id", V.array_vector("embedding").alias("features"))
    turned = apply(DCT(inverse=False, inputCol="features", outputCol="waves"), rows)
    return V.explode_vector(turned, ["vec_id"], "waves").select("vec_id", "pos", r6("value", 5).alias("value"))


@query(
    "feat_pca",
    """WITH s AS (SELECT var_samp(l_quantity) AS a, var_samp(l_extendedprice / 1000) AS b,
                         covar_samp(l_quantity, l_extendedprice / 1000) AS c FROM lineitem),
            f AS (SELECT ((a + b) / 2 + sqrt(((a - b) / 2) ** 2 + c * c)) / (a + b) AS first FROM s)
       SELECT unnest([0, 1]) AS pos, round(unnest([first, 1 - first]), 6) AS share, 0.0::DOUBLE AS gap FROM f""",
)
def pca(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        V.dense_vector(["l_quantity", F.col("l_extendedprice") / 1000]).alias("features")
    )
    model = fitted(PCA(k=2, inputCol="features", outputCol="scores"), lines)
    shares = [float(x) for x in model.explainedVariance]
    # The gap column is 0 when projecting keeps every row's length, as orthonormal components must.
    kept = model.transform(lines).agg(
        F.max(F.abs(V.norm(V.vector_array("features")) - V.norm(V.vector_array("scores")))).alias("gap")
    )
    rows = spark.createDataFrame(list(enumerate(shares)), "pos int, share double")
    return rows.select("pos", r6("share").alias("share"), r6(kept.scalar(), 6).alias("gap"))


@query(
    "feat_chisq_select",
    """WITH f AS (SELECT (l_linestatus = 'O')::INT AS y, unnest([0, 1, 2]) AS pos,
                         unnest([(l_returnflag = 'A')::INT, (l_returnflag = 'N')::INT, (l_returnflag = 'R')::INT]) AS x FROM lineitem),
            o AS (SELECT pos, x, y, count(*) AS n FROM f GROUP BY ALL),
            e AS (SELECT *, sum(n) OVER (PARTITION BY pos, x) * sum(n) OVER (PARTITION BY pos, y) / sum(n) OVER (PARTITION BY pos) AS e FROM o),
            c AS (SELECT pos, sum((n - e) ** 2 / e) AS chi FROM e GROUP BY 1),
            b AS (SELECT pos FROM c ORDER BY chi DESC, pos LIMIT 1)
       SELECT pos AS selected, CAST(sum(x) AS BIGINT) AS n FROM f JOIN b USING (pos) GROUP BY 1""",
)
def chisq_select(spark, sf):
    names = ["A", "N", "R"]
    lines = table(spark, sf, "lineitem").select(
        F.when(F.col("l_linestatus") == "O", 1.0).otherwise(0.0).alias("label"),
        V.dense_vector([(F.col("l_returnflag") == n).cast("int") for n in names]).alias("features"),
    )
    model = fitted(ops.top_by_chi_square("features", "label", 1), lines)
    chosen = model.transform(lines).agg(F.sum(V.vector_array("selected")[0]).cast("bigint").alias("n"))
    return chosen.select(F.lit(int(model.selectedFeatures[0])).alias("selected"), "n")


@query(
    "feat_rformula",
    """WITH i AS (SELECT l_returnflag, row_number() OVER (ORDER BY count(*) DESC, l_returnflag) - 1 AS idx FROM lineitem GROUP BY 1)
       SELECT l_orderkey, l_linenumber, l_tax AS label, (idx = 0)::INT::DOUBLE AS f0, (idx = 1)::INT::DOUBLE AS f1,
              l_quantity AS f2 FROM lineitem JOIN i USING (l_returnflag)""",
)
def rformula(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_tax", "l_returnflag", "l_quantity")
    shaped = apply(RFormula(formula="l_tax ~ l_returnflag + l_quantity"), lines)
    return V.spread(shaped.select("l_orderkey", "l_linenumber", "label", "features"), "features", ["f0", "f1", "f2"])
