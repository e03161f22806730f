"""Sources and sinks."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, IDF, Tokenizer
from pyspark.sql import functions as F

from loomframe.functions.vectors import array_vector, explode_vector, vector_array

from loomframe.queries.registry import far, none_broken, query, r6, table, violations, wide
from loomframe.session import persisted, scratch_path
from loomframe.sources import files, models


@query("src_csv_header", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def csv_header(spark, sf):
    path = scratch_path(spark, "csv")
    nation = table(spark, sf, "nation")
    nation.write.option("header", True).csv(path)
    text = files.read_csv_text(spark, path, nation.columns)
    return text.select(
        F.col("n_nationkey").try_cast("int").alias("n_nationkey"),
        "n_name",
        F.col("n_regionkey").try_cast("int").alias("n_regionkey"),
    )


@query(
    "src_csv_infer",
    "SELECT CAST(p_partkey AS INTEGER) AS p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part",
)
def csv_infer(spark, sf):
    path = scratch_path(spark, "csv")
    table(spark, sf, "part").write.option("header", True).csv(path)
    return files.read_csv_inferred(spark, path).withColumn("p_partkey", F.col("p_partkey").cast("int"))


@query("src_csv_schema", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def csv_schema(spark, sf):
    path = scratch_path(spark, "csv")
    supplier = table(spark, sf, "supplier")
    supplier.write.csv(path)
    return files.read_csv(spark, path, supplier.schema)


@query("src_tsv", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders")
def tsv(spark, sf):
    path = scratch_path(spark, "tsv")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    orders.write.option("sep", "\t").csv(path)
    return files.read_csv(spark, path, orders.schema, sep="\t")


@query(
    "src_rating_lines",
    """WITH l AS (SELECT o_custkey + 1099511627776 AS u, l_partkey AS i, l_quantity, l_shipdate, l_returnflag = 'R' AS cut
                  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
       SELECT CAST(u AS BIGINT) AS "user", CAST(i AS BIGINT) AS item, CAST(l_quantity AS FLOAT) AS rating,
              CAST(epoch(l_shipdate) AS BIGINT) AS ts, NULL AS rejected FROM l WHERE NOT cut
       UNION ALL SELECT NULL, NULL, NULL, NULL, u || '::' || i || '::none' FROM l WHERE cut""",
)
def rating_lines(spark, sf):
    """Kept ratings and rejected lines; users have ids above 2 to the 40, returned items lines without a rating."""
    path = scratch_path(spark, "ratings")
    items = table(spark, sf, "lineitem").join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    user = F.col("o_custkey") + F.lit(1 << 40)
    whole = F.concat_ws("::", user, "l_partkey", "l_quantity", F.unix_timestamp("l_shipdate"))
    broken = F.concat_ws("::", user, "l_partkey", F.lit("none"))
    items.select(F.when(F.col("l_returnflag") == "R", broken).otherwise(whole).alias("value")).write.text(path)
    ratings, rejected = files.parse_ratings(spark.read.text(path))
    return ratings.withColumn("rejected", F.lit(None).cast("string")).unionByName(rejected.select(F.col("value").alias("rejected")), allowMissingColumns=True)


@query(
    "src_basket_lines",
    """WITH b AS (SELECT l_orderkey, list_sort(list(DISTINCT p_type)) AS items
                  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1)
       SELECT array_to_string(items, '_') AS items, CAST(len(items) AS INTEGER) AS n_items, count(*) AS n_baskets
       FROM b GROUP BY 1, 2""",
)
def basket_lines(spark, sf):
    path = scratch_path(spark, "baskets")
    pairs = table(spark, sf, "lineitem").join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    lines = pairs.select("l_orderkey", "p_type").distinct().groupBy("l_orderkey").agg(F.collect_list("p_type").alias("i"))
    lines.select(F.concat_ws(" ", "i").alias("value")).write.text(path)
    baskets = files.parse_baskets(spark.read.text(path))
    return (
        baskets.groupBy(F.concat_ws("_", F.array_sort("items")).alias("items"), F.size("items").alias("n_items"))
        .agg(F.count(F.lit(1)).alias("n_baskets"))
    )


SEPARATORS = {"space": " ", "comma": ",", "equals": "=", "marker": "[-]"}


@query(
    "src_labelled_text",
    r"""WITH t AS (SELECT CAST(quality AS VARCHAR) AS label,
                          trim(regexp_replace(text, '[ \t\n\x0B\f\r]+', ' ', 'g')) AS message
                   FROM documents JOIN labels USING (doc_id)),
             s AS (SELECT unnest(['space', 'comma', 'equals', 'marker']) AS separator)
        SELECT separator, label, md5(message) AS message,
               CAST(len(string_split(message, ' ')) AS INTEGER) AS n_tokens
        FROM t, s""",
)
def labelled_text(spark, sf):
    joined = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    message = F.trim(F.regexp_replace("text", r"\s+", " "))
    parts = []
    with persisted(joined.select(F.col("quality").cast("string").alias("q"), message.alias("m"))) as rows:
        for name, sep in SEPARATORS.items():
            path = scratch_path(spark, f"labelled-{name}")
            rows.select(F.concat("q", F.lit(sep), "m").alias("value")).write.text(path)
            good, _ = files.parse_labelled(spark.read.text(path), sep)
            parts.append(
                good.select(
                    F.lit(name).alias("separator"),
                    "label",
                    F.md5("text").alias("message"),
                    F.size("tokens").alias("n_tokens"),
                )
            )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query(
    "src_libsvm",
    """SELECT CAST(label AS DOUBLE) AS label, CAST(pos - 1 AS INTEGER) AS pos, round(sum(CAST(x AS DOUBLE)), 6) + 0.0 AS total
       FROM (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings)
       GROUP BY 1, 2""",
)
def libsvm(spark, sf):
    path = scratch_path(spark, "libsvm")
    vectors = table(spark, sf, "embeddings").select("label", array_vector("embedding").alias("features"))
    files.write_libsvm(vectors, path, "label", "features")
    back = files.read_libsvm(spark, path, 64)
    return explode_vector(back, ["label"], "features").groupBy("label", "pos").agg(r6(F.sum("value")).alias("total"))


HAN = "啊鹅衣哦乌"


@query(
    "src_text_charset",
    f"""SELECT p_partkey || ' ' || translate(p_type, 'AEIOU', '{HAN}') AS line, NULL AS rejected FROM part
        UNION ALL SELECT NULL, hex(encode(p_partkey::VARCHAR)) || 'FF' FROM part WHERE p_partkey % 100 = 7""",
)
def text_charset(spark, sf):
    """Chinese lines written and read in GB2312, some with a byte that it does not have."""
    path = scratch_path(spark, "charset")
    parts = table(spark, sf, "part")
    files.write_encoded_lines(parts.select(F.concat_ws(" ", "p_partkey", F.translate("p_type", "AEIOU", HAN)).alias("line")), path, "line")
    broken = parts.where("p_partkey % 100 = 7").select(F.concat(F.col("p_partkey").cast("string").cast("binary"), F.unhex(F.lit("FF"))).cast("string").alias("value"))
    broken.write.mode("append").text(path)
    good, bad = files.read_encoded_lines(spark, path, "gb2312")
    kept = good.select(F.col("text").alias("line"), F.lit(None).cast("string").alias("rejected"))
    return kept.unionByName(bad.select(F.lit(None).cast("string").alias("line"), F.hex("raw").alias("rejected")))


@query(
    "src_bad_label_report",
    """WITH l AS (SELECT o_orderkey, o_orderpriority, o_orderkey % 16 AS shard,
                         row_number() OVER (PARTITION BY o_orderkey % 16 ORDER BY o_orderkey) AS line_number FROM orders)
       SELECT o_orderkey AS source_id, o_orderpriority AS label, 'shard=' || shard AS file, line_number FROM l
       WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM')""",
)
def bad_label_report(spark, sf):
    """Lines with an unknown label, by the folder of their file and their number in it."""
    path = scratch_path(spark, "labels")
    orders = table(spark, sf, "orders").withColumn("shard", F.pmod("o_orderkey", F.lit(16)))
    lines = orders.repartition("shard").sortWithinPartitions("shard", "o_orderkey")
    lines.select("shard", F.concat_ws("\t", "o_orderpriority", "o_orderkey").alias("value")).write.partitionBy("shard").text(path)
    bad = files.unknown_labels(files.read_numbered_lines(spark, path), "value", ["1-URGENT", "2-HIGH", "3-MEDIUM"], sep="\t")
    return bad.select(
        F.split("value", "\t")[1].cast("bigint").alias("source_id"), "label", F.regexp_extract("file", "/(shard=[0-9]+)/", 1).alias("file"), "line_number"
    )


def _text_stages():
    return Pipeline(
        stages=[
            Tokenizer(inputCol="text", outputCol="tokens"),
            HashingTF(inputCol="tokens", outputCol="tf", numFeatures=1000),
            IDF(inputCol="tf", outputCol="features"),
            LogisticRegression(maxIter=10, regParam=0.01),
        ]
    )


def _labelled_documents(spark, sf):
    return table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id").select(
        "doc_id", "text", F.col("quality").cast("double").alias("label")
    )


def _differing(first, second):
    a = first.select("doc_id", vector_array("probability").alias("p1"), F.col("prediction").alias("y1"))
    b = second.select("doc_id", vector_array("probability").alias("p2"), F.col("prediction").alias("y2"))
    both = a.join(b, "doc_id")
    return violations(both, far(F.col("p1")[1], F.col("p2")[1], 1e-9) | (F.col("y1") != F.col("y2")))


def _all_documents(spark, sf):
    return wide(spark, sf, "documents", "doc_id", "text").withColumn("text", F.coalesce("text", F.lit("")))


@query("sink_pipeline_save", none_broken("documents"))
def pipeline_save(spark, sf):
    """Trained on the labelled documents; the saved model scores all documents like the one that was trained."""
    docs = _all_documents(spark, sf)
    model = _text_stages().fit(_labelled_documents(spark, sf))
    back = models.load_fitted(models.save(model, scratch_path(spark, "model")))
    return _differing(model.transform(docs), back.transform(docs))


@query("src_pipeline_load", none_broken("documents"))
def pipeline_load(spark, sf):
    """Loaded stages, trained on the labelled documents, score all documents like the stages that were saved."""
    labelled, docs = _labelled_documents(spark, sf), _all_documents(spark, sf)
    stages = _text_stages()
    back = models.load_unfitted(models.save(stages, scratch_path(spark, "stages")))
    return _differing(stages.fit(labelled).transform(docs), back.fit(labelled).transform(docs))
