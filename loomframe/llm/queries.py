"""One query per operator, over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from loomframe.llm import bpe, embeddings, fingerprints, jaccard, licences, merkle, mixing, ngrams, packing, pieces, quality, sharding, spelling

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query("op1_sharding")
def op1_sharding(spark: SparkSession, sf: str) -> DataFrame:
    """All documents in shuffled shards 0 to 15 by the key law, read back from the shard files."""
    rows = sharding.shard_files(table(spark, sf, "documents"), 16)
    return rows.select(
        "doc_id",
        sharding.text_bytes("text").alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        F.lit("key").alias("law"),
        "shard",
        "slot",
        sharding.shard_of("doc_id", 17).alias("grown_shard"),
    )


@query("op2_fingerprints")
def op2_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    """Every document's fingerprint, its edited form's, and how alike they and the next document's are."""
    return fingerprints.edited_fingerprints(table(spark, sf, "documents")).withColumnRenamed("id", "doc_id")


@query("op3_embedding_copies")
def op3_embedding_copies(spark: SparkSession, sf: str) -> DataFrame:
    """The links and components of all vectors at a cosine of 0.9."""
    return embeddings.near_vectors(table(spark, sf, "embeddings"), 0.9).withColumnRenamed("id", "vec_id")


@query("op4_sentencepiece")
def op4_sentencepiece(spark: SparkSession, sf: str) -> DataFrame:
    """Every document encoded and decoded with a SentencePiece model."""
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    return pieces.round_trips(table(spark, sf, "documents"), path).withColumnRenamed("id", "doc_id")


@query("op5_jaccard_join")
def op5_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    """Components of documents whose three-word shingle sets share nine tenths of their union."""
    found = jaccard.similar_sets(table(spark, sf, "documents"), 3, 9, 10)
    return found.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


def _licence_sql() -> str:
    """The rules as joins of known sentences: of a rule's runs the one that ends first, and begins last."""
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    known = ", ".join(f"({quote(t)}, {quote(i)})" for i, t in licences.SENTENCES.items())
    found = []
    for r in licences.RULES:
        n = len(r.sentences)
        joins = "".join(
            f" JOIN k s{i} ON s{i}.doc_id = s0.doc_id AND s{i}.sentence = {quote(name)} AND s{i}.place - s{i - 1}.place BETWEEN 1 AND {r.gap + 1}"
            for i, name in enumerate(r.sentences)
            if i
        )
        found.append(
            f"SELECT s0.doc_id, {quote(r.licence)} AS licence, true AS complete, {n} AS n, s0.place AS first, s{n - 1}.place AS last "
            f"FROM k s0{joins} WHERE s0.sentence = {quote(r.sentences[0])}"
        )
    names = {r.licence: sorted({s for q in licences.RULES if q.licence == r.licence for s in q.sentences}) for r in licences.RULES}
    members = ", ".join(f"({quote(name)}, {quote(s)})" for name, each in names.items() for s in each)
    return f"""
    WITH c AS (SELECT doc_id, regexp_split_to_array(text, '[\n\r]+|[.!?;:]+[ \t\n\r\f]') AS parts FROM documents),
    d AS (SELECT doc_id, list_filter(list_transform(parts, lambda x: trim(regexp_replace(lower(x), '[^a-z0-9]+', ' ', 'g'))), lambda x: x <> '') AS said FROM c),
    u AS (SELECT doc_id, unnest(said) AS said, unnest(range(len(said))) AS place FROM d),
    k AS (SELECT doc_id, place, t.sentence FROM u JOIN (VALUES {known}) t(said, sentence) USING (said)),
    f AS ({" UNION ALL ".join(found)}),
    w AS (SELECT *, row_number() OVER (PARTITION BY doc_id, licence ORDER BY n DESC, last, first DESC) AS nth FROM f WHERE complete),
    p AS (SELECT doc_id, m.licence, count(DISTINCT k.sentence) AS n, min(place) AS first, max(place) AS last
          FROM k JOIN (VALUES {members}) m(licence, sentence) USING (sentence) GROUP BY ALL)
    SELECT doc_id, p.licence, nth IS NOT NULL AS complete, coalesce(w.n, p.n)::INT AS n_sentences,
           coalesce(w.first, p.first)::INT AS first_sentence, coalesce(w.last, p.last)::INT AS last_sentence
    FROM p LEFT JOIN (SELECT * FROM w WHERE nth = 1) w USING (doc_id, licence)
    """


@query("op6_licence_scan", _licence_sql())
def op6_licence_scan(spark: SparkSession, sf: str) -> DataFrame:
    """The licences named in each document."""
    return licences.recognised(table(spark, sf, "documents")).withColumnRenamed("id", "doc_id")


@query("op7_token_packing")
def op7_token_packing(spark: SparkSession, sf: str) -> DataFrame:
    """Every document's place, length and checksum, from the packed token files."""
    import public_tokenizers

    path = packing.token_files(table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"), 1)
    return packing.read_blocks(spark, path).withColumnRenamed("id", "doc_id")


@query(
    "op8_source_mixing",
    """
    WITH d AS (
        SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
               ('0x' || substr(md5('11|' || coalesce(doc_id::VARCHAR, '') || '|' || coalesce(text, '')), 1, 15))::BIGINT AS rank
        FROM documents),
    s AS (
        SELECT source, sum(size)::BIGINT AS source_size,
               ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT AS turn, [3.0, 1.0, 2.0][turn]::DOUBLE AS weight,
               [4.0, 0.5, 1.0][turn]::DOUBLE AS a, [2.0, 1.5, 3.0][turn]::DOUBLE AS b
        FROM d GROUP BY source),
    f AS (
        SELECT *, 2.0::DOUBLE * source_size AS fill, 1.5::DOUBLE * sum(source_size) OVER () AS demand FROM s),
    l AS (
        SELECT *, coalesce(fill <= (demand - coalesce(sum(fill) OVER (ORDER BY source_size / weight, source NULLS LAST
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                  / sum(weight) OVER (ORDER BY source_size / weight, source NULLS LAST
                      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) * weight, false) AS is_full
        FROM f),
    t AS (
        SELECT source, source_size, a, b,
               CASE WHEN is_full THEN fill
                    ELSE (demand - coalesce(sum(CASE WHEN is_full THEN fill END) OVER (), 0)) * weight
                         / sum(CASE WHEN NOT is_full THEN weight END) OVER () END AS target
        FROM l),
    r AS (
        SELECT d.*, t.source_size, t.target, t.a, t.b,
               coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY rank, doc_id, size
                            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS done
        FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
    c AS (
        SELECT *, (CASE WHEN size > 0 THEN greatest(0, least(2, ceil((target - (done + size / 2)) / source_size))) ELSE 0 END)::INT AS copies,
               least((done + size / 2) / target, 1.0) AS share
        FROM r)
    SELECT doc_id, size, source_size, target, (copies * size)::BIGINT AS taken, copies,
           round(CASE WHEN copies > 0 THEN (sqrt(a * a + (b - a) * (a + b) * share) - a) / (b - a) END, 6) AS position
    FROM c
    """,
)
def op8_source_mixing(spark: SparkSession, sf: str) -> DataFrame:
    """How many words of each document a mix of all sources takes, in the order of its curriculum.

    The schedules' integrals are 3, 1, 2 in turn. Rows are range-sorted by the position of their first copy, between 0 and
    1 of the training; those that are not taken come last, without one.
    """
    planned = mixing.plan(mixing.measured(table(spark, sf, "documents")), [[4, 2], [0.5, 1.5], [1, 3]], 1.5, 2)
    return mixing.in_order(planned).select(F.col("key").alias("doc_id"), "size", "source_size", "target", "taken", "copies", F.round("position", 6).alias("position"))


@query("op9_lm_scores")
def op9_lm_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Every document's score under the n-gram model of nine tenths of them, and under single words."""
    return ngrams.scores(table(spark, sf, "documents")).withColumnRenamed("id", "doc_id")


@query("op10_quality_classifier")
def op10_quality_classifier(spark: SparkSession, sf: str) -> DataFrame:
    """Every document's perplexity, its language's limit and whether it is kept."""
    docs = table(spark, sf, "documents")
    found = quality.by_row(docs, quality.judged(docs, table(spark, sf, "labels")))
    return found.select(F.col("id").alias("doc_id"), "lang", "n_tokens", "log10_ppl", F.col("limit").alias("lang_limit"), "kept")


@query("op11_bpe")
def op11_bpe(spark: SparkSession, sf: str) -> DataFrame:
    """Every document encoded and decoded with a byte-level BPE file."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    back = bpe.decoded(bpe.encoded(table(spark, sf, "documents"), path), path)
    ids = F.col("ids").cast("array<string>")
    return back.select(
        F.col("id").alias("doc_id"),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", ids), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


def _crc32_sql(text: str) -> str:
    """The unsigned CRC-32 of a text's UTF-8 bytes: per byte one exclusive or and eight steps (-1) of the polynomial."""
    byte = f"('0x' || substr(hex(encode({text})), (2 * i + 1)::INT, 2))::BIGINT"
    steps = f"flatten(list_transform(range(octet_length(encode({text}))), lambda i: [{byte}, -1, -1, -1, -1, -1, -1, -1, -1]))"
    step = "CASE WHEN b >= 0 THEN xor(c, b) WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    return f"xor(list_reduce({steps}, lambda c, b: {step}, 4294967295), 4294967295)"


def _merkle_sql() -> str:
    """Levels by a recursive query over whole levels; proofs by a second one that looks siblings up."""
    field = lambda c: f"coalesce(octet_length(encode({c}::VARCHAR)) || ':' || {c}::VARCHAR, '-')"
    leaf = lambda n: f"sha256({' || '.join(field(n if c == 'n_chars' else c) for c in merkle.FIELDS)})"
    level = (
        "SELECT {tree}, level + 1, idx // 2, sha256(string_agg(h, '' ORDER BY idx)), (n + 1) // 2 "
        "FROM {source} WHERE n > 1 GROUP BY {tree}, level, idx // 2, n"
    )
    return f"""
    WITH RECURSIVE d AS (
        SELECT doc_id, lang, {leaf('n_chars')} AS leaf,
               CASE WHEN n_chars IS NOT NULL AND {_crc32_sql('doc_id::VARCHAR')} % 7 = 0 THEN {leaf('(n_chars + 1)')} END AS wrong
        FROM documents),
    g AS (SELECT lang, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS tree FROM (SELECT DISTINCT lang FROM d)),
    l AS (
        SELECT d.*, g.tree, row_number() OVER (PARTITION BY g.tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY g.tree) AS n
        FROM d JOIN g ON d.lang IS NOT DISTINCT FROM g.lang),
    nodes(tree, level, idx, h, n) AS (
        SELECT tree, 0, idx, leaf, n FROM l UNION ALL {level.format(tree="tree", source="nodes")}),
    sub AS (SELECT tree, h AS subroot, level AS depth FROM nodes WHERE n = 1),
    top(level, idx, h, n) AS (
        SELECT 0, tree, subroot, (SELECT count(*) FROM sub) FROM sub
        UNION ALL {level.format(tree="0", source="top").replace("SELECT 0, ", "SELECT ").replace("GROUP BY 0, ", "GROUP BY ")}),
    every AS (
        SELECT tree, level, idx, h FROM nodes WHERE n > 1
        UNION ALL SELECT -1, level, idx, h FROM top),
    climb(tree, idx, spot, level, place, h, proof, left_levels) AS (
        SELECT l.tree, l.idx, l.tree, 0, l.idx, coalesce(wrong, leaf), '', depth FROM l JOIN sub USING (tree)
        UNION ALL
        SELECT c.tree, c.idx, CASE WHEN left_levels = 0 THEN -1 ELSE c.spot END, CASE WHEN left_levels = 0 THEN 0 ELSE c.level + 1 END,
               CASE WHEN left_levels = 0 THEN c.tree ELSE c.place // 2 END,
               CASE WHEN left_levels = 0 THEN c.h WHEN c.place % 2 = 1 THEN sha256(e.h || c.h) ELSE sha256(c.h || coalesce(e.h, '')) END,
               CASE WHEN left_levels = 0 THEN c.proof ELSE c.proof || coalesce(e.h, '') END,
               CASE WHEN left_levels = 0 THEN (SELECT max(level) FROM top) ELSE left_levels - 1 END
        FROM climb c LEFT JOIN every e ON e.tree = c.spot AND e.level = c.level AND e.idx = c.place + 1 - 2 * (c.place % 2)
        WHERE left_levels > 0 OR c.spot >= 0),
    ends AS (SELECT * FROM climb WHERE spot = -1 AND left_levels = 0)
    SELECT l.doc_id, l.leaf, sub.subroot, (SELECT h FROM top WHERE n = 1) AS root, sha256(ends.proof) AS proof_sha256,
           ends.h AS folded_root, ends.h = (SELECT h FROM top WHERE n = 1) AS verified
    FROM l JOIN sub USING (tree) JOIN ends ON ends.tree = l.tree AND ends.idx = l.idx
    """


@query("op12_merkle_manifest", _merkle_sql())
def op12_merkle_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Every document's leaf, subroot, root and proof, and whether its climb, tampered or not, reaches the root."""
    chosen = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    more = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("string")
    tampered = F.when(chosen & F.col("n_chars").isNotNull(), merkle.leaf_digest(n_chars=more))
    found = merkle.proofs(table(spark, sf, "documents"), tampered)
    digests = {c: merkle.hex_text(F.col(c)) for c in ("leaf", "subroot", "root", "folded_root")}
    found = found.withColumns({**digests, "proof_sha256": F.sha2(merkle.hex_text(F.col("proof")), 256)})
    return found.select(F.col("key").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


@query(
    "op13_spelling_variants",
    f"""
    WITH RECURSIVE r AS (
        SELECT coalesce(doc_id::VARCHAR, '') AS key, translate(unnest(regexp_extract_all(text, '[A-Za-z\\x{{00C0}}-\\x{{00FF}}]{{7,}}')),
                   '{spelling.UPPER}', '{spelling.LOWER}') AS run
        FROM documents),
    h AS (
        SELECT *, {_crc32_sql("(key || ':' || run)")} AS h FROM (SELECT key, run, count(*) AS n FROM r GROUP BY ALL)),
    m AS (
        SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n
        FROM h),
    w AS (SELECT word, sum(n)::BIGINT AS n FROM m WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
    c AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS cut
          FROM (SELECT word, n, unnest(range(1, length(word) + 1))::INT AS i FROM w)),
    near AS (
        SELECT DISTINCT * FROM (
            SELECT a.word, b.word AS other, b.n FROM c a JOIN c b ON a.cut = b.cut AND a.i = b.i AND a.word <> b.word
            UNION ALL SELECT c.word, w.word, w.n FROM c JOIN w ON c.cut = w.word
            UNION ALL SELECT w.word, c.word, c.n FROM c JOIN w ON c.cut = w.word)),
    best AS (
        SELECT word, count(*) AS n_near, max(n) AS form_n, arg_min(other, (-n, encode(other))) AS form FROM near GROUP BY word),
    f AS (
        SELECT w.word, CASE WHEN form_n >= {spelling.RATIO} * w.n THEN form END AS form, w.n, coalesce(n_near, 0) AS n_near,
               CASE WHEN form_n >= {spelling.RATIO} * w.n THEN form_n END AS form_n
        FROM w LEFT JOIN best USING (word)),
    follow(word, root, next) AS (
        SELECT word, word, form FROM f
        UNION ALL SELECT follow.word, f.word, f.form FROM follow JOIN f ON follow.next = f.word)
    SELECT f.word, f.form, follow.root, f.n, f.n_near, f.form_n FROM f JOIN follow ON follow.word = f.word AND follow.next IS NULL
    """,
)
def op13_spelling_variants(spark: SparkSession, sf: str) -> DataFrame:
    """Every word with its common form, the last form of its chain and how many words are near."""
    return spelling.variants(spelling.word_counts(table(spark, sf, "documents")))
