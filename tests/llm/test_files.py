"""Shards, packed token files and mixing against brute force."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomframe.llm import mixing, packing, sharding, words

ODD = [(5, None), (1, ""), (2, "a b  c"), (3, "a b  c"), (None, "x"), (9, "Ünï <|endoftext|> it's 12!! 漢字 \x1c\x85"), (7, "w " * 30000)]


def test_words_are_those_of_the_pattern():
    texts = [(t or "").encode() for _, t in ODD] + [b" lead", b"A a", b"x" * 9000 + b" y"]
    kept, words.CHUNK = words.CHUNK, 7
    try:
        hashes, counts = words.word_hashes(*words.joined_parts(texts))
    finally:
        words.CHUNK = kept
    assert counts.tolist() == [len(t.split()) for t in texts]
    flat = [w.lower() for t in texts for w in t.split()]
    assert len(set(zip(flat, hashes.tolist()))) == len(set(flat)) == len(set(hashes.tolist()))


@pytest.mark.parametrize("bits", [1, 7, 16, 17, 31])
def test_pack_round_trip(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 1001)
    packed = packing.pack(ids, bits)
    assert len(packed) == (1001 * bits + 7) // 8
    assert packing.unpack(packed, bits, 0, 1001).tolist() == ids.tolist()
    assert packing.unpack(packed, bits, 13, 700).tolist() == ids[13:700].tolist()
    assert packing.bits_for(1 << bits) == bits


def test_token_files(spark, docs):
    P = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = P.path("word_bpe_49k.json")
    tool = Tokenizer.from_file(path)
    frame = docs(ODD).withColumn("ids", F.lit("clash")).withColumn("range", F.lit(1))
    files = packing.token_files(frame, path, 1)
    got = {r["id"]: tuple(r)[1:] for r in packing.read_blocks(spark, files).collect()}
    start, every = 0, []
    for key, text in sorted(ODD, key=lambda r: (r[0] is not None, r[0])):
        ids = [*tool.encode(text or "", add_special_tokens=False).ids, 1]
        assert got[key] == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
        every += ids
    assert packing.ids_at(spark, files, 3, 40) == every[3:40]
    assert packing.read_blocks(spark, packing.token_files(docs([]), path, 1)).count() == 0


def test_shards(spark, docs):
    rows = [*ODD, *[(k, f"text {k % 3}") for k in range(10, 400)]]
    frame = docs(rows).withColumn("slot", F.lit("clash"))
    out = sharding.shard_files(frame, 5, bucket_bytes=256).withColumn("g", sharding.shard_of("doc_id", 6)).collect()
    assert sorted((r["doc_id"] or -1, r["text"] or "") for r in out) == sorted((k or -1, t or "") for k, t in rows)
    for s in range(5):
        assert sorted(r["slot"] for r in out if r["shard"] == s) == list(range(sum(r["shard"] == s for r in out)))
    assert all(r["g"] in (r["shard"], 5) for r in out) and {r["g"] for r in out} == set(range(6))
    again = sharding.shard_files(frame.repartition(7), 5, bucket_bytes=256).collect()
    assert {(r["doc_id"], r["shard"], r["slot"]) for r in again} == {(r["doc_id"], r["shard"], r["slot"]) for r in out}
    order = [r["doc_id"] for r in sorted((r for r in out if r["shard"] == 1), key=lambda r: r["slot"])]
    assert order != sorted(order)
    assert sharding.shard_files(docs([]), 3).count() == 0


def brute_targets(sizes, weights, share, cap):
    goal, left, full = share * sum(sizes), dict(enumerate(weights)), {}
    while left:
        rest = goal - sum(full.values())
        over = [i for i in left if rest * left[i] / sum(left.values()) >= cap * sizes[i]]
        if not over:
            return [full.get(i, rest * weights[i] / sum(left.values())) for i in range(len(sizes))]
        for i in over:
            full[i] = cap * sizes[i]
            del left[i]
    return [full[i] for i in range(len(sizes))]


def test_mix(spark, docs):
    rows = [(k, "w " * (k % 7), "en", ["b", "a", None, "c"][(k % 13) % 4]) for k in range(300)]
    rows += [(1000, None, "en", "a"), (1001, "", "en", "a"), (1002, "w " * 9, "en", "a"), (1002, "w " * 9, "en", "a")]
    frame = docs(rows)
    weights = [3, 1, 2, 3]
    planned = mixing.plan(mixing.measured(frame), [[3], [1], [2]], 1.5, 2).collect()
    assert len(planned) == len(rows)
    order = ["a", "b", "c", None]
    size = {s: sum(len((r[1] or "").split()) for r in rows if r[3] == s) for s in order}
    want = dict(zip(order, brute_targets([size[s] for s in order], weights, 1.5, 2)))
    for s in order:
        mine = [r for r in planned if r["source"] == s]
        assert mine[0]["target"] == pytest.approx(want[s]) and mine[0]["source_size"] == size[s]
        assert abs(sum(r["taken"] for r in mine) - want[s]) <= 5
    assert all(r["taken"] <= 2 * r["size"] for r in planned)
    sequence = mixing.mixed(frame.withColumn("copy", F.lit("clash")), [[3, 1], [1], [2]], 1.5).collect()
    assert sum(len(r["text"].split()) for r in sequence) == pytest.approx(1.5 * sum(size.values()), abs=20)
    assert sequence == sorted(sequence, key=lambda r: (r["position"], r["doc_id"]))
    assert mixing.mixed(docs([]), [[1]], 1.5).count() == 0


def test_position_inverts_the_schedule(spark):
    knots = [4.0, 1.0, 0.0, 2.0]
    times = np.linspace(0, 1, 3001)
    area = np.concatenate([[0], np.cumsum((np.interp(times, np.linspace(0, 1, 4), knots)[1:] + np.interp(times, np.linspace(0, 1, 4), knots)[:-1]) / 2)])
    area /= area[-1]
    frame = spark.createDataFrame([(float(x),) for x in (0.0, 0.1, 0.5, 0.7, 0.9, 1.0)], "done double")
    for r in frame.withColumn("p", mixing.position(F.array(*[F.lit(k) for k in knots]), F.col("done"))).collect():
        assert np.interp(r["p"], times, area) == pytest.approx(r["done"], abs=1e-3)


def test_targets_follow_the_integrals_of_the_schedules(spark, docs):
    frame = docs([(k, "w " * 10, "en", "ab"[k % 2]) for k in range(400)])
    planned = mixing.plan(mixing.measured(frame), [[3, 1], [0, 2, 6, 2]], 0.5, 2).collect()
    target = {r["source"]: r["target"] for r in planned}
    assert target["a"] == pytest.approx(2000 * 2 / (2 + 3)) and target["b"] == pytest.approx(2000 * 3 / (2 + 3))


def test_rows_in_the_order_of_the_curriculum(spark, docs):
    frame = docs([(k, "w " * (k % 7), "en", "abc"[k % 3]) for k in range(600)])
    schedules = [[3, 1], [0, 2], [1]]
    planned = mixing.in_order(mixing.plan(mixing.measured(frame), schedules, 0.7, 2)).collect()
    sequence = mixing.mixed(frame, schedules, 0.7).where("copy = 0").collect()
    assert [(r["position"], r["key"]) for r in planned if r["taken"]] == [(r["position"], r["doc_id"]) for r in sequence]
    first = [r["taken"] > 0 for r in planned]
    assert len(planned) == 600 and 0 < sum(first) < 600 and all(first[: sum(first)])
    early = lambda s: np.mean([r["position"] < 0.5 for r in sequence if r["source"] == s])
    assert early("a") == pytest.approx(5 / 8, abs=0.06) and early("b") == pytest.approx(1 / 4, abs=0.06)


def test_shards_with_a_hot_key(spark, docs):
    """Half of the rows have one key, a third are equal; joins may be cut at skewed parts."""
    rows = [(7, f"text number {k}") for k in range(3000)] + [(8, "all the same")] * 2000 + [(100 + k, f"t{k}") for k in range(1000)]
    kept = {}
    small = {"skewJoin.enabled": "true", "skewJoin.skewedPartitionThresholdInBytes": "1k", "advisoryPartitionSizeInBytes": "1k", "skewJoin.skewedPartitionFactor": "1.1"}
    for name, value in small.items():
        kept[name] = spark.conf.get(f"spark.sql.adaptive.{name}")
        spark.conf.set(f"spark.sql.adaptive.{name}", value)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = sharding.shard_files(docs(rows), 4, bucket_bytes=2000).select("doc_id", "text", "shard", "slot").collect()
        again = sharding.shard_files(docs(rows), 4, bucket_bytes=2000).select("doc_id", "text", "shard", "slot").collect()
    finally:
        for name, value in kept.items():
            spark.conf.set(f"spark.sql.adaptive.{name}", value)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert sorted(map(tuple, out)) == sorted(map(tuple, again))
    assert sorted((r["doc_id"], r["text"]) for r in out) == sorted(rows)
    for s in range(4):
        slots = sorted(r["slot"] for r in out if r["shard"] == s)
        assert slots == list(range(len(slots)))
    sizes = sharding.scattered(docs(rows), 4, "doc_id", "text", 1, 2000).groupBy("_bucket").agg(F.sum(sharding.text_bytes("text")).alias("n"))
    assert sizes.agg(F.max("n")).first()[0] < 3 * 2000


def test_bucket_offsets_do_not_shuffle_the_rows(spark, docs, tmp_path):
    """The rows are shuffled into buckets once; to learn where their bucket begins they stay where they are."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        frame = docs([(k, f"text {k}") for k in range(100)])
        schema = sharding.write_shards(frame, 4, str(tmp_path / "shards"), bucket_bytes=256)
        found = sharding.read_shards(spark, str(tmp_path / "shards"), schema)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        assert found.count() == 100
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_mixing_deals_documents_once(spark, docs):
    """The pipeline's mixture moved whole texts three times: to number them, to join their places, to sort them."""
    rows = [(k, f"{k} " + "w " * (k % 7), "en", "abc"[k % 3]) for k in range(60)]
    rows += [(100, "x y z", "en", s) for s in ("a", "b", None, "a", None)] * 3
    frame, schedules = docs(rows), [[3, 1], [0, 2], [1]]
    name = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(name, "-1")
    try:
        loose = mixing.mixed(frame, schedules, 1.1, ordered=False)
        plan = loose._jdf.queryExecution().executedPlan().toString()
        found = loose.collect()
    finally:
        spark.conf.unset(name)
    # The other exchange is that of the places.
    assert plan.count("Exchange hashpartitioning") <= 2 and "rangepartitioning" not in plan
    key = lambda r: (r["doc_id"], r["source"] or "", r["copy"], r["position"])
    assert sorted(found, key=key) == sorted(mixing.mixed(frame, schedules, 1.1).collect(), key=key)
    planned = mixing.plan(mixing.measured(frame), schedules, 1.1, 2).collect()
    taken = lambda rows, n: sorted((s, sum(n(r) for r in rows if (r["source"] or "") == s)) for s in ("", "a", "b", "c"))
    assert taken(found, lambda r: 1) == taken(planned, lambda r: r["copies"])
