import random
from itertools import product

import pytest
from pyspark.sql import functions as F

from loomframe.operators import patterns as pat

BASKETS = ["r z h k p", "z y x w v u t s", "s x o n r", "x z y m t s q e", "z", "x z y r q t p"]


@pytest.fixture(scope="module")
def model(spark):
    rows = [(i, item) for i, line in enumerate(BASKETS) for item in line.split()]
    df = spark.createDataFrame(rows + rows[:3], "basket int, item string")
    return pat.mine(pat.baskets(df, "basket", "item", 0.5), 0.5, 0.8)


def test_known_itemsets_and_rules(model):
    found = {r["items"]: r["freq"] for r in pat.itemset_rows(model).collect()}
    assert len(found) == 18
    assert {k: found[k] for k in ("t", "t_x", "t_x_z", "t_z", "s", "s_x", "z", "y", "t_y")} == {
        "t": 3, "t_x": 3, "t_x_z": 3, "t_z": 3, "s": 3, "s_x": 3, "z": 5, "y": 3, "t_y": 3,
    }
    assert pat.rule_rows(model).count() == 23


def test_also_viewed_lists_single_items_only(model):
    rows = [tuple(r) for r in pat.also_viewed(model).orderBy("item", "rank").collect()]
    assert [r for r in rows if r[0] == "s"] == [("s", 1, "x", 1.0)]
    assert [r for r in rows if r[0] == "y"] == [("y", 1, "t", 1.0), ("y", 2, "x", 1.0), ("y", 3, "z", 1.0)]


def test_dropping_rare_items_first_changes_nothing(spark):
    rng = random.Random(4)
    rows = [(b, f"i{min(int(rng.expovariate(0.25)), 60)}") for b in range(300) for _ in range(rng.randrange(1, 9))]
    rows += [(0, f"only{i}") for i in range(500)]
    df = spark.createDataFrame(rows, "basket int, item string")
    found = lambda support: {tuple(r) for r in pat.itemset_rows(pat.mine(pat.baskets(df, "basket", "item", support), 0.1, 0.5)).collect()}
    assert found(0.1) == found(None)
    assert pat.baskets(df, "basket", "item", 0.1).agg(F.max(F.size("items"))).first()[0] < 30


def _contains(sequence, pattern):
    at = iter(sequence)
    return all(any(x == y for y in at) for x in pattern)


@pytest.mark.parametrize("per_shard", [3, 1000])
def test_event_sequences_match_brute_force_and_prefix_span(spark, per_shard):
    rng = random.Random(8)
    sequences = {u: [rng.choice("abcd") for _ in range(rng.randrange(1, 7))] for u in range(40)}
    sequences[0] = [rng.choice("abcd") for _ in range(400)]
    events = [(u, t, item) for u, seq in sequences.items() for t, item in enumerate(seq)]
    df = spark.createDataFrame(events, "u int, t int, item string")
    got = pat.frequent_event_sequences(df, ["u"], ["t"], "item", 0.3, 3, per_shard)
    rows = {tuple(r["pattern"]): r["freq"] for r in got.collect()}
    expected = {}
    for n in (1, 2, 3):
        for p in product("abcd", repeat=n):
            freq = sum(_contains(s, p) for s in sequences.values())
            if freq >= 0.3 * len(sequences):
                expected[p] = freq
    assert rows == expected
    arrays = spark.createDataFrame([([[x] for x in s],) for s in sequences.values()], "sequence array<array<string>>")
    single = pat.frequent_sequences(arrays, 0.3, 3).filter(F.forall("sequence", lambda s: F.size(s) == 1))
    assert {tuple(x[0] for x in r["sequence"]): r["freq"] for r in single.collect()} == expected


def test_prefix_span_on_itemset_sequences(spark):
    rows = [([[1, 2], [3]],), ([[1], [3, 2], [1, 2]],), ([[1, 2], [5]],), ([[6]],)]
    df = spark.createDataFrame(rows, "sequence array<array<int>>")
    found = {tuple(tuple(s) for s in r["sequence"]): r["freq"] for r in pat.frequent_sequences(df, 0.5).collect()}
    assert found == {((1,),): 3, ((2,),): 3, ((3,),): 2, ((1, 2),): 3, ((1,), (3,)): 2}


@pytest.mark.parametrize("per_shard", [3, 1000])
def test_itemset_sequences_match_prefix_span(spark, per_shard):
    rng = random.Random(12)
    sequences = {u: [sorted(rng.sample("abcd", rng.randrange(1, 4))) for _ in range(rng.randrange(1, 5))] for u in range(40)}
    sequences[0] = [sorted(rng.sample("abcd", rng.randrange(1, 4))) for _ in range(60)]
    events = [(u, t, i) for u, steps in sequences.items() for t, items in enumerate(steps) for i in items]
    events += [events[0], (1, None, "a"), (2, 0, None)]
    df = spark.createDataFrame(events, "u int, t int, item string")
    got = pat.frequent_itemset_sequences(df, ["u"], "t", "item", 0.4, 4, per_shard).collect()
    arrays = spark.createDataFrame([(s,) for s in sequences.values()], "sequence array<array<string>>")
    expected = pat.frequent_sequences(arrays, 0.4, 4).collect()
    plain = lambda sequence: tuple(tuple(sorted(x)) for x in sequence)
    assert {plain(r["pattern"]): r["freq"] for r in got} == {plain(r["sequence"]): r["freq"] for r in expected}
    assert len(got) == len(expected) > 20
    assert pat.frequent_itemset_sequences(df.limit(0), ["u"], "t", "item", 0.4).count() == 0


def test_baskets_meet_the_rules_in_parts_of_bounded_size(spark, monkeypatch):
    """Baskets are dealt once, into as many parts as their number asks for; rows per basket and rule are not moved."""
    monkeypatch.setattr(pat, "TASK_BASKETS", 20, raising=False)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        rows = [(k, [x for i, x in enumerate("abcde") if (k >> i) & 1 or (k + i) % 3 == 0]) for k in range(200)]
        rows += [(3, ["a"]), (None, ["a", "b"]), (300, [])]
        frame = spark.createDataFrame(rows, "o long, items array<string>")
        model = pat.mine(frame, 0.2, 0.3)
        found = pat.implied_items(frame, model, "o")
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "ENSURE_REQUIREMENTS" not in plan and "hashpartitioning(o#" in plan and ", 11), REPARTITION_BY_NUM" in plan
        rules = [(set(r.antecedent), r.consequent[0]) for r in model.associationRules.collect()]
        held = {}
        for o, items in rows:
            held.setdefault(o, set()).update(items)
        want = [(o, tuple(items), tuple(sorted({c for a, c in rules if o is not None and a <= held[o]} - held[o]))) for o, items in rows]
        got = [(r.o, tuple(r["items"]), tuple(r.prediction)) for r in found.collect()]
        assert sorted(got, key=str) == sorted(want, key=str) and any(w[2] for w in want)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
