import random
from collections import Counter, defaultdict

from snapflow.llm.mixing import cyclic_weights, emit_copies, mix

SCHEMA = "doc_id long, text string, source string, size long, rank long"


def targets(sizes, budget=1.5, cap=2.0, weights=(5, 2, 1)):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = budget * sum(sizes.values()), set(names), {}
    while open_:
        share = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if cap * sizes[s] < share * weight[s]}
        if not over:
            return out | {s: share * weight[s] for s in open_}
        for s in over:
            out[s] = cap * sizes[s]
            left -= out[s]
        open_ -= over
    return out


def frame(spark, data):
    return spark.createDataFrame([(*r, -1, -2) for r in data], SCHEMA)


def test_targets_and_copies(spark):
    rng = random.Random(4)
    data = [(i, "w " * rng.randint(0, 60), rng.choice(["b", "a", "é", "hot", "hot", "hot", None])) for i in range(600)]
    data += [(1000 + i, "w " * 900, "big") for i in range(3)]
    rows = mix(frame(spark, data)).collect()
    assert len(rows) == len(data)
    sizes = defaultdict(int)
    for _, t, s in data:
        sizes[s] += len(t.split())
    want, taken, largest = targets(sizes), Counter(), Counter()
    for r in rows:
        assert r["source_size"] == sizes[r["source"]] and abs(r["target"] - want[r["source"]]) < 1e-6 * want[r["source"]]
        assert r["copies"] <= 2 and r["taken"] == r["copies"] * r["size"]
        taken[r["source"]] += r["taken"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    for s in want:
        assert abs(taken[s] - want[s]) <= 2 * largest[s]
    again = mix(frame(spark, data[::-1]).repartition(7)).collect()
    key = lambda r: (r["doc_id"], r["taken"])
    assert sorted(map(key, rows)) == sorted(map(key, again))


def test_prefix_sum_crosses_integers(spark):
    rows = mix(frame(spark, [(i, "w w", "s") for i in range(10)] + [(99, "v " * 20, "t")]), budget=0.5, weight_of=cyclic_weights([1, 3]))
    got = {(r["source"]): [0, 0.0] for r in rows.collect()}
    for r in rows.collect():
        got[r["source"]][0] += r["copies"]
        got[r["source"]][1] = r["target"] / r["source_size"]
    for s, n in (("s", 10), ("t", 1)):
        assert abs(got[s][0] - n * got[s][1]) < 1


def test_nulls_empty_and_repeated_rows(spark):
    data = [(1, None, "a"), (2, "", "a"), (3, "x y", None), (3, "x y", None), (None, "z", "a"), (4, "q r", "a"), (4, "s t", "a")]
    df = frame(spark, data)
    mixed = mix(df)
    got = Counter((r["doc_id"], r["size"]) for r in mixed.collect())
    assert got == Counter({(1, 0): 1, (2, 0): 1, (3, 2): 2, (None, 1): 1, (4, 2): 2})
    out = emit_copies(df, mixed).collect()
    assert len(out) == sum(r["copies"] for r in mixed.collect())
    assert all(r["size"] == -1 and r["copy"] >= 1 for r in out)


def test_empty_tables(spark):
    df = frame(spark, [])
    assert mix(df).collect() == [] and emit_copies(df, mix(df)).collect() == []
    assert [r["taken"] for r in mix(frame(spark, [(1, None, None)])).collect()] == [0]
