import random
from itertools import combinations

import xxhash

from snapflow.llm.simhash import error_patterns, fingerprint, keep_one, links, near_duplicates

SCHEMA = "doc_id long, text string, fp long, component string"


def plain(text, width=3):
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not w:
        return 0
    grams = [b" ".join(w[i : i + width]) for i in range(max(1, len(w) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(pairs, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def test_fingerprint_is_the_majority_of_bits():
    rng = random.Random(1)
    for n in (0, 1, 2, 3, 4, 50):
        text = " \t".join(rng.choice(["The", "é", "cat", "X\x0by", "dog z"]) for _ in range(n))
        assert fingerprint(text, 3) & (1 << 64) - 1 == plain(text)
    assert fingerprint(None, 3) == fingerprint(" \n", 3) == 0


def test_patterns_lead_to_codewords():
    assert [len(x) for x in error_patterns(2)] == [1] + [16] * 31


def fps_near(rng, n):
    out = set()
    while len(out) < n:
        x = rng.getrandbits(64)
        out.add(x)
        for _ in range(rng.randint(0, 4)):
            for _ in range(rng.randint(1, 4)):
                x ^= 1 << rng.randrange(64)
            out.add(x)
    return [x - (1 << 64) if x >> 63 else x for x in out]


def test_links_equal_all_pairs(spark):
    rng = random.Random(2)
    fps = fps_near(rng, 600)
    # A crowd around one point.
    fps = list(dict.fromkeys(fps + [fps[0] ^ (1 << a) ^ (1 << b) for a, b in combinations(range(0, 40), 2)]))
    near = [(a, b) for a, b in combinations(fps, 2) if ((a ^ b) & (1 << 64) - 1).bit_count() <= 2]
    want = components(near, fps)
    df = spark.createDataFrame([(x,) for x in fps], "fp long")
    for crowd in (64, 1, 10**6):
        got = [(r["a"], r["b"]) for r in links(df, 2, crowd).collect()]
        if crowd == 10**6:
            assert {(min(p), max(p)) for p in got} == {(min(p), max(p)) for p in near}
        assert components(got, fps) == want


def test_replicas_are_never_broadcast(spark, tmp_path):
    # Spark takes the replicas for as many as the fingerprints, and these few are below its limit.
    spark.createDataFrame([(x,) for x in fps_near(random.Random(4), 500)], "fp long").write.parquet(f"{tmp_path}/fps")
    plan = links(spark.read.parquet(f"{tmp_path}/fps"), 2, 64)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 3 and "Broadcast" not in plan


def test_rows(spark):
    base = " ".join(f"word{i}" for i in range(400))
    data = [(9, base), (4, base + " end"), (4, base + " end"), (None, base), (7, ""), (8, None), (2, "other text here now"),
            (None, "nobody's own text stands here"), (3, "x " * 60_000)]
    df = spark.createDataFrame([(d, t, 1, "c") for d, t in data], SCHEMA)
    got = near_duplicates(df).collect()
    assert sorted((str(r["doc_id"]), r["fingerprint"]) for r in got) == sorted((str(d), f"{plain(t):016x}") for d, t in data)
    by = {(r["doc_id"], r["fingerprint"]): r["component_id"] for r in got}
    assert by[(8, "0" * 16)] == by[(7, "0" * 16)] == 7
    assert by[(None, f"{plain(data[7][1]):016x}")] is None
    together = (plain(base) ^ plain(base + " end")).bit_count() <= 2
    assert by[(9, f"{plain(base):016x}")] == (4 if together else 9)
    kept = keep_one(df).collect()
    assert len(kept) == len({r["component_id"] for r in got}) and all(r["component"] == "c" for r in kept)
    assert sum(r["doc_id"] == 4 for r in kept) == 1


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert near_duplicates(df).collect() == [] and keep_one(df).collect() == []
