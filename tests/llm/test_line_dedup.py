import random
import time
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from snapflow.llm import line_dedup
from snapflow.llm.line_dedup import MEASURES, dedup_lines, dedup_report, measures, open_pairs, possible, similar_lines, verified

SCHEMA = "doc_id long, text string, id string, first long"


def shingles(line, size=8):
    units = line.encode("utf-16-be")
    return {units[i * 2 : (i + size) * 2] for i in range(len(units) // 2 - size + 1)}


def brute(docs, size=8, similarity=0.8):
    """Removed line numbers per document, from all pairs of lines."""
    first = {}
    for doc, text in docs:
        for n, line in enumerate((text if text is not None else "").split("\n")):
            if line.strip():
                first[line] = min(first.get(line, (doc, n)), (doc, n))
    root = {x: x for x in first}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(first, 2):
        x, y = shingles(a, size), shingles(b, size)
        if x and y and len(x & y) >= similarity * len(x | y):
            root[find(a)] = find(b)
    kept = {}
    for line in first:
        kept[find(line)] = min(kept.get(find(line), first[line]), first[line])
    return {
        doc: [n for n, line in enumerate((text or "").split("\n")) if line.strip() and kept[find(line)] != (doc, n)]
        for doc, text in docs
    }


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghiklmnoprstuvé") for _ in range(rng.randint(2, 9))) for _ in range(n))


@pytest.fixture(scope="module")
def docs():
    rng = random.Random(3)
    base = [words(rng, 25) for _ in range(30)]

    def near(line):
        parts = line.split()
        parts[rng.randrange(len(parts))] = "x" + words(rng, 1)
        return " ".join(parts)

    out = []
    for i in range(60):
        lines = [rng.choice([rng.choice(base), near(rng.choice(base)), words(rng, 20), "ok", ""]) for _ in range(5)]
        out.append((i, "\n".join(lines)))
    # A family of near copies of one line, most of them not similar to one another's edits.
    out += [(100 + i, near(near(base[0])) + "\n" + words(rng, 12)) for i in range(40)]
    return out


def test_equals_all_pairs(spark, docs):
    rows = spark.createDataFrame([(d, t, "x", 1) for d, t in docs], SCHEMA)
    got = {r["doc_id"]: r["removed"] for r in dedup_report(rows).collect()}
    want = brute(docs)
    assert got.keys() == want.keys()
    assert {d: got[d] for d in want} == want


def test_texts_follow_the_report(spark, docs):
    rows = spark.createDataFrame([(d, t, "x", 1) for d, t in docs], SCHEMA)
    want = brute(docs)
    kept = {r["doc_id"]: r for r in dedup_lines(rows).collect()}
    for doc, text in docs:
        left = "\n".join(line for n, line in enumerate(text.split("\n")) if n not in want[doc])
        if want[doc] and not left.strip():
            assert doc not in kept
        elif doc in kept and kept[doc]["text"] != left:
            assert len(kept[doc]["text"]) <= len(text)
    assert kept[0]["id"] == "x" and kept[0]["first"] == 1


def test_nulls_empty_long_and_repeated(spark):
    long = "lorem ipsum dolor sit amet " * 4000
    data = [
        (1, None), (2, ""), (3, "tiny"), (4, "tiny"), (None, "a line without an id, long enough"),
        (5, "a line without an id, long enough"), (6, long), (7, long + "x"), (8, "own line number eight\n\nblank before"),
        (8, "own line number eight\n\nblank before"),
    ]
    rows = spark.createDataFrame([(d, t, None, None) for d, t in data], SCHEMA)
    got = [(r["doc_id"], r["n_lines"], r["removed"]) for r in dedup_report(rows).collect()]
    assert sorted(got, key=str) == sorted(
        [(1, 0, []), (2, 1, []), (3, 1, []), (4, 1, [0]), (None, 1, []), (5, 1, [0]), (6, 1, []), (7, 1, [0]),
         (8, 3, []), (8, 3, [])], key=str,
    )
    left = {r["doc_id"] for r in dedup_lines(rows).collect()}
    assert left == {1, 2, 3, None, 6, 8}


def test_empty_table(spark):
    rows = spark.createDataFrame([], SCHEMA)
    assert dedup_report(rows).collect() == [] and dedup_lines(rows).collect() == []


def test_lines_of_one_template_equal_all_pairs(spark):
    """One bucket of lines that share a template; only a few of them are near copies of one another."""
    rng = random.Random(4)
    template = words(rng, 60).split()

    def changed(parts, n):
        parts = list(parts)
        for i in rng.sample(range(len(parts)), n):
            parts[i] = words(rng, 1)
        return parts

    single = [changed(template, 5) for _ in range(130)]
    lines = [" ".join(x) for x in single + [changed(x, 3) for x in single[:25]] + [changed(single[0], 1) for _ in range(15)]]
    sets = [shingles(x) for x in lines]
    part = list(range(len(lines)))
    n_links = 0
    for i, j in combinations(range(len(lines)), 2):
        if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
            n_links += 1
            part = [min(part[i], part[j]) if p in (part[i], part[j]) else p for p in part]
    assert 40 <= n_links < 400
    keys = spark.createDataFrame([(i, [7]) for i in range(len(lines))], "id long, keys array<long>")
    rows = spark.createDataFrame(list(enumerate(lines)), "id long, line string")
    got = {r["node"]: r["component"] for r in similar_lines(keys, rows, size=8, similarity=0.8).collect()}
    assert got == {i: p for i, p in enumerate(part) if part.count(p) > 1}


def test_bounds_never_rule_out_a_similar_pair(spark):
    """Of random pairs around the limit, every similar one passes the bounds, and most others do not."""
    rng = random.Random(5)
    base = [words(rng, rng.randint(4, 40)).split() for _ in range(60)]
    lines = []
    for parts in base:
        for n in (0, 1, 2, 4, 7, 10):
            other = list(parts)
            for i in rng.sample(range(len(parts)), min(n, len(parts))):
                other[i] = words(rng, 1)
            lines.append((" ".join(parts), " ".join(other)))
    rows = spark.createDataFrame([(2 * i + j, line) for i, pair in enumerate(lines) for j, line in enumerate(pair)], "id long, line string")
    sized = measures(rows.selectExpr("id", "encode(line, 'UTF-16BE') wide"), 8)
    x = sized.where("id % 2 = 0").select(*[F.col(c).alias(f"x{c}") for c in sized.columns])
    y = sized.where("id % 2 = 1").select(*[F.col(c).alias(f"y{c}") for c in sized.columns])
    passed = {r["xid"] // 2 for r in x.join(y, F.expr("xid + 1 = yid")).where(possible("x", "y", 0.8)).collect()}
    similar = {i for i, (a, b) in enumerate(lines) if len(shingles(a) & shingles(b)) >= 0.8 * len(shingles(a) | shingles(b))}
    assert similar <= passed and len(passed - similar) < 0.2 * (len(lines) - len(similar))


def test_unlike_lines_of_a_large_template(spark):
    """2,000 lines of one template, each unlike the others, in one bucket: the join makes few rows."""
    rng = random.Random(6)
    template = words(rng, 30).split()
    lines = [" ".join(words(rng, 1) if rng.random() < 0.3 else w for w in template) for _ in range(2000)]
    rows = spark.createDataFrame(list(enumerate(lines)), "id long, line string").selectExpr("id", "encode(line, 'UTF-16BE') wide")
    members = measures(rows, 8).selectExpr("7L band", "id", "id part", *MEASURES)
    assert open_pairs(members, 0.8).count() < 4 * len(lines)


def test_one_doc_id_with_several_texts(spark):
    shared = "a line of text that two documents of one number share"
    data = [(1, shared + "\nsomething else entirely, on its own"), (1, shared + "\nand another thing, quite unlike it"), (2, shared)]
    rows = spark.createDataFrame([(d, t, "x", 1) for d, t in data], SCHEMA)
    assert sorted(len(r["removed"]) for r in dedup_report(rows).collect()) == [0, 1, 1]


def test_work_on_a_long_line_grows_with_its_length(spark):
    """A shingle takes its own bytes from the line, which is not copied for each of them."""
    rng = random.Random(7)
    line = "".join(rng.choice("abcdefghiklmnoprstuv") for _ in range(600_000))
    data = [(0, line), (1, "x" + line)]
    rows = spark.createDataFrame(data, "id long, line string").selectExpr("id", "encode(line, 'UTF-16BE') wide")
    began = time.monotonic()
    sizes = {r["id"]: r["n"] for r in measures(rows, 8).collect()}
    pairs = spark.createDataFrame([(0, 1, sizes[0], sizes[1])], "a long, b long, na int, nb int")
    assert [tuple(r) for r in verified(pairs, rows, 8, 0.8).collect()] == [(0, 1)]
    assert sizes == {i: len(shingles(x)) for i, x in data}
    assert time.monotonic() - began < 45


def test_a_round_writes_four_tables(spark, monkeypatch):
    """Pairs compared and links found stay in the tables of their rounds; nothing is merged again in each of them."""
    rng = random.Random(8)
    families = [words(rng, 40) for _ in range(3)]
    lines = [f"{family} {words(rng, 1)}" for family in families for _ in range(30)]
    names = []
    real = line_dedup.written
    monkeypatch.setattr(line_dedup, "written", lambda df, name: (names.append(name), real(df, name))[1])
    keys = spark.createDataFrame([(i, [7]) for i in range(len(lines))], "id long, keys array<long>")
    rows = spark.createDataFrame(list(enumerate(lines)), "id long, line string")
    got = {r["node"]: r["component"] for r in similar_lines(keys, rows, size=8, similarity=0.8).collect()}
    assert got == {i: i // 30 * 30 for i in range(90)}
    rounds = names[names.index("led") : names.index("parts")]
    assert rounds.count("led") > 1
    assert rounds == ["led", "pairs", "links", "left-out"] * rounds.count("led")


@pytest.mark.parametrize("limit", [0, 10**6])
def test_band_entries_and_measures_are_never_broadcast(spark, docs, monkeypatch, limit):
    plans = {}
    real = line_dedup.written

    def note(df, name):
        plans.setdefault(name, df._jdf.queryExecution().executedPlan().toString())
        return real(df, name)

    monkeypatch.setattr(line_dedup, "written", note)
    monkeypatch.setattr(line_dedup, "BROADCAST_ROWS", limit)
    line_dedup.line_verdicts(spark.createDataFrame(docs, "doc_id long, text string"))
    assert "SortMergeJoin" in plans["members"] and "Broadcast" not in plans["members"]
    # Only the counted list of bands may be sent around.
    assert ("Broadcast" in plans["shared-bands"]) == (limit > 0)
