import random

import pytest

import corpus_pipeline
from snapflow.llm import decontaminate, line_dedup, simhash, toxicity
from snapflow.llm.common import table


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    rng = random.Random(11)
    filler = ["".join(rng.choice("abcdefgilmnoprst") for _ in range(7)) for _ in range(800)]
    line = lambda n=15: " ".join(rng.choice(filler) for _ in range(n))
    item = line(20)
    docs, labels = [], []
    for i in range(240):
        text, toxic = [line() for _ in range(6)], i % 6 == 0
        if toxic:
            text = [f"{x} {rng.choice(['scum', 'trash'])}" for x in text]
        if i % 20 == 7:
            text[2] = f"{line(4)} {item} {line(4)}"
        if i % 20 == 9:
            text[1] = "this very line is in many documents of the corpus"
        docs.append((i, "\n".join(text), "en", f"s{i % 4}" if i % 11 else None, 0))
        labels.append((i, 1, int(toxic)))
    docs += [(300 + i, docs[1][1], "en", "s1", 0) for i in range(5)]  # exact copies
    docs += [(400, None, None, None, None), (401, "", "en", "s0", 0), (401, "", "en", "s0", 0)]
    path = tmp_path_factory.mktemp("sf")
    write = lambda rows, schema, name: spark.createDataFrame(rows, schema).write.parquet(f"{path}/{name}.parquet")
    write(docs, "doc_id long, text string, lang string, source string, n_chars long", "documents")
    write(labels, "doc_id long, quality int, toxic int", "labels")
    write([(1, item), (2, line(20))], "item_id long, text string", "benchmark")
    return str(path)


def test_stages_in_order(spark, sf_dir):
    docs, counts = table(spark, sf_dir, "documents"), {}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, corpus_pipeline.written(stage(spark, docs, sf_dir), "t")
        counts[name] = (before.count(), docs.count())
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
        rows = {r["doc_id"]: r["text"] for r in docs.collect()}
        if name == "toxicity":
            judged = toxicity.classify(before, table(spark, sf_dir, "labels")).where("predicted = 1")
            assert not {r["doc_id"] for r in judged.collect()} & rows.keys()
            assert not any(w in (t or "") for t in rows.values() for w in ("scum", "trash"))
            assert {i for i in range(240) if i % 6} <= rows.keys()
        if name == "line_dedup":
            assert sum("this very line" in (t or "") for t in rows.values()) == 1
            assert not {300, 301, 302, 303, 304} & rows.keys() and 1 in rows and 401 in rows
            assert all(r["n_chars"] == len(r["text"]) for r in docs.where("text is not null").collect())
        if name == "simhash_near_dedup":
            groups = simhash.near_duplicates(before).select("component_id").distinct().count()
            assert counts[name][1] == groups and (400 in rows) != (401 in rows)
        if name == "benchmark_decontamination":
            found = decontaminate.contamination(before, table(spark, sf_dir, "benchmark")).where("contaminated").collect()
            assert found and not {r["doc_id"] for r in found} & rows.keys()
            assert counts[name][0] - counts[name][1] == len(found)
    assert counts["source_mixing"][1] > counts["source_mixing"][0]
    assert corpus_pipeline.run(spark, sf_dir).count() == counts["source_mixing"][1]


def test_five_stages_and_query_names():
    import __spark_entry__ as entry

    assert len(corpus_pipeline.STAGES) == 5 and "pipeline" in entry.queries()
    for n in range(1, 11):
        assert sum(q.startswith(f"op{n}_") for q in entry.queries()) == 1
    assert line_dedup.dedup_lines
