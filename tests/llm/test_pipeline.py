import corpus_pipeline
import pytest

import __spark_entry__ as entry
from aerolake.llm import pseudonyms
from compare import compare, duck

SF = "/root/testdata/sf0.001"


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {r.doc_id: r for r in docs.collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    for at, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{folder}/{at}")
        before, docs = docs, spark.read.parquet(f"{folder}/{at}")
        if name != "pack":
            assert docs.columns == before.columns
        rows = docs.collect()
        ids = {r.doc_id for r in rows}
        assert ids and ids <= set(kept)
        if name == "quality":
            bad = [i for i, q in labels.items() if q == 0]
            assert sum(i in ids for i in bad) <= 0.2 * len(bad)
            assert all(i in ids for i, q in labels.items() if q == 1)
        if name == "near_duplicates":
            assert len({kept[i].text for i in ids}) == len(ids) == len(rows)
        if name == "pii":
            for r in rows:
                assert pseudonyms.pseudonymise(r.text, pseudonyms.QUERY_KEY, back=True)[0] == kept[r.doc_id].text
                assert r.n_chars == len(r.text)
        if name == "pack":
            assert ids == {r.doc_id for r in before.collect()}
    assert sorted(map(repr, corpus_pipeline.run(spark, SF).drop("ids").collect())) == sorted(map(repr, docs.drop("ids").collect()))


def test_registered():
    names = entry.queries()
    assert all(any(q.startswith(f"op{n}_") for q in names) for n in range(1, 11)) and "pipeline" in names


@pytest.mark.parametrize("name", [n for n in sorted(entry.oracle_sql()) if n.startswith("op")])
def test_query_matches_its_sql(spark, name):
    rows, problem = compare(spark, duck(SF), name, SF)
    assert not problem and rows
