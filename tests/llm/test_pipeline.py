from __future__ import annotations

import os

import pytest
from tests.llm.data import odd_rows
from tests.llm.test_exact_dedup import expected
from tests.llm.test_simhash import components, edited, slow_fingerprint
from tests.llm.test_repeats import slow

import corpus_pipeline

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the driver's tables")


def test_stages_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, tables = docs.columns, [docs]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, tables[-1], SF).write.parquet(f"{tmp_path}/{i}")
        tables.append(spark.read.parquet(f"{tmp_path}/{i}"))
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "exact dedup", "SimHash near-dedup", "suffix-array dedup", "best-fit packing"]
    assert all(t.columns == columns for t in tables[:-1])
    rows = [[(r.doc_id, r.text) for r in t.select("doc_id", "text").collect()] for t in tables[:-1]]
    ids = [{i for i, _ in r} for r in rows]
    toxic = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").filter("toxic = 1").collect()}
    clean = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").filter("toxic = 0").collect()}
    assert len(toxic & ids[1]) <= 0.1 * len(toxic) and len(clean & ids[0] - ids[1]) <= 0.02 * len(clean)
    assert ids[2] == {keep for _, keep, _, _ in expected(rows[1])}
    found = components([(i, "") for i, _ in rows[2]], [slow_fingerprint(t or "") for _, t in rows[2]])
    assert ids[3] == set(found) and len(rows[3]) == len(ids[3])
    assert ids[4] == ids[3]
    want = {doc: n - gone for doc, n, gone, _, _ in slow(rows[3], corpus_pipeline.PASSAGE)}
    assert all(want[i] - len(t.encode()) in range(7) for i, t in rows[4])  # a character that is cut in part goes in whole
    packed = tables[-1].collect()
    assert {r.doc_id for r in packed} == ids[4]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_passage_of_51_words_goes_and_clean_texts_stay(spark, tmp_path):
    from tests.llm.data import words

    passage = " ".join(f"ab{i:02d}" for i in range(51))
    clean = [(i, words(i, 150), "en", "s", 0) for i in range(20)]
    planted = [(100 + i, f"{words(200 + i, 60)} {passage} {words(300 + i, 60)}", "en", "s", 0) for i in range(6)]
    spark.createDataFrame(clean + planted, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES[:4]):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
    left = {r.doc_id: r.text for r in docs.collect()}
    assert all(left[r[0]] == r[1] for r in clean)
    assert len(left) == 26 and not any("ab20 ab21" in left[r[0]] for r in planted)
    assert all(left[r[0]].startswith(r[1][:150]) and left[r[0]].endswith(r[1][-150:]) for r in planted)


def test_odd_rows_and_an_empty_table_through_all_stages(spark, tmp_path):
    for name, rows in (("odd", [(i, t, None, None, None) for i, t in odd_rows()]), ("none", [])):
        folder = f"{tmp_path}/{name}"
        spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        packed = corpus_pipeline.run(spark, folder).collect()
        assert bool(packed) == bool(rows)
        assert all(0 <= r.offset and r.offset + r.length <= 2048 for r in packed)
