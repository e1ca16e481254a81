"""The pipeline's stages against brute force, and registered queries against their SQL."""

import os

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from tests.llm import helpers as h
from velograph.llm import nb_svm, queries

SF = "/root/testdata/sf0.001"


def test_stages_on_the_small_tables(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("ids", F.lit("clash")).withColumn("score", F.lit(1)).withColumn("kept_id", F.col("doc_id"))
    benchmark = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for name, stage in pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        texts = {i: r.text for i, r in before.items()}
        out = stage(spark, docs, SF)
        if name != "encode":
            assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        after = {r.doc_id: r for r in docs.collect()}
        if name == "quality":
            labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
            model = nb_svm.fit(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
            scored = nb_svm.score(spark.read.parquet(f"{SF}/documents.parquet"), model).collect()
            assert after.keys() == {r.doc_id for r in scored if r.predicted}
            known = [i for i in before if i in labels]
            assert sum((i in after) == (labels[i] == 1) for i in known) >= 0.97 * len(known)
        if name == "lines":
            want = h.line_dedup(texts)
            assert {i: r.text for i, r in after.items()} == {i: t for i, (*_, t) in want.items()}
            assert all(r.n_chars == len(r.text) for i, r in after.items() if want[i][1])
        if name == "near_duplicates":
            assert after.keys() == {i for i, (_, c) in h.near_duplicates(texts, 5, 80).items() if c == i}
        if name == "decontaminate":
            assert after.keys() == {i for i, (n, hit, _) in h.contamination(texts, benchmark).items() if not (hit and 20 * hit >= n)}
        if name == "encode":
            assert after.keys() == before.keys() and all(r.lossless and r.n_ids == len(r.ids) for r in after.values())
        if name != "lines":
            assert all(after[i].text == texts[i] for i in after)


def test_stages_on_awkward_rows(spark):
    rows = [(i, t, "en", None, len(t or "")) for i, t in enumerate(h.awkward_texts(n=15))]
    rows += [(None, "no id", None, "s", None), (None, None, None, None, None), (3, "third again", "en", "s", 5), rows[-1]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    for name, stage in pipeline.STAGES:
        some, none = stage(spark, docs, SF), stage(spark, docs.where("false"), SF)
        assert none.collect() == [] and none.columns == some.columns
        kept = some.collect()
        if name in ("lines", "encode"):
            assert len(kept) == len(rows)
        if name == "near_duplicates":
            assert sum(r.doc_id is None for r in kept) == 2 and {r.text for r in kept if r.doc_id == 3} == {"\n", "third again"}


def test_run_keeps_what_the_stages_keep(spark):
    out = pipeline.run(spark, SF)
    assert out.count() > 100 and out.where("NOT lossless").count() == 0


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    import duckdb
    con = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    found = con.execute(queries.ORACLE_SQL[name])
    names = [c[0] for c in found.description]
    want = sorted(map(tuple, found.fetchall()))
    got = sorted(tuple(r[c] for c in names) for r in queries.QUERIES[name](spark, SF).collect())
    assert got == want


def test_op7_equals_the_tokenizer(spark):
    import zlib

    import numpy as np
    from tokenizers import Tokenizer
    tokenizer, start = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), 0
    got = {r.doc_id: r for r in queries.QUERIES["op7_huffman"](spark, SF).collect()}
    for r in sorted(spark.read.parquet(f"{SF}/documents.parquet").collect(), key=lambda r: r.doc_id):
        ids = [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 2]
        assert (got[r.doc_id].start, got[r.doc_id].n_tokens, got[r.doc_id].ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_llm_is_not_needed_elsewhere():
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    for folder, _, files in os.walk(os.path.join(root, "velograph")):
        if os.path.basename(folder) != "llm":
            for f in files:
                if f.endswith(".py"):
                    with open(os.path.join(folder, f)) as x:
                        assert "velograph.llm" not in x.read()


def test_near_duplicates_keeps_unrelated_texts_of_one_id(spark):
    words = [" ".join(f"{a}{i}" for i in range(30)) for a in "abcd"]
    near = words[1].replace("b29", "other")
    rows = [(7, words[0]), (7, words[1]), (7, words[1]), (9, near), (3, words[2]), (7, words[2]), (8, words[3] + " x"), (8, words[3]), (8, ""), (8, None), (5, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [(r.doc_id, r.text) for r in pipeline.near_duplicates(spark, docs, SF).collect()]
    eights = [t for i, t in got if i == 8 and t]
    assert len(eights) == 1 and eights[0] in (words[3], words[3] + " x")
    assert sorted((x for x in got if x[0] != 8 or not x[1]), key=repr) == sorted([(7, words[0]), (7, words[1]), (3, words[2]), (8, ""), (8, None), (5, "")], key=repr)
