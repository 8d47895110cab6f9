"""The pipeline on a small table with planted rows, held against brute force stage by stage."""

import random
import re

import numpy as np
import pytest

import corpus_pipeline
from tests.conftest import SF01
from tests.llm.test_llm_hashing import brute
from tests.llm.test_llm_models import base_spans


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """400 documents of the given tables, and planted ones: junk, copies, leaks, secrets."""
    path = tmp_path_factory.mktemp("corpus")
    docs = spark.read.parquet(f"{SF01}/documents.parquet").filter("doc_id < 400")
    items = spark.read.parquet(f"{SF01}/benchmark.parquet")
    rng = random.Random(1)
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    noise = " ".join("".join(rng.choices("bcdfghjklmnpqrstvwxz", k=7)) for _ in range(150))
    rows = [(9000, noise), (9001, "12 34 !!"), (9002, None), (9003, text[50]), (9004, text[51] + " tail."),
            (9005, "Before it. " + items.first()["text"] + " After it."), (9006, text[60][:300] + ' token = "zz11yy22xx33ww44" and more')]
    planted = spark.createDataFrame([(i, t, None if i < 9003 else "en", "planted", len(t or "")) for i, t in rows], docs.schema)
    docs.union(planted).write.parquet(f"{path}/documents.parquet")
    items.write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def test_stages(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, kept = docs.columns, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, folder)
        out.write.parquet(f"{tmp_path}/{k}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{k}")
        if k < 4:
            assert docs.columns == columns
            kept[k] = {r["doc_id"]: r["text"] for r in docs.collect()}
        if k == 0:
            gone = {r["doc_id"] for r in before.collect()} - set(kept[0])
            assert gone == {9000, 9001, 9002}
        if k == 1:
            links = brute([(r["doc_id"], r["text"]) for r in before.collect()], 5, 80)
            assert set(kept[1]) == {i for i, _, c, _ in links if i == c} and not {9003, 9004} & set(kept[1])
        if k == 2:
            bench = [r["text"] for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
            plain = [re.sub(r"\W+", " ", b.lower()).strip() for b in bench]
            gone = {i for i, t in kept[1].items() if any(b in re.sub(r"\W+", " ", t.lower()) for b in plain)}
            assert 9005 in gone and set(kept[1]) - set(kept[2]) == gone
        if k == 3:
            assert set(kept[3]) == set(kept[2]) and "zz11yy22xx33ww44" not in kept[3][9006]
            for i, t in kept[3].items():
                assert not base_spans(t)
                if not base_spans(kept[2][i]):
                    assert t == kept[2][i]
            assert all(r["n_chars"] == len(r["text"]) for r in docs.collect())
    from tokenizers import Tokenizer
    from tickframe.llm.packing import tokenizer_path
    t = Tokenizer.from_file(tokenizer_path())
    sizes = {i: len(t.encode(x, add_special_tokens=False).ids) + 1 for i, x in kept[3].items()}
    got = docs.groupBy("doc_id").sum("length").collect()
    assert {r[0]: r[1] for r in got} == sizes
    assert sorted(map(tuple, corpus_pipeline.run(spark, folder).drop("sequence_id").collect())) == sorted(map(tuple, docs.drop("sequence_id").collect()))
    assert np.all([r["length"] > 0 for r in docs.collect()])


def test_pipeline_of_empty_tables(spark, folder, tmp_path):
    for t in ("documents", "benchmark"):
        spark.read.parquet(f"{folder}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_columns_named_like_working_columns_keep_their_values(spark, corpus):
    from tickframe.llm import decontaminate, jaccard, secrets
    names = "row id sig copy i s _id _set _copy _sig _text _base _spans _runs _table _m Text2 c0".split()
    rows = [(i, (t or "") + ' password = "abcd1234efgh5678"' if i < 20 else t, *[f"{i}{n}" for n in names]) for i, t in corpus[:70]]
    wide = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))
    items = spark.createDataFrame([(1, "an item that nothing holds at all here")], "item_id long, text string")
    for out in (secrets.redact(wide), jaccard.one_of_each(wide), decontaminate.without_leaks(wide, items)):
        assert out.columns == wide.columns
        got = out.collect()
        assert len(got) > 50 and all(r[n] == f"{r['doc_id']}{n}" for r in got for n in names)
    assert not any("abcd1234efgh5678" in str(r.asDict()) for r in secrets.redact(wide).collect())
