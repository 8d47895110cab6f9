"""The filter audit against plain definitions and its SQL."""

import itertools
import random
import re
from collections import Counter

import pytest

from tests.conftest import SF001, SF01
from tests.harness import compare, duck
from tickframe.llm import audit, queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LABELS = "doc_id long, quality int, toxic int"


def plain(rows, labels):
    least = {}
    for i, t, *_ in rows:
        if i is not None:
            least[t or ""] = min(least.get(t or "", i), i)
    docs = []
    for i, t, lang in rows:
        t = t or ""
        words = re.findall("[^\x20\x09-\x0D]+", t)
        fails = {"A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
                 "D": bool(re.search("[#$%&*|]", t)), "E": i is not None and least[t] < i}
        docs.append((lang or "", fails, any(q == 1 for j, q, _ in labels if j == i and i is not None), any(x == 1 for j, _, x in labels if j == i and i is not None)))
    out, shapley = {}, Counter()
    for order in map("".join, itertools.permutations("ABCDE")):
        for part in {d[0] for d in docs}:
            left = [d for d in docs if d[0] == part]
            everything = left
            for step, f in enumerate(order, 1):
                gone = [d for d in left if d[1][f]]
                seen = sum(d[1][f] for d in everything)
                left = [d for d in left if not d[1][f]]
                only = sum(d[1][f] and sum(d[1].values()) == 1 for d in everything)
                out[part, order, step] = [len(left), len(gone), seen - len(gone), only, sum(d[2] for d in gone), sum(d[3] for d in gone)]
                shapley[part, f] += len(gone)
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def read(df):
    return {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"))
            for r in df.collect()}


@pytest.fixture(scope="module")
def rows(corpus):
    rng = random.Random(3)
    texts = [t for _, t in corpus] + ["A B C", "x # y", "word " * 120, " ".join(f"w{k}" for k in range(150)), "ÄÖ Ü"]
    out = [(rng.choice([None, *range(400)]), rng.choice(texts), rng.choice(["aa", "bb", None, ""])) for _ in range(500)]
    return out + [(None, texts[-1], "aa")] * 3 + [(7, "twice the same", "aa")] * 4 + [(7, "twice the same", "bb"), (3, "twice the same", "cc"), (9, "twice the same", "aa")]


@pytest.fixture(scope="module")
def labels():
    rng = random.Random(4)
    return [(rng.choice([None, *range(400)]), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(300)]


@pytest.mark.parametrize("batches, group_texts", [(1, 10_000), (6, 7)])
def test_audit_is_the_plain_one(spark, rows, labels, tmp_path, batches, group_texts):
    rows = sorted(rows, key=lambda r: -(r[0] or 0))
    for k in range(6):
        spark.createDataFrame([(i, t, g, "s", 1) for i, t, g in rows[k * 85:(k + 1) * 85 if k < 5 else None]], SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/d")
    got = read(audit.audit(spark, f"{tmp_path}/d", spark.createDataFrame(labels, LABELS), batches=batches, group_texts=group_texts))
    assert got == plain(rows, labels)


def test_a_smaller_id_retracts_and_a_later_run_goes_on(spark, tmp_path):
    labels = spark.createDataFrame([(5, 1, 0), (2, 0, 1)], LABELS)
    at, folder = f"{tmp_path}/d", f"{tmp_path}/state"
    rows = []
    for i in (9, 5, 7, 2):
        rows.append((i, "one and the same", "aa"))
        spark.createDataFrame([(i, "one and the same", "aa", "s", 1)], SCHEMA).coalesce(1).write.mode("append").parquet(at)
        log = audit.counter_log(spark, at, labels, folder)
        assert read(audit.interactions(log)) == plain(rows, [(5, 1, 0), (2, 0, 1)])
    assert log.filter("n < 0").count() == 2               # 9 and 5 were the least for a while


def test_labels_are_not_broadcast(spark):
    rows = spark.createDataFrame([(i, "aa", bytes([k]) * 16, 1) for i in (1, 2, 3, None) for k in range(40)], "doc_id long, part string, hash binary, mask int")
    out = audit.labelled(rows, spark.createDataFrame([(1, 1, 1), (2, 0, 1), (2, 1, None), (3, 0, 0), (None, 1, 1), (4, 1, 1)], LABELS))
    both = 1 + audit.GOOD + audit.TOXIC
    assert Counter((r["doc_id"], r["mark"]) for r in out.collect()) == {(1, both): 40, (2, both): 40, (3, 1): 40, (None, 1): 40}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_state_round_trip():
    texts = {b"a" * 16: [5, {("x", 3): 2, ("", 64): 1}], b"\0" * 16: [-1, {("é", 0): 1}]}
    assert audit.unpacked(audit.packed(texts)) == texts
    assert audit.unpacked(audit.packed({})) == {}


def test_edges(spark, nothing, messy, tmp_path):
    labels = spark.createDataFrame([], LABELS)
    nothing.write.parquet(f"{tmp_path}/none")
    assert audit.audit(spark, f"{tmp_path}/none", labels).count() == 0
    messy.write.parquet(f"{tmp_path}/messy")
    assert read(audit.audit(spark, f"{tmp_path}/messy", labels)) == plain([(r["doc_id"], r["text"], r["lang"]) for r in messy.collect()], [])


def test_query_and_its_sql(spark):
    ok, message = compare(queries.queries()["op12_filter_audit"](spark, SF01), duck(SF01), queries.oracle_sql()["op12_filter_audit"])
    assert ok, message
    docs = [(r["doc_id"], r["text"], r["lang"]) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    labels = [tuple(r) for r in spark.read.parquet(f"{SF001}/labels.parquet").collect()]
    assert read(queries.queries()["op12_filter_audit"](spark, SF001)) == plain(docs, labels)
