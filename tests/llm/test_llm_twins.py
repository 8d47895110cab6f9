"""Language identification and fuzzy notices against dictionary and dynamic-programming twins."""

import math
import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tickframe.llm import langid, licenses
from tickframe.llm.blocks import pieces

VOICES = {
    "aa": "the house of water and stone under a long road Ünder",
    "bb": "das haus und wasser stein unter der straße lang über",
    "cc": "la casa del agua y piedra bajo el camino largo niño",
}


# ---------------------------------------------------------------- language identification
def symbols(t):
    """Lower-case letters, one space for each run of other characters."""
    out = ""
    for c in t:
        s = c.lower() if c.isalpha() and len(c.lower()) == 1 else c if c.isalpha() else " "
        if s != " " or out[-1:] != " ":
            out += s
    return out


def grams(t, k):
    s = "   " + symbols(t)
    return [s[j - k + 1:j + 1] for j in range(3, len(s))]


class Twin:
    """Interpolated Kneser-Ney of order 4 over dictionaries, for one language."""

    def __init__(self, texts, alphabet):
        self.alphabet = alphabet
        raw = {k: Counter(g for t in texts for g in grams(t, k)) for k in range(1, 5)}
        self.count = {4: raw[4]}
        for k in (1, 2, 3):
            self.count[k] = Counter(g[1:] for g in raw[k + 1])          # distinct left neighbours
        self.total, self.kinds, self.discount = {}, {}, {}
        for k, c in self.count.items():
            self.total[k], self.kinds[k] = defaultdict(int), Counter(g[:-1] for g in c)
            for g, n in c.items():
                self.total[k][g[:-1]] += n
            n1, n2 = (sum(n == x for n in c.values()) for x in (1, 2))
            self.discount[k] = n1 / (n1 + 2 * n2) if n1 else 0.5

    def p(self, gram):
        k = len(gram)
        if not k:
            return 1 / self.alphabet
        total = self.total[k].get(gram[:-1], 0)
        if not total:
            return self.p(gram[1:])
        d = self.discount[k]
        return max(self.count[k][gram] - d, 0) / total + d * self.kinds[k][gram[:-1]] / total * self.p(gram[1:])

    def entropy(self, t):
        g = grams(t, 4)
        return -sum(math.log(self.p(x)) for x in g) / len(g)


@pytest.fixture(scope="module")
def spoken():
    rng = random.Random(3)
    rows = []
    for j, (lang, words) in enumerate(VOICES.items()):
        for k in range(30):
            t = " ".join(rng.choices(words.split(), k=rng.randint(3, 30)))
            rows.append((100 * j + k, t.capitalize() + rng.choice([".", " 12 !?", "", "  \n"]), lang))
    return rows


def test_languages_equal_the_dictionary_twin(spark, spoken):
    docs = spark.createDataFrame(spoken, "doc_id long, text string, lang string")
    labelled = docs.select(F.col("lang").alias("label"), F.col("doc_id").alias("id"), "text", F.xxhash64("doc_id").alias("pick"))
    fit = [(r["label"], r["text"]) for r in langid.labelled_sample(labelled, langid.SAMPLE_ROWS, langid.SAMPLE_CHARS).filter("fit").collect()]
    assert Counter(label for label, _ in fit) == {x: 24 for x in VOICES}
    alphabet = len({g for _, t in fit for g in grams(t, 1)}) + 1
    twins = [Twin([t for label, t in fit if label == x], alphabet) for x in sorted(VOICES)]
    model = langid.train(docs)
    assert model.languages == sorted(VOICES)

    unseen = ["water 7 stone, water", "Straße!", "  el agua", "zzz qqq", "niño und the", "日本 house", "ß", "x" * 40, *(t for _, t, _ in spoken[::7])]
    ((_, _, off, data),) = pieces(pa.array(unseen))
    ce, many, _ = langid.entropies(model, off, data)
    for t, got, n in zip(unseen, ce, many):
        assert n == len(symbols(t))
        assert got == pytest.approx([w.entropy(t) for w in twins], abs=1e-5)

    rows = spark.createDataFrame(list(enumerate(unseen)), "doc_id long, text string")
    for r in langid.identify(rows, model).collect():
        want = [w.entropy(r["text"]) for w in twins]
        assert r["entropy"] == pytest.approx(min(want), abs=1e-5)
        assert want[model.languages.index(r["lang_pred"])] == pytest.approx(min(want), abs=1e-5)
        n = min(len(symbols(r["text"])), 50)
        assert r["score"] == pytest.approx(1 / sum(math.exp((min(want) - x) * n) for x in want), abs=1e-3)


# ---------------------------------------------------------------- licenses
def least_edits(text, notice):
    """The least edit distance of the notice to any part of the text (free start and end)."""
    row = list(range(len(notice) + 1))
    best = row[-1]
    for c in text:
        last, row[0] = row[0], 0
        for j, n in enumerate(notice, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (c != n))
        best = min(best, row[-1])
    return best


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, d in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (c != d))
    return row[-1]


def plain(t):
    return " ".join(re.findall("[a-z0-9]+", t.lower()))


def edited(rng, t, edits):
    for _ in range(edits):
        at = rng.randrange(len(t))
        kind = rng.randrange(3)
        t = t[:at] + ("" if kind == 0 else rng.choice("abcdefghij")) + t[at + (kind < 2):]
    return t


def test_fuzzy_notices_equal_edit_distances(spark):
    rng = random.Random(12)
    rows = []
    for k in range(50):
        notice, _, most = licenses.NOTICES[k % len(licenses.NOTICES)]
        body = edited(rng, notice, rng.randint(max(0, most - 2), most + 2))
        around = [" ".join(rng.choices("water, stone Road. of license the under".split(), k=6)) for _ in range(2)]
        rows.append((k, f"{around[0]} {body.upper() if k % 3 else body.replace(' ', ' -- ')} {around[1]}"))
    got = {r["doc_id"]: r for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    near = 0
    for k, t in rows:
        flat = plain(t)
        want = {label for notice, label, most in licenses.NOTICES if least_edits(flat, notice) <= most}
        base = set(got[k]["base_labels"].split(",")) - {""}
        assert set(got[k]["labels"].split(",")) - {""} == want | base
        near += bool(want - base)
        for f in got[k]["finds"]:
            span = plain(t[f["start"]:f["end"]])
            # a find may begin or end with a separator, which a span of words doesn't show
            assert min(distance(span, n) for n, label, _ in licenses.NOTICES if label == f["label"]) <= f["edits"] + 2
    assert near >= 15
