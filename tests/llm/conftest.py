import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n, words):
    out = []
    for k in range(n):
        w = rng.choice(words)
        out.append((w.capitalize() if k % 9 == 0 else w) + ("." if k % 9 == 8 else ""))
    return " ".join(out)


@pytest.fixture(scope="session")
def vocabulary():
    rng = random.Random(5)
    syllables = "an be co di er fo gu ha in ke lo mi".split()
    return ["".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(900)]


@pytest.fixture(scope="session")
def corpus(vocabulary):
    """(id, text): prose, exact and near copies, null, empty, blank, accents, a very long text."""
    rng = random.Random(7)
    rows = [(k, prose(rng, rng.randint(20, 160), vocabulary)) for k in range(60)]
    rows += [(100 + k, rows[k][1]) for k in range(8)]                              # exact copies
    for k in range(8):                                                              # near copies: one word in many
        w = rows[10 + k][1].split(" ")
        w[len(w) // 2] = "changed"
        rows.append((200 + k, " ".join(w)))
    rows += [(300, None), (301, ""), (302, " \n\t "), (303, "uno"), (304, "uno"), (305, "dos palabras"),
             (306, "Ünïcode ñandú 日本語 \U0001F600 ende. " * 30), (307, prose(rng, 30_000, vocabulary)), (308, "x" * 5000)]
    return rows


@pytest.fixture(scope="session")
def docs(spark, corpus):
    return spark.createDataFrame([(i, t, None if i % 7 == 0 else "aa", "s", None) for i, t in corpus], SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def messy(spark, corpus):
    """Repeated rows, null ids, and further columns whose names the operators use themselves."""
    rows = corpus[:20] + corpus[:3] + [(None, "no id at all here"), (None, None), (300, None)]
    names = "size shard slot score lang_pred rejected bucket range key n prefix sig start spans _language _text".split()
    return spark.createDataFrame([(i, t, "aa", "s", 1, *["clash"] * len(names)) for i, t in rows],
                                 SCHEMA + ", " + ", ".join(f"{n} string" for n in names))


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
