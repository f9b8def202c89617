import random

import pytest

WORDS = "the of and to in is that was for on are with as by at from his they it an were which be this have not had but".split()


def prose(rng, n, lang=0):
    return " ".join(rng.choice(WORDS) + "aeio"[lang] * rng.randint(0, 2) + rng.choice(("", "", "", ".", ",")) for _ in range(n))


@pytest.fixture(scope="session")
def corpus():
    """(doc_id, text): prose with exact and near copies, a shared line and a shared passage, junk, and odd rows."""
    rng = random.Random(11)
    base = [prose(rng, rng.randint(1, 260)) for _ in range(60)]
    passage, line = prose(rng, 70), "Released under a very common license that many documents share."
    texts = [*base, *base[:8]]
    for t in base[:20]:
        words = t.split()
        for _ in range(max(1, len(words) // 60)):
            words[rng.randrange(len(words))] = "changed"
        texts.append("  ".join(words))
    texts += [f"{prose(rng, rng.randint(5, 40))}\n{passage}\n{prose(rng, rng.randint(5, 40))}" for _ in range(25)]
    texts += [f"{line} {prose(rng, rng.randint(0, 30))}" for _ in range(25)]
    texts += [None, "", " \t\n", "one", "two words", "é" * 3, "x" * 5000, " ".join(["same"] * 300), " ".join(["same"] * 120), prose(rng, 6000)]
    rng.shuffle(texts)
    return list(enumerate(texts, 3))


@pytest.fixture(scope="session")
def docs(spark, corpus):
    """With columns whose names clash with those that operators use."""
    rows = [(i, t, "x", i % 3, None) for i, t in corpus]
    return spark.createDataFrame(rows, "doc_id long, text string, n_words string, score long, component_id string").repartition(5)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string")
