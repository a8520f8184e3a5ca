import random

import pytest


@pytest.fixture(scope="session")
def texts():
    """Small documents with copies, near copies, shared passages, odd and empty texts, a repeated row and a null id."""
    rng = random.Random(5)
    words = ["".join(rng.choice("aeioubcdfg") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    passage = " ".join(rng.choice(words) for _ in range(30))
    rows = []
    for i in range(60):
        own = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 25))) for _ in range(rng.randint(1, 8))]
        if i % 4 == 0:
            own.insert(rng.randint(0, len(own)), passage)
        rows.append((i, "\n".join(own)))
    for i in range(60, 80):
        base = rows[i - 60][1].split(" ")
        for _ in range(i % 3):
            base[rng.randrange(len(base))] = rng.choice(words)
        rows.append((i, " ".join(base)))
    rows += [(i, rows[3][1]) for i in range(80, 90)]
    rows += [(90, None), (91, ""), (92, "  \n\t"), (93, "one"), (94, "One"), (95, "ab cd"), (96, "é" * 120), (97, "x" + "é" * 120), (98, "a" * 300), (99, "a" * 200 + "b")]
    rows += [rows[5], (None, rows[7][1])]
    return rows


@pytest.fixture(scope="session")
def docs(spark, texts):
    """With an extra column, and columns whose names an operator might use itself."""
    return spark.createDataFrame([(i, t, "en", "s", 1, "x") for i, t in texts], "doc_id long, text string, lang string, source string, n_chars long, words string").repartition(3)


@pytest.fixture(scope="session")
def none(docs):
    return docs.limit(0)
