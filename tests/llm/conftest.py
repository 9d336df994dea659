import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, uid long, row string, length int, w string, lines string, digest string, gram long, path string"


def words(rng, n):
    return " ".join(rng.choice(["the", "of", "and"]) if rng.random() < 0.4 else "".join(rng.choice("aeiostrn") for _ in range(rng.randrange(2, 9))) for _ in range(n))


@pytest.fixture(scope="session")
def texts():
    """Texts with copies, near copies, shared passages, junk, other scripts and edge cases."""
    rng = random.Random(5)
    base = [words(rng, rng.randrange(60, 300)) + "." for _ in range(30)]
    passage = words(rng, 120)
    near = base[0].split()
    near[len(near) // 2] = "changed"
    out = [*base, base[0], base[0], base[1], " ".join(near), *[words(rng, 40) + "\n" + passage + "\n" + words(rng, 40) for _ in range(6)]]
    out += [None, "", " ", "a", "a", "one two three", "é" * 700, "The " * 500, "\n".join(["same line of words."] * 60), "日本語 の テキスト", "x\x00y \x1c z\t\t\r\n end", "1234 5678 !!", words(rng, 30_000), "word%%% odd$$$ " * 80, "MENU | HOME | BACK | NEXT\n" * 30]
    return out


@pytest.fixture(scope="session")
def docs(spark, texts):
    """With a null id, a repeated row, and columns whose names the operators use themselves."""
    langs = ["en", "fr", None]
    rows = [(i, t, langs[i % 3], "src", 0, 1, "r", 2, "w", "l", "d", 3, "p") for i, t in enumerate(texts)]
    rows += [(None, "text without an id", "en", None, None, None, None, None, None, None, None, None, None), rows[3]]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)


@pytest.fixture(scope="session")
def held(docs):
    """The rows as (doc_id, text) on the driver."""
    return [(r.doc_id, r.text) for r in docs.collect()]
