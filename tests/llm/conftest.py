import random

import pytest

COLUMNS = ("doc_id long, text string, lang string, source string, uid long, id string, n int, row string, "
           "size int, key string, term int, part int, w double, spans string, first long, y int")


def words(rng, n, vocabulary=400):
    return [f"{rng.choice('ABCdefghij')}{rng.randrange(vocabulary)}" for _ in range(n)]


@pytest.fixture(scope="session")
def texts():
    """Odd and ordinary texts: empty, NULL, short, very long, copies, near copies, shared passages."""
    rng = random.Random(7)
    base = words(rng, 120)
    passage = words(rng, 45)
    out = ["", None, " \n\t ", "One", "one TWO", "a b c", "Ünï ço dé 　wide\x1c x",
           "mail a@b.cd+e@f.gh ip 1.2.3.4.5 card 4111 1111 1111 1111 tel +1 (555) 123-4567 <|endoftext|>",
           "x" * 3000 + "@" + "a." * 500 + "b", "z" * 20_000, " ".join(words(rng, 15_000))]
    out += [" ".join(base)] * 5 + [" ".join(base).upper()]
    for i in range(25):
        near = list(base)
        for _ in range(i % 6):
            near[rng.randrange(len(near))] = f"new{rng.randrange(10 ** 6)}"
        out.append(" ".join(near))
    for i in range(20):
        w = words(rng, rng.randrange(20, 150))
        out.append(" ".join(w[:15] + passage + w[15:] + (w[:30] if i % 3 == 0 else [])) + "\nsame line\nsame line")
    out += [" ".join(words(rng, rng.randrange(1, 80))) for _ in range(40)]
    return out


@pytest.fixture(scope="session")
def docs(spark, texts):
    """The texts with unique ids, and columns whose names operators use themselves."""
    rows = [(i * 3, t, [None, "en", "de"][i % 3], [None, "s1", "s2", "S1"][i % 4], 1, "x", 2, "r", 3, "k", 4, 5, 0.5,
             "s", 6, 1) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, COLUMNS).repartition(5).cache()


@pytest.fixture(scope="session")
def messy(spark, texts):
    """The same with NULL and repeated ids and repeated rows."""
    rows = [([None, 7, 7, i][i % 4], t, "en", "s1", 1, "x", 2, "r", 3, "k", 4, 5, 0.5, "s", 6, 1)
            for i, t in enumerate(texts)]
    return spark.createDataFrame(rows + rows[:12], COLUMNS).repartition(5).cache()


@pytest.fixture(scope="session")
def none(docs):
    return docs.where("false")
