import pytest

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(autouse=True, scope="session")
def checkpoints(spark, tmp_path_factory):
    spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))


@pytest.fixture(scope="session")
def frame(spark):
    """Rows (id, text) with columns whose names clash with those inside the operators."""
    def make(rows):
        return spark.createDataFrame([(i, t, f"s{k % 2}", 1, 2, "x") for k, (i, t) in enumerate(rows)],
                                     "doc_id long, text string, source string, k int, kept int, _text string")
    return make


@pytest.fixture(scope="session")
def words():
    """Seeded texts: words with repeats, edited copies, shared passages, edges."""
    import random

    rnd = random.Random(4)
    vocabulary = ["".join(rnd.choice("abcdeéü") for _ in range(rnd.randint(1, 6))) for _ in range(60)]

    def text(n):
        return " ".join(rnd.choice(vocabulary) for _ in range(n))

    base = [text(rnd.randint(30, 90)) for _ in range(12)]
    passage = text(45)
    rows = []
    for b in base:
        rows.append(b)
        for _ in range(rnd.randint(0, 4)):
            w = b.split()
            for _ in range(rnd.randint(0, 2)):
                w[rnd.randrange(len(w))] = rnd.choice(vocabulary)
            rows.append(rnd.choice([" ", "  ", "\n"]).join(w))
        if rnd.random() < 0.5:
            rows.append(text(20) + "\n" + passage + "\t" + text(15))
    rows += [None, "", "   \n", "one", "One", "a b c d", "A  b\tc d", "a b c d e", "z " * 80, "z " * 80, base[0].upper(), text(3000)]
    return [(i, t) for i, t in enumerate(rows)] + [(0, rows[0]), (None, rows[1]), (None, None)]
