import random

import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long, name long, part int, keys string"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and very long texts, ties, repeated rows, columns that clash with inner names."""
    rnd = random.Random(5)
    words = ["w%d" % i for i in range(400)]
    base = [rnd.choice(words) for _ in range(120)]
    passage = " ".join(rnd.choice(words) for _ in range(60))
    long = " ".join(rnd.choice(words) for _ in range(30000))
    texts = {1: " ".join(base), 2: " ".join(base), 3: " ".join(base[:60] + ["x"] + base[61:]), 4: None, 5: "", 6: "  \n ",
             7: "one two", 8: "One TWO", 9: long, 10: passage + " tail a b c", 11: "head é" + passage, 12: "aaaa" * 400,
             13: "b" + "aaaa" * 300, 14: "x" * 49, 15: "x" * 49, 16: "y" * 50, 17: "y" * 50, 18: "naïve ﬁ 日本 \U0001F600 <|endoftext|> .,;!"}
    for k in range(20, 40):
        texts[k] = " ".join(rnd.choice(words) for _ in range(rnd.choice([3, 30, 200])))
        if k % 4 == 0:
            texts[k] = " ".join(w if rnd.random() > 0.02 else "z" for w in base)
    rows = [(i, t, "en", "s", 0, 7, 8, "k") for i, t in texts.items()]
    rows += [(1, texts[1], "en", "s", 0, 7, 8, "k"), (None, "no id " + passage, None, None, None, None, None, None), (None, texts[1], None, None, None, None, None, None)]
    return spark.createDataFrame(rows, DOC).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC)
