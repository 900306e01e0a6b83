import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
DOCS = "doc_id long, text string, lang string, source string, n_chars long, node long, start int"


@pytest.fixture(scope="session")
def llm(spark):
    """The session, with Python workers that find the package wherever the tests were started."""
    spark.sparkContext.environment["PYTHONPATH"] = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    return spark


@pytest.fixture(scope="session")
def corpus():
    """Rows with copies, near copies, shared passages, nulls, repeated rows, odd and long texts, and clashing extra columns."""
    rng = random.Random(7)
    vocabulary = ["".join(rng.choice("abcdeéöñ") for _ in range(rng.randint(2, 7))) for _ in range(400)]

    def prose(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    texts = [prose(rng.choice([1, 2, 5, 14, 60, 200])) for _ in range(60)]
    base, passage = prose(150), prose(40)
    for k in range(30):  # a group of near copies at very different distances
        words = base.split()
        for _ in range(k // 2):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        texts.append(" ".join(words))
    texts += [prose(30) + " " + passage + " " + prose(k) for k in range(12)] + [base] * 10
    texts += ["", None, "   \t\n", ".,;!", "word", "Word", "a b", "x" * 3000, prose(4000), "one two", "ONE  two\n", "<|endoftext|> It's 42 ́e²"]
    rows = [(k, t, rng.choice(["en", "de", None]), rng.choice(["src1", "src2", None]), None if t is None else len(t), 1, 2) for k, t in enumerate(texts)]
    rng.shuffle(rows)
    rows += [rows[3], rows[4], (None, base, None, None, 1, 1, 1), (None, None, None, None, None, None, None)]
    return rows


@pytest.fixture(scope="session")
def docs(llm, corpus):
    return llm.createDataFrame(corpus, DOCS).repartition(4).cache()


@pytest.fixture(scope="session")
def empty(llm):
    return llm.createDataFrame([], DOCS)
