from __future__ import annotations

import random

import pytest

#: Nulls, empty and blank texts, ties, one very long text, marks, special strings.
ODD = [None, "", " ", "\n\n", "a", "A  b", "a b c d e", "A b c\nd e", "x" * 70_000, "é́ ñ İ K Straße", "<|endoftext|> x<|endoftext|> don't  stop", "12 34\t56\r\n", "\x00\x1c y\x85z", "日本語 " * 40]


@pytest.fixture(scope="session")
def texts():
    r = random.Random(5)
    words = [f"w{i}" for i in range(300)] + ["the", "of", "and", "É", "ñu"]
    out = [*ODD, *ODD]
    line = " ".join(r.choice(words) for _ in range(60))
    for _ in range(25):
        base = [r.choice(words) for _ in range(r.choice([8, 40, 200]))]
        for _ in range(r.choice([1, 1, 3, 9])):
            own = list(base)
            for _ in range(r.choice([0, 0, 1, 3])):
                own[r.randrange(len(own))] = r.choice(words)
            t = " ".join(own)
            if r.random() < 0.3:
                t = t.replace(" w1", "\nw1", 2) + "\n" + line
            out.append(t)
    r.shuffle(out)
    return out


@pytest.fixture(scope="session")
def docs(spark, texts):
    """Columns that clash with those the operators make are there, too."""
    rows = [(i, t, ("en", "fr", None)[i % 3], f"src{i % 4}", len(t or ""), 1, "x", [1]) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, n long, row string, spans array<int>").repartition(3)


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)
