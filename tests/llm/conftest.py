import random

import pytest

WORDS = "the of and thing onre blehe thander stion lywh ersh anti ouha edth Reth, inor. wh".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "x", "yz"]) for _ in range(n))


@pytest.fixture(scope="session")
def corpus():
    """(doc_id, text, lang, source, n_chars) rows with every edge case."""
    rng = random.Random(11)
    rows = []
    for i in range(90):
        text = "\n".join(prose(rng, rng.randrange(4, 40)) for _ in range(rng.randrange(1, 6)))
        rows.append((i, text, "en", f"src{i % 4}"))
    passage = prose(rng, 60)
    for i in range(8):  # a passage that documents share, near copies, exact copies
        rows.append((100 + i, prose(rng, 20) + " " + passage + " " + prose(rng, 15), "en", "src1"))
        words = rows[5][1].split(" ")
        words[rng.randrange(len(words))] = "changed"
        rows.append((120 + i, " ".join(words), "en", "src2"))
        rows.append((140 + i, rows[7][1], "de", "src0"))
    for i in range(12):  # a line that pages of a host share; junk on one host
        rows.append((160 + i, prose(rng, 30) + "\nShare this page\n" + prose(rng, 12), "en", "src3"))
        rows.append((180 + i, " ".join("%$# &&" for _ in range(20)) + prose(rng, 6), "en", "junk"))
    rows += [(200, None, "en", "src0"), (201, "", "en", "src0"), (202, " \n\t ", None, None), (None, prose(rng, 30), "en", "src1"),
             (None, None, None, None), (203, "one", "en", "src2"), (204, "a b a b a b a b a b a b a b a b", "en", "src2"),
             (205, prose(rng, 9000), "en", "src0"), (206, "é ü ñ " * 30, "fr", "src1"), (207, "x" * 3000, "en", "src1"),
             (208, "line\n" * 200, "en", "src2"), (209, "AB " * 400, "en", "src2")]
    rows += rows[:6]  # repeated rows
    return [(a, b, c, d, len(b or "")) for a, b, c, d in rows]


@pytest.fixture(scope="session")
def docs(spark, corpus):
    return spark.createDataFrame(
        corpus, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).cache()


#: Names that the operators use for columns of their own.
CLASHING = ["key", "fp", "host", "n_words", "kept", "words", "all", "lines", "__row", "__key", "condemned", "shard", "chunk", "doc"]


@pytest.fixture(scope="session")
def clashing(docs):
    from pyspark.sql import functions as F
    return docs.withColumns({c: F.lit(f"own {c}") for c in CLASHING})


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
