import random

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


def words(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}{'.' if rng.random() < 0.1 else ''}" for _ in range(n)]


def make_texts(seed=3):
    """Texts with copies, near copies, shared passages, repeated words, and the odd cases."""
    rng = random.Random(seed)
    base = [" ".join(words(rng, rng.randrange(40, 160))) for _ in range(40)]
    passage = " ".join(words(rng, 60))
    texts = list(base)
    texts += base[:4] * 2 + [base[5]] * 6
    for k in range(6, 16):  # near copies: one word changed
        w = base[k].split()
        w[rng.randrange(len(w))] = "changed"
        texts.append(" ".join(w))
    for k in range(20, 27):  # a shared passage inside others, with other blanks around it
        w = base[k].split()
        texts.append(" ".join(w[:20]) + "\n" + passage.replace(" ", "  ", 3) + "\t" + " ".join(w[20:]))
    texts += [None, None, "", "", " \n\t ", "one", "one", "a b c d", "a b c d", "same " * 200, "same " * 36, "same " * 35, "same " * 34,
              "ab cd " * 60, "x y z " * 20, "\n".join(["line one", "line two", "line one", "", "line one"] * 5),
              "é ü ß 漢字 🙂 " * 30, "long" * 5000 + " " + " ".join(words(rng, 3000))]
    return texts


@pytest.fixture(scope="session")
def texts():
    return make_texts()


@pytest.fixture(scope="session")
def docs(spark, texts):
    """The texts as documents: with repeated rows, a null id, a null source."""
    rows = [(k, t, "en", f"src{k % 4}" if k % 9 else None, None if t is None else len(t)) for k, t in enumerate(texts)]
    rows += [rows[0], rows[0], (None, texts[1], None, None, 3), (None, None, None, None, None)]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


def clash(df):
    """The same rows with further columns named as working columns of the operators are."""
    from pyspark.sql import functions as F
    names = ["row", "k1", "k2", "id", "size", "target", "node", "words", "key", "x", "h", "label", "kept"]
    return df.select("*", *[F.lit(7).alias(c) for c in names if c not in df.columns])
