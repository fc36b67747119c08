"""Quality classifier (operator 9): regularised quadratic discriminant analysis.

Each document becomes a short vector of transformed statistics of its whole
text. Labelled vectors give, per class, a mean and a covariance that is shrunk
towards the pooled covariance and its diagonal. Both covariances are factored
once (Cholesky, cached in the model); a score is the logistic of the difference
of the two Mahalanobis log-densities plus the log prior ratio.

Fitting uses every labelled row of the training part: Spark sums counts, values
and products per class, so the driver sees two vectors and matrices of fixed
size whatever the corpus.

Defined cases: a null or empty text is the all-zero statistics vector and gets
a score as any other; labels that are null or not 0/1, or without a document,
are not learned from; a document with several labels counts once for each; if a
class has no labelled row, every score is the share of label 1 (0.5 without any
labels); an empty table gives no rows; only the named columns are read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from responsekit.llm.common import map_rows, pack_row, read, row_key
from responsekit.llm.textstats import STATS, text_stats
from responsekit.session import materialize

FEATURES = 13
#: Shares of the pooled covariance, and of its diagonal, in each class covariance.
SHRINK_POOLED, SHRINK_DIAGONAL = 0.2, 0.1


def features(stats: np.ndarray) -> np.ndarray:
    """Transformed statistics (rows of ``STATS`` to rows of ``FEATURES``): logs of
    sizes and square roots of shares, which bring skewed ratios nearer to normal."""
    s = {c: stats[:, k].astype(float) for k, c in enumerate(STATS)}
    words, lines, letters = (np.maximum(s[c], 1) for c in ("n_words", "n_lines", "n_letters"))
    chars = np.maximum(s["word_chars"], 1)
    mean = s["word_chars"] / words
    share = [s["n_symbols"] / words, s["n_dup_lines"] / lines, s["n_repeat_words"] / words, s["n_upper_words"] / words,
             s["n_bang"] / words, s["n_digits"] / chars, s["n_upper"] / letters,
             s["n_marks"] / words]
    return np.column_stack([np.log1p(s["n_words"]), np.log1p(mean), np.log1p(s["longest_word"]),
                            np.log1p(words / lines), s["n_unique"] / words, *map(np.sqrt, share)])


def document_features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, text key and ``x``, the feature vector; texts never leave their task."""
    src = docs.select(F.col(id_col).alias("id"), row_key(docs, id_col, text_col)[1], F.col(text_col).alias("text"))
    schema = T.StructType([T.StructField("id", src.schema["id"].dataType), T.StructField("k2", T.LongType()),
                           T.StructField("x", T.ArrayType(T.DoubleType()))])

    def to_features(cols):
        stats = np.array([text_stats(t.as_py()) for t in cols["text"]], dtype=np.int64).reshape(-1, len(STATS))
        return {"id": cols["id"], "k2": cols["k2"], "x": list(features(stats))}

    return map_rows(src, to_features, schema)


def class_sums(labelled: DataFrame) -> dict[int, tuple[int, np.ndarray, np.ndarray]]:
    """Rows, sum of x and sum of x x' by ``label``, as one aggregate."""
    d = range(FEATURES)
    sums = [F.sum(F.col("x")[i]).alias(f"s{i}") for i in d]
    products = [F.sum(F.col("x")[i] * F.col("x")[j]).alias(f"p{i}_{j}") for i in d for j in d if i <= j]
    out = {}
    for r in labelled.groupBy("label").agg(F.count("*").alias("n"), *sums, *products).collect():
        prod = np.array([[r[f"p{min(i, j)}_{max(i, j)}"] for j in d] for i in d])
        out[r["label"]] = (r["n"], np.array([r[f"s{i}"] for i in d]), prod)
    return out


class ShrunkQda:
    """Two class densities; ``factors`` holds mean, inverse Cholesky factor and log-determinant by class."""

    def __init__(self, sums: dict[int, tuple[int, np.ndarray, np.ndarray]]):
        n = {c: sums[c][0] if c in sums else 0 for c in (0, 1)}
        self.prior = n[1] / (n[0] + n[1]) if n[0] + n[1] else 0.5
        self.factors: dict[int, tuple[np.ndarray, np.ndarray, float]] = {}
        if not (n[0] and n[1]):
            return
        mean = {c: sums[c][1] / n[c] for c in (0, 1)}
        cov = {c: sums[c][2] / n[c] - np.outer(mean[c], mean[c]) for c in (0, 1)}
        pooled = (n[0] * cov[0] + n[1] * cov[1]) / (n[0] + n[1])
        diagonal = np.diag(np.maximum(np.diag(pooled), 1e-6))
        for c in (0, 1):
            shrunk = ((1 - SHRINK_POOLED - SHRINK_DIAGONAL) * cov[c] + SHRINK_POOLED * pooled
                      + SHRINK_DIAGONAL * diagonal)
            low = np.linalg.cholesky(shrunk)
            self.factors[c] = (mean[c], np.linalg.inv(low), 2 * float(np.log(np.diag(low)).sum()))

    def scores(self, x: np.ndarray) -> np.ndarray:
        if not self.factors:
            return np.full(len(x), self.prior)
        log = {}
        for c, (mean, inverse, log_det) in self.factors.items():
            z = (x - mean) @ inverse.T
            log[c] = -0.5 * ((z * z).sum(axis=1) + log_det)
        odds = np.clip(log[1] - log[0] + np.log(self.prior / (1 - self.prior)), -700, 700)
        return 1 / (1 + np.exp(-odds))


def held_out(id_col: str = "doc_id") -> Column:
    """True where crc32 of the id as text leaves 1 when divided by 3 (false for a null id)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def score_features(feats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> DataFrame:
    """Fit on the labels that are not held out; ``id``, ``held_out``, ``score`` for every row of ``feats``."""
    known = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
             .where(F.col("label").isin(0, 1) & ~held_out("id")))
    model = ShrunkQda(class_sums(feats.join(known, "id")))
    schema = T.StructType([feats.schema["id"], T.StructField("k2", T.LongType()), T.StructField("score", T.DoubleType())])

    def score(cols):
        x = cols["x"].flatten().to_numpy(zero_copy_only=False).reshape(-1, FEATURES)
        return {"id": cols["id"], "k2": cols["k2"], "score": model.scores(x)}

    return map_rows(feats, score, schema).select("id", "k2", held_out("id").alias("held_out"), "score")


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return score_features(materialize(document_features(docs, id_col, text_col)), labels)


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score 0.5 or more, with all their columns."""
    rejected = (score_documents(docs, labels, id_col, text_col).where(F.col("score") < 0.5)
                .select(F.xxhash64("id").alias("k1"), "k2").distinct())
    keyed = docs.select(pack_row(docs), *row_key(docs, id_col, text_col))
    return keyed.join(rejected, ["k1", "k2"], "left_anti").select("row.*")


def op9_quality_qda(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return scored.select(F.col("id").alias("doc_id"), "held_out", "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
