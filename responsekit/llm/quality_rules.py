"""Quality rules by weak supervision (operator 3).

Rules over document counts each vote good (1), bad (-1) or abstain (0). Spark
counts how many documents show each vote pattern; expectation-maximisation over
these patterns (at most ``3 ** len(RULES)`` of them, however large the corpus)
estimates the share of good documents and, for good and bad documents apart,
how often each rule votes each way; a rule that calls many documents bad which
the others call good is found to be a poor one. The posterior probability of a good
document then replaces filtering by all rules passed.

Defined cases: a null or empty text has no words, so it fails the base rule and
is not kept; equal texts get equal results; an empty table gives no rows; of
the input only the id and text columns are read, so extra columns don't matter;
a null id is returned as null.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from responsekit.llm.common import map_rows, read
from responsekit.llm.textstats import STATS, text_stats
from responsekit.session import materialize

MIN_WORDS = 50
#: (rule, ratio as SQL, bad if, good if); neither holds: the rule abstains.
RULES = [
    ("words", "n_words", "{0} < 50", "{0} >= 80"),
    ("word_length", "word_chars / n_words", "{0} < 2.5 or {0} > 12", "{0} between 3 and 10"),
    ("symbols", "n_symbols / n_words", "{0} > 0.1", "false"),
    ("repeated_lines", "n_dup_lines / n_lines", "{0} > 0.4", "false"),
    ("repeated_words", "n_repeat_words / n_words", "{0} > 0.4", "{0} < 0.1"),
    ("upper_case", "n_upper_words / n_words", "{0} > 0.15", "false"),
    ("bangs", "n_bang / n_words", "{0} > 0.1", "false"),
    ("long_words", "longest_word", "{0} > 200", "false"),
    ("letters", "n_letters / word_chars", "{0} < 0.8", "{0} >= 0.9"),
    ("line_ends", "n_ended_lines / n_lines", "{0} < 0.5", "{0} >= 0.9"),
]
EM_ROUNDS = 200
#: Prior knowledge, fixed beforehand: how often a rule votes bad, abstains or votes good in each class (1: good), and
#: the share of good documents. It weighs as much as so many documents, so a corpus outweighs it; nothing else
#: bounds what EM estimates.
PRIOR_DOCS, PRIOR_GOOD = 300, 0.8
PRIOR_BAD_ONLY = {1: {-1: 0.002, 0: 0.996, 1: 0.002}, 0: {-1: 0.3, 0: 0.698, 1: 0.002}}
PRIOR_BOTH = {1: {-1: 0.01, 0: 0.14, 1: 0.85}, 0: {-1: 0.2, 0: 0.2, 1: 0.6}}
PRIOR_RATES = [PRIOR_BAD_ONLY if good == "false" else PRIOR_BOTH for _, _, _, good in RULES]


def document_stats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id and the counts of ``STATS``; texts never leave their task."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = T.StructType([T.StructField("id", src.schema["id"].dataType),
                           *[T.StructField(c, T.LongType()) for c in STATS]])

    def stats(cols):
        rows = [text_stats(x.as_py()) for x in cols["text"]]
        return {"id": cols["id"], **{c: [r[k] for r in rows] for k, c in enumerate(STATS)}}

    return map_rows(src, stats, schema)


def votes() -> list[Column]:
    """One column per rule: -1, 0 or 1; every rule abstains on a document without words."""
    out = []
    for name, ratio, bad, good in RULES:
        r = f"({ratio})"
        out.append(F.expr(f"case when n_words = 0 then 0 when {bad.format(r)} then -1 when {good.format(r)} then 1 "
                          "else 0 end").cast("int").alias(f"v_{name}"))
    return out


def fit_label_model(patterns: list[tuple[tuple[int, ...], int]], rounds: int = EM_ROUNDS) -> dict:
    """EM over (vote pattern, documents): prior of good, vote rates by class, accuracy of each rule.

    Starts from: a document is good unless some rule calls it bad. No pattern
    (an empty corpus) leaves the prior rates."""
    post = [0.1 if -1 in p else 0.95 for p, _ in patterns]
    total = sum(n for _, n in patterns)
    weigh = PRIOR_DOCS
    prior, rates = PRIOR_GOOD, {c: [dict(p[c]) for p in PRIOR_RATES] for c in (0, 1)}
    for _ in range(rounds):
        good = sum(n * q for (_, n), q in zip(patterns, post))
        prior = (good + PRIOR_GOOD * weigh) / (total + weigh)
        for c, weight in ((0, total - good), (1, good)):
            for j in range(len(RULES)):
                for v in (-1, 0, 1):
                    seen = sum(n * (q if c else 1 - q) for (p, n), q in zip(patterns, post) if p[j] == v)
                    rates[c][j][v] = (seen + weigh * PRIOR_RATES[j][c][v]) / (weight + weigh)
        post = [1 / (1 + math.exp(-min(700.0, max(-700.0, log_odds(p, prior, rates))))) for p, _ in patterns]
    right = [(prior * g[1] + (1 - prior) * b[-1], prior * g[-1] + (1 - prior) * b[1]) for g, b in zip(rates[1], rates[0])]
    return {"prior": prior, "rates": rates, "accuracy": [r / (r + w) for r, w in right]}


def vote_odds(rule: int, vote: int, rates: dict) -> float:
    return math.log(rates[1][rule][vote] / rates[0][rule][vote])


def log_odds(pattern: tuple[int, ...], prior: float, rates: dict) -> float:
    return math.log(prior / (1 - prior)) + sum(vote_odds(j, v, rates) for j, v in enumerate(pattern))


def score_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", cut: float = 0.5) -> DataFrame:
    """Counts, votes, posterior and verdict of every document (id column: ``id``)."""
    stats = materialize(document_stats(docs, id_col, text_col).select("*", *votes()))
    names = [f"v_{r[0]}" for r in RULES]
    patterns = [(tuple(r[c] for c in names), r["n"])
                for r in stats.groupBy(*names).agg(F.count("*").alias("n")).orderBy(*names).collect()]
    model = fit_label_model(patterns)
    odds = F.lit(math.log(model["prior"] / (1 - model["prior"])))
    for j, c in enumerate(names):
        bad, none, good = (vote_odds(j, v, model["rates"]) for v in (-1, 0, 1))
        odds = odds + F.when(F.col(c) < 0, bad).when(F.col(c) > 0, good).otherwise(none)
    return (stats.withColumn("posterior", 1 / (1 + F.exp(-odds)))
            .withColumn("base_failed", F.expr(f"n_words < {MIN_WORDS} or 100 * n_repeat_words > 50 * n_words"))
            .withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= cut)))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(read(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "posterior")
