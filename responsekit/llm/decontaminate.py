"""Benchmark decontamination (operator 10): MinHash containment search, verified exactly.

A test item is short, a document may be ten thousand times as long, so their
Jaccard similarity says nothing; what counts is the share of the item's word
shingles that the document contains. Items are partitioned by size (powers of
two of their shingles); an item's sketch is its smallest shingle hashes, as many
as its partition needs for the target recall (all of them where it has fewer). An item
of fewer than five words has one shingle of all its words; windows of its length
are looked up in the documents, only for lengths that items have. A document is a candidate if one
of its shingles is in the sketch and it is long enough for items of that
partition. Missing an item that is contained to the share ``threshold`` takes a
sketch that lies wholly in the missing share: at most ``(1 - threshold) **
sketch``, and nothing can be missed where the sketch is larger than that share.
Candidates are then verified on all shingles of the whole text, as strings.

Cost: one pass over the texts that hashes every shingle and looks it up in the
sketches, and one over the candidate documents; only hits are shuffled. The
benchmark's shingles are written and counted; sketches and shingles are broadcast
up to ``MAX_BROADCAST_SHINGLES`` of them, else joined by shuffle.

Only DataFrame functions are used. Defined cases: a null, empty or blank text
has no shingle and no pair; repeated rows (equal
id and text) give one pair; a null id is returned as null; an empty table gives
no pairs; only the id and text columns are read.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from responsekit.llm.common import SHINGLE, WORD, pack_row, read, row_key
from responsekit.session import materialize

THRESHOLD, RECALL = 0.8, 0.999999
#: Shingles of the benchmark up to which it is broadcast: about 30 MB of hashes and words.
MAX_BROADCAST_SHINGLES = 300_000


def sketch_size(threshold: float = THRESHOLD, recall: float = RECALL) -> int:
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold))


def shingled(df: DataFrame, keys: list[str], text: str, n: int = SHINGLE, lengths=()) -> DataFrame:
    """``keys``, ``size`` (words of the shingle), ``windows`` (shingles with repeats), the hash ``h`` and the words of
    every shingle of ``n`` words, and of every window of the other ``lengths``."""
    words = df.select(*keys, F.regexp_extract_all(F.col(text), F.lit(WORD), F.lit(0)).alias("words"))
    out = None
    for size in (n, *lengths):
        rows = words.where(F.size("words") >= size)
        each = rows.select(*keys, "words", F.explode(F.sequence(F.lit(0), F.size("words") - size)).alias("i"))
        part = each.select(*keys, F.lit(size).alias("size"), (F.size("words") - (size - 1)).alias("windows"),
                           F.xxhash64(*[F.col("words")[F.col("i") + k] for k in range(size)]).alias("h"),
                           F.concat_ws(" ", *[F.col("words")[F.col("i") + k] for k in range(size)]).alias("shingle"))
        out = part if out is None else out.unionByName(part)
    return out


def item_shingles(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Distinct shingles of each item with its number of them and the rank of their hash; an item of fewer than
    ``SHINGLE`` words has one shingle of all its words."""
    rows = items.select(F.col(id_col).alias("item_id"), F.col(text_col).alias("text"),
                        *[c.alias(f"i{k}") for k, c in enumerate(row_key(items, id_col, text_col))])
    keys = ["item_id", "i0", "i1"]
    own = F.regexp_extract_all(F.col("text"), F.lit(WORD), F.lit(0))
    short = rows.select(*keys, own.alias("words")).where(F.size("words").between(1, SHINGLE - 1))
    word = F.col("words")
    h = F.lit(None)
    for size in range(1, SHINGLE):
        h = F.when(F.size("words") == size, F.xxhash64(*[word[k] for k in range(size)])).otherwise(h)
    short = short.select(*keys, F.size("words").alias("size"), h.cast("long").alias("h"), F.concat_ws(" ", "words").alias("shingle"))
    each = shingled(rows, keys, "text").select(*keys, "size", "h", "shingle").unionByName(short).distinct()
    item = Window.partitionBy("i0", "i1")
    return (each.withColumn("n_item", F.count("*").over(item))
            .withColumn("rank", F.row_number().over(item.orderBy("h", "shingle"))))


def find_leaks(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id",
               text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
               broadcast_shingles: int = MAX_BROADCAST_SHINGLES) -> DataFrame:
    """Pairs (k1, k2, doc_id, item_id, n_item, n_shared, containment) of at least ``threshold``; k1, k2 name the row."""
    shingles = materialize(item_shingles(items, item_id, item_text))
    sizes = {r["size"]: r["n"] for r in shingles.groupBy("size").agg(F.count("*").alias("n")).collect()}
    hint = F.broadcast if sum(sizes.values()) <= broadcast_shingles else (lambda df: df)
    lengths = sorted(set(sizes) - {SHINGLE})
    # partitions by size; in each, the smallest document that can hold its smallest item to the threshold
    partition = F.floor(F.log2("n_item"))
    sketches = (shingles.where(F.col("rank") <= sketch_size(threshold)).withColumn("part", partition)
                .withColumn("least_windows", F.ceil(F.lit(threshold) * F.pow(F.lit(2), "part")))
                .groupBy("size", "h", "i0", "i1").agg(F.min("least_windows").alias("least_windows")))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), *row_key(docs, id_col, text_col))
    hits = shingled(rows, ["k1", "k2"], "text", lengths=lengths).select("k1", "k2", "size", "h", "windows")
    candidates = materialize(hits.join(hint(sketches), ["size", "h"]).where("windows >= least_windows")
                             .select("k1", "k2", "i0", "i1").distinct())  # used twice below
    return verify(rows, candidates, shingles, hint, threshold, lengths)


def verify(rows: DataFrame, candidates: DataFrame, shingles: DataFrame, hint, threshold: float, lengths=()) -> DataFrame:
    """Exact containment of each candidate pair over all shingles of the document."""
    texts = rows.join(candidates.select("k1", "k2").distinct(), ["k1", "k2"], "left_semi")
    have = shingled(texts, ["doc_id", "k1", "k2"], "text", lengths=lengths).select("doc_id", "k1", "k2", "size", "h", "shingle")
    wanted = shingles.select("size", "h", "shingle", "item_id", "i0", "i1", "n_item")
    shared = have.join(hint(wanted), ["size", "h", "shingle"]).select("doc_id", "k1", "k2", "item_id", "i0", "i1", "n_item", "shingle")
    shared = shared.distinct().groupBy("doc_id", "k1", "k2", "item_id", "i0", "i1", "n_item").agg(F.count("*").alias("n_shared"))
    return (shared.where(F.col("n_shared") >= F.lit(threshold) * F.col("n_item"))
            .join(candidates, ["k1", "k2", "i0", "i1"], "left_semi")
            .withColumn("containment", F.col("n_shared") / F.col("n_item"))
            .select("k1", "k2", "doc_id", "item_id", "n_item", "n_shared", "containment"))


def drop_leaks(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that contain no item, with all their columns."""
    leaks = find_leaks(docs, items, threshold).select("k1", "k2").distinct()
    keyed = docs.select(pack_row(docs), *row_key(docs, "doc_id", "text"))
    return keyed.join(leaks, ["k1", "k2"], "left_anti").select("row.*")


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")).select(
        "doc_id", "item_id", "n_item", "n_shared", "containment")


SQL = r"""
WITH words AS (SELECT 'd' AS kind, doc_id AS id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM documents
               UNION ALL SELECT 'i', item_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') FROM benchmark),
size AS (SELECT DISTINCT least(len(w), 5) AS n FROM words WHERE kind = 'i' AND len(w) > 0),
shingles AS (SELECT DISTINCT kind, id, n, unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS s
             FROM words JOIN size ON len(w) >= n WHERE kind = 'd' OR n = least(len(w), 5)),
items AS (SELECT id AS item_id, n, s, count(*) OVER (PARTITION BY id) AS n_item FROM shingles WHERE kind = 'i')
SELECT d.id AS doc_id, item_id, n_item, count(*) AS n_shared, count(*) / n_item AS containment
FROM items JOIN shingles d ON d.kind = 'd' AND d.n = items.n AND d.s = items.s
GROUP BY d.id, item_id, n_item HAVING count(*) >= 0.8 * n_item
"""
