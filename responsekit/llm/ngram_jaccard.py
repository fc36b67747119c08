"""N-gram Jaccard join (operator 5): MinHash banding, verified on full shingle sets.

Each text becomes the set of its five-word shingles (a text of one to four words:
one shingle of all its words). Texts with equal sets are one class; classes with a
Jaccard similarity of ``THRESHOLD`` or more are linked. Band and row counts come
from the target recall at the threshold. Classes meet where a band's hash agrees:

* buckets with the same members are compared once (their members are summed up by
  hashes, no list of them is made);
* a bucket is cut into blocks of ``BLOCK`` classes, and each pair of blocks is one
  group, so no group grows with the bucket;
* a group gets the full shingle sets, counts common shingles by matrix products,
  and returns a row per class: its links, and the smallest class it is connected to.
  A pair counts in the first band that agrees, so it counts once; pairs of
  documents are never listed.

Links give groups of near duplicates (connected components).

A link is missed only if no band agrees: at most ``1 - RECALL`` of the links at the
threshold, fewer above. Each link that is found was verified exactly.

Defined cases: a text without words (null, empty, blank) is linked to nothing and is
its own class; repeated rows are copies and link to each other; a null id takes part
as any other, but a group's class id is its smallest id that isn't null; an empty
table gives no rows; other columns are carried along whatever their names.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from responsekit.llm import bits as B
from responsekit.llm.common import (
    SHINGLE,
    WORD,
    map_rows,
    mix64,
    ngram_hashes,
    pack_row,
    read,
    row_key,
    signed,
    split_words,
    word_hashes,
)
from responsekit.llm.components import connected_components
from responsekit.session import discard, materialize

THRESHOLD, RECALL, MAX_HASHES = 0.8, 0.999, 100
BLOCK = 512
#: Shingles that one matrix product of a group covers.
COLUMNS = 8192
SEED = 20240229


def choose_bands(threshold: float, recall: float, most: int = MAX_HASHES) -> tuple[int, int]:
    """Bands and rows: the most rows per band (fewest false candidates) whose bands, as many as the
    recall at the threshold needs, take no more than ``most`` hash functions."""
    best = None
    for rows in range(1, most + 1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold ** rows)) if threshold < 1 else 1
        if rows * bands <= most:
            best = bands, rows
    if best is None:
        raise ValueError("too few hash functions for this recall")
    return best


def shingle_set(text: str | None, n: int = SHINGLE) -> np.ndarray:
    """Sorted distinct shingle hashes of a text."""
    h = word_hashes(split_words(text))
    return np.unique(ngram_hashes(h, min(n, len(h)))) if len(h) else h


def set_id(s: np.ndarray) -> bytes:
    """128 bits that name a set."""
    a, b = (int(np.add.reduce(mix64(s + np.uint64(k)))) for k in (1, 2))
    return (a & (2 ** 64 - 1)).to_bytes(8, "big") + ((b + len(s)) & (2 ** 64 - 1)).to_bytes(8, "big")


class MinHash:
    def __init__(self, bands: int, rows: int):
        rng = np.random.default_rng(SEED)
        self.bands, self.rows = bands, rows
        self.times = rng.integers(1, 2 ** 63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.flip = rng.integers(0, 2 ** 63, bands * rows, dtype=np.uint64)

    def band_hashes(self, s: np.ndarray) -> np.ndarray:
        least = np.full(self.bands * self.rows, ~np.uint64(0))
        for at in range(0, len(s), 512):
            least = np.minimum(least, ((s[at: at + 512, None] ^ self.flip) * self.times).min(axis=0))
        out = np.arange(1, self.bands + 1, dtype=np.uint64)
        for column in least.reshape(self.bands, self.rows).T:
            out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + column)
        return out


def signatures(keyed: DataFrame, bands: int, rows: int) -> DataFrame:
    """(id, k1, k2, node, bands) per row; ``node`` names the shingle set, null without words."""
    schema = T.StructType([keyed.schema["id"], T.StructField("k1", T.LongType()), T.StructField("k2", T.LongType()),
                           T.StructField("node", T.BinaryType()), T.StructField("bands", T.ArrayType(T.LongType()))])
    family = MinHash(bands, rows)

    def sign(cols):
        sets = [shingle_set(t.as_py()) for t in cols["text"]]
        return {"id": cols["id"], "k1": cols["k1"], "k2": cols["k2"],
                "node": [set_id(s) if len(s) else None for s in sets],
                "bands": [signed(family.band_hashes(s)) if len(s) else None for s in sets]}

    return map_rows(keyed, sign, schema)


def common_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Common elements of every set of ``left`` with every set of ``right``; memory is bounded by COLUMNS."""
    _, code, found = np.unique(np.concatenate([*left, *right]), return_inverse=True, return_counts=True)
    shared = np.cumsum(found >= 2) - 1
    code = np.where((found >= 2)[code], shared[code], -1)
    row = np.repeat(np.arange(len(left) + len(right)), [len(s) for s in [*left, *right]])
    row, code = row[code >= 0], code[code >= 0]
    order = np.argsort(code, kind="stable")
    row, code = row[order], code[order]
    out = np.zeros((len(left), len(right)), dtype=np.int64)
    for at in range(0, int(shared[-1]) + 1, COLUMNS):
        a, b = np.searchsorted(code, (at, at + COLUMNS))
        dense = np.zeros((len(left) + len(right), COLUMNS if b - a > COLUMNS else max(1, int(code[b - 1]) - at + 1)), dtype=np.float32)
        dense[row[a:b], code[a:b] - at] = 1
        out += (dense[: len(left)] @ dense[len(left):].T).astype(np.int64)
    return out


def smallest_connected(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    label = np.arange(n)
    while True:
        old = label.copy()
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == old).all():
            return label


def compare_group(nodes: list[bytes], sides: list[int], weight: list[int], bands: np.ndarray, sets: list[np.ndarray],
                  band: int, same_block: bool, threshold: float) -> list[tuple[bytes, int, bytes]]:
    """(node, links, smallest connected node) of the linked nodes of one group."""
    left = [k for k in range(len(nodes)) if same_block or sides[k] == 0]
    right = left if same_block else [k for k in range(len(nodes)) if sides[k] == 1]
    if not left or not right:
        return []
    common = common_counts([sets[k] for k in left], [sets[k] for k in right])
    sizes = np.array([len(s) for s in sets])
    union = sizes[left][:, None] + sizes[right][None, :] - common
    linked = common >= threshold * union - 1e-9
    if same_block:
        linked = np.triu(linked, 1)
    x, y = np.nonzero(linked)
    a, b = np.array(left)[x], np.array(right)[y]
    if not len(a):
        return []
    first = ~(bands[a, :band] == bands[b, :band]).any(axis=1)
    w, links = np.array(weight), np.zeros(len(nodes), dtype=np.int64)
    np.add.at(links, a[first], w[b[first]])
    np.add.at(links, b[first], w[a[first]])
    rank = sorted(range(len(nodes)), key=nodes.__getitem__)
    place = np.empty(len(nodes), dtype=np.int64)
    place[rank] = np.arange(len(nodes))
    label = smallest_connected(len(nodes), place[a], place[b])
    return [(nodes[k], int(links[k]), nodes[rank[label[place[k]]]]) for k in np.unique(np.concatenate([a, b]))]


def shared_buckets(classes: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """(h, band, members, node) of the buckets of two classes or more, one for each different set of members, and
    the written tables it reads."""
    each = classes.select("node", F.posexplode("bands").alias("band", "h"))
    # written before they are joined back, so that adaptive execution can split a bucket in the join
    shared = materialize(each.groupBy("h").agg(F.count("*").alias("members")).where("members >= 2"))
    full = materialize(each.join(shared, "h"))
    discard(shared)
    named = full.groupBy("h", "band", "members").agg(F.bit_xor(F.xxhash64("node")).alias("x1"),
                                                     F.bit_xor(F.xxhash64(F.lit(7), "node")).alias("x2"))
    kept = materialize(named.groupBy("members", "x1", "x2").agg(F.min(F.struct("band", "h")).alias("one")).select("one.band", "one.h"))
    return full.join(kept, ["band", "h"]), [full, kept]


def blocks(buckets: DataFrame) -> DataFrame:
    """A row for each pair of blocks that a member takes part in: (h, i, j, band, node, side)."""
    n = F.ceil(F.col("members") / BLOCK).cast("int")
    own = buckets.select("h", "band", "node", n.alias("n"), F.pmod(F.xxhash64("node", "h"), n).cast("int").alias("own"))
    pairs = own.select("h", "band", "node", "own", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("other"))
    return pairs.select("h", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "band", "node",
                        (F.col("own") > F.col("other")).cast("int").alias("side"))


def row_hashes(k1, k2) -> np.ndarray:
    return mix64(k1.to_numpy().view(np.uint64) ^ mix64(k2.to_numpy().view(np.uint64)))


def wanted_sets(keyed: DataFrame, wanted: DataFrame) -> tuple[DataFrame, object]:
    """(k1, k2, shingles): shingle sets of the rows that a Bloom filter of ``wanted`` (k1, k2) lets through, made where
    the texts are read, so that no text is shuffled; and the filter, to be freed."""
    bits = B.BITS
    merged = materialize(B.merge(B.fill(wanted.select("k1", "k2"), lambda b: row_hashes(b.column(0), b.column(1)), bits), bits))
    known = B.collect(merged, "once", bits)
    discard(merged)
    schema = T.StructType([T.StructField("k1", T.LongType()), T.StructField("k2", T.LongType()), T.StructField("shingles", T.BinaryType())])

    def sets(cols):
        at = np.flatnonzero(B.BitFilter(bits, known.value).has(row_hashes(cols["k1"], cols["k2"])))
        return {"k1": cols["k1"].take(at), "k2": cols["k2"].take(at),
                "shingles": [shingle_set(cols["text"][int(k)].as_py()).tobytes() for k in at]}

    return map_rows(keyed.select("k1", "k2", "text"), sets, schema), known


def class_links(keyed: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """(node, links, root) per group and linked class, written."""
    buckets, used = shared_buckets(classes)
    units = materialize(blocks(buckets))
    for table in used:
        discard(table)
    met = classes.join(units.select("node").distinct(), "node").select("node", "m", "bands", "first.k1", "first.k2")
    met = materialize(met)
    rows, known = wanted_sets(keyed, met)
    # repeated rows have one key: one of them gives the set of the class
    sets = rows.join(met, ["k1", "k2"]).groupBy("node").agg(*[F.first(c).alias(c) for c in ("m", "bands", "shingles")])
    out = "node binary, links long, root binary"

    def compare(key, group):
        found = compare_group(list(group["node"]), list(group["side"]), list(group["m"]), np.array(list(group["bands"])),
                              [np.frombuffer(s, dtype=np.uint64) for s in group["shingles"]],
                              int(group["band"].iloc[0]), key[1] == key[2], threshold)
        return type(group)(found, columns=["node", "links", "root"])

    links = materialize(units.join(sets, "node").groupBy("h", "i", "j").applyInPandas(compare, out))
    known.unpersist()
    discard(units)
    discard(met)
    return links


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(id, k1, k2, class_id, n_links, first) per row; k1 and k2 name the row, ``first`` is true for the one
    row of its class that stays (repeated rows share it)."""
    bands, rows = choose_bands(threshold, recall)
    keyed = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *row_key(docs, id_col, text_col))
    signed_docs = materialize(signatures(keyed, bands, rows))
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "k1", "k2"))
    classes = materialize(signed_docs.where("node is not null").groupBy("node")
                          .agg(F.count("*").alias("m"), first.alias("first"), F.first("bands").alias("bands")))
    links = class_links(keyed, classes, threshold)
    label = connected_components(links.select(F.col("node").alias("u"), F.col("root").alias("v")))
    counts = links.groupBy("node").agg(F.sum("links").alias("links"))
    known = (classes.select("node", "m", "first").join(counts, "node", "left").join(label, "node", "left")
             .select("node", (F.col("m") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "first",
                     F.coalesce("label", "node").alias("label")))
    known = materialize(known)
    for table in (links, label, classes):
        discard(table)
    heads = materialize(known.groupBy("label").agg(F.min("first").alias("head")))
    known = known.join(heads, "label").select("node", "n_links", "head")
    out = signed_docs.join(known, "node", "left")
    return out.select("id", "k1", "k2", F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("head.id")).alias("class_id"),
                      F.coalesce("n_links", F.lit(0)).alias("n_links"),
                      (F.col("node").isNull() | ((F.col("k1") == F.col("head.k1")) & (F.col("k2") == F.col("head.k2")))).alias("first"))


def keep_one_of_each(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row of ``docs`` for each class, the one of the smallest id; rows without words stay all."""
    verdict = near_duplicates(docs, threshold)
    has_words = F.coalesce(F.col("text").rlike(WORD), F.lit(False))
    keyed = docs.select(pack_row(docs), has_words.alias("has_words"), *row_key(docs, "doc_id", "text"))
    firsts = verdict.where("first").select("k1", "k2").distinct()
    kept = keyed.where("has_words").join(firsts, ["k1", "k2"], "left_semi").dropDuplicates(["k1", "k2"])
    return kept.select("row.*").unionByName(keyed.where("not has_words").select("row.*"))


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents")).select(F.col("id").alias("doc_id"), "class_id", "n_links")


SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, list_sort(list_distinct(list_transform(range(1, greatest(len(w) - 3, 2)),
             lambda i: array_to_string(w[i:i + 4], ' ')))) AS s FROM w WHERE len(w) > 0),
c AS (SELECT s, min(doc_id) AS c, count(*) AS m, len(s) AS n FROM s GROUP BY s),
x AS (SELECT c, m, n, unnest(s) AS g FROM c),
p AS (SELECT a.c AS a, b.c AS b, b.m FROM x a JOIN x b ON a.g = b.g AND a.c <> b.c
      GROUP BY a.c, b.c, a.n, b.n, b.m HAVING count(*) >= 0.8 * (a.n + b.n - count(*))),
linked AS (SELECT a, sum(m) AS links FROM p GROUP BY a),
reach(c, r) AS (SELECT c, c FROM c UNION SELECT reach.c, p.b FROM reach JOIN p ON reach.r = p.a),
label AS (SELECT c, min(r) AS class_id FROM reach GROUP BY c),
k AS (SELECT s, c.c, class_id, (m - 1 + coalesce(links, 0))::BIGINT AS n_links
      FROM c JOIN label USING (c) LEFT JOIN linked ON c.c = linked.a)
SELECT w.doc_id, coalesce(class_id, w.doc_id) AS class_id, coalesce(n_links, 0) AS n_links
FROM w LEFT JOIN s USING (doc_id) LEFT JOIN k USING (s)
"""
