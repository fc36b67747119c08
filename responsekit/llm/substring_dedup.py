"""Substring dedup (operator 4): seed and extend.

A window is ``LENGTH`` consecutive words of one document; a word goes if it lies
in a window whose word sequence also starts elsewhere (in another document or
the same). Windows are judged on the input.

Seeds: in every window the smallest hash of ``SEED`` words is its anchor, so equal
windows have equal anchors (winnowing); about one word in fourteen is one. An
anchor occurrence is extended to both sides to the stretch of all windows that it
anchors. Occurrences are grouped by anchor, and

* anchors that occur once in the corpus are done with;
* occurrences whose whole extension occurs twice or more are repeats throughout;
* the others that share an anchor are compared window by window, one
  representative for each different extension.

The covered windows of a document are merged into maximal repeats and cut out.
No step lists pairs: groups are counted with partial aggregates and the counts
joined back, so a passage found in a third of all documents costs as many rows
as it has occurrences, and adaptive execution can split such a key in the joins.

Hashes are of 128 bits (extensions) and 96 bits (windows) in all, so false repeats
are not to be expected at any corpus size.

Defined cases: a null text has no words and becomes null in the cut text, its
digest is that of the empty text; a text of fewer than ``LENGTH`` words keeps all;
equal rows are repeats of each other; an empty table gives no rows; other columns
are carried along untouched, whatever their names.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from responsekit.llm.common import (
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
from responsekit.session import discard, materialize

LENGTH, SEED = 35, 8
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2 ** 64))
_LEN = np.uint64(0xC2B2AE3D27D4EB4F)


def powers(base: np.uint64, n: int) -> np.ndarray:
    return np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n, base))])


def find_anchors(h: np.ndarray, length: int, seed: int) -> tuple[np.ndarray, ...]:
    """Of a text with word hashes ``h``: per anchor occurrence the anchor's hash, the hash of its
    extension, its first window, its number of windows, and how many like it follow each other."""
    n = len(h)
    if n < length:
        e = np.zeros(0, np.uint64)
        return e, e, e.astype(np.int64), e.astype(np.int64), e.astype(np.int64)
    g = ngram_hashes(h, seed)
    at = sliding_window_view(g, length - seed + 1).argmin(axis=1) + np.arange(n - length + 1)
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    count = np.diff(np.concatenate([first, [len(at)]]))
    end = first + count - 1 + length
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * powers(_BASE, n)[:n])])
    whole = mix64((total[end] - total[first]) * powers(_INVERSE, n)[first] + (end - first).astype(np.uint64) * _LEN)
    anchor = g[at[first]]
    # a run of one repeated word gives the same anchor and extension at each word: kept as one row
    new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (whole[1:] != whole[:-1])])
    start = np.flatnonzero(new)
    like = np.diff(np.concatenate([start, [len(anchor)]]))
    return anchor[start], whole[start], first[start], np.add.reduceat(count, start), like


def covered(n_words: int, windows: np.ndarray, length: int) -> np.ndarray:
    """Mask of the words in the windows that start at ``windows``."""
    steps = np.zeros(n_words + 1, dtype=np.int64)
    starts = np.unique(windows)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + length, -1)
    return np.cumsum(steps[:-1]) > 0


def anchor_table(keyed: DataFrame, length: int, seed: int) -> DataFrame:
    """(a, u, k1, k2, at, n, like) of all anchor occurrences of ``keyed`` (k1, k2, text)."""
    long, small = T.LongType(), T.IntegerType()
    schema = T.StructType([T.StructField(c, long) for c in ("a", "u", "k1", "k2")]
                          + [T.StructField(c, small) for c in ("at", "n", "like")])

    def to_anchors(cols):
        found = [find_anchors(word_hashes(split_words(t.as_py())), length, seed) for t in cols["text"]]
        each = [len(f[0]) for f in found]
        a, u, at, n, like = (np.concatenate(x) for x in zip(*found))
        return {"a": signed(a), "u": signed(u), "at": at, "n": n, "like": like,
                **{k: np.repeat(cols[k].to_numpy(), each) for k in ("k1", "k2")}}

    return map_rows(keyed.select("k1", "k2", "text"), to_anchors, schema)


def repeated_stretches(keyed: DataFrame, length: int, seed: int) -> DataFrame:
    """Per document key the ``stretches`` (at, n, whole, emit) around anchors that occur twice or more.

    ``whole``: the entire extension is repeated. ``emit``: its windows take part in the comparison by window."""
    anchors = materialize(anchor_table(keyed, length, seed))
    # counts are written before they are joined back: both sides of the join are then plain exchanges,
    # and adaptive execution can split an anchor that a large share of the rows has
    twice = materialize(anchors.groupBy("a").agg(F.sum("like").alias("total")).where("total >= 2").select("a"))
    repeated = materialize(anchors.join(twice, "a"))
    discard(anchors)
    extensions = repeated.groupBy("a", "u").agg(F.sum("like").alias("found"), F.min(F.struct("k1", "k2", "at")).alias("first"))
    extensions = materialize(extensions)
    several = materialize(extensions.groupBy("a").agg(F.count("*").alias("kinds")).where("kinds >= 2")
                          .select("a", F.lit(True).alias("several")))
    judged = repeated.join(extensions.join(several, "a", "left"), ["a", "u"])
    is_first = F.struct("k1", "k2", "at") == F.col("first")
    judged = judged.select("k1", "k2", "at", "n", (F.col("found") >= 2).alias("whole"),
                           (F.col("several").isNotNull() & ((F.col("found") == 1) | is_first)).alias("emit"))
    # repeated rows have one key and equal stretches: the set of them is that of one row
    return judged.groupBy("k1", "k2").agg(F.collect_set(F.struct("at", "n", "whole", "emit")).alias("stretches"))


_WINDOW = T.StructType([T.StructField("at", T.IntegerType()), T.StructField("h", T.LongType()),
                        T.StructField("h2", T.IntegerType()), T.StructField("weight", T.IntegerType())])


def judge_document(text: str | None, stretches: list[dict] | None, length: int, seed: int) -> tuple:
    """Windows known to be repeated, and those to compare as rows of ``_WINDOW`` (weight 1: in doubt, 2: repeated)."""
    if not stretches:
        return np.zeros(0, np.int64), [], False
    sure = [np.arange(s["at"], s["at"] + s["n"]) for s in stretches if s["whole"]]
    windows, doubt = [], any(s["emit"] and not s["whole"] for s in stretches)
    if any(s["emit"] for s in stretches):
        h = word_hashes(split_words(text))
        full = signed(ngram_hashes(h, length))
        least = sliding_window_view(ngram_hashes(h, seed), length - seed + 1)
        for s in stretches:
            if s["emit"]:
                h2 = int(least[s["at"]].min() & np.uint64(0x7FFFFFFF))  # of the anchor that these windows share
                # of a run of equal windows one is enough
                rows = range(s["at"], s["at"] + (s["n"] if not s["whole"] else min(s["n"], length)))
                windows += [{"at": k, "h": int(full[k]), "h2": h2, "weight": 2 if s["whole"] else 1} for k in rows]
    return np.concatenate(sure) if sure else np.zeros(0, np.int64), windows, doubt


def cut_text(text: str, gone: np.ndarray) -> str:
    """``text`` without the words marked in ``gone``; what is left between two cuts keeps its blanks."""
    parts, start, end = [], None, 0
    for k, m in enumerate(_WORD.finditer(text)):
        if gone[k]:
            if start is not None:
                parts.append(text[start:end])
            start = None
        else:
            start = m.start() if start is None else start
            end = m.end()
    if start is not None:
        parts.append(text[start:end])
    return "\n".join(parts)


def finish(text: str | None, windows: np.ndarray, length: int, cut: bool) -> tuple[int, int, str | None]:
    """Words, words removed, and the kept text or (``cut`` false) the SHA-256 of the kept words joined by spaces."""
    words = split_words(text)
    gone = covered(len(words), windows, length) if len(windows) else np.zeros(len(words), dtype=bool)
    removed = int(gone.sum())
    if cut:
        return len(words), removed, text if not removed else cut_text(text, gone)
    kept = b" ".join(w for w, g in zip(words, gone) if not g) if removed else b" ".join(words)
    return len(words), removed, hashlib.sha256(kept).hexdigest()


def remove_repeats(docs: DataFrame, cut: bool, carry: list[str] | None = None, id_col: str = "doc_id",
                   text_col: str = "text", length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """Every row of ``docs``: struct ``row`` (columns of ``carry``), n_words, n_removed and ``kept``, the text
    without its repeats (``cut``) or its digest."""
    keys = row_key(docs, id_col, text_col)
    if isinstance(docs.schema[id_col].dataType, T.IntegralType):
        keys[0] = F.coalesce(F.col(id_col).cast("long"), F.lit(-1)).alias("k1")  # plain ids pack better than hashes
    keyed = docs.select(pack_row(docs, carry), F.col(text_col).alias("text"), *keys)
    stretches = repeated_stretches(keyed, length, seed)
    schema = T.StructType([
        keyed.schema["row"], T.StructField("k1", T.LongType()), T.StructField("k2", T.LongType()),
        T.StructField("text", T.StringType()), T.StructField("n_words", T.LongType()),
        T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType()),
        T.StructField("sure", T.ArrayType(T.IntegerType())), T.StructField("windows", T.ArrayType(_WINDOW))])

    def first_pass(cols):
        out = {c: [] for c in schema.names[3:]}
        for t, s in zip(cols["text"], cols["stretches"]):
            text = t.as_py()
            sure, windows, doubt = judge_document(text, s.as_py(), length, seed)
            done = (None, None, None) if doubt else finish(text, sure, length, cut)
            for c, v in zip(out, (text if doubt else None, *done, sure if doubt else None, windows)):
                out[c].append(v)
        return {"row": cols["row"], "k1": cols["k1"], "k2": cols["k2"], **out}

    # documents whose windows are all settled are finished here; the others wait with their text
    passed = materialize(map_rows(keyed.join(stretches, ["k1", "k2"], "left"), first_pass, schema))
    windows = passed.where(F.size("windows") > 0).select("k1", "k2", F.explode("windows").alias("w")).select("k1", "k2", "w.*")
    twice = materialize(windows.groupBy("h", "h2").agg(F.sum("weight").alias("total")).where("total >= 2").select("h", "h2"))
    found = (windows.where("weight = 1").join(twice, ["h", "h2"])
             .groupBy("k1", "k2").agg(F.collect_set("at").alias("more")))
    done = T.StructType([schema[c] for c in ("row", "n_words", "n_removed", "kept")])

    def second_pass(cols):
        out = {c: [] for c in done.names[1:]}
        for t, sure, more in zip(cols["text"], cols["sure"], cols["more"]):
            starts = np.array((sure.as_py() or []) + (more.as_py() or []), dtype=np.int64)
            for c, v in zip(out, finish(t.as_py(), starts, length, cut)):
                out[c].append(v)
        return {"row": cols["row"], **out}

    waiting = passed.where("n_words is null").select("row", "k1", "k2", "text", "sure")
    return (passed.where("n_words is not null").select(*done.names)
            .unionByName(map_rows(waiting.join(found, ["k1", "k2"], "left"), second_pass, done)))


def cut_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeats cut out of ``text`` and ``n_chars`` (if there) counted anew."""
    out = remove_repeats(docs, cut=True, carry=[c for c in docs.columns if c != "text"])
    new = {"text": F.col("kept"), "n_chars": F.when(F.col("n_removed") > 0, F.length("kept").cast(docs.schema["n_chars"].dataType))
           .otherwise(F.col("row.n_chars")) if "n_chars" in docs.columns else None}
    return out.select(*[(new[c] if c in new else F.col("row")[c]).alias(c) for c in docs.columns])


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs, cut=False, carry=["doc_id"]).select(
        "row.doc_id", "n_words", "n_removed", F.col("kept").alias("kept_sha256"))


SQL = r"""
WITH w AS (SELECT row_number() OVER () AS rn, doc_id,
                  coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
win AS (SELECT rn, i, md5(array_to_string(w[i:i + 34], ' ')) AS h
        FROM (SELECT rn, w, unnest(range(1, len(w) - 33)) AS i FROM w WHERE len(w) >= 35)),
dup AS (SELECT rn, i FROM win JOIN (SELECT h FROM win GROUP BY h HAVING count(*) > 1) USING (h)),
word AS (SELECT rn, k, w[k] AS x FROM (SELECT rn, w, unnest(range(1, len(w) + 1)) AS k FROM w)),
near AS (SELECT word.rn, word.k, x, dup.i FROM word ASOF LEFT JOIN dup ON word.rn = dup.rn AND word.k >= dup.i),
kept AS (SELECT rn, count(*) AS n, string_agg(x, ' ' ORDER BY k) AS t FROM near WHERE i IS NULL OR i < k - 34 GROUP BY rn)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (rn)
"""
