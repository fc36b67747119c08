"""Line dedup (operator 12): two Bloom filters, exact confirmation of suspects only.

A line's key is the line without ASCII blanks at both ends, A-Z lower-cased. Keys of
``MIN_CHARS`` code points or more that are found in ``MIN_DOCS`` documents or more
lose all their lines except those of one document, the one with the largest id.

* Pass 1: each task puts the key hashes of its documents (one of each in a document)
  into a filter of hashes seen once and, if they are there already, into a filter
  of hashes seen twice. Merged over tasks, the second filter also gets what the
  first filters of two tasks have in common.
* Pass 2: a document none of whose keys is in the second filter is finished where it
  is. The others wait with their suspects; only (document, digest of 128 bits) rows
  of these leave the task. False positives only add rows there.
* Suspects are confirmed exactly: distinct documents for each key, and the largest id.
  The verdicts go back to the waiting documents, which are cut.

Nothing is gathered by key: counts are pre-aggregated, and the counts (a written
table with one row for each key) are joined to the occurrences, where adaptive
execution can split a key that a large share of all documents has.

Bounds: the filters have ``BITS`` bits each whatever the input (32 MB; about 30
million different lines at under 1 % false positives; beyond that, more lines are
confirmed); a document's verdicts are bounded by its own lines.

Defined cases: a null or empty text is one empty line (a null text stays null when
cutting); rows with one id are one document, a null id is one that is smaller than
all others; repeated rows give repeated results; an empty table gives no rows; other
columns are carried along whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from responsekit.llm import bits as B
from responsekit.llm.common import map_rows, pack_row, read, row_key
from responsekit.llm.textstats import BLANKS
from responsekit.session import discard, materialize

MIN_CHARS, MIN_DOCS = 40, 5
_KEY = T.StructType([T.StructField("h1", T.LongType()), T.StructField("h2", T.LongType())])


def line_digest(line: str, min_chars: int) -> bytes | None:
    """128 bits that name the key of a line; none if the key is shorter than ``min_chars`` code points."""
    if len(line) < min_chars:
        return None
    key = line.strip(BLANKS)
    return xxhash.xxh3_128_digest(key.encode("utf-8", "surrogatepass").lower()) if len(key) >= min_chars else None


def text_digests(text: str | None, min_chars: int) -> list[bytes]:
    """The different key digests of a text."""
    return list({d for d in (line_digest(x, min_chars) for x in (text or "").split("\n")) if d})


def as_words(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), dtype="<u8").reshape(-1, 2)


def finish(text: str | None, gone: set[bytes], min_chars: int, cut: bool) -> tuple[int, int, str | None]:
    """Lines, lines dropped, and the kept text or (``cut`` false) its SHA-256."""
    lines = (text or "").split("\n")
    kept = [x for x in lines if line_digest(x, min_chars) not in gone] if gone else lines
    dropped = len(lines) - len(kept)
    if cut:
        return len(lines), dropped, "\n".join(kept) if dropped else text
    return len(lines), dropped, hashlib.sha256("\n".join(kept).encode("utf-8", "surrogatepass")).hexdigest()


def remove_lines(docs: DataFrame, cut: bool, carry: list[str] | None = None, id_col: str = "doc_id", text_col: str = "text",
                 min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, bits: int = B.BITS) -> DataFrame:
    """Every row of ``docs``: struct ``row`` (columns of ``carry``), n_lines, n_dropped and ``kept``, the text
    without the dropped lines (``cut``) or its digest."""
    def hashes(batch: pa.RecordBatch) -> np.ndarray:
        found = [d for t in batch.column(0) for d in text_digests(t.as_py(), min_chars)]
        return as_words(found)[:, 0]

    merged = materialize(B.merge(B.fill(docs.select(F.col(text_col).alias("text")), hashes, bits, twice=True), bits))
    twice = B.collect(merged, "twice", bits)
    discard(merged)

    keyed = docs.select(pack_row(docs, carry), F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                        *row_key(docs, id_col, text_col))
    schema = T.StructType([
        keyed.schema["row"], keyed.schema["id"], T.StructField("k1", T.LongType()), T.StructField("k2", T.LongType()),
        T.StructField("text", T.StringType()), T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType()),
        T.StructField("kept", T.StringType()), T.StructField("suspects", T.ArrayType(_KEY))])

    def first_pass(cols):
        seen = B.BitFilter(bits, twice.value)
        out = {c: [] for c in schema.names[4:]}
        each = [text_digests(t.as_py(), min_chars) for t in cols["text"]]
        words = as_words([d for x in each for d in x])
        suspect = seen.has(words[:, 0])
        signed, at = words.view(np.int64), 0
        for t, x in zip(cols["text"], each):
            rows = signed[at: at + len(x)][suspect[at: at + len(x)]].tolist()
            at += len(x)
            text = t.as_py()
            done = (None, None, None) if rows else finish(text, set(), min_chars, cut)
            for c, v in zip(out, (text if rows else None, *done, [{"h1": a, "h2": b} for a, b in rows])):
                out[c].append(v)
        return {**{c: cols[c] for c in schema.names[:4]}, **out}

    passed = materialize(map_rows(keyed, first_pass, schema))
    waiting = passed.where("n_lines is null")
    # one row for each different (document row, key)
    found = materialize(waiting.select("k1", "k2", "id", F.explode("suspects").alias("s")).select("k1", "k2", "id", "s.*").distinct())
    holder = F.max(F.struct(F.col("id").isNotNull().alias("known"), "id")).alias("holder")
    # written before it is joined back, so that adaptive execution can split a key in the join
    repeated = materialize(found.select("id", "h1", "h2").distinct().groupBy("h1", "h2").agg(F.count("*").alias("n"), holder)
                           .where(F.col("n") >= min_docs).select("h1", "h2", F.col("holder.id").alias("holder")))
    gone = (found.join(repeated, ["h1", "h2"]).where(~F.col("id").eqNullSafe(F.col("holder")))
            .groupBy("k1", "k2").agg(F.collect_list(F.struct("h1", "h2")).alias("gone")))
    done = T.StructType([schema[c] for c in ("row", "n_lines", "n_dropped", "kept")])

    def second_pass(cols):
        out = {c: [] for c in done.names[1:]}
        for t, g in zip(cols["text"], cols["gone"]):
            keys = {np.array([k["h1"], k["h2"]], dtype="<i8").tobytes() for k in g.as_py() or []}
            for c, v in zip(out, finish(t.as_py(), keys, min_chars, cut)):
                out[c].append(v)
        return {"row": cols["row"], **out}

    cut_rows = map_rows(waiting.select("row", "k1", "k2", "text").join(gone, ["k1", "k2"], "left"), second_pass, done)
    return passed.where("n_lines is not null").select(*done.names).unionByName(cut_rows)


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """``docs`` with the repeated lines cut out of the text column."""
    out = remove_lines(docs, True, [c for c in docs.columns if c != text_col], id_col, text_col, **limits)
    return out.select(*[(F.col("kept") if c == text_col else F.col("row")[c]).alias(c) for c in docs.columns])


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_lines(docs, False, ["doc_id"]).select("row.doc_id", "n_lines", "n_dropped", F.col("kept").alias("kept_sha256"))


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rn, doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
l AS (SELECT rn, doc_id, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS i FROM d),
k AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM l),
r AS (SELECT k, max(doc_id) AS holder FROM k WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
j AS (SELECT k.rn, k.doc_id, k.line, k.i, r.holder IS NULL OR r.holder = k.doc_id AS stays FROM k LEFT JOIN r USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (NOT stays) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (stays), '')) AS kept_sha256
FROM j GROUP BY rn, doc_id
"""
