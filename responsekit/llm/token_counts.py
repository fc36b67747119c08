"""Token counts (operator 1): offset-mapped attribution to sections.

A document is encoded once, as a whole, with a public byte-level BPE vocabulary.
Token lengths in bytes give every token its span in the text; a sorted interval
join of these spans with the spans of the sections (here: lines, each with its
line end) attributes each token to one section. A token that crosses a boundary
goes, by the explicit rule, to the section with

* ``first``: its first byte, * ``last``: its last byte, or
* ``most``: most of its bytes, the earlier one in a tie.

So counts of sections add up to the count of the document.

Defined cases: a null or empty text is one section without tokens; repeated rows
give repeated results; an empty table gives no rows; only the id and text columns
are read.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from responsekit.llm.common import map_rows, read

#: Vocabulary file (token in base64 and rank on each line); installed on every machine.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: how this public vocabulary cuts text into words before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
RULES = ("first", "last", "most")


@lru_cache(maxsize=2)
def load_encoding(path: str):
    """The encoding and the byte length of each of its tokens, once per Python worker."""
    import tiktoken
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in f if x.strip())}
    lengths = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
    lengths[list(ranks.values())] = [len(t) for t in ranks]
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), lengths


def encode(text: str, path: str = VOCABULARY) -> tuple[np.ndarray, np.ndarray]:
    """Token ids and the byte offsets between tokens (one more than tokens)."""
    encoding, lengths = load_encoding(path)
    tokens = np.array(encoding.encode_ordinary(text), dtype=np.int64)
    return tokens, np.concatenate([[0], np.cumsum(lengths[tokens])]).astype(np.int64)


def line_bounds(data: bytes) -> np.ndarray:
    """Byte offsets of the ends of lines, from 0 on; a line includes its line end."""
    ends = np.flatnonzero(np.frombuffer(data, dtype=np.uint8) == 10) + 1
    return np.unique(np.concatenate([[0], ends, [len(data)]])) if data else np.array([0, 0])


def attribute(offsets: np.ndarray, bounds: np.ndarray, rule: str = "most") -> tuple[np.ndarray, np.ndarray]:
    """Tokens per section, and tokens of it that cross a boundary."""
    sections = len(bounds) - 1
    if len(offsets) < 2:
        return np.zeros(sections, dtype=np.int64), np.zeros(sections, dtype=np.int64)
    start, end = offsets[:-1], offsets[1:]
    first = np.searchsorted(bounds, start, side="right") - 1
    last = np.searchsorted(bounds, end, side="left") - 1
    crosses = first != last
    home = (last if rule == "last" else first).copy()
    if rule == "most":
        for k in np.flatnonzero(crosses):
            cut = np.clip(bounds[first[k]: last[k] + 2], start[k], end[k])
            home[k] = first[k] + int(np.argmax(np.diff(cut)))
    return np.bincount(home, minlength=sections), np.bincount(home[crosses], minlength=sections)


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rule: str = "most",
                 vocabulary: str = VOCABULARY) -> DataFrame:
    """A row per document and line: id, section (from 0), char_start, char_end, n_tokens, n_crossing."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = T.StructType([src.schema["id"], *[T.StructField(c, T.LongType()) for c in (
        "section", "char_start", "char_end", "n_tokens", "n_crossing")]])

    def count(cols):
        out: dict[str, list] = {c: [] for c in schema.names[1:]}
        take = []
        for k, t in enumerate(cols["text"]):
            text = t.as_py() or ""
            data = text.encode("utf-8", "surrogatepass")
            bounds = line_bounds(data)
            _, offsets = encode(text, vocabulary)
            tokens, crossing = attribute(offsets, bounds, rule)
            chars = bounds
            if len(data) != len(text):  # characters before a byte: bytes that don't continue one
                starts = (np.frombuffer(data, dtype=np.uint8) & 0xC0) != 0x80
                chars = np.concatenate([[0], np.cumsum(starts)])[bounds]
            take.append(np.full(len(tokens), k))
            for c, v in zip(out, (np.arange(len(tokens)), chars[:-1], chars[1:], tokens, crossing)):
                out[c].append(v)
        return {"id": cols["id"].take(np.concatenate(take)), **{c: np.concatenate(v) for c, v in out.items()}}

    return map_rows(src, count, schema)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(read(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
