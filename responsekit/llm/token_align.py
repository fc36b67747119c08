"""Cross-tokenizer alignment (operator 11): pointer jumping over overlapping tokens.

A text is encoded by two tokenizers; both sequences cover the same bytes (a space,
then the text). Every token points to its farthest-right overlapping token of the
other sequence, or to itself where both end at the same byte (the token of the
second sequence is the terminal one). Successors are doubled, for all tokens of a
chunk of documents at once, until nothing moves: the terminal token labels the
group, so a group ends at each offset where tokens of both sequences end.

Links are the pairs of an A and a B token of one group. How many documents hold an id
pair linked is counted over the whole corpus: a chunk (a few MB of text) gives each
of its different pairs once with its number of documents, these are summed up, and
each chunk gets the totals of its own pairs back, by a join on the pair and a cogroup
on the chunk. So documents' links never leave their chunk, and no group is larger
than one. The highest count of every A id is a table bounded by the vocabulary, the
only one that is broadcast.

Defined cases: a text that is null or empty, or whose joined tokens of either side
aren't its bytes, has no tokens: zeros and ''. Repeated rows are documents of their
own; a null id is carried; an empty table gives no rows; only the id and text columns
are read. A group of very many tokens is expanded by its different ids, slice by slice.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from responsekit.llm.bits import task_number
from responsekit.llm.common import cut_batch, read
from responsekit.llm.token_counts import PATTERN
from responsekit.session import discard, materialize

#: Vocabulary files, installed on every machine.
BYTE_BPE, PIECE_BPE = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"
#: Bits of a token id inside a pair code, links that are expanded at once, bytes of text in a chunk.
ID_BITS, MOST_LINKS, PIECE = 20, 1 << 20, 2 << 20
_LOW = (1 << ID_BITS) - 1


@dataclass
class Vocabulary:
    encode: object  # list of texts to list of id lists
    pieces: list  # bytes of each id
    lengths: np.ndarray
    digits: np.ndarray  # decimal digits of each id, padded with zero bytes on the left


def _tables(encode, pieces: list[bytes]) -> Vocabulary:
    if len(pieces) > _LOW:
        raise ValueError(f"a vocabulary of more than {_LOW} ids")
    width = len(str(len(pieces)))
    text = "".join(str(k).rjust(width, "\0") for k in range(len(pieces))).encode()
    return Vocabulary(encode, pieces, np.fromiter(map(len, pieces), np.int64, len(pieces)),
                      np.frombuffer(text, np.uint8).reshape(-1, width))


def byte_alphabet() -> dict[str, int]:
    """How byte-level vocabularies write bytes: printable Latin-1 as itself, the rest in order from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


@lru_cache(maxsize=2)
def load_byte_bpe(path: str) -> Vocabulary:
    """A byte-level BPE file; ids are in merge order, so they are the merge ranks. Special tokens are plain text."""
    import tiktoken
    with open(path, encoding="utf-8") as f:
        data = json.load(f)
    special = {t["id"] for t in data["added_tokens"]}
    alphabet = byte_alphabet()
    ranks = {bytes(alphabet[c] for c in t): k for t, k in data["model"]["vocab"].items() if k not in special}
    pieces = [b""] * (max([*ranks.values(), *special]) + 1)
    for t, k in ranks.items():
        pieces[k] = t
    encoding = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _tables(lambda texts: [encoding.encode_ordinary(" " + t) for t in texts], pieces)


@lru_cache(maxsize=2)
def load_piece_bpe(path: str) -> Vocabulary:
    """A sentence-piece file; its encoder adds the space itself."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(k) for k in range(model.get_piece_size())]
    pieces = [bytes([int(p[3:5], 16)]) if model.is_byte(k) else p.replace("▁", " ").encode() for k, p in enumerate(pieces)]
    return _tables(lambda texts: model.encode(texts, num_threads=1), pieces)


def jump(nxt: np.ndarray) -> np.ndarray:
    """Each node's terminal node, by doubling the successors."""
    while True:
        far = nxt[nxt]
        if (far == nxt).all():
            return nxt
        nxt = far


def group_tokens(end_a: np.ndarray, end_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group number of each token, from the ends of two token sequences over the same bytes."""
    n = len(end_a)
    to_b = np.searchsorted(end_b, end_a)
    to_a = np.searchsorted(end_a, end_b)
    here = end_a[to_a] == end_b  # both end: the chain ends at this token
    last = jump(np.concatenate([n + to_b, np.where(here, n + np.arange(len(end_b)), to_a)]))
    number = np.cumsum(here) - 1
    return number[last[:n] - n], number[last[n:] - n]


def expand(starts_a, sizes_a, starts_b, sizes_b, ids_a, ids_b, home) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(code, times) of the links of all groups: the group's ``home`` document, A id and B id in one number."""
    links = sizes_a * sizes_b
    small = np.flatnonzero(links <= MOST_LINKS)
    upto = np.cumsum(links[small])
    at = 0
    while at < len(small):  # as many groups at a time as MOST_LINKS allows
        to = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + MOST_LINKS, "right")))
        g, each = small[at:to], links[small[at:to]]
        row = np.repeat(np.arange(len(g)), each)
        k = np.arange(len(row)) - np.repeat(np.cumsum(each) - each, each)
        g = g[row]
        a, b = ids_a[starts_a[g] + k // sizes_b[g]], ids_b[starts_b[g] + k % sizes_b[g]]
        yield np.unique(home[g] << 2 * ID_BITS | a << ID_BITS | b, return_counts=True)
        at = to
    for g in np.flatnonzero(links > MOST_LINKS):
        a, na = np.unique(ids_a[starts_a[g]: starts_a[g] + sizes_a[g]], return_counts=True)
        b, nb = np.unique(ids_b[starts_b[g]: starts_b[g] + sizes_b[g]], return_counts=True)
        step = max(1, MOST_LINKS // len(b))
        for k in range(0, len(a), step):
            yield ((home[g] << 2 * ID_BITS | a[k: k + step, None] << ID_BITS | b).ravel(), (na[k: k + step, None] * nb).ravel())


def sum_up(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Different codes in order and how often each is there."""
    if len(parts) == 1:
        return parts[0]
    code, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    times = np.zeros(len(code), dtype=np.int64)
    np.add.at(times, at, np.concatenate([p[1] for p in parts]))
    return code, times


def write_groups(va: Vocabulary, vb: Vocabulary, a, b, group_a, group_b, home) -> tuple[bytes, np.ndarray]:
    """All groups as ``a1,a2|b1;a3|b2``, document after document without anything between, and where each document ends."""
    n = len(a)
    order = np.lexsort((np.concatenate([np.zeros(n, np.int8), np.ones(len(b), np.int8)]), np.concatenate([group_a, group_b])))
    width = max(va.digits.shape[1], vb.digits.shape[1])
    chars = np.zeros((n + len(b), width + 1), dtype=np.uint8)
    chars[:n, width - va.digits.shape[1]: width] = va.digits[a]
    chars[n:, width - vb.digits.shape[1]: width] = vb.digits[b]
    chars = chars[order]
    group, side = np.concatenate([group_a, group_b])[order], order >= n
    doc = home[group]
    same_group, same_doc = group[1:] == group[:-1], doc[1:] == doc[:-1]
    chars[:-1, width] = np.where(same_group, np.where(side[1:] == side[:-1], ord(","), ord("|")), np.where(same_doc, ord(";"), 0))
    used = chars != 0
    ends = np.cumsum(used.sum(axis=1))
    last = np.flatnonzero(np.concatenate([~same_doc, [True]])) if len(doc) else np.zeros(0, np.int64)
    return chars[used].tobytes(), ends[last]


def align_chunk(texts: list[str | None], va: Vocabulary, vb: Vocabulary) -> dict:
    """Alignment of the texts of one chunk: per text n_a, n_b, n_groups, n_links, groups and the byte ends of groups, and
    the different (text, pair) codes with how often each is linked."""
    n = len(texts)
    full = [k for k, t in enumerate(texts) if t]
    given = [texts[k] for k in full]
    sides = [v.encode(given) for v in (va, vb)]
    ok = []
    for k, t, a, b in zip(range(len(full)), given, *sides):
        data = (" " + t).encode("utf-8", "surrogatepass")
        if b"".join([va.pieces[x] for x in a]) == data and b"".join([vb.pieces[x] for x in b]) == data:
            ok.append(k)
    out = {c: np.zeros(n, dtype=np.int64) for c in ("n_a", "n_b", "n_groups", "n_links")}
    groups, cuts = [b""] * n, [np.zeros(0, np.int64)] * n
    none = np.zeros(0, np.int64)
    if not ok:
        return {**out, "groups": groups, "cuts": cuts, "code": none, "times": none}
    where = np.array([full[k] for k in ok])
    (a, len_a), (b, len_b) = ((np.fromiter((x for k in ok for x in s[k]), np.int64), np.array([len(s[k]) for k in ok])) for s in sides)
    end_a, end_b = np.cumsum(va.lengths[a]), np.cumsum(vb.lengths[b])
    group_a, group_b = group_tokens(end_a, end_b)
    n_groups = int(group_b[-1]) + 1
    sizes_a, sizes_b = np.bincount(group_a, minlength=n_groups), np.bincount(group_b, minlength=n_groups)
    starts_a, starts_b = np.cumsum(sizes_a) - sizes_a, np.cumsum(sizes_b) - sizes_b
    home = np.repeat(where, len_a)[starts_a]
    np.add.at(out["n_links"], home, sizes_a * sizes_b)
    out["n_a"][where], out["n_b"][where], out["n_groups"] = len_a, len_b, np.bincount(home, minlength=n)
    code, times = sum_up(list(expand(starts_a, sizes_a, starts_b, sizes_b, a, b, home)))
    text, ends = write_groups(va, vb, a, b, group_a, group_b, home)
    byte_ends = end_b[starts_b + sizes_b - 1]
    doc_end = np.cumsum(out["n_groups"][where])
    start = first = base = 0
    for k, end, to in zip(where, ends, doc_end):
        groups[k], cuts[k] = text[start:end], byte_ends[first:to] - base
        start, first, base = end, to, byte_ends[to - 1]
    return {**out, "groups": groups, "cuts": cuts, "code": code, "times": times}


def align(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a_path: str = BYTE_BPE, b_path: str = PIECE_BPE,
          digest: bool = False) -> DataFrame:
    """A row per document: id, n_a, n_b, n_groups, n_links, n_best, count_sum, and ``groups`` (``a1,a2|b1;...``) with
    ``group_ends`` (byte offsets in space + text), or (``digest``) the SHA-256 of the groups ('' without tokens)."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    long = T.LongType()
    fields = [T.StructField("chunk", long), src.schema["id"], *[T.StructField(c, long) for c in ("n_a", "n_b", "n_groups", "n_links")],
              T.StructField("groups", T.StringType()), T.StructField("group_ends", T.ArrayType(long)),
              T.StructField("links", T.BinaryType()), T.StructField("pairs", T.ArrayType(long)), T.StructField("found", T.ArrayType(long))]
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in fields])
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        va, vb = load_byte_bpe(a_path), load_piece_bpe(b_path)
        pack, chunk = zstandard.ZstdCompressor(level=1).compress, task_number() << 32
        for batch in batches:
            for part in cut_batch(batch, PIECE):
                got = align_chunk(part.column(1).to_pylist(), va, vb)
                n = part.num_rows
                pairs, at = np.unique(got["code"] & ((1 << 2 * ID_BITS) - 1), return_inverse=True)
                ends = np.searchsorted(got["code"] >> 2 * ID_BITS, np.arange(n), "right")
                starts = np.concatenate([[0], ends[:-1]])
                at, times = at.astype("<i4"), got["times"].astype("<i8")
                blobs = [pack(at[i:j].tobytes() + times[i:j].tobytes()) if j > i else None for i, j in zip(starts, ends)]
                text = [x.decode() for x in got["groups"]] if not digest else \
                    [hashlib.sha256(x).hexdigest() if x else "" for x in got["groups"]]
                rows = {"chunk": [chunk] * n, "id": part.column(0), **{c: got[c] for c in ("n_a", "n_b", "n_groups", "n_links")},
                        "groups": text, "group_ends": [None] * n if digest else got["cuts"], "links": blobs,
                        "pairs": [None] * n, "found": [None] * n}
                yield pa.RecordBatch.from_arrays([rows[f.name] if isinstance(rows[f.name], pa.Array) else
                                                  pa.array(rows[f.name], type=f.type) for f in arrow], schema=arrow)
                head = {"chunk": [chunk], "pairs": [pairs], "found": [np.bincount(at, minlength=len(pairs))]}
                yield pa.RecordBatch.from_arrays([pa.array(head.get(f.name, [None]), type=f.type) for f in arrow], schema=arrow)
                chunk += 1

    table = materialize(src.mapInArrow(run, schema))
    heads = table.where("pairs is not null").select("chunk", F.inline(F.arrays_zip("pairs", "found")))
    # written before they are joined back: every pair has one row, and at most one a chunk on the other side
    counts = materialize(heads.groupBy(F.col("pairs").alias("pair")).agg(F.sum("found").alias("count")))
    side = F.shiftright("pair", ID_BITS)
    best = counts.groupBy(side.alias("a")).agg(F.max("count").alias("best"))  # at most a row per id of A
    known = counts.withColumn("a", side).join(F.broadcast(best), "a").select(
        "pair", (F.col("count") * 2 + (F.col("count") == F.col("best")).cast("long")).alias("value"))
    totals = heads.select(F.col("chunk").alias("of"), F.col("pairs").alias("pair")).join(materialize(known), "pair")
    discard(counts)
    result = T.StructType([schema[c] for c in ("id", "n_a", "n_b", "n_groups", "n_links")]
                          + [T.StructField(c, long) for c in ("n_best", "count_sum")] + [schema["groups"], schema["group_ends"]])
    out_arrow = to_arrow_schema(result)

    def add_up(docs_of: pa.Table, pairs_of: pa.Table) -> pa.Table:
        value = pairs_of.column("value").to_numpy()[np.argsort(pairs_of.column("pair").to_numpy())]
        unpack, n_best, total = zstandard.ZstdDecompressor().decompress, [], []
        for x in docs_of.column("links"):
            data = unpack(x.as_py()) if x.is_valid else b""
            n = len(data) // 12
            v, times = value[np.frombuffer(data, "<i4", n)], np.frombuffer(data, "<i8", n, 4 * n)
            n_best.append(int((times * (v & 1)).sum()))
            total.append(int((times * (v >> 1)).sum()))
        cols = {c: docs_of.column(c) for c in result.names if c in docs_of.column_names}
        cols |= {"n_best": pa.array(n_best, pa.int64()), "count_sum": pa.array(total, pa.int64())}
        return pa.table([cols[f.name].cast(f.type) for f in out_arrow], schema=out_arrow)

    rows = table.where("pairs is null").drop("pairs", "found")
    return rows.groupBy("chunk").cogroup(totals.groupBy("of")).applyInArrow(add_up, result)


def op11_token_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(read(spark, sf_dir, "documents"), digest=True).select(
        F.col("id").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.col("groups").alias("groups_sha256"))
