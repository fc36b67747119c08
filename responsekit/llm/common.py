"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# One word: a maximal run of characters that are neither space nor \t..\r.
WORD = r"[^\x20\x09-\x0D]+"
#: Words in a shingle wherever an operator does not say otherwise.
SHINGLE = 5


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def row_key(df: DataFrame, id_col: str, text_col: str) -> list[Column]:
    """Two longs that name a row by its id and whole text.

    Rows with an equal key have the same id and text, so what an operator finds
    out about one of them holds for the other; nothing depends on row order or
    partitioning, and a lost executor computes the same keys again.
    """
    return [F.xxhash64(F.col(id_col)).alias("k1"), F.xxhash64(F.lit("text"), F.col(text_col)).alias("k2")]


def pack_row(df: DataFrame, names: list[str] | None = None) -> Column:
    """The columns of ``df`` (or ``names``) as one struct ``row``, out of the way of working columns."""
    return F.struct(*[F.col(f"`{c}`") for c in (names or df.columns)]).alias("row")


def split_words(text: str | None) -> list[bytes]:
    """The words of a text in UTF-8 (``bytes.split`` splits at exactly the six ASCII blanks)."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))


_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93), np.uint64(0x632BE59BD9B4E019)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambler of 64-bit values."""
    x = (x ^ (x >> np.uint64(32))) * _M2
    x = (x ^ (x >> np.uint64(29))) * _M2
    return x ^ (x >> np.uint64(32))


def ngram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` consecutive items, by doubling: log2(n) passes."""
    if len(h) < n:
        return h[:0]
    cur, width = h, 1
    while width < n:
        step = min(width, n - width)  # the second half may overlap the first; the pair still fixes the run
        cur = mix64(cur[:-step] * _M1 + (cur[step:] ^ _M3))
        width += step
    return cur


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def map_rows(df: DataFrame, fn: Callable[[dict], dict], schema: T.StructType) -> DataFrame:
    """``mapInArrow`` where ``fn`` turns the columns of one Arrow batch (name to
    Arrow array) into the columns of an output batch (name to array or list)."""
    from pyspark.sql.pandas.types import to_arrow_schema
    out_schema = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # some texts at a time, so that memory follows bytes, not rows
            for part in cut_batch(batch):
                cols = fn(dict(zip(part.schema.names, part.columns)))
                yield pa.RecordBatch.from_arrays(
                    [cols[f.name] if isinstance(cols[f.name], pa.Array) else pa.array(cols[f.name], type=f.type)
                     for f in out_schema], schema=out_schema)

    return df.mapInArrow(run, schema)


#: Bytes of an Arrow batch that are worked on at once.
PIECE_BYTES = 4 << 20


def cut_batch(batch: pa.RecordBatch, piece: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    rows = batch.num_rows
    if not rows:
        return
    step = max(1, min(rows, int(rows * piece / max(batch.nbytes, 1))))
    for at in range(0, rows, step):
        yield batch.slice(at, step)
