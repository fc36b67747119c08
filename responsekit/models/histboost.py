"""Boosted trees that continue from stored margins.

The feature columns are binned once at approximate quantiles and written as blocks of
``BLOCK_ROWS`` rows, each with its margins. A step reads that table, adds ``STEP`` trees,
and writes it again with the new margins, the loss of every round and, where the AUC
decides, the validation scores of every round. So no round is fitted twice, a longer
budget continues where a shorter one ended, a lost executor repeats one step, and the
best prefix of the ensemble is cut out of it.

Trees are second-order and grow level by level from sums of gradients and hessians for
each (node, feature, bin):

* A table of several blocks takes a job for each level: every task adds up its blocks,
  the sums meet by feature group, and a row for each node and group, its best split,
  reaches the driver. Blocks with their margins stay persisted within a step. Fits over
  the same table share these jobs (``Together``).
* The table of one block (``ONE_BLOCK`` cells at most) has its levels in the task that
  holds the block, so a step is one job: in its JVM (``jvm_steps.py``), or by ``advance`` where
  that can't be reached. Equal columns are looked at once, and columns of few bins (in ``advance``
  those that follow from each other) are counted together (``BlockPacks``).

Gradients and hessians are rounded to 2^-24 and summed up as whole numbers, so both ways
give the same trees, whatever the partitioning; rows and columns of a round are drawn by
hashes of row key, seed and round.

Up to ``ONE_BLOCK`` cells (128 MB) a round in one task takes less time than the jobs of its levels, for one fit and more
so for several, which run side by side (README has the figures).

Memory: a block (rows x features bytes), sums of ``CELLS`` cells at a time, shared by the
fits of a ``Together``, the trees.
"""

from __future__ import annotations

import hashlib
import json
import math
import time
from collections.abc import Callable, Generator, Iterator
from dataclasses import dataclass, field
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from responsekit.models import jvm_steps
from responsekit.operators.evaluate import auc_by_group
from responsekit.session import discard, materialize

#: Rows of a block, rounds of a step, cells (node, feature, bin) summed up at a time, bins of a feature group, cells
#: (row, feature) up to which all columns are added up in one go, and up to which a table is one block; rounds whose
#: trees wait until the persisted margins are renewed.
BLOCK_ROWS, STEP, CELLS, GROUP_BINS, FEW_CELLS, ONE_BLOCK, CARRY = 65_536, 50, 1 << 22, 4096, 1 << 19, 1 << 27, 8
#: Rows whose work arrays stay in the processor's cache.
RUN = 1 << 14
_UNIT = float(1 << 24)


@dataclass(frozen=True)
class Params:
    rounds: int = 500
    rate: float = 0.05
    depth: int = 6
    bins: int = 254
    min_rows: int = 1
    min_hessian: float = 1e-3
    l1: float = 0.0
    l2: float = 1.0
    min_gain: float = 0.0
    rows: float = 1.0  # share of the rows drawn for a round
    columns: float = 1.0  # share of the columns drawn for a round
    level_columns: float = 1.0  # share of these drawn for a level
    seed: int = 42


@dataclass
class Tree:
    """Nodes in heap order: children of k are 2k + 1 and 2k + 2; ``feature`` is -1 at leaves. Right if bin > ``cut``."""
    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    gain: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> Tree:
        n = 2 ** (depth + 1) - 1
        return cls(np.full(n, -1, np.int32), np.zeros(n, np.uint8), np.zeros(n), np.zeros(n))

    def leaf(self, bins: np.ndarray, levels: int, rows: np.ndarray | None = None) -> np.ndarray:
        """The node each row (column of ``bins``; only ``rows``, if given) has reached after ``levels`` levels."""
        out = np.zeros(bins.shape[1] if rows is None else len(rows), dtype=np.int64)
        for first in range(0, len(out), RUN):
            node = out[first: first + RUN]
            each = np.arange(first, first + len(node)) if rows is None else rows[first: first + RUN]
            for _ in range(levels):
                f = self.feature[node]
                right = bins[np.maximum(f, 0), each] > self.cut[node]
                node[:] = np.where(f >= 0, 2 * node + 1 + right, node)
        return out

    def pack(self) -> str:
        used = np.flatnonzero((self.feature >= 0) | (self.value != 0))
        return json.dumps([len(self.feature), *[x[used].tolist() for x in (self.feature, self.cut, self.value, self.gain)], used.tolist()])

    @classmethod
    def unpack(cls, text: str) -> Tree:
        n, *cols, used = json.loads(text)
        tree = cls.empty(int(math.log2(n + 1)) - 1)
        for x, v in zip((tree.feature, tree.cut, tree.value, tree.gain), cols):
            x[used] = v
        return tree


@dataclass
class BoostedModel:
    """A fitted ensemble; it scores any frame that has its columns."""
    columns: list[str]
    edges: list[list[float]]
    trees: list[Tree]

    def matrix_bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, k]) for k, e in enumerate(self.edges)]).astype(np.uint8)

    def margins(self, x: np.ndarray) -> np.ndarray:
        bins, out = self.matrix_bins(x), np.zeros(len(x))
        for t in self.trees:
            out += t.value[t.leaf(bins, int(math.log2(len(t.feature) + 1)) - 1)]
        return out

    def p(self) -> Column:
        """Probability of class 1, a narrow expression."""
        width = len(self.columns)

        @F.arrow_udf("double")
        def score(rows: pa.Array) -> pa.Array:
            x = rows.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(rows), width)
            return pa.array(sigmoid(self.margins(x)))

        return score(F.array(*[F.col(f"`{c}`").cast("double") for c in self.columns]))

    def importances(self) -> dict[str, float]:
        """Share of the total gain by column."""
        out = np.zeros(len(self.columns))
        for t in self.trees:
            inner = t.feature >= 0
            np.add.at(out, t.feature[inner], t.gain[inner])
        return dict(zip(self.columns, (out / out.sum() if out.sum() > 0 else out).tolist()))

    def prefix(self, rounds: int) -> BoostedModel:
        return BoostedModel(self.columns, self.edges, self.trees[:rounds])

    def to_json(self) -> str:
        return json.dumps({"columns": self.columns, "edges": self.edges, "trees": [t.pack() for t in self.trees]})

    @classmethod
    def from_json(cls, text: str) -> BoostedModel:
        d = json.loads(text)
        return cls(d["columns"], d["edges"], [Tree.unpack(t) for t in d["trees"]])


def sigmoid(m: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * m))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def drawn(keys: np.ndarray, share: float, *at: int) -> np.ndarray:
    """Mask of the keys drawn with probability ``share``; the same wherever and whenever it is asked."""
    if share >= 1:
        return np.ones(len(keys), dtype=bool)
    h = keys.astype(np.uint64)
    for k in at:
        h = _mix(h * np.uint64(0x9E3779B97F4A7C15) + np.uint64(k + 1))
    return (h >> np.uint64(11)).astype(float) < share * 2.0 ** 53


# ---------------------------------------------------------------- the prepared table
@dataclass
class Prepared:
    """Binned rows in blocks, written once for any number of fits."""
    table: DataFrame
    columns: list[str]
    edges: list[list[float]]
    blocks: int

    def bins(self) -> np.ndarray:
        return np.array([len(e) + 1 for e in self.edges], dtype=np.int64)


BLOCK = "block long, n int, id binary, key binary, y binary, w binary, fold binary, bins binary, margin binary"


def quantile_edges(df: DataFrame, cols: list[str], bins: int) -> list[list[float]]:
    """Per column the upper ends of its bins but the last: different approximate quantiles below the largest value."""
    probs = [k / bins for k in range(bins + 1)]
    found = df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{k}") for k, c in enumerate(cols)]).approxQuantile(
        [f"c{k}" for k in range(len(cols))], probs, 0.25 / bins)
    return [sorted({x for x in q if x < max(q)}) for q in found]


def prepare(rows: DataFrame, cols: list[str], label: str, id_col: str, bins: int = 254, weight: str | None = None,
            fold: str | None = None, block_rows: int | None = None, edge_rows: DataFrame | None = None) -> Prepared:
    """Bins ``cols`` at quantiles of ``edge_rows`` (all ``rows``) and writes the blocks. ``fold`` (integer column) can
    later be held out. Unless ``block_rows`` are given, up to ``ONE_BLOCK`` cells are one block, and larger tables
    have blocks of equal size, ``BLOCK_ROWS`` rows at most, whose number is a multiple of the cores."""
    edges = quantile_edges(rows if edge_rows is None else edge_rows, cols, min(bins, 255))
    src = rows.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(id_col).alias("key"), F.col(label).cast("double").alias("y"),
                      (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("w"),
                      (F.col(fold).cast("int") if fold else F.lit(0)).alias("fold"),
                      F.array(*[F.col(f"`{c}`").cast("double") for c in cols]).alias("x"))
    width, model = len(cols), BoostedModel(cols, edges, [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        block, held, size = TaskContext.get().partitionId() << 32, [], 0

        def flush():
            parts = [np.concatenate([h[k] for h in held]) for k in range(5)]
            bins_of = np.concatenate([h[5] for h in held], axis=1)
            n = len(parts[0])
            data = [p.tobytes() for p in parts] + [bins_of.tobytes(), np.zeros(n).tobytes()]
            return pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([n], pa.int32()),
                                               *[pa.array([d], pa.binary()) for d in data]], names=[x.split()[0] for x in BLOCK.split(", ")])

        for batch in batches:
            while batch.num_rows:
                part, batch = batch.slice(0, block_rows - size), batch.slice(block_rows - size)
                x = part.column(5).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(part.num_rows, width)
                held.append([part.column(k).to_numpy(zero_copy_only=False).astype(t) for k, t in
                             enumerate((np.int64, np.int64, float, float, np.int32))] + [model.matrix_bins(x)])
                size += part.num_rows
                if size == block_rows:
                    yield flush()
                    block, held, size = block + 1, [], 0
        if held:
            yield flush()

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [r for batch in batches for r in batch.to_pylist()]
        if held:
            names = [x.split()[0] for x in BLOCK.split(", ")]
            bins_of = np.concatenate([np.frombuffer(r["bins"], np.uint8).reshape(width, r["n"]) for r in held], axis=1)
            data = [bins_of.tobytes() if c == "bins" else b"".join(r[c] for r in held) for c in names[2:]]
            yield pa.RecordBatch.from_arrays([pa.array([0], pa.int64()), pa.array([sum(r["n"] for r in held)], pa.int32()),
                                              *[pa.array([d], pa.binary()) for d in data]], names=names)

    n = rows.count()
    cores = rows.sparkSession.sparkContext.defaultParallelism
    if block_rows is None and BLOCK_ROWS * width < n * width <= ONE_BLOCK:  # binned in many tasks, then joined
        block_rows = BLOCK_ROWS
        parts = materialize(src.mapInArrow(run, BLOCK))
        table = materialize(parts.coalesce(1).mapInArrow(join, BLOCK))
        discard(parts)
        return Prepared(table, list(cols), edges, table.count())
    if block_rows is None and n * width > ONE_BLOCK:
        block_rows = BLOCK_ROWS
        src = src.repartition(math.ceil(n / (0.95 * block_rows) / cores) * cores, "key")
    else:  # partitions of less than a block are joined
        block_rows = block_rows or max(1, n)
        src = src.coalesce(max(1, math.ceil(n / block_rows)))
    table = materialize(src.mapInArrow(run, BLOCK))
    return Prepared(table, list(cols), edges, table.count())


class Block:
    """The arrays of one block."""

    def __init__(self, row: dict, width: int, margin: np.ndarray | float | None = None):
        self.n = row["n"]
        self.key = np.frombuffer(row["key"], np.int64).view(np.uint64)
        self.y, self.w = np.frombuffer(row["y"]), np.frombuffer(row["w"])
        self.fold = np.frombuffer(row["fold"], np.int32)
        self.bins = np.frombuffer(row["bins"], np.uint8).reshape(width, self.n)
        self.margin = np.frombuffer(row["margin"]).copy() if margin is None else margin
        self.codes = row.get("codes")  # by ``Packs``

    def held_out(self, fold: int | None) -> np.ndarray:
        return self.fold == fold if fold is not None else np.zeros(self.n, dtype=bool)

    def gradients(self, p: Params, at: int, fold: int | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows of round ``at`` and their gradients and hessians as whole numbers of 2^-24."""
        use = np.flatnonzero(~self.held_out(fold) & (self.w > 0) & drawn(self.key, p.rows, p.seed, at))
        q, w = sigmoid(self.margin[use]), self.w[use]
        return use, np.rint((q - self.y[use]) * w * _UNIT), np.rint(np.maximum(q * (1 - q), 1e-16) * w * _UNIT)

    def losses(self, fold: int | None) -> list[float]:
        """Sums of weighted loss and weight over the training rows, of loss and rows over the held-out ones."""
        loss = np.logaddexp(0, np.where(self.y > 0.5, -self.margin, self.margin))
        out = self.held_out(fold)
        return [float((loss * self.w)[~out].sum()), float(self.w[~out].sum()), float(loss[out].sum()), float(out.sum())]


# ---------------------------------------------------------------- growing a tree
@dataclass
class Level:
    """Nodes to split, the columns that may split them, and whether these are all nodes of their level."""
    nodes: np.ndarray
    columns: np.ndarray
    whole: bool = True


class Packs:
    """Columns of few bins share a code of at most 256 values, so that one count by code serves them all. The sums of a
    column's bins are sums over codes: whole numbers, so nothing is lost."""

    def __init__(self, bins: np.ndarray):
        self.columns: list[list[int]] = []
        self.same = np.arange(len(bins))
        size = 257
        for c in np.argsort(bins, kind="stable").tolist():
            if size * bins[c] > 256:
                self.columns.append([])
                size = 1
            self.columns[-1].append(c)
            size *= int(bins[c])
        self.sizes = [int(np.prod(bins[p])) for p in self.columns]
        # codes by bins of all columns of the pack
        self.members = []
        for p, n in zip(self.columns, self.sizes):
            digits = np.unravel_index(np.arange(n), bins[p])
            self.members.append([(np.arange(bins[c]) == d[:, None]).astype(float) for c, d in zip(p, digits)])

    def codes(self, bins: np.ndarray) -> np.ndarray:
        out = np.zeros((len(self.columns), bins.shape[1]), np.uint8)
        for k, (first, *others) in enumerate(self.columns):
            out[k] = bins[first]
            for c, m in zip(others, self.members[k][1:]):
                out[k] = out[k] * m.shape[1] + bins[c]
        return out


class BlockPacks(Packs):
    """Packs of a single block, by the values that its rows hold: a column joins a code if there are at most 256
    different pairs of both. So columns that follow from others (logs, squares, one-hot columns) need no count of their
    own. ``same`` holds for each column the first one with equal bins in all rows."""

    def __init__(self, bins: np.ndarray, rows: np.ndarray):
        first: dict[tuple[int, bytes], int] = {}
        self.same = np.array([first.setdefault((int(bins[c]), hashlib.blake2b(r.tobytes()).digest()), c) for c, r in enumerate(rows)])
        self.columns, self.sizes, self.held, digits = [], [], [], []
        some = rows[:, :: max(1, rows.shape[1] // 2048)]
        shown, apart = np.zeros((0, some.shape[1]), np.uint16), []  # the codes of some rows, how many are different
        for c in sorted(first.values(), key=lambda c: (-bins[c], c)):
            # codes from which the column follows in some rows, then those with fewest pairs
            found = np.sort(shown * np.uint16(256) + some[c], axis=1, kind="stable")
            pairs = 1 + (np.diff(found, axis=1) > 0).sum(axis=1)
            order = np.lexsort((pairs, pairs > np.array(apart, dtype=int)))
            for k in [k for k in order.tolist() if pairs[k] <= 256][:4]:
                pair = self.held[k].astype(np.uint16) * np.uint16(256) + rows[c]
                seen = np.bincount(pair, minlength=1 << 16) > 0
                if seen.sum() <= 256:
                    values = np.flatnonzero(seen)
                    code = (np.cumsum(seen) - 1).clip(0).astype(np.uint8)
                    self.held[k], shown[k] = code[pair], code[shown[k] * np.uint16(256) + some[c]]
                    digits[k] = [d[values >> 8] for d in digits[k]] + [values & 255]
                    self.columns[k].append(c)
                    self.sizes[k], apart[k] = len(values), pairs[k]
                    break
            else:
                self.columns.append([c])
                self.sizes.append(int(bins[c]))
                self.held.append(rows[c])
                digits.append([np.arange(bins[c])])
                shown = np.concatenate([shown, some[c][None].astype(np.uint16)])
                apart.append(len(np.unique(some[c])))
        self.members = [[(np.arange(bins[c]) == d[:, None]).astype(float) for c, d in zip(p, ds)] for p, ds in zip(self.columns, digits)]

    def codes(self, bins: np.ndarray) -> np.ndarray:
        return np.stack(self.held) if self.held else np.zeros((0, bins.shape[1]), np.uint8)

    def different(self, columns: np.ndarray) -> np.ndarray:
        """The first of ``columns`` with equal bins: the others have the same splits and never come before it."""
        return columns[np.sort(np.unique(self.same[columns], return_index=True)[1])]


def node_sums(rows_slot: np.ndarray, block: Block, packs: Packs, rows: np.ndarray, columns: np.ndarray, g, h, slots: int, starts: np.ndarray,
              counts: bool) -> np.ndarray:
    """Sums (gradient, hessian, rows) over the ``rows`` of the block for each slot and bin of ``columns``, side by side in
    one array."""
    width, values = int(starts[-1]), (g, h, None)[: 3 if counts else 2]
    if len(rows_slot) * len(columns) <= FEW_CELLS:  # few rows: all columns in one go
        at = (rows_slot * width)[None, :] + (block.bins[np.ix_(columns, rows)] + starts[:-1, None])
        many = [None if v is None else np.broadcast_to(v, at.shape).ravel() for v in values]
        return np.stack([np.bincount(at.ravel(), v, slots * width).reshape(slots, width) for v in many])
    # a run of rows at a time: its slots, gradients and codes stay in the processor's cache over all packs
    place = {int(c): k for k, c in enumerate(packs.same[columns])}
    wanted = [[(place[c], m) for c, m in zip(pack, members) if c in place] for pack, members in zip(packs.columns, packs.members)]
    some, every = [k for k, w in enumerate(wanted) if w], len(rows) == block.n
    sums = np.zeros((len(values), len(some), slots * 256))
    for first in range(0, len(rows), RUN):
        run = slice(first, first + RUN)
        base, parts = rows_slot[run] * 256, [v if v is None else v[run] for v in values]
        at = np.empty_like(base)
        for i, k in enumerate(some):
            np.add(base, block.codes[k][run] if every else block.codes[k].take(rows[run]), out=at)
            for j, v in enumerate(parts):
                sums[j, i] += np.bincount(at, v, slots * 256)
    out = np.zeros((len(values), slots, width))
    for i, k in enumerate(some):
        of = sums[:, i].reshape(len(values), slots, 256)[:, :, : packs.sizes[k]]
        for c, m in wanted[k]:
            out[:, :, starts[c]: starts[c + 1]] = of if len(packs.columns[k]) == 1 else of @ m
    return out


def pair_sums(before: tuple | None, nodes: np.ndarray, columns: np.ndarray, slot: np.ndarray, sums_of) -> np.ndarray:
    """Sums of the ``nodes`` of a level. Where those of their parents are known (``before``: nodes, columns, sums), only
    the child with fewer rows is added up, its sibling is the rest: whole numbers, so nothing is lost.
    ``sums_of(slot, slots)`` adds up rows by slot."""
    if before is None or len(nodes) < 2 or not np.array_equal(before[1], columns):
        return sums_of(slot, len(nodes))
    rows = np.bincount(slot[slot >= 0], minlength=len(nodes))
    small = np.arange(0, len(nodes), 2) + (rows[1::2] < rows[::2])  # siblings follow each other
    place = np.full(len(nodes) + 1, -1)  # the last is for rows in no slot
    place[small] = np.arange(len(small))
    own = sums_of(place[slot], len(small))
    parents = before[2][:, np.searchsorted(before[0], (nodes[::2] - 1) // 2)]
    out = np.empty((own.shape[0], len(nodes), own.shape[2]))
    out[:, small] = own
    out[:, small ^ 1] = parents - own
    return out


class Split(NamedTuple):
    """The best split of a node (gain 0: none) and the sums of its left child and of the node itself."""
    gain: float = 0.0
    feature: int = 0
    cut: int = 0
    left_g: float = 0.0
    left_h: float = 0.0
    g: float = 0.0
    h: float = 0.0


def best_splits(sums: np.ndarray, columns: np.ndarray, starts: np.ndarray, p: Params) -> list[Split]:
    """Per slot the best split of these columns; as many slots at a time as the processor's cache has room for."""
    step = max(1, RUN // sums.shape[2])
    return [s for k in range(0, sums.shape[1], step) for s in _best_splits(sums[:, k: k + step], columns, starts, p)]


def _best_splits(sums: np.ndarray, columns: np.ndarray, starts: np.ndarray, p: Params) -> list[Split]:
    left = np.cumsum(sums, axis=2)
    left[:2] /= _UNIT  # a power of two
    sizes = np.diff(starts)
    before = left[:, :, starts[1:-1] - 1]
    left[:, :, starts[1]:] -= np.repeat(before, sizes[1:], axis=2)
    total = left[:, :, starts[1:] - 1]  # the sums of the node, once for each column
    right = np.repeat(total, sizes, axis=2)
    right -= left

    def worth(g, h):
        g = np.sign(g) * np.maximum(np.abs(g) - p.l1, 0) if p.l1 else g
        return g * g / (h + (p.l2 + 1e-12))

    gain = worth(left[0], left[1])
    gain += worth(right[0], right[1])
    gain -= np.repeat(worth(total[0], total[1]), sizes, axis=1)
    least = max(p.min_hessian, 1e-9)
    ok = (left[1] >= least) & (right[1] >= least)
    if len(sums) > 2:
        ok &= (left[2] >= p.min_rows) & (right[2] >= p.min_rows)
    gain = np.where(ok, 0.5 * gain - p.min_gain, 0.0)
    at = gain.argmax(axis=1)
    col = np.searchsorted(starts, at, "right") - 1
    return [Split(max(float(gain[s, k]), 0.0), int(columns[c]), int(k - starts[c]), *(float(x[s, i]) * _UNIT for x, i in (
        (left[0], k), (left[1], k), (total[0], c), (total[1], c)))) for s, (k, c) in enumerate(zip(at, col))]


def leaf_value(g, h, p: Params):
    g, h = g / _UNIT, h / _UNIT
    g = np.sign(g) * np.maximum(np.abs(g) - p.l1, 0)
    return -p.rate * g / (h + p.l2 + 1e-12)


def starts_of(bins: np.ndarray, columns: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(bins[columns])]).astype(np.int64)


def grow(p: Params, at: int, bins: np.ndarray, cells: int) -> Generator[tuple[Tree, int, Level], list[Split], Tree]:
    """One tree. Asks for the best split of each node of a level, ``cells`` sums at a time; is sent the splits. A level
    without columns asks for the sums of the root alone."""
    tree, names = Tree.empty(p.depth), np.arange(len(bins), dtype=np.uint64)
    g, h = np.zeros(len(tree.feature)), np.zeros(len(tree.feature))
    usable = np.flatnonzero(bins > 1)
    mine = usable[drawn(names[usable], p.columns, p.seed, at, 7)]
    nodes = np.array([0])
    depth = 0
    while depth < p.depth and len(nodes) and len(mine):
        cols = mine[drawn(names[mine], p.level_columns, p.seed, at, 11, depth)]
        if not len(cols):
            cols = mine
        width = int(bins[cols].sum())
        step = max(1, cells // width)
        found = []
        for k in range(0, len(nodes), step):
            found += yield tree, depth, Level(nodes[k: k + step], cols, step >= len(nodes))
        nxt = []
        for node, s in zip(nodes, found):
            g[node], h[node] = s.g, s.h
            if s.gain > 0:
                tree.feature[node], tree.cut[node], tree.gain[node] = s.feature, s.cut, s.gain
                g[2 * node + 1: 2 * node + 3] = s.left_g, s.g - s.left_g
                h[2 * node + 1: 2 * node + 3] = s.left_h, s.h - s.left_h
                nxt += [2 * node + 1, 2 * node + 2]
        nodes = np.array(nxt, dtype=np.int64)
        depth += 1
    if not depth:  # nothing was asked yet
        [root] = yield tree, 0, Level(nodes, mine[:0])
        g[0], h[0] = root.g, root.h
    leaves = tree.feature < 0
    tree.value[leaves] = leaf_value(g[leaves], h[leaves], p)
    return tree


def slots_of(node: np.ndarray, nodes: np.ndarray, size: int) -> np.ndarray:
    """Slot of each row's node among ``nodes``, -1 for others."""
    slot = np.full(size, -1, dtype=np.int64)
    slot[nodes] = np.arange(len(nodes))
    return slot[node]


def advance(block: Block, p: Params, bins: np.ndarray, first: int, rounds: int, fold: int | None,
            after: Callable[[Block], None]) -> list[Tree]:
    """``rounds`` further rounds over the only block; ``after`` sees the block after each."""
    trees, packs = [], BlockPacks(bins, block.bins)
    block.codes = packs.codes(block.bins)
    for at in range(first, first + rounds):
        use, g, h = block.gradients(p, at, fold)
        now = {"depth": 0, "node": np.zeros(len(use), dtype=np.int64)}

        def split(tree, depth, level, use=use, g=g, h=h, now=now):
            if not len(level.columns):
                return [Split(g=float(g.sum()), h=float(h.sum()))]
            if now["depth"] < depth:  # one level further
                node = now["node"]
                f = tree.feature[node]
                right = block.bins[np.maximum(f, 0), use] > tree.cut[node]
                now["depth"], now["node"] = depth, np.where(f >= 0, 2 * node + 1 + right, node)
            columns = packs.different(level.columns)
            starts = starts_of(bins, columns)
            slot = slots_of(now["node"], level.nodes, len(tree.feature))

            def sums_of(slot, slots):
                rows = np.flatnonzero(slot >= 0)
                return node_sums(slot[rows], block, packs, use[rows], columns, g[rows], h[rows], slots, starts, p.min_rows > 1)

            sums = pair_sums(now.get("sums"), level.nodes, columns, slot, sums_of)
            # kept for the next level if it is the whole level
            now["sums"] = (level.nodes, columns, sums) if level.whole else None
            return best_splits(sums, columns, starts, p)

        tree = grown(grow(p, at, bins, CELLS), split)
        trees.append(tree)
        node, f = now["node"], tree.feature[now["node"]]  # the rows of the round are one level above their leaf at most
        block.margin[use] += tree.value[np.where(f >= 0, 2 * node + 1 + (block.bins[np.maximum(f, 0), use] > tree.cut[node]), node)]
        rest = np.ones(block.n, dtype=bool)
        rest[use] = False
        rest = np.flatnonzero(rest)
        block.margin[rest] += tree.value[tree.leaf(block.bins, p.depth, rest)]
        after(block)
    return trees


def grown(tree: Generator[tuple[Tree, int, Level], list[Split], Tree], split: Callable[[Tree, int, Level], list[Split]]) -> Tree:
    found = None
    while True:
        try:
            found = split(*tree.send(found))
        except StopIteration as e:
            return e.value


# ---------------------------------------------------------------- Spark steps
STATE = BLOCK + ", trees array<string>, curve array<array<double>>, held_y array<double>, scores array<array<double>>"


def _blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[dict, Block]]:
    for batch in batches:
        for row in batch.to_pylist():
            yield row, Block(row, width)


def _state(row: dict, block: Block, trees: list[Tree], curve: list, held_y, scores) -> pa.RecordBatch:
    names = [x.split()[0] for x in BLOCK.split(", ")]
    cols = {**{c: row[c] for c in names}, "margin": block.margin.tobytes(), "trees": [t.pack() for t in trees], "curve": curve,
            "held_y": held_y, "scores": scores}
    types = [pa.int64(), pa.int32(), *[pa.binary()] * 7, pa.list_(pa.string()), pa.list_(pa.list_(pa.float64())),
             pa.list_(pa.float64()), pa.list_(pa.list_(pa.float64()))]
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(cols.values(), types)], names=list(cols))


def _recorder(fold: int | None, scores_too: bool):
    curve, scores = [], []

    def after(block: Block) -> None:
        curve.append(block.losses(fold))
        if scores_too:
            scores.append(block.margin[block.held_out(fold)])
    return curve, scores, after


def step_in_task(table: DataFrame, p: Params, bins: np.ndarray, first: int, rounds: int, fold: int | None, scores_too: bool) -> DataFrame:
    """The next rounds of a table of one block, in the task's JVM (``jvm_steps``); without one, by ``advance``."""
    spec = [first, rounds, fold, int(scores_too), *(float(x) if isinstance(x, float) else int(x) for x in (
        p.rate, p.depth, p.min_rows, p.min_hessian, p.l1, p.l2, p.min_gain, p.rows, p.columns, p.level_columns, p.seed)), *bins.tolist()]
    column = jvm_steps.column(table.sparkSession, spec)
    if column is not None:
        names = [x.split()[0] for x in BLOCK.split(", ")]
        written = materialize(table.select(*[c for c in names if c != "margin"], column.alias("s")))
        state = written.select(*[F.col("s.margin") if c == "margin" else c for c in names], "s.trees", "s.curve", "s.held_y", "s.scores")
        state._materialized_path = written._materialized_path
        return state

    def run(batches):
        for row, block in _blocks(batches, len(bins)):
            curve, scores, after = _recorder(fold, scores_too)
            trees = advance(block, p, bins, first, rounds, fold, after)
            yield _state(row, block, trees, curve, block.y[block.held_out(fold)] if scores_too else None, scores)

    return materialize(table.mapInArrow(run, STATE))


def column_groups(columns: np.ndarray, bins: np.ndarray) -> list[np.ndarray]:
    """The columns in groups of about ``GROUP_BINS`` bins, one reducer each."""
    upto = np.cumsum(bins[columns])
    return np.split(columns, np.flatnonzero(np.diff(upto // GROUP_BINS)) + 1)


@dataclass
class Ask:
    """The level a job has to split for one fit."""
    params: Params
    fold: int | None
    at: int
    tree: Tree
    depth: int
    level: Level
    groups: list[np.ndarray]
    starts: list[np.ndarray]


Held = RDD  # of (row of a block without its margin, margins by fit, loss sums by fit and round, scores by fit)


class Together:
    """Fits over one table of several blocks, which add their rounds side by side: a job for each level of their trees.

    Within a step the blocks and their margins are persisted (memory, then disk); the margins are renewed after
    ``CARRY`` rounds and written at the end of the step."""

    def __init__(self, fits: list[Booster]):
        self.fits, self.data, self.table = fits, fits[0].data, None
        self.bins = self.data.bins()
        self.packs = Packs(self.bins)
        for slot, f in enumerate(fits):
            f.group, f.slot = self, slot

    def load(self) -> Held:
        source, n = self.data.table if self.table is None else self.table, len(self.fits)
        place = {r.block: k for k, r in enumerate(self.data.table.select("block").orderBy("block").collect())}
        self.parts = min(len(place), source.sparkSession.sparkContext.defaultParallelism)
        fresh, width, packs = self.table is None, len(self.bins), self.packs

        def held(r):
            row = {c: r[c] if c in ("block", "n") else bytes(r[c]) for c in r.__fields__ if c not in ("margin", "margins", "held_y", "scores")}
            row["codes"] = packs.codes(Block(row, width, 0).bins)
            return place[r.block], (row, [np.frombuffer(r.margin)] * n if fresh else [np.frombuffer(m) for m in r.margins], [[] for _ in range(n)],
                                    [[] for _ in range(n)])

        return source.rdd.map(held).partitionBy(self.parts, int).values().persist(StorageLevel.MEMORY_AND_DISK)

    def run(self, going: list[Booster], rounds: int) -> None:
        """Adds ``rounds`` rounds to the fits ``going``, all of which have equally many."""
        held, pending = self.load(), {f.slot: [] for f in going}
        for k in range(rounds):
            for slot, tree in self.trees(held, going, pending).items():
                pending[slot].append(tree)
            if len(next(iter(pending.values()))) == CARRY or k == rounds - 1:
                held = self.carry(held, going, pending)
                for f in going:
                    f.trees += pending[f.slot]
                    pending[f.slot] = []
        self.write(held, going)
        held.unpersist()

    def trees(self, held: Held, going: list[Booster], pending: dict[int, list[Tree]]) -> dict[int, Tree]:
        """The next tree of every fit."""
        at = {f.slot: len(f.trees) + len(pending[f.slot]) for f in going}
        growing = {f.slot: grow(f.params, at[f.slot], self.bins, max(1, CELLS // len(going))) for f in going}
        asked = {slot: next(tree) for slot, tree in growing.items()}
        done = {}
        while asked:
            asks = {}
            for slot, (tree, depth, level) in asked.items():
                groups = column_groups(level.columns, self.bins) if len(level.columns) else []
                asks[slot] = Ask(self.fits[slot].params, self.fits[slot].held_out, at[slot], tree, depth, level, groups,
                                 [starts_of(self.bins, g) for g in groups])
            found, asked = self.splits(held, asks, pending), {}
            for slot in asks:
                try:
                    asked[slot] = growing[slot].send(found[slot])
                except StopIteration as e:
                    done[slot] = e.value
        return done

    def splits(self, held: Held, asks: dict[int, Ask], pending: dict[int, list[Tree]]) -> dict[int, list[Split]]:
        """The best split of every node asked for."""
        width, packs = len(self.bins), self.packs
        places = {k: i for i, k in enumerate((slot, j) for slot, a in asks.items() for j in range(max(1, len(a.groups))))}

        def add_up(items):
            out: dict[int, np.ndarray] = {}
            for row, margins, _, _ in items:
                block = Block(row, width, 0)
                for slot, a in asks.items():
                    block.margin = advanced(block, margins[slot], pending[slot])
                    use, g, h = block.gradients(a.params, a.at, a.fold)
                    if a.groups:
                        place = slots_of(a.tree.leaf(block.bins, a.depth)[use], a.level.nodes, len(a.tree.feature))
                        rows = np.flatnonzero(place >= 0)
                        place, use, g, h = place[rows], use[rows], g[rows], h[rows]
                        parts = [node_sums(place, block, packs, use, c, g, h, len(a.level.nodes), s, a.params.min_rows > 1)
                                 for c, s in zip(a.groups, a.starts)]
                    else:
                        parts = [np.array([g.sum(), h.sum()])]
                    for j, v in enumerate(parts):
                        k = slot, j
                        out[k] = out[k] + v if k in out else v
            return iter(out.items())

        def judge(items):
            sums: dict[tuple[int, int], np.ndarray] = {}
            for k, v in items:
                sums[k] = sums[k] + v if k in sums else v
            for (slot, j), v in sums.items():
                a = asks[slot]
                yield slot, best_splits(v, a.groups[j], a.starts[j], a.params) if a.groups else [Split(g=float(v[0]), h=float(v[1]))]

        # added up within a task, then by fit and column group
        met = held.mapPartitions(add_up).partitionBy(min(len(places), self.parts), places.__getitem__)
        found: dict[int, list[Split]] = {}
        for slot, splits in met.mapPartitions(judge).collect():
            # the largest gain, the first column of equal ones: as if all columns were in one group
            found[slot] = [min(x, y, key=lambda s: (-s.gain, s.feature)) for x, y in zip(found[slot], splits)] if slot in found else splits
        met._jrdd.rdd().cleanShuffleDependencies(False)
        return found

    def carry(self, held: Held, going: list[Booster], pending: dict[int, list[Tree]]) -> Held:
        """The blocks with the margins after the pending trees; the losses of their rounds go to the curves."""
        width, slots = len(self.bins), [(f.slot, f.held_out, f.scores_too(), pending[f.slot]) for f in going]

        def further(item):
            row, margins, curves, scores = item
            block, margins, curves, scores = Block(row, width, 0), list(margins), [[] for _ in margins], list(scores)
            for slot, fold, scores_too, trees in slots:
                block.margin = margins[slot].copy()
                for t in trees:
                    block.margin += t.value[t.leaf(block.bins, int(math.log2(len(t.feature) + 1)) - 1)]
                    curves[slot].append(block.losses(fold))
                    if scores_too:
                        scores[slot] = [*scores[slot], block.margin[block.held_out(fold)]]
                margins[slot] = block.margin
            return row, margins, curves, scores

        new = held.map(further).persist(StorageLevel.MEMORY_AND_DISK)
        sums = new.map(lambda item: [np.array(c) for c in item[2]]).reduce(lambda a, b: [x + y for x, y in zip(a, b)])
        for f in going:
            f.add_losses(sums[f.slot])
        held.unpersist()
        return new

    def write(self, held: Held, going: list[Booster]) -> None:
        old, width = self.table, len(self.bins)
        scored = [(f.slot, f.held_out) for f in going if f.scores_too()]

        def row(item):
            kept, margins, _, scores = item
            block, shown = Block(kept, width, 0), dict(scored)
            y = [block.y[block.held_out(shown[k])].tolist() if k in shown else [] for k in range(len(margins))]
            return (*[v for c, v in kept.items() if c != "codes"], [m.tobytes() for m in margins], y, [[s.tolist() for s in each] if k in shown else [] for k, each in enumerate(scores)])

        spark = self.data.table.sparkSession
        schema = BLOCK.replace(", margin binary", "") + ", margins array<binary>, held_y array<array<double>>, scores array<array<array<double>>>"
        self.table = materialize(spark.createDataFrame(held.map(row), schema, verifySchema=False))
        for f in self.fits:
            k = f.slot
            f.state = self.table.select(*[c for c in self.table.columns if c not in ("margins", "held_y", "scores")], F.col("margins")[k].alias("margin"),
                                        F.col("held_y")[k].alias("held_y"), F.col("scores")[k].alias("scores"))
        if old is not None:
            discard(old)

    def close(self) -> None:
        if self.table is not None:
            discard(self.table)
            self.table = None


def advanced(block: Block, margin: np.ndarray, trees: list[Tree]) -> np.ndarray:
    for t in trees:
        margin = margin + t.value[t.leaf(block.bins, int(math.log2(len(t.feature) + 1)) - 1)]
    return margin


# ---------------------------------------------------------------- the loop
@dataclass
class Curve:
    """By round: loss on the training rows, loss and (if watched) AUC on the held-out rows."""
    learn: list[float] = field(default_factory=list)
    test: list[float] = field(default_factory=list)
    auc: list[float] = field(default_factory=list)

    def watched(self, watch: str) -> list[float]:
        return self.auc if watch == "auc" else self.test


def best_round(curve: list[float], watch: str) -> int:
    """First best round (0-based) of a validation curve."""
    return min(range(len(curve)), key=lambda k: (-curve[k] if watch == "auc" else curve[k], k))


def patience_ends(curve: list[float], watch: str, patience: int) -> int | None:
    """Rounds after which the curve has not improved for ``patience`` rounds."""
    best, at = None, 0
    for k, v in enumerate(curve):
        v = -v if watch == "auc" else v
        if best is None or v < best:
            best, at = v, k
        elif k - at >= patience:
            return k + 1
    return None


def round_scores(state: DataFrame, first: int) -> DataFrame:
    """(round, score, y): a row per round and held-out row, from the stored scores of a step."""
    each = state.select("held_y", F.posexplode("scores").alias("k", "s"))
    return each.select((F.col("k") + first).alias("round"), F.inline(F.arrays_zip(F.col("s").alias("score"), F.col("held_y").alias("y"))))


class Booster:
    """A fit that can go on: ``run(n)`` adds rounds to what is stored."""

    def __init__(self, data: Prepared, params: Params, held_out: int | None = None, watch: str = "log_loss"):
        self.data, self.params, self.held_out, self.watch = data, params, held_out, watch
        self.state, self.trees, self.curve, self.stopped = data.table, [], Curve(), False
        self.group, self.slot = None, 0

    def scores_too(self) -> bool:
        return self.watch == "auc" and self.held_out is not None

    def add_losses(self, sums: np.ndarray) -> None:
        """Further rounds of the curve, from a row of ``Block.losses`` for each."""
        for learn, weight, test, rows in sums:
            self.curve.learn.append(float(learn / weight) if weight else math.nan)
            self.curve.test.append(float(test / rows) if rows else math.nan)

    def add_aucs(self, first: int) -> None:
        if self.scores_too():
            found = {r["round"]: r["auc"] for r in auc_by_group(round_scores(self.state, first), "round", "score", "y").collect()}
            self.curve.auc += [found.get(k) if found.get(k) is not None else 0.5 for k in range(first, len(self.trees))]

    def run(self, rounds: int, at_once: int = STEP) -> None:
        """Adds ``rounds`` rounds, ``at_once`` in a step."""
        bins = self.data.bins()
        while rounds > 0:
            n, first = min(rounds, at_once), len(self.trees)
            rounds -= n
            if self.data.blocks > 1:
                (self.group or Together([self])).run([self], n)
                self.add_aucs(first)
                continue
            old = self.state
            self.state = step_in_task(old.select(*[x.split()[0] for x in BLOCK.split(", ")]), self.params, bins, first, n, self.held_out, self.scores_too())
            self.trees += [Tree.unpack(t) for r in self.state.select("trees").collect() for t in r.trees]
            sums = {r["k"]: r for r in self.state.select(F.posexplode("curve").alias("k", "c")).groupBy("k").agg(
                *[F.sum(F.col("c")[j]).alias(f"s{j}") for j in range(4)]).collect()}
            self.add_losses(np.array([[sums[k][f"s{j}"] for j in range(4)] if k in sums else [0.0] * 4 for k in range(n)]))
            self.add_aucs(first)
            if old is not self.data.table:
                discard(old)

    def run_until(self, budget: int, patience: int, deadline: float | None = None) -> int:
        """Rounds are added until the watched value has not improved for ``patience`` rounds or ``budget`` is used up
        (or, looked at after each step, the clock has passed ``deadline``: then ``stopped`` is set).
        Returns the number of the best prefix's rounds; rounds after the end are cut from trees and curves."""
        end = None
        while end is None and len(self.trees) < budget:
            if deadline is not None and time.time() > deadline:
                self.stopped = True
                break
            step = self.next_step()
            self.run(min(step, budget - len(self.trees)), step)
            end = patience_ends(self.curve.watched(self.watch), self.watch, patience)
        return self.cut(end)

    def next_step(self) -> int:
        """Steps grow with the rounds there are; not so where each stores the scores of its rounds."""
        return STEP if self.watch == "auc" else max(STEP, len(self.trees) // 4)

    def cut(self, end: int | None) -> int:
        """Cuts the rounds after ``end``; the number of the best prefix's rounds."""
        end = end if end is not None else len(self.trees)
        self.trees = self.trees[:end]
        self.curve = Curve(self.curve.learn[:end], self.curve.test[:end], self.curve.auc[:end])
        return best_round(self.curve.watched(self.watch), self.watch) + 1 if end else 0

    def model(self, rounds: int | None = None) -> BoostedModel:
        return BoostedModel(self.data.columns, self.data.edges, self.trees[:rounds])

    def held_out_scores(self) -> DataFrame:
        """(id, y, p) of the held-out rows from their stored margins, after the rounds that have run."""
        width, fold = len(self.data.columns), self.held_out

        def run(batches):
            for row, block in _blocks(batches, width):
                out = block.held_out(fold)
                ids = np.frombuffer(row["id"], np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(ids[out]), pa.array(block.y[out]), pa.array(sigmoid(block.margin[out]))],
                                                 names=["id", "y", "p"])

        return self.state.select(*[x.split()[0] for x in BLOCK.split(", ")]).mapInArrow(run, "id long, y double, p double")

    def close(self) -> None:
        """Deletes the stored margins."""
        if self.group is not None:
            self.group.close()
        elif self.state is not self.data.table:
            discard(self.state)


def finish(fits: list[Booster], patience: int | None = None) -> list[int | None]:
    """All rounds of fits over one table of several blocks, side by side; with ``patience`` as ``run_until`` ends them.
    Returns the number of the best prefix's rounds of each (None without patience)."""
    group, going, best = Together(fits), list(fits), {}
    while going:
        least = min(f.params.rounds - len(f.trees) for f in going)
        n, first = min(least, *[f.next_step() for f in going]), len(going[0].trees)
        if n:
            group.run(going, n)
        on = []
        for f in going:
            f.add_aucs(first)
            end = patience_ends(f.curve.watched(f.watch), f.watch, patience) if patience is not None else None
            if end is None and len(f.trees) < f.params.rounds:
                on.append(f)
            else:
                best[f.slot] = f.cut(end) if patience is not None else None
        going = on
    group.close()
    return [best[f.slot] for f in fits]


def fit_jobs(fits: dict, patience: int | None = None) -> dict[object, Callable[[], dict]]:
    """Jobs that may run at the same time and bring fits over one table to their end: name -> (fit, rounds of its best
    prefix). Those over one block are a job each, those over several blocks share their jobs."""
    if not fits:
        return {}

    def alone(name, fit):
        best = fit.run_until(fit.params.rounds, patience) if patience is not None else fit.run(fit.params.rounds)
        fit.close()
        return {name: (fit, best)}

    if next(iter(fits.values())).data.blocks <= 1:
        return {name: (lambda name=name, fit=fit: alone(name, fit)) for name, fit in fits.items()}
    return {"together": lambda: {name: (fits[name], best) for name, best in zip(fits, finish(list(fits.values()), patience))}}
