"""Phrase collocation mining (operator 13): HAT-trie counting, runs merged by prefix.

Texts are lower-cased (A-Z), split at ``.,;:!?`` and line ends into pieces and these into
words. Phrases of 1 to ``LONGEST`` words inside pieces are counted for each language:

* A task counts in a HAT-trie: a shallow trie over word ids whose leaves are hash
  containers (phrase to count), at first shared by blocks of first words; one that
  grows over ``BURST`` entries bursts into a trie node with a container for each
  first, then second word. When all tries of the task hold more than ``MOST_ENTRIES`` entries, the largest subtrees are
  spilled whole, as sorted runs, and what is left at the end follows.
* Runs are dealt by ranges of (language, phrase), that is by prefix: Spark samples the
  runs, so the ranges of a common prefix are as large as any others. A range is
  merged by one task; a phrase has one row for each run at most.
* Lengths go level by level: a phrase can be found ``MIN_COUNT`` times only if the two
  phrases one word shorter are. Frequent phrases of a level set a Bloom filter of a
  fixed size; the next level counts only what passes. A false positive costs a row
  and changes no result.

Then everything is joins over frequent phrases: a row for each cut finds the counts of
its two parts, the lowest score stays, phrases that a longer one covers go, and the
first ``TOP`` of a language are ranked (the limit is the feature).

Bounds: entries and words of a task's tries, filters of 32 MB, one range of runs. Counts
are exact; scores are computed with decimals of 38 digits.

Defined cases: a null text is empty, a null language is ``und``; repeated rows count
each; ties end at the phrase, in byte order; an empty table gives no rows; only the
language and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from responsekit.llm import bits as B
from responsekit.llm.common import cut_batch, mix64, read
from responsekit.session import discard, materialize

MIN_COUNT, LONGEST, TOP, COVER = 30, 4, 2000, 80
NO_LANG = "und"
#: First words that share a container, its entries before it bursts, the deepest node, entries and different words
#: a task holds, rows of a batch it sends, bytes of text that are sorted before they go into the tries.
SHARED, BURST, DEEPEST, MOST_ENTRIES, MOST_WORDS, ROWS, PIECE = 256, 16_384, 2, 1_000_000, 500_000, 1 << 16, 8 << 20
_BREAKS = b".,;:!?\n\x0b\x0c\r"
_CLEAN = bytes.maketrans(_BREAKS + b"\tABCDEFGHIJKLMNOPQRSTUVWXYZ", b"\n" * len(_BREAKS) + b" abcdefghijklmnopqrstuvwxyz")
_TIMES = np.uint64(0x9E3779B97F4A7C15)
ID = 31
_LOW = (1 << ID) - 1
RUNS = "lang string, size int, phrase string, n long"


def split_words(texts: list[str | None]) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """The words of some texts: their places in the array of different words (in order of first use), that array, and
    the number of the piece each lies in."""
    data = "\n".join([t or "" for t in texts]).encode("utf-8", "surrogatepass").translate(_CLEAN)
    data = np.frombuffer(data, np.uint8)
    ends = data == 10  # of pieces
    inside = ~(ends | (data == 32))
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))  # starts and ends of words by turns
    starts = edges[::2]
    offsets = np.concatenate([[0], np.cumsum(edges[1::2] - starts)])
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])]).dictionary_encode()
    return words.indices.to_numpy(), words.dictionary, np.searchsorted(np.flatnonzero(ends), starts)


class Words(dict):
    """Word to number, in order of first use, with the words and their hashes."""

    def __init__(self):
        self.names, self._hashes = [], np.zeros(0, np.uint64)

    def __missing__(self, word: bytes) -> int:
        self[word] = k = len(self.names)
        self.names.append(word)
        return k

    def hashes(self) -> np.ndarray:
        new = self.names[len(self._hashes):]
        self._hashes = np.concatenate([self._hashes, word_hashes(new)])
        return self._hashes


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def phrase_hash(lang: str, columns: list[np.ndarray]) -> np.ndarray:
    """Hash of phrases given by their words' hashes, one array for each position."""
    h = np.full(len(columns[0]), np.uint64(xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass"))))
    for c in columns:
        h = mix64(h * _TIMES + c)
    return h


class Node:
    """A trie node: its children are containers or nodes, by the first ``depth`` words of a key."""

    def __init__(self, order: int, depth: int):
        self.depth, self.shift, self.children = depth, ID * (order - depth), {}


class HatTrie:
    """Counts of phrases of ``order`` word ids, packed into one number. Below the root are hash containers (dicts from
    phrase to count), each shared by the first words of a block of ``SHARED`` ids; a container that grows over
    ``BURST`` entries bursts into a node with a container for each first word, and these, if there are words left to
    tell phrases apart by, into one for each second word."""

    def __init__(self, order: int):
        self.order, self.root, self.entries = order, {}, 0

    def add(self, block: int, keys: list[int], counts: list[int]) -> None:
        at = self.root.get(block)
        if at is None:
            at = self.root[block] = {}
        if isinstance(at, Node):
            self.add_below(at, keys, counts)
            return
        before, get = len(at), at.get
        for k, n in zip(keys, counts):
            at[k] = get(k, 0) + n
        self.entries += len(at) - before
        if len(at) > BURST and self.order > 1:
            self.root[block] = self.burst(at, 1)

    def add_below(self, node: Node, keys, counts) -> None:
        for k, n in zip(keys, counts):
            at, below = node, None
            while isinstance(at, Node):
                above, below = at, k >> at.shift
                at = above.children.get(below)
            if at is None:
                at = above.children[below] = {}
            self.entries += k not in at
            at[k] = at.get(k, 0) + n
            if len(at) > BURST and above.depth < min(self.order - 1, DEEPEST):
                above.children[below] = self.burst(at, above.depth + 1)

    def burst(self, container: dict, depth: int) -> Node:
        node = Node(self.order, depth)
        for k, n in container.items():
            node.children.setdefault(k >> node.shift, {})[k] = n
        return node

    def containers(self, block: int) -> list[dict]:
        """All containers of the subtree of a block."""
        found, open_ = [], [self.root[block]]
        while open_:
            at = open_.pop()
            if isinstance(at, Node):
                open_ += at.children.values()
            else:
                found.append(at)
        return found

    def size(self, block: int) -> int:
        return sum(map(len, self.containers(block)))

    def take(self, block: int) -> list[dict]:
        """Removes the subtree of a block."""
        found = self.containers(block)
        del self.root[block]
        self.entries -= sum(map(len, found))
        return found


def as_run(lang: str, order: int, containers: list[dict], names: pa.Array, rank: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Containers as rows (lang, size, phrase, n) in the order of their words."""
    size = sum(map(len, containers))
    counts = np.fromiter(chain.from_iterable(c.values() for c in containers), np.int64, size)
    keys = chain.from_iterable(containers)
    if order <= 2:
        packed = np.fromiter(keys, np.int64, size)
        columns = [packed >> ID * k & _LOW for k in range(order - 1, -1, -1)]
    else:  # more than 64 bits
        keys = list(keys)
        columns = [np.fromiter((x >> ID * k & _LOW for x in keys), np.int64, size) for k in range(order - 1, -1, -1)]
    by = np.lexsort([rank[c] for c in reversed(columns)])
    for k in range(0, len(by), ROWS):
        at = by[k: k + ROWS]
        words = [names.take(pa.array(c[at])) for c in columns]
        phrase = (pc.binary_join_element_wise(*words, b" ") if order > 1 else words[0]).cast(pa.string())
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(np.full(len(at), order, np.int32)),
                                          phrase, pa.array(counts[at])], names=["lang", "size", "phrase", "n"])


class Counter:
    """The tries of one task, one for each language and order, over shared word ids."""

    def __init__(self, orders: tuple[int, ...], allowed: B.BitFilter | None):
        self.orders, self.allowed = orders, allowed
        self.words, self.tries = Words(), {}

    def add(self, lang: str, texts: list[str | None]) -> None:
        """Counts the phrases of some texts."""
        at, different, piece = split_words(texts)
        if not len(at):
            return
        word = np.array(list(map(self.words.__getitem__, different.to_pylist())), dtype=np.int64)[at]
        for order in self.orders:
            if len(word) < order:
                continue
            at = np.flatnonzero(piece[order - 1:] == piece[: len(piece) - order + 1])
            if self.allowed is not None:  # both phrases one word shorter must be frequent
                h = self.words.hashes()[word]
                ok = self.allowed.has(phrase_hash(lang, [h[k: len(h) - order + 2 + k] for k in range(order - 1)]))
                at = at[ok[at] & ok[at + 1]]
            if len(at):
                self.count(lang, order, [word[at + k] for k in range(order)])

    def count(self, lang: str, order: int, columns: list[np.ndarray]) -> None:
        used = np.zeros(len(self.words.names), dtype=bool)
        for c in columns:
            used[c] = True
        number, dense = np.flatnonzero(used), np.cumsum(used) - 1
        bits = max(1, (len(number) - 1).bit_length())
        if order * bits < 64:  # the words, numbered anew, fit into one number
            key = dense[columns[0]]
            for c in columns[1:]:
                key = key << bits | dense[c]
            key, counts = np.unique(key, return_counts=True)
            columns = [number[key >> bits * k & (1 << bits) - 1] for k in range(order - 1, -1, -1)]
        else:
            key = columns[0]
            for c in columns[1:]:  # numbered anew at each step, so that two numbers fit into one
                _, dense = np.unique(key, return_inverse=True)
                key = dense << ID | c
            _, where, counts = np.unique(key, return_index=True, return_counts=True)
            columns = [c[where] for c in columns]  # in order of their first words, then of the others
        if order <= 2:
            keys = (columns[0] << ID | columns[1] if order == 2 else columns[0]).tolist()
        else:
            keys = columns[0].tolist()
            for c in columns[1:]:
                keys = [k << ID | x for k, x in zip(keys, c.tolist())]
        counts = counts.tolist()
        trie = self.tries.setdefault((lang, order), HatTrie(order))
        block = columns[0] // SHARED
        starts = np.flatnonzero(np.diff(block, prepend=-1))
        for w, start, end in zip(block[starts].tolist(), starts.tolist(), [*starts[1:].tolist(), len(block)]):
            trie.add(w, keys[start:end], counts[start:end])

    def spill(self, everything: bool = False) -> Iterator[pa.RecordBatch]:
        """Runs of whole subtrees: of all, or of the largest ones until half of the entries are left."""
        total = sum(t.entries for t in self.tries.values())
        if not everything and total <= MOST_ENTRIES and len(self.words.names) <= MOST_WORDS:
            return
        left = 0 if everything or len(self.words.names) > MOST_WORDS else MOST_ENTRIES // 2
        names = pa.array(self.words.names, pa.binary())
        rank = np.empty(len(names), dtype=np.int64)
        rank[pc.sort_indices(names).to_numpy()] = np.arange(len(names))
        taken: dict[tuple[str, int], list] = {}
        for size, key, w in sorted(((t.size(w), key, w) for key, t in self.tries.items() for w in t.root), reverse=True):
            if total <= left:
                break
            taken.setdefault(key, []).extend(self.tries[key].take(w))
            total -= size
        for (lang, order), containers in taken.items():
            yield from as_run(lang, order, containers, names, rank)
        if left == 0:
            self.words, self.tries = Words(), {}


def count_runs(src: DataFrame, orders: tuple[int, ...], allowed=None, bits: int = B.BITS) -> DataFrame:
    """Runs of the phrases of ``src`` (lang, text) of these lengths; ``allowed``: broadcast filter of phrases one
    word shorter, both of which a phrase must have in it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(orders, B.BitFilter(bits, allowed.value) if allowed is not None else None)
        for batch in batches:
            for part in cut_batch(batch, PIECE):
                by_lang: dict[str, list] = {}
                for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    by_lang.setdefault(lang, []).append(text)
                for lang, texts in by_lang.items():
                    counter.add(lang, texts)
                yield from counter.spill()
        yield from counter.spill(everything=True)

    return src.mapInArrow(run, RUNS)


def merge_runs(runs: DataFrame, min_count: int) -> DataFrame:
    """(lang, size, phrase, f) of the phrases found ``min_count`` times or more."""
    dealt = runs.repartitionByRange("lang", "phrase")
    return dealt.groupBy("lang", "phrase").agg(F.first("size").alias("size"), F.sum("n").alias("f")).where(F.col("f") >= min_count)


def frequent_filter(frequent: DataFrame, bits: int):
    """Broadcast Bloom filter of frequent phrases (lang, phrase) of one length."""
    def hashes(batch: pa.RecordBatch) -> np.ndarray:
        langs, words = batch.column(0).to_pylist(), [p.encode("utf-8", "surrogatepass").split(b" ") for p in batch.column(1).to_pylist()]
        out = np.zeros(len(langs), np.uint64)
        for lang in set(langs):
            at = np.array([k for k, x in enumerate(langs) if x == lang])
            out[at] = phrase_hash(lang, [word_hashes([words[k][j] for k in at]) for j in range(len(words[at[0]]))])
        return out

    return B.collect(B.merge(B.fill(frequent.select("lang", "phrase"), hashes, bits), bits), "once", bits)


def frequent_phrases(docs: DataFrame, min_count: int = MIN_COUNT, longest: int = LONGEST, lang_col: str = "lang",
                     text_col: str = "text", bits: int = B.BITS) -> tuple[DataFrame, DataFrame]:
    """All phrases up to ``longest`` words found ``min_count`` times or more (lang, size, phrase, f), and the number
    of words of each language (lang, n)."""
    src = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANG)).alias("lang"), F.col(text_col).alias("text"))
    runs = materialize(count_runs(src, tuple(range(1, min(2, longest) + 1))))
    totals = materialize(runs.where("size = 1").groupBy("lang").agg(F.sum("n").alias("n")))
    found = materialize(merge_runs(runs, min_count))
    discard(runs)
    levels = [found]
    for order in range(3, longest + 1):
        allowed = frequent_filter(levels[-1].where(F.col("size") == order - 1), bits)
        runs = materialize(count_runs(src, (order,), allowed, bits))
        levels.append(materialize(merge_runs(runs, min_count)))
        discard(runs)
        allowed.unpersist()
    out = levels[0]
    for level in levels[1:]:
        out = out.unionByName(level)
    return out, totals


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, longest: int = LONGEST, top: int = TOP, cover: int = COVER,
                 **columns) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language."""
    frequent, totals = frequent_phrases(docs, min_count, longest, **columns)
    frequent = materialize(frequent)
    words = F.split("phrase", " ").alias("w")
    phrases = frequent.where("size >= 2").select("lang", "phrase", "size", F.col("f").alias("a"), words)

    def part(start, n):
        return F.array_join(F.slice("w", start, n), " ")

    cuts = phrases.select("lang", "phrase", "size", "a", "w", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("left"),
                       part(F.col("k") + 1, F.col("size") - F.col("k")).alias("right"))
    for side, name in (("left", "l"), ("right", "r")):
        cuts = cuts.join(frequent.select("lang", F.col("phrase").alias(side), F.col("f").alias(name)), ["lang", side])
    score = F.expr("cast(2000000 as decimal(7, 0)) * cast(a as decimal(19, 0)) div (cast(l as decimal(20, 0)) + r)")
    scored = (cuts.select("lang", "phrase", "a", F.struct(score.alias("score"), "k", "l", "r").alias("cut"))
              .groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.min("cut").alias("cut")))
    inner = F.expr("flatten(transform(sequence(2, size - 1), n -> transform(sequence(1, size - n + 1), i -> array_join(slice(w, i, n), ' '))))")
    covers = (phrases.where("size >= 3").select("lang", F.col("a").alias("f"), F.explode(inner).alias("phrase"))
              .groupBy("lang", "phrase").agg(F.max("f").alias("longer")))
    ample = F.expr(f"cast(100 as decimal(3, 0)) * cast(longer as decimal(19, 0)) >= cast({int(cover)} as decimal(3, 0)) * cast(a as decimal(19, 0))")
    kept = scored.join(covers, ["lang", "phrase"], "left").where(F.col("longer").isNull() | ~ample)
    best = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), F.asc("phrase"))
    ranked = kept.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r",
                                              "n", F.col("cut.score").alias("score"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read(spark, sf_dir, "documents").select("lang", "text"))


SQL = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[.,;:!?\x0A-\x0D]')) AS p FROM documents),
w AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM p),
g AS (SELECT lang, s, w, unnest(range(1, len(w) - s + 2)) AS i FROM w, (VALUES (1), (2), (3), (4)) t(s) WHERE len(w) >= s),
c AS (SELECT lang, s, w[i:i + s - 1] AS w, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM c WHERE s = 1 GROUP BY lang),
f AS (SELECT lang, s, w, f FROM c WHERE f >= 30),
k AS (SELECT lang, s, w, f AS a, unnest(range(1, s)) AS k FROM f WHERE s >= 2),
x AS (SELECT k.*, l.f AS l, r.f AS r, 2000000::HUGEINT * k.a // (l.f + r.f) AS score
      FROM k JOIN f l ON l.lang = k.lang AND l.w = k.w[1:k.k] JOIN f r ON r.lang = k.lang AND r.w = k.w[k.k + 1:]),
b AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY lang, w ORDER BY score, k) = 1),
t AS (SELECT lang, f, w, s, unnest(range(2, s)) AS m FROM f WHERE s >= 3),
v AS (SELECT lang, f, w[i:i + m - 1] AS w FROM (SELECT *, unnest(range(1, s - m + 2)) AS i FROM t)),
o AS (SELECT lang, w, max(f) AS longer FROM v GROUP BY lang, w),
e AS (SELECT b.lang, array_to_string(b.w, ' ') AS phrase, a, l, r, score
      FROM b LEFT JOIN o ON o.lang = b.lang AND o.w = b.w WHERE longer IS NULL OR 100 * longer < 80 * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score::BIGINT AS score
FROM e JOIN n USING (lang)
QUALIFY rank <= 2000
"""
