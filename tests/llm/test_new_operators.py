"""Operators 11 to 13 against brute force: small fixtures with nulls, empty and long texts, ties, repeated rows,
empty tables and clashing columns."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from responsekit.llm import bits as B
from responsekit.llm import collocations as C
from responsekit.llm import token_align as A
from responsekit.llm.collocations import collocations, frequent_phrases
from responsekit.llm.line_dedup import drop_repeated_lines, remove_lines
from responsekit.llm.token_align import align
from tests.llm.conftest import DOCS, clash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# ---------------------------------------------------------------- 11 token alignment
def byte_tokens():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(A.BYTE_BPE)
    t.encode_special_tokens = True
    names, alphabet = {k: x for x, k in t.get_vocab().items()}, A.byte_alphabet()
    return lambda x: [(k, bytes(alphabet[c] for c in names[k])) for k in t.encode(" " + x, add_special_tokens=False).ids]


def piece_tokens():
    import sentencepiece
    m = sentencepiece.SentencePieceProcessor(model_file=A.PIECE_BPE)

    def piece(k):
        p = m.id_to_piece(k)
        return bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode()
    return lambda x: [(k, piece(k)) for k in m.encode(x)]


def brute_align(texts):
    """Per text (n_a, n_b, n_groups, n_links, n_best, count_sum, groups)."""
    encode = byte_tokens(), piece_tokens()
    all_groups = []
    for t in texts:
        sides = [e(t) if t else [] for e in encode]
        if not t or any(b"".join(p for _, p in s) != (" " + t).encode() for s in sides):
            all_groups.append([])
            continue
        ends = [np.cumsum([len(p) for _, p in s]) for s in sides]
        cuts = sorted(set(ends[0]) & set(ends[1]))
        groups = [([], []) for _ in cuts]
        for side in (0, 1):
            for (k, _), end in zip(sides[side], ends[side]):
                groups[int(np.searchsorted(cuts, end))][side].append(k)
        all_groups.append(groups)
    links = [collections.Counter((a, b) for g in groups for a in g[0] for b in g[1]) for groups in all_groups]
    found = collections.Counter(p for c in links for p in c)
    best = {}
    for (a, _), n in found.items():
        best[a] = max(best.get(a, 0), n)
    out = []
    for groups, c in zip(all_groups, links):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append((sum(len(g[0]) for g in groups), sum(len(g[1]) for g in groups), len(groups), sum(c.values()),
                    sum(n for p, n in c.items() if found[p] == best[p[0]]), sum(n * found[p] for p, n in c.items()), text))
    return out


ODD = ["<|endoftext|> and <s> </s> <unk>", "▁ already there", "a\u0000b", "  two  blanks ", "日本語 テキスト 漢字", "é ﬁ ½ \U0001f642\U0001f468‍\U0001f469",
       "<0x0A> \r\n\t x", "z" * 3000, " ", "1234567890" * 30, "http://a.example/x?y=1&z=2"]


@pytest.fixture(scope="module")
def aligned_docs(spark, texts):
    rows = [(k, t, "en", "s", None) for k, t in enumerate(texts + ODD)]
    rows += [rows[3], rows[3], (None, texts[1], None, None, 3), (None, None, None, None, None)]
    return rows, spark.createDataFrame(rows, DOCS).repartition(3)


def align_key(r):
    return tuple((x is None, x) for x in r)


def test_align_matches_brute_force(spark, aligned_docs):
    rows, df = aligned_docs
    want = sorted(((r[0], *b) for r, b in zip(rows, brute_align([r[1] for r in rows]))), key=align_key)
    columns = ["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
    got = align(clash(df))
    assert sorted((tuple(r) for r in got.select(*columns).collect()), key=align_key) == want
    digests = align(df, digest=True).select("id", "n_a", "groups").collect()
    assert sorted((tuple(r) for r in digests), key=align_key) == sorted(
        ((w[0], w[1], hashlib.sha256(w[-1].encode()).hexdigest() if w[-1] else "") for w in want), key=align_key)


def test_group_ends_are_cuts_of_the_text(spark):
    df = spark.createDataFrame([(1, "plain words and cafés"), (2, None)], "doc_id long, text string")
    got = {r["id"]: r for r in align(df).collect()}
    assert got[1]["group_ends"][-1] == len(" plain words and cafés".encode())
    assert len(got[1]["group_ends"]) == got[1]["n_groups"] and got[1]["group_ends"] == sorted(set(got[1]["group_ends"]))
    assert got[2]["group_ends"] == [] and got[2]["groups"] == ""


def test_align_empty_table(spark, no_docs):
    assert align(no_docs).count() == 0


def test_links_of_large_groups_are_the_same(monkeypatch, texts):
    va, vb = A.load_byte_bpe(A.BYTE_BPE), A.load_piece_bpe(A.PIECE_BPE)
    some = texts[-6:] + ODD + ["\U0001f468‍\U0001f469‍\U0001f467" * 40]
    whole = A.align_chunk(some, va, vb)
    for most in (1, 3, 50):
        monkeypatch.setattr(A, "MOST_LINKS", most)
        cut = A.align_chunk(some, va, vb)
        assert (cut["code"] == whole["code"]).all() and (cut["times"] == whole["times"]).all()


def test_pointer_jumping_on_long_chains():
    n = 10000  # tokens of 2 bytes, shifted by one against each other: one chain over all of them
    end_a = np.arange(2, 2 * n + 2, 2)
    end_b = np.concatenate([np.arange(1, 2 * n, 2), [2 * n]])
    a, b = A.group_tokens(end_a, end_b)
    assert (a == 0).all() and (b == 0).all()


# ---------------------------------------------------------------- 12 line dedup
def line_key(x):
    return x.strip(" \t\n\x0b\x0c\r").translate(LOWER)


def brute_lines(rows, min_chars=40, min_docs=5):
    """Per row (lines, dropped, kept text)."""
    held = collections.defaultdict(set)
    for doc, t in rows:
        for x in (t or "").split("\n"):
            if len(line_key(x)) >= min_chars:
                held[line_key(x)].add(doc)
    out = []
    for doc, t in rows:
        lines = (t or "").split("\n")
        kept = []
        for x in lines:
            docs = held.get(line_key(x), ())
            largest = max(docs, key=lambda d: (d is not None, d)) if docs else None
            if len(docs) < min_docs or doc == largest:
                kept.append(x)
        out.append((len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


@pytest.fixture(scope="module")
def line_rows():
    rng = random.Random(5)
    common = [f"{k} a line that comes again and again in many texts {'x' * k}" for k in range(12)]
    rows = []
    for doc in range(60):
        lines = [f"only here {doc} {rng.random()} and quite long so that it counts" for _ in range(rng.randrange(4))]
        for k, line in enumerate(common):
            if rng.random() < 0.02 + k / 15:
                lines += [rng.choice([line, "  " + line.upper() + "\t", line + "\r", line + "\x0b"])] * rng.randrange(1, 3)
        rng.shuffle(lines)
        rows.append((doc, "\n".join(lines) + rng.choice(["", "\n", "\n\n"])))
    four, five = "found in four documents only, which is too few", "found in five documents, which is just enough ok"
    rows += [(100 + k, (four if k < 4 else "") + "\n" + five) for k in range(5)]
    edge = "é\U0001f642" * 20  # 40 code points, more bytes
    rows += [(200 + k, edge + "\n" + edge[:-1] + "\n " + "s" * 39) for k in range(6)]
    rows += [(210, "same doc " * 5 + "\n" + "same doc " * 5)] * 7  # repeated rows of one id are one document
    rows += [(300 + k % 2, f"{k}\nanother text under a repeated id, the line is the same") for k in range(8)]
    rows += [(None, common[11]), (None, common[11] + "\n" + "null ids are one document, smaller than all others")]
    rows += [(None, "null ids are one document, smaller than all others")] * 9
    rows += [(400 + k, t) for k, t in enumerate([None, "", "\n", " \n\t", "x" * 100000, ("long line " * 9 + "\n") * 2000])]
    return rows


def line_docs(spark, rows):
    return spark.createDataFrame([(d, t, "en", "s", 1) for d, t in rows], DOCS).repartition(4)


def test_line_dedup_matches_brute_force(spark, line_rows):
    want = brute_lines(line_rows)
    assert sum(w[1] for w in want) > 100
    got = remove_lines(clash(line_docs(spark, line_rows)), False, ["doc_id"]).select("row.doc_id", "n_lines", "n_dropped", "kept")
    key = [(d, n, gone, hashlib.sha256(t.encode()).hexdigest()) for (d, _), (n, gone, t) in zip(line_rows, want)]
    assert sorted(map(tuple, got.collect()), key=align_key) == sorted(key, key=align_key)


def test_line_dedup_cuts_texts_and_keeps_columns(spark, line_rows):
    df = clash(line_docs(spark, line_rows))
    got = drop_repeated_lines(df)
    assert got.columns == df.columns
    want = [(d, t if w[1] == 0 else w[2]) for (d, t), w in zip(line_rows, brute_lines(line_rows))]
    assert sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=align_key) == sorted(want, key=align_key)


def test_full_filters_change_no_result(spark, line_rows):
    df = line_docs(spark, line_rows)
    columns = ["row.doc_id", "n_lines", "n_dropped", "kept"]
    rows = [sorted(map(tuple, remove_lines(df, False, ["doc_id"], bits=b).select(*columns).collect()), key=align_key) for b in (8, 1 << 20)]
    assert rows[0] == rows[1]


def test_line_dedup_empty_table(spark, no_docs):
    assert drop_repeated_lines(no_docs).collect() == []


def test_filters_hold_all_that_is_seen_twice(spark):
    rng = np.random.default_rng(1)
    values = rng.integers(0, 3000, 5000).tolist()
    df = spark.createDataFrame([(v,) for v in values], "v long").repartition(7)
    bits = 1 << 20

    def hashes(batch):
        return A_hash(batch.column(0).to_numpy())
    A_hash = lambda x: B.mix64(x.astype(np.uint64) + np.uint64(11))
    merged = B.merge(B.fill(df, hashes, bits, twice=True), bits)
    seen = collections.Counter(values)
    for which, least in (("once", 1), ("twice", 2)):
        f = B.BitFilter(bits, B.collect(merged, which, bits).value)
        there = np.array([v for v, n in seen.items() if n >= least])
        other = np.array([v for v in range(3000) if seen[v] < least])
        assert f.has(A_hash(there)).all()
        assert f.has(A_hash(other)).mean() < 0.05


# ---------------------------------------------------------------- 13 collocations
def brute_phrases(rows, longest=4):
    counts, totals = collections.defaultdict(collections.Counter), collections.Counter()
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            totals[lang or "und"] += len(w)
            for n in range(1, longest + 1):
                for i in range(len(w) - n + 1):
                    counts[lang or "und"][tuple(w[i: i + n])] += 1
    return counts, totals


def brute_collocations(rows, min_count, top, longest=4):
    counts, totals = brute_phrases(rows, longest)
    out = []
    for lang, c in counts.items():
        cands = {p: a for p, a in c.items() if a >= min_count and len(p) >= 2}
        found = []
        for p, a in cands.items():
            score, _, l, r = min((2000000 * a // (c[p[:k]] + c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
            inside = [f for q, f in cands.items() if len(q) > len(p)
                      and any(q[i: i + len(p)] == p for i in range(len(q) - len(p) + 1))]
            if not any(100 * f >= 80 * a for f in inside):
                found.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, totals[lang], -s))
    return sorted(out)


@pytest.fixture(scope="module")
def phrase_rows():
    rng = random.Random(9)
    vocabulary = [f"w{k}" for k in range(30)] + ["Été", "a b", "B", "b", "漢字", "x-y", "'"]
    fixed = ["New York City Hall", "machine learning", "w1 w2 w3 w4", "aa bb cc"]
    rows = []
    for k in range(150):
        parts = []
        for _ in range(rng.randrange(1, 12)):
            parts.append(" ".join(rng.choices(vocabulary, k=rng.randrange(1, 7))))
            if rng.random() < 0.6:
                parts.append(rng.choice(fixed))
        rows.append((rng.choice(["en", "de", "en", None, "und"]), "".join(p + rng.choice([" ", ". ", "\n", ",", "\t", "; ", "\r\n", "?!"]) for p in parts)))
    rows += [rows[0]] * 20 + [("en", None), (None, ""), ("de", " .,; \n"), ("fr", "same " * 5000), ("en", "q" * 50000), ("en", "no break here")]
    return rows


def phrase_docs(spark, rows):
    return spark.createDataFrame([(k, t, lang, "s", 1) for k, (lang, t) in enumerate(rows)], DOCS).repartition(5)


@pytest.mark.parametrize("min_count,top", [(5, 2000), (12, 7)])
def test_collocations_match_brute_force(spark, phrase_rows, min_count, top):
    got = collocations(clash(phrase_docs(spark, phrase_rows)), min_count, top=top)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert {t for c, t in got.dtypes if c not in ("lang", "phrase")} == {"bigint"}
    want = brute_collocations(phrase_rows, min_count, top)
    assert len(want) > 10
    assert sorted(map(tuple, got.collect())) == want


def test_frequent_phrases_hold_every_count(spark, phrase_rows):
    frequent, totals = frequent_phrases(phrase_docs(spark, phrase_rows), 4, bits=64)  # a full filter prunes nothing
    counts, n = brute_phrases(phrase_rows)
    want = {(lang, " ".join(p)): f for lang, c in counts.items() for p, f in c.items() if f >= 4}
    assert {(r["lang"], r["phrase"]): r["f"] for r in frequent.collect()} == want
    assert {r["lang"]: r["n"] for r in totals.collect()} == {k: v for k, v in n.items() if v}


def test_tries_burst_and_spill_without_loss(monkeypatch, phrase_rows):
    monkeypatch.setattr(C, "BURST", 3)
    monkeypatch.setattr(C, "MOST_ENTRIES", 200)
    counter, runs, burst = C.Counter((1, 2, 3, 4), None), [], 0
    for lang, t in phrase_rows:
        counter.add(lang or "und", [t])
        burst += sum(isinstance(at, C.Node) for trie in counter.tries.values() for at in trie.root.values())
        runs += list(counter.spill())
    assert len(runs) > 20 and burst > 20
    runs += list(counter.spill(everything=True))
    got = collections.defaultdict(collections.Counter)
    for batch in runs:
        rows = batch.to_pylist()
        assert [r["phrase"].split(" ") for r in rows] == sorted(r["phrase"].split(" ") for r in rows)
        for r in rows:
            assert len(r["phrase"].split(" ")) == r["size"]
            got[r["lang"]][tuple(r["phrase"].split(" "))] += r["n"]
    assert got == {k: v for k, v in brute_phrases(phrase_rows)[0].items() if v}


def test_word_ids_start_again_when_there_are_many(monkeypatch, phrase_rows):
    monkeypatch.setattr(C, "MOST_WORDS", 10)
    counter, got = C.Counter((2,), None), collections.Counter()
    for _, t in phrase_rows:
        counter.add("x", [t])
        for batch in counter.spill():
            got.update({r["phrase"]: r["n"] for r in batch.to_pylist()})
        assert len(counter.words.names) <= 10
    for batch in counter.spill(everything=True):
        got.update({r["phrase"]: r["n"] for r in batch.to_pylist()})
    want = brute_phrases([("x", t) for _, t in phrase_rows])[0]["x"]
    assert got == {" ".join(p): n for p, n in want.items() if len(p) == 2}


def test_scores_pass_64_bits(spark):
    row = spark.createDataFrame([(9 * 10 ** 15, 10 ** 16, 9 * 10 ** 15 + 1)], "a long, l long, r long")
    s = row.select(F.expr("cast(2000000 as decimal(7, 0)) * cast(a as decimal(19, 0)) div (cast(l as decimal(20, 0)) + r)")).first()[0]
    assert s == 2000000 * 9 * 10 ** 15 // (10 ** 16 + 9 * 10 ** 15 + 1)


def test_words_are_split_at_once():
    """The words of a batch come out of one pass over its bytes, with their pieces, as splitting text by text gives them."""
    texts = ["", None, "a  B\ta, b.\x0bé a!?", " \n", "A", "\U0001F600 b;c", "::"]
    at, different, piece = C.split_words(texts)
    want = [[w.encode() for w in re.split(r"[ \t]+", re.sub("[A-Z]", lambda m: m[0].lower(), p)) if w]
            for t in texts for p in re.split(r"[.,;:!?\n-\r]", t or "")]
    got = collections.defaultdict(list)
    for k, p in zip(at.tolist(), piece.tolist()):
        got[p].append(different[k].as_py())
    assert list(got.values()) == [w for w in want if w]
    assert [len(x) for x in C.split_words(["", None])] == [0, 0, 0]


@pytest.mark.parametrize("n", [3, 70_000])  # 70,000 words: four of them don't fit into 64 bits
def test_counting_packs_words_if_they_fit(n):
    words = [f"w{k}" for k in range(n)]
    counter, got = C.Counter((1, 2, 3, 4), None), collections.Counter()
    for texts in ([" ".join(words), " ".join(words[:5])], [" ".join(reversed(words)), " ".join(words)]):
        counter.add("en", texts)
    for run in counter.spill(everything=True):
        for p, k in zip(run.column(2).to_pylist(), run.column(3).to_pylist()):
            got[p] += k
    want = collections.Counter()
    for text in (words, words[:5], words[::-1], words):
        for size in (1, 2, 3, 4):
            want.update(" ".join(text[k: k + size]) for k in range(len(text) - size + 1))
    assert got == want


def test_collocations_empty_table(spark, no_docs):
    assert collocations(no_docs).collect() == []
    assert isinstance(collocations(no_docs).schema["score"].dataType, T.LongType)
