"""Each operator against a brute-force version on a small fixture, and its defined odd cases."""

import collections
import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from responsekit.llm import decontaminate, license_scan, ngram_jaccard, quality_qda, quality_rules, source_mix
from responsekit.llm import substring_dedup, token_counts, url_rules, warc
from responsekit.llm.components import connected_components
from responsekit.llm.textstats import STATS, base_counts
from responsekit.llm.common import split_words
from tests.llm.conftest import clash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def tokens(t):
    return WORD.findall(t or "")


def shingles(t, n=5):
    w = tokens(t)
    return {tuple(w[k:k + n]) for k in range(len(w) - n + 1)}


def bag(rows):
    return collections.Counter(tuple(r) for r in rows)


# ---- 1 token counts

def brute_tokens(text, rule):
    """Token by token and section by section, over bytes."""
    data = (text or "").encode()
    lines = (text or "").split("\n")
    parts = [x + "\n" for x in lines[:-1]] + ([lines[-1]] if lines[-1] else [])
    parts = parts or [""]
    bounds = np.cumsum([0] + [len(p.encode()) for p in parts])
    encoding, _ = token_counts.load_encoding(token_counts.VOCABULARY)
    counts, at = [0] * len(parts), 0
    for t in encoding.encode_ordinary(text or ""):
        end = at + len(encoding.decode_single_token_bytes(t))
        share = [max(0, min(end, bounds[k + 1]) - max(at, bounds[k])) for k in range(len(parts))]
        inside = [k for k, s in enumerate(share) if s]
        counts[{"first": inside[0], "last": inside[-1], "most": share.index(max(share))}[rule]] += 1
        at = end
    assert at == len(data)
    return counts


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_token_counts(docs, rule):
    got = collections.defaultdict(dict)
    for r in token_counts.count_tokens(clash(docs.where("doc_id is not null")), rule=rule).collect():
        got[r["id"]][r["section"]] = r
    for r in docs.where("doc_id is not null").collect():
        mine = [got[r["doc_id"]][k] for k in sorted(got[r["doc_id"]])]
        assert [x["n_tokens"] for x in mine] == brute_tokens(r["text"], rule)
        assert [x["char_start"] for x in mine][1:] == [x["char_end"] for x in mine][:-1]
        assert mine[-1]["char_end"] == len(r["text"] or "")


def test_crossing_token_rules():
    offsets, bounds = np.array([0, 3, 7, 8]), np.array([0, 4, 5, 8])  # the token 3..7 covers 1, 1 and 2 bytes
    assert token_counts.attribute(offsets, bounds, "first")[0].tolist() == [2, 0, 1]
    assert token_counts.attribute(offsets, bounds, "most")[0].tolist() == [1, 0, 2]
    assert token_counts.attribute(offsets, bounds, "most")[1].tolist() == [0, 0, 1]


# ---- 2 licence scan

def brute_licences(text):
    out = []
    sets = {}
    for name, t in license_scan.TEMPLATES:
        w = re.sub(r"[\W_]+", " ", t.lower()).split()
        sets[name] = {" ".join(w[k:k + 2]) for k in range(max(1, len(w) - 1))}
    units = [("line", k, x) for k, x in enumerate((text or "").split("\n"))]
    units += [("paragraph", k, x) for k, x in enumerate(re.split(r"\n[ \t-\r]*\n", text or "")) if "\n" in x.strip(" ")]
    for unit, k, x in units:
        w = re.sub(r"[\W_]+", " ", x.lower()).split()
        if not w:
            continue
        mine = {" ".join(w[i:i + 2]) for i in range(max(1, len(w) - 1))}
        dice = [(-2 * len(mine & s) / (len(mine) + len(s)), name) for name, s in sets.items()]
        if -min(dice)[0] >= 0.8:
            out.append((unit, k, min(dice)[1], round(-min(dice)[0], 9)))
    return out


def test_license_scan(spark, no_docs):
    mit = dict(license_scan.TEMPLATES)["MIT-terms"]
    texts = ["Intro words.\nReleased under the MIT license\nmore", mit, mit.replace("free of charge", "gratis"),
             "a\n\n" + mit.replace(", to deal", ",\nto deal") + "\n\nend", "Licensed under CC BY-NC 4.0.", "licensed under cc by 4.0",
             "License", "", None, "MIT " * 3000, "This work is licensed under the GNU General Public License, version 2."]
    rows = [Row(doc_id=k, text=t) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows + rows[:1], "doc_id long, text string")
    templates = spark.createDataFrame(license_scan.TEMPLATES, "name string, text string")
    got = bag((r["doc_id"], r["unit"], r["number"], r["license"], round(r["dice"], 9)) for r in license_scan.scan(clash(df), templates).collect())
    assert got == bag((k, *x) for k, t in enumerate(texts) for x in brute_licences(t))
    assert len(got) >= 6
    assert license_scan.scan(no_docs, templates).count() == 0
    assert license_scan.scan(df, templates.limit(0)).count() == 0


def brute_runs(text, templates, threshold=0.8):
    """Every run of a template's width from every word on that begins at one of its bigrams; those no better one overlaps."""
    w = re.sub(r"[\W_]+", " ", (text or "").lower()).split()
    found = []
    for name, t in templates:
        v = re.sub(r"[\W_]+", " ", t.lower()).split()
        known = {" ".join(v[k:k + 2]) for k in range(max(1, len(v) - 1))}
        for s in range(len(w)):
            run = w[s:s + len(v)]
            grams = [" ".join(run[k:k + 2]) for k in range(max(1, len(run) - 1))]
            if grams[0] in known:
                common = len(set(grams) & known)
                found.append((-2 * common / (len(set(grams)) + len(known)), -common, s, name, s + len(run)))
    found = [f for f in found if -f[0] >= threshold]
    return [("run", f[2], f[3], round(-f[0], 9)) for f in found
            if not any(o[:4] < f[:4] and o[2] < f[4] and f[2] < o[4] for o in found)]


def test_license_passages(spark, no_docs):
    known = dict(license_scan.TEMPLATES)
    mit, gpl = known["MIT-terms"].split(), known["GPL-3.0-notice"].split()
    wrapped = "\n".join(" ".join(mit[k:k + 9]) for k in range(0, len(mit), 9))
    code = "\n".join(f"call_{k}(value_{k}, other_{k % 7})" for k in range(60))
    comment = "\n#\n".join("# " + " ".join(gpl[k:k + 8]) for k in range(0, len(gpl), 8))
    terms = "Permission to do this is given to all. " * 2 + "\n\n" + "\n\n".join(" ".join(f"clause {k} says word{k}" for k in range(b, b + 20)) for b in (0, 20, 40)) + "\n\nEnd of all terms."
    templates = [*license_scan.TEMPLATES, ("Full", terms), ("One", "Unlicensed")]
    texts = [f"Copyright (c) 2020 A Person\n{wrapped}\n{code}", f"{code}\n{comment}\n{code}", terms, f"{code}\n{terms}\n{code}",
             "We say that all of it is released under the MIT License. and nothing else is said about it here by anyone.",
             "Released under the MIT License. " * 3 + "Unlicensed", "This work is licensed under the GNU General Public License, version 3.",
             f"{known['Apache-2.0-notice']} more words", "unlicensed", "", None, "MIT " * 3000]
    df = spark.createDataFrame([Row(doc_id=k, text=t) for k, t in enumerate(texts)] * 2, "doc_id long, text string")
    tf = spark.createDataFrame(templates, "name string, text string")
    got = bag((r["doc_id"], r["unit"], r["number"], r["license"], round(r["dice"], 9)) for r in license_scan.scan_passages(clash(df), tf).collect())
    assert bag(x for x in got if x[1] == "run") == bag((k, *x) for k, t in enumerate(texts) for x in brute_runs(t, templates))
    seen = {(x[0], x[3]) for x in got}
    assert {(0, "MIT-terms"), (1, "GPL-3.0-notice"), (2, "Full"), (3, "Full"), (4, "MIT"), (5, "One"), (6, "GPL-3.0"), (7, "Apache-2.0-notice")} <= seen
    assert {x for x in got if x[1] == "text"} == {(2, "text", 0, "Full", 1.0)}
    lines = {(r["doc_id"], r["license"]) for r in license_scan.scan(df, tf).collect()}
    assert not lines & {(0, "MIT-terms"), (1, "GPL-3.0-notice"), (2, "Full"), (3, "Full"), (4, "MIT")}  # what lines and paragraphs miss
    assert license_scan.scan_passages(no_docs, tf).count() == 0
    assert license_scan.scan_passages(df, tf.limit(0)).count() == 0


# ---- 3 quality rules

def brute_base(text):
    w = tokens(text)
    lines = [x for x in (text or "").split("\n") if tokens(x)]
    dup = sum(x in lines[:k] for k, x in enumerate(lines))
    seen = collections.Counter(zip(w, w[1:], w[2:]))
    covered = {k + d for k in range(len(w) - 2) if seen[tuple(w[k:k + 3])] > 1 for d in range(3)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered)


def test_base_counts(texts):
    for t in [*texts, "# a b c\n# a b c\n|<>", "a\x1cb\x85c\xa0d \u2003 e"]:
        assert base_counts(t, split_words(t)) == brute_base(t)


def test_quality_rules(docs, no_docs):
    got = quality_rules.score_quality(clash(docs)).collect()
    assert len(got) == docs.count()
    by_id = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in got:
        if r["id"] is not None:
            assert tuple(r[c] for c in STATS[:5]) == brute_base(by_id[r["id"]])
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert r["kept"] == (not r["base_failed"] and r["posterior"] >= 0.5)
        assert 0 <= r["posterior"] <= 1
    assert quality_rules.score_quality(no_docs).count() == 0


def pattern(**given):
    return tuple(given.get(r[0], 1 if r[0] in ("words", "word_length", "repeated_words", "letters", "line_ends") else 0)
                 for r in quality_rules.RULES)


def test_label_model_learns_accuracies():
    good, bad = pattern(), pattern(symbols=-1, repeated_lines=-1, repeated_words=-1, letters=-1)
    model = quality_rules.fit_label_model([(good, 9000), (bad, 800), (pattern(symbols=-1), 20)])
    assert quality_rules.log_odds(good, model["prior"], model["rates"]) > 0 > quality_rules.log_odds(bad, model["prior"], model["rates"])
    assert all(0 < a < 1 for a in model["accuracy"])
    assert model["rates"][0][2][-1] > 0.5 and model["rates"][1][2][-1] < 0.01


def test_label_model_learns_that_a_rule_is_poor():
    """400 of 900 documents that every other rule calls good trip one rule: its false-alarm rate is learned."""
    flagged = pattern(symbols=-1)
    model = quality_rules.fit_label_model([(pattern(), 500), (flagged, 400)])
    assert model["rates"][1][2][-1] > 0.3
    assert quality_rules.log_odds(flagged, model["prior"], model["rates"]) > 0
    # ten times the corpus: the prior, a fixed number of documents, weighs less
    more = quality_rules.fit_label_model([(pattern(), 5000), (flagged, 4000)])
    assert abs(more["rates"][1][2][-1] - 4 / 9) < abs(model["rates"][1][2][-1] - 4 / 9) < 0.15


def test_quality_posterior_on_labelled_documents(spark):
    """The posterior, which has seen no label, agrees with the labels of the given table."""
    sf = "/root/testdata/sf0.01"
    got = quality_rules.score_quality(spark.read.parquet(f"{sf}/documents.parquet")).select("id", "posterior")
    rows = got.join(spark.read.parquet(f"{sf}/labels.parquet"), got["id"] == F.col("doc_id")).collect()
    right = {q: sum((r["posterior"] >= 0.5) == bool(q) for r in rows if r["quality"] == q) for q in (0, 1)}
    total = collections.Counter(r["quality"] for r in rows)
    assert right[0] >= 0.95 * total[0] and right[1] >= 0.95 * total[1]


# ---- 4 substring dedup

def brute_repeats(rows, length):
    found = collections.Counter()
    split = [tokens(t) for t in rows]
    for w in split:
        found.update(tuple(w[k:k + length]) for k in range(len(w) - length + 1))
    out = []
    for w in split:
        gone = {k + d for k in range(len(w) - length + 1) if found[tuple(w[k:k + length])] > 1 for d in range(length)}
        kept = [x for k, x in enumerate(w) if k not in gone]
        out.append((len(w), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return out


@pytest.mark.parametrize("length,seed", [(35, 8), (35, 35), (10, 3)])
def test_substring_dedup(docs, length, seed):
    rows = docs.collect()
    want = bag((r["doc_id"], *x) for r, x in zip(rows, brute_repeats([r["text"] for r in rows], length)))
    out = substring_dedup.remove_repeats(clash(docs), cut=False, carry=["doc_id", "k1"], length=length, seed=seed)
    got = out.select("row.doc_id", "n_words", "n_removed", "kept").collect()
    assert bag(got) == want


def test_cut_repeats(docs, no_docs):
    rows = docs.collect()
    want = collections.Counter()
    for r, (n, gone, digest) in zip(rows, brute_repeats([r["text"] for r in rows], 35)):
        want[(r["doc_id"], r["text"] is None, digest)] += 1
        if not gone:
            want[(r["doc_id"], r["text"], "same")] += 1
    got = collections.Counter()
    cut = substring_dedup.cut_repeats(docs)
    assert cut.columns == docs.columns
    before = {(r["doc_id"], r["text"]) for r in rows}
    for r in cut.collect():
        got[(r["doc_id"], r["text"] is None, hashlib.sha256(" ".join(tokens(r["text"])).encode()).hexdigest())] += 1
        if (r["doc_id"], r["text"]) in before:
            got[(r["doc_id"], r["text"], "same")] += 1
        else:
            assert r["n_chars"] == len(r["text"])
    assert got == want
    assert substring_dedup.cut_repeats(no_docs).count() == 0


def test_a_row_repeated_ten_thousand_times(spark):
    """Repeated rows are brought down to one before anything is gathered by row, so work grows with their number."""
    long = " ".join(f"r{k % 390}x{k}" for k in range(400))
    df = spark.range(10000).select(F.lit(7).cast("long").alias("doc_id"), F.lit(long).alias("text")).unionByName(
        spark.createDataFrame([(8, long + " one more"), (9, "other words here")], "doc_id long, text string"))
    got = substring_dedup.remove_repeats(df, cut=False, carry=["doc_id"]).groupBy("row.doc_id", "n_words", "n_removed").count().collect()
    assert {tuple(r) for r in got} == {(7, 400, 400, 10000), (8, 402, 400, 1), (9, 3, 0, 1)}
    links = ngram_jaccard.near_duplicates(df).groupBy("id", "class_id", "n_links").count().collect()
    assert {tuple(r) for r in links} == {(7, 7, 10000, 10000), (8, 7, 10000, 1), (9, 9, 0, 1)}


# ---- 5 n-gram Jaccard join

def brute_links(rows):
    sets = []
    for _, t in rows:
        w = tokens(t)
        sets.append({tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    n = len(rows)
    links = [[j for j in range(n) if j != i and sets[i] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])] for i in range(n)]
    group = list(range(n))
    for _ in range(n):
        group = [min([group[i]] + [group[j] for j in links[i]]) for i in range(n)]
    return links, group


def test_ngram_jaccard(docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    links, group = brute_links(rows)
    ids = collections.defaultdict(list)
    for i, g in enumerate(group):
        ids[g].append(rows[i][0])
    want = collections.Counter()
    for i, (doc, t) in enumerate(rows):
        own = doc if not tokens(t) else min((x for x in ids[group[i]] if x is not None), default=None)
        want[(doc, own, len(links[i]))] += 1
    got = ngram_jaccard.near_duplicates(clash(docs.drop("lang")).drop("id")).select("id", "class_id", "n_links").collect()
    assert bag(got) == want
    assert ngram_jaccard.near_duplicates(no_docs).count() == 0


def test_keep_one_of_each(docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    _, group = brute_links(rows)
    kept = ngram_jaccard.keep_one_of_each(clash(docs))
    assert kept.columns == clash(docs).columns
    assert kept.count() == len({group[i] for i, r in enumerate(rows) if tokens(r[1])}) + sum(not tokens(t) for _, t in rows)


def test_large_buckets_are_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(ngram_jaccard, "BLOCK", 4)
    monkeypatch.setattr(ngram_jaccard, "COLUMNS", 16)
    base = [f"w{k}" for k in range(150)]
    rows = []
    for k in range(30):  # each with one word of its own: all pairs are linked
        w = list(base)
        w[5 * k] = f"own{k}"
        rows.append((k, " ".join(w)))
    got = ngram_jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    links, group = brute_links(rows)
    assert {(r["id"], r["class_id"], r["n_links"]) for r in got.collect()} == {(k, group[k], len(links[k])) for k in range(30)}


def test_bands_reach_recall():
    bands, rows = ngram_jaccard.choose_bands(0.8, 0.999)
    assert 1 - (1 - 0.8 ** rows) ** bands >= 0.999 and bands * rows <= ngram_jaccard.MAX_HASHES


def test_components(spark):
    edges = [(k + 1, k) for k in range(40)] + [(100, 103), (103, 101), (101, 100), (200, 200)]
    got = {r["node"]: r["label"] for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{k: 0 for k in range(41)}, 100: 100, 101: 100, 103: 100}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


# ---- 6 source mix

def brute_targets(sizes):
    total, weights = 1.5 * sum(sizes.values()), {}
    for k, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or ""))):
        weights[s] = (5, 2, 1)[k % 3]
    target, open_ = {s: 0.0 for s in sizes}, set(sizes)
    left = total
    while open_ and left > 1e-9:
        w = sum(weights[s] for s in open_)
        share = {s: left * weights[s] / w for s in open_}
        full = {s for s in open_ if target[s] + share[s] > 2 * sizes[s]}
        if not full:
            for s in open_:
                target[s] += share[s]
            break
        for s in full:
            target[s] = 2.0 * sizes[s]
        open_ -= full
        left = total - sum(target[s] for s in sizes if s not in open_)
    return target


def test_source_mix(docs, no_docs):
    got = source_mix.mix(clash(docs)).select("row.doc_id", "row.source", "row.text", "size", "source_size", "target", "taken").collect()
    assert len(got) == docs.count()
    sizes = collections.Counter()
    for r in docs.collect():
        sizes[r["source"]] += len(tokens(r["text"]))
    want, taken = brute_targets(sizes), collections.Counter()
    for r in got:
        assert r["size"] == len(tokens(r["text"])) and r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 1
    assert sum(want.values()) == pytest.approx(1.5 * sum(sizes.values()))
    again = source_mix.mix(docs.repartition(7), carry=["doc_id", "text"]).select("row.doc_id", "row.text", "taken")
    assert bag(again.collect()) == bag((r["doc_id"], r["text"], r["taken"]) for r in got)
    assert source_mix.mix(no_docs).count() == 0


def test_mix_of_empty_texts(spark):
    got = source_mix.mix(spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")).collect()
    assert [(r["size"], r["target"], r["taken"]) for r in got] == [(0, 0.0, 0)] * 2


def test_complete_epochs_come_first(spark):
    rows = [(k, "w " * 100, "a" if k < 4 else "b") for k in range(40)]
    got = source_mix.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).select("row.source", "size", "taken", "target").collect()
    a = [r for r in got if r["source"] == "a"]
    assert {r["taken"] for r in a} == {200} and a[0]["target"] == 800  # five shares of 6000 words, but twice its size at most
    b = [r["taken"] for r in got if r["source"] == "b"]
    assert sum(b) == 5200 and min(b) >= 100


# ---- 7 url filter

def test_url_filter(spark):
    urls = ["http://a.example.org/es/x?q#f", "https://EXAMPLE.org/en/12", "http://org", "http://x.org/", "http://notexample.org/es/",
            "ftp://fr.com/fr/1", "http://b.c.com/de/", "http://com/de/x", "http://b.com/it", "http://example.org", "noscheme/org/", "", None,
            "a://b://org/x", "://org/y", "http:///p", "http://ÄB.com/fr/é", "http://example.org/en/", "x\n://y.org/z\n"]
    rules = [(v, h, p) for v, h, p in url_rules.RULES] + [("block", "b.c.com", "/de/"), ("allow", "c.com", "/de/x/y")]

    def brute(u):
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        fits = [(len(h + p), len(h), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return host, path, max(fits)[2] if fits else None, max(fits)[3] if fits else "allow"

    rows = [(k, u) for k, u in enumerate(urls)] + [(0, urls[0]), (None, urls[1])]
    df = clash(spark.createDataFrame(rows, "page_id long, url string"))
    got = url_rules.filter_urls(df, spark.createDataFrame(rules, "verdict string, host string, path string"))
    want = bag((k, *brute(u)) for k, u in rows)
    assert bag(got.select("row.page_id", "host", "path", "rule", "verdict").collect()) == want
    none = url_rules.filter_urls(df.limit(0), spark.createDataFrame(rules, "verdict string, host string, path string"))
    assert none.count() == 0
    no_rules = url_rules.filter_urls(df, spark.createDataFrame([], "verdict string, host string, path string"))
    assert {(r["rule"], r["verdict"]) for r in no_rules.collect()} == {(None, "allow")}


# ---- 8 WARC

def test_warc_round_trip(spark, tmp_path):
    html = ["<p>a</p>", None, "", "x" * 200000, "a\r\n\r\nWARC/1.1\r\n", "é漢🙂", "<p>a</p>", "<p>a</p>"]
    rows = [(k, f"http://h/{k} ü\n", h) for k, h in enumerate(html)] + [(1, None, None), (None, "u", "<p>a</p>"), (None, None, "only")]
    df = clash(spark.createDataFrame(rows, "page_id long, url string, html string")).repartition(3)
    index = warc.write_archive(df, str(tmp_path / "w"))
    got = warc.read_records(index, str(tmp_path / "w")).collect()
    assert len(got) == len(rows)
    first = {}
    for k, _, h in rows:
        h = h or ""
        first[h] = min((x for x in (first.get(h), k) if x is not None), default=None)
    want = collections.Counter()
    for k, u, h in rows:
        data = (h or "").encode()
        revisit = k != first[h or ""]
        want[(None if k is None else str(k), u, len(data), warc.base32_sha1(data), "revisit" if revisit else "response",
              str(first[h or ""]) if revisit else None, None if revisit else data)] += 1
    assert collections.Counter((r["page_id"], r["url"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"],
                                None if r["payload"] is None else bytes(r["payload"])) for r in got) == want
    some = warc.read_records(index.where("page_id in ('3', '5')"), str(tmp_path / "w")).collect()
    assert {r["page_id"] for r in some} == {"3", "5"}
    big = warc.read_records(warc.write_archive(df, str(tmp_path / "v"), min_revisit_bytes=100), str(tmp_path / "v"))
    assert {r["record_type"] for r in big.collect()} == {"response"}
    assert warc.read_records(warc.write_archive(df.limit(0), str(tmp_path / "e")), str(tmp_path / "e")).count() == 0


def test_archive_is_read_by_plain_gzip(spark, tmp_path):
    import gzip
    df = spark.createDataFrame([(k, "http://h", f"<p>{k}</p>") for k in range(9)], "page_id long, url string, html string")
    warc.write_archive(df, str(tmp_path / "w"))
    data = b"".join(gzip.decompress(f.read_bytes()) for f in (tmp_path / "w").iterdir())
    assert data.count(b"WARC/1.1\r\nWARC-Type: response") == 9


# ---- 9 quality classifier

def test_qda_density_matches_formula():
    rng = np.random.default_rng(1)
    x = {c: rng.normal(c, 1 + c, (200, quality_qda.FEATURES)) for c in (0, 1)}
    model = quality_qda.ShrunkQda({c: (200, v.sum(0), v.T @ v) for c, v in x.items()})
    q = rng.normal(0.5, 1, (20, quality_qda.FEATURES))
    cov = {c: np.cov(v.T, bias=True) for c, v in x.items()}
    pooled = (cov[0] + cov[1]) / 2
    a, b = quality_qda.SHRINK_POOLED, quality_qda.SHRINK_DIAGONAL
    log = {}
    for c in (0, 1):
        s = (1 - a - b) * cov[c] + a * pooled + b * np.diag(np.diag(pooled))
        d = q - x[c].mean(0)
        log[c] = -0.5 * (np.einsum("ij,jk,ik->i", d, np.linalg.inv(s), d) + np.linalg.slogdet(s)[1])
    assert np.allclose(model.scores(q), 1 / (1 + np.exp(np.clip(log[0] - log[1], -700, 700))))


def test_qda_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = quality_qda.op9_quality_qda(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    assert len(got) > 50 and np.mean([r["predicted"] == r["quality"] for r in got]) >= 0.95


def test_qda_odd_cases(spark, docs, no_docs):
    labels = spark.createDataFrame([(0, 1), (0, 1), (3, 0), (5, None), (6, 7), (999, 1), (None, 0)], "doc_id long, quality int")
    got = quality_qda.score_documents(clash(docs).drop("id"), labels).collect()
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 for r in got)
    one = quality_qda.score_documents(docs, labels.where("quality = 1")).collect()
    assert {r["score"] for r in one} == {1.0}
    none = quality_qda.score_documents(docs, labels.limit(0)).collect()
    assert {r["score"] for r in none} == {0.5}
    assert quality_qda.score_documents(no_docs, labels).count() == 0
    kept = quality_qda.keep_good(clash(docs), labels.limit(0))
    assert kept.columns == clash(docs).columns and kept.count() == docs.count()


# ---- 10 decontamination

def windows(text, size):
    w = tokens(text)
    return {tuple(w[k:k + size]) for k in range(len(w) - size + 1)} if size else set()


def test_decontaminate(spark, texts, docs, no_docs):
    items = [(k, " ".join((t or "").split()[3:3 + n])) for k, (t, n) in enumerate(zip(texts, [8, 12, 5, 4, 40, 60, 20, 9] * 10))]
    items += [(500, None), (501, ""), (502, "not there at all ever"), (0, items[0][1]), (503, texts[2][:20] + " " + texts[2])]
    items += [(600, "the secret answer"), (601, "w1"), (602, "a b c d"), (603, "one"), (604, texts[0].split()[7]),
              (605, " ".join(texts[1].split()[4:6])), (606, "漢字 🙂"), (607, "漢字 🙂 \n é")]
    want = set()
    for doc, text in [(r["doc_id"], r["text"]) for r in docs.distinct().collect()]:
        for item, s in items:
            size = min(5, len(tokens(s)))
            need, have = windows(s, size), windows(text, size)
            if need and len(need & have) >= 0.8 * len(need):
                want.add((doc, item, len(need), len(need & have)))  # rows without id differ in text, none is a pair twice
    df = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.find_leaks(clash(docs), clash(df)).collect()
    assert bag((r["doc_id"], r["item_id"], r["n_item"], r["n_shared"]) for r in got) == bag(want)
    by_shuffle = decontaminate.find_leaks(docs, df, broadcast_shingles=0).collect()
    assert bag(got) == bag(by_shuffle)
    leaked = {d for d, *_ in want}
    kept = decontaminate.drop_leaks(clash(docs), df)
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == sorted(
        r["doc_id"] for r in docs.collect() if r["doc_id"] is not None and r["doc_id"] not in leaked)
    assert decontaminate.find_leaks(no_docs, df).count() == 0 and decontaminate.find_leaks(docs, df.limit(0)).count() == 0
