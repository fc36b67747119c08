"""The registered queries against their SQL, and the pipeline against brute force."""

import collections

import pytest

import corpus_pipeline
from checks.compare import compare_one, duck_conn
from responsekit.llm.queries import QUERIES, SQL
from tests.llm.test_operators import brute_links, brute_repeats, shingles, tokens

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, name):
    info = compare_one(spark, duck_conn(SF), name, QUERIES[name], SQL[name], SF)
    assert info["values"], info


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_pipeline(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = [(r["doc_id"], r["text"]) for r in docs.collect()]
        path = str(tmp_path / name)
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        after = {r["doc_id"]: r for r in docs.collect()}
        if k < 4:
            assert docs.columns == columns
        if name == "quality_classifier":
            bad = {r["doc_id"] for r in QUERIES["op9_quality_qda"](spark, SF).collect() if r["predicted"] == 0}
            assert set(after) == {d for d, _ in before} - bad and bad
        if name == "near_duplicates":
            _, group = brute_links(before)
            firsts = {min(before[j][0] for j in range(len(before)) if group[j] == g) for g in set(group)}
            assert set(after) == firsts
        if name == "substring_dedup":
            assert set(after) == {d for d, _ in before}
            for (doc, _), (n, gone, _) in zip(before, brute_repeats([t for _, t in before], 35)):
                assert len(tokens(after[doc]["text"])) == n - gone
        if name == "decontamination":
            items = [shingles(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            have = {d: shingles(t) for d, t in before}
            clean = {d for d in have if not any(s and len(s & have[d]) >= 0.8 * len(s) for s in items)}
            assert set(after) == clean
        if name == "source_mix":
            assert set(after) == {d for d, _ in before}
            taken, target = collections.Counter(), {}
            for r in after.values():
                taken[r["source"]] += r["taken"]
                target[r["source"]] = r["target"]
            assert all(abs(taken[s] - target[s]) <= 1 for s in target)
    assert {r["doc_id"]: r["taken"] for r in corpus_pipeline.run(spark, SF).collect()} == {d: r["taken"] for d, r in after.items()}
