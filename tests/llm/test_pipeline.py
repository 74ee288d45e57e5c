import duckdb
import pytest

import corpus_pipeline as P
from kindling.llm import decontam, langid, lines, mixing, oracle, queries, simhash
from tests.llm.test_decontam import brute as brute_hits
from tests.llm.test_lines import brute as brute_lines
from tests.llm.test_mixing import brute_targets
from tests.llm.test_simhash import brute_components, brute_fp

D = "/root/testdata/sf0.001"


def test_one_query_of_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.Q) == list(range(1, 14))
    assert set(oracle.SQL) <= set(queries.Q)


def test_stages_match_brute_force_step_by_step(spark):
    docs = spark.read.parquet(f"{D}/documents.parquet")
    columns, frames = docs.columns, []
    cur = docs
    for _, stage in P.STAGES:
        cur = spark.createDataFrame(stage(spark, cur, D).collect(), stage(spark, cur, D).schema)
        frames.append(cur)
    assert all(f.columns == columns for f in frames[:-1])
    rows = [[tuple(r) for r in f.select("doc_id", "text", "source", "n_chars").collect()] for f in frames[:-1]]
    seen = {r.doc_id: r for r in langid.identify(docs).collect()}
    assert {r[0] for r in rows[0]} == {i for i, r in seen.items() if r.lang_pred != "und" and r.score >= langid.MIN_SCORE}
    want = {i: t for i, _, _, t in brute_lines([r[:3] for r in rows[0]], lines.MAX_RATIO, lines.MIN_PAGES)}
    assert {r[0]: r[1] for r in rows[1]} == want
    assert all(r[3] == len(r[1]) for r in rows[1])
    ids = [r[0] for r in rows[1]]
    least = brute_components([brute_fp(r[1]) for r in rows[1]], ids, simhash.MAX_BITS)
    assert sorted(r[0] for r in rows[2]) == sorted(set(least))
    items = [tuple(r) for r in spark.read.parquet(f"{D}/benchmark.parquet").collect()]
    clean = [i for i, _, n, _ in brute_hits([r[:2] for r in rows[2]], items, decontam.WINDOW_WORDS) if not n]
    assert sorted(r[0] for r in rows[3]) == sorted(clean)
    mixed = frames[-1].collect()
    sizes = {}
    for r in rows[3]:
        sizes[r[2]] = sizes.get(r[2], 0) + len(r[1].split())
    goal, source = brute_targets(sizes, mixing.WEIGHTS, mixing.MOST_TIMES), {r[0]: r[2] for r in rows[3]}
    assert sorted(r.doc_id for r in mixed) == sorted(clean)
    assert all(r.target == pytest.approx(goal[source[r.doc_id]]) and r.taken <= 3 * r["size"] for r in mixed)


def test_run_is_the_stages_in_order(spark):
    assert [n.split("_")[0] for n, _ in P.STAGES] == ["language", "line", "simhash", "benchmark", "mix"]
    got = P.run(spark, D)
    assert got.columns == ["doc_id", "size", "source_size", "target", "taken"] and got.count() > 100


def test_stages_take_edge_rows(spark, edge, empty):
    bench = duckdb.sql(f"select * from '{D}/benchmark.parquet'")
    assert bench.columns == ["item_id", "text"]
    for name, stage in P.STAGES:
        for docs in (edge, empty):
            got = stage(spark, docs, D)
            assert got.count() <= docs.count()
            if name != P.STAGES[-1][0]:
                assert got.columns == docs.columns
