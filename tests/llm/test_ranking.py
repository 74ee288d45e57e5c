import math
import random
import re

import pytest

from kindling.llm import ranking as K

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return TERM.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute(docs, items, top):
    kept = [(i, plain_terms(t)) for i, t in docs if plain_terms(t)]
    n_docs, all_terms = len(kept), sum(len(w) for _, w in kept)
    out = []
    for item, text in dict.fromkeys(items):
        scored = []
        for doc_id, found in kept:
            score = 0
            for t in sorted(set(plain_terms(text))):
                tf = found.count(t)
                df = sum(t in w for _, w in kept)
                if tf:
                    m = 100 - 50 + (50 * len(found) * n_docs) // all_terms
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) * ((1000000000 * tf) // (1000 * tf + 20 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id if doc_id is not None else 0))
        for rank, (score, none, doc_id) in enumerate(sorted(scored)[:top], 1):
            out.append((item, rank, None if none else doc_id, -score))
    return sorted(out, key=repr)


def result(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


def items_of(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "item_id long, text string, score string, q int")


ITEMS = [(1, "the cat sat on the mat"), (2, None), (3, "..."), (4, ""), (None, "looked DOG yard today tonight"), (5, "w1x1 w2x2 end"),
         (6, "ünïcode 🙂 ß"), (7, "nosuchword"), (1, "the cat sat on the mat"), (1, "tonight")]


@pytest.mark.parametrize("top", [2, 50])
def test_edge_cases_match_brute_force(spark, edge, top):
    docs = [tuple(r) for r in edge.select("doc_id", "text").collect()]
    got = K.search(edge, items_of(spark, ITEMS), top)
    assert result(got) == brute(docs, ITEMS, top)


@pytest.mark.parametrize("query_bytes", [1 << 20, 300])
def test_ties_copies_and_frequent_words(spark, docs_of, monkeypatch, query_bytes):
    monkeypatch.setattr(K, "SHARD_DOCS", 40)
    rnd = random.Random(5)
    vocabulary = [f"w{k}" for k in range(60)]
    odds = [1 / (k + 1) for k in range(60)]
    texts = [" ".join(rnd.choices(vocabulary, odds, k=rnd.randint(0, 40))) for _ in range(300)]
    texts += ["w0 w1 w2 w3"] * 120 + ["w0"] * 100
    docs = [(rnd.randint(0, 400), t, None, None) for t in texts]
    items = [(k, " ".join(rnd.choices(vocabulary, k=rnd.randint(1, 12)))) for k in range(12)] + [(99, "w0"), (98, "w1 w2 w0 w3")]
    got = K.search(docs_of(docs).repartition(20), items_of(spark, items), 10, query_bytes=query_bytes)
    assert result(got) == brute([d[:2] for d in docs], items, 10)


def test_nra_is_the_plain_sum_of_lists():
    import numpy as np
    n = 20_000
    rare = np.arange(60)
    codes = np.concatenate([np.zeros(n, np.int64), np.ones(60, np.int64)])
    doc, tf = np.concatenate([np.arange(n), rare]), np.concatenate([np.ones(n, np.int64), np.full(60, 5)])
    shard = K.Shard(np.full(n, 50), codes, doc, tf, n, 50 * n)
    lists = shard.lists(np.array([0, 1]), np.array([1, 9000]))
    assert [len(d) for d, _ in lists] == [n, 60]
    best, scores = shard.nra(np.array([0, 1]), np.array([1, 9000]), 50, 0)
    total = np.zeros(n, np.int64)
    for d, s in lists:
        total[d] += s
    least = np.sort(total)[-50]
    assert set(best) == set(np.flatnonzero(total >= least)) and (scores == total[best]).all()


def test_the_floor_drops_nothing_that_counts(spark, small):
    docs = small("documents")
    items = [(r.item_id, r.text) for r in small("benchmark").collect()]
    got = result(K.op12_ranked_search(spark, "/root/testdata/sf0.001"))
    assert got == brute([tuple(r) for r in docs.select("doc_id", "text").collect()], items, K.TOP)


def test_string_ids(spark):
    docs = spark.createDataFrame([("b", "cat"), ("a", "cat"), (None, "cat"), ("c", "dog")], "doc_id string, text string")
    items = spark.createDataFrame([("q", "cat")], "item_id string, text string")
    assert [(r.rank, r.doc_id) for r in sorted(K.search(docs, items).collect(), key=lambda r: r.rank)] == [(1, "a"), (2, "b"), (3, None)]


def test_empty(spark, empty, edge):
    assert K.search(empty, items_of(spark, ITEMS)).count() == 0
    assert K.search(edge, items_of(spark, [])).count() == 0
    with pytest.raises(ValueError):
        K.search(edge, items_of(spark, ITEMS), 0)
