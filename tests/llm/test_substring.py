import random

import pytest
from pyspark.sql import functions as F

from kindling.llm import substring as S

LAST = 1 << 62


def brute(rows, window=13):
    first = {}
    docs = [(LAST if i is None else i, i, (t or "").encode().split()) for i, t in rows]
    for key, _, w in docs:
        for k in range(len(w) - window + 1):
            g = tuple(w[k:k + window])
            first[g] = min(first.get(g, LAST), key)
    out = []
    for key, i, w in docs:
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if first[tuple(w[k:k + window])] < key:
                gone[k:k + window] = [True] * window
        out.append((i, len(w), sum(gone), b" ".join(a for a, g in zip(w, gone) if not g).decode()))
    return sorted(out, key=repr)


def result(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in df.collect()), key=repr)


@pytest.mark.parametrize("shard_words", [40, 1000, 1_000_000])
def test_edge_cases_match_brute_force(edge, shard_words):
    rows = [tuple(r) for r in edge.select("doc_id", "text").collect()]
    assert result(S.remove_repeats(edge, shard_words=shard_words)) == brute(rows)


@pytest.mark.parametrize("seed,shard_words", [(1, 60), (2, 500)])
def test_random_repeats_match_brute_force(docs_of, seed, shard_words, monkeypatch):
    monkeypatch.setattr(S, "RANGE_BYTES", 300)
    rnd = random.Random(seed)
    passages = [[rnd.choice("abcde") + str(rnd.randint(0, 9)) for _ in range(rnd.randint(10, 40))] for _ in range(8)]
    rows = []
    for i in rnd.sample(range(1000), 80):
        words = []
        for _ in range(rnd.randint(0, 4)):
            words += rnd.choice(passages)[rnd.randint(0, 5):] if rnd.random() < 0.6 else [rnd.choice("xyz")] * rnd.randint(1, 20)
        rows.append((i, " ".join(words), "en", "s"))
    want = brute([r[:2] for r in rows])
    assert sum(w[2] for w in want) > 100
    assert result(S.remove_repeats(docs_of(rows), shard_words=shard_words)) == want


def test_a_passage_inside_one_document_stays(docs_of):
    t = " ".join(f"w{k}" for k in range(20))
    got = result(S.remove_repeats(docs_of([(1, f"{t} {t}", "en", "s")])))
    assert got == [(1, 40, 0, f"{t} {t}")]


def test_empty(empty):
    assert S.remove_repeats(empty).count() == 0


def test_shards_are_read_without_a_shuffle(edge):
    plan = S.remove_repeats(edge)._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan or "BroadcastHashJoin" in plan
    assert S.remove_repeats(edge).agg(F.sum("n_words")).first()[0] > 120_000


def test_the_automaton_decides(monkeypatch):
    """What goes is what the automaton locates: with one that finds nothing, nothing goes."""
    import numpy as np
    import zstandard
    passage = " ".join(f"p{k}" for k in range(30))
    lines = [f"own{k} other{k} {passage} tail{k}".encode() + b"\n" for k in range(3)]
    shard = S._Shard([5, 3, 9], zstandard.ZstdCompressor().compress(b"".join(lines)), 13)
    gone = S._locate(shard, shard.many, shard.least, 13)
    assert np.diff(np.concatenate(([0], np.cumsum(gone)))[shard.starts]).tolist() == [0, 30, 30]   # of 3, 5, 9
    earlier = np.minimum(shard.least, 1)   # another shard has all of it under a smaller doc_id
    assert S._locate(shard, shard.many, earlier, 13).sum() == 90

    class Blind:
        def __init__(self, *a): pass
        def add_word(self, *a): pass
        def make_automaton(self): pass
        def iter(self, text): return iter(())
    monkeypatch.setattr(S.ahocorasick, "Automaton", Blind)
    assert not S._locate(shard, shard.many, shard.least, 13).any()


def test_the_shards_table_leaves_the_catalog(spark, docs_of):
    from kindling.session import clean_up
    S.remove_repeats(docs_of([(1, "a b c", "en", "s")])).collect()
    assert any(t.name.startswith("repeat_shards_") for t in spark.catalog.listTables())
    clean_up(spark)
    assert not any(t.name.startswith("repeat_shards_") for t in spark.catalog.listTables())
