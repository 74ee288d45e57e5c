import random

import numpy as np
import pytest

from kindling.llm import decontam as D


def brute(docs, items, window=10):
    found = {}
    for i, t in items:
        w = D.text_words(t).split()
        for k in range(max(1, len(w) - window + 1) if w else 0):
            found.setdefault(tuple(w[k:k + window]), set()).add("null" if i is None else str(i))
    out = []
    for i, t in docs:
        w, covered, names = D.text_words(t).split(), set(), set()
        for size in {len(f) for f in found}:
            for k in range(len(w) - size + 1):
                hit = found.get(tuple(w[k:k + size]))
                if hit:
                    covered.update(range(k, k + size))
                    names |= hit
        out.append((i, len(w), len(covered), tuple(sorted(names))))
    return sorted(out, key=repr)


def result(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in df.collect()), key=repr)


ITEMS = [(1, "The CAT sat, on the mat and looked at the dog in the yard"), (10, "dog in the"), (2, None), (3, "..."), (4, ""),
         (None, "looked at the dog"), (1, "w1x1 w2x2 w3x3"), (5, "üNÏCODE"), (6, "no such words anywhere to be found in this corpus of mine at all")]


def items_of(spark):
    return spark.createDataFrame([(*i, "x") for i in ITEMS], "item_id long, text string, window string")


@pytest.mark.parametrize("shard_words,block", [(30, 3), (1_000_000, 200_000)])
def test_edge_cases_match_brute_force(spark, edge, shard_words, block):
    rows = [tuple(r) for r in edge.select("doc_id", "text").collect()]
    got = D.find_hits(edge, items_of(spark), shard_words=shard_words, block=block)
    want = brute(rows, ITEMS)
    assert sum(w[2] for w in want) > 50
    assert result(got) == want
    for r in got.collect():
        assert sum(s.stop - s.start for s in r.spans) == r.n_hit
        assert all(a.stop < b.start for a, b in zip(r.spans, r.spans[1:]))


def test_small_tables_match_brute_force(small):
    docs, bench = small("documents"), small("benchmark")
    assert result(D.find_hits(docs, bench)) == brute([tuple(r) for r in docs.select("doc_id", "text").collect()],
                                                     [tuple(r) for r in bench.collect()])


def test_words_are_ascii_lower_cased():
    assert D.text_words("Ab-C9 É_z\x7fÜ`~") == "ab c9 É z Ü ".encode()


def test_empty_tables(spark, edge, empty):
    assert D.find_hits(empty, items_of(spark)).count() == 0
    none = spark.createDataFrame([], "item_id long, text string")
    assert {r.n_hit for r in D.find_hits(edge, none).collect()} == {0}
    assert D.drop_contaminated(edge, none).count() == edge.count()


def test_drop_contaminated(spark, edge):
    kept = D.drop_contaminated(edge, items_of(spark))
    assert kept.columns == edge.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["2", "3", "4", "7"]


@pytest.mark.parametrize("seed", range(6))
def test_index_finds_and_locates_everything(seed):
    rnd = np.random.default_rng(seed)
    sigma = int(rnd.choice([4, 5, 30, 300]))
    ids = np.concatenate((rnd.integers(1, sigma, int(rnd.integers(1, 400))), np.full(int(rnd.integers(0, 90)), 2), [0]))
    index = D.FMIndex(ids, sigma, every=int(rnd.choice([1, 4, 16])))
    order = D.suffix_array(ids, 3)
    assert [tuple(ids[k:]) for k in order] == sorted(tuple(ids[k:]) for k in range(len(ids))) or sigma > 8
    for size in (1, 2, 3, 7):
        phrases = rnd.integers(1, sigma, (40, size))
        low, high = index.search(phrases)
        for p, a, b in zip(phrases, low, high):
            want = [k for k in range(len(ids) - size + 1) if (ids[k:k + size] == p).all()]
            assert sorted(index.locate(np.arange(a, max(a, b))).tolist()) == want


def test_suffix_array_of_one_word_repeated():
    ids = np.append(np.full(5000, 3), 0)
    assert D.suffix_array(ids, 2).tolist() == list(range(5000, -1, -1))


def test_random_passages(docs_of, spark):
    rnd = random.Random(5)
    vocabulary = [f"t{k}" for k in range(60)]
    items = [(k, " ".join(rnd.choices(vocabulary, k=rnd.randint(3, 30)))) for k in range(12)]
    rows = []
    for i in range(60):
        parts = [" ".join(rnd.choices(vocabulary, k=rnd.randint(1, 30))) for _ in range(3)]
        if i % 3:
            parts.insert(rnd.randint(0, 3), rnd.choice(items)[1])
        rows.append((i, " ".join(parts), "en", "s"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert result(D.find_hits(docs_of(rows), bench, shard_words=200)) == brute([r[:2] for r in rows], items)


def test_rows_are_judged_by_their_own_text(spark, docs_of):
    bad = " ".join(f"q{k}" for k in range(12))
    bench = spark.createDataFrame([(1, bad)], "item_id long, text string")
    rows = [(None, bad, "en", "s"), (None, "clean", "en", "s"), (None, None, "en", "s"), (1, bad, "en", "s"), (1, "other", "en", "s")]
    kept = D.drop_contaminated_rows(docs_of(rows), bench).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in kept) == [(0, ""), (0, "clean"), (1, "other")]
