import random

import pytest
import xxhash

from kindling.llm import simhash as S


def brute_fp(text, shingle=4):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[k:k + shingle]) for k in range(max(1, len(words) - shingle + 1))]
    hs = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(fps, ids, k):
    group = list(range(len(fps)))

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= k:
                group[root(i)] = root(j)
    least = {}
    for i, d in enumerate(ids):
        r = root(i)
        known = [x for x in (least.get(r), d) if x is not None]
        least[r] = min(known) if known else None
    return [least[root(i)] for i in range(len(fps))]


def test_edge_cases_match_brute_force(spark, edge):
    got = S.near_duplicates(edge).collect()
    rows = edge.select("doc_id", "text").collect()
    fps = [brute_fp(r.text) for r in rows]
    want = sorted((str(r.doc_id), f"{f:016x}", c) for r, f, c in zip(rows, fps, brute_components(fps, [r.doc_id for r in rows], 4)))
    assert sorted((str(g.doc_id), f"{g.fp & (2**64 - 1):016x}", g.component_id) for g in got) == want


def test_spark_hash_is_the_contract_hash(spark):
    from pyspark.sql import functions as F
    assert spark.range(1).select(F.xxhash64(F.lit("a b c d"))).first()[0] & (2**64 - 1) == xxhash.xxh64_intdigest(b"a b c d", 42)


@pytest.mark.parametrize("chain,cap,max_bits", [(2, 256, 4), (3, 256, 4), (2, 1, 4), (2, 2, 3), (1, 3, 2), (2, 256, 0)])
def test_links_connect_what_brute_force_connects(spark, chain, cap, max_bits):
    rnd = random.Random(chain * 10 + max_bits)
    fps = [rnd.getrandbits(64) for _ in range(30)]
    for _ in range(120):
        x = rnd.choice(fps)
        for b in rnd.sample(range(64), rnd.randint(1, 6)):
            x ^= 1 << b
        fps.append(x)
    fps = sorted(set(fps))
    df = spark.createDataFrame([(S._signed(f),) for f in fps], "fp long")
    links = S.links(df, max_bits=max_bits, pair_cap=cap, chain=min(chain, max_bits + 1))
    from kindling.llm.common import connected_components
    got = {r.node: r.component for r in connected_components(links).collect()}
    signed = [S._signed(f) for f in fps]
    want = brute_components(fps, signed, max_bits)
    classes = {}
    for s, w in zip(signed, want):
        classes.setdefault(w, []).append(s)
    for members in classes.values():
        assert {got.get(m, m) for m in members} == {min(members)}


def test_empty(spark, empty):
    assert S.near_duplicates(empty).count() == 0
    assert S.keep_one(empty).columns == empty.columns


def test_keep_one_keeps_columns_and_smallest(spark, docs_of):
    t = "one two three four five six seven eight nine ten eleven twelve"
    docs = docs_of([(9, t, "en", "s"), (3, t, "en", "s"), (5, t.upper(), "en", "s"), (7, "something quite different it is said here", "en", "s")])
    kept = S.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [3, 7]


def test_long_chain_component(spark):
    from kindling.llm.common import connected_components
    edges = spark.range(200).selectExpr("id as u", "id + 1 as v")
    assert connected_components(edges).select("component").distinct().collect()[0][0] == 0


def test_keep_one_keeps_one_row_of_each_component(docs_of):
    a, b, c = (" ".join(f"{t}{k}" for k in range(60)) for t in "abc")
    rows = [(None, a, "en", "s"), (4, a, "en", "s"), (None, b, "en", "s"), (None, b, "en", "s"),
            (7, c, "en", "s"), (7, c, "en", "s"), (7, c, "en", "t"), (8, c, "en", "s"), (7, b + " d e f", "en", "s")]
    got = [sorted((r.doc_id or 0, r.text[:1], r.source) for r in S.keep_one(docs_of(x)).collect()) for x in (rows[:8], rows[7::-1])]
    assert got[0] == got[1]
    assert [x[:2] for x in got[0]] == [(0, "b"), (4, "a"), (7, "c")]
