import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from kindling.llm import langid as L

VOCABULARY = {"aa": ["katoma", "tikato", "makoto", "okatim"], "bb": ["brenzel", "wurzen", "blenz", "gruwel"], "cc": ["shiyau", "eouiya", "ayiueo"]}


def rows(n=120, seed=3):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        lang = rnd.choice(sorted(VOCABULARY))
        out.append((i, " ".join(rnd.choices(VOCABULARY[lang], k=rnd.randint(3, 40))).capitalize() + ". 12!", lang, "s"))
    return out


def test_held_out_accuracy_on_driver_rows(small):
    docs = small("documents")
    got = {r.doc_id: r for r in L.identify(docs).collect()}
    held = [(r.lang, got[r.doc_id].lang_pred) for r in docs.collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert len(held) > 20 and sum(a == b for a, b in held) / len(held) >= 0.95
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1


def test_labels_of_the_held_out_fold_are_not_learned(docs_of):
    data = [(i, t, "zz" if zlib.crc32(str(i).encode()) % 5 == 0 else lang, s) for i, t, lang, s in rows()]
    assert "zz" not in {r.lang_pred for r in L.identify(docs_of(data)).collect()}


def test_mixtures_are_recovered(spark, docs_of):
    model = L.learn(docs_of(rows()))
    a, b = VOCABULARY["aa"], VOCABULARY["bb"]
    mixed = [(1, " ".join(a * 15 + b * 5), None, None), (2, " ".join(a * 8), None, None), (3, " ".join(b * 18 + a), None, None)]
    got = {r.doc_id: r for r in L.predict(docs_of(mixed), model).collect()}
    assert got[1].lang_pred == "aa" and abs(got[1].score - 0.75) < 0.02
    assert got[2].lang_pred == "aa" and got[2].score == 1.0
    assert got[3].lang_pred == "bb" and got[3].score > 0.9


def brute_em(like, steps):
    """One document, plainly: like[w][k]."""
    k = len(like[0])
    share = [1 / k] * k
    for _ in range(steps):
        resp = [[s * x for s, x in zip(share, word)] for word in like]
        resp = [[x / sum(r) for x in r] for r in resp]
        share = [sum(r[j] for r in resp) / len(resp) for j in range(k)]
    return share


def test_em_matches_plain_em():
    rng = np.random.default_rng(1)
    like = rng.random((3, 50)).astype(np.float32)
    starts = np.array([0, 20, 21, 50])
    share, fit = L._proportions(like, starts, np.full((3, 3), 1 / 3, np.float32), 5)
    for d, (a, b) in enumerate(zip(starts, starts[1:])):
        want = brute_em(like[:, a:b].T.tolist(), 5)
        assert np.allclose(share[:, d], want, atol=1e-4)
        assert np.isclose(fit[d], np.log(np.array(want) @ like[:, a:b]).sum(), atol=1e-2)


def test_selection_takes_out_languages_that_do_not_pay():
    class W:
        n, codes, starts = 2, np.array([0] * 50 + [0] * 30 + [1] * 20), np.array([0, 50, 100])
        word_of, grams = np.array([0, 1]), np.array([0, 1])
    table = np.log(np.array([[0.9, 0.05], [0.05, 0.9], [0.3, 0.3]], np.float32))
    share = L.mixtures(W, table)
    assert share[:, 0].tolist() == [1, 0, 0]
    assert np.allclose(share[:, 1], [0.6, 0.4, 0], atol=0.05)


def test_edge_cases(edge, empty):
    got = L.identify(edge).collect()
    assert len(got) == edge.count()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    for i in (2, 3, 4):
        assert (by[i][0].lang_pred, by[i][0].score) == ("und", 0.0)
    assert not any(r.held_out for r in by[None])
    assert all(r.lang_pred in ("en", "xx") for r in by[1] + by[5] + by[7])
    assert L.identify(empty).count() == 0
    assert {r.lang_pred for r in L.identify(edge.selectExpr("doc_id", "text", "cast(null as string) lang")).collect()} == {"und"}


def test_stage_keeps_columns_and_clean_documents(docs_of):
    data = rows(60) + [(1000, "12 345 !!!", "aa", "s"), (1001, None, "aa", "s")]
    kept = L.keep_identified(docs_of(data))
    assert kept.columns == docs_of([]).columns
    assert sorted(r.doc_id for r in kept.collect()) == list(range(60))


@pytest.mark.parametrize("text", ["", "   ", "123", "a", "a b", "ß", "İ", "𝒳 x", "x" * 70_000])
def test_words_survive_any_text(docs_of, text):
    model = (["aa"], np.zeros((1, 1 << L.BUCKET_BITS), np.float32))
    got = L.predict(docs_of([(1, text, None, None)]), model).collect()
    assert got[0].lang_pred == ("aa" if any(c.isalpha() for c in text) else "und")


def test_stage_rejects_gibberish_and_unlearned_languages(docs_of):
    rnd = random.Random(5)
    data = rows(200)
    other = [(1000 + k, " ".join("".join(rnd.choices("bcdfghjkpqvxz", k=rnd.randint(4, 9))) for _ in range(30)), None, "s") for k in range(3)]
    other += [(2000 + k, " ".join(rnd.choices(["hrvojed", "pljusnu", "ckvist", "jednym"], k=40)), None, "s") for k in range(3)]
    short = [(3000, "Katoma", None, "s"), (3001, "shiyau brenzel", None, "s")]
    kept = sorted(r.doc_id for r in L.keep_identified(docs_of(data + other + short)).collect())
    assert kept == [*range(200), 3000, 3001]


def test_learned_rows_fit_without_their_own_counts(docs_of):
    labelled = L._labelled(docs_of([(1, "abc abd", "aa", "s"), (2, "abc", "aa", "s"), (3, "xyz", "bb", "s")]), "text", "lang")
    languages, counts = L._counts(labelled, L.BUCKET_BITS)
    rest = L._labelled(docs_of([(2, "abc", "aa", "s"), (3, "xyz", "bb", "s")]), "text", "lang")
    alone = L._counts(rest, L.BUCKET_BITS)[1]

    class Model:
        value = languages, counts.astype(np.float32)

    got = [b.to_pylist() for b in L._learned_fit_batches(labelled.toArrow().to_batches(), Model, L.BUCKET_BITS)]
    got = [r for b in got for r in b]
    words = L._Words(pa.array(["abc abd "]), L.BUCKET_BITS)
    logs = np.log((alone + L.SMOOTHING) / (L._totals(counts) - np.array([[6], [0]])))
    want, n = L.fits(words, logs)
    assert sorted(r["trigrams"] for r in got) == [3, 3, 6]
    assert n[0] == 6 and [r["loglik"] for r in got if r["trigrams"] == 6][0] == pytest.approx(want[0], rel=1e-5)


def test_stage_judges_rows_by_their_own_text(docs_of):
    data = rows(60) + [(None, "12 345", None, "s"), (None, "katoma tikato", None, "s"), (0, "...", None, "s")]
    kept = L.keep_identified(docs_of(data)).collect()
    assert sorted(r.text for r in kept) == sorted(t for _, t, _, _ in rows(60) + [(None, "katoma tikato", None, "s")])


def test_memory_of_a_task_does_not_follow_the_batch():
    """Arrow batches hold up to 10,000 texts; arrays are made for a small part of them at once."""
    import tracemalloc

    class Sent:
        value = (["a", "b", "c", "d"], np.zeros((4, 1 << 10), np.float32))

    text = "".join(f"{chr(97 + k % 26)}{chr(97 + k % 7)} " for k in range(2000))
    batch = pa.RecordBatch.from_arrays([pa.array(range(2000)), pa.array([False] * 2000), pa.array([text] * 2000)], ["a", "b", "c"])
    tracemalloc.start()
    rows = sum(b.num_rows for b in L._predict_batches([batch], Sent, 10, with_fit=True))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == 2000 and peak < 160 << 20
