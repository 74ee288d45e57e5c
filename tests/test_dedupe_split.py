from kindling.operators import features as fe
from kindling.operators.dedupe import dedupe_labels
from kindling.operators.split import split_sizes, stratified_split


def _df(spark, texts, targets):
    return spark.createDataFrame(list(zip(range(len(texts)), texts, targets)),
                                 "id long, text string, target int")


def test_majority_vote_resolves_conflict(spark):
    out = dedupe_labels(_df(spark, ["same", "same", "same", "unique"], [1, 1, 0, 0]), "id")
    rows = {r["text"]: r["target"] for r in out.collect()}
    assert rows == {"same": 1, "unique": 0}


def test_exact_ties_are_dropped(spark):
    out = dedupe_labels(_df(spark, ["tied", "tied", "unique"], [1, 0, 0]), "id")
    assert [r["text"] for r in out.collect()] == ["unique"]


def test_no_duplicates_is_noop(spark):
    out = dedupe_labels(_df(spark, ["a", "b", "c"], [1, 0, 1]), "id")
    assert out.count() == 3 and {r["target"] for r in out.collect()} == {0, 1}


def test_first_row_wins_and_nulls(spark):
    df = spark.createDataFrame(
        [(5, "k1", "x", None), (3, "k0", "x", 1), (9, "k2", "x", 1), (1, None, None, 1),
         (2, "a", "only-null", None), (4, "b", "only-null", None)],
        "id long, keyword string, text string, target int")
    out = {r["text"]: r for r in dedupe_labels(df, "id").collect()}
    assert set(out) == {"x"}                 # null text and null-only votes are dropped
    assert out["x"]["id"] == 3 and out["x"]["keyword"] == "k0" and out["x"]["target"] == 1


def test_clean_and_featurize_pipeline(spark):
    df = spark.createDataFrame([(1, "fire", "duplicate text", 1), (2, "fire", "duplicate text", 1),
                                (3, None, "other text", 0)],
                               "id long, keyword string, text string, target int")
    out = fe.clean_and_featurize(df, order_col="id")
    assert out.count() == 2
    assert {"cleaned_text", "word_count", "has_keyword"} <= set(out.columns)


def test_split_sizes_goldens():
    s = split_sizes({0: 4302, 1: 3191})
    assert sum(v[0] for v in s.values()) == 1124 and s[1][0] == 479      # test
    assert sum(v[1] for v in s.values()) == 1124 and s[1][1] == 479      # val
    assert sum(v[2] for v in s.values()) == 5245 and s[1][2] == 2233     # train
    s2 = split_sizes({1: 400, 0: 600})
    assert sum(v[0] for v in s2.values()) == 150 and sum(v[1] for v in s2.values()) == 150


def _toy(spark, n=1000, rate=0.4):
    npos = int(n * rate)
    return spark.createDataFrame([(i, f"tweet {i}", 1 if i < npos else 0) for i in range(n)],
                                 "id long, text string, target int")


def test_split_sizes_disjoint_balance_determinism(spark):
    df = _toy(spark)
    a = stratified_split(df, "id").toPandas()
    assert len(a) == 1000 and a["id"].is_unique
    sizes = a["split"].value_counts().to_dict()
    assert sizes == {"train": 700, "val": 150, "test": 150}
    for _, g in a.groupby("split"):
        assert abs(g["target"].mean() - 0.4) < 0.03
    b = stratified_split(df, "id").toPandas()
    assert a.sort_values("id")["split"].tolist() == b.sort_values("id")["split"].tolist()


def test_split_matches_rank_restatement(spark):
    import hashlib
    df = _toy(spark, n=500, rate=0.3)
    got = stratified_split(df, "id", hex_digits=1).toPandas().set_index("id")["split"]
    pdf = df.toPandas()
    pdf["h"] = [hashlib.md5(f"42:{i}".encode()).hexdigest() for i in pdf["id"]]
    sizes = split_sizes(pdf["target"].value_counts().to_dict())
    exp = {}
    for t, g in pdf.sort_values(["h", "id"]).groupby("target"):
        nt, nv, _ = sizes[t]
        for r, i in enumerate(g["id"], start=1):
            exp[i] = "test" if r <= nt else ("val" if r <= nt + nv else "train")
    assert got.to_dict() == exp


def test_split_keeps_rows_with_null_ids_and_targets(spark):
    rows = [(i if i % 10 else None, f"t{i}", None if i % 7 == 0 else i % 2) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, text string, target int")
    got = stratified_split(df, "id", hex_digits=1).toPandas()
    assert len(got) == 200 and got["split"].value_counts().to_dict() == {"train": 139, "val": 31, "test": 30}


def test_split_sizes_in_sql_match_the_rule(spark):
    from kindling.operators.split import class_cuts
    for counts in ({0: 4302, 1: 3191}, {0: 1, 1: 1, 2: 1}, {0: 7}, {0: 10, 1: 0, 2: 33, 3: 999}):
        df = spark.createDataFrame(list(counts.items()), "target int, _c long")
        got = {r["target"]: (r["_cut1"], r["_cut2"]) for r in class_cuts(df, "target", .15, .15).collect()}
        assert got == {k: (t, t + v) for k, (t, v, _) in split_sizes(counts).items()}


def test_null_order_and_many_targets(spark):
    df = spark.createDataFrame([(None, "x", 1), (4, "x", 1), (None, "y", 0)] + [(i, "z", i) for i in range(9, 30)],
                               "id long, text string, target int")
    out = {r["text"]: r for r in dedupe_labels(df, "id").collect()}
    assert out["x"]["id"] == 4 and out["y"]["id"] is None and out["y"]["text"] == "y" and "z" not in out


def test_dedupe_counts(spark):
    from kindling.operators.dedupe import dedupe_counts
    df = _df(spark, ["a", "a", "b", "b", None], [1, 1, 0, 1, 1])
    assert {r["stage"]: r["n"] for r in dedupe_counts(df, "id").collect()} == {
        "raw": 5, "distinct_texts": 2, "deduped": 1, "dropped": 1}
