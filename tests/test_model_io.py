import os

import pytest
from pyspark.sql import functions as F

from kindling.operators import features as fe
from kindling.operators.model import (BaselineRepresentation, fit, load_model, predict_one,
                                      save_model)
from kindling.operators.tfidf import TfidfModel, vocabulary, weights
from kindling.plans import jobs as J
from kindling.streaming.ingest import run_ingestion

TRAIN = [("storm", "a heavy storm took the roof off the school", 1),
         ("storm", "storm surge cuts the island off, boats needed", 1),
         ("quake", "strong quake, people sleep outside tonight", 1),
         (None, "my inbox is an absolute storm of jokes", 0),
         (None, "baking bread and humming along to records", 0),
         (None, "the museum cafe has new cake", 0)]


@pytest.fixture(scope="module")
def tiny(spark):
    df = spark.createDataFrame([(i, k, t, y) for i, (k, t, y) in enumerate(TRAIN)],
                               "id long, keyword string, text string, target int")
    train = fe.build_features(df)
    model = fit(BaselineRepresentation(min_df=1), train)
    return model, train


def test_vocabulary_and_width(spark, tiny):
    model, train = tiny
    terms = model.representation.tfidf.terms
    assert terms == sorted(terms) and "storm" in terms and "heavy storm" in terms
    assert model.representation.width == len(terms) + 5
    w = weights(train, vocabulary(train, "id", min_df=1), "id")
    norms = w.groupBy("id").agg(F.sum(F.col("weight") ** 2).alias("n")).collect()
    assert all(abs(r["n"] - 1) < 1e-9 for r in norms)


def test_out_of_vocabulary_ignored(spark):
    df = spark.createDataFrame([(0, "alpha beta"), (1, "alpha gamma")], "id long, cleaned_text string")
    v = vocabulary(df, "id", min_df=2)
    assert [r["term"] for r in v.collect()] == ["alpha"]
    tm = TfidfModel.from_vocab(v)
    other = spark.createDataFrame([(2, "zzz yyy")], "id long, cleaned_text string")
    assert tm.vectorize(other).first()["tfidf"].numNonzeros() == 0


def test_score_columns_and_optional_keyword(spark, tiny):
    model, _ = tiny
    batch = spark.createDataFrame([(1, "storm over the island"), (2, "new cake")],
                                  "id long, text string")
    out = model.score(batch)
    assert out.columns == ["id", "text", "probability", "label"]
    rows = out.collect()
    assert all(0 <= r["probability"] <= 1 and r["label"] == int(r["probability"] >= 0.5) for r in rows)


def test_predict_one_and_persistence(spark, tiny, tmp_dir):
    model, _ = tiny
    one = predict_one(spark, model, "heavy storm by the school", "storm")
    assert set(one) == {"label", "probability"}
    path = os.path.join(tmp_dir, "m")
    save_model(spark, model, path)
    again = predict_one(spark, load_model(spark, path), "heavy storm by the school", "storm")
    assert abs(again["probability"] - one["probability"]) < 1e-12


def test_missing_model_raises(spark, tmp_dir):
    with pytest.raises(FileNotFoundError, match="train"):
        load_model(spark, os.path.join(tmp_dir, "nope"))


def _write(path, text):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_ingest_scores_moves_skips_and_is_idempotent(spark, tiny, tmp_dir):
    model, _ = tiny
    inc, proc, tri, ck = (os.path.join(tmp_dir, d) for d in ("incoming", "processed", "triaged", "ck"))
    os.makedirs(inc)
    _write(os.path.join(inc, "batch_a.csv"),
           'id,keyword,text\n1,fire,"storm surge,\nrising"\n2,,new cake\n')
    _write(os.path.join(inc, "batch_b.csv"), 'text,id\n"reordered ""quoted"" text",7\n')
    _write(os.path.join(inc, "bad.csv"), "not_text\nhello\n")
    done = run_ingestion(spark, inc, tri, ck, model, processed_dir=proc)
    assert [(d["source_file"], d["n"]) for d in done] == [("batch_a", 2), ("batch_b", 1)]
    out = spark.read.option("header", "true").option("multiLine", "true").option("escape", '"').csv(tri)
    rows = {r["id"]: r for r in out.collect()}
    assert set(rows) == {"1", "2", "7"}
    assert rows["1"]["text"] == "storm surge,\nrising"
    assert rows["7"]["text"] == 'reordered "quoted" text'
    assert sorted(os.listdir(proc)) == ["batch_a.csv", "batch_b.csv"]
    assert os.path.exists(os.path.join(inc, "bad.csv"))
    rejects = spark.read.parquet(tri + "_rejects").collect()
    assert len(rejects) == 1 and rejects[0]["source_file"].endswith("bad.csv")
    assert run_ingestion(spark, inc, tri, ck, model, processed_dir=proc) == []     # nothing new
    again = spark.read.option("header", "true").option("multiLine", "true").option("escape", '"').csv(tri)
    assert again.count() == 3


def test_a_replayed_batch_changes_nothing(spark, tiny, tmp_dir):
    from kindling.streaming.ingest import _move, make_batch_writer, move_consumed
    model, _ = tiny
    inc, tri, proc = (os.path.join(tmp_dir, d) for d in ("in", "tri", "proc"))
    os.makedirs(inc)
    _write(os.path.join(inc, "a.csv"), "id,text\nabc,new cake\n2\n")
    _write(os.path.join(inc, "b.csv"), "nothing\n1\n")
    batch = spark.createDataFrame([(os.path.join(inc, f),) for f in ("a.csv", "b.csv")], "path string")
    process = make_batch_writer(model, tri, tri + "_rejects", tri + "_summary")

    def outputs():
        return (sorted(map(tuple, spark.read.parquet(tri + "_rejects").collect()), key=repr),
                [(r["source_file"], r["n"]) for r in spark.read.parquet(tri + "_summary").collect()],
                [r["id"] for r in spark.read.option("header", "true").csv(tri).collect()])

    process(batch, 0)
    first = outputs()
    assert len(first[0]) == 2 and first[1] == [("a", 1)] and first[2] == ["abc"]
    process(batch, 0)                                     # failed before its commit: nothing has moved
    assert outputs() == first
    move_consumed(spark, tri, proc, {0})
    assert os.listdir(proc) == ["a.csv"] and os.path.exists(os.path.join(inc, "b.csv"))
    move_consumed(spark, tri, proc, {0})                  # already moved
    _write(os.path.join(proc, "z.csv"), "x")
    _move(spark, os.path.join(inc, "gone.csv"), proc)
    assert outputs() == first


def _splits(spark):
    rows = [(i, None, t, y, s) for i, (t, y, s) in enumerate([
        ("storm hits the coast hard", 1, "train"), ("crews clear the coast road after the storm", 1, "train"),
        ("quake shakes the town", 1, "train"), ("town hall cracked by the quake", 1, "train"),
        ("warm bread from the oven", 0, "train"), ("old records are back", 0, "train"),
        ("bread and records at home", 0, "train"), ("home baked cake", 0, "train"),
        ("storm moves to town", 1, "val"), ("cake and records", 0, "val"),
        ("quake near the coast", 1, "test"), ("home with warm bread", 0, "test")])]
    df = spark.createDataFrame(rows, "id long, keyword string, text string, target int, split string")
    return fe.build_features(df)


def _retrain(spark, base, batches):
    return J.retrain_cycle(spark, _splits(spark), batches, f"{base}/models/b", f"{base}/metrics/b",
                           f"{base}/archive", f"{base}/cand")


def _publish(base, f1):
    """Current metrics as an indented document in a file."""
    import json
    import shutil
    path = f"{base}/metrics/b"
    if os.path.isdir(path):
        shutil.rmtree(path)
    with open(path, "w") as f:
        json.dump({"val": {"f1": 0.5}, "test": {"f1": f1}}, f, indent=2)


def test_retrain_promote_keep_archive(spark, tmp_dir):
    from kindling.operators.model import current_version
    new = spark.createDataFrame([(100, None, "storm hits the coast hard", 0), (101, None, "a new text", 1)],
                                "id long, keyword string, text string, target int")
    base = os.path.join(tmp_dir, "r")
    s1, _ = _retrain(spark, base, [new])                 # no current metrics -> promote
    assert s1["promoted"] and s1["current_f1"] is None
    assert (s1["n_train"], s1["n_new"], s1["n_pool"]) == (8, 2, 8)     # a tie drops one text, one is new
    assert current_version(spark, f"{base}/models/b") == s1["version"]
    load_model(spark, f"{base}/models/b")
    _publish(base, 0.999)
    s2, _ = _retrain(spark, base, [new])
    assert not s2["promoted"] and os.listdir(f"{base}/cand") and not os.path.exists(f"{base}/archive")
    assert current_version(spark, f"{base}/models/b") == s1["version"]
    _publish(base, 0.0)
    s3, _ = _retrain(spark, base, [new])
    assert s3["promoted"] == (s3["new_f1"] >= 0.01) and s3["promoted"]
    assert current_version(spark, f"{base}/models/b") == s3["version"] != s1["version"]
    assert os.listdir(f"{base}/archive/models") and os.listdir(f"{base}/archive/metrics")
    load_model(spark, f"{base}/archive/models/" + os.listdir(f"{base}/archive/models")[0])
    _publish(base, None)
    with pytest.raises(ValueError):                      # unreadable metrics don't open the gate
        _retrain(spark, base, [new])


def test_a_cycle_counts_on_the_way_and_may_keep_its_pool(spark, tmp_dir, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    plain = DataFrame.count

    def no_count(self):
        assert "text" not in self.columns, "a job that only counts messages"
        return plain(self)
    monkeypatch.setattr(DataFrame, "count", no_count)
    new = spark.createDataFrame([(100, None, "storm hits the coast hard", 0), (101, None, "a new text", 1)],
                                "id long, keyword string, text string, target int")
    found = []
    for name, more in (("a", {}), ("b", {"pool_path": os.path.join(tmp_dir, "pool")})):
        base = os.path.join(tmp_dir, name)
        s, m = J.retrain_cycle(spark, _splits(spark), [new], f"{base}/models/b", f"{base}/metrics/b", f"{base}/archive", f"{base}/cand", **more)
        assert (s["n_train"], s["n_new"], s["n_pool"]) == (8, 2, 8)
        found.append(sorted((r["split"], r["metric"], round(r["value"], 9)) for r in m.collect()))
    assert found[0] == found[1]


def test_expanded_train_tie_drops_text(spark):
    from kindling.operators.retrain import expanded_train
    train = spark.createDataFrame([(1, "a text", 1), (2, "b text", 0)], "id long, text string, target int")
    new = spark.createDataFrame([(9, "a text", 0), (10, "c text", 1)], "id long, text string, target int")
    assert expanded_train(train, []).count() == 2
    out = {r["text"]: r["target"] for r in expanded_train(train, [new]).collect()}
    assert out == {"b text": 0, "c text": 1}


def test_streaming_prediction_log(spark, tiny, tmp_dir):
    from kindling.streaming.prediction_log import read_log, start_log_stream
    model, _ = tiny
    req = os.path.join(tmp_dir, "requests")
    spark.createDataFrame([(1, "storm surge", "storm"), (2, "new cake", None)],
                          "id long, text string, keyword string").write.parquet(req)
    stream = spark.readStream.schema("id long, text string, keyword string").parquet(req)
    q = start_log_stream(model.score(stream), os.path.join(tmp_dir, "log"),
                         os.path.join(tmp_dir, "ck"), "baseline_tfidf")
    q.awaitTermination()
    log = read_log(spark, os.path.join(tmp_dir, "log")).collect()
    assert len(log) == 2 and all(r["model_name"] == "baseline_tfidf" and r["timestamp"] for r in log)


def test_candidate_representation(spark):
    from kindling.operators.model import CandidateRepresentation
    rows = [(i, f"text {i}", [float(i % 3), 1.0, 0.0] if i % 5 else [0.0, 0.0, 0.0], i % 2)
            for i in range(20)]
    df = fe.build_features(spark.createDataFrame(
        rows, "id long, text string, embedding array<float>, target int"))
    model = fit(CandidateRepresentation(), df)
    out = model.score(df)
    assert out.count() == 20 and "probability" in out.columns
    v = model.representation.transform(df).select("features").first()["features"]
    assert v.size == 3 + 5


def test_expanded_train_holdout_exclusion(spark):
    from kindling.operators.retrain import expanded_train
    train = spark.createDataFrame([(1, "a text", 1)], "id long, text string, target int")
    new = spark.createDataFrame([(9, "held out", 0), (10, "fresh", 1)], "id long, text string, target int")
    hold = spark.createDataFrame([(5, "held out", 1)], "id long, text string, target int")
    assert {r["text"] for r in expanded_train(train, [new]).collect()} == {"a text", "held out", "fresh"}
    assert {r["text"] for r in expanded_train(train, [new], holdout=hold).collect()} == {"a text", "fresh"}
