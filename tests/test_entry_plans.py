"""Driver contract and plan assertions (scale properties)."""
import __spark_entry__ as E
from tests.conftest import SF001


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() == 3 and "f1" in df.columns


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_features_stay_in_jvm(spark):
    from kindling.plans import queries as q
    plan = _plan(q.Q["word_count"](spark, SF001))
    assert "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan
    plan = _plan(q.Q["clean_text"](spark, SF001))
    assert "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan


def test_scan_is_pruned(spark):
    from kindling.operators.summary import value_counts
    from kindling.plans import views as V
    plan = _plan(value_counts(V.lat(spark, SF001), ["event_type"]))
    schema = plan.split("ReadSchema: ")[1].split("\n")[0]
    assert "value:double" in schema and "event_type:string" in schema
    for unused in ("props", "user_id", "ts:"):
        assert unused not in schema
    assert "PushedFilters: [IsNotNull(value)]" in plan


def test_terms_are_counted_without_an_exchange(spark):
    from kindling.operators.tfidf import term_counts
    docs = spark.range(100).selectExpr("id", "concat('some words ', id) AS cleaned_text")
    assert "Exchange" not in _plan(term_counts(docs, "id"))


def test_no_large_single_partition_exchange(spark):
    """Single-partition exchanges hold one row per class, source or check only."""
    from kindling.plans import queries as q
    for name in ("clean_and_featurize", "dedupe_labels", "stratified_split", "ngrams", "score_fixed_weights", "expanded_train"):
        assert "SinglePartition" not in _plan(q.Q[name](spark, SF001)), name


def test_texts_are_not_compared_in_sorts(spark):
    from kindling.plans import queries as q
    plan = _plan(q.Q["dedupe_labels"](spark, SF001))
    keys = [line for line in plan.split("\n") if "hashpartitioning" in line]
    assert keys and not any("hashpartitioning(text" in line for line in keys)


def test_dedupe_uses_partial_aggregation(spark):
    from kindling.plans import queries as q
    plan = _plan(q.Q["dedupe_labels"](spark, SF001))
    assert "partial_min_by" in plan or "partial_count" in plan


def test_spread_only_when_under_partitioned(spark):
    from kindling.sources.tables import spread
    want = spark.sparkContext.defaultParallelism
    one = spark.range(100).coalesce(1)
    assert spread(one, "id").rdd.getNumPartitions() == want
    many = spark.range(0, 100, 1, want + 2)
    assert spread(many, "id") is many
