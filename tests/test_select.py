import math
import random

import pytest
from pyspark.sql import functions as F

from kindling.operators import select as R
from kindling.operators.summary import feature_summary, order_statistics


def numbers(kind, n=400):
    rnd = random.Random(kind)
    if kind == "continuous":
        return [rnd.gauss(0, 1) * 10 ** rnd.randint(-300, 300) for _ in range(n)]
    if kind == "close":   # equal in all but the lowest bits
        return [1.0 + rnd.randint(0, 50) * 2.0 ** -52 for _ in range(n)]
    if kind == "signed":
        return [rnd.choice([-0.0, 0.0, -1.5, 1.5, math.inf, -math.inf, 5e-324, -5e-324]) for _ in range(n)]
    return [float(rnd.randint(0, 40)) for _ in range(n)]


KINDS = ["continuous", "close", "signed", "whole"]


@pytest.fixture(scope="module")
def mixed(spark):
    rows = [(k, x) for k in KINDS for x in numbers(k)] + [(None, 3.0), (None, None), ("none", None), ("one", 7.25)]
    return spark.createDataFrame(rows, "g string, v double").repartition(6)


def test_every_rank_of_every_group(mixed):
    ranks = {"first": F.lit(0), "mid": F.floor(F.col("n") / 2), "p90": F.floor(F.col("n") * 0.9), "last": F.col("n") - 1, "outside": F.col("n")}
    found, _ = R.ranked_values(mixed, ["g"], "v", ranks)
    got = {(r.g, r.name): r.value for r in found.collect()}
    for k in KINDS:
        s = sorted(numbers(k))
        assert [got[k, x] for x in ("first", "mid", "p90", "last")] == [s[0], s[200], s[360], s[-1]]
    assert got[None, "mid"] == 3.0 and got["one", "last"] == 7.25
    assert not any(name == "outside" or g == "none" for g, name in got)


def test_key_sorts_as_doubles(spark):
    values = [-math.inf, -1e300, -1.0, -5e-324, 0.0, 5e-324, 1.0, 1.0 + 2.0 ** -52, 1e300, math.inf, math.nan]
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, v double")
    keys = [r.key for r in df.select("k", R.sort_key(F.col("v")).alias("key")).orderBy("k").collect()]
    assert keys == sorted(keys) and len(set(keys)) == len(keys)


def test_order_statistics_of_continuous_values(mixed):
    got = {r.g: r for r in order_statistics(mixed, "g", "v").collect()}
    s = sorted(numbers("continuous"))
    assert (got["continuous"].p50, got["continuous"].p95, got["continuous"].p99) == (s[200], s[380], s[396])
    assert got["none"].n == 0 and got["none"].p50 is None and got[None].n == 1


def test_summary_matches_numpy(spark):
    import numpy as np
    x, y = np.array(numbers("close")), np.array(numbers("whole"))
    df = spark.createDataFrame([(float(a), int(b), None) for a, b in zip(x, y)], "x double, y int, z int")
    got = {r.feature: r for r in feature_summary(df, ["x", "y", "z"]).collect()}
    assert "z" not in got
    for name, v in (("x", x), ("y", y)):
        r = got[name]
        assert (r["count"], r.min, r.max) == (400, v.min(), v.max())
        assert (r.p25, r.p50, r.p75) == pytest.approx(tuple(np.percentile(v, [25, 50, 75])), rel=1e-15)
        assert r["mean"] == pytest.approx(v.mean(), rel=1e-14) and r["std"] == pytest.approx(v.std(ddof=1), rel=1e-9)


def test_a_whole_number_feature_is_settled_in_one_aggregate(spark, monkeypatch):
    calls = []
    plain = R.histogram
    monkeypatch.setattr(R, "histogram", lambda *a: calls.append(a[-1]) or plain(*a))
    df = spark.range(1000).select((F.col("id") % 7).cast("double").alias("v"), F.lit("a").alias("g"))
    found, _ = R.ranked_values(df, ["g"], "v", {"mid": F.floor(F.col("n") / 2)})
    assert found.first().value == 3.0 and calls == [48]
