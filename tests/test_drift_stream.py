import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from kindling import config as C
from kindling.operators.drift import drift_report
from kindling.operators.metrics import compare, verdict
from kindling.plans import jobs as J
from kindling.sources.commit_log import CommitLog
from kindling.sources.files import append_report, read_reports
from kindling.streaming import drift_stream as D

COLUMNS = "word_count int, has_url int, hashtag_count int, mention_count int, has_keyword int, {} int"


def rows(seed, n, shift=0):
    rnd = random.Random(seed)
    return [(rnd.randint(0, 30) + shift, rnd.randint(0, 1), rnd.randint(0, 3), rnd.choice([0, 0, 2, None]), rnd.randint(0, 1), rnd.randint(0, 1))
            for _ in range(n)]


@pytest.fixture(scope="module")
def reference(spark):
    return spark.createDataFrame(rows(1, 120), COLUMNS.format("target"))


def report(df):
    return sorted(((r.check, r.test, r.statistic, r.p_value, r.reference_rate, r.current_rate, r.diff, r.flagged, r.n_reference, r.n_current, r.any_drift)
                   for r in df.collect()), key=lambda r: r[0])


def drop(spark, folder, name, data, schema):
    spark.createDataFrame(data, schema).coalesce(1).write.parquet(os.path.join(folder, name))


def test_report_after_every_run_equals_the_batch_report(spark, reference, tmp_dir):
    inc, out, ck = (os.path.join(tmp_dir, d) for d in ("in", "out", "ck"))
    schema = COLUMNS.format("label")
    seen = []
    for k in range(3):
        new = rows(10 + k, 25, shift=4 * k)
        seen += new
        drop(spark, inc, f"b{k}", new, schema)
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(inc)
        D.start_drift(stream, reference, out, ck).awaitTermination()
        want = drift_report(reference, spark.createDataFrame(seen, schema))
        got = D.latest_reports(spark, out)
        assert report(got) == report(want) and got.count() == 6
    assert read_reports(spark, f"{out}/reports").select("report_id").distinct().count() == 3
    before = sorted(map(str, read_reports(spark, f"{out}/reports").collect()))
    # a replay of the last micro-batch changes nothing
    last = CommitLog(spark, f"{out}/commits").numbers()[-1]
    counts = spark.read.schema(D.COUNTS).parquet(f"{out}/counts/batch_id={last}").collect()
    D.make_report_writer(out)(spark.createDataFrame(counts, D.COUNTS), last)
    assert sorted(map(str, read_reports(spark, f"{out}/reports").collect())) == before
    assert report(D.latest_reports(spark, out)) == report(drift_report(reference, spark.createDataFrame(seen, schema)))


def test_windows_have_reports_of_their_own(spark, reference, tmp_dir):
    inc, out, ck = (os.path.join(tmp_dir, d) for d in ("in", "out", "ck"))
    schema = COLUMNS.format("label") + ", at timestamp"
    at = lambda h: dt.datetime(2024, 5, 1, h, 30)
    by = {1: rows(5, 40), 2: rows(6, 35, shift=20)}
    drop(spark, inc, "a", [(*r, at(1)) for r in by[1]] + [(*r, at(2)) for r in by[2][:5]], schema)
    drop(spark, inc, "b", [(*r, at(2)) for r in by[2][5:]], schema)
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(inc)
    D.start_drift(stream, reference, out, ck, time_col="at").awaitTermination()
    got = D.latest_reports(spark, out)
    assert got.select("win").distinct().count() == 2
    for h in (1, 2):
        want = drift_report(reference, spark.createDataFrame(by[h], COLUMNS.format("label")))
        assert report(got.where(F.col("win").contains(f"T0{h}"))) == report(want)


def test_reports_are_kept_together(spark, reference, tmp_dir):
    table = os.path.join(tmp_dir, "reports")
    batch = spark.createDataFrame(rows(3, 40), COLUMNS.format("label"))
    J.monitor_job(reference, batch, report_table=table)
    J.monitor_job(reference, batch.limit(20), report_table=table)
    kept = read_reports(spark, table)
    assert kept.count() == 12 and kept.select("report_id").distinct().count() == 2 and kept.where("report_time IS NULL").isEmpty()
    append_report(drift_report(reference, batch), table, "again", "2024-01-01T00:00:00Z")
    append_report(drift_report(reference, batch), table, "again", "2024-01-01T00:00:00Z")
    assert read_reports(spark, table).where("report_id = 'again'").count() == 6


def test_a_missing_metric_is_an_error(spark):
    long = lambda *r: spark.createDataFrame(r, "split string, metric string, value double")
    full = long(("test", "f1", 0.5), ("test", "recall", None))
    assert compare(full, full).count() == 2 and verdict(compare(full, full)).first().verdict == "KEEP baseline"
    with pytest.raises(Exception, match="candidate metrics lack test.recall"):
        compare(full, long(("test", "f1", 0.5))).collect()
    with pytest.raises(Exception, match="baseline metrics lack test.f1"):
        verdict(compare(long(("test", "recall", 0.5)), full)).collect()
