"""Streaming batch ingestion: score every new CSV dropped in a folder.

The stream carries file *paths*, not parsed rows (``binaryFile`` source with
only ``path`` selected, so contents are never loaded by the source). The
source checkpoint is the exactly-once record of consumed files: a rerun with
``availableNow`` yields nothing new. Each micro-batch (``foreachBatch``):

  1. reads each file's header and reads files by header group (CSV matches
     columns by position under a fixed schema, so this is required);
  2. files without a ``text`` column, and malformed rows, go to the rejects;
  3. scores rows with the shared scoring path (same as batch / single text);
  4. writes scored rows, per-file (rows, flagged) counts and rejects, each under
     a ``batch_id`` folder with overwrite - a replayed batch rewrites the same
     folders, so every output is idempotent.

The micro-batch is committed by an entry of the output's commit log, put under its
number once all outputs are complete; it names the consumed files and is what
``run_ingestion`` goes by. A replay finds the entry and changes nothing. Files
are moved to ``processed_dir`` only after that; until then a replay finds them
in place.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kindling import config as C
from kindling.sources.commit_log import CommitLog, Conflict
from kindling.sources.files import READ_BACK, REJECTED_ROWS, WRITE_CSV, read_csvs

BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"
#: Added to the output's folder name: the folder of its commit log.
LOG = "_commits"


def _move(spark: SparkSession, path: str, target_dir: str) -> None:
    """Move a file; one that an earlier run has moved already is left alone."""
    jvm = spark.sparkContext._jvm
    src = jvm.org.apache.hadoop.fs.Path(path)
    fs = src.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(src):
        return
    dst_dir = jvm.org.apache.hadoop.fs.Path(target_dir)
    fs.mkdirs(dst_dir)
    if not fs.rename(src, jvm.org.apache.hadoop.fs.Path(dst_dir, src.getName())):
        raise OSError(f"can't move {path} to {target_dir}")


def score_files(spark: SparkSession, paths: list[str], model) -> tuple[DataFrame | None, list, DataFrame]:
    rows, rejects, bad = read_csvs(spark, paths, required="text")
    return (None if rows is None else model.score(rows)), rejects, bad


def make_batch_writer(model, triaged_dir: str, rejects_dir: str, summary_dir: str):
    def process(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # file paths only: bounded by maxFilesPerTrigger
        paths = sorted(r["path"] for r in batch.select("path").collect())
        if not paths:
            return
        scored, rejects, bad = score_files(spark, paths, model)
        stamp = F.date_format(F.current_timestamp(), C.STAMP_FORMAT)
        here = f"batch_id={batch_id}"
        files = spark.createDataFrame([(p, r, None) for p, r in rejects], REJECTED_ROWS)
        bad.unionByName(files).write.mode("overwrite").parquet(f"{rejects_dir}/{here}")
        if scored is not None:
            out = scored.withColumn("run_ts", stamp).withColumn(
                "source_file", F.regexp_replace("source_file", r"\.csv$", ""))
            out.write.mode("overwrite").partitionBy("source_file").options(**WRITE_CSV).csv(f"{triaged_dir}/{here}")
            written = spark.read.options(**READ_BACK).csv(f"{triaged_dir}/{here}")
            (written.groupBy("source_file").agg(
                F.count("*").alias("n"), F.sum(F.col("label").cast("int")).cast("long").alias("n_flagged"))
             .withColumn("run_ts", stamp)
             .withColumn("output", F.concat(F.lit(f"{triaged_dir}/{here}/source_file="), "source_file"))
             .write.mode("overwrite").parquet(f"{summary_dir}/{here}"))
        rejected = {p for p, _ in rejects}
        entry = {"consumed": [p for p in paths if p not in rejected], "rejected": sorted(rejected), "scored": scored is not None}
        log = CommitLog(spark, triaged_dir + LOG)
        try:
            log.put(batch_id, entry)
        except Conflict:   # replayed: the entry must be this batch's own
            if log.read(batch_id) != entry:
                raise
    return process


def _dirs(triaged_dir: str, rejects_dir: str | None, summary_dir: str | None) -> tuple[str, str]:
    return rejects_dir or f"{triaged_dir}_rejects", summary_dir or f"{triaged_dir}_summary"


def start_ingest(spark: SparkSession, incoming_dir: str, triaged_dir: str, checkpoint_dir: str,
                 model, rejects_dir: str | None = None, summary_dir: str | None = None,
                 max_files_per_trigger: int = 1000, available_now: bool = True) -> StreamingQuery:
    paths = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
             .option("pathGlobFilter", "*.csv").option("maxFilesPerTrigger", max_files_per_trigger)
             .load(incoming_dir).select("path"))
    writer = make_batch_writer(model, triaged_dir, *_dirs(triaged_dir, rejects_dir, summary_dir))
    w = paths.writeStream.foreachBatch(writer).option("checkpointLocation", checkpoint_dir)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def move_consumed(spark: SparkSession, triaged_dir: str, processed_dir: str, batches: set[int]) -> None:
    """Move the files of committed micro-batches out of the incoming folder."""
    log = CommitLog(spark, triaged_dir + LOG)
    for k in sorted(batches):
        for path in (log.read(k) or {}).get("consumed", []):
            _move(spark, path, processed_dir)


def run_ingestion(spark: SparkSession, incoming_dir: str, triaged_dir: str, checkpoint_dir: str,
                  model, processed_dir: str | None = None, rejects_dir: str | None = None,
                  summary_dir: str | None = None, **kw) -> list[dict]:
    """One availableNow run: consume everything new, then stop. Returns one entry
    per scored file of this run: source_file, output, n, n_flagged."""
    _, summaries = _dirs(triaged_dir, rejects_dir, summary_dir)
    log = CommitLog(spark, triaged_dir + LOG)
    before = set(log.numbers())
    q = start_ingest(spark, incoming_dir, triaged_dir, checkpoint_dir, model, rejects_dir, summary_dir, **kw)
    q.awaitTermination()
    done = set(log.numbers())
    if processed_dir:   # all committed batches: a crash may have kept an earlier run from moving
        move_consumed(spark, triaged_dir, processed_dir, done)
    out = []
    for k in sorted(done - before):
        if log.read(k)["scored"]:
            rows = spark.read.parquet(f"{summaries}/batch_id={k}").orderBy("source_file").collect()   # files of one batch
            out += [{c: r[c] for c in ("source_file", "output", "n", "n_flagged")} for r in rows]
    return out
