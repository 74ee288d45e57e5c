"""Records of large CSV files with embedded newlines, read in many tasks.

Spark gives a multi-line CSV file to one task, as a newline may stand inside a quoted cell. Here the file is
read as lines, in byte ranges. Whether a line starts inside quotes depends on all lines before it, but only
through two cases, so each range reports where it ends for either start (one row a range). Put together in
file order, which the driver does with those rows, they give the true start of every range. A second pass then
cuts records; one that crosses ranges comes as fragments, at most two a range, which are joined by record.

Quotes are read as Spark's CSV reader reads them with ``escape='"'``: a cell is quoted if it begins with a quote; two
quotes inside are one; a quote before anything but a delimiter or the line's end makes the rest of the cell plain.
Lines end with a line feed, a carriage return before it belongs to the end.
"""
from __future__ import annotations

from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kindling.session import materialize

WHOLE, HEAD, MIDDLE, TAIL = 0, 1, 2, 3
FRAGMENT = "file string, at long, pos long, kind int, record string"


def inside_after(line: str, inside: bool) -> bool:
    """Whether a line that starts inside quotes or not ends inside quotes."""
    if '"' not in line:
        return inside
    k, n = 0, len(line) - line.endswith("\r")
    while True:
        if not inside:
            if k < n and line[k] == '"':
                inside = True
                k += 1
            else:   # a plain cell
                k = line.find(",", k, n) + 1
                if not k:
                    return False
                continue
        k = line.find('"', k, n)
        if k < 0:
            return True
        k += 1
        if k < n and line[k] == '"':
            k += 1
            continue
        inside = False
        if k >= n:
            return False
        k = line.find(",", k, n) + 1   # the delimiter; what stands before it is plain
        if not k:
            return False


def _runs(batches):
    """(file, at, lines) runs of a task, in order."""
    for batch in batches:
        files, ats, values = (batch.column(c).to_pylist() for c in range(3))
        lo = 0
        for k in range(1, len(files) + 1):
            if k == len(files) or (files[k], ats[k]) != (files[lo], ats[lo]):
                yield files[lo], ats[lo], values[lo:k]
                lo = k


def _ends(batches):
    """For every range: the state at its end for a start outside and inside quotes."""
    found: dict[tuple, list] = {}
    for file, at, lines in _runs(batches):
        states = found.setdefault((file, at), [False, True])
        for line in lines:
            if '"' in line:
                states[0], states[1] = inside_after(line, states[0]), inside_after(line, states[1])
    if found:
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in found], pa.string()), pa.array([k[1] for k in found], pa.int64()),
             pa.array([v[0] for v in found.values()]), pa.array([v[1] for v in found.values()])], ["file", "at", "outside", "inside"])


def range_starts(rows: list) -> dict[tuple, tuple[bool, bool]]:
    """(file, at) -> (starts inside quotes, ends inside quotes), from the rows of all ranges."""
    out, state, before = {}, False, None
    for r in sorted(rows, key=lambda r: (r.file, r.at)):
        state = state if r.file == before else False
        end = r.inside if state else r.outside
        out[r.file, r.at] = (state, end)
        state, before = end, r.file
    return out


def _cut(batches, starts, header: bool):
    """Records and fragments of every range; ``pos`` orders the records of a file."""
    known = starts.value
    rows: list[tuple] = []
    here, inside, held, pos, begun, skip, kind = None, False, [], 0, 0, False, WHOLE

    def end_of_range():
        if held:
            rows.append((*here, begun, MIDDLE if kind == HEAD else TAIL, "\n".join(held)))

    for file, at, lines in _runs(batches):
        if (file, at) != here:
            end_of_range()
            here, inside = (file, at), known[file, at][0]
            held, pos, begun, skip, kind = [], at, at, header and at == 0, HEAD if inside else WHOLE
        for line in lines:
            if not held:
                begun = pos
            pos += len(line.encode("utf-8", "replace")) + 1
            inside = inside_after(line, inside)
            if not held and not inside:   # the usual case: a record is a line
                record = line
            else:
                held.append(line)
                if inside:
                    continue
                record, held = "\n".join(held), []
            if skip:
                skip = False
            elif record not in ("", "\r") or kind == HEAD:
                rows.append((file, at, begun, kind, record))
            kind = WHOLE
            if len(rows) >= 8192:
                yield _batch(rows)
                rows = []
    end_of_range()
    if rows:
        yield _batch(rows)


def _batch(rows):
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], ["file", "at", "pos", "kind", "record"])


def _joined(fragments: DataFrame) -> DataFrame:
    """Records of fragments: a tail, the ranges that lie inside it, and the head that ends it."""
    order = Window.partitionBy("file").orderBy("at", "pos").rowsBetween(Window.unboundedPreceding, 0)
    numbered = fragments.withColumn("n", F.sum(F.when(F.col("kind") == TAIL, 1).otherwise(0)).over(order))
    parts = F.sort_array(F.collect_list(F.struct("at", "pos", "record")))
    return numbered.groupBy("file", "n").agg(F.min("pos").alias("pos"), parts.alias("p")).select(
        "file", "pos", F.concat_ws("\n", F.transform("p", lambda x: x["record"])).alias("record"))


def read_records(spark: SparkSession, paths: list[str], header: bool = True) -> DataFrame:
    """(file, source_file, pos, record) of every record but the header; empty lines are no records."""
    lines = spark.read.option("lineSep", "\n").text(paths).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), "value")
    # one row a range, as many as the scan has splits
    starts = range_starts(lines.mapInArrow(_ends, "file string, at long, outside boolean, inside boolean").collect())
    cut = lines.mapInArrow(partial(_cut, starts=spark.sparkContext.broadcast(starts), header=header), FRAGMENT)
    got = cut.where(F.col("kind") == WHOLE).select("file", "pos", "record")
    if any(end for _, end in starts.values()):
        fragments = materialize(cut.where(F.col("kind") != WHOLE), "csv-fragments")
        got = got.unionByName(_joined(fragments))
    record = F.regexp_replace("record", "\r$", "")
    return got.select("file", F.element_at(F.split("file", "/"), -1).alias("source_file"), "pos", record.alias("record"))
