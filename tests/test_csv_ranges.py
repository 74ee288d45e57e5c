import os
import random

import pytest

from kindling.sources import csv_ranges as X
from kindling.sources import files as S

CELLS = ["plain", "two words", "", 'say ""hi""', "line one\nline two", "a,b", "\n\n", 'ends with quote""', "ünï 🙂", "x" * 40, '""', "tab\tcell", "multi\nline, with ""comma"""]


def document(rnd, n):
    """CSV text with quoted cells, embedded newlines, blank lines and rows of a wrong width."""
    out = ["id,text,target"]
    for k in range(n):
        cell = rnd.choice(CELLS)
        quoted = rnd.random() < .3 or any(c in cell for c in ',\n"')
        row = [str(k), f'"{cell}"' if quoted else cell, rnd.choice(["0", "1", "1.0", "x", ""])]
        if rnd.random() < .05:
            row.append("extra")
        if rnd.random() < .05:
            row = row[:2]
        out.append(",".join(row))
        if rnd.random() < .05:
            out.append("")
    return "\n".join(out) + ("\n" if n % 2 else "")


def both(spark, paths, split):
    """(rows, rejects) of the one-task read and of the read in ranges, and the ranges."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    cost = [("always one", 1 << 40), ("ranges", 0)]
    got = []
    try:
        for _, most in cost:
            S_large = S._large
            S._large = lambda *a, most=most: not most
            try:
                good, bad = S.read_csv_group(spark, paths, ["id", "text", "target"])
                got.append((sorted(map(tuple, good.drop("_pos").collect()), key=repr), sorted(map(tuple, bad.collect()), key=repr)))
            finally:
                S._large = S_large
        parts = spark.read.option("lineSep", "\n").text(paths).rdd.getNumPartitions()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    return (*got, parts)


@pytest.mark.parametrize("seed,split", [(1, "70"), (2, "333"), (3, "5000")])
def test_ranges_equal_the_one_task_read(spark, tmp_dir, seed, split):
    rnd, paths = random.Random(seed), []
    for f in range(2):
        paths.append(os.path.join(tmp_dir, f"f{f}.csv"))
        with open(paths[-1], "w", encoding="utf-8", newline="") as out:
            out.write(document(rnd, 60 + f))
    one, many, parts = both(spark, paths, split)
    assert parts > 2
    assert len(one[0]) > 40 and len(one[1]) > 5
    assert many == one


def test_a_record_longer_than_several_ranges(spark, tmp_dir):
    path = os.path.join(tmp_dir, "long.csv")
    cell = "\n".join(f"line {k} with a, comma" for k in range(80))
    with open(path, "w", newline="") as out:
        out.write(f'id,text,target\n1,"{cell}",0\n2,b,1\n3,"{cell}",1\n')
    one, many, parts = both(spark, [path], "100")
    assert parts > 20 and many == one and len(one[0]) == 3


def test_positions_order_the_records(spark, tmp_dir):
    path = os.path.join(tmp_dir, "o.csv")
    rnd = random.Random(8)
    with open(path, "w", newline="") as out:
        out.write("id,text\n" + "".join('%d,"%s"\n' % (k, rnd.choice(["a\nb", "c", "d\n\ne"])) for k in range(200)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        rows = X.read_records(spark, [path]).orderBy("pos").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [int(r.record.split(",")[0]) for r in rows] == list(range(200))


@pytest.mark.parametrize("line,outside,inside", [
    ("a,b", False, True), ('a,"b', True, False), ('"a","b"', False, False), ('"a""b', True, False), ('a"b,c', False, False), ('x",y', False, False),
    ('"a"b,"c', True, True), ('""', False, True), ('"', True, False), ('"a"\r', False, False), ('', False, True)])
def test_state_after_a_line(line, outside, inside):
    assert X.inside_after(line, False) == outside and X.inside_after(line, True) == inside


def test_a_large_file_takes_many_tasks(spark, tmp_dir):
    path = os.path.join(tmp_dir, "big.csv")
    with open(path, "w", newline="") as out:
        out.write("id,text,target\n")
        for k in range(60_000):
            out.write(f'{k},"row {k} first line\nsecond line, {"x" * 100}",{k % 2}\n')
    assert os.path.getsize(path) > 8 << 20
    df = S.read_labelled_csv(spark, path)
    assert df.rdd.getNumPartitions() > 1
    assert df.count() == 60_000 and df.selectExpr("sum(id)").first()[0] == 60_000 * 59_999 // 2
    assert df.where("target <> id % 2 OR text NOT LIKE 'row %\nsecond line%'").count() == 0
