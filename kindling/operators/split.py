"""Exact-size, stratified, seeded train / val / test split.

Sizes follow the two-stage rule: test = ceil(f_test * n); then, of the rest,
val = ceil(f_val / (1 - f_test) * rest). Each stage allocates the per-class
counts by largest remainder (ties: lower class first). Inside a class, rows
are ordered by ``md5(seed ':' id)``: the first ``test_c`` go to test, the
next ``val_c`` to val, the rest to train. Rows of one id are ordered by a hash
of all their columns; rows equal in every column get the same split. Null
targets are a class, null ids are rows like any other.

Scale plan: no window over a class. Rows get a uniform bucket (the first hex
digits of their order key), whose counts are classes x 16^digits rows at most.
The <= 2 buckets per class that straddle a cut are ranked, on (class, key) rows
only, which gives two cut keys per class. Every row of the input is then
labelled by comparing its key with its class's cuts: a join with one row per
class and no other shuffle of the input.
"""
from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kindling import config as C
from kindling.session import broadcast_if_small, join_null_safe, reuse


def approximate_mode(counts: dict, n_draws: int) -> dict:
    """Largest-remainder allocation of ``n_draws`` over class ``counts``."""
    n = sum(counts.values())
    if n == 0:
        return {k: 0 for k in counts}
    cont = {k: (v * n_draws) / n for k, v in counts.items()}
    alloc = {k: math.floor(x) for k, x in cont.items()}
    need = n_draws - sum(alloc.values())
    order = sorted(counts, key=lambda k: (-(cont[k] - alloc[k]), k))
    for k in order[:need]:
        alloc[k] += 1
    return alloc


def split_sizes(counts: dict, val_fraction: float = C.VAL_FRACTION,
                test_fraction: float = C.TEST_FRACTION) -> dict:
    """{class: (n_test, n_val, n_train)} following the two-stage rule."""
    n = sum(counts.values())
    n_test = math.ceil(test_fraction * n)
    trainval = approximate_mode(counts, n - n_test)
    m = n - n_test
    n_val = math.ceil(val_fraction / (1 - test_fraction) * m)
    train = approximate_mode(trainval, m - n_val)
    return {k: (counts[k] - trainval[k], trainval[k] - train[k], train[k]) for k in counts}


def _allocated(classes: DataFrame, target_col: str, count: str, n_draws, out: str) -> DataFrame:
    """``approximate_mode`` over a table of classes; the windows are over that table."""
    everything = Window.partitionBy()
    whole = classes.withColumn("_cont", (F.col(count) * n_draws).cast("double") / F.sum(count).over(everything))
    whole = whole.withColumn("_fl", F.floor("_cont"))
    rank = F.row_number().over(Window.orderBy((F.col("_cont") - F.col("_fl")).desc(), F.col(target_col)))
    need = n_draws - F.sum("_fl").over(everything)
    return whole.withColumn("_need", need).withColumn("_rk", rank).withColumn(
        out, (F.col("_fl") + F.when(F.col("_rk") <= F.col("_need"), 1).otherwise(0)).cast("long")).drop(
        "_cont", "_fl", "_need", "_rk")


def class_cuts(classes: DataFrame, target_col: str, val_fraction: float, test_fraction: float) -> DataFrame:
    """(target, _cut1, _cut2) from (target, _c): rows up to _cut1 are test, up to _cut2 val."""
    everything = Window.partitionBy()
    n = F.sum("_c").over(everything)
    kept = classes.withColumn("_n1", (n - F.ceil(F.lit(test_fraction) * n)).cast("long"))
    kept = _allocated(kept, target_col, "_c", F.col("_n1"), "_tv")
    m = F.sum("_tv").over(everything)
    kept = kept.withColumn("_n2", (m - F.ceil(F.lit(val_fraction / (1 - test_fraction)) * m)).cast("long"))
    kept = _allocated(kept, target_col, "_tv", F.col("_n2"), "_tr")
    return kept.select(target_col, (F.col("_c") - F.col("_tv")).alias("_cut1"), (F.col("_c") - F.col("_tr")).alias("_cut2"))


def order_key(id_col: str, seed: int = C.SEED) -> F.Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))


def stratified_split(df: DataFrame, id_col: str, target_col: str = "target",
                     val_fraction: float = C.VAL_FRACTION, test_fraction: float = C.TEST_FRACTION,
                     seed: int = C.SEED, hex_digits: int = C.RANK_BUCKET_HEX) -> DataFrame:
    """Return ``df`` plus a ``split`` column ('train' | 'val' | 'test')."""
    key = F.concat(F.coalesce(order_key(id_col, seed), F.md5(F.lit(f"{seed}:"))), F.hex(F.xxhash64(*df.columns)))
    bucket = F.substring("_h", 1, hex_digits)
    thin = reuse(df.select(F.col(target_col), key.alias("_h")))

    per_bucket = thin.groupBy(target_col, bucket.alias("_bk")).agg(F.count("*").alias("_cnt"))
    w = Window.partitionBy(target_col).orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    placed = reuse(per_bucket.withColumn("_lo", F.coalesce(F.sum("_cnt").over(w), F.lit(0))))
    classes = placed.groupBy(target_col).agg(F.sum("_cnt").alias("_c"))
    cuts = reuse(class_cuts(classes, target_col, val_fraction, test_fraction))

    # the bucket that holds each cut's last row, and the key of that row
    wanted = cuts.select(target_col, F.explode(F.array(
        F.struct(F.lit(1).alias("k"), F.col("_cut1").alias("cut")),
        F.struct(F.lit(2).alias("k"), F.col("_cut2").alias("cut")))).alias("x")).select(target_col, "x.*").where("cut > 0")
    straddle = join_null_safe(placed, wanted, [target_col]).where(
        (F.col("_lo") < F.col("cut")) & (F.col("cut") <= F.col("_lo") + F.col("_cnt")))
    rows = join_null_safe(thin.withColumn("_bk", bucket), broadcast_if_small(straddle), [target_col, "_bk"])
    rank = F.col("_lo") + F.row_number().over(Window.partitionBy(target_col, "_bk", "k").orderBy("_h"))
    at = rows.withColumn("_rank", rank).where(F.col("_rank") == F.col("cut"))
    keys = at.groupBy(target_col).agg(F.max(F.when(F.col("k") == 1, F.col("_h"))).alias("_h1"),
                                      F.max(F.when(F.col("k") == 2, F.col("_h"))).alias("_h2"))
    keys = broadcast_if_small(reuse(keys))   # one row per class
    labelled = join_null_safe(df.withColumn("_h", key), keys, [target_col], "left")
    return labelled.withColumn(
        "split", F.when(F.col("_h") <= F.col("_h1"), "test").when(F.col("_h") <= F.col("_h2"), "val").otherwise("train")
    ).select(*df.columns, "split")
