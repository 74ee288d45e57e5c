"""Exact selection of ranked values without sorting: radix selection on the bits of doubles.

A double's bits, with those of negative numbers turned round, sort as the number does. One aggregate counts the
values of every group by the highest 16 bits; the bucket that holds a rank is found from at most 65,536 running
counts; the next aggregate counts only that bucket's values by the next 16 bits, and so on: four aggregates at
most, for all groups and ranks together, whatever the number of rows or of different values. A bucket whose
least and largest value are equal is settled at once, so small whole numbers take one or two.

Moments come from the first aggregate as well: each bucket has its count, mean and squared deviations,
which add up to those of the group without a second look at the mean.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kindling.session import broadcast_if_small, join_null_safe, reuse

BITS, DIGITS = 16, (48, 32, 16, 0)


def sort_key(value) -> F.Column:
    """A long that sorts as the double does: NaN above all, the zeros equal."""
    bits = F.call_function("java_method", F.lit("java.lang.Double"), F.lit("doubleToLongBits"), value.cast("double") + F.lit(0.0)).cast("long")
    return F.when(bits < 0, bits.bitwiseXOR(F.lit((1 << 63) - 1))).otherwise(bits)


def histogram(keyed: DataFrame, group_cols: list[str], shift: int) -> DataFrame:
    """(group, prefix, digit, c, lo, hi, m, ss) by the 16 bits above ``shift``; the bits above them are the prefix."""
    digit = F.shiftright("_key", shift)
    rows = keyed.withColumn("digit", digit).withColumn("prefix", F.shiftright(digit, BITS))
    return rows.groupBy(*group_cols, "prefix", "digit").agg(
        F.count(F.lit(1)).alias("c"), F.min("_v").alias("lo"), F.max("_v").alias("hi"),
        F.avg("_v").alias("m"), F.var_pop("_v").alias("ss")).withColumn("ss", F.col("ss") * F.col("c"))


def moments(first: DataFrame, group_cols: list[str]) -> DataFrame:
    """(group, n, mean, std, min, max) from the first histogram; std with n - 1, null below two values."""
    c, m = F.col("c"), F.col("m")
    total = first.groupBy(*group_cols).agg(F.sum("c").alias("n"), (F.sum(c * m) / F.sum("c")).alias("mean"), F.min("lo").alias("min"), F.max("hi").alias("max"))
    apart = join_null_safe(first, broadcast_if_small(total.select(*group_cols, F.col("mean").alias("_mean"))), group_cols)
    spread = apart.groupBy(*group_cols).agg(F.sum(F.col("ss") + c * (m - F.col("_mean")) * (m - F.col("_mean"))).alias("_ss"))
    got = join_null_safe(total, spread, group_cols)
    return got.withColumn("std", F.when(F.col("n") > 1, F.sqrt(F.col("_ss") / (F.col("n") - 1)))).drop("_ss")


def _found(counts: DataFrame, wanted: DataFrame, group_cols: list[str]) -> DataFrame:
    """For each wanted (group, prefix, name, r): the bucket that holds rank r, and the rank inside it."""
    keys = [*group_cols, "prefix"]
    upto = F.sum("c").over(Window.partitionBy(*keys).orderBy("digit").rowsBetween(Window.unboundedPreceding, 0))
    placed = counts.withColumn("_upto", upto).withColumn("_before", F.col("_upto") - F.col("c"))
    hit = join_null_safe(placed, broadcast_if_small(wanted), keys).where((F.col("r") >= F.col("_before")) & (F.col("r") < F.col("_upto")))
    return hit.select(*group_cols, "name", F.col("digit").alias("prefix"), (F.col("r") - F.col("_before")).alias("r"), "lo", "hi")


def ranked_values(df: DataFrame, group_cols: list[str], value_col: str, ranks: dict) -> tuple[DataFrame, DataFrame]:
    """((group, name, value), first histogram): for each name the value at a 0-based rank, which is an
    expression of the group's count ``n``. ``df`` is read once a pass, so hand in a scan or a written table.
    Null values are left out, null groups are groups; a group without values or a rank outside has no row."""
    keyed = df.select(*group_cols, F.col(value_col).cast("double").alias("_v")).where("_v IS NOT NULL").withColumn("_key", sort_key(F.col("_v")))
    first = reuse(histogram(keyed, group_cols, DIGITS[0]))
    n = first.groupBy(*group_cols, "prefix").agg(F.sum("c").alias("n"))
    # the first digit is signed, so its prefix is 0 or -1 and both belong to one search
    first_all = first.withColumn("prefix", F.lit(0).cast("long"))
    total = n.groupBy(*group_cols).agg(F.sum("n").alias("n")).withColumn("prefix", F.lit(0).cast("long"))
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("name"), r.cast("long").alias("r")) for k, r in ranks.items()]))
    wanted = total.select(*group_cols, "prefix", each.alias("_w")).select(*group_cols, "prefix", "_w.name", "_w.r")
    found = reuse(_found(first_all, wanted, group_cols))
    done = found.where("lo = hi OR (isnan(lo) AND isnan(hi))")
    for shift in DIGITS[1:]:
        open_ = found.where("lo <> hi")
        if open_.isEmpty():
            break
        wanted = open_.select(*group_cols, "prefix", "name", "r")
        inside = keyed.withColumn("prefix", F.shiftright("_key", shift + BITS))
        inside = join_null_safe(inside, broadcast_if_small(wanted.select(*group_cols, "prefix").distinct()), [*group_cols, "prefix"])
        found = reuse(_found(histogram(inside.drop("prefix"), group_cols, shift), wanted, group_cols))
        done = done.unionByName(found.where("lo = hi"))
    return done.select(*group_cols, "name", F.col("lo").alias("value")), first


def wide(found: DataFrame, group_cols: list[str], names: list[str]) -> DataFrame:
    """(group, one column a name)."""
    return found.groupBy(*group_cols).agg(*[F.max(F.when(F.col("name") == k, F.col("value"))).alias(k) for k in names])
