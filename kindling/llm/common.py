"""Helpers shared by the operators: column checks, sizing, written tables, connected components."""
from __future__ import annotations

import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindling.session import materialize

#: White space that separates words in the contracts of the operators.
SPACE_CLASS = r"[\x20\x09-\x0D]+"


def words(text) -> "F.Column":
    """Non-empty runs of other than ASCII white space, as an array (null text: empty)."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_CLASS), "")


def thin(df: DataFrame, **cols: str) -> DataFrame:
    """Only the named columns, under fixed names: extra columns of the input, clashing names
    included, never meet the operator's own. ``thin(df, doc_id="id")`` reads ``id``."""
    return df.select(*[F.col(f"`{c}`").alias(n) for n, c in cols.items()])


def packed(df: DataFrame, **own) -> DataFrame:
    """Whole rows as one struct ``_row`` beside an operator's own columns, so that no name can clash."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), *[x.alias(n) for n, x in own.items()])


def unpacked(columns: list[str], **replaced) -> list:
    """The columns of ``_row`` again, some of them replaced."""
    return [replaced[c].alias(c) if c in replaced else F.col("_row").getField(c).alias(c) for c in columns]


def row_key(doc_id, text) -> "F.Column":
    """64 bits of a row's id, of any type, and text, nulls told apart. Rows of one key are alike to stages that
    judge the text; two others meet with odds of 2^-64."""
    text = text.cast("string")
    return F.xxhash64(doc_id.isNull(), doc_id, text.isNull(), text)


def text_bytes(df: DataFrame, column: str) -> int:
    """UTF-8 bytes in a text column; used only to size partitions, never to choose a result."""
    return int(df.agg(F.coalesce(F.sum(F.octet_length(F.col(column))), F.lit(0))).first()[0])


def pieces(total: int, each: int, least: int = 1) -> int:
    return max(least, -(-total // each))


def byte_slices(batch, column: int, most: int):
    """Parts of an Arrow batch with at most ``most`` text bytes, or one row if that has more."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    lo, held = 0, 0
    for k, n in enumerate(sizes):
        if held and held + n > most:
            yield batch.slice(lo, k - lo)
            lo, held = k, 0
        held += n
    if lo < batch.num_rows:
        yield batch.slice(lo)


def written(df: DataFrame, name: str) -> DataFrame:
    """A table in the folder named by spark.checkpoint.dir: lineage is cut, files outlive executors."""
    return materialize(df, name)


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of an edge table (u, v); component is the smallest node.

    Alternates large-star and small-star steps, each a min per node and a join, so that a hub with
    a third of all edges is combined map-side and its join partition can be split. Every round is a
    written table. No link, node or component reaches the driver, only a count and a checksum.
    """
    cur = written(edges.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
                  .where("u < v").distinct(), "cc")
    sig = _signature(cur)
    for _ in range(max_rounds):
        if not sig[0]:
            break
        # large star: every larger neighbour of a node goes to the node's smallest neighbour
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.join(low, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
                 .where("a <> b").distinct())
        # small star: (a, b) has b < a; smaller neighbours and the node go to the smallest one
        low2 = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low2, "a")
        nxt = (small.select(F.col("m").alias("u"), F.col("b").alias("v"))
               .unionByName(small.select(F.col("m").alias("u"), F.col("a").alias("v")))
               .where("u < v").distinct())
        nxt = written(nxt, "cc")
        now = _signature(nxt)
        cur, done, sig = nxt, now == sig, now
        if done:
            break
    else:
        raise RuntimeError(f"connected components did not settle in {max_rounds} rounds")
    stars = cur.select(F.col("v").alias("node"), F.col("u").alias("component"))
    return stars.unionByName(cur.select(F.col("u").alias("node"), F.col("u").alias("component"))).distinct()
