"""Mixing sources to target weights.

1. Every source's documents, in a pseudorandom order, are packed end to end into blocks of
   ``block_words`` words (the last one may be shorter); a source with a target of fewer than
   ``LEAST_SLOTS`` such blocks has blocks of that share of its target, of one word at least, so that
   whole blocks come near the target of a small source too.
2. Sources by code point, null last, weigh ``weights`` in turn and share the words of all; a source's
   target stops at ``most`` times its size and the excess is reshared by weight.
3. A source's slots (its target in blocks) are spread over the output shards by a multinomial draw, so
   each shard's source counts are multinomial and their totals hold the targets.
4. Slot j of a source takes block perm(j mod n) of its n blocks, perm a keyed pseudorandom permutation of
   their indices: no block is taken again before all have been.
5. Slots join blocks by (source, index); a document's words are those of its pieces in taken blocks.

Order inside a source is by the hash of doc_id, so neighbours are unrelated; running sums are taken in
as many hash ranges as a range has documents, and over their totals: no task gets a whole source. Pieces are as many as blocks and
documents together. No text is read after its words are counted.

Defined cases: null, empty and blank texts have size 0 and take 0; null sources form the last source;
repeated rows of a doc_id are separate rows; a null doc_id is a row like any other; an empty table gives
an empty result; a rerun gives the same rows; other columns are not read.
"""
from __future__ import annotations

from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kindling.llm.common import pieces, thin, words, written

WEIGHTS = (5, 2, 1)
MOST_TIMES = 3
BLOCK_WORDS = 64
#: Blocks that a target has at least, or as many as it has words.
LEAST_SLOTS = 48
#: Blocks in an output shard.
SHARD_BLOCKS = 1 << 16
#: Slots that one task maps to blocks.
TASK_SLOTS = 1 << 18
SEED = 17


def targets(sources: DataFrame, weights=WEIGHTS, most: int = MOST_TIMES) -> DataFrame:
    """(source, source_size, target) from (source, source_size): one row per source.

    Resharing the excess until none is above its limit ends where target = min(level * weight, limit)
    with one level for all; sources in order of limit / weight are full up to the level's place. The
    windows are over the table of sources, of a few integers each.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_limit = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    ranked = (sources.withColumn("weight", weight).withColumn("limit", F.col("source_size").cast("double") * most)
              .withColumn("ratio", F.col("limit") / F.col("weight")))
    full = Window.orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    # the level if all sources before this one are full
    level = ((F.sum(F.col("source_size").cast("double")).over(everything) - F.coalesce(F.sum("limit").over(full), F.lit(0.0)))
             / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(full), F.lit(0.0))))
    stepped = ranked.withColumn("place", F.row_number().over(by_limit)).withColumn("level", level)
    first = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("place", "level"))).over(everything)
    return (stepped.withColumn("at", first)
            .select("source", "source_size",
                    F.when(F.col("at").isNull() | (F.col("place") < F.col("at.place")), F.col("limit"))
                    .otherwise(F.col("at.level") * F.col("weight")).alias("target")))


def _permuted(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """A keyed permutation of range(n): a Feistel network on the next power of four, walked until in range."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    out, todo, x = np.empty(len(index), np.int64), np.arange(len(index)), index.astype(np.uint64)
    while len(todo):
        left, right = x >> np.uint64(half), x & mask
        for k in range(4):
            f = right * np.uint64(0x9E3779B97F4A7C15) + np.uint64((key + k * 0x632BE59BD9B4E019) & (2**64 - 1))
            f ^= f >> np.uint64(29)
            f *= np.uint64(0xBF58476D1CE4E5B9)
            f ^= f >> np.uint64(32)
            left, right = right, left ^ (f & mask)
        x = (left << np.uint64(half)) | right
        done = x < n
        out[todo[done]] = x[done].astype(np.int64)
        todo, x = todo[~done], x[~done]
    return out


def _shard_counts(batches, seed):
    """(source, key, n_blocks, shard, first, count): a source's multinomial counts over all shards."""
    for pdf in batches:
        for row in pdf.itertuples(index=False):
            rng = np.random.default_rng([seed, row.key & (2**63 - 1)])
            counts = rng.multinomial(row.n_slots, np.full(row.n_shards, 1.0 / row.n_shards))
            first = np.cumsum(counts) - counts
            for lo in range(0, row.n_shards, 65536):
                part = slice(lo, lo + 65536)
                got = pd.DataFrame({"shard": np.arange(row.n_shards)[part], "first": first[part], "count": counts[part]})
                yield got[got["count"] > 0].assign(sid=row.sid, key=row.key, n_blocks=row.n_blocks)[
                    ["sid", "key", "n_blocks", "shard", "first", "count"]]


def _slot_blocks(batches, block_rows=1 << 16):
    """The block of every slot."""
    for pdf in batches:
        for row in pdf.itertuples(index=False):
            for lo in range(0, row.count, block_rows):
                j = np.arange(row.first + lo, row.first + min(row.count, lo + block_rows))
                got = _permuted(j % row.n_blocks, row.n_blocks, row.key & (2**64 - 1))
                yield pd.DataFrame({"sid": row.sid, "shard": row.shard, "slot": j, "block": got})




def plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=WEIGHTS,
         most: int = MOST_TIMES, block_words: int = BLOCK_WORDS, shard_blocks: int = SHARD_BLOCKS, seed: int = SEED):
    """Tables of the mix: rows (row, doc_id, size, sid, source_size, target, each), pieces (row, sid, block, words)
    and slots (sid, shard, slot, block), where slots join pieces by (sid, block)."""
    src = thin(docs, doc_id=id_col, text=text_col, source=source_col)
    # rows of one doc_id that agree in size and source are interchangeable, so any order among them is the same
    sized = src.select(F.col("doc_id").cast("long"), F.col("source").cast("string"),
                       F.size(words(F.col("text").cast("string"))).cast("long").alias("size"))
    sized = written(sized.withColumn("h", F.xxhash64(F.lit(seed), "doc_id")), "mix-sized")
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    goal = targets(sources.select("source", "source_size"), weights, most)
    goal = goal.join(sources.select(F.col("source").alias("s"), "n_docs"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    each = F.least(F.lit(block_words), F.greatest(F.lit(1), F.floor(F.col("target") / LEAST_SLOTS))).cast("long")
    n_blocks = F.ceil(F.col("source_size") / each)
    # the last block may be short: slots count full blocks' worth, and never more than every block ``most`` times
    share = F.col("target") * n_blocks / F.greatest(F.col("source_size"), F.lit(1))
    goal = goal.select(
        "source", "source_size", "target", F.xxhash64(F.lit(seed), F.coalesce("source", F.lit("")), F.col("source").isNull()).alias("sid"),
        each.alias("each"), n_blocks.cast("long").alias("n_blocks"), F.least(F.round(share), n_blocks * most).cast("long").alias("n_slots"),
        F.ceil(F.sqrt("n_docs")).cast("long").alias("ranges"))
    goal = written(goal, "mix-sources")
    total = goal.agg(F.coalesce(F.sum("n_slots"), F.lit(0))).first()[0]
    n_shards = pieces(int(total), shard_blocks)

    tagged = sized.join(goal, sized["source"].eqNullSafe(goal["source"])).select(
        "doc_id", "size", "h", "sid", "source_size", "target", "each",
        F.floor((F.col("h").cast("double") / 2.0**64 + 0.5) * F.col("ranges")).alias("range"))
    inside = Window.partitionBy("sid", "range").orderBy("h", F.col("doc_id").asc_nulls_last(), "size").rowsBetween(
        Window.unboundedPreceding, 0)
    before = Window.partitionBy("sid").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offset = (tagged.groupBy("sid", "range").agg(F.sum("size").alias("n"))
              .select("sid", "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")))
    placed = (tagged.withColumn("upto", F.sum("size").over(inside)).withColumn("nth", F.row_number().over(inside))
              .join(offset, ["sid", "range"])
              .select(F.struct("sid", "range", "nth").alias("row"), "doc_id", "size", "sid", "source_size", "target", "each",
                      (F.col("offset") + F.col("upto") - F.col("size")).alias("start")))
    placed = written(placed, "mix-rows")
    lo, hi = F.col("start"), F.col("start") + F.col("size")
    parts = (placed.where("size > 0")
             .select("row", "sid", lo.alias("lo"), hi.alias("hi"),
                     "each", F.explode(F.sequence(F.floor(lo / F.col("each")), F.floor((hi - 1) / F.col("each")))).alias("block"))
             .select("row", "sid", "block", (F.least("hi", (F.col("block") + 1) * F.col("each"))
                                             - F.greatest("lo", F.col("block") * F.col("each"))).cast("long").alias("words")))
    per_source = goal.where("n_slots > 0").select("sid", F.col("sid").alias("key"), "n_blocks", "n_slots",
                                                  F.lit(n_shards).cast("long").alias("n_shards"))
    # one row per source and shard, dealt out anew: a source with a third of all slots is spread by shard;
    # a fixed number of tasks, as the rows are few and small but their slots many
    counts = per_source.mapInPandas(partial(_shard_counts, seed=seed),
                                    "sid long, key long, n_blocks long, shard long, first long, count long")
    slots = counts.repartition(pieces(int(total), TASK_SLOTS), "sid", "shard").mapInPandas(
        _slot_blocks, "sid long, shard long, slot long, block long")
    return placed, parts, slots


def mix(docs: DataFrame, **kw) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every row."""
    placed, parts, slots = plan(docs, **kw)
    times = slots.groupBy("sid", "block").agg(F.count(F.lit(1)).alias("times"))
    # the planner takes the slots for as small as the table of sources they come from: never broadcast them
    taken = parts.join(times.hint("merge"), ["sid", "block"]).groupBy("row").agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
    return placed.join(taken, "row", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def op2_mixing(spark, sf_dir: str) -> DataFrame:
    """Contract query over the whole documents table."""
    from kindling.sources.tables import table
    return mix(table(spark, sf_dir, "documents"))
