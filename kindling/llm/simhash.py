"""SimHash near-duplicates with pigeonring candidate filtering.

A document's fingerprint has a bit set if over half of its shingle hashes (XXH64, seed 42) set it.
Two fingerprints are linked at ``max_bits`` or fewer differing bits.

Candidates. A fingerprint is cut into ``max_bits + 1`` segments laid on a ring. By the pigeonring
principle, linked fingerprints have a segment from which every chain of l consecutive segments
differs in at most l * max_bits / (max_bits + 1) bits. The first ``chain`` segments of such a chain
are a join key: one side is stored as it is, the other probes with all bit flips that the budgets
allow. Longer chains, up to the whole ring (the full Hamming check), prune what the join yields.

Buckets with more than ``pair_cap`` fingerprints are never paired. Their members, and all that would
probe them, are linked through points: two fingerprints differ in at most k bits if and only if some
64-bit point lies within floor(k/2) bits of one and ceil(k/2) bits of the other. Rows made there
grow with the members, not with their pairs, and no link is lost.

Defined cases: null, empty and blank texts have fingerprint zero and are linked like any other;
repeated rows and ties give the same fingerprint and the smallest doc_id; a null doc_id is kept and
never the smallest unless its component has no other; empty tables give empty results; other columns
of the input are not read.
"""
from __future__ import annotations

from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindling.llm.common import connected_components, packed, row_key, thin, unpacked, written

BITS = 64
SHINGLE_WORDS = 4
MAX_BITS = 4
#: Fingerprints of one bucket that are still compared in pairs.
PAIR_CAP = 256


def shingle_hashes(text: str | None, shingle: int) -> np.ndarray:
    """XXH64 (seed 42) of every shingle of a text, repeats included."""
    found = (text or "").encode("utf-8", "replace").lower().split()
    joined = b" ".join(found)
    if not found:
        return np.zeros(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    if len(found) < shingle:
        return np.array([digest(joined, 42)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    spans = zip(starts[: len(found) - shingle + 1].tolist(), ends[shingle - 1:].tolist())
    return np.array([digest(joined[a:b], 42) for a, b in spans], np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """Signed 64-bit fingerprint; counted in slices, so a very long text needs little memory."""
    counts = np.zeros(BITS, np.int64)
    for k in range(0, len(hashes), 1 << 16):
        part = np.ascontiguousarray(hashes[k: k + (1 << 16)])
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits((counts * 2 > len(hashes)).astype(np.uint8), bitorder="little").view(np.int64)[0])


def _fingerprint_batches(batches, shingle):
    for batch in batches:
        got = [fingerprint(shingle_hashes(t.as_py(), shingle)) for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got, pa.int64())], ["doc_id", "fp"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fp): one row per input row, fp a signed 64-bit integer."""
    src = thin(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return src.mapInArrow(partial(_fingerprint_batches, shingle=shingle), "doc_id long, fp long")


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


class Ring:
    """Segments of the ring, their masks, and the budgets of chains."""

    def __init__(self, max_bits: int):
        self.k, self.m = max_bits, max_bits + 1
        widths = [BITS // self.m + (i < BITS % self.m) for i in range(self.m)]
        at = [sum(widths[:i]) for i in range(self.m)]
        self.bits = [list(range(a, a + w)) for a, w in zip(at, widths)]

    def budget(self, length: int) -> int:
        return length * self.k // self.m

    def mask(self, start: int, length: int) -> int:
        return sum(1 << b for j in range(length) for b in self.bits[(start + j) % self.m])

    def flips(self, start: int, length: int) -> list[int]:
        """Every difference of a chain that keeps each of its beginnings within budget."""
        found = [(0, 0)]
        for j in range(length):
            seg = self.bits[(start + j) % self.m]
            found = [(mask | sum(1 << b for b in c), used + n) for mask, used in found
                     for n in range(self.budget(j + 1) - used + 1) for c in combinations(seg, n)]
        return [mask for mask, _ in found]


def chain_length(n: int, max_bits: int) -> int:
    """Segments in the join key: the count for which probes and expected chance meetings are fewest.
    The result is the same for any; only the work differs."""
    ring = Ring(max_bits)

    def cost(length: int) -> float:
        probes = sum(len(ring.flips(i, length)) for i in range(ring.m))
        return n * (ring.m + probes) + probes * float(n) ** 2 / 2.0 ** (length * BITS / ring.m)

    return min(range(min(2, ring.m), min(3, ring.m) + 1), key=cost)


def _points(radius: int) -> list[int]:
    return [_signed(sum(1 << b for b in c)) for n in range(radius + 1) for c in combinations(range(BITS), n)]


def _links_by_points(fps: DataFrame, max_bits: int) -> DataFrame:
    near, far = max_bits // 2, -(-max_bits // 2)
    masks = F.array(*[F.struct(F.lit(p).alias("p"), F.lit(bin(p & (2**BITS - 1)).count("1") <= near).alias("near"))
                      for p in _points(far)])
    on = (fps.select("fp", F.explode(masks).alias("x"))
          .select("fp", F.col("fp").bitwiseXOR(F.col("x.p")).alias("point"), "x.near"))
    hub = on.where("near").groupBy("point").agg(F.min("fp").alias("u"))
    return on.join(hub.hint("merge"), "point").where("fp <> u").select("u", F.col("fp").alias("v")).distinct()


def links(fps: DataFrame, max_bits: int = MAX_BITS, pair_cap: int = PAIR_CAP, chain: int | None = None) -> DataFrame:
    """Links (u, v) between distinct fingerprints ``fp``: all pairs within ``max_bits`` of buckets up
    to ``pair_cap``; for larger buckets, links that connect exactly the same components."""
    ring = Ring(max_bits)
    chain = chain or chain_length(fps.count(), max_bits)
    stored = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(_signed(ring.mask(i, chain))).alias("mask"))
                       for i in range(ring.m)])
    tried = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(_signed(ring.mask(i, chain))).alias("mask"),
                               F.lit(_signed(f)).alias("flip"))
                      for i in range(ring.m) for f in ring.flips(i, chain)])
    index = (fps.select(F.col("fp").alias("v"), F.explode(stored).alias("x"))
             .select("v", "x.i", F.col("v").bitwiseAND(F.col("x.mask")).alias("key")))
    probe = (fps.select(F.col("fp").alias("u"), F.explode(tried).alias("x"))
             .select("u", "x.i", F.col("u").bitwiseXOR(F.col("x.flip")).bitwiseAND(F.col("x.mask")).alias("key")))
    hot = written(index.groupBy("i", "key").count().where(F.col("count") > pair_cap).select("i", "key"), "simhash-hot")
    any_hot = not hot.isEmpty()
    cold = index.join(hot, ["i", "key"], "left_anti") if any_hot else index
    diff = F.col("u").bitwiseXOR(F.col("v"))
    # the planner takes exploded rows for as many as their fingerprints: never broadcast them
    pairs = probe.join(cold.hint("merge"), ["i", "key"]).where("u < v")
    for length in range(chain + 1, ring.m + 1):
        mask = F.lit(None).cast("long")
        for i in range(ring.m):
            mask = F.when(F.col("i") == i, F.lit(_signed(ring.mask(i, length)))).otherwise(mask)
        pairs = pairs.where(F.bit_count(diff.bitwiseAND(mask)) <= ring.budget(length))
    found = pairs.where(F.bit_count(diff) <= max_bits).select("u", "v").distinct()
    if any_hot:
        rest = (index.join(hot, ["i", "key"]).select(F.col("v").alias("fp"))
                .unionByName(probe.join(hot, ["i", "key"]).select(F.col("u").alias("fp"))).distinct())
        found = found.unionByName(_links_by_points(rest, max_bits)).distinct()
    return found


def _components(classes: DataFrame, max_bits: int, pair_cap: int, chain: int | None) -> DataFrame:
    """``classes``, one row per fingerprint, with the component of each."""
    nodes = connected_components(links(classes.select("fp"), max_bits, pair_cap, chain))
    return classes.join(nodes.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "component", F.coalesce("component", "fp"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE_WORDS,
                    max_bits: int = MAX_BITS, pair_cap: int = PAIR_CAP, chain: int | None = None) -> DataFrame:
    """(doc_id, fp, component_id): every row with the smallest doc_id reachable over links."""
    docs_fp = written(fingerprints(docs, id_col, text_col, shingle), "simhash-docs")
    classes = written(docs_fp.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-classes")
    joined = _components(classes, max_bits, pair_cap, chain)
    least = joined.groupBy("component").agg(F.min("least").alias("component_id"))
    member = joined.join(least, "component").select("fp", "component_id")
    return docs_fp.join(member, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE_WORDS,
             max_bits: int = MAX_BITS, pair_cap: int = PAIR_CAP, chain: int | None = None) -> DataFrame:
    """One row of each component, all columns kept: the one with the smallest doc_id (null last), then with
    the smallest hash of id and text. Of rows equal in both, one stays, by the hash of the other columns."""
    doc_id, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    key = row_key(doc_id, text)
    keyed = fingerprints(docs.select(key.alias("doc_id"), text.alias("text")), shingle=shingle).select(F.col("doc_id").alias("key"), "fp")
    ids = docs.select(key.alias("key"), doc_id.alias("id")).groupBy("key").agg(F.first("id").alias("id"), F.count(F.lit(1)).alias("n"))
    rows = written(keyed.distinct().join(ids, "key"), "simhash-rows")
    place = F.struct(F.col("id").isNull().alias("none"), "id", "key", "n")
    classes = written(rows.groupBy("fp").agg(F.min(place).alias("least")), "simhash-classes")
    kept = written(_components(classes, max_bits, pair_cap, chain).groupBy("component").agg(F.min("least").alias("least"))
                   .select("least.key", "least.n"), "simhash-kept")
    rows = packed(docs, key=key)
    alone = rows.join(kept.where("n = 1").drop("n"), "key", "left_semi")
    copied = rows.join(kept.where("n > 1").drop("n"), "key")
    hashed = [F.col("_row").getField(f.name) for f in docs.schema if "map<" not in f.dataType.simpleString()]
    # the copies' rows are combined before the exchange, however many there are
    first = copied.groupBy("key").agg(F.min_by("_row", F.xxhash64(*hashed)).alias("_row"))
    return alone.unionByName(first).select(*unpacked(docs.columns))


def hex_fingerprint(fp) -> "F.Column":
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def op8_simhash(spark, sf_dir: str) -> DataFrame:
    """Contract query over the whole documents table."""
    from kindling.sources.tables import table
    got = near_duplicates(table(spark, sf_dir, "documents"))
    return got.select("doc_id", hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")
