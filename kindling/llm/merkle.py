"""Merkle manifest of a dataset, with a membership witness for every row.

A row's leaf is the hash of its columns. Leaves form one tree per ``tree`` value, in the order of an id;
while a level has several nodes, every ``FANOUT`` consecutive ones (the last run fewer, even one) become
their hash. What remains is the tree's subroot; subroots, in the order of the trees, give the root alike.

Incremental witnesses. Nodes of a tree are dealt to aligned blocks of FANOUT^BLOCK_LEVELS. A block is a
stream of appends: a node opens with an empty witness; when a run is complete, the witnesses of all
nodes below its members get the member's place and siblings, and the run's hash is appended to the level
above. A block's root is an append to the next round, which deals block roots to blocks again, until every
tree has one; a last round or more appends the subroots. A witness is then extended, block by block
from the top, by what its block's root got.

Scale: a round shuffles digests and ids, never columns. Places in a tree come from a range
partitioning by (tree, id) and counts per partition. A block is at most 4,096 nodes in one task. Rounds
divide the nodes by 4,096; their tables are written in the shared folder.

Defined cases: null columns are hashed as ``-``; a null tree value is a tree, before all others, and differs
from the empty text; null ids come first; rows with equal tree and id are ordered by their leaf, so
repeated rows (equal leaves) have fixed digests; very long texts are hashed whole; an empty table gives no rows
(and has no root); other columns are not read, so clashing names don't meet the operator's own.
"""
from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindling.llm.common import written

FANOUT = 8
#: Levels of a block: a task holds FANOUT ** BLOCK_LEVELS nodes.
BLOCK_LEVELS = 4
BLOCK = FANOUT ** BLOCK_LEVELS

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_digest(*values) -> "F.Column":
    """Hex SHA-256 of columns: each ``-`` if null, else its UTF-8 length, ``:`` and the text."""
    parts = [F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-"))
             for v in (x.cast("string") for x in values)]
    return F.sha2(F.concat(*parts), 256)


def tree_key(value) -> "F.Column":
    """A key of a tree that is never null and sorts as the value does, null first."""
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit("-"))


def run_digest(digests: list[str]) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


class Appender:
    """Appends digests in order; keeps a partial witness for each, and the open run of every level."""

    def __init__(self, fanout: int = FANOUT):
        self.fanout = fanout
        self.witnesses: list[list] = []  # of every append: (place, siblings) by level
        self.open: list[list] = [[]]     # by level: (digest, first append, appends)

    def append(self, digest: str) -> None:
        self.witnesses.append([])
        self._push(0, (digest, len(self.witnesses) - 1, 1))

    def _push(self, level: int, node: tuple) -> None:
        if level == len(self.open):
            self.open.append([])
        self.open[level].append(node)
        if len(self.open[level]) == self.fanout:
            self._complete(level)

    def _complete(self, level: int) -> None:
        run, self.open[level] = self.open[level], []
        digests = [n[0] for n in run]
        for place, (_, first, n) in enumerate(run):
            siblings = digests[:place] + digests[place + 1:]
            for k in range(first, first + n):
                self.witnesses[k].append((place, siblings))
        self._push(level + 1, (run_digest(digests), run[0][1], sum(n for _, _, n in run)))

    def close(self, levels: int | None = None) -> str:
        """Complete the last runs: up to a fixed level, or while a level has several nodes."""
        level = 0
        while level != levels:
            above = any(self.open[level + 1:])
            if levels is None and not above and len(self.open[level]) == 1:
                break
            if self.open[level]:
                self._complete(level)
            level += 1
        (digest, _, _), = self.open[level]
        return digest


def _append_block(table: pa.Table, carried: list[str], fanout: int, levels: int) -> pa.Table:
    """One block: its nodes with partial witnesses, and the block's root in every row."""
    table = table.sort_by("place")
    stream = Appender(fanout)
    for digest in table.column("digest").to_pylist():
        stream.append(digest)
    alone = not table.column("several")[0].as_py()
    root = stream.close(None if alone else levels)
    n = table.num_rows
    out = {c: table.column(c) for c in ["tree", "block", "place", "digest", *carried]}
    out["places"] = pa.array([[p for p, _ in w] for w in stream.witnesses], pa.list_(pa.int32()))
    out["siblings"] = pa.array([[s for _, s in w] for w in stream.witnesses], pa.list_(pa.list_(pa.string())))
    out["block_root"] = pa.array([root] * n, pa.string())
    return pa.table(out)


def _placed(nodes: DataFrame, order: list[str]) -> DataFrame:
    """``nodes`` (tree, digest, ...) with each node's ``place`` in its tree, by ``order``, then digest.

    A hot tree, id or digest is split: equal nodes are interchangeable, so a written row number parts them."""
    nodes = written(nodes.withColumn("_salt", F.monotonically_increasing_id()), "merkle-nodes")
    keys = ["tree", *order, "digest", "_salt"]
    ranged = written(nodes.repartitionByRange(*keys).sortWithinPartitions(*keys)
                     .withColumn("_part", F.spark_partition_id()).withColumn("_row", F.monotonically_increasing_id()), "merkle-ranged")
    # one row for each partition and tree in it
    counts = ranged.groupBy("tree", "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    counts = counts.selectExpr("tree", "_part", "_first", "coalesce(sum(_n) OVER (PARTITION BY tree ORDER BY _part "
                               "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS _before",
                               "sum(_n) OVER (PARTITION BY tree) AS _all")
    got = ranged.join(counts, ["tree", "_part"])
    return (got.withColumn("place", (F.col("_row") - F.col("_first") + F.col("_before")).cast("long"))
            .withColumn("n_nodes", F.col("_all").cast("long")).drop("_salt", "_part", "_row", "_first", "_before", "_all"))


def _round(nodes: DataFrame, carried: list[str], fanout: int, levels: int) -> DataFrame:
    """Nodes (tree, place, n_nodes, digest, carried) appended block by block, written."""
    size = fanout ** levels
    kinds = ", ".join(f"`{c}` {nodes.schema[c].dataType.simpleString()}" for c in carried)
    schema = ("tree string, block long, place long, digest string, " + (kinds + ", " if kinds else "")
              + "places array<int>, siblings array<array<string>>, block_root string")
    dealt = nodes.withColumn("block", F.expr(f"place div {size}")).withColumn("several", F.col("n_nodes") > size).drop("n_nodes")

    def appended(table: pa.Table) -> pa.Table:
        return _append_block(table, carried, fanout, levels)
    return written(dealt.groupBy("tree", "block").applyInArrow(appended, schema), "merkle-round")


def _roots(done: DataFrame, size: int) -> DataFrame:
    """Block roots as nodes of the next round."""
    blocks = done.where(F.col("place") % size == 0).select("tree", F.col("block").alias("place"), F.col("block_root").alias("digest"))
    n = blocks.groupBy("tree").agg(F.count(F.lit(1)).alias("n_nodes"))
    return written(blocks.join(n, "tree"), "merkle-blocks")


def _climb(nodes: DataFrame, carried: list[str], fanout: int, levels: int) -> tuple[list[DataFrame], DataFrame]:
    """Rounds until every tree has one node: the tables of all rounds, and (tree, place, n_nodes, digest) of the last roots."""
    rounds = []
    while True:
        rounds.append(_round(nodes, carried if not rounds else [], fanout, levels))
        nodes = _roots(rounds[-1], fanout ** levels)
        if nodes.where("n_nodes > 1").isEmpty():
            return rounds, nodes


def _extend(done: DataFrame, above: DataFrame, carried: list[str]) -> DataFrame:
    """Witnesses of a round, extended by those that their blocks' roots have got."""
    up = above.select("tree", F.col("place").alias("block"), F.col("places").alias("_p"), F.col("siblings").alias("_s"), *carried)
    return (done.join(up, ["tree", "block"]).withColumn("places", F.concat("places", "_p"))
            .withColumn("siblings", F.concat("siblings", "_s")).drop("_p", "_s", "block", "block_root"))


def witnesses(leaves: DataFrame, order: list[str], fanout: int = FANOUT, levels: int = BLOCK_LEVELS) -> DataFrame:
    """``leaves`` (tree, digest, and columns to order by or to carry) with subroot, root, and a witness:
    ``places`` and ``siblings`` by level from the leaf to the root. ``tree`` must not be null (see tree_key)."""
    own = {"place", "n_nodes", "block", "several", "places", "siblings", "block_root", "subroot", "root", "_salt", "_part", "_row",
           "_n", "_first", "_before", "_all", "_p", "_s"} & set(leaves.columns)
    if own or fanout < 2 or levels < 1:
        raise ValueError(f"rename {sorted(own)}" if own else "fanout must be 2 or more, levels 1 or more")
    carried = [c for c in leaves.columns if c not in ("tree", "digest")]
    rounds, tops = _climb(_placed(leaves, order), carried, fanout, levels)
    # subroots are the appends of one more tree
    subroots = _placed(tops.select(F.lit("=").alias("tree"), F.col("tree").alias("sub"), "digest"), ["sub"])
    upper, _ = _climb(subroots, ["sub"], fanout, levels)
    none = F.array().cast("array<int>"), F.array().cast("array<array<string>>")
    above = upper[-1].select("tree", "block", F.col("block_root").alias("root"), *[x.alias(n) for x, n in zip(none, ("places", "siblings"))])
    above = above.distinct().withColumnRenamed("block", "place")
    for done in reversed(upper):
        above = _extend(done, above, ["root"])
    above = above.select(F.col("sub").alias("tree"), F.lit(0).cast("long").alias("place"), F.col("digest").alias("subroot"), "root", "places", "siblings")
    for done in reversed(rounds):
        above = _extend(done, above, ["subroot", "root"])
    return above.drop("place")


def fold(digest, places, siblings) -> "F.Column":
    """The root that a digest and a witness give."""
    def step(acc, level):
        at, others = level["place"], level["others"]
        return F.sha2(F.concat(F.concat_ws("", F.slice(others, F.lit(1), at)), acc,
                               F.concat_ws("", F.slice(others, at + 1, F.greatest(F.size(others) - at, F.lit(0))))), 256)
    levels = F.zip_with(places, siblings, lambda p, s: F.struct(p.alias("place"), s.alias("others")))
    return F.aggregate(levels, digest, step)


def manifest(docs: DataFrame, columns: tuple[str, ...] = COLUMNS, tree_col: str = "lang", id_col: str = "doc_id",
             also: dict | None = None) -> DataFrame:
    """(id, leaf, subroot, root, places, siblings) of every row; ``also`` names further columns to carry."""
    values = [F.col(f"`{c}`") for c in columns]
    leaves = docs.select(tree_key(F.col(f"`{tree_col}`")).alias("tree"), F.col(f"`{id_col}`").alias("id"),
                         leaf_digest(*values).alias("digest"), *[v.alias(k) for k, v in (also or {}).items()])
    return witnesses(leaves, ["id"]).withColumnRenamed("digest", "leaf").drop("tree")


#: The letters that tampering lower-cases.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def op13_merkle(spark, sf_dir: str) -> DataFrame:
    """Contract query over the whole documents table."""
    from kindling.sources.tables import table
    docs = table(spark, sf_dir, "documents")
    changed = leaf_digest(*[F.translate(c, UPPER, LOWER) if c == "text" else F.col(c) for c in COLUMNS])
    hit = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    got = manifest(docs, also={"tampered": F.when(hit, changed)})
    folded = fold(F.coalesce("tampered", "leaf"), F.col("places"), F.col("siblings"))
    got = got.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root",
                     F.sha2(F.concat_ws("", F.flatten("siblings")), 256).alias("proof_sha256"), folded.alias("folded_root"))
    return got.withColumn("verified", F.col("folded_root") == F.col("root"))


def _sql(depth: int = 9) -> str:
    """Every level as one step, ``depth`` levels in a tree (8^9 leaves) and as many over the subroots."""
    def climb(name: str, source: str, by: str, order: str) -> tuple[list[str], str]:
        steps = [f"{name}0 AS (SELECT {by} AS t, row_number() OVER (PARTITION BY {by} ORDER BY {order}) - 1 AS i, "
                 f"count(*) OVER (PARTITION BY {by}) AS n, digest AS h FROM {source})"]
        for k in range(depth):
            steps.append(
                f"{name}{k + 1} AS (SELECT t, i // {FANOUT} AS i, any_value((n + {FANOUT - 1}) // {FANOUT}) AS n, "
                f"CASE WHEN any_value(n) = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h "
                f"FROM {name}{k} GROUP BY t, i // {FANOUT})")
        return steps, f"{name}{depth}"

    def runs(name: str) -> list[str]:
        return [f"{name}r{k} AS (SELECT t, i // {FANOUT} AS r, list(h ORDER BY i) AS hs FROM {name}{k} WHERE n > 1 GROUP BY t, i // {FANOUT})"
                for k in range(depth)]

    def fold_steps(name: str, start: str) -> tuple[list[str], str]:
        steps, cur = [], start
        for k in range(depth):
            here = f"(w.place_{name} // {FANOUT ** k})"
            place = f"({here} % {FANOUT})::BIGINT"
            steps.append(
                f"{name}w{k} AS (SELECT w.* REPLACE (w.proof || coalesce(array_to_string(hs[1:{place}], '') || array_to_string(hs[{place} + 2:], ''), '') AS proof, "
                f"CASE WHEN hs IS NULL THEN w.folded ELSE sha256(array_to_string(hs[1:{place}], '') || w.folded || array_to_string(hs[{place} + 2:], '')) END AS folded) "
                f"FROM {cur} w LEFT JOIN {name}r{k} x ON x.t = w.tree_{name} AND x.r = {here} // {FANOUT})")
            cur = f"{name}w{k}"
        return steps, cur

    def part(v: str) -> str:
        return f"coalesce(strlen({v})::VARCHAR || ':' || {v}, '-')"

    head = " || ".join(part(f"{c}::VARCHAR") for c in COLUMNS[:-1])
    low = f"translate(text, '{UPPER}', '{LOWER}')"
    crc = ("(SELECT list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::UBIGINT)), "
           "lambda a, c: list_reduce(list_prepend(xor(a, c), [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0]), "
           "lambda y, z: xor(y >> 1, (y & 1) * 3988292384::UBIGINT) + z)))")
    steps = [f"d AS (SELECT row_number() OVER () AS row, doc_id, {head} AS head, text, coalesce('=' || lang, '-') AS tree FROM documents)",
             f"l AS (SELECT row, doc_id, tree, sha256(head || {part('text')}) AS digest, "
             f"CASE WHEN xor({crc}, 4294967295::UBIGINT) % 3 = 0 THEN sha256(head || {part(low)}) END AS bad FROM d)"]
    one, top = climb("a", "l", "tree", "doc_id NULLS FIRST, digest, row")
    steps += one + runs("a")
    steps.append(f"subs AS (SELECT t AS tree, h AS digest, 0 AS one FROM {top})")
    two, root = climb("b", "subs", "one", "tree")
    steps += two + runs("b")
    steps.append(f"start AS (SELECT l.doc_id, l.digest AS leaf, s.digest AS subroot, (SELECT h FROM {root}) AS root, '' AS proof, coalesce(l.bad, l.digest) AS folded, "
                 "l.tree AS tree_a, row_number() OVER (PARTITION BY l.tree ORDER BY doc_id NULLS FIRST, l.digest, row) - 1 AS place_a, "
                 "0 AS tree_b, dense_rank() OVER (ORDER BY l.tree) - 1 AS place_b FROM l JOIN subs s ON s.tree = l.tree)")
    fa, cur = fold_steps("a", "start")
    fb, cur = fold_steps("b", cur)
    return ("WITH " + ",\n".join(steps + fa + fb) + "\nSELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, "
            f"folded = root AS verified FROM {cur}")


OP13_SQL = _sql()
