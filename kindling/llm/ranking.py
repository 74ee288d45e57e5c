"""Ranked lexical search with NRA: sequential reads of impact-sorted postings, no random access.

1. One pass cuts every document into terms and writes, per document, its term count and the counts of those
   terms that the queries hold. Document frequencies and corpus totals are summed from that table.
2. A shard is a bounded run of documents in one task. It sorts the postings of each term by impact, and
   answers every query by NRA: lists are read in step, deeper each round; a document's lower bound is the
   sum of what was read of it, its upper bound adds, for each list in which it was not met, that list's
   next impact. Reading goes on until no unread document can reach the k-th lower bound, and every document
   whose upper bound reaches it has equal bounds: membership, ties and scores are then final.
3. A first wave over one written part in ``WAVE`` gives each query a floor: k documents score that much, so
   no document below it can be in the result. The second wave runs all shards against the floors, each
   task passing on at most k documents a query; the best k of those are the result.

Scale: queries are a stated set, taken in blocks of at most ``QUERY_BYTES`` of text (one larger item is a block
of its own); a block's terms go to the driver and to every task, nothing of the corpus does but one
number per term or query of the block. Each block reads the corpus once. No posting list is ever whole in one task: a term in a third
of all documents is a list per shard.

Defined cases: null texts (of documents or items) have no terms and are in no result; documents with a null
doc_id are ranked, last among equal scores; repeated rows are ranked one by one; an item id and text that is
repeated is ranked once; a null item id is kept; ids keep their types; very long texts are read whole; empty
tables give empty results; other columns are not read.
"""
from __future__ import annotations

import uuid
from collections import Counter
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kindling.llm.common import pieces, text_bytes, thin
from kindling.session import materialize

TOP = 50
#: Text bytes of the queries that are answered in one pass over the corpus.
QUERY_BYTES = 8 << 20
#: Documents and postings of one shard at most; they bound memory, never the result.
SHARD_DOCS, SHARD_POSTINGS = 1 << 15, 1 << 21
#: One written part in so many is searched first, for floors.
WAVE = 16
#: Postings read of each list in the first round; twice as many in each further one.
FIRST_READ = 64

#: Bytes to term bytes: letters lower-cased, digits and bytes above ASCII as they are, all else a space.
_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(_BYTES).split()


def weight(n_docs: int, df: np.ndarray) -> np.ndarray:
    """floor(1000 ln((2N + 2) / (2 df + 1))) in doubles."""
    return np.floor(1000 * np.log((2.0 * n_docs + 2) / (2.0 * df + 1))).astype(np.int64)


def impacts(tf: np.ndarray, n_terms: np.ndarray, n_docs: int, all_terms: int) -> np.ndarray:
    """A posting's score before the term's weight, in 64-bit integers."""
    m = 50 + (50 * n_terms * n_docs) // all_terms
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


def _count(batches, vocabulary):
    known, part = vocabulary.value, TaskContext.get().partitionId()
    for batch in batches:
        n, codes, counts, keep = [], [], [], []
        for k, text in enumerate(batch.column(1)):
            found = terms(text.as_py())
            if not found:
                continue
            held = [(known[t], c) for t, c in Counter(found).items() if t in known]
            keep.append(k)
            n.append(len(found))
            codes.append([x for x, _ in held])
            counts.append([c for _, c in held])
        yield pa.RecordBatch.from_arrays(
            [pa.array([part] * len(keep), pa.int64()), batch.column(0).take(pa.array(keep, pa.int64())), pa.array(n, pa.int64()),
             pa.array(codes, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int64()))], ["part", "doc_id", "n", "terms", "counts"])


class Shard:
    """Impact-sorted postings of a run of documents."""

    def __init__(self, n_terms, codes, doc, tf, n_docs, all_terms):
        self.size = len(n_terms)
        value = impacts(tf, n_terms[doc], n_docs, all_terms)
        by = np.lexsort((doc, -value, codes))
        self.doc, self.value, codes = doc[by], value[by], codes[by]
        self.code, self.start = np.unique(codes, return_index=True)
        self.end = np.append(self.start[1:], len(codes))
        self.lower, self.met = np.zeros(self.size, np.int64), np.zeros(self.size, np.int64)

    def lists(self, query: np.ndarray, weights: np.ndarray) -> list[tuple]:
        """(documents, scores) of each query term that the shard has and that has a weight."""
        k = np.searchsorted(self.code, query)
        k = np.minimum(k, max(0, len(self.code) - 1))
        found = []
        for q, at in zip(query.tolist(), k.tolist()):
            if len(self.code) and self.code[at] == q and weights[q] > 0:
                span = slice(self.start[at], self.end[at])
                found.append((self.doc[span], self.value[span] * weights[q]))
        return found

    def nra(self, query: np.ndarray, weights: np.ndarray, top: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents that may be among the best ``top`` of a larger set in which that many score ``floor``:
        all that do so and are not below ``top`` others here, with final scores."""
        lists = self.lists(query, weights)
        lower, met = self.lower, self.met
        lower[:] = 0
        at, depth = 0, FIRST_READ
        while True:
            heads = []
            for docs, scores in lists:
                lower[docs[at: at + depth]] += scores[at: at + depth]
                heads.append(int(scores[at + depth]) if at + depth < len(docs) else 0)
            at, depth = at + depth, depth * 2
            rest = sum(heads)
            least = max(floor, 1)
            if self.size >= top:
                least = max(least, int(np.partition(lower, self.size - top)[self.size - top]))
            if not rest:
                break
            if rest < least:  # no unread document can enter; are all that can stay resolved?
                met[:] = 0
                for (docs, _), head in zip(lists, heads):
                    if head:
                        met[docs[:at]] += head
                    else:  # read to its end: nothing is left of it for any document
                        continue
                upper = lower + rest - met
                if not ((upper >= least) & (upper > lower) & (lower > 0)).any():
                    break
        best = np.flatnonzero(lower >= least)
        return best, lower[best]


def _search(batches, job, top):
    queries, weights, floors, n_docs, all_terms, id_type = job.value
    held: list[list[tuple]] = [[] for _ in queries]
    least = list(floors)

    def shard():
        docs = np.concatenate([x[0] for x in parts])
        made = Shard(np.concatenate([x[1] for x in parts]), np.concatenate([x[2] for x in parts]),
                     np.repeat(np.arange(len(docs)), np.concatenate([x[4] for x in parts])), np.concatenate([x[3] for x in parts]), n_docs, all_terms)
        for q, query in enumerate(queries):
            best, scores = made.nra(query, weights, top, least[q])
            if not len(best):
                continue
            found = held[q] + [(-int(s), docs[k] is None, 0 if docs[k] is None else docs[k]) for k, s in zip(best.tolist(), scores.tolist())]
            found.sort()
            held[q] = found[:top]
            if len(held[q]) == top:
                least[q] = max(least[q], -held[q][-1][0])

    parts, n, postings = [], 0, 0
    for batch in batches:
        codes, sizes = batch.column(2), np.diff(batch.column(2).offsets.to_numpy())
        ids = np.empty(batch.num_rows, object)
        ids[:] = batch.column(0).to_pylist()
        parts.append((ids, batch.column(1).to_numpy(), codes.flatten().to_numpy(), batch.column(3).flatten().to_numpy(), sizes))
        n, postings = n + batch.num_rows, postings + len(codes.flatten())
        if n >= SHARD_DOCS or postings >= SHARD_POSTINGS:
            shard()
            parts, n, postings = [], 0, 0
    if parts:
        shard()
    rows = [(q, None if none else doc, -score) for q, best in enumerate(held) for score, none, doc in best]
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], id_type),
                                          pa.array([r[2] for r in rows], pa.int64())], ["q", "doc_id", "score"])


def _best(found: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def _answer(src: DataFrame, items: list, item_type, top: int) -> DataFrame:
    """(item_id, rank, doc_id, score) of one block of items."""
    spark = src.sparkSession
    sc = spark.sparkContext
    id_type = src.schema["doc_id"].dataType
    known: dict[bytes, int] = {}
    queries = []
    for _, text in items:
        codes = sorted({known.setdefault(t, len(known)) for t in terms(text)})
        queries.append(np.array(codes, np.int64))
    kind = id_type.simpleString()
    counted = materialize(src.mapInArrow(partial(_count, vocabulary=sc.broadcast(known)),
                                         f"part long, doc_id {kind}, n long, terms array<int>, counts array<bigint>"), "ranking-terms")
    n_docs, all_terms = counted.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(known), np.int64)
    for code, n in counted.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # as many as terms of the block
        df[code] = n
    weights = weight(n_docs, df)

    def searched(part: DataFrame, floors: list[int]) -> DataFrame:
        from pyspark.sql.pandas.types import to_arrow_type
        job = sc.broadcast((queries, weights, floors, n_docs, max(1, all_terms), to_arrow_type(id_type)))
        return part.select("doc_id", "n", "terms", "counts").mapInArrow(partial(_search, job=job, top=top), f"q long, doc_id {kind}, score long")

    floors = [0] * len(queries)
    first = _best(searched(counted.where(F.col("part") % WAVE == 0), floors), top).where(F.col("rank") == top)
    for row in first.select("q", "score").collect():  # one number a query
        floors[row.q] = row.score
    best = _best(searched(counted, floors), top)
    names = spark.createDataFrame([(q, item) for q, (item, _) in enumerate(items)], f"q long, item_id {item_type}")
    return best.join(names, "q").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def search(docs: DataFrame, queries: DataFrame, top: int = TOP, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text: str = "text", query_bytes: int = QUERY_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents of every item, fewer where fewer score above 0."""
    if top < 1:
        raise ValueError("top must be 1 or more")
    src = thin(docs, doc_id=id_col, text=text_col).select("doc_id", F.col("text").cast("string"))
    asked = thin(queries, item_id=item_col, text=item_text).select("item_id", F.col("text").cast("string")).where("text IS NOT NULL").distinct()
    item_type = asked.schema["item_id"].dataType.simpleString()
    asked = materialize(asked, f"ranking-items-{uuid.uuid4().hex[:8]}")
    blocks = pieces(text_bytes(asked, "text"), query_bytes)
    answers = None
    for b in range(blocks):
        items = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect() if blocks > 1 else asked.collect()
        got = _answer(src, [(r.item_id, r.text) for r in items], item_type, top)
        answers = got if answers is None else answers.unionByName(got)
    return answers


def op12_ranked_search(spark, sf_dir: str) -> DataFrame:
    """Contract query: every benchmark item against the whole documents table."""
    from kindling.sources.tables import table
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP12_SQL = rf"""
WITH items AS (SELECT DISTINCT item_id, text FROM benchmark WHERE text IS NOT NULL),
asked AS (SELECT row_number() OVER () AS q, item_id, list_distinct(regexp_extract_all({_LOWERED}, '{_TERM}')) AS ts FROM items),
terms AS (SELECT DISTINCT unnest(ts) AS t FROM asked),
docs AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWERED}, '{_TERM}') AS w FROM documents WHERE text IS NOT NULL),
sizes AS (SELECT r, doc_id, len(w)::BIGINT AS n FROM docs WHERE len(w) > 0),
corpus AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS all_terms FROM sizes),
postings AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM docs) WHERE t IN (SELECT t FROM terms) GROUP BY r, t),
weights AS (SELECT t, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS weight FROM postings, corpus GROUP BY t),
scored AS (SELECT r, doc_id, t, weight * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * n_docs) // all_terms)))) AS part
  FROM postings JOIN sizes USING (r) JOIN weights USING (t), corpus),
totals AS (SELECT q, item_id, r, doc_id, sum(part)::BIGINT AS score FROM (SELECT q, item_id, unnest(ts) AS t FROM asked) JOIN scored USING (t) GROUP BY q, item_id, r, doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank FROM totals WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= {TOP}
"""
