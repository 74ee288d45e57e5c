"""Substring dedup with repeated-phrase automata.

A window is ``window`` consecutive words of one document. A word goes if a window over it also
starts, word for word, in a document with a smaller doc_id.

1. Documents are packed, in the order of the scan, into shards of about ``shard_words`` words. The
   shards are a bucketed table in the shared folder, so that later steps read them without a shuffle.
2. Confirming recurring passages: every shard sends its distinct windows (64-bit hashes) with the
   smallest doc_id that has each, sorted and packed by hash range. A range answers which windows other
   shards have too, and the smallest doc_id of those. A window in a third of all documents is one entry
   per shard. A window also recurs if several documents of the shard have it.
3. Each shard compiles a pyahocorasick automaton over the recurring phrases of all its documents (a run of
   windows with one first document is compiled as the phrases that cover it) and streams all its documents
   through it. What goes follows from the occurrences that the automaton locates: the words of one that
   lies in a document other than the phrase's first.

Hash collisions: a window is wrongly taken for a repeat with a chance of (windows / 2^64), 1e-11 at
10^8 windows and 1e-6 at 100 TB. Windows of one shard are compared by word in the automaton.

Defined cases: null and empty texts have no words; documents shorter than a window lose nothing; rows
with one doc_id do not count as smaller than each other, so repeated rows of a doc_id all stay; a null
doc_id is larger than all others; empty tables give empty results; other columns are not read.
"""
from __future__ import annotations

import uuid
from functools import partial

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindling.llm.common import pieces, text_bytes, thin
from kindling.session import temporary_table, work_dir

WINDOW_WORDS = 13
#: Words packed and compiled together; bounds a task's memory, never the result.
SHARD_WORDS = 500_000
#: Text bytes behind one hash range: as small as the first, as the corpus over RANGES, as large as the last.
RANGE_BYTES, RANGES, RANGE_BYTES_MOST = 4 << 20, 4096, 256 << 20
#: Text bytes behind one bucket of the shards' table, a bucket being one task.
BUCKET_BYTES = 64 << 20

LAST_ID = np.iinfo(np.int64).max  # stands for a null doc_id
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def _pack(batches, shard_words):
    """Shards of whole documents: ids, and words joined by spaces, a line a document, compressed."""
    part, seq = TaskContext.get().partitionId(), 0
    ids, lines, words = [], [], 0

    def shard():
        body = zstandard.ZstdCompressor(level=3).compress(b"".join(x + b"\n" for x in lines))
        return pa.RecordBatch.from_arrays(
            [pa.array([(part << 32) | seq], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([body], pa.binary())],
            ["shard", "ids", "body"])

    for batch in batches:
        for doc_id, text in zip(batch.column(0), batch.column(1)):
            found = (text.as_py() or "").encode("utf-8", "replace").split()
            ids.append(doc_id.as_py())
            lines.append(b" ".join(found))
            words += len(found) + 1
            if words >= shard_words:
                yield shard()
                ids, lines, words, seq = [], [], 0, seq + 1
    if ids:
        yield shard()


class _Shard:
    """Words, documents and windows of one packed shard; documents in order of doc_id, null last."""

    def __init__(self, ids, body, window):
        ids = np.array([LAST_ID if x is None else x for x in ids], np.int64)
        lines = zstandard.ZstdDecompressor().decompress(body).split(b"\n")[:-1]
        self.order = np.argsort(ids, kind="stable")
        self.ids = ids[self.order]
        data = b"".join(lines[k] + b" " for k in self.order if lines[k])
        self.counts = np.array([lines[k].count(b" ") + 1 if lines[k] else 0 for k in self.order], np.int64)
        self.starts = np.concatenate(([0], np.cumsum(self.counts)))
        ends = np.flatnonzero(np.frombuffer(data, np.uint8) == 0x20).astype(np.int64) + 1
        self.data, self.offsets = data, np.concatenate((np.zeros(1, np.int64), ends))
        coded = pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(self.offsets), pa.py_buffer(data)]
                                      ).dictionary_encode()
        self.codes = coded.indices.to_numpy(zero_copy_only=False)
        digest = xxhash.xxh3_64_intdigest
        distinct = np.fromiter((digest(w) for w in coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
        n = len(self.codes)
        # words of a document end where the next begins: only windows inside one document count
        last = np.repeat(self.starts[1:], self.counts)
        self.at = np.flatnonzero(np.arange(n) + window <= last)
        hashes = np.zeros(max(0, n - window + 1), np.uint64)
        for j in range(window):
            hashes *= MULTIPLIER
            hashes += distinct[self.codes[j: j + len(hashes)]]
        hashes = hashes[self.at]
        hashes ^= hashes >> np.uint64(32)
        hashes *= np.uint64(0xD6E8FEB86659FD93)
        hashes ^= hashes >> np.uint64(32)
        self.doc = np.searchsorted(self.starts, self.at, "right") - 1
        by = np.argsort(hashes, kind="stable")
        ranked = hashes[by]
        new = np.ones(len(by), bool)
        new[1:] = ranked[1:] != ranked[:-1]
        self.keys = ranked[new]
        self.key_of = np.empty(len(by), np.int64)
        self.key_of[by] = np.cumsum(new) - 1
        self.least = self.ids[self.doc[by[new]]]  # stable: the first holder has the smallest doc_id
        # windows of several documents: the last holder has another doc_id than the first
        self.many = self.ids[self.doc[by[np.append(new[1:], True)]]] > self.least if len(by) else np.zeros(0, bool)

    def cuts(self, ranges: int) -> np.ndarray:
        """Where each of the equal hash ranges begins among the sorted keys."""
        edge = (np.arange(1, ranges, dtype=object) * (1 << 64)) // ranges
        return np.concatenate(([0], np.searchsorted(self.keys, np.array(edge, np.uint64)), [len(self.keys)])).astype(np.int64)


def _planes(x: np.ndarray) -> bytes:
    """64-bit integers by byte planes, compressed: the high bytes of small ones cost nothing."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8).T).tobytes())


def _unplanes(b: bytes, kind) -> np.ndarray:
    got = np.frombuffer(zstandard.ZstdDecompressor().decompress(b), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(got.T).view(kind).ravel()


def _send(batches, window, ranges):
    for batch in batches:
        for name, ids, body in zip(*(batch.column(k).to_pylist() for k in range(3))):
            shard = _Shard(ids, body, window)
            cut = shard.cuts(ranges)
            rows = [], [], [], []
            for r in np.flatnonzero(np.diff(cut)).tolist():
                part = slice(cut[r], cut[r + 1])
                rows[0].append(r)
                rows[1].append(name)
                rows[2].append(_planes(np.diff(shard.keys[part], prepend=np.uint64(0))))
                rows[3].append(_planes(shard.least[part]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.int64()), pa.array(rows[2], pa.binary()), pa.array(rows[3], pa.binary())],
                ["range", "shard", "keys", "least"])


def _answer(table: pa.Table) -> pa.Table:
    """For each shard of a range: a bit for each of its windows, set if other shards have it, and the smallest doc_id of those."""
    shards = table.column("shard").to_pylist()
    keys = [np.cumsum(_unplanes(b.as_py(), np.uint64), dtype=np.uint64) for b in table.column("keys")]
    sizes = np.array([len(k) for k in keys])
    keys = np.concatenate(keys)
    least = np.concatenate([_unplanes(b.as_py(), np.int64) for b in table.column("least")])
    by = np.argsort(keys)
    keys = keys[by]
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    del keys
    starts, group = np.flatnonzero(new), np.cumsum(new) - 1
    shared, first = np.empty(len(by), bool), np.empty(len(by), np.int64)
    shared[by] = (np.diff(np.append(starts, len(by))) > 1)[group]
    first[by] = np.minimum.reduceat(least[by], starts)[group]
    ends = np.cumsum(sizes)
    parts = [slice(e - s, e) for e, s in zip(ends, sizes)]
    r = table.column("range").to_pylist()[0]
    return pa.table({"shard": pa.array(shards, pa.int64()), "range": pa.array([r] * len(shards), pa.int64()),
                     "n": pa.array(sizes, pa.int64()), "bits": pa.array([np.packbits(shared[p]).tobytes() for p in parts], pa.binary()),
                     "first": pa.array([_planes(first[p][shared[p]]) for p in parts], pa.binary())})


def _locate(shard: _Shard, recurs: np.ndarray, first: np.ndarray, window: int) -> np.ndarray:
    """Which words go, from the occurrences of recurring phrases that the shard's automaton locates in its documents."""
    gone = np.zeros(len(shard.codes) + 1, np.int32)
    held = np.flatnonzero(recurs[shard.key_of])
    if not len(held):
        return gone[:-1].astype(bool)
    # windows of a run with one first document: the first, every window-th after it, and the last cover the same words as all
    at, whose = shard.at[held], first[shard.key_of[held]]
    begins = np.ones(len(held), bool)
    begins[1:] = (at[1:] != at[:-1] + 1) | (shard.doc[held][1:] != shard.doc[held][:-1]) | (whose[1:] != whose[:-1])
    ends = np.append(begins[1:], True)
    since = np.arange(len(held)) - np.maximum.accumulate(np.where(begins, np.arange(len(held)), 0))
    phrases = held[(since % window == 0) | ends]
    phrases = phrases[np.unique(shard.key_of[phrases], return_index=True)[1]]
    machine = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    codes = shard.codes
    for k in phrases.tolist():
        a = int(shard.at[k])
        machine.add_word(tuple(codes[a: a + window].tolist()), int(shard.key_of[k]))
    machine.make_automaton()
    spans = np.zeros(0, np.int64)
    for d in range(len(shard.ids)):
        a, b = int(shard.starts[d]), int(shard.starts[d + 1])
        if b - a < window:
            continue
        found = list(machine.iter(tuple(codes[a:b].tolist())))
        if found:
            spans = np.array(found, np.int64)
            spans = spans[first[spans[:, 1]] < shard.ids[d], 0] + a
            gone[spans - window + 1] += 1   # a place ends one occurrence at most
            gone[spans + 1] -= 1
    return gone[:-1].cumsum() > 0


def _remove(batches, window):
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])
    for batch in batches:
        for ids, body, answers in zip(*(batch.column(k).to_pylist() for k in range(3))):
            shard = _Shard(ids, body, window)
            answers = sorted(answers or [], key=lambda x: x["range"])
            shared = [np.unpackbits(np.frombuffer(x["bits"], np.uint8), count=x["n"]).astype(bool) for x in answers]
            shared = np.concatenate(shared) if shared else np.zeros(0, bool)
            if len(shared) != len(shard.keys):
                raise RuntimeError("a shard's answers don't match its windows")
            first = shard.least.copy()
            if answers:
                first[shared] = np.concatenate([_unplanes(x["first"], np.int64) for x in answers])
            gone = _locate(shard, shared | shard.many, first, window)
            n_removed = np.diff(np.concatenate(([0], np.cumsum(gone)))[shard.starts])
            kept = []
            for d in range(len(shard.ids)):
                a, b = shard.starts[d], shard.starts[d + 1]
                if not n_removed[d]:
                    kept.append(shard.data[shard.offsets[a]: max(shard.offsets[a], shard.offsets[b] - 1)])
                    continue
                stay = np.flatnonzero(~gone[a:b]) + a
                kept.append(b"".join(shard.data[p:q] for p, q in
                                     zip(shard.offsets[stay].tolist(), shard.offsets[stay + 1].tolist()))[:-1])
            for lo in range(0, len(kept), 4096):
                part = slice(lo, lo + 4096)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([None if x == LAST_ID else x for x in shard.ids[part].tolist()], pa.int64()),
                     pa.array(shard.counts[part]), pa.array(n_removed[part]),
                     pa.array([x.decode("utf-8") for x in kept[part]], pa.string())], schema=schema)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW_WORDS,
                   shard_words: int = SHARD_WORDS) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) of every row: kept words joined by one space."""
    spark = docs.sparkSession
    src = thin(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    size = text_bytes(src, "text")
    ranges = pieces(size, min(max(RANGE_BYTES, size // RANGES), RANGE_BYTES_MOST))
    name = temporary_table(f"repeat_shards_{uuid.uuid4().hex}")
    (src.mapInArrow(partial(_pack, shard_words=shard_words), "shard long, ids array<long>, body binary")
     .write.bucketBy(max(int(spark.conf.get("spark.sql.shuffle.partitions")), pieces(size, BUCKET_BYTES)), "shard")
     .option("path", work_dir(spark, name)).format("parquet").saveAsTable(name))
    shards = spark.table(name)
    sent = shards.mapInArrow(partial(_send, window=window, ranges=ranges), "range long, shard long, keys binary, least binary")
    answers = (sent.groupBy("range").applyInArrow(_answer, "shard long, range long, n long, bits binary, first binary")
               .groupBy("shard").agg(F.collect_list(F.struct("range", "n", "bits", "first")).alias("answers")))
    return (shards.join(answers, "shard", "left").select("ids", "body", "answers")
            .mapInArrow(partial(_remove, window=window), "doc_id long, n_words long, n_removed long, kept string"))


def op1_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """Contract query over the whole documents table."""
    from kindling.sources.tables import table
    got = remove_repeats(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP1_SQL = f"""
WITH src AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
windows AS (SELECT r, doc_id, unnest(range(1, len(w) - {WINDOW_WORDS - 2})) AS i,
    unnest(list_transform(range(1, len(w) - {WINDOW_WORDS - 2}), lambda i: array_to_string(w[i:i + {WINDOW_WORDS - 1}], ' '))) AS s FROM src),
judged AS (SELECT r, i, doc_id > min(doc_id) OVER (PARTITION BY s) AS gone FROM windows),
places AS (SELECT DISTINCT r, p FROM (SELECT r, unnest(range(i, i + {WINDOW_WORDS})) AS p FROM judged WHERE gone)),
lost AS (SELECT r, list(p) AS ps FROM places GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(ps), 0)::BIGINT AS n_removed,
  sha256(array_to_string(list_filter(w, lambda x, i: NOT list_contains(coalesce(ps, []), i)), ' ')) AS kept_sha256
FROM src LEFT JOIN lost USING (r)
"""
