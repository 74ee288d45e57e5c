"""Bounded-space online packing of token ids into sequences of at most ``capacity`` ids.

Every partition keeps at most ``open_windows`` windows open. A document takes whole windows off its head
while it is longer than one; what is left goes, in one piece, to the window with the least room that
holds it, or opens a window. When none fits and all are open, the fullest is topped off with the head of
the document and emitted, and the rest is placed again. So emitted windows have no padding and a
document is cut only at window ends.

Leftovers are the open windows of all partitions. Groups of ``FAN`` partitions merge theirs by the same
packing, fullest first, and pass on at most ``open_windows`` again, until one group is left. Its last
windows are joined, cut into full sequences, and the rest into sequences of powers of two, largest first,
which need no padding. A merge sees at most FAN * open_windows windows, whatever the corpus.

Token ids: where the tokenizer's rules say that no token spans white space and that white space is
dropped, texts are cut at ASCII white space and the library encodes each different part once in a while
(a bounded table per worker); else it encodes whole texts.

Defined cases: null and empty texts have the closing id alone; a very long text takes as many windows as it
needs; repeated rows and doc_ids are packed one by one; a null doc_id is kept; doc_id keeps the input's
type; empty tables give empty results; other columns are not read. The result is a function of the
partitions of the scan: reruns over the same files agree.
"""
from __future__ import annotations

import json
import os
from array import array
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindling.llm.common import byte_slices, thin
from kindling.session import work_dir

VOCABULARY = "word_bpe_49k.json"
CAPACITY = 4096
CLOSING_ID = 2
#: Windows that a partition or a merge keeps open.
OPEN_WINDOWS = 16
#: Partitions whose leftovers are merged together.
FAN = 16
#: Parts of texts whose ids a worker remembers, and the longest of them.
REMEMBERED, REMEMBERED_BYTES = 1_000_000, 64
#: Text bytes handled at once, and closed sequences sent on at once.
SLICE_BYTES, SENT = 8 << 20, 256

_ID_BYTES = 4


def white_space_apart(path: str) -> bool:
    """The tokenizer's file says that white space ends every token and is in none."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    norm = spec.get("normalizer") or {}
    steps = norm.get("normalizers", [norm] if norm else [])
    pre = spec.get("pre_tokenizer") or {}
    cuts = pre.get("pretokenizers", [pre] if pre else [])
    first = cuts[0] if cuts else {}
    pattern = (first.get("pattern") or {}).get("Regex", "")
    plain = all(s.get("type") in ("NFC", "Lowercase") or s.get("type") == "Replace"
                and s.get("pattern") == {"Regex": r"\s+"} and s.get("content") == " " for s in steps)
    # matches are kept and the rest removed: letters, digits or runs that the pattern keeps free of white space
    drops = first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert") is True
    free = not any(x in pattern.replace(r"[^\s", "[^") for x in (r"\s", " ")) and pattern.count(r"[^") == pattern.count(r"[^\s")
    rest = all(c.get("type") == "ByteLevel" and not c.get("add_prefix_space") and not c.get("use_regex", True) for c in cuts[1:])
    added = all(not (t["lstrip"] or t["rstrip"] or t["single_word"] or any(ch.isspace() for ch in t["content"]))
                for t in spec.get("added_tokens", []))
    return bool(plain and drops and free and rest and added and not spec.get("post_processor"))


def lower_cased(path: str) -> bool:
    """The tokenizer's file lower-cases texts before it cuts them."""
    with open(path, encoding="utf-8") as f:
        norm = json.load(f).get("normalizer") or {}
    return any(s.get("type") == "Lowercase" for s in norm.get("normalizers", [norm]))


def word_ends(path: str) -> np.ndarray:
    """By id, whether a token ends a word; empty if the vocabulary does not mark ends of words."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    suffix, vocabulary = model.get("end_of_word_suffix"), model["vocab"]
    if not suffix:
        return np.zeros(0, bool)
    out = np.zeros(max(vocabulary.values()) + 1, bool)
    out[[k for t, k in vocabulary.items() if t.endswith(suffix)]] = True
    return out


def _byte_set(members: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(members)] = True
    return out


_SPACES = _byte_set(b" \t\n\x0b\x0c\r")
_UPPER = _byte_set(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LETTERS = _UPPER | _byte_set(b"abcdefghijklmnopqrstuvwxyz")
#: Marks that the pre-tokenizer takes alone when one of them ends a part behind a letter.
_MARKS = _byte_set(b".,;:!?")
#: Words of letters that are encoded as one text.
_JOINED = 200


class Encoder:
    """Little-endian unsigned 32-bit ids of UTF-8 texts."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.by_parts, self.lower, self.remembered = white_space_apart(path), lower_cased(path), remembered
        self.ends = word_ends(path)
        self.seen: dict[bytes, bytes] = {}

    def __call__(self, texts: list[bytes]) -> list[bytes]:
        if not self.by_parts:
            return self._encode([t.decode() for t in texts])
        if len(self.seen) > self.remembered:
            self.seen.clear()
        coded, ends = self._words(texts)
        words = coded.dictionary.to_pylist()
        ids = list(map(self.seen.get, words))
        if None in ids:
            own = self._learn([w for w, x in zip(words, ids) if x is None])
            ids = [own[w] if x is None else x for w, x in zip(words, ids)]
        # every word's ids, gathered from those of the different words
        sizes = np.fromiter(map(len, ids), np.int32, len(ids)) // _ID_BYTES
        flat, begins = np.frombuffer(b"".join(ids), "<u4"), np.cumsum(sizes, dtype=np.int32) - sizes
        codes = coded.indices.to_numpy()
        taken = sizes[codes]
        after = np.cumsum(taken)
        place = np.repeat((begins[codes] - (after - taken)).astype(np.int32), taken)
        place += np.arange(len(place), dtype=np.int32)
        got = flat[place]
        cuts = np.concatenate(([0], after))[ends]
        return [got[a:b].tobytes() for a, b in zip(np.concatenate(([0], cuts[:-1])).tolist(), cuts.tolist())]

    def _words(self, texts: list[bytes]) -> tuple[pa.DictionaryArray, np.ndarray]:
        """The parts between ASCII white space of all texts, and how many there are up to each text's end. A mark
        behind an ASCII letter is a part of its own, and parts of ASCII letters are lower-cased if the library does."""
        data = np.frombuffer(b"".join(t + b"\n" for t in texts), np.uint8)
        text_ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
        space, letter = _SPACES[data], _LETTERS[data]
        first = ~space
        first[1:] &= space[:-1]
        alone = _MARKS[data]
        alone[1:] &= letter[:-1]
        alone[:1] = False
        alone[:-1] &= space[1:]  # the last byte is a line end
        first |= alone
        starts = np.flatnonzero(first)
        kept = data[~space]
        at = np.cumsum(~space)[starts] - 1 if len(starts) else starts
        offsets = np.append(at, len(kept))
        if self.lower and len(starts):
            plain = np.add.reduceat(_LETTERS[kept].astype(np.int64), at) == np.diff(offsets)
            kept = kept + 32 * (np.repeat(plain, np.diff(offsets)) & _UPPER[kept]).astype(np.uint8)
        words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(kept)])
        return words.dictionary_encode(), np.searchsorted(starts, text_ends)

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, new: list[bytes]) -> dict[bytes, bytes]:
        """Ids of new parts. Parts of letters are one word each to the library, so many make one text, which is
        cut behind the tokens that end a word."""
        own = {}
        letters = [w for w in new if w.decode().isalpha()] if len(self.ends) else []
        groups = [letters[k: k + _JOINED] for k in range(0, len(letters), _JOINED)]
        for group, ids in zip(groups, self._encode([b" ".join(g).decode() for g in groups])):
            cuts = (np.flatnonzero(self.ends[np.frombuffer(ids, "<u4")]) + 1) * _ID_BYTES
            if len(cuts) == len(group) and cuts[-1] == len(ids):
                cuts = [0, *cuts.tolist()]
                own.update((w, ids[a:b]) for w, a, b in zip(group, cuts, cuts[1:]))
        rest = [w for w in new if w not in own]
        own.update(zip(rest, self._encode([w.decode() for w in rest])))
        self.seen.update((w, ids) for w, ids in own.items() if len(w) <= REMEMBERED_BYTES)
        return own


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder: what one task has learned serves the next."""
    if path not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


class Packer:
    """Open windows of one partition. A unit is a list of pieces (doc_id, start, ids, doc_tokens)."""

    def __init__(self, capacity: int, open_windows: int):
        self.capacity, self.most = capacity, open_windows
        self.open: list[list] = []  # [room, pieces]
        self.closed: list[list] = []

    def place(self, unit: list, size: int) -> None:
        while size >= self.capacity:
            head, unit = cut(unit, self.capacity)
            self.closed.append(head)
            size -= self.capacity
        while size:
            room, k = min(((w[0], k) for k, w in enumerate(self.open) if w[0] >= size), default=(0, None))
            if k is not None:  # the window with the least room that holds it
                self.open[k][1] += unit
                self.open[k][0] -= size
                if not self.open[k][0]:
                    self.closed.append(self.open.pop(k)[1])
                return
            if len(self.open) < self.most:
                self.open.append([self.capacity - size, list(unit)])
                return
            # none fits: the fullest is topped off and goes
            room, k = min((w[0], k) for k, w in enumerate(self.open))
            head, unit = cut(unit, room)
            size -= room
            self.closed.append(self.open.pop(k)[1] + head)

    def finish(self) -> None:
        """Join the open windows, cut full sequences, then powers of two."""
        rest = [p for w in sorted(self.open, key=lambda w: w[0]) for p in w[1]]
        self.open = []
        left = sum(len(p[2]) for p in rest) // _ID_BYTES
        while left:
            n = min(self.capacity, 1 << (left.bit_length() - 1)) if left < self.capacity else self.capacity
            head, rest = cut(rest, n)
            self.closed.append(head)
            left -= n


def cut(unit: list, n: int) -> tuple[list, list]:
    """The first n ids of a unit, and the rest."""
    head, rest = [], list(unit)
    while n:
        doc_id, start, ids, total = rest.pop(0)
        have = len(ids) // _ID_BYTES
        take = min(n, have)
        head.append((doc_id, start, ids[: take * _ID_BYTES], total))
        if take < have:
            rest.insert(0, (doc_id, start + take, ids[take * _ID_BYTES:], total))
        n -= take
    return head, rest


def _sequence_type(id_type: pa.DataType) -> pa.DataType:
    return pa.struct([("doc_id", id_type), ("start", pa.int64()), ("offset", pa.int64()), ("doc_tokens", pa.int64()),
                      ("ids", pa.binary())])


class _Rows:
    """Arrow batches of sequences; sequence ids hold the level, the part and a number."""

    def __init__(self, level: int, part: int, id_type: pa.DataType):
        self.base, self.part, self.n, self.id_type = (level << 56) | (part << 28), part, 0, id_type

    def batch(self, sequences: list[list], opened: bool) -> pa.RecordBatch:
        ends = np.cumsum([0] + [len(s) for s in sequences]).astype(np.int32)
        flat = [p for s in sequences for p in s]
        sizes = np.array([len(p[2]) // _ID_BYTES for p in flat], np.int64)
        before = np.concatenate(([0], np.cumsum(sizes)))
        first = before[ends[:-1]]
        lengths = before[ends[1:]] - first
        offsets = before[:-1] - np.repeat(first, np.diff(ends))
        kind = _sequence_type(self.id_type)
        pieces = pa.StructArray.from_arrays(
            [pa.array([p[0] for p in flat], self.id_type), pa.array([p[1] for p in flat], pa.int64()), pa.array(offsets, pa.int64()),
             pa.array([p[3] for p in flat], pa.int64()), pa.array([bytes(p[2]) for p in flat], pa.binary())], fields=list(kind))
        numbers = np.arange(self.n, self.n + len(sequences), dtype=np.int64) + self.base
        self.n += len(sequences)
        part = pa.array([self.part if opened else None] * len(sequences), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(numbers), part, pa.array(lengths, pa.int64()), pa.ListArray.from_arrays(pa.array(ends), pieces)],
            ["sequence_id", "part", "length", "pieces"])


def _pack_documents(batches, path, closing, capacity, open_windows):
    encode, packer, rows = encoder(path), Packer(capacity, open_windows), None
    end = np.array([closing], "<u4").tobytes()
    for batch in batches:
        rows = rows or _Rows(0, TaskContext.get().partitionId(), batch.column(0).type)
        for part in byte_slices(batch, 1, SLICE_BYTES):
            texts = pc.fill_null(part.column(1).cast(pa.binary()), b"").to_pylist()
            for doc_id, ids in zip(part.column(0).to_pylist(), encode(texts)):
                n = len(ids) // _ID_BYTES + 1
                packer.place([(doc_id, 0, memoryview(ids + end), n)], n)
                if len(packer.closed) >= SENT:
                    yield rows.batch(packer.closed, False)
                    packer.closed = []
    if rows and packer.closed:
        yield rows.batch(packer.closed, False)
    if rows and packer.open:
        yield rows.batch([w[1] for w in packer.open], True)


def _merger(level: int, last: bool, capacity: int, open_windows: int):
    def merge(table: pa.Table) -> pa.Table:
        got = table.sort_by([("length", "descending"), ("sequence_id", "ascending")])
        kind = got.schema.field("pieces").type.value_type.field("doc_id").type
        packer, rows = Packer(capacity, open_windows), _Rows(level, got.column("grp")[0].as_py(), kind)
        for size, pieces in zip(got.column("length").to_pylist(), got.column("pieces").to_pylist()):
            packer.place([(p["doc_id"], p["start"], p["ids"], p["doc_tokens"]) for p in pieces], size)
        if last:
            packer.finish()
        made = [rows.batch(x, o) for x, o in ((packer.closed, False), ([w[1] for w in packer.open], True)) if x]
        return pa.Table.from_batches(made)
    return merge


def pack(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
         closing: int = CLOSING_ID, open_windows: int = OPEN_WINDOWS, fan: int = FAN) -> DataFrame:
    """(sequence_id, length, pieces) of every sequence; a piece has doc_id, start, offset, doc_tokens and ids,
    little-endian unsigned 32-bit integers. The written table holds the ids once; leftovers once a level."""
    if capacity < 1 or open_windows < 1 or fan < 2:
        raise ValueError("capacity and open_windows must be 1 or more, fan 2 or more")
    spark = docs.sparkSession
    src = thin(docs, doc_id=id_col, text=text_col).select("doc_id", F.col("text").cast("string"))
    kind = src.schema["doc_id"].dataType.simpleString()
    pieces = f"array<struct<doc_id:{kind},start:bigint,offset:bigint,doc_tokens:bigint,ids:binary>>"
    schema = f"sequence_id long, part long, length long, pieces {pieces}"
    base = work_dir(spark, f"packing-{os.urandom(8).hex()}")

    def kept(df: DataFrame, level: int) -> DataFrame:
        df.write.option("compression", "zstd").parquet(f"{base}/{level}")
        return spark.read.schema(schema).parquet(f"{base}/{level}")

    got = kept(src.mapInArrow(partial(_pack_documents, path=path, closing=closing, capacity=capacity,
                                      open_windows=open_windows), schema), 0)
    done, level = got.where("part IS NULL"), 0
    while (most := got.agg(F.max("part")).first()[0]) is not None:
        level += 1
        left = got.where("part IS NOT NULL").withColumn("grp", F.expr(f"part div {fan}"))

        got = kept(left.groupBy("grp").applyInArrow(_merger(level, most < fan, capacity, open_windows), schema), level)
        done = done.unionByName(got.where("part IS NULL"))
    return done.drop("part")


def op11_packing(spark, sf_dir: str) -> DataFrame:
    """Contract query over the whole documents table."""
    import public_tokenizers

    from kindling.sources.tables import table
    got = pack(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))
    piece = got.select("sequence_id", F.explode("pieces").alias("p"))
    return piece.select("p.doc_id", "p.start", F.expr(f"octet_length(p.ids) div {_ID_BYTES}").cast("long").alias("length"),
                        F.crc32("p.ids").alias("ids_crc32"), "p.doc_tokens", "sequence_id", "p.offset")
