"""Benchmark decontamination with one FM-index per training shard.

A shard is a run of whole documents of about ``shard_words`` words inside one task. Its words become
symbols, its suffix array gives the Burrows-Wheeler transform, a wavelet matrix answers ranks, and
every k-th text position keeps its suffix-array row. Test phrases are searched backwards, all at
once, and the occurrences found are located by walking to the next sampled position. Overlapping
occurrences merge into removal spans. Nothing is shuffled: a document lies in one shard.

The phrases are the stated query set. They are read in blocks of bounded size, each broadcast on its
own; a shard is indexed once and searched with one block after the other.

Defined cases: null and empty texts have no words, no hits; an item of fewer words than a window is
one window, an item without words none; repeated items, and windows shared by items, count for every
item once; a null item_id is named ``null``; repeated document rows each get their row; an empty
benchmark marks nothing; only the named columns are read.
"""
from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindling.llm.common import packed, row_key, thin, unpacked

WINDOW_WORDS = 10
#: Words indexed together; bounds a task's memory, never the result.
SHARD_WORDS = 1_000_000
#: Every how many text positions a suffix-array row is kept.
SAMPLE_EVERY = 16
#: Windows broadcast at once (about 100 bytes each).
BLOCK_WINDOWS = 200_000

#: A-Z to a-z; every other ASCII character than 0-9 and a-z to a space.
WORD_TABLE = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20
    for b in range(256))

END, BETWEEN, FIRST_WORD = 0, 1, 2  # symbols: end of shard, between documents, words from here


def suffix_array(ids: np.ndarray, bits: int) -> np.ndarray:
    """Rows of all suffixes in order: as many symbols as fit a key at first, then doubling among ties."""
    n, per = len(ids), max(1, 62 // bits)
    key = ids.astype(np.int64)
    for j in range(1, per):
        key <<= bits
        key[: max(0, n - j)] |= ids[j:]
    order = np.argsort(key)
    key = key[order]
    new = np.ones(n, bool)
    new[1:] = key[1:] != key[:-1]
    row = np.arange(n)
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, row, 0))
    slots = row[~(new & np.append(new[1:], True))]
    step = per
    while len(slots):
        sub = order[slots]
        after = sub + step
        second = np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        key = (rank[sub] << 32) | second
        by = np.argsort(key)
        sub, key = sub[by], key[by]
        order[slots] = sub
        new = np.ones(len(sub), bool)
        new[1:] = key[1:] != key[:-1]
        rank[sub] = slots[np.maximum.accumulate(np.where(new, np.arange(len(sub)), 0))]
        slots = slots[~(new & np.append(new[1:], True))]
        step *= 2
    return order


class Wavelet:
    """Wavelet matrix of a symbol sequence: packed bits with block counts for each level."""

    def __init__(self, symbols: np.ndarray, bits: int):
        n, self.bits, self.levels = len(symbols), bits, []
        symbols = symbols.astype(np.uint32)
        for shift in range(bits - 1, -1, -1):
            one = ((symbols >> shift) & 1).astype(bool)
            packed = np.zeros((n // 64 + 1) * 8, np.uint8)
            got = np.packbits(one, bitorder="little")
            packed[: len(got)] = got
            packed = packed.view(np.uint64)
            before = np.concatenate(([0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)))
            zeros = n - int(before[-1])
            self.levels.append((packed, before, zeros))
            symbols = np.concatenate((symbols[~one], symbols[one]))

    @staticmethod
    def _ones(level, at):
        packed, before, _ = level
        block = at >> 6
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return before[block] + np.bitwise_count(packed[block] & low)

    def down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where position ``at`` comes to lie if followed as ``symbol``; less the symbol's own start
        this is its rank before ``at``."""
        for k, level in enumerate(self.levels):
            one = (symbol >> (self.bits - 1 - k)) & 1
            ones = self._ones(level, at)
            at = np.where(one == 1, level[2] + ones, at - ones)
        return at

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each position, and where it comes to lie."""
        symbol = np.zeros(len(at), np.int64)
        for level in self.levels:
            one = ((level[0][at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)).astype(np.int64)
            ones = self._ones(level, at)
            symbol = (symbol << 1) | one
            at = np.where(one == 1, level[2] + ones, at - ones)
        return symbol, at


class FMIndex:
    """Counts, ranks and sampled positions of one shard. ``ids`` ends with the only END."""

    def __init__(self, ids: np.ndarray, sigma: int, every: int = SAMPLE_EVERY):
        n, bits = len(ids), max(1, int(sigma - 1).bit_length())
        rows = suffix_array(ids, bits)
        self.wavelet = Wavelet(ids[rows - 1], bits)
        counts = np.bincount(ids, minlength=1 << bits)
        self.less = np.concatenate(([0], np.cumsum(counts)[:-1]))
        codes = np.arange(1 << bits)
        turned = sum(((codes >> k) & 1) << (bits - 1 - k) for k in range(bits))
        self.start = np.empty(1 << bits, np.int64)  # the lowest level orders symbols by reversed bits
        self.start[turned] = np.concatenate(([0], np.cumsum(counts[turned])[:-1]))
        kept = rows % every == 0
        marks = np.zeros((n // 64 + 1) * 8, np.uint8)
        got = np.packbits(kept, bitorder="little")
        marks[: len(got)] = got
        marks = marks.view(np.uint64)
        self.marks = (marks, np.concatenate(([0], np.cumsum(np.bitwise_count(marks), dtype=np.int64))), 0)
        self.samples, self.n = rows[kept], n

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row intervals of phrases (one per line, same length), by backward search."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        live = np.arange(len(phrases))
        for column in phrases.T[::-1]:
            c = column[live]
            base = self.less[c] - self.start[c]
            low[live] = base + self.wavelet.down(c, low[live])
            high[live] = base + self.wavelet.down(c, high[live])
            live = live[low[live] < high[live]]
            if not len(live):
                break
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows: walk back to a sampled one, counting steps."""
        found, walk, steps = np.empty(len(rows), np.int64), np.arange(len(rows)), 0
        rows = rows.copy()
        while len(walk):
            marked = (self.marks[0][rows >> 6] >> (rows & 63).astype(np.uint64)) & np.uint64(1) == 1
            at = rows[marked]
            found[walk[marked]] = self.samples[Wavelet._ones(self.marks, at)] + steps
            walk, rows = walk[~marked], rows[~marked]
            symbol, down = self.wavelet.access(rows)
            rows = self.less[symbol] - self.start[symbol] + down
            steps += 1
        return found


def text_words(text: str | None) -> bytes:
    """The words of a text, each followed by a space."""
    got = (text or "").encode("utf-8", "replace").translate(WORD_TABLE).split()
    return b" ".join(got) + b" " if got else b""


def _coded(data: bytes) -> tuple[np.ndarray, pa.Array]:
    """Symbols and distinct words of space-ended words."""
    ends = np.flatnonzero(np.frombuffer(data, np.uint8) == 0x20).astype(np.int64) + 1
    offsets = np.concatenate((np.zeros(1, np.int64), ends))
    got = pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    got = got.dictionary_encode()
    return got.indices.to_numpy(zero_copy_only=False).astype(np.int64), got.dictionary


def _window_batches(batches, window):
    """(window, item) of every item."""
    for batch in batches:
        found = [], []
        for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            got = text_words(text).split()
            for k in range(max(1, len(got) - window + 1) if got else 0):
                found[0].append(b" ".join(got[k: k + window]))
                found[1].append("null" if item is None else str(item))
        yield pa.RecordBatch.from_arrays([pa.array(found[0], pa.binary()), pa.array(found[1], pa.string())],
                                         ["window", "item"])


def phrase_blocks(bench: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW_WORDS,
                  block: int = BLOCK_WINDOWS) -> list:
    """Broadcasts of at most ``block`` (window, item) rows; the driver holds one block at a time."""
    src = thin(bench, item=id_col, text=text_col).select(F.col("item").cast("string"), F.col("text").cast("string"))
    rows = (src.mapInArrow(partial(_window_batches, window=window), "window binary, item string")
            .distinct().repartition(F.col("window")))
    found, part = [], []

    def send():
        distinct: dict[bytes, list[str]] = {}
        for w, item in part:
            distinct.setdefault(w, []).append(item)
        found.append(bench.sparkSession.sparkContext.broadcast((list(distinct), list(distinct.values()))))
        part.clear()

    for row in rows.toLocalIterator():
        part.append((bytes(row["window"]), row["item"]))
        if len(part) >= block:
            send()
    if part:
        send()
    return found


class _Shard:
    """Whole documents of a task, indexed and searched together."""

    def __init__(self):
        self.ids, self.texts, self.which, self.words, self.places = [], [], [], 0, {}

    def add(self, doc_id, text):
        data = text_words(text)
        if data not in self.places:  # copies are indexed once
            self.places[data] = len(self.texts)
            self.texts.append(data)
            self.words += data.count(b" ") + 1
        self.ids.append(doc_id)
        self.which.append(self.places[data])

    def batch(self, blocks, schema) -> pa.RecordBatch:
        counts = np.array([t.count(b" ") for t in self.texts], np.int64)
        starts = np.concatenate(([0], np.cumsum(counts + 1)))
        symbols, distinct = _coded(b"".join(t + b"\x00 " for t in self.texts))
        symbols += FIRST_WORD
        symbols[starts[1:] - 1] = BETWEEN  # the word \x00 stands between documents and in no text
        symbols = np.append(symbols, END)
        index = FMIndex(symbols, len(distinct) + FIRST_WORD)
        cover = np.zeros(len(symbols) + 1, np.int64)
        items: list[set] = [set() for _ in self.texts]
        for block in blocks:
            windows, owners = block.value
            for size, at in _by_length(windows):
                data = b"".join(windows[k] + b" " for k in at)
                coded, vocabulary = _coded(data)
                here = pc.index_in(vocabulary, value_set=distinct).fill_null(-1).to_numpy(zero_copy_only=False)
                phrases = here.astype(np.int64)[coded].reshape(-1, size)
                known = np.flatnonzero((phrases >= 0).all(1))
                low, high = index.search(phrases[known] + FIRST_WORD)
                hit = np.flatnonzero(low < high)
                for part in _slices(high[hit] - low[hit]):
                    lo, n = low[hit[part]], (high - low)[hit[part]]
                    rows = np.repeat(lo - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
                    where = index.locate(rows)
                    np.add.at(cover, where, 1)
                    np.add.at(cover, where + size, -1)
                    doc = np.searchsorted(starts, where, "right") - 1
                    pairs = np.unique(doc * (1 << 32) + np.repeat(known[hit[part]], n))
                    for pair in pairs.tolist():
                        items[pair >> 32].update(owners[at[pair & 0xFFFFFFFF]])
        covered = cover[:-1].cumsum() > 0
        hits = np.concatenate(([0], np.cumsum(covered)))
        n_hit = hits[starts[1:]] - hits[starts[:-1]]
        edge = np.diff(np.concatenate(([0], covered.astype(np.int8), [0])))
        begin, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        span_doc = np.searchsorted(starts, begin, "right") - 1
        first = np.searchsorted(span_doc, np.arange(len(self.texts) + 1))
        spans = [[{"start": int(a - starts[d]), "stop": int(b - starts[d])}
                  for a, b in zip(begin[first[d]: first[d + 1]], stop[first[d]: first[d + 1]])]
                 for d in range(len(self.texts))]
        named = [sorted(x) for x in items]
        cols = [self.ids, counts[self.which], n_hit[self.which], [named[k] for k in self.which],
                [spans[k] for k in self.which]]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)


def _by_length(windows):
    sizes = np.array([w.count(b" ") + 1 for w in windows], np.int64)
    return [(int(size), np.flatnonzero(sizes == size)) for size in np.unique(sizes)]


def _slices(n: np.ndarray, most: int = 1 << 20):
    """Slices of at most about ``most`` occurrences, so a frequent phrase needs little memory at once."""
    group = np.cumsum(n) // most
    return [np.flatnonzero(group == g) for g in np.unique(group)]


def _search_batches(batches, blocks, shard_words):
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()),
                        ("items", pa.list_(pa.string())),
                        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))])
    shard = _Shard()
    for batch in batches:
        for doc_id, text in zip(batch.column(0), batch.column(1)):
            shard.add(doc_id.as_py(), text.as_py())
            if shard.words >= shard_words:
                yield shard.batch(blocks, schema)
                shard = _Shard()
    if shard.ids:
        yield shard.batch(blocks, schema)


def find_hits(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW_WORDS,
              shard_words: int = SHARD_WORDS, block: int = BLOCK_WINDOWS) -> DataFrame:
    """(doc_id, n_words, n_hit, items, spans) of every document row; spans are [start, stop) words."""
    blocks = phrase_blocks(bench, item_col, item_text_col, window, block)
    src = thin(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return src.mapInArrow(
        partial(_search_batches, blocks=blocks, shard_words=shard_words),
        "doc_id long, n_words long, n_hit long, items array<string>, spans array<struct<start:long,stop:long>>")


def drop_contaminated(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", **kw) -> DataFrame:
    """The documents in which no test phrase occurs, all columns kept; null ids are judged together."""
    bad = find_hits(docs, bench, id_col, **kw).where("n_hit > 0").select(F.col("doc_id").alias("hit")).distinct()
    rows = packed(docs, own=F.col(f"`{id_col}`").cast("long"))
    return rows.join(bad, F.col("own").eqNullSafe(F.col("hit")), "left_anti").select(*unpacked(docs.columns))


def drop_contaminated_rows(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """The rows in which no test phrase occurs, all columns kept. Every row is judged by its own text,
    whatever its id."""
    text = F.col(f"`{text_col}`")
    key = row_key(F.col(f"`{id_col}`"), text)
    bad = (find_hits(docs.select(key.alias("doc_id"), text.alias("text")), bench, **kw).where("n_hit > 0")
           .select(F.col("doc_id").alias("key")).distinct())
    return packed(docs, key=key).join(bad, "key", "left_anti").select(*unpacked(docs.columns))


def op5_decontamination(spark, sf_dir: str) -> DataFrame:
    """Contract query over the whole documents and benchmark tables."""
    from kindling.sources.tables import table
    got = find_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return got.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS_SQL = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
OP5_SQL = f"""
WITH src AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS_SQL} AS w FROM documents),
items AS (SELECT coalesce(item_id::VARCHAR, 'null') AS item, {_WORDS_SQL} AS w, least(len(w), {WINDOW_WORDS}) AS n FROM benchmark WHERE len(w) > 0),
phrases AS (SELECT DISTINCT item, n, unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS s FROM items),
windows AS (SELECT r, n, unnest(range(1, len(w) - n + 2)) AS i,
    unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS s
  FROM src CROSS JOIN (SELECT DISTINCT n FROM phrases) WHERE len(w) >= n),
hits AS (SELECT r, i, n, item FROM windows JOIN phrases USING (n, s)),
covered AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r),
named AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS names FROM hits GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM src LEFT JOIN covered USING (r) LEFT JOIN named USING (r)
"""
