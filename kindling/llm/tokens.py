"""Token counts by byte-pair merging with a heap and a linked list; no identifiers are emitted.

A text is cut at the vocabulary's added tokens and by the pre-tokenizer's pattern. A piece starts as
its bytes; the lowest-rank adjacent pair, leftmost first, is popped from a heap and merged in a linked
list until no pair has a rank. A piece's tokens are its initial symbols less its merges. Pieces seen
before in a task are looked up; the table is emptied when full, which costs time and changes nothing.

Defined cases: null and empty texts have no tokens; a very long piece costs n log n; repeated rows each
get their row; other columns are not read. The vocabulary is read on the driver from a path that is a
parameter, and its merge ranks are broadcast (their size is the vocabulary's, not the data's).
"""
from __future__ import annotations

import json
from functools import partial
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindling.llm.common import thin

VOCABULARY = "byte_bpe_50k.json"
LIMIT_TOKENS = 1024
#: Pieces remembered in a task.
REMEMBERED = 500_000

#: Fixed value: the pre-tokenizer's pattern, white space spelled out as the Unicode property.
PIECES = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
          r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in the vocabulary file: itself where it is
    printable in Latin-1, else the next free code point from 256."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b if b in own else next(spare)) for b in range(256)]


def load_vocabulary(path: str) -> tuple[list[int], dict, list[str]]:
    """Symbols of the 256 bytes; (left, right) -> (rank, merged) on symbols; added tokens' strings."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    kind = spec.get("pre_tokenizer") or {}
    flags = [t for t in spec["added_tokens"] if t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]]
    if spec.get("normalizer") or kind.get("type") != "ByteLevel" or kind.get("add_prefix_space") or flags:
        raise ValueError(f"{path}: only plain byte-level BPE files are supported")
    ids = spec["model"]["vocab"]
    ranks = {}
    for rank, pair in enumerate(spec["model"]["merges"]):
        a, b = pair.split(" ") if isinstance(pair, str) else pair
        ranks[ids[a], ids[b]] = (rank, ids[a + b])
    return [ids[c] for c in byte_letters()], ranks, [t["content"] for t in spec["added_tokens"]]


def merged_length(symbols: list[int], ranks: dict) -> int:
    """Symbols left after merging the lowest-rank adjacent pair again and again."""
    n = len(symbols)
    nxt, prev = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(got[0], k, got[1], a, b) for k, (a, b) in enumerate(zip(symbols, symbols[1:])) if (got := ranks.get((a, b)))]
    heapify(heap)
    symbols = [*symbols, -1]
    left = n
    while heap:
        _, k, merged, a, b = heappop(heap)
        r = nxt[k]
        if symbols[k] != a or r >= n or symbols[r] != b:
            continue  # one of the two was merged meanwhile
        after = nxt[r]
        symbols[k], symbols[r], nxt[k] = merged, -1, after
        left -= 1
        if after < n:
            prev[after] = k
            if got := ranks.get((merged, symbols[after])):
                heappush(heap, (got[0], k, got[1], merged, symbols[after]))
        before = prev[k]
        if before >= 0 and (got := ranks.get((symbols[before], merged))):
            heappush(heap, (got[0], before, got[1], symbols[before], merged))
    return left


class _Lengths(dict):
    """Tokens of each piece."""

    def __init__(self, letters, ranks, remembered):
        super().__init__()
        self.letters, self.ranks, self.remembered = letters, ranks, remembered

    def __missing__(self, piece):
        if len(self) >= self.remembered:
            self.clear()
        got = self[piece] = merged_length([self.letters[b] for b in piece.encode("utf-8", "replace")], self.ranks)
        return got


def _count_batches(batches, vocabulary, remembered):
    letters, ranks, added = vocabulary.value
    lengths = _Lengths(letters, ranks, remembered)
    find = regex.compile(PIECES).findall
    cut = regex.compile("|".join(regex.escape(a) for a in sorted(added, key=len, reverse=True))) if added else None
    for batch in batches:
        got = []
        for text in batch.column(1):
            parts = cut.split(text.as_py() or "") if cut else [text.as_py() or ""]
            got.append(len(parts) - 1 + sum(sum(map(lengths.__getitem__, find(p))) for p in parts))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got, pa.int64()), batch.column(2)],
                                         ["doc_id", "n_tokens", "n_bytes"])


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 remembered: int = REMEMBERED) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of every row."""
    vocabulary = docs.sparkSession.sparkContext.broadcast(load_vocabulary(path))
    src = thin(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    src = src.withColumn("n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
    got = src.mapInArrow(partial(_count_batches, vocabulary=vocabulary, remembered=remembered),
                         "doc_id long, n_tokens long, n_bytes long")
    return got.select("doc_id", "n_bytes", "n_tokens")


def op7_token_counts(spark, sf_dir: str) -> DataFrame:
    """Contract query over the whole documents table."""
    import public_tokenizers

    from kindling.sources.tables import table
    got = token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))
    return got.withColumn("over_limit", F.col("n_tokens") > LIMIT_TOKENS)
