"""Language identification by multilingual mixture inference.

Learning counts letter trigrams (hashed to a fixed number of buckets) of every labelled training row and
smooths them to one distribution per language. A document is a mixture: its words are drawn from
languages in unknown proportions. Expectation-maximisation estimates the proportions from the words'
trigram likelihoods; languages are then taken out, smallest first, as long as the penalised likelihood
(half of log(words) a language) does not fall. The largest proportion left is the prediction and its
score.

EM runs over all documents of a batch at once, by segment sums. The model's size is languages x buckets,
whatever the corpus.

Proportions only compare languages. The pipeline's stage also tests a document's fit: the mean
log-likelihood of its trigrams, each word by the language that fits it best. It is set against the fits of
all learned rows, each without its own counts, so gibberish and unlearned languages go.

Defined cases: null texts and texts without a letter are ``und`` with score 0, as is everything if no
row is labelled; ties go to the first language by name; a null doc_id is neither learned from nor held
out; repeated rows each get their row; other columns are not read.
"""
from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindling.llm.common import byte_slices, packed, row_key, thin, unpacked, written

BUCKET_BITS = 18
SMOOTHING = 0.5
#: EM steps over all languages, and after each language taken out.
STEPS, STEPS_AFTER = 8, 4
#: Penalty of a language, times log(words) of the document.
PENALTY = 0.5
FOLDS = 5
#: Text bytes worked on at once; bounds a task's memory, never the result.
PART_BYTES = 2 << 20
UNKNOWN = "und"
#: The pipeline rejects documents whose main language has a lower proportion. A text of two or three
#: languages is kept; only one spread over more goes.
MIN_SCORE = 0.3
#: A fit is rejected if it lies further below the low quantile of the learned rows than ``FIT_MARGIN`` times
#: the quantile's distance from their median. Each counts as if it had ``PRIOR_TRIGRAMS`` of the mean fit
#: besides, as the fit of few words says little.
FIT_QUANTILE, FIT_MARGIN, PRIOR_TRIGRAMS = 0.001, 2, 20


def _letters(text):
    """Lower-case words of letters, joined and ended by single spaces; no letter: empty."""
    spaced = F.ltrim(F.regexp_replace(F.concat(F.coalesce(text.cast("string"), F.lit("")), F.lit(" ")), r"[^\p{L}]+", " "))
    return F.lower(spaced)


class _Words:
    """Words of a batch, in order: distinct word codes, documents' bounds, trigrams of distinct words."""

    def __init__(self, column, bits):
        data = b"".join(b if b.endswith(b" ") or not b else b + b" " for b in (x.as_py().encode("utf-8", "replace") for x in column))
        ends = np.flatnonzero(np.frombuffer(data, np.uint8) == 0x20).astype(np.int64) + 1
        offsets = np.concatenate((np.zeros(1, np.int64), ends))
        coded = pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(data)]).dictionary_encode()
        self.codes = coded.indices.to_numpy(zero_copy_only=False)
        sizes = np.array([x.as_py().count(" ") for x in column], np.int64)
        self.starts = np.concatenate(([0], np.cumsum(sizes)))
        # distinct words in one row of characters; a trigram is a letter with both neighbours, spaces included
        chars = np.frombuffer((" " + b"".join(coded.dictionary.to_pylist()).decode("utf-8")).encode("utf-32-le"), np.uint32).astype(np.uint64)
        middle = np.flatnonzero(chars[1:-1] != 0x20) + 1 if len(chars) > 2 else np.zeros(0, np.int64)
        mixed = (chars[middle - 1] * np.uint64(0x9E3779B97F4A7C15) + chars[middle] * np.uint64(0xC2B2AE3D27D4EB4F)
                 + chars[middle + 1] * np.uint64(0x165667B19E3779F9))
        mixed ^= mixed >> np.uint64(31)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        self.grams = (mixed >> np.uint64(64 - bits)).astype(np.int64)
        self.n = len(coded.dictionary)
        self.word_of = (np.cumsum(chars == 0x20) - 1)[middle]


def _count_batches(batches, bits):
    totals: dict[str, np.ndarray] = {}
    for part in (p for b in batches for p in byte_slices(b, 1, PART_BYTES)):
        languages = np.array([x.as_py() for x in part.column(0)], object)
        for lang in sorted(set(languages)):
            words = _Words(part.column(1).filter(pa.array(languages == lang)), bits)
            if not len(words.codes):
                continue
            weight = np.bincount(words.codes, minlength=words.n)
            got = np.bincount(words.grams, weights=weight[words.word_of], minlength=1 << bits)
            totals[lang] = totals.get(lang, 0) + got
    for lang, got in totals.items():
        at = np.flatnonzero(got)
        for lo in range(0, len(at), 1 << 16):
            part = at[lo: lo + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(part)), pa.array(part), pa.array(got[part].astype(np.int64))],
                                             ["lang", "bucket", "n"])


def _labelled(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return thin(docs, lang=lang_col, text=text_col).where("lang IS NOT NULL").select(
        F.col("lang").cast("string"), _letters(F.col("text")).alias("text"))


def _counts(labelled: DataFrame, bits: int):
    """(languages, counts [languages, buckets])"""
    counted = (labelled.mapInArrow(partial(_count_batches, bits=bits), "lang string, bucket long, n long")
               .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas())  # languages x buckets at most
    languages = sorted(set(counted["lang"]))
    table = np.zeros((len(languages), 1 << bits))
    place = {lang: k for k, lang in enumerate(languages)}
    table[counted["lang"].map(place).to_numpy(int), counted["bucket"].to_numpy(int)] = counted["n"].to_numpy(float)
    return languages, table


def _totals(table: np.ndarray) -> np.ndarray:
    """Smoothed trigrams of each language, over the buckets seen and one more."""
    seen = max(1, int((table.sum(0) > 0).sum())) + 1
    return table.sum(1, keepdims=True, dtype=float) + SMOOTHING * seen


def _log_likelihoods(table: np.ndarray) -> np.ndarray:
    return np.log((table + SMOOTHING) / _totals(table)).astype(np.float32)


def learn(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", bits: int = BUCKET_BITS):
    """(languages, log-likelihoods [languages, buckets]) from every row with a language."""
    languages, table = _counts(_labelled(labelled, text_col, lang_col), bits)
    return languages, _log_likelihoods(table)


def _by_word(words: _Words, table: np.ndarray) -> np.ndarray:
    return np.array([np.bincount(words.word_of, weights=row[words.grams], minlength=words.n) for row in table])


def fits(words: _Words, table: np.ndarray):
    """(log-likelihood, trigrams) of every document, each word by the language that fits it best."""
    each = _by_word(words, table).max(0)[words.codes], np.bincount(words.word_of, minlength=words.n)[words.codes]
    sums = [np.concatenate(([0], np.cumsum(x))) for x in each]
    return tuple(x[words.starts[1:]] - x[words.starts[:-1]] for x in sums)


def _learned_fit_batches(batches, model, bits):
    """Fit of every learned row, without the row's own counts."""
    languages, counts = model.value
    place = {lang: k for k, lang in enumerate(languages)}
    logs, totals = _log_likelihoods(counts), _totals(counts)
    for part in (p for b in batches for p in byte_slices(b, 1, PART_BYTES)):
        words, found = _Words(part.column(1), bits), ([], [])
        by_word, size = _by_word(words, logs), np.bincount(words.word_of, minlength=words.n)
        first = np.cumsum(size) - size
        for lang, lo, hi in zip(part.column(0).to_pylist(), words.starts, words.starts[1:]):
            if lo == hi:
                continue
            own, times = np.unique(words.codes[lo:hi], return_counts=True)
            n = size[own]
            grams = words.grams[np.repeat(first[own] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
            weight = np.repeat(times, n)
            distinct, at = np.unique(grams, return_inverse=True)
            held = np.bincount(at, weights=weight)[at]
            k = place[lang]
            left = np.maximum(counts[k, grams] - held, 0)
            best = by_word[:, own]
            best[k] = np.bincount(np.repeat(np.arange(len(own)), n), minlength=len(own), weights=np.log(
                (left + SMOOTHING) / (totals[k, 0] - weight.sum())))
            found[0].append(float((best.max(0) * times).sum()))
            found[1].append(int((n * times).sum()))
        yield pa.RecordBatch.from_arrays([pa.array(found[0], pa.float64()), pa.array(found[1], pa.int64())], ["loglik", "trigrams"])


def _fit(mean: float) -> "F.Column":
    return (F.col("loglik") + PRIOR_TRIGRAMS * mean) / (F.col("trigrams") + PRIOR_TRIGRAMS)


def least_fit(labelled: DataFrame, languages: list, counts: np.ndarray, bits: int = BUCKET_BITS) -> tuple[float, float]:
    """(mean fit of a trigram, least fit of a document) from all learned rows (lang, text)."""
    sent = labelled.sparkSession.sparkContext.broadcast((languages, counts.astype(np.float32)))
    got = written(labelled.mapInArrow(partial(_learned_fit_batches, model=sent, bits=bits), "loglik double, trigrams long"), "lang-fits")
    mean = got.agg(F.sum("loglik") / F.sum("trigrams")).first()[0]
    if mean is None:
        return 0.0, float("-inf")
    low, median = got.agg(F.percentile_approx(_fit(mean), [FIT_QUANTILE, 0.5], 10000)).first()[0]
    return mean, low - FIT_MARGIN * (median - low)


def _proportions(like, starts, share, steps):
    """EM for all documents: share [languages, documents], and the log-likelihood of each."""
    sizes = np.diff(starts)
    for step in range(steps + 1):
        part = like * np.repeat(share, sizes, axis=1)
        total = part.sum(0)
        np.maximum(total, 1e-30, out=total)
        if step < steps:
            part /= total
            share = np.add.reduceat(part, starts[:-1], axis=1) / sizes
    return share, np.add.reduceat(np.log(total), starts[:-1])


def mixtures(words: _Words, table: np.ndarray) -> np.ndarray:
    """Language proportions [languages, documents with words] after selection."""
    by_word = np.zeros((len(table), words.n), np.float32)
    for k, row in enumerate(table):
        by_word[k] = np.bincount(words.word_of, weights=row[words.grams], minlength=words.n)
    by_word = np.exp(np.maximum(by_word - by_word.max(0), -30))
    sizes = np.diff(words.starts)
    starts = np.concatenate(([0], np.cumsum(sizes[sizes > 0])))
    like = by_word[:, words.codes]
    k, docs = len(table), len(starts) - 1
    share, fit = _proportions(like, starts, np.full((k, docs), 1.0 / k, np.float32), STEPS)
    price = PENALTY * np.log(np.maximum(np.diff(starts), 2))
    open_ = np.ones(docs, bool)
    for left in range(k - 1, 0, -1):
        rows = np.flatnonzero(open_)
        if not len(rows):
            break
        least = np.where(share[:, rows] > 0, share[:, rows], np.inf).argmin(0)
        trial = share[:, rows].copy()
        trial[least, np.arange(len(rows))] = 0
        weight = trial.sum(0)
        trial = np.where(weight > 0, trial / np.maximum(weight, 1e-30), 0).astype(np.float32)
        pick = np.repeat(open_, np.diff(starts))
        sub = np.concatenate(([0], np.cumsum(np.diff(starts)[rows])))
        trial, fitted = _proportions(like if pick.all() else like[:, pick], sub, trial, STEPS_AFTER if left > 1 else 0)
        better = fitted + price[rows] >= fit[rows]
        share[:, rows[better]] = trial[:, better]
        fit[rows[better]] = fitted[better]
        open_[rows[~better]] = False
    return share


def _predict_batches(batches, model, bits, with_fit=False):
    languages, table = model.value
    for batch in batches:
        for part in byte_slices(batch, 2, PART_BYTES):
            words = _Words(part.column(2), bits)
            pred, score = [UNKNOWN] * part.num_rows, np.zeros(part.num_rows)
            full = np.flatnonzero(np.diff(words.starts))
            if len(full) and languages:
                share = mixtures(words, table)
                best = share.argmax(0)
                score[full] = np.clip(share[best, np.arange(len(full))], 0, 1)
                for row, lang in zip(full.tolist(), best.tolist()):
                    pred[row] = languages[lang]
            columns = {"doc_id": part.column(0), "held_out": part.column(1), "lang_pred": pa.array(pred), "score": pa.array(score)}
            if with_fit:
                loglik, trigrams = fits(words, table) if len(full) and languages else np.zeros((2, part.num_rows))
                columns |= {"loglik": pa.array(loglik, pa.float64()), "trigrams": pa.array(trigrams.astype(np.int64))}
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def predict(docs: DataFrame, model, id_col: str = "doc_id", text_col: str = "text", bits: int = BUCKET_BITS,
            with_fit: bool = False) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row, and (loglik, trigrams) if asked for. ``model``: what
    ``learn`` gave."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    src = thin(docs, doc_id=id_col, text=text_col).select(
        F.col("doc_id").cast("long"), F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"),
        _letters(F.col("text")).alias("text"))
    return src.mapInArrow(partial(_predict_batches, model=sent, bits=bits, with_fit=with_fit),
                          "doc_id long, held_out boolean, lang_pred string, score double" + ", loglik double, trigrams long" * with_fit)


def fold(doc_id) -> "F.Column":
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Learn from the labelled rows outside the held-out fold, predict all rows."""
    return predict(docs, learn(docs.where(fold(F.col(id_col)) != 0), text_col, lang_col), id_col, text_col)


def keep_identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                    min_score: float = MIN_SCORE) -> DataFrame:
    """The documents with a main language of at least ``min_score`` and a fit like the learned rows', all
    columns kept. Every row is judged by its own text, whatever its id."""
    labelled = _labelled(docs.where(fold(F.col(id_col)) != 0), text_col, lang_col)
    languages, counts = _counts(labelled, BUCKET_BITS)
    mean, least = least_fit(labelled, languages, counts)
    text = F.col(f"`{text_col}`")
    key = row_key(F.col(f"`{id_col}`"), text)
    good = (predict(docs.select(key.alias("doc_id"), text.alias("text")), (languages, _log_likelihoods(counts)), with_fit=True)
            .where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= min_score) & (_fit(mean) >= least))
            .select(F.col("doc_id").alias("key")).distinct())
    return packed(docs, key=key).join(good, "key", "left_semi").select(*unpacked(docs.columns))


def op4_language_id(spark, sf_dir: str) -> DataFrame:
    """Contract query over the whole documents table."""
    from kindling.sources.tables import table
    return identify(table(spark, sf_dir, "documents"))
