"""Quality rules: a threshold table compiled into one Spark projection, without user functions.

Base statistics of a text are columns; each rule is a row of ``RULES``: a ratio of two of them and the
bounds it must keep. ``compile_rules`` turns the table into expressions of one projection.

Words found in repeated windows: the hashes of a text's windows are sorted with their positions,
neighbours that are equal mark repeats, and the marked positions are merged into covered words. A text
is one row throughout; nothing is exploded or shuffled. Windows are compared by 64-bit hashes within
one text, where a collision has a chance of (windows^2 / 2^65).

Defined cases: null, empty and blank texts have no words, all counts zero, and fail the base; a ratio
with denominator zero is zero; repeated rows each get their row; other columns are not read.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindling.llm.common import thin, words

WINDOW_WORDS = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

#: Characters counted as symbols.
SYMBOLS = r"[#*$%&|<>]"
#: A character other than ASCII white space.
WORD_CHARACTER = r"[^\x20\x09-\x0D]"

#: Common words of the languages served, in lower case.
STOP_WORDS = {
    "en": "the of and to a in is that it was for on are as with his they at be this from have or by".split(),
    "de": "der die und das den von zu mit ist des im dem nicht ein eine als auch es an auf für".split(),
    "fr": "de la le et les des en un une du dans est que pour qui sur pas au par avec ce".split(),
    "es": "de la que el en y a los se del las un por con una su para es al lo como".split(),
}

#: name: (numerator, denominator, least, most); None: no bound.
RULES = {
    "mean_word_length": ("word_chars", "n_words", 2.0, 14.0),
    "symbols_per_word": ("n_symbols", "n_words", None, 0.1),
    "words_per_stop_word": ("n_words", "n_stop_words_and_one", None, 30.0),
    "doubled_word_share": ("n_doubled_words", "n_words", None, 0.2),
    "duplicate_line_share": ("n_dup_lines", "n_lines", None, 0.5),
}


def _base(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    src = thin(docs, doc_id=id_col, text=text_col)
    return src.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).select(
        "doc_id", "text", words(F.col("text")).alias("words"),
        F.filter(F.split("text", "\n", -1), lambda x: x.rlike(WORD_CHARACTER)).alias("lines"))


def _repeat_words(n, ranked):
    """Words covered by windows whose hash another window of the text has. ``ranked``: sorted (h, i)."""
    def beside(by):
        return F.slice(ranked, 2, F.greatest(F.size(ranked), F.lit(1))) if by > 0 else F.concat(
            F.array(F.struct(F.lit(None).cast("long").alias("h"), F.lit(None).cast("int").alias("i"))), ranked)

    def same(a, b):
        return F.coalesce(a["h"] == b["h"], F.lit(False))

    with_next = F.zip_with(ranked, beside(1), lambda a, b: F.struct(a.alias("w"), same(a, b).alias("hit")))
    with_both = F.zip_with(with_next, beside(-1), lambda a, b: F.when(a["hit"] | same(a["w"], b), a["w"]["i"]))
    return F.array_sort(F.array_compact(with_both))


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW_WORDS) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_stop_words_and_one,
    n_doubled_words); the last counts words equal to the word before them."""
    stops = F.array(*[F.lit(w) for w in sorted({w for ws in STOP_WORDS.values() for w in ws})])
    n = F.size("words")
    starts = F.when(n >= window, F.sequence(F.lit(1), n - (window - 1))).otherwise(F.array().cast("array<int>"))
    counted = _base(docs, id_col, text_col).select(
        "doc_id", n.cast("long").alias("n_words"), F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.regexp_replace("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size(F.filter("words", lambda w: F.array_contains(stops, F.lower(w)))) + 1).cast("long").alias("n_stop_words_and_one"),
        F.size(F.filter(F.zip_with("words", F.slice("words", 2, F.greatest(n, F.lit(1))), lambda a, b: a == b),
                        lambda x: F.coalesce(x, F.lit(False)))).cast("long").alias("n_doubled_words"),
        F.sort_array(F.transform(starts, lambda i: F.struct(
            F.xxhash64(*[F.col("words")[i - 1 + k] for k in range(window)]).alias("h"), i.alias("i")))).alias("ranked"))
    at = counted.select(*[c for c in counted.columns if c != "ranked"], _repeat_words(F.col("n_words"), F.col("ranked")).alias("at"))
    covered = F.aggregate(F.zip_with("at", F.slice("at", 2, F.greatest(F.size("at"), F.lit(1))), lambda a, b: F.least(F.coalesce(b - a, F.lit(window)), F.lit(window))),
                          F.lit(0), lambda x, y: x + y)
    return at.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                     covered.cast("long").alias("n_repeat_words"), "n_lines", "n_stop_words_and_one", "n_doubled_words")


def compile_rules(rules: dict) -> list:
    """A boolean column for each rule of the table."""
    out = []
    for name, (top, bottom, least, most) in rules.items():
        ratio = F.coalesce(F.try_divide(F.col(top).cast("double"), F.col(bottom).cast("double")), F.lit(0.0))
        holds = F.lit(True)
        if least is not None:
            holds = holds & (ratio >= least)
        if most is not None:
            holds = holds & (ratio <= most)
        out.append(holds.alias(name))
    return out


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: dict = RULES) -> DataFrame:
    """The statistics, ``base_failed``, one boolean for each rule, and ``kept``."""
    stats = statistics(docs, id_col, text_col)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    judged = stats.select("*", failed.alias("base_failed"), *compile_rules(rules))
    kept = ~F.col("base_failed")
    for name in rules:
        kept = kept & F.col(name)
    return judged.withColumn("kept", kept)


def op3_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Contract query over the whole documents table."""
    from kindling.sources.tables import table
    got = judge(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _op3_sql() -> str:
    stops = ", ".join(f"'{w}'" for w in sorted({w for ws in STOP_WORDS.values() for w in ws}))

    def rule(top, bottom, least, most):
        ratio = f"coalesce({top}::DOUBLE / nullif({bottom}, 0)::DOUBLE, 0.0)"
        return " AND ".join([f"{ratio} >= {least}"] * (least is not None) + [f"{ratio} <= {most}"] * (most is not None))

    return f"""
WITH src AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM documents),
windows AS (SELECT doc_id, unnest(range(1, len(words) - {WINDOW_WORDS - 2})) AS i, words FROM src),
seen AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, list_slice(words, i, i + {WINDOW_WORDS - 1})) AS n FROM windows),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (
    SELECT doc_id, unnest(range(i, i + {WINDOW_WORDS})) AS p FROM seen WHERE n > 1) GROUP BY doc_id),
stats AS (SELECT src.doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '{SYMBOLS}', '', 'g')))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
    len(lines) AS n_lines, len(list_filter(words, lambda w: list_contains([{stops}], lower(w)))) + 1 AS n_stop_words_and_one,
    len(list_filter(range(1, len(words)), lambda i: words[i] = words[i + 1])) AS n_doubled_words
  FROM src LEFT JOIN covered USING (doc_id)),
base AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM stats)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND {" AND ".join(rule(*r) for r in RULES.values())} AS kept FROM base
"""


OP3_SQL = _op3_sql()
