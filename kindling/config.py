"""Shared constants.

FIXED VALUES - these must equal the behaviour being reproduced (patterns,
replacement table, thresholds, hyper-parameters). They are stated plainly
and in their natural order; do not edit them to make a check pass.
"""
from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES: regular expressions (Java / Spark dialect)
# ---------------------------------------------------------------------------
# A word character as understood by Python's Unicode ``\w``.
WORD = r"[\p{L}\p{N}_]"
# A whitespace character as understood by Python's ``str.split()`` /
# ``str.isspace()`` / ``\s`` (Unicode White_Space plus the four separators
# U+001C..U+001F).
WS = r"(?U)[\s\x1c-\x1f]"
NON_WS_RUN = r"(?U)[^\s\x1c-\x1f]+"
NON_WS = r"(?U)[^\s\x1c-\x1f]"
WS_RUN = r"(?U)[\s\x1c-\x1f]+"

# URL: "http(s)://" or "www." followed by a run of non-whitespace.
URL = r"(?U)https?://[^\s\x1c-\x1f]+|www\.[^\s\x1c-\x1f]+"
HASHTAG = r"(?<![\p{L}\p{N}_])#[\p{L}\p{N}_]+"
MENTION = r"(?<![\p{L}\p{N}_])@[\p{L}\p{N}_]+"
# Catch-all strip of code points U+0080..U+00FF (to the empty string).
LATIN1_STRIP = r"[\x{80}-\x{ff}]+"
# Tokenizer: maximal runs of at least two word characters.
TOKEN = r"[\p{L}\p{N}_]{2,}"

# ---------------------------------------------------------------------------
# FIXED VALUES: known mojibake sequences, applied in this order
# ---------------------------------------------------------------------------
MOJIBAKE_REPLACEMENTS: list[tuple[str, str]] = [
    ("\x89\xdb\xaa", "'"),
    ("\x89\xdb\xcf", '"'),
    ("\x89\xdb\xf7", "'"),
    ("\x89\xdb\x9d", '"'),
    ("\x89\xdb\xd2", '"'),
    ("\x89\xdb\xd3", '"'),
    ("\x89\xdb_", "..."),
    ("\xe5\xca", "-"),
]

# ---------------------------------------------------------------------------
# FIXED VALUES: features, split, model, thresholds
# ---------------------------------------------------------------------------
FEATURE_COLUMNS = ["word_count", "has_url", "hashtag_count", "mention_count", "has_keyword"]
NUMERIC_FEATURES = ["word_count", "hashtag_count", "mention_count"]
RATE_FEATURES = ["has_url", "has_keyword"]

VAL_FRACTION = 0.15
TEST_FRACTION = 0.15
SEED = 42

TFIDF_MAX_FEATURES = 20_000
TFIDF_NGRAM_MAX = 2
TFIDF_MIN_DF = 2

LR_C = 1.0

DECISION_THRESHOLD = 0.5
KS_P_VALUE_THRESHOLD = 0.05
RATE_DIFF_THRESHOLD = 0.15
POSITIVE_RATE_DIFF_THRESHOLD = 0.15
MIN_BATCH_SIZE = 30
KS_EXACT_MAX_N = 10_000
F1_PROMOTION_MARGIN = 0.01

METRIC_ORDER = ["accuracy", "precision", "recall", "f1", "roc_auc"]

# UTC file stamp used for outputs, reports and archives.
STAMP_FORMAT = "yyyyMMdd'T'HHmmss'Z'"

# ---------------------------------------------------------------------------
# Engine tuning (ours, not reference values)
# ---------------------------------------------------------------------------
# Distinct values per bucket of the distributed prefix sum; buckets follow their number.
PREFIX_BUCKET_ROWS = 100_000
# Hex digits of md5 used as a uniform bucket for exact ranked cuts.
RANK_BUCKET_HEX = 4
# Upper bound (bytes, planner's estimate) for a side that we broadcast.
BROADCAST_BYTES_LIMIT = 8 << 20
