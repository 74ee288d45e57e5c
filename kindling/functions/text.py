"""Scalar text functions (cleaning and the five handcrafted features).

Everything here returns a ``Column`` built from Spark built-ins, so a whole
featurisation is a single Project; no row leaves the JVM.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kindling import config as C
from kindling.functions import entities


def _col(c: "Column | str") -> Column:
    return F.col(c) if isinstance(c, str) else c


def html_unescape(c: "Column | str") -> Column:
    """Decode HTML entities (full HTML5 table, numeric references, and the
    legacy prefix forms without ``;``)."""
    return entities.unescape(_col(c))


def fix_mojibake(c: "Column | str") -> Column:
    """Apply the known mis-decoding repairs, in order (literal replaces)."""
    c = _col(c)
    for bad, good in C.MOJIBAKE_REPLACEMENTS:
        c = F.replace(c, F.lit(bad), F.lit(good))
    return c


def strip_latin1(c: "Column | str") -> Column:
    """Drop leftover U+0080..U+00FF code points (to nothing, not a space)."""
    return F.regexp_replace(_col(c), C.LATIN1_STRIP, "")


def remove_urls(c: "Column | str") -> Column:
    return F.regexp_replace(_col(c), C.URL, " ")


def squash_whitespace(c: "Column | str") -> Column:
    """Collapse whitespace runs to one space and trim the ends."""
    return F.trim(F.regexp_replace(_col(c), C.WS_RUN, " "))


def clean_text(c: "Column | str") -> Column:
    """Null -> ''; mojibake repair -> entity decode -> U+0080..U+00FF strip ->
    URLs to a space -> whitespace collapse + trim. Case and punctuation kept."""
    c = F.coalesce(_col(c), F.lit(""))
    c = fix_mojibake(c)
    c = html_unescape(c)
    c = strip_latin1(c)
    c = remove_urls(c)
    return squash_whitespace(c)


def word_count(c: "Column | str") -> Column:
    """Number of whitespace-separated tokens (0 for null / blank)."""
    return F.coalesce(F.regexp_count(_col(c), F.lit(C.NON_WS_RUN)), F.lit(0)).cast("int")


def has_url(c: "Column | str") -> Column:
    return F.coalesce(_col(c).rlike(C.URL), F.lit(False)).cast("int")


def hashtag_count(c: "Column | str") -> Column:
    return F.coalesce(F.regexp_count(_col(c), F.lit(C.HASHTAG)), F.lit(0)).cast("int")


def mention_count(c: "Column | str") -> Column:
    return F.coalesce(F.regexp_count(_col(c), F.lit(C.MENTION)), F.lit(0)).cast("int")


def has_keyword(c: "Column | str") -> Column:
    """1 when the keyword has any non-whitespace character."""
    return F.coalesce(_col(c).rlike(C.NON_WS), F.lit(False)).cast("int")


def tokens(c: "Column | str") -> Column:
    """Lower-case, then every maximal run of >= 2 word characters."""
    return F.regexp_extract_all(F.lower(F.coalesce(_col(c), F.lit(""))), F.lit(C.TOKEN), F.lit(0))


def word_ngrams(tok: "Column | str", n_max: int = C.TFIDF_NGRAM_MAX) -> Column:
    """Unigrams followed by 2..n_max-grams of adjacent tokens joined by a space.

    Linear in the token count: the k-grams are the (k-1)-grams zipped with
    the token array shifted by k-1. Pass a column *reference* (not the
    tokenizer expression) so the tokens are computed once per row."""
    tok = _col(tok)
    out, grams = tok, tok
    for k in range(2, n_max + 1):
        n = F.size(tok) - k + 1
        nxt = F.zip_with(F.slice(grams, 1, n), F.slice(tok, k, n),
                         lambda a, b: F.concat(a, F.lit(" "), b))
        grams = F.when(n >= 1, nxt).otherwise(F.array().cast("array<string>"))
        out = F.concat(out, grams)
    return out
