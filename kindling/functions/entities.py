"""HTML character references decoded in the JVM, as the standard library's ``html.unescape`` does.

A text is cut at ``&``; each part behind one begins with a reference or not. A named reference with ``;`` is looked
up as a whole, by its first letter and then its name; else the longest of the names that are valid without
``;`` counts, and what follows it stays. Numeric references go by their code point. The tables come from
the standard library when the expression is built; they enter it as one literal each.
"""
from __future__ import annotations

import json
from functools import lru_cache
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What a reference can be, right behind ``&``.
REFERENCE = r"^(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
REPLACEMENT = "\N{REPLACEMENT CHARACTER}"


@lru_cache(maxsize=1)
def _tables() -> tuple[str, str, str]:
    """JSON of names with ``;`` by first letter, JSON of names valid without, and their pattern, longest first."""
    closed: dict[str, dict[str, str]] = {}
    for name, chars in html5.items():
        if name.endswith(";"):
            closed.setdefault(name[0], {})[name] = chars
    bare = {name: chars for name, chars in html5.items() if not name.endswith(";")}
    longest = "|".join(sorted(bare, key=lambda n: (-len(n), n)))
    return json.dumps(closed), json.dumps(bare), f"^({longest})"


def _legacy(n: int) -> str:
    """The character that a reference to a C1 control stands for: that of Windows' code page, if it has one."""
    return bytes([n]).decode("cp1252", "ignore") or chr(n)


@lru_cache(maxsize=1)
def _replaced() -> str:
    return json.dumps({"0": REPLACEMENT, "13": "\r"} | {str(n): _legacy(n) for n in range(0x80, 0xA0)})


def _character(code: Column) -> Column:
    """The character of a code point; -1 stands for one beyond the last."""
    replaced = F.element_at(F.from_json(F.lit(_replaced()), "map<string,string>"), code.cast("string"))
    out_of_range = (code < 0) | (code > 0x10FFFF) | code.between(0xD800, 0xDFFF)
    none = (code.between(1, 8) | (code == 0xB) | code.between(0xE, 0x1F) | code.between(0x7F, 0x9F) | code.between(0xFDD0, 0xFDEF)
            | (code.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE))
    plain = F.decode(F.unhex(F.lpad(F.hex(code.cast("long")), 8, "0")), "UTF-32")
    return F.when(replaced.isNotNull(), replaced).when(out_of_range, F.lit(REPLACEMENT)).when(none, F.lit("")).otherwise(plain)


def _code(reference: Column) -> Column:
    """The number of a numeric reference, -1 if it has more digits than any code point."""
    hexed = F.regexp_extract(reference, "^#[xX]0*([0-9a-fA-F]*)", 1)
    digits = F.regexp_extract(reference, "^#0*([0-9]*)", 1)
    from_hex = F.when(F.length(hexed) > 6, F.lit(-1)).otherwise(F.conv(F.concat(F.lit("0"), hexed), 16, 10).cast("int"))
    from_digits = F.when(F.length(digits) > 7, F.lit(-1)).otherwise(F.concat(F.lit("0"), digits).cast("int"))
    return F.when(reference.rlike("^#[xX]"), from_hex).otherwise(from_digits)


def _decoded(part: Column) -> Column:
    """A part behind ``&`` (struct p, m: the text and its reference) decoded."""
    closed, bare, longest = _tables()
    p, m = part["p"], part["m"]
    rest = p.substr(F.length(m) + 1, F.length(p))
    whole = F.element_at(F.element_at(F.from_json(F.lit(closed), "map<string,map<string,string>>"), F.substring(m, 1, 1)), m)
    prefix = F.regexp_extract(m, longest, 1)
    short = F.element_at(F.from_json(F.lit(bare), "map<string,string>"), prefix)
    named = (F.when(m.endswith(";") & whole.isNotNull(), F.concat(whole, rest))
             .when(prefix != "", F.concat(short, p.substr(F.length(prefix) + 1, F.length(p)))).otherwise(F.concat(F.lit("&"), p)))
    return F.when(m == "", F.concat(F.lit("&"), p)).when(m.startswith("#"), F.concat(_character(_code(m)), rest)).otherwise(named)


def unescape(c: Column) -> Column:
    """Named, numeric and prefix references decoded. The text's expression stands in the result once."""
    parts = F.transform(F.split(c, "&"), lambda p, i: F.struct(
        p.alias("p"), F.when(i > 0, F.regexp_extract(p, REFERENCE, 1)).alias("m")))
    return F.array_join(F.transform(parts, lambda x: F.when(x["m"].isNull(), x["p"]).otherwise(_decoded(x))), "")
