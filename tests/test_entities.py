import html
import random
from html.entities import html5

from kindling.functions import text as tx


def check(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string").select("k", "t", tx.html_unescape("t").alias("u"))
    assert "EvalPython" not in df._jdf.queryExecution().executedPlan().toString()
    for r in df.collect():
        assert r.u == (None if r.t is None else html.unescape(r.t)), ascii(r.t)


def test_every_name_with_and_without_its_end(spark):
    check(spark, [f"x &{name} y" for name in html5] + [f"&{name.rstrip(';')}z;&{name}" for name in html5])


def test_numbers_at_all_borders(spark):
    numbers = [0, 1, 8, 9, 10, 11, 12, 13, 14, 31, 32, 38, 60, 126, 127, 128, 129, 0x8D, 0x8F, 0x90, 0x9D, 0x9F, 0xA0, 0xD7FF, 0xD800, 0xDFFF, 0xE000,
               0xFDCF, 0xFDD0, 0xFDEF, 0xFDF0, 0xFFFD, 0xFFFE, 0xFFFF, 0x10000, 0x1FFFE, 0x1FFFF, 0x1F600, 0x10FFFD, 0x10FFFE, 0x10FFFF, 0x110000, 9999999, 10**12, 10**40]
    check(spark, [f"a&#{n};b" for n in numbers] + [f"&#x{n:x};" for n in numbers] + [f"&#X{n:X}g" for n in numbers] + [f"&#000{n}" for n in numbers]
          + [f"&#x0000{n:x} " for n in numbers])


def test_odd_texts(spark):
    rnd = random.Random(6)
    pieces = ["&", "&&", ";", "#", "&#", "&#x", "&#;", "&#x;", "amp", "&amp", "&amp;", "&ampamp;", "&notit;", "&notin;", "&not", "&lt;p&gt;", "&copy2024", "&nbsp;", " ",
              "\n", "\t", "é", "😀", "&é;", "&😀", "&abcdefghijklmnopqrstuvwxyzabcdefghijklmnop;", "x", "1", "&CounterClockwiseContourIntegral;", "&frac12", "&Frac12;"]
    check(spark, ["".join(rnd.choices(pieces, k=rnd.randint(0, 9))) for _ in range(1500)] + [None, "", "no references", "&" * 50])


def test_cleaning_stays_in_the_jvm(spark):
    df = spark.createDataFrame([("a &amp; b &lt;",)], "t string").select(tx.clean_text("t").alias("c"))
    assert df.first().c == "a & b <" and "ArrowEvalPython" not in df._jdf.queryExecution().executedPlan().toString()
