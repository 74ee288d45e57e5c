"""Line dedup by site-relative frequency, in DataFrame operations only.

Pages are grouped by site. A line's ratio is the number of the site's pages that contain it, divided
by all pages of the site; a line over ``max_ratio``, on ``min_pages`` pages or more, is boilerplate of
that site and goes from its pages. Exact copies of a page count as one page: a line is boilerplate
because different pages share it, and a page that was copied often keeps its text.

Lines are compared by 64-bit hashes. A site has at most (mean lines of a page / max_ratio) boilerplate
lines, so its list is short however many pages it has.

Defined cases: lines without a word are never counted nor dropped; null text stays null and has no
lines; null sites form a site of their own; a site of few pages keeps everything; repeated rows each get
their row; all other columns are kept, clashing names included.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindling.llm.common import packed, unpacked, written

MAX_RATIO = 0.1
MIN_PAGES = 5
#: Boilerplate tables up to this size are broadcast; larger ones are joined by a shuffle.
BROADCAST_BYTES = 8 << 20

#: A character other than ASCII white space.
WORD_CHARACTER = r"[^\x20\x09-\x0D]"


def _lines(text):
    return F.split(text, "\n", -1)


def _site_key(site):
    return F.struct(site.isNull().alias("none"), F.coalesce(site.cast("string"), F.lit("")).alias("name"))


def boilerplate(docs: DataFrame, site_col: str = "source", text_col: str = "text", max_ratio: float = MAX_RATIO,
                min_pages: int = MIN_PAGES) -> DataFrame:
    """(site, bad): every site with boilerplate and the hashes of its lines."""
    text = F.col(f"`{text_col}`").cast("string")
    with_word = F.filter(_lines(text), lambda x: x.rlike(WORD_CHARACTER))
    pages = (docs.select(_site_key(F.col(f"`{site_col}`")).alias("site"), F.xxhash64(text, F.octet_length(text)).alias("page"),
                         F.array_distinct(F.transform(with_word, lambda x: F.xxhash64(x))).alias("lines"))
             .groupBy("site", "page").agg(F.first("lines").alias("lines")))
    pages = written(pages, "line-pages")
    total = pages.groupBy("site").agg(F.count(F.lit(1)).alias("total"))
    shared = (pages.select("site", F.explode("lines").alias("line")).groupBy("site", "line")
              .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_pages))
    return (shared.join(total, "site").where(F.col("n") > F.lit(max_ratio) * F.col("total"))
            .groupBy("site").agg(F.collect_list("line").alias("bad")))


def drop_boilerplate(docs: DataFrame, site_col: str = "source", text_col: str = "text", max_ratio: float = MAX_RATIO,
                     min_pages: int = MIN_PAGES, counts: bool = True) -> DataFrame:
    """``docs`` with boilerplate lines gone from the text; with ``counts``, ``_n_lines`` and ``_n_dropped`` are
    added, or replace columns of those names."""
    bad = written(boilerplate(docs, site_col, text_col, max_ratio, min_pages), "line-boilerplate")
    n, size = bad.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("bad") * 8 + F.octet_length("site.name") + 48), F.lit(0))).first()
    bad = F.broadcast(bad) if size <= BROADCAST_BYTES else bad
    rows = packed(docs, text=F.col(f"`{text_col}`").cast("string"), site=_site_key(F.col(f"`{site_col}`")))
    marked = rows.join(bad, "site", "left")
    text, known = F.col("text"), F.coalesce(F.col("bad"), F.array().cast("array<long>"))
    kept = F.filter(_lines(text), lambda x: ~(x.rlike(WORD_CHARACTER) & F.array_contains(known, F.xxhash64(x))))
    marked = marked.withColumn("kept", F.when(F.col("bad").isNull(), _lines(text)).otherwise(kept))
    lines = F.when(text.isNull(), F.lit(0)).otherwise(F.size(_lines(text)))
    left = F.when(text.isNull(), F.lit(0)).otherwise(F.size("kept"))
    own = [lines.cast("long").alias("_n_lines"), (lines - left).cast("long").alias("_n_dropped")] if counts else []
    columns = [c for c in docs.columns if not counts or c not in ("_n_lines", "_n_dropped")]
    return marked.select(*unpacked(columns, **{text_col: F.array_join("kept", "\n")}), *own)


def op6_line_dedup(spark, sf_dir: str) -> DataFrame:
    """Every document with its lines less the boilerplate of its source."""
    from kindling.sources.tables import table
    got = drop_boilerplate(table(spark, sf_dir, "documents"))
    return got.select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"), "text")


OP6_SQL = f"""
WITH src AS (SELECT doc_id, source, text, string_split(text, chr(10)) AS lines FROM documents),
pages AS (SELECT DISTINCT source, text, lines FROM src),
total AS (SELECT source, count(*) AS total FROM pages GROUP BY source),
held AS (SELECT source, line, count(*) AS n FROM (
    SELECT source, unnest(list_distinct(lines)) AS line FROM pages) WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')
  GROUP BY source, line),
bad AS (SELECT held.source, list(line) AS bad FROM held JOIN total ON held.source IS NOT DISTINCT FROM total.source
  WHERE n >= {MIN_PAGES} AND n > {MAX_RATIO} * total GROUP BY held.source),
kept AS (SELECT doc_id, text, lines,
  CASE WHEN bad IS NULL THEN lines ELSE list_filter(lines, lambda x: NOT list_contains(bad, x)) END AS kept
  FROM src LEFT JOIN bad ON src.source IS NOT DISTINCT FROM bad.source)
SELECT doc_id, coalesce(len(lines), 0)::BIGINT AS n_lines, coalesce(len(lines) - len(kept), 0)::BIGINT AS n_dropped,
  array_to_string(kept, chr(10)) AS text FROM kept
"""
