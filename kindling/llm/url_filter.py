"""URL filter by the ratio of two character language models, in DataFrame operations only.

Two smoothed variable-order Markov models over the characters of host and path are counted from all
URLs: one of rejected URLs (a seed word is a part of the host between punctuation) and one of accepted
URLs (no seed word anywhere in the host). Hosts that hold a seed word within a longer part are examples
of neither and are only judged. A character's
probability after its last ``ORDER - 1`` characters falls back on ever shorter contexts:
p(c | context) = (n(context c) + strength * p(c | shorter context)) / (n(context) + strength).
A URL's score is the mean over its characters of log p_rejected - log p_accepted.

Accepted examples are only presumed so. Hosts are dealt into folds, and a URL's held-out score takes both
models without the counts of its host's fold. An accepted host whose URLs have a mean held-out score
above 0 is more like the rejected ones: it leaves the accepted examples, and the models are counted
again without it. The threshold is calibrated on held-out scores too: halfway between the means of accepted and
of rejected examples. URLs are judged by the scores of the second models.
Rules of (host, path) are compiled into one expression and go before the models.

Defined cases: null URLs and URLs without ``://`` have empty host and path, no rule fits them, and
without characters to judge they are blocked; if one class has no URL, all URLs with a host are allowed;
repeated rows each get their row; other columns are not read.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kindling.llm.common import thin, written

#: (host, path, verdict)
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
#: Parts of hosts whose URLs are examples for the rejected model.
SEED_WORDS = ("ads", "adult", "bets", "casino", "escort", "pills", "poker", "porn", "spam", "viagra", "xxx")
ORDER = 4
STRENGTH = 1.0
#: Folds of hosts; at most 256.
FOLDS = 32
#: Tables of n-grams up to this size are broadcast; larger ones are joined by a shuffle.
BROADCAST_BYTES = 8 << 20
#: Stands before a URL's first character.
PAD = "\x02"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def parsed(pages: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(page_id, host, path)"""
    src = thin(pages, page_id=id_col, url=url_col)
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    return src.select("page_id", F.translate(F.regexp_extract(url, PARTS, 1), UPPER, LOWER).alias("host"),
                      F.regexp_extract(url, PARTS, 2).alias("path"))


def rule_of(host, path, rules=RULES):
    """(rule, verdict) of the longest rule that fits, else nulls."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0] + r[1])):  # a longer one is asked first
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(v)).otherwise(verdict)
    return name, verdict


def _grams(text, order):
    padded = F.concat(F.lit(PAD * (order - 1)), text)
    return F.when(F.length(text) > 0, F.transform(F.sequence(F.lit(1), F.length(text)), lambda i: F.substring(padded, i, order))).otherwise(
        F.array().cast("array<string>"))


def _fold(host):
    return (F.conv(F.substring(F.md5(host), 1, 2), 16, 10).cast("int") % FOLDS).alias("fold")


def model(urls: DataFrame, order: int = ORDER, strength: float = STRENGTH) -> DataFrame:
    """(gram, fold, held, ratio) from (text, fold, rejected): log p_rejected - log p_accepted of a gram's last
    character, without the counts of the fold and with them."""
    counts = urls.select(F.explode(_grams(F.col("text"), order)).alias("gram"), "fold", "rejected").groupBy("gram", "fold").agg(
        F.count_if(~F.col("rejected")).alias("n_0"), F.count_if("rejected").alias("n_1"))
    counts = written(counts, "url-grams")
    letters = counts.agg(F.count_distinct(F.substring("gram", order, 1))).first()[0]

    def counted(part, prefix):
        # a part has at most FOLDS rows, so no window is large
        got, everywhere = counts.groupBy(part.alias("part"), "fold").agg(F.sum("n_0").alias("own_0"), F.sum("n_1").alias("own_1")), Window.partitionBy("part")
        return got.select("part", "fold", *[x.alias(f"{prefix}{c}{kind}") for c in (0, 1) for kind, x in (
            ("_all", F.sum(f"own_{c}").over(everywhere)), ("_held", F.sum(f"own_{c}").over(everywhere) - F.col(f"own_{c}")))])

    out = counts.select("gram", "fold")
    p = {(c, kind): F.lit(1.0 / (letters + 1)) for c in (0, 1) for kind in ("_held", "_all")}
    for k in range(1, order + 1):  # grams of the last k characters, after contexts of k - 1
        tail, context = F.substring("gram", order - k + 1, k), F.substring("gram", order - k + 1, k - 1)
        before = counted(context, f"c{k}_")
        before = F.broadcast(before) if k == 1 else before  # FOLDS rows
        out = out.withColumn("part", tail).join(counted(tail, f"n{k}_"), ["part", "fold"])
        out = out.withColumn("part", context).join(before, ["part", "fold"]).drop("part")
        p = {(c, kind): (F.col(f"n{k}_{c}{kind}") + strength * q) / (F.col(f"c{k}_{c}{kind}") + strength) for (c, kind), q in p.items()}
    return out.select("gram", "fold", (F.log(p[1, "_held"]) - F.log(p[0, "_held"])).alias("held"),
                      (F.log(p[1, "_all"]) - F.log(p[0, "_all"])).alias("ratio"))


def _scored(urls: DataFrame, order: int) -> DataFrame:
    """(text, host, rejected, held, score) of every URL under the models of its examples."""
    ratios = written(model(urls, order), "url-ratios")
    n = ratios.count()
    ratios = F.broadcast(ratios) if n * (28 + 4 * order) <= BROADCAST_BYTES else ratios
    return (urls.select("text", "host", "fold", "rejected", F.explode(_grams(F.col("text"), order)).alias("gram"))
            .join(ratios, ["gram", "fold"]).groupBy("text", "host", "rejected")
            .agg(F.avg("held").alias("held"), F.avg("ratio").alias("score")))


def scores(pages: DataFrame, seed_words=SEED_WORDS, order: int = ORDER) -> DataFrame:
    """(text, host, rejected, held, score) of every distinct host and path with a character; rejected is null
    where the URL is an example of neither model, at last."""
    seeds = F.array(*[F.lit(w) for w in seed_words])
    whole = F.arrays_overlap(F.split("host", r"[^a-z0-9]"), seeds)
    example = F.when(whole, F.lit(True)).when(~F.col("host").rlike("|".join(seed_words)), F.lit(False))
    urls = written(pages.select(F.concat("host", "path").alias("text"), "host", example.alias("rejected")).where("text <> ''")
                   .groupBy("text", "host").agg(F.max("rejected").alias("rejected")).withColumn("fold", _fold(F.col("host"))), "url-texts")
    leaving = written(_scored(urls, order).where("not rejected").groupBy("host").agg(F.avg("held").alias("held")).where("held > 0")
                      .select("host", F.lit(True).alias("leaves")), "url-leaving")
    size = leaving.agg(F.coalesce(F.sum(F.octet_length("host") + 16), F.lit(0))).first()[0]
    leaving = F.broadcast(leaving) if size <= BROADCAST_BYTES else leaving
    cleaned = urls.join(leaving, "host", "left").withColumn("rejected", F.when(F.col("leaves").isNull(), F.col("rejected")))
    return _scored(written(cleaned.drop("leaves"), "url-cleaned"), order)


def filter_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES, seed_words=SEED_WORDS,
                order: int = ORDER) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) of every row."""
    src = parsed(pages, id_col, url_col)
    scored = written(scores(src, seed_words, order), "url-scores")
    low, high = scored.agg(F.avg(F.when(~F.col("rejected"), F.col("held"))), F.avg(F.when(F.col("rejected"), F.col("held")))).first()
    threshold = float("inf") if high is None or low is None else (high + low) / 2
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    judged = src.withColumn("text", F.concat("host", "path")).join(scored.select("text", "score"), "text", "left")
    by_model = F.when(F.col("score").isNull() | (F.col("score") > threshold), F.lit("block")).otherwise(F.lit("allow"))
    return judged.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, by_model).alias("verdict"), "score")


def op10_url_filter(spark, sf_dir: str) -> DataFrame:
    """Contract query over the whole pages table."""
    from kindling.sources.tables import table
    return filter_urls(table(spark, sf_dir, "pages")).withColumn("score", F.round("score", 6))


def _scores_sql(urls: str, n: int) -> str:
    """CTEs up to s{n} (t, h, rej, held, score) over ``urls`` (t, h, f, rej)."""
    tables, joins, p = [], [], dict.fromkeys(("ha", "hr", "ta", "tr"), f"1.0 / (n{n}.k + 1)")
    for k in range(1, ORDER + 1):
        for kind, size in (("t", k), ("c", k - 1)):
            part, name = f"substring(g, {ORDER - k + 1}, {size})", f"{kind}{n}_{k}"
            tables.append(f"""{name} AS MATERIALIZED (SELECT f || '/' || x AS x, ta, tr, ta - a AS ha, tr - r AS hr FROM (SELECT *, sum(a) OVER w AS ta, sum(r) OVER w AS tr
    FROM (SELECT {part} AS x, f, sum(a) AS a, sum(r) AS r FROM c{n} GROUP BY 1, 2) WINDOW w AS (PARTITION BY x)))""")
            joins.append(f"JOIN {name} ON {name}.x = q.f || '/' || {part.replace('(g', '(q.g')}")
        p = {x: f"((t{n}_{k}.{x} + {STRENGTH} * {q}) / (c{n}_{k}.{x} + {STRENGTH}))" for x, q in p.items()}
    return f"""g{n} AS MATERIALIZED (SELECT t, h, f, rej, unnest(list_transform(range(1, length(t) + 1),
    lambda i: substring(repeat(chr({ord(PAD)}), {ORDER - 1}) || t, i, {ORDER}))) AS g FROM {urls}),
c{n} AS MATERIALIZED (SELECT g, f, count(*) FILTER (rej = 0) AS a, count(*) FILTER (rej = 1) AS r FROM g{n} GROUP BY g, f),
n{n} AS (SELECT count(DISTINCT substring(g, {ORDER}, 1)) AS k FROM c{n}),
{", ".join(tables)},
p{n} AS MATERIALIZED (SELECT q.g, q.f, ln({p["hr"]}) - ln({p["ha"]}) AS held, ln({p["tr"]}) - ln({p["ta"]}) AS ratio
  FROM c{n} q CROSS JOIN n{n} {" ".join(joins)}),
s{n} AS MATERIALIZED (SELECT t, h, rej, avg(held) AS held, avg(ratio) AS score FROM g{n} JOIN p{n} USING (g, f) GROUP BY t, h, rej)"""


def _op10_sql() -> str:
    parts = PARTS.replace("'", "''")
    seeds = ", ".join(f"'{w}'" for w in SEED_WORDS)
    rules = sorted(RULES, key=lambda r: -len(r[0] + r[1]))
    fits = [f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')" for h, p, _ in rules]
    rule = " ".join(f"WHEN {f} THEN '{h}{p}'" for f, (h, p, _) in zip(fits, rules))
    verdict = " ".join(f"WHEN {f} THEN '{v}'" for f, (_, _, v) in zip(fits, rules))
    return f"""
WITH src AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '{parts}', 1), '{UPPER}', '{LOWER}') AS host,
    regexp_extract(coalesce(url, ''), '{parts}', 2) AS path FROM pages),
urls AS MATERIALIZED (SELECT DISTINCT host || path AS t, host AS h, ('0x' || substring(md5(host), 1, 2))::INT % {FOLDS} AS f,
    CASE WHEN list_has_any(regexp_split_to_array(host, '[^a-z0-9]'), [{seeds}]) THEN 1
    WHEN NOT regexp_matches(host, '{"|".join(SEED_WORDS)}') THEN 0 END AS rej FROM src WHERE host || path <> ''),
{_scores_sql("urls", 1)},
leaving AS MATERIALIZED (SELECT h FROM s1 WHERE rej = 0 GROUP BY h HAVING avg(held) > 0),
cleaned AS MATERIALIZED (SELECT t, h, f, CASE WHEN h NOT IN (SELECT h FROM leaving) THEN rej END AS rej FROM urls),
{_scores_sql("cleaned", 2)},
bound AS (SELECT (avg(held) FILTER (rej = 0) + avg(held) FILTER (rej = 1)) / 2 AS edge FROM s2)
SELECT page_id, host, path, CASE {rule} END AS rule,
  coalesce(CASE {verdict} END, CASE WHEN score IS NULL OR score > coalesce(edge, 'infinity'::DOUBLE) THEN 'block' ELSE 'allow' END) AS verdict,
  round(score, 6) AS score
FROM src CROSS JOIN bound LEFT JOIN s2 ON t = host || path
"""


OP10_SQL = _op10_sql()
