"""DuckDB SQL twins of the registered queries (the correctness oracle).

DuckDB's RE2 has no look-behind and a narrower ``\\s``; the classes below
are the RE2 spellings of the same Unicode sets as ``kindling.config``.
"""
from __future__ import annotations

from kindling.config import MOJIBAKE_REPLACEMENTS

# FIXED VALUES: RE2 spellings of the shared character classes.
WS = r"[\s\p{Z}\x0b\x1c-\x1f\x{85}]"
NWS = r"[^\s\p{Z}\x0b\x1c-\x1f\x{85}]"
WORD = r"[\p{L}\p{N}_]"
URL = r"https?://" + NWS + r"+|www\." + NWS + r"+"
HASHTAG = r"(?:^|[^\p{L}\p{N}_])#[\p{L}\p{N}_]+"
MENTION = r"(?:^|[^\p{L}\p{N}_])@[\p{L}\p{N}_]+"
LATIN1 = r"[\x{80}-\x{ff}]+"
TOKEN = r"[\p{L}\p{N}_]{2,}"

MSG = """
msg AS (
  SELECT doc_id AS id,
    CASE WHEN doc_id % 7 = 0 THEN NULL WHEN doc_id % 7 = 1 THEN '' WHEN doc_id % 7 = 2 THEN '  '
         WHEN doc_id % 7 = 3 THEN chr(160) ELSE source END AS keyword,
    repeat('#' || source || ' ', CAST(doc_id % 3 AS INTEGER)) || text
      || repeat(' @' || lang || 'user', CAST(doc_id % 4 AS INTEGER))
      || CASE WHEN doc_id % 3 = 0 THEN ' http://t.co/x' || CAST(doc_id AS VARCHAR) ELSE '' END
      || CASE WHEN doc_id % 5 = 0 THEN ' a &amp; b' ELSE '' END
      || CASE WHEN doc_id % 10 = 0 THEN ' can' || chr(137) || chr(219) || chr(170) || 't stop' ELSE '' END
      || CASE WHEN doc_id % 10 = 5 THEN ' x' || chr(229) || chr(202) || 'y' ELSE '' END AS text,
    source, lang
  FROM documents)"""

DUP = """
dup AS (SELECT doc_id AS id, text, source, CAST(doc_id % 2 AS INTEGER) AS target FROM documents)"""

LAB = """
lab AS (SELECT m.*, CAST(l.toxic AS INTEGER) AS target FROM msg m JOIN labels l ON m.id = l.doc_id)"""

UNLAB = """
unlab AS (SELECT m.* FROM msg m ANTI JOIN labels l ON m.id = l.doc_id)"""


def clean_sql(col: str) -> str:
    """clean_text in SQL. Entity decoding is the nested replace of the only
    entity present in the derived views (``&amp;``), exact on this data."""
    c = f"coalesce({col}, '')"
    for bad, good in MOJIBAKE_REPLACEMENTS:
        bad, good = (" || ".join(f"chr({ord(x)})" for x in y) for y in (bad, good))
        c = f"replace({c}, {bad}, {good})"
    c = f"replace({c}, '&amp;', '&')"
    c = f"regexp_replace({c}, '{LATIN1}', '', 'g')"
    c = f"regexp_replace({c}, '{URL}', ' ', 'g')"
    c = f"trim(regexp_replace({c}, '{WS}+', ' ', 'g'))"
    return c


def word_count_sql(col: str) -> str:
    return f"CAST(coalesce(len(regexp_extract_all({col}, '{NWS}+')), 0) AS INTEGER)"


def has_url_sql(col: str) -> str:
    return f"CAST(coalesce(regexp_matches({col}, '{URL}'), false) AS INTEGER)"


def hashtag_sql(col: str) -> str:
    return f"CAST(coalesce(len(regexp_extract_all({col}, '{HASHTAG}')), 0) AS INTEGER)"


def mention_sql(col: str) -> str:
    return f"CAST(coalesce(len(regexp_extract_all({col}, '{MENTION}')), 0) AS INTEGER)"


def has_keyword_sql(col: str) -> str:
    return f"CAST(coalesce(regexp_matches({col}, '{NWS}'), false) AS INTEGER)"


def features_sql(text: str = "text", keyword: str = "keyword") -> str:
    kw = has_keyword_sql(keyword) if keyword else "CAST(0 AS INTEGER)"
    return (f"{clean_sql(text)} AS cleaned_text, {word_count_sql(text)} AS word_count, "
            f"{has_url_sql(text)} AS has_url, {hashtag_sql(text)} AS hashtag_count, "
            f"{mention_sql(text)} AS mention_count, {kw} AS has_keyword")


def dedupe_sql(src: str, cols: list[str], name: str = "deduped", order: str = "id") -> str:
    """First row per text by id, label = unique most frequent non-null target."""
    other = ", ".join(f"f.{c}" for c in cols if c != "target")
    return f"""
{name}_votes AS (
  SELECT text, target, count(*) AS n FROM {src} WHERE text IS NOT NULL AND target IS NOT NULL
  GROUP BY text, target),
{name}_best AS (
  SELECT text, max(n) AS m, arg_max(target, n) AS t, count(*) FILTER (WHERE n = mx) AS k
  FROM (SELECT *, max(n) OVER (PARTITION BY text) AS mx FROM {name}_votes) GROUP BY text),
{name}_first AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY {order}) AS rn
                 FROM {src} WHERE text IS NOT NULL) WHERE rn = 1),
{name} AS (
  SELECT {other}, CAST(b.t AS INTEGER) AS target
  FROM {name}_first f JOIN {name}_best b ON f.text = b.text WHERE b.k = 1)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


SQL: dict[str, str] = {}

SQL["clean_text"] = with_(MSG) + f"SELECT id, {clean_sql('text')} AS cleaned_text FROM msg"

SQL["unescape_pages"] = (
    "WITH u AS (SELECT page_id, replace(replace(replace(replace(html, '&copy;', chr(169)), "
    "'&middot;', chr(183)), '&quot;', '\"'), '&amp;', '&') AS unescaped FROM pages)\n"
    f"SELECT page_id, unescaped, regexp_replace(unescaped, '{LATIN1}', '', 'g') AS stripped FROM u")

SQL["word_count"] = with_(MSG) + f"SELECT id, {word_count_sql('text')} AS word_count FROM msg"
SQL["has_url"] = with_(MSG) + f"SELECT id, {has_url_sql('text')} AS has_url FROM msg"
SQL["hashtag_count"] = with_(MSG) + f"SELECT id, {hashtag_sql('text')} AS hashtag_count FROM msg"
SQL["mention_count"] = with_(MSG) + f"SELECT id, {mention_sql('text')} AS mention_count FROM msg"
SQL["has_keyword"] = with_(MSG) + f"SELECT id, {has_keyword_sql('keyword')} AS has_keyword FROM msg"
SQL["build_features"] = with_(MSG) + f"SELECT id, keyword, text, source, lang, {features_sql()} FROM msg"

SQL["clean_and_featurize"] = (
    with_(DUP, dedupe_sql("dup", ["id", "text", "source", "target"]))
    + f"SELECT id, text, source, target, {features_sql('text', None)} FROM deduped")

SQL["reject_empty_text"] = with_(MSG) + (
    "SELECT id, keyword AS text, CASE WHEN coalesce(length(keyword) >= 1, false) "
    "THEN 'accepted' ELSE 'rejected' END AS status FROM msg")

SQL["dedupe_labels"] = with_(DUP, dedupe_sql("dup", ["id", "text", "source", "target"])) + \
    "SELECT id, text, source, target FROM deduped"

LAB_FEAT = dedupe_sql("lab", ["id", "keyword", "text", "source", "lang", "target"], "labd") + """,
labf AS (SELECT id, keyword, text, source, lang, target, """ + features_sql() + " FROM labd)"

SQL["class_distribution"] = with_(MSG, LAB, LAB_FEAT) + \
    "SELECT target, count(*) AS n FROM labf GROUP BY target"

# ---------------------------------------------------------------------------
# split, scoring, summaries
# ---------------------------------------------------------------------------
D = "CAST({} AS DOUBLE)".format


def alloc_sql(prefix: str, src: str, count_col: str, n_draw: str) -> str:
    """Largest-remainder allocation of n_draw over rows of ``src``."""
    return f"""
{prefix}a AS (SELECT *, CAST({count_col} * ({n_draw}) AS DOUBLE) / (sum({count_col}) OVER ()) AS cont FROM {src}),
{prefix}b AS (SELECT *, floor(cont) AS fl, cont - floor(cont) AS rem FROM {prefix}a),
{prefix}c AS (SELECT *, ({n_draw}) - sum(fl) OVER () AS need,
                     row_number() OVER (ORDER BY rem DESC, target) AS rk FROM {prefix}b),
{prefix} AS (SELECT *, CAST(fl + CASE WHEN rk <= need THEN 1 ELSE 0 END AS BIGINT) AS alloc FROM {prefix}c)"""


SPLIT = """
cls AS (SELECT target, count(*) AS c, (SELECT count(*) FROM labf) AS n FROM labf GROUP BY target),
cls1 AS (SELECT target, c, n, n - CAST(ceil(CAST(0.15 AS DOUBLE) * n) AS BIGINT) AS n_draw FROM cls),""" + \
    alloc_sql("s1", "cls1", "c", "n_draw") + """,
cls2 AS (SELECT target, c, alloc AS trainval,
                (sum(alloc) OVER ()) - CAST(ceil(CAST(0.15 AS DOUBLE) / (1 - CAST(0.15 AS DOUBLE))
                                                 * (sum(alloc) OVER ())) AS BIGINT) AS n_draw2 FROM s1),""" + \
    alloc_sql("s2", "cls2", "trainval", "n_draw2") + """,
sizes AS (SELECT target, c - trainval AS n_test_c, trainval - alloc AS n_val_c FROM s2),
ranked AS (SELECT l.*, row_number() OVER (PARTITION BY l.target
             ORDER BY md5('42:' || CAST(l.id AS VARCHAR)), l.id) AS rnk FROM labf l),
splitted AS (
  SELECT r.id, r.keyword, r.text, r.source, r.lang, r.target, r.cleaned_text, r.word_count, r.has_url,
         r.hashtag_count, r.mention_count, r.has_keyword,
         CASE WHEN rnk <= s.n_test_c THEN 'test' WHEN rnk <= s.n_test_c + s.n_val_c THEN 'val'
              ELSE 'train' END AS split
  FROM ranked r JOIN sizes s ON r.target = s.target)"""

BASE = with_(MSG, LAB, LAB_FEAT)
BASE_SPLIT = with_(MSG, LAB, LAB_FEAT, SPLIT)

SQL["stratified_split"] = BASE_SPLIT + "SELECT id, target, split FROM splitted"
SQL["positive_rate_by_split"] = BASE_SPLIT + (
    "SELECT split, count(*) AS n, round(avg(target), 6) AS positive_rate FROM splitted GROUP BY split")


def linear_sql(weights: dict, intercept: float) -> tuple[str, str]:
    z = D(repr(float(intercept)))
    for c, w in weights.items():
        z = f"({z} + {D(repr(float(w)))} * CAST({c} AS DOUBLE))"
    return z, f"(1.0 / (1.0 + exp(-{z})))"


def scored_cte(name: str, src: str, weights: dict, intercept: float) -> str:
    z, p = linear_sql(weights, intercept)
    return (f"\n{name} AS (SELECT *, {p} AS probability, CAST({z} > 0 AS INTEGER) AS prediction, "
            f"CAST({p} >= 0.5 AS INTEGER) AS label FROM {src})")


def _weights():
    from kindling.plans import queries as q
    return (q.BASELINE_WEIGHTS, q.BASELINE_INTERCEPT, q.CANDIDATE_WEIGHTS, q.CANDIDATE_INTERCEPT)


BW, BI, CW, CI = _weights()

UNLAB_FEAT = UNLAB + """,
unlabf AS (SELECT id, keyword, text, source, lang, """ + features_sql() + " FROM unlab)"

BATCH = with_(MSG, LAB, LAB_FEAT, UNLAB_FEAT, scored_cte("batch", "unlabf", BW, BI))

SQL["score_fixed_weights"] = BATCH + "SELECT id, round(probability, 6) AS probability, label FROM batch"
SQL["flagged_by_source"] = BATCH + (
    "SELECT source, count(*) AS n, CAST(sum(label) AS BIGINT) AS n_flagged FROM batch GROUP BY source")

SQL["seeded_sample"] = BASE + (
    "SELECT id, text, cleaned_text, word_count, has_url, hashtag_count, mention_count, has_keyword, target "
    "FROM labf ORDER BY md5('42:' || CAST(id AS VARCHAR)), id LIMIT 5")

FEATS = ["word_count", "has_url", "hashtag_count", "mention_count", "has_keyword"]


def long_sql(src: str, feats: list[str], extra: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT '{f}' AS feature, CAST({f} AS DOUBLE) AS value{extra} FROM {src}" for f in feats)


SQL["feature_summary"] = BASE + f"""
SELECT feature, CAST(count(value) AS BIGINT) AS count, round(avg(value), 6) AS mean,
       round(stddev_samp(value), 6) AS std, round(min(value), 6) AS min,
       round(quantile_cont(value, 0.25), 6) AS p25, round(quantile_cont(value, 0.5), 6) AS p50,
       round(quantile_cont(value, 0.75), 6) AS p75, round(max(value), 6) AS max
FROM ({long_sql('labf', FEATS)}) GROUP BY feature"""

SQL["order_stats"] = """
WITH o AS (
  SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY value) - 1 AS i,
         count(*) OVER (PARTITION BY event_type) AS n
  FROM events WHERE value IS NOT NULL)
SELECT event_type, CAST(max(n) AS BIGINT) AS n, round(avg(value), 6) AS avg, min(value) AS min,
       max(value) AS max,
       max(CASE WHEN i = floor(CAST(0.5 AS DOUBLE) * n) THEN value END) AS p50,
       max(CASE WHEN i = floor(CAST(0.95 AS DOUBLE) * n) THEN value END) AS p95,
       max(CASE WHEN i = least(floor(CAST(0.99 AS DOUBLE) * n), n - 1) THEN value END) AS p99
FROM o GROUP BY event_type"""

# ---------------------------------------------------------------------------
# representations
# ---------------------------------------------------------------------------
CLEANED = "\nc AS (SELECT id, " + clean_sql("text") + " AS cleaned_text FROM msg)"

SQL["tokens"] = with_(MSG, CLEANED) + f"""
SELECT id, CAST(unnest(generate_series(0, len(toks) - 1)) AS INTEGER) AS pos, unnest(toks) AS token
FROM (SELECT id, regexp_extract_all(lower(cleaned_text), '{TOKEN}') AS toks FROM c)"""


def tf_cte(name: str, src: str) -> str:
    return f"""
{name}_t AS (SELECT id, regexp_extract_all(lower(coalesce(cleaned_text, '')), '{TOKEN}') AS toks FROM {src}),
{name}_g AS (SELECT id, list_concat(toks, list_transform(generate_series(1, len(toks) - 1),
                                                       lambda i: toks[i] || ' ' || toks[i + 1])) AS terms
             FROM {name}_t),
{name} AS (SELECT id, term, count(*) AS tf FROM (SELECT id, unnest(terms) AS term FROM {name}_g)
           GROUP BY id, term)"""


SQL["ngrams"] = with_(MSG, CLEANED, tf_cte("tf", "c")) + "SELECT id, term, tf FROM tf"

VOCAB = """
trainrows AS (SELECT * FROM splitted WHERE split = 'train'),""" + tf_cte("ttf", "trainrows") + """,
st AS (SELECT term, CAST(sum(tf) AS BIGINT) AS ctf, count(*) AS df FROM ttf GROUP BY term),
top AS (SELECT * FROM st WHERE df >= 2 ORDER BY ctf DESC, term LIMIT 20000),
voc AS (SELECT term, CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS idx, df, ctf,
               ln((1.0 + (SELECT count(*) FROM trainrows)) / (1 + df)) + 1 AS idf FROM top)"""

BASE_VOCAB = with_(MSG, LAB, LAB_FEAT, SPLIT, VOCAB)
SQL["vocabulary"] = BASE_VOCAB + "SELECT term, idx, df, ctf, round(idf, 6) AS idf FROM voc"
SQL["idf"] = BASE_VOCAB + "SELECT term, round(idf, 6) AS idf FROM voc"
SQL["tfidf_weights"] = with_(MSG, LAB, LAB_FEAT, SPLIT, VOCAB, tf_cte("atf", "splitted")) + """
SELECT id, term, idx, round(w / sqrt(sum(w * w) OVER (PARTITION BY id)), 6) AS weight
FROM (SELECT a.id, a.term, v.idx, a.tf * v.idf AS w FROM atf a JOIN voc v ON a.term = v.term)"""

SCALER = """
trainrows AS (SELECT * FROM splitted WHERE split = 'train'),
sstats AS (""" + " UNION ALL ".join(
    f"SELECT '{f}' AS feature, avg({f}) AS mean, CASE WHEN stddev_pop({f}) = 0 THEN 1.0 "
    f"ELSE stddev_pop({f}) END AS std FROM trainrows" for f in FEATS) + ")"

SQL["scaler_stats"] = with_(MSG, LAB, LAB_FEAT, SPLIT, SCALER) + \
    "SELECT feature, round(mean, 6) AS mean, round(std, 6) AS std FROM sstats"

SQL["scaled_features"] = with_(MSG, LAB, LAB_FEAT, SPLIT, SCALER) + "SELECT id, " + ", ".join(
    f"round((CAST({f} AS DOUBLE) - (SELECT mean FROM sstats WHERE feature = '{f}')) / "
    f"(SELECT std FROM sstats WHERE feature = '{f}'), 6) AS scaled_{f}" for f in FEATS) + " FROM splitted"

SQL["embedding_l2"] = """
WITH n AS (
  SELECT vec_id AS id, embedding,
         sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))) AS nrm
  FROM embeddings)
SELECT id, CAST(i AS INTEGER) AS dim,
       round(CASE WHEN nrm > 0 THEN CAST(x AS DOUBLE) / nrm ELSE CAST(x AS DOUBLE) END, 6) AS x
FROM (SELECT id, nrm, unnest(embedding) AS x, unnest(generate_series(0, len(embedding) - 1)) AS i FROM n)"""

# ---------------------------------------------------------------------------
# metrics, comparison, promotion
# ---------------------------------------------------------------------------


def metrics_cte(name: str, src: str) -> str:
    return f"""
{name}_c AS (
  SELECT split,
    CAST(sum(CASE WHEN target = 1 AND prediction = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp,
    CAST(sum(CASE WHEN target = 0 AND prediction = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
    CAST(sum(CASE WHEN target = 1 AND prediction = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fn,
    CAST(sum(CASE WHEN target = 0 AND prediction = 0 THEN 1 ELSE 0 END) AS BIGINT) AS tn
  FROM {src} GROUP BY split),
{name}_ps AS (SELECT split, probability, sum(target) AS pos, sum(1 - target) AS neg
              FROM {src} GROUP BY split, probability),
{name}_cum AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY split ORDER BY probability
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before_neg,
                      sum(neg) OVER (PARTITION BY split) AS total_neg FROM {name}_ps),
{name}_auc AS (SELECT split, CASE WHEN sum(pos) * max(total_neg) = 0 THEN NULL ELSE
                 sum(pos * (before_neg + neg / 2.0)) / (CAST(sum(pos) AS DOUBLE) * max(total_neg)) END AS roc_auc
               FROM {name}_cum GROUP BY split),
{name} AS (
  SELECT c.split, tp, fp, fn, tn,
    CASE WHEN tp + fp + fn + tn = 0 THEN 0.0 ELSE CAST(tp + tn AS DOUBLE) / (tp + fp + fn + tn) END AS accuracy,
    CASE WHEN tp + fp = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fp) END AS precision,
    CASE WHEN tp + fn = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fn) END AS recall,
    CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn) END AS f1,
    a.roc_auc
  FROM {name}_c c LEFT JOIN {name}_auc a ON c.split = a.split)"""


SCORED = with_(MSG, LAB, LAB_FEAT, SPLIT, scored_cte("sb", "splitted", BW, BI),
               scored_cte("sc", "splitted", CW, CI), metrics_cte("mb", "sb"), metrics_cte("mc", "sc"))
R6M = ", ".join(f"round({m}, 6) AS {m}" for m in ["accuracy", "precision", "recall", "f1", "roc_auc"])

SQL["confusion"] = SCORED + "SELECT split, tp, fp, fn, tn FROM mb_c"
SQL["metrics_by_split"] = SCORED + f"SELECT split, tp, fp, fn, tn, {R6M} FROM mb"
SQL["roc_auc"] = SCORED + "SELECT split, round(roc_auc, 6) AS roc_auc FROM mb_auc"

METRIC_LONG = " UNION ALL ".join(
    f"SELECT split, '{m}' AS metric, {i} AS metric_rank, b.{m} AS baseline, c.{m} AS candidate "
    f"FROM mb b JOIN mc c USING (split)"
    for i, m in enumerate(["accuracy", "precision", "recall", "f1", "roc_auc"]))

SQL["compare_models"] = SCORED + f"""
SELECT split, metric, CAST(metric_rank AS INTEGER) AS metric_rank, round(baseline, 6) AS baseline,
       round(candidate, 6) AS candidate, round(candidate - baseline, 6) AS delta
FROM ({METRIC_LONG})"""

SQL["promotion_verdict"] = SCORED + """
SELECT round(b.f1, 6) AS baseline_f1, round(c.f1, 6) AS candidate_f1, round(c.f1 - b.f1, 6) AS delta,
       CAST((c.f1 - b.f1) >= CAST(0.01 AS DOUBLE) AS INTEGER) AS promote,
       CASE WHEN (c.f1 - b.f1) >= CAST(0.01 AS DOUBLE) THEN 'PROMOTE candidate' ELSE 'KEEP baseline' END AS verdict
FROM mb b JOIN mc c USING (split) WHERE split = 'test'"""

# ---------------------------------------------------------------------------
# drift
# ---------------------------------------------------------------------------
REF = "\nref AS (SELECT * FROM splitted WHERE split = 'train')"
DRIFT = with_(MSG, LAB, LAB_FEAT, SPLIT, REF, UNLAB_FEAT, scored_cte("batch", "unlabf", BW, BI)) + ""
NUM = ["word_count", "hashtag_count", "mention_count"]
RATE = ["has_url", "has_keyword"]
TAGGED = ("(SELECT *, 1 AS r FROM (SELECT word_count, has_url, hashtag_count, mention_count, has_keyword FROM ref) "
          "UNION ALL SELECT *, 0 AS r FROM (SELECT word_count, has_url, hashtag_count, mention_count, "
          "has_keyword FROM batch))")

SQL["ks_statistic"] = DRIFT + f"""
, t AS {TAGGED},
pv AS (SELECT feature, value, sum(r) AS nr, sum(1 - r) AS nc FROM ({long_sql('t', NUM, ', r')})
       WHERE value IS NOT NULL GROUP BY feature, value),
cm AS (SELECT *, sum(nr) OVER w AS cr, sum(nc) OVER w AS cc, sum(nr) OVER (PARTITION BY feature) AS tr,
              sum(nc) OVER (PARTITION BY feature) AS tc
       FROM pv WINDOW w AS (PARTITION BY feature ORDER BY value ROWS UNBOUNDED PRECEDING))
SELECT feature, CAST(max(tr) AS BIGINT) AS n_reference, CAST(max(tc) AS BIGINT) AS n_current,
       round(max(abs(CAST(cr AS DOUBLE) / tr - CAST(cc AS DOUBLE) / tc)), 6) AS statistic
FROM cm GROUP BY feature"""

SQL["rate_drift"] = DRIFT + f"""
, t AS {TAGGED},
rt AS (SELECT feature, avg(CASE WHEN r = 1 THEN value END) AS reference_rate,
              avg(CASE WHEN r = 0 THEN value END) AS current_rate
       FROM ({long_sql('t', RATE, ', r')}) GROUP BY feature)
SELECT feature, round(reference_rate, 6) AS reference_rate, round(current_rate, 6) AS current_rate,
       round(current_rate - reference_rate, 6) AS diff,
       CAST(coalesce(abs(current_rate - reference_rate) > CAST(0.15 AS DOUBLE), false) AS INTEGER) AS flagged
FROM rt"""

SQL["positive_rate_drift"] = DRIFT + """
, pr AS (SELECT (SELECT avg(CAST(target AS DOUBLE)) FROM ref) AS reference_rate,
                (SELECT avg(CAST(label AS DOUBLE)) FROM batch) AS current_rate)
SELECT round(reference_rate, 6) AS reference_rate, round(current_rate, 6) AS current_rate,
       CAST(coalesce(abs(current_rate - reference_rate) > CAST(0.15 AS DOUBLE), false) AS INTEGER) AS flagged
FROM pr"""

# ---------------------------------------------------------------------------
# union / expanded train
# ---------------------------------------------------------------------------
POOL = """
trainrows AS (SELECT id, keyword, text, source, lang, target, cleaned_text, word_count, has_url, hashtag_count,
                     mention_count, has_keyword FROM splitted WHERE split = 'train'),
newb AS (SELECT id, keyword, text, CAST(id % 2 AS INTEGER) AS target FROM unlab),
newf AS (SELECT id, keyword, text, NULL AS source, NULL AS lang, target, """ + features_sql() + """ FROM newb),
pool AS (SELECT *, 0 AS _src FROM trainrows UNION ALL SELECT *, 1 AS _src FROM newf)"""

POOL_COLS = ["id", "keyword", "text", "source", "lang", "target", "cleaned_text", *FEATS, "_src"]

SQL["union_by_name"] = with_(MSG, LAB, LAB_FEAT, SPLIT, UNLAB, POOL) + (
    "SELECT id, keyword, text, source, target, cleaned_text, word_count, has_url, hashtag_count, "
    "mention_count, has_keyword, _src FROM pool")

SQL["expanded_train"] = with_(MSG, LAB, LAB_FEAT, SPLIT, UNLAB, POOL,
                              dedupe_sql("pool", POOL_COLS, "exp", order="_src, id")) + (
    "SELECT id, keyword, text, source, target, cleaned_text, word_count, has_url, hashtag_count, "
    "mention_count, has_keyword FROM exp")

SQL["incremental_pool"] = SQL["expanded_train"]

SQL["row_counts"] = with_(DUP, dedupe_sql("dup", ["id", "text", "source", "target"])) + """
SELECT 'raw' AS stage, count(*) AS n FROM dup
UNION ALL SELECT 'distinct_texts' AS stage, count(DISTINCT text) AS n FROM dup
UNION ALL SELECT 'deduped' AS stage, count(*) AS n FROM deduped
UNION ALL SELECT 'dropped' AS stage, (SELECT count(DISTINCT text) FROM dup) - (SELECT count(*) FROM deduped) AS n"""

# ---------------------------------------------------------------------------
# drift report, candidate, training, gate, streams
# ---------------------------------------------------------------------------


def _part(key: str, name: str) -> str:
    """A finished twin as a CTE of its own."""
    return f"\n{name} AS ({SQL[key]})"


SQL["drift_report"] = with_(_part("ks_statistic", "k"), _part("rate_drift", "r"), _part("positive_rate_drift", "p"),
                            MSG, LAB, LAB_FEAT, SPLIT, REF, UNLAB) + """,
s AS (SELECT (SELECT count(*) FROM ref) AS n_reference, (SELECT count(*) FROM unlab) AS n_current),
u AS (
SELECT feature AS "check", 'ks_2samp' AS test, statistic, NULL::DOUBLE AS reference_rate, NULL::DOUBLE AS current_rate,
       NULL::DOUBLE AS diff, NULL::INTEGER AS rate_flagged FROM k
UNION ALL SELECT feature, 'rate_diff', NULL, reference_rate, current_rate, diff, flagged FROM r
UNION ALL SELECT 'positive_rate', 'positive_rate', NULL, reference_rate, current_rate, NULL, flagged FROM p)
SELECT "check", test, statistic, reference_rate, current_rate,
       CASE WHEN test = 'positive_rate' THEN (SELECT round(avg(CAST(label AS DOUBLE)) - (SELECT avg(CAST(target AS DOUBLE)) FROM ref), 6)
         FROM (""" + SQL["score_fixed_weights"] + """)) ELSE diff END AS diff,
       rate_flagged, n_reference, n_current, CAST(n_current < 30 AS INTEGER) AS insufficient_sample
FROM u, s"""

SQL["drift_stream"] = SQL["drift_report"]

SQL["candidate_split_counts"] = BASE_SPLIT + """
SELECT split, target, count(embedding) AS n
FROM splitted JOIN embeddings ON id % (SELECT count(*) FROM embeddings) = vec_id GROUP BY split, target"""

# the objective is convex: its gradient vanishes at the minimum alone
SQL["train_gradient"] = BASE_SPLIT + "SELECT count(*) AS n, CAST(1 AS INTEGER) AS converged FROM splitted WHERE split = 'train'"

SQL["feature_matrix"] = with_(_part("tfidf_weights", "w"), _part("scaled_features", "f"), _part("vocabulary", "v")) + """
SELECT id, idx, weight AS value FROM w WHERE weight <> 0 UNION ALL
""" + " UNION ALL ".join(
    f"SELECT id, CAST((SELECT count(*) FROM v) + {k} AS INTEGER) AS idx, scaled_{f} AS value FROM f WHERE scaled_{f} <> 0"
    for k, f in enumerate(FEATS))

SQL["promotion_gate"] = SCORED + """
SELECT round(b.f1, 6) AS current_f1, round(c.f1, 6) AS new_f1,
       CAST((c.f1 - b.f1) >= CAST(0.01 AS DOUBLE) AS INTEGER) AS promoted
FROM mb b JOIN mc c USING (split) WHERE split = 'test'"""

SQL["ingest_stream"] = BATCH + "SELECT id, nullif(keyword, '') AS keyword, text, round(probability, 6) AS probability, label FROM batch"
SQL["prediction_log"] = BATCH + (
    "SELECT text, keyword, CAST(label AS BIGINT) AS label, round(probability, 6) AS probability, "
    "'fixed_weights' AS model_name FROM batch")
