import re

import duckdb

from kindling.llm import quality as Q

STOPS = {w for ws in Q.STOP_WORDS.values() for w in ws}


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(words[k:k + 5]) for k in range(len(words) - 4)]
    count = {}
    for g in grams:
        count[g] = count.get(g, 0) + 1
    covered = {p for k, g in enumerate(grams) if count[g] > 1 for p in range(k, k + 5)}
    return (len(words), sum(map(len, words)), len(re.findall(Q.SYMBOLS, text)), len(lines) - len(set(lines)), len(covered),
            len(lines), sum(w.lower() in STOPS for w in words) + 1, sum(a == b for a, b in zip(words, words[1:])))


COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stop_words_and_one", "n_doubled_words")


def check(df):
    rows = df.select("doc_id", "text").collect()
    got = sorted(((str(r.doc_id), *(r[c] for c in COLUMNS)) for r in Q.statistics(df).collect()))
    assert got == sorted((str(r.doc_id), *brute(r.text)) for r in rows)


def test_edge_cases_match_brute_force(edge):
    check(edge)


def test_repeats_match_brute_force(docs_of):
    texts = ["a b c d e a b c d e", "a a a a a", "a a a a a a", "a a a a", "a b c d e x a b c d e f g h i j k l a b c d e", "x\ny\nx\n\n \n \nx",
             "# $ | <b> & 100%", "To " * 5000, "ß é 🙂 " * 7]
    check(docs_of([(k, t, None, None) for k, t in enumerate(texts)]))


def test_driver_rows_match_brute_force(small):
    check(small("documents"))


def test_sql_twin(spark):
    d = "/root/testdata/sf0.001"
    duckdb.sql(f"create or replace view documents as select * from '{d}/documents.parquet'")
    want = sorted(duckdb.sql(Q.OP3_SQL).fetchall())
    assert sorted(map(tuple, Q.op3_quality_rules(spark, d).collect())) == want


def test_labelled_rows_are_judged_right(spark):
    d = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{d}/labels.parquet").select("doc_id", "quality")
    judged = Q.op3_quality_rules(spark, d).join(labels, "doc_id").collect()
    assert not any(r.kept for r in judged if r.quality == 0)
    assert all(r.kept or r.base_failed for r in judged if r.quality == 1)


def test_rule_table_is_the_verdict(docs_of):
    text = "the cat sat on a mat with the dog in our yard " + "# " * 30
    row = Q.judge(docs_of([(1, text, None, None)])).first()
    assert not row.symbols_per_word and not row.kept
    row = Q.judge(docs_of([(1, text, None, None)]), rules={"mean_word_length": ("word_chars", "n_words", None, 99.0)}).first()
    assert row.mean_word_length


def test_empty(empty):
    assert Q.judge(empty).count() == 0


def test_one_projection_without_python(edge):
    plan = Q.judge(edge)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "Exchange", "Generate"))
