import re

import duckdb

from kindling.llm import lines as N


def brute(rows, ratio, least):
    pages = {}
    for _, text, site in rows:
        pages.setdefault(site, set()).add(text)
    bad = {}
    for site, texts in pages.items():
        held = {}
        for t in texts:
            for line in set((t or "").split("\n")):
                if re.search(r"[^\x20\x09-\x0D]", line):
                    held[line] = held.get(line, 0) + 1
        bad[site] = {x for x, n in held.items() if n >= least and n > ratio * len(texts)}
    out = []
    for i, text, site in rows:
        lines = [] if text is None else text.split("\n")
        kept = [x for x in lines if x not in bad[site]]
        out.append((i, len(lines), len(lines) - len(kept), None if text is None else "\n".join(kept)))
    return sorted(out, key=repr)


def result(df):
    return sorted(((r.doc_id, r._n_lines, r._n_dropped, r.text) for r in df.collect()), key=repr)


def test_edge_cases_match_brute_force(edge):
    rows = [tuple(r) for r in edge.select("doc_id", "text", "source").collect()]
    for ratio, least in ((0.1, 5), (0.3, 1), (0.0, 1)):
        assert result(N.drop_boilerplate(edge, max_ratio=ratio, min_pages=least)) == brute(rows, ratio, least)


def test_boilerplate_goes_and_copies_stay(docs_of):
    rows = [(i, f"Own line {i}\nShared footer\n\nOwn end {i}", "en", "site") for i in range(20)]
    rows += [(100 + i, "A page that was copied\nwith two lines", "en", "site") for i in range(50)]
    rows += [(200 + i, "Shared footer\nelsewhere it is rare " + str(i), "en", None if i else "other") for i in range(5)]
    got = {r.doc_id: r for r in N.drop_boilerplate(docs_of(rows)).collect()}
    assert got[3].text == "Own line 3\n\nOwn end 3" and got[3]._n_dropped == 1
    assert got[120].text == "A page that was copied\nwith two lines"
    assert got[200].text.startswith("Shared footer")


def test_shuffle_join_gives_the_same(edge, monkeypatch):
    want = result(N.drop_boilerplate(edge, max_ratio=0.0, min_pages=1))
    monkeypatch.setattr(N, "BROADCAST_BYTES", -1)
    assert result(N.drop_boilerplate(edge, max_ratio=0.0, min_pages=1)) == want


def test_empty(empty):
    got = N.drop_boilerplate(empty)
    assert got.count() == 0 and got.columns == [*empty.columns, "_n_lines", "_n_dropped"]


def test_sql_twin(spark):
    d = "/root/testdata/sf0.001"
    duckdb.sql(f"create or replace view documents as select * from '{d}/documents.parquet'")
    want = sorted(duckdb.sql(N.OP6_SQL).fetchall(), key=repr)
    assert sorted(map(tuple, N.op6_line_dedup(spark, d).collect()), key=repr) == want


def test_no_python_in_the_plan(edge):
    plan = N.drop_boilerplate(edge)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))
