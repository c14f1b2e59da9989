from __future__ import annotations

from cardpanel.llm import url_rules as R

URLS = [
    (1, "https://www.Example.ORG/es/1?x=1"), (2, "http://example.org/en/15"), (3, "http://a.org"), (4, "http://a.org/?q"), (5, "http://x.com/fr/1"),
    (6, "http://x.com/de/1#y"), (7, "http://notexample.org/es/1"), (8, None), (9, "no url"), (9, "no url"), (10, "http://myorg/x"), (11, ""),
    (12, "http://org/x"), (13, "ftp://a.b.c.d.e/f/g/h/" + "z" * 50_000),
]


def frame(spark, rows=URLS):
    return spark.createDataFrame([(i, u, "h", "r", "v") for i, u in rows], "page_id long, url string, html string, rule string, tokens string")


def test_given_rules(spark):
    rows = R.judged(frame(spark)).collect()
    got = {r.page_id: (r.host, r.path, r.rule) for r in rows}
    assert len(rows) == len(URLS)
    assert got[1] == ("www.example.org", "/es/1", "example.org/es/") and got[2] == ("example.org", "/en/15", "example.org/en/1")
    assert got[3] == ("a.org", "", None) and got[4] == ("a.org", "/", "org/") and got[5][2] == "com/fr/" and got[6] == ("x.com", "/de/1", "com/de/")
    assert got[7][2] == "org/" and got[8] == got[9] == got[11] == ("", "", None) and got[10][2] is None and got[12][2] == "org/"
    assert all(r.verdict in ("allow", "block") for r in rows)


def test_mined_rules_decide_the_rest(spark):
    rows = [(i, f"http://h{i}.com/{'de' if i % 2 else 'fr'}/{i}.html") for i in range(60)] + [(100, "http://h.net/de/7.html"), (101, "http://h.net/fr/7.html"), (102, "http://h.net/it/1")]
    got = {r.page_id: r.verdict for r in R.judged(frame(spark, rows)).collect()}
    assert got[100] == "block" and got[101] == "allow" and got[102] == "allow"


def test_no_labels_and_empty(spark):
    assert {r.verdict for r in R.judged(frame(spark, [(1, "http://a.net/x")])).collect()} == {R.DEFAULT}
    assert R.judged(frame(spark).limit(0)).count() == 0


def test_no_python_in_the_plan(spark):
    plan = R.judged(frame(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
