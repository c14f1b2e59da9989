from __future__ import annotations

import datetime as dt
import random

from cardpanel.llm import revisits as R

SCHEMA = "record_id long, url string, ts timestamp, kind string, headers array<struct<name:string,value:string>>, payload_digest string, block int, own string"


def record(i, url, day, kind, etag=None, changed=None, digest=None, **more):
    headers = [(k.replace("_", "-"), v) for k, v in {"etag": etag, "last_modified": changed, **more}.items() if v is not None]
    ts = None if day is None else dt.datetime(2024, 1, 1) + dt.timedelta(days=day)
    return (i, url, ts, kind, headers, digest, 1, "x")


def resolve(spark, rows):
    return {r.record_id: r for r in R.resolve(spark.createDataFrame(rows, SCHEMA)).collect()}


def test_validators_headers_and_order(spark):
    rows = [
        record(1, "http://A.com:80/x?b=2&a=1&utm_source=f#top", 0, "response", '"v1"', "mon", "d1", content_length="9", vary="a"),
        record(2, "https://a.com/x?a=1&b=2", 1, "revisit", 'W/"v1"', content_length="0", cache_control="no", connection="close"),
        record(3, "http://a.com/x?a=1&b=2", 2, "response", '"v2"', "tue", "d2"),
        record(4, "http://a.com/x?a=1&b=2", 2, "response", '"v3"', "wed", "d3"),
        record(5, "http://a.com/x?a=1&b=2", 2, "revisit", '"v1"'),  # not later than 3 and 4
        record(6, "http://a.com/x?a=1&b=2", 3, "revisit", None, "wed"),  # of two at one time the larger id
        record(7, "http://a.com/x?a=1&b=2", 4, "revisit", '"v2"'),
        record(8, "http://a.com/x?a=1&b=2", 5, "revisit"),
        record(9, "http://b.com/", 5, "revisit", '"v2"'),
        record(10, None, 5, "revisit", '"v2"'), record(11, "http://a.com/x?a=1&b=2", None, "revisit", '"v2"'), record(12, "http://a.com", 1, "other"),
    ]
    got = resolve(spark, rows)
    assert {k: (v.status, v.response_id) for k, v in got.items()} == {
        2: ("matched", 1), 5: ("matched", 1), 6: ("matched", 4), 7: ("mismatch", None), 8: ("no_validator", None),
        9: ("no_response", None), 10: ("no_response", None), 11: ("no_response", None)}
    assert [tuple(h) for h in got[2].headers] == [("cache-control", "no"), ("content-length", "9"), ("etag", 'W/"v1"'), ("last-modified", "mon"), ("vary", "a")]
    assert got[2].payload_digest == "d1" and got[7].headers is None


def test_hot_url_in_blocks_equals_brute_force(spark):
    rng = random.Random(3)
    rows = [record(i, "http://hot.com/" if rng.random() < 0.7 else f"http://{rng.randrange(30)}.com/", rng.randrange(200),
                   "response" if rng.random() < 0.1 else "revisit", f'"{rng.randrange(2)}"', digest=str(i)) for i in range(1500)]
    got = resolve(spark, rows)
    for i, url, ts, kind, headers, *_ in rows:
        if kind == "revisit":
            before = [(r[2], r[0], r[4]) for r in rows if r[3] == "response" and r[1] == url and r[2] < ts]
            want = ("no_response", None)
            if before:
                _, response, old = max(before, key=lambda x: x[:2])
                want = ("matched", response) if old == headers else ("mismatch", None)
            assert (got[i].status, got[i].response_id) == want


def test_empty(spark):
    assert R.resolve(spark.createDataFrame([], SCHEMA)).count() == 0
