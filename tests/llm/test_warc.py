"""Revisits against plain loops, with one hot URL over many ranges, and edge cases."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from heliopanel.llm import warc as W

SCHEMA = "record_id long, type string, url string, time timestamp_ntz, http string, digest string, fields string, key int"
T0 = datetime(2024, 1, 1)


def block(status, **fields):
    return "\r\n".join([f"HTTP/1.1 {status} X", *(f"{k.replace('_', '-')}: {v}" for k, v in fields.items()), ""])


def test_canonical_urls(spark):
    cases = {"http://WWW.Example.com:80/a/?b=2&utm_source=x&a=1#top": "example.com/a?a=1&b=2", "https://example.com/": "example.com",
             "https://u:p@example.com:8080/x//": "example.com:8080/x", "ftp://example.com?ref=1": "example.com", " about:blank ": "about:blank",
             "https://example.com/?q=a?b": "example.com?q=a?b", "": "", "http://example.com/A?refer=1": "example.com/A?refer=1"}
    df = spark.createDataFrame([(u,) for u in [*cases, None]], "u string")
    got = {r[0]: r[1] for r in df.select("u", W.canonical_url(F.col("u"))).collect()}
    assert got == {**cases, None: None}


def test_header_blocks(spark):
    df = spark.createDataFrame([("HTTP/1.1 200 OK\r\nA: 1\r\nb:x:y \nA: 2\r\nbroken\r\n: none\r\n\r\n",), (None,), ("",)], "h string")
    got = [r[0] for r in df.select(W.header_map(F.col("h"))).collect()]
    assert got == [{"a": "1, 2", "b": "x:y"}, {}, {}]
    assert [r[0] for r in df.select(W.http_status(F.col("h"))).collect()] == [200, None, None]


def test_against_loops(spark):
    r = random.Random(3)
    rows = []
    for i in range(1500):
        url = "http://hot.example.com/x" if r.random() < 0.4 else f"http://h{r.randint(0, 60)}.example.com/"
        tag, kind = f'"{r.randint(0, 2)}"', r.random()
        time = T0 + timedelta(seconds=r.randint(0, 400))
        if kind < 0.25:
            rows.append((i, "response", url, time, block(200, ETag=tag, Content_Length=i, Date=i), f"d{r.randint(0, 3)}"))
        elif kind < 0.3:
            rows.append((i, "response", url, time, block(404, ETag=tag), "d"))
        else:
            head = {"ETag": tag} if r.random() < 0.7 else {}
            rows.append((i, "revisit", url + "#f", time, block(304, Date=i, Content_Length=0, **head), f"d{r.randint(0, 3)}" if r.random() < 0.7 else None))
    want = {}
    for i, kind, url, time, http, digest in rows:
        if kind != "revisit":
            continue
        url = url.split("#")[0]
        full = [x for x in rows if x[1] == "response" and " 200 " in x[4] and x[2] == url and (x[3], x[0]) < (time, i)]
        prior = max(full, key=lambda x: (x[3], x[0]), default=None)
        if prior is None:
            want[i] = ("no_response", None, None)
            continue
        old = dict(x.split(": ") for x in prior[4].split("\r\n")[1:-1])
        new = dict(x.split(": ") for x in http.split("\r\n")[1:-1])
        same = new["ETag"] == old["ETag"] if "ETag" in new else None if digest is None else digest == prior[5]
        fields = {"etag": old["ETag"], "content-length": old["Content-Length"], "date": new["Date"]}
        want[i] = ("unverified", None, None) if same is None else ("resolved", prior[0], fields) if same else ("mismatch", None, None)
    df = spark.createDataFrame([(*x, None, 1) for x in rows], SCHEMA).repartition(7)
    got = W.resolve_revisits(df).collect()
    assert {g["record_id"]: (g["outcome"], g["response_id"], g["fields"]) for g in got} == want and len(got) == len(want)


def test_edges(spark):
    ok = ("response", "http://a.b/c", T0, block(200, ETag='"1"'), "d")
    late = T0 + timedelta(seconds=9)
    rows = [(1, *ok), (2, "revisit", "https://www.a.b/c/", late, block(304, ETag='W/"1"'), None),
            (2, "revisit", "https://www.a.b/c/", late, block(304, ETag='W/"1"'), None), (3, "revisit", None, late, None, None),
            (4, "revisit", "http://a.b/c", None, None, None), (None, "revisit", "http://a.b/c", late, None, "d"),
            (5, "revisit", "http://a.b/c", late, None, None), (6, None, "http://a.b/c", late, None, None),
            (7, "revisit", "http://a.b/c", T0 - timedelta(1), None, "d"), (8, "response", None, T0, block(200), "d")]
    df = spark.createDataFrame([(*x, "f", 1) for x in rows], SCHEMA)
    got = sorted(((g["record_id"], g["outcome"]) for g in W.resolve_revisits(df).collect()), key=str)
    assert got == [(2, "resolved"), (2, "resolved"), (3, "no_response"), (4, "no_response"), (5, "unverified"), (7, "no_response"), (None, "no_response")]
    assert W.resolve_revisits(df.limit(0)).count() == 0
