from pyspark.sql import functions as F

from daygrain.llm import warc

SCHEMA = "record_id string, url string, at long, kind string, headers map<string,string>, canonical_url string, block int"


def test_canonical_urls(spark):
    pairs = {
        "HTTP://www.Example.org:80/a/b/?utm_source=x&b=2&a=1#frag": "example.org/a/b?a=1&b=2", "https://example.org": "example.org",
        "example.org/": "example.org", "https://user:pw@Example.org:443/A?fbclid=1": "example.org/A", "http://m.example.org/x//": "m.example.org/x",
        "": "", None: None, "http://example.org/?q=a%20b&&": "example.org?q=a%20b",
    }
    rows = spark.createDataFrame([(u, e) for u, e in pairs.items()], "u string, e string").select("e", warc.canonical_url(F.col("u")).alias("c"))
    assert all(r.e == r.c for r in rows.collect())


def records():
    h = lambda **k: {n.replace("_", "-"): v for n, v in k.items()}
    return [
        ("r1", "http://a.org/x", 10, "response", h(etag='"1"', content_length="7", date="d1")),
        ("r2", "https://www.a.org/x/", 50, "response", h(etag='"2"', last_modified="m2", content_length="8")),
        ("r3", "http://a.org/x", 50, "response", h(etag='"3"', last_modified="m3", vary="v")),
        ("v0", "http://a.org/x", 5, "revisit", h(etag='"1"')), ("v1", "http://a.org/x#q", 11, "revisit", h(etag='W/"1"', date="d9", content_length="0")),
        ("v2", "http://a.org/x", 49, "revisit", h(etag='"9"')), ("v3", "http://a.org/x", 50, "revisit", h(last_modified="m3", expires="e")),
        ("v4", "http://a.org/x", 9000, "revisit", h(etag='"3"')), ("v4", "http://a.org/x", 9000, "revisit", h(etag='"3"')),
        ("v5", "http://b.org/", 60, "revisit", h(etag='"3"')), ("v6", None, 60, "revisit", h(etag='"3"')), ("v7", "http://a.org/x", None, "revisit", None),
        ("v8", "http://a.org/x", 70, "revisit", None), ("r9", None, 1, "response", None), ("r8", "http://a.org/x", None, "response", None),
    ]


def test_as_of_any_span(spark):
    docs = spark.createDataFrame([(*r, "c", 3) for r in records()], SCHEMA)
    seen = []
    for span in (1, 16, 100_000):
        got = sorted(((r.record_id, r.response_id, r.state, r.headers) for r in warc.resolved(docs, span).collect()), key=str)
        seen.append(got)
    assert seen[0] == seen[1] == seen[2]
    by = {r[0]: r[1:] for r in seen[0]}
    assert by["v0"] == (None, "missing", None) and by["v5"][1] == "missing" and by["v6"][1] == "missing" and by["v7"][1] == "missing"
    assert by["v1"] == ("r1", "resolved", {"etag": 'W/"1"', "content-length": "7", "date": "d9"})
    assert by["v2"][:2] == ("r1", "changed") and by["v8"][:2] == ("r3", "changed")
    assert by["v3"] == ("r3", "resolved", {"etag": '"3"', "last-modified": "m3", "vary": "v", "expires": "e"})
    assert by["v4"][:2] == ("r3", "resolved") and len(seen[0]) == 10
    assert warc.resolved(docs.limit(0), 10).collect() == []
