from datetime import datetime, timedelta

from obslake.llm.url_lists import match_lists, validity_intervals

CAPTURES = "page int, url string, fetched_at timestamp, value string, Lists string"
ENTRIES = "list string, scope string, value string, action string, effective_at timestamp, note string"
DAY = datetime(2024, 1, 1)


def day(n):
    return DAY + timedelta(days=n)


def entry(name, scope, value, action, n):
    return (name, scope, value, action, None if n is None else day(n), "x")


ROWS = [
    entry("spam", "host", "a.example.org", "add", 10), entry("spam", "host", "a.example.org", "remove", 40),
    entry("spam", "host", "a.example.org", "add", 90), entry("spam", "host", "a.example.org", "add", 95),
    entry("adult", "domain", ".Example.org", "add", 20), entry("adult", "domain", "example.org", "remove", 30),
    entry("odd", "prefix", "b.net/x/y", "add", 0), entry("odd", "prefix", "b.net/x/y", "remove", 0),
    entry("gone", "host", "b.net", "remove", 5), entry("bad", "host", "b.net", "add", None), entry(None, "host", "b.net", "add", 1),
    entry("bad", "site", "b.net", "add", 1), entry("spam", "host", "a.example.org", "add", 10),
]


def test_intervals(spark):
    found = validity_intervals(spark.createDataFrame(ROWS, ENTRIES)).collect()
    assert sorted((r.list, r.value, r.since, r.until or day(999)) for r in found) == [
        ("adult", "example.org", day(20), day(30)), ("odd", "b.net/x/y", day(0), day(999)),
        ("spam", "a.example.org", day(10), day(40)), ("spam", "a.example.org", day(90), day(999)),
    ]


def test_matches_at_the_time_of_the_capture(spark):
    cases = [
        ("http://a.example.org/", 9, [], None), ("http://a.example.org/", 10, ["spam"], 10), ("HTTPS://u:p@A.example.org:8080?q", 39, ["spam"], 10),
        ("http://a.example.org/", 40, [], None), ("http://a.example.org./z", 25, ["adult", "spam"], 10), ("http://a.example.org", 300, ["spam"], 90),
        ("http://example.org/q", 29, ["adult"], 20), ("http://notexample.org/q", 29, [], None), ("http://b.net/x/y", 1, ["odd"], 0),
        ("http://b.net/x/y/z?k#f", 1, ["odd"], 0), ("http://b.net/x/yz", 1, [], None), ("http://c.b.net/x/y", 1, [], None),
        ("no url", 1, [], None), ("", 1, [], None), (None, 1, [], None), ("http://b.net/x/y", None, [], None), ("http://b.net/x/y", 1, ["odd"], 0),
    ]
    rows = [(k, u, None if n is None else day(n), "v", "w") for k, (u, n, *_) in enumerate(cases)]
    captures = spark.createDataFrame(rows, CAPTURES)
    found = {r.page: r for r in match_lists(captures, spark.createDataFrame(ROWS, ENTRIES)).collect()}
    assert len(found) == len(cases)
    for k, (url, n, lists, since) in enumerate(cases):
        assert (found[k].lists, found[k].listed_since) == (lists, None if since is None else day(since)), (url, n)
    assert found[0].value == "v" and captures.limit(0).count() == 0
    assert match_lists(captures.limit(0), spark.createDataFrame(ROWS, ENTRIES)).collect() == []
    assert {tuple(r.lists) for r in match_lists(captures, spark.createDataFrame([], ENTRIES)).collect()} == {()}
