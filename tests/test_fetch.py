"""Fetching with made-up clients."""

import pytest

from fieldspark.sources import fetch


def client(answers):
    left = {u: list(a) for u, a in answers.items()}

    def get(url):
        a = left[url].pop(0)
        if isinstance(a, Exception):
            raise a
        return a

    return get


def test_polite_tries():
    waits = []
    get = client({"u": [(429, {"Retry-After": "7"}, ""), (503, {}, ""), OSError("gone"), (200, {}, "ok")]})
    assert fetch.polite_get(get, "u", 6, waits.append) == (200, "ok") and waits == [7.0, 2.0, 4.0]
    waits.clear()
    assert fetch.polite_get(client({"u": [(404, {}, "")]}), "u", 6, waits.append) == (404, None) and waits == []
    assert fetch.polite_get(client({"u": [(500, {}, "")] * 3}), "u", fetch.FINAL_TRIES, waits.append) == (500, None) and waits == [1.0, 2.0]
    assert fetch.wait_before(9) == 60.0 and fetch.wait_before(1, {"retry-after": "600"}) == 60.0


@pytest.mark.parametrize("url,ok", [("https://a.b/x", True), ("http://a.b/x", False), ("https://evil/a.b", False)])
def test_hosts(url, ok):
    assert fetch.allowed(url, frozenset({"a.b"})) == ok


def test_only_the_missing_is_fetched(spark, tmp_path):
    cache = f"{tmp_path}/c"
    req = fetch.season_chunks(spark, [2024], "https://a.b/{season}/{type}/{week}", weeks=3)
    assert req.count() == 6

    def some(url):
        return (200, {}, f"body of {url}") if url.endswith(("1", "2")) else (404, {}, "")

    def rest(url):
        if not url.endswith("3"):
            raise AssertionError("asked again")
        return 200, {}, "late"

    assert fetch.fetch_missing(req, some, cache, frozenset({"a.b"}), 2).count() == 4
    got = fetch.fetch_missing(req, rest, cache, frozenset({"a.b"}), 2, tries=1)
    assert got.count() == 6 and got.where("body = 'late'").count() == 2
    refused = fetch.fetched(req.union(spark.createDataFrame([(None, "https://a.b/1/1/1")], req.schema)), some, frozenset({"c.d"}))
    assert [r.status for r in refused.select("status").distinct().collect()] == [-1] and refused.count() == 6


def test_links_in_answers(spark):
    body = '{"items": [{"$ref": "http://a.b/v2/events/401?lang=en"}, {"$ref": "http://a.b/v2/events/402"}, {"x": "1"}, {"$ref": "http://a.b/none"}]}'
    df = spark.createDataFrame([(body,), ("broken",), (None,)], "body string")
    assert sorted(map(tuple, fetch.linked_requests(df, "$.items").collect())) == [("401", "https://a.b/v2/events/401?lang=en"), ("402", "https://a.b/v2/events/402")]
