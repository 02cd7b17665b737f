import re

from hypothesis import given, settings
from hypothesis import strategies as st

from lakemart.llm.url_filter import SOFT, STRICT, judge_urls, rejects

PARTS = st.sampled_from([*STRICT, *SOFT, "-", ".", "/", "x", "1", "_", "é", "Casino", "ADS", "?"])


def plainly(url):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), url)
    hit = lambda t: re.search(f"(?<![a-z0-9]){t}(?![a-z0-9])", text)
    return any(map(hit, STRICT)) or sum(bool(hit(t)) for t in SOFT) >= 2


@settings(max_examples=500, deadline=None)
@given(st.lists(PARTS, max_size=8).map("".join))
def test_vocabulary_equals_regular_expressions(url):
    assert rejects(url, STRICT, SOFT, 2) == plainly(url)


def test_rules_hosts_and_odd_rows(spark, rows):
    urls = [
        None, "", "no scheme casino", "http://A.Example.ORG/en/12?x#y", "http://example.org/es", "x://example.org/es/", "http://badexample.org/es/",
        "http://q.com/fr/", "http://com/de/1", "http://casino.net/", "http://a.net/ads/track", "http://a.net/ads/ads", "http://a.org/casino",
        "http://org", "http://org?/", "://org/", "a://b://c/d", "http://x.com/fr/" + "y" * 100_000,
    ]
    got = judge_urls(spark.createDataFrame([(i, u, "mine") for i, u in enumerate([*urls, urls[3]])], "page_id long, url string, rule string"))
    by = {r.page_id: (r.host, r.path[:20], r.rule, r.verdict) for r in got.collect()}
    assert by[0] == by[1] == ("", "", None, "allow") and by[2] == ("", "", None, "block")
    assert by[3] == by[18] == ("a.example.org", "/en/12", "example.org/en/1", "block")
    assert by[4] == ("example.org", "/es", "org/", "allow") and by[5] == ("example.org", "/es/", "example.org/es/", "block")
    assert by[6] == ("badexample.org", "/es/", "org/", "allow")
    assert by[7] == ("q.com", "/fr/", "com/fr/", "allow") and by[8] == ("com", "/de/1", "com/de/", "block")
    assert [by[i][3] for i in (9, 10, 11, 12)] == ["block", "block", "allow", "allow"]
    assert by[13] == ("org", "", None, "allow") and by[14] == ("org", "", None, "allow") and by[15] == ("org", "/", "org/", "allow")
    assert by[16] == ("b:", "//c/d", None, "allow") and by[17][2:] == ("com/fr/", "allow")


def test_empty_table_and_own_lists(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    assert judge_urls(none).count() == 0
    one = spark.createDataFrame([(1, "http://a.b/c")], "page_id long, url string")
    assert judge_urls(one, rules=[], strict=[], soft=[]).first().verdict == "allow"
