import re

import pytest

from tallyhouse.llm import url_filter as op
from tests.llm import cases


def brute(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest).group()
        path = re.match(r"[^?#]*", rest[len(host) :]).group()
    host = re.sub("[A-Z]", lambda m: m.group().lower(), host)
    best = None
    for rule, verdict in (
        ("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"),
        ("com/fr/", "allow"), ("com/de/", "block"),
    ):
        rule_host, _, rule_path = rule.partition("/")
        if (host == rule_host or host.endswith("." + rule_host)) and path.startswith("/" + rule_path):
            if best is None or len(rule) > len(best[0]):
                best = (rule, verdict)
    if best:
        return host, path, *best
    spam = any(re.search(r.pattern, host + path) for r in op.WORD_RULES)
    return host, path, None, "block" if spam else "allow"


URLS = [
    None, "", "no scheme", "http://", "http://ORG/x", "https://a.Example.org/es/1?q#f", "x://example.org/es",
    "http://example.org/en/1", "http://example.org/en/123/", "http://b.example.org/en/2", "http://notorg/",
    "http://example.org", "http://example.org?x=/es/", "http://x.com/fr/", "http://com/de/a", "http://xcom/de/",
    "http://www.casino-win.example.net/", "http://casinos.net/", "http://pills.example.net/casino", "a://b://org/",
    "http://user@host.org:80/p\nq", "http://\u00e4.org/", "http://cheap-pills.com/fr/1", "http://x/" + "y" * 50_000,
]


@pytest.mark.parametrize("extra", [False, True])
def test_equals_brute_force(spark, extra):
    rows = [(i, u) for i, u in enumerate(URLS)] + [(3, URLS[5]), (None, URLS[5])]
    pages = spark.createDataFrame(rows, "page_id bigint, url string")
    if extra:
        pages = pages.selectExpr("*", "'old' as host", "'old' as rule", "1 as _tokens", "2 as _name")
    judged = op.judge(pages, op.HOST_RULES + op.WORD_RULES)
    names = [r.name for r in op.HOST_RULES]
    found = [
        (r.page_id, r.url, r.host, r.path, r.rule if r.rule in names else None, r.verdict)
        for r in judged.collect()
    ]
    assert sorted(found, key=str) == sorted([(i, u, *brute(u)) for i, u in rows], key=str)


def test_rules_without_tokens_and_no_rules(spark):
    pages = spark.createDataFrame([(1, "http://a.b/c"), (2, "http://d.e/")], "page_id int, url string")
    odd = [op.Rule("any c", "block", "/c$", (), 1)]
    assert {r.page_id: r.verdict for r in op.judge(pages, odd).collect()} == {1: "block", 2: "allow"}
    assert [r.rule for r in op.judge(pages, []).collect()] == [None, None]
    assert op.judge(pages.limit(0), odd).count() == 0
    with pytest.raises(ValueError):
        op.judge(pages, odd * 2)


def test_rarest_token_is_the_index_key(spark):
    pages = spark.createDataFrame([("http://a.com/fr/",)] * 3 + [("http://b.com/x",)], "url string")
    tokens = pages.select(op.tokens_of(op.host_of(pages.url), op.path_of(pages.url)).alias("_tokens"))
    assert op.rarest_tokens(tokens, [op.host_rule("allow", "com", "/fr/")]) == {"com/fr/": "p:fr"}
    assert cases.EXTRA
