import collections
import random
import re

import pytest

from strandforge.llm.queries import SITE_RULES
from strandforge.llm.url_filter import DEFAULT_PATTERNS, RuleIndex, UrlRule, filter_urls, site_rule, site_rules, split_url, tokens_of, word_rule
from tests.llm.texts import crowded

URLS = [
    "http://Example.NET/en/a?x=1", "https://blog.example.net/de/1", "http://example.net", "http://a.net/", "http://notexample.net/en/1", "http://example.net.evil.com/en/", "ftp://x.example.com/de/1#f",
    "http://example.com/de", "http://x.org/fr/2", "http://x.org/en/2", "http://cheap-pills.example.org/", "http://cheapish-pills.org/x", "no scheme", "", None, "http://", "://net/", "http://a b.net/x", "http://u:p@h.net:80/q",
    "HTTP://A.ORG/FR/x", "http://x.org/fr/", "http://x.org/frx/", "http://example.net/en", "x://y://net/a",
]


def brute(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split("[/?#]", rest, maxsplit=1)[0]
        path = re.split("[?#]", rest[len(host) :], maxsplit=1)[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    best = None
    for v, h, p in (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")):
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[1])):
            best = (v, h + p)
    spam = any(re.search(rf"(?<![a-z0-9]){w}(?![a-z0-9])", host) for w in ("cheap[-_]pills", "free[-_]bets", "casino", "adult", "porn", "xxx", "viagra", "ads[-_]track"))
    return host, path, best[1] if best else None, best[0] if best else "block" if spam else "allow"


def test_equals_brute_force(spark):
    rnd = random.Random(1)
    parts = ["http://", "net", "example", ".", "com", "org", "/", "en", "de", "fr", "?", "#", "casino", "-", "free", "bets", "X", "://"]
    urls = URLS + ["".join(rnd.choice(parts) for _ in range(rnd.randint(1, 14))) for _ in range(3000)]
    urls += ["http://" + rnd.choice(["", "a.", "casino."]) + rnd.choice(["example.net", "net", "example.com", "b.org", "org"]) + rnd.choice(["", "/", "/en/", "/de/x", "/fr/", "/fr?x"]) for _ in range(300)]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)] + [(None, URLS[0])], "page_id long, url string")
    got = {r.page_id: r for r in filter_urls(crowded(df), SITE_RULES + DEFAULT_PATTERNS).collect()}
    assert len(got) == len(urls) + 1
    for i, u in enumerate(urls):
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == brute(u), u
    assert filter_urls(df.limit(0), SITE_RULES).count() == 0


def test_rules_are_found_by_their_rarest_token():
    rules = [site_rule("block", "a.example.com"), UrlRule("any", "block", r".*zz", ())]
    index = RuleIndex(rules, {"a": 5, "example": 900, "com": 800})
    assert list(index.by_token) == ["a"] and len(index.always) == 1
    assert index.judge("x.a.example.com", "/", "allow")[:2] == ("a.example.com/", "block")
    assert index.judge("b", "/zz", "allow") == (None, "block", "any")
    # the last word of a rule's path may go on in the URL, so it is no token
    assert "en" not in site_rule("allow", "b.com", "/x/en").tokens
    assert RuleIndex([site_rule("block", "b.com", "/x/en")], {}).judge(*split_url("http://b.com/x/english"), "allow")[1] == "block"
    assert tokens_of("A.b-c", "/D/e") >= {"b", "c", "d", "e"}


def test_a_host_with_nul_is_a_subdomain_too(spark):
    from strandforge.llm.url_filter import filter_urls, site_rule

    rows = [(1, "http://a\0b.example.net/x"), (2, "http://a\0.net/"), (2, "http://net/"), (2, "http://net/")]
    got = filter_urls(spark.createDataFrame(rows, "page_id long, url string"), [site_rule("block", "net")]).collect()
    assert len(got) == 4 and all(r.rule == "net/" for r in got)


def test_index_of_thousands_of_rules_equals_trying_all(spark):
    """Rules fetched by their rarest token are all that can match; most are never tried."""
    rnd = random.Random(7)
    names = [f"{rnd.choice('abcdefgh')}{k}" for k in range(400)]
    host = lambda: ".".join(rnd.choice(names) for _ in range(rnd.randint(1, 3))) + rnd.choice([".net", ".org", ".co.uk"])
    table = [(rnd.choice(["block", "allow"]), host(), rnd.choice([None, "/", "/a/", "/a/b", "/x-y/"])) for _ in range(4000)] + [(None, "a.net", "/"), ("block", None, "/"), ("block", "", "/")]
    rules = site_rules(spark.createDataFrame(table + table[:10], "verdict string, host string, path string")) + [word_rule("block", f"w{k}", names[k], names[k + 1]) for k in range(300)]
    assert len(rules) == len({t for t in ((v, h, p or "/") for v, h, p in table) if t[0] and t[1]}) + 300
    urls = ["http://" + rnd.choice(["", "www.", names[3] + "-" + names[4] + "."]) + (rnd.choice(table[:4000])[1] if rnd.random() < 0.7 else host()) + rnd.choice(["", "/", "/a/", "/a/b?q", "/x-y/z", "/q"]) for _ in range(400)]
    compiled = [(r, re.compile(r.pattern)) for r in rules]
    got = {r.page_id: r for r in filter_urls(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), rules).collect()}
    found = 0
    for i, u in enumerate(urls):
        h, p = split_url(u)
        fit = [r for r, c in compiled if c.match(h + "\0" + p)]
        sites, words = [r for r in fit if r.site], [r for r in fit if not r.site]
        best = max(sites, key=lambda r: (len(r.name), r.name), default=None) or max(words, key=lambda r: r.name, default=None)
        found += best is not None
        names_of = {r.verdict for r in sites if best and r.name == best.name} or {best.verdict if best else "allow"}
        assert got[i].verdict in names_of and got[i].rule == (best.name if best and best.site else None) and got[i].pattern_rule == (best.name if best and not best.site else None)
    assert found > 200
    seen = collections.Counter(t for u in urls for t in tokens_of(*split_url(u)))
    index = RuleIndex(rules, seen)
    tried = [sum(len(index.by_token.get(t, ())) for t in tokens_of(*split_url(u))) for u in urls]
    assert not index.always and sum(tried) < 0.02 * len(urls) * len(rules)
    with pytest.raises(ValueError):
        site_rules(spark.createDataFrame(table, "verdict string, host string, path string"), most=10)
