import re

from pyspark.sql import functions as F

from coverlay.llm import url_rules as U
from coverlay.llm.literals import mandatory, token_choices, trigram_query

URLS = [
    None, "", "no scheme", "http://a.net", "http://a.net/", "HTTP://A.NET/x", "http://x.example.NET/en/1?a#b", "http://example.net/en", "http://notexample.com/de/",
    "http://example.com/de/", "http://m.example.com/de/1", "http://wiki.org/fr/x", "http://org/fr/", "http://b.org/en/", "a://b://c.net/", "x://?net/", "http://h/p?ref=x",
    "http://h/p?ref=x&y", "http://h/p?ref=9", "http://h/login", "http://h/login?x", "http://h/catalogin", "http://ad7.h/", "http://h/big-casino", "http://h/casinos",
    "http://a.com/x.net/", "http://h/a.exe", "http://u.net/robots.txt", "http://u.com/robots.txt", "http://bücher.net/é\n/?q", "ftp://net/", "http://a-net/", "http://h/" + "a/" * 40_000 + "print/",
]


def plain(url):
    """Every rule tried on every url."""
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    raw = re.match(r"[^/?#]*", rest)[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), raw)
    path = re.match(r"[^?#]*", rest[len(raw) :])[0]
    best = None
    for r in U.SITES:
        h, _, p = r.site.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(r.site) > len(best.site)):
            best = r
    if best:
        return host, path, best.site, best.verdict, None
    hits = [r for r in U.PATTERNS if url is not None and re.search(r.pattern, url)]
    hit = next((h for h in hits if h.verdict == "allow"), hits[0] if hits else None)
    return host, path, None, hit.verdict if hit else "allow", hit.pattern if hit else None


def test_against_every_rule(spark):
    rows = [(i, u) for i, u in enumerate(URLS)] + [(5, URLS[5]), (None, "http://q.net/")]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumns({"host": F.lit("h"), "rule": F.lit(1), "_url": F.lit(None)})
    got = U.apply(pages).collect()
    key = lambda r: (r[0] is not None, r[0] or 0)
    assert sorted(map(tuple, got), key=key) == sorted([(i, *plain(u)) for i, u in rows], key=key)
    assert U.apply(pages.limit(0)).count() == 0


def test_rarest_token_is_chosen():
    rules = [U.SiteRule("example.net/en/", "allow"), U.PatternRule("[?&]ref=", "block"), U.PatternRule(r"[a-z]{9,}\d", "block"), U.PatternRule(r"/(?:login|signin)/", "block")]
    index = U.RuleIndex(rules, {"example": 90, "net": 50, "en": 20, "ref": 3})
    assert index.by_token == {"en": [0], "ref": [1], "login": [3], "signin": [3]} and index.always == [2]
    assert index.candidates({"en", "login", "zz"}) == [0, 2, 3]


def test_mandatory_literals():
    assert sorted(map(sorted, token_choices(r"^ads?\.")[0])) == [["ad"], ["ads"]]
    assert token_choices(r"foo") == [] and token_choices(r"/foo[a-z]*/") == [] and token_choices(r"(?:/foo/)*") == []
    assert mandatory(r"(?:ab){2}[0-9]+cd") == [frozenset({"abab"}), frozenset({"cd"})]
    assert trigram_query(r"[0-9a-f]+") == [] and trigram_query("ab.cd") == []
    assert set(trigram_query("a(?:bcd|bx)")[0]) == {frozenset({"abx"}), frozenset({"abc", "bcd"})}
