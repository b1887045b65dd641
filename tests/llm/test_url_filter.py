"""URL verdicts against a plain search through all rules."""

import random

import pytest

from starloom.llm.url_filter import build_cascade, filter_urls, listed

RULES = [
    ("net/", "block"),
    ("example.net/en/", "allow"),
    ("example.com/de/", "block"),
    ("org/fr/", "allow"),
    ("a.b.net/", "allow"),
    ("bare.org", "block"),
    ("twice.org/", "allow"),
    ("twice.org/", "block"),
    ("net/abcd", "allow"),
    ("EXAMPLE.net/En/ü", "block"),
    ("/no host", "block"),
    ("x.org/", None),
    (None, "block"),
]
URLS = [
    None,
    "",
    "no scheme/net/",
    "http://",
    "http:///en/",
    "http://net",
    "http://net/",
    "https://NET/x",
    "https://a.net?x=/",
    "https://a.net/?x",
    "https://example.net/en",
    "https://www.Example.NET/en/1#top",
    "https://badexample.com/de/1",
    "https://x.example.com/de/1://net/",
    "x://fr.org/fr/",
    "x://a.b.net/abcd/",
    "x://b.net/abcd/",
    "x://bare.org?",
    "x://y.bare.org#/",
    "x://twice.org/1",
    "x://example.net/En/ü/ö",
    "x://x.org/",
    "x://net:80/",
    "x://net./",
    "x://" + "a." * 50_000 + "net/" + "p" * 100_000,
]


def expected(url):
    at = (url or "").find("://")
    rest = url[at + 3 :] if at >= 0 else ""
    end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
    path = rest[end : min([k for k in (rest.find(c, end) for c in "?#") if k >= 0] or [len(rest)])]
    best = None
    for rule, verdict in RULES:
        if rule is None or verdict is None:
            continue
        name, slash, start = rule.partition("/")
        name = "".join(c.lower() if "A" <= c <= "Z" else c for c in name)
        fits = name and host and ("." + host).endswith("." + name) and path.startswith(slash + start)
        if fits:
            key = (len(name + slash + start), len(name), name + slash + start, verdict == "block")
            best = max(best, key) if best else key
    return host, path, best and best[2], "block" if best and best[3] else "allow"


@pytest.fixture(scope="module")
def rules(spark):
    return spark.createDataFrame(RULES, "rule string, verdict string")


@pytest.mark.parametrize("options", [{}, {"first": (1, 1), "others": (1, 1)}, {"most_bytes": 4}, {"shapes_a_pass": 2}])
def test_verdicts(spark, rules, options):
    rows = [(k % 7 or None, url, "h", k) for k, url in enumerate(URLS)] + [(1, URLS[11], "h", 99)]
    pages = spark.createDataFrame(rows, "page_id long, url string, rule string, host long")
    found = filter_urls(spark, pages, rules, **options).collect()
    got = sorted((r.passed.host, r.passed.url, r.passed.rule, r.host, r.path, r.rule, r.verdict) for r in found if r.passed.url)
    assert got == sorted((n, url, "h", *expected(url)) for _, url, _, n in rows if url)
    assert [(r.host, r.path, r.rule, r.verdict) for r in found if not r.passed.url] == [("", "", None, "allow")] * 2


def test_no_rules_and_no_pages(spark, rules):
    pages = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    assert [tuple(r)[1:] for r in filter_urls(spark, pages, rules.limit(0)).collect()] == [("a.net", "/", None, "allow")]
    assert filter_urls(spark, pages.limit(0), rules).count() == 0


def test_a_small_cascade_is_exact(spark):
    draw = random.Random(5)
    words = sorted({"".join(draw.choices("abc", k=7)) for _ in range(2000)})
    keys = spark.createDataFrame([(w,) for w in words * 2], "key string")
    rules = spark.createDataFrame([(w,) for w in [*words[::7], "not in the universe"]], "key string")
    levels = build_cascade(spark, rules, keys, first=(2, 1), others=(2, 1))
    assert len(levels) > 3
    assert sorted(r.key for r in keys.distinct().where(listed(keys.key, levels)).collect()) == words[::7]


def test_no_python_in_the_plan(spark, rules):
    pages = spark.createDataFrame([], "page_id long, url string")
    plan = filter_urls(spark, pages, rules)._jdf.queryExecution().toString()
    assert "Python" not in plan and "InArrow" not in plan and "Join" not in plan
