"""URL functions against urllib on hand-picked addresses."""

from __future__ import annotations

from urllib.parse import urlparse

from pyspark.sql import functions as F

from gleanery.functions import urls

ADDRESSES = [
    "https://example.com/path",
    "HTTP://Example.com",
    "  https://a.b/c  ",
    "ftp://files.example",
    "call the office",
    "https://",
    "https:///x",
    "http://user@host:80/x?y#z",
    "//host.only/p",
    "mailto:a@b.com",
    "https://under_score.ex.com:8080/a",
    "http://[::1]:80/x",
    "",
    "https://?q",
]


def test_is_http_url(evaluate):
    def expected(url: str) -> bool:
        parsed = urlparse(url.strip())
        return parsed.scheme in ("http", "https") and bool(parsed.netloc)

    assert evaluate(urls.is_http_url, ADDRESSES) == [expected(u) for u in ADDRESSES]
    assert evaluate(urls.is_http_url, [None]) == [False]


def test_authority_like_netloc(evaluate):
    values = [u.strip() for u in ADDRESSES]
    assert evaluate(urls.authority, values) == [urlparse(u).netloc for u in values]


def test_coerce(evaluate):
    cases = {
        "Roofs.Lake.example": "https://Roofs.Lake.example",
        "example.com/apply now": None,
        "/relative.html": None,
        "a.b": None,
        "abcd": None,
        "abcd/e.f": None,
        "?a.b": None,
        "mailto:a@b.com": "https://mailto:a@b.com",
        " https://x.org/a\n b ": "https://x.org/a b",
        "https:///path": None,
        "": None,
    }
    assert evaluate(urls.coerce_http_url, list(cases)) == list(cases.values())


def test_resolve_prefers_application(spark):
    rows = [
        ("https://forms.lake.example/a", "https://lake.example/p", "https://forms.lake.example/a"),
        ("call the office", "https://lake.example/p", "https://lake.example/p"),
        ("/forms/a.pdf", "lake.example/p", "https://lake.example/p"),
        (None, " plain text ", "plain text"),
        (None, None, ""),
    ]
    df = spark.createDataFrame(rows, "a string, s string, want string")
    link = urls.resolve_link(F.col("a"), F.col("s"))
    assert df.filter(~link.eqNullSafe(F.col("want"))).count() == 0


def test_broken_hosts(evaluate):
    bad = ["http://[oops/x", "http://a]b/", "https://[1234]/", "x.[y/z"]
    good = ["http://[::1]/", "http://[v1.x]/", "http://plain.org/[x]", None, "[not a url"]
    assert evaluate(urls.has_broken_host, bad + good) == [True] * len(bad) + [False] * len(good)
