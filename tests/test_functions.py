from datetime import datetime
import random

import pytest
from pyspark.sql import functions as F

from brightweir.functions import dates, keys, names, text, urls

REF = "2026-09-12 12:00:00"


@pytest.mark.parametrize(
    "raw, canonical",
    [
        ("HTTPS://News.Site.ORG:443/y/z/?z=9&utm_medium=mail&c=3#top", "https://news.site.org/y/z?c=3&z=9"),
        ("https://news.site.org/y/z?c=3&z=9", "https://news.site.org/y/z?c=3&z=9"),
        ("https://a.com", "https://a.com"),
        ("https://a.com/", "https://a.com/"),
        ("http://a.com:443/x", "http://a.com:443/x"),
        ("http://a.com:80/x", "http://a.com/x"),
        ("http://x/?a=&b=1", "http://x/?b=1"),
        ("http://x/?REF=x&q=a%20b", "http://x/?q=a+b"),
        ("http://x/y;p", "http://x/y;p"),
        ("http://x/y/;p=1", "http://x/y;p=1"),
        ("http://x/a//", "http://x/a/"),
        ("http://x/a b?q=%zz%20", "http://x/a b?q=%25zz+"),
        ("http://x/?z=~*é", "http://x/?z=~%2A%C3%A9"),
        ("http://x/?b=1&a=2&a=1", "http://x/?a=1&a=2&b=1"),
        ("http://x/?a", "http://x/"),
        ("  http://x/Y  ", "http://x/Y"),
        ("", ""),
        (None, ""),
    ],
)
def test_canonical_url(column_values, raw, canonical):
    assert column_values(urls.canonical_url, [raw]) == [canonical]


def test_canonical_url_is_idempotent(column_values):
    rng = random.Random(3)
    # Without slashes: one trailing slash is removed each time.
    parts = ["a", "B", "%20", "%zz", "=", "&", "?", "+", "é", "#", "utm_term", "~", "*"]
    raw = ["HTTP://H.Example:80/x" + "".join(rng.choices(parts, k=rng.randint(0, 14))) for _ in range(300)]
    once = column_values(urls.canonical_url, raw)
    assert column_values(urls.canonical_url, once) == once


def test_repo_key(column_values):
    raw = ["https://github.com/Foo/Bar.git", "http://www.GitHub.com/a/b/tree/x", "https://example.com/a/b", None, "github.com/a/b?x#y"]
    assert column_values(urls.repo_key, raw) == ["foo/bar", "a/b", None, None, "a/b"]
    assert column_values(urls.repo_url, ["a/b", "http://x", "", None]) == ["https://github.com/a/b", "http://x", None, None]


# Two published records with the keys they were stored under (fixed values).
STORED = [
    ("job", "Idealo Internet",
     "https://www.arbeitnow.com/jobs/companies/idealo-internet-gmbh/machine-learning-ops-engineer-personalization-mwd-berlin-48646",
     "9946da2ebbb18ea1f72a7eda72cdeea08d76116d7a3493593c3d7fcee04082c0"),
    ("news", "Anthropic spent this week in hot water over cybersecurity",
     "https://www.theverge.com/ai-artificial-intelligence/994064/anthropic-spent-this-week-in-hot-water-over-cybersecurity",
     "5392551ae94fe7888c53330b5da95cf9b258410bd22c52924bc5f6e21a76f947"),
]


@pytest.mark.parametrize("scope, name, url, stored", STORED)
def test_record_key_reproduces_stored_keys(spark, scope, name, url, stored):
    df = spark.createDataFrame([(name, url)], "n string, u string")
    assert df.select(keys.record_key(scope, F.col("n"), F.col("u"))).first()[0] == stored


def test_entity_key_ignores_case_and_surrounding_space(column_values):
    a, b, c = column_values(lambda v: keys.entity_key("startup", v), ["Northwind", "  northWIND  ", "Contoso"])
    assert a == b != c
    assert column_values(lambda v: keys.entity_key("product", v), ["Northwind"]) != [a]


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("2025-02-28T23:59:59Z", "2025-02-28 23:59:59"),
        ("Mon, 03 Mar 2025 01:02:03 GMT", "2025-03-03 01:02:03"),
        ("12 Sep 2026 12:00:00 EST", "2026-09-12 17:00:00"),
        ("12 Sep 2026 12:00:00 +0200", "2026-09-12 10:00:00"),
        ("12 Sep 2026 12:00", "2026-09-12 12:00:00"),
        ("2026-09-12T14:30:00+0200", "2026-09-12 12:30:00"),
        ("2026-09-12 14:30", "2026-09-12 14:30:00"),
        ("2026-09-12", "2026-09-12 00:00:00"),
        ("Sep 12, 2026", "2026-09-12 00:00:00"),
        ("September 12, 2026", "2026-09-12 00:00:00"),
        ("May 1, 2026", "2026-05-01 00:00:00"),
        ("12 Sep 2026", "2026-09-12 00:00:00"),
        ("2026/09/12", "2026-09-12 00:00:00"),
        ("Friday, 12 September 2026 3:04 PM EST", "2026-09-12 20:04:00"),
        ("2026-09-12 3pm", "2026-09-12 15:00:00"),
        ("2026-09-12 12 a.m.", "2026-09-12 00:00:00"),
        ("12.09.2026", "2026-12-09 00:00:00"),
        ("13.09.2026", "2026-09-13 00:00:00"),
        ("9/12/2026 7:05", "2026-09-12 07:05:00"),
        ("12-Sep-2026", "2026-09-12 00:00:00"),
        ("2026 Sep 12", "2026-09-12 00:00:00"),
        ("Sep 12 2026 10:00", "2026-09-12 10:00:00"),
        ("Sept. 12th, 2026 at 10:00:01.5 GMT+2 (CEST)", "2026-09-12 08:00:01.5"),
        ("10:00 -0530, 1st of May 99", "1999-05-01 15:30:00"),
        ("Sat Sep 12 10:00:00 UTC 2026", "2026-09-12 10:00:00"),
        ("20260912", "2026-09-12 00:00:00"),
        ("20260912T101500Z", "2026-09-12 10:15:00"),
        ("202609121015", "2026-09-12 10:15:00"),
        ("12 Sep 26", "2026-09-12 00:00:00"),
        ("Sep 2026", None),
        ("12 September", None),
        ("10:30", None),
        ("30.02.2026", None),
        ("2026-09-12 13pm", None),
        ("2026-09-12 25:00", None),
        ("Sep 12 2026 10:00 11:00", None),
        ("Sep 12 2026 noonish", None),
        ("1 2 3 4", None),
        ("3 hours ago", None),
        ("12345", None),
        ("٣ Sep 2026", None),
        ("2026-13-45", None),
        ("yesterday", None),
        ("10", None),
        ("zzz", None),
        ("", None),
        (None, None),
    ],
)
def test_parse_absolute(column_values, raw, expected):
    want = expected and datetime.fromisoformat(expected)
    assert column_values(dates.parse_absolute, [raw]) == [want]


@pytest.mark.parametrize(
    "raw, seconds",
    [
        ("7 hours ago", 25200), ("20 mins ago", 1200), ("Yesterday", 86400), ("just now", 0), ("Moments ago", 0),
        ("3 weeks ago", 1814400), ("2 months ago", 60 * 86400), ("1 year ago", 365 * 86400),
        ("posted 5 days ago by x", 432000), ("an hour ago", None), ("99999999999999999999 years ago", None),
        ("999999999999 years ago", None), (None, None),
    ],
)
def test_parse_relative(column_values, raw, seconds):
    got = column_values(lambda v: dates.parse_relative(v, dates.reference(REF)), [raw])[0]
    ref = datetime.strptime(REF, "%Y-%m-%d %H:%M:%S")
    assert got is None if seconds is None else (ref - got).total_seconds() == seconds


def test_publication_time_prefers_the_feed(spark):
    df = spark.createDataFrame([("2026-09-11T21:00:00Z", "2026-09-12T03:00:00Z")], "feed string, raw string")
    best = dates.publication_time(dates.reference(REF), feed=F.col("feed"), raw=F.col("raw"))
    row = df.select(best.alias("b")).first().b
    assert (row.ts.hour, row.date_source) == (21, "feed")


def test_feed_dates_are_never_relative(spark):
    df = spark.createDataFrame([("2 hours ago",)], "feed string")
    assert df.select(dates.publication_time(dates.reference(REF), feed=F.col("feed"))).first()[0] is None


def test_epoch_or_text(column_values):
    got = column_values(lambda v: dates.epoch_or_text(v, dates.reference(REF)), ["1789200000", "1789200000.5", "2026-09-12T08:00:00Z", "3 hours ago", ""])
    assert [g and g.isoformat() for g in got] == [
        "2026-09-12T08:00:00", "2026-09-12T08:00:00.500000", "2026-09-12T08:00:00", "2026-09-12T09:00:00", None]


def test_iso_utc(column_values):
    assert column_values(dates.iso_utc, [datetime(2026, 9, 12, 8, 15, 0, 999)], "timestamp") == ["2026-09-12T08:15:00Z"]


@pytest.mark.parametrize(
    "raw, normal",
    [
        ("Northwind, Ltd.", "northwind"), ("Contoso GmbH", "contoso"), ("Blue Yonder Corp", "blue yonder"),
        ("Fabrikam Group, LLC", "fabrikam"), ("Café Société", "cafe societe"), ("Inc.", ""), ("Co Star", "star"),
        ("Foo-Tech", "foo"), ("a_b", "a_b"), ("Grafanalabs", "grafanalabs"), ("Überlabs GmbH", "uberlabs"), ("ﬁne Co", "fine"),
    ],
)
def test_normal_name(column_values, raw, normal):
    assert column_values(lambda v: names.normal_name(names.without_accents(v)), [raw]) == [normal]


def _common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        previous = 0
        for j, y in enumerate(b, 1):
            previous, row[j] = row[j], previous + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_common_letters_against_brute_force(spark):
    rng = random.Random(7)
    pairs = []
    for low, high in ((1, 12), (50, 62), (55, 75), (63, 90)):
        for _ in range(25):
            pairs.append(tuple("".join(rng.choices("abcdé ", k=rng.randint(low, high))) for _ in range(2)))
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    got = df.select("i", names.common_letters(F.col("a"), F.col("b")).alias("n")).orderBy("i").collect()
    assert [r.n for r in got] == [_common(a, b) for a, b in pairs]


def test_token_similarity(spark):
    df = spark.createDataFrame(
        [("databrickss", "Databricks"), ("databrickss", "databricks"), ("ab cd", "cd ab"), ("", "x"), ("a", "b")], "a string, b string"
    )
    forward = [r[0] for r in df.select(names.token_similarity(F.col("a"), F.col("b"))).collect()]
    backward = [r[0] for r in df.select(names.token_similarity(F.col("b"), F.col("a"))).collect()]
    assert [round(s, 1) for s in forward] == [85.7, 95.2, 100.0, 0.0, 0.0]
    assert forward == backward


def test_token_estimate(column_values):
    assert column_values(text.token_estimate, ["x" * 61, "abc", "", None]) == [15, 1, 0, 0]


def test_reduced(column_values):
    assert [len(v) for v in column_values(text.reduced, ["z" * 902, "z" * 130, "z" * 40, None])] == [451, 100, 40, 0]


def test_snippet(spark):
    long = "before it " * 80 + "Wanted-Word " + "after it " * 80
    df = spark.createDataFrame([(long,)], "t string")
    out = df.select(
        text.snippet(F.col("t"), F.lit("wanted-WORD"), 100).alias("hit"),
        text.snippet(F.col("t"), F.lit("absent"), 100).alias("miss"),
        text.snippet(F.lit(None).cast("string"), F.lit("a"), 100).alias("none"),
    ).first()
    assert "Wanted-Word" in out.hit and len(out.hit) <= 120 and out.hit.startswith("...") and out.hit.endswith("...")
    assert out.miss == long[:100].strip() and out.none == ""


def test_first_line_name(column_values):
    raw = ["  Acme \nrest", "", None, "x" * 80, "\nnext", "one two"]
    assert column_values(text.first_line_name, raw) == ["Acme", "Unknown", "Unknown", "x" * 50, "", "one"]


def test_strip_covers_all_white_space(column_values):
    blanks = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())
    assert column_values(text.strip, [blanks + "a b" + blanks]) == ["a b"]
    assert column_values(text.squeeze, [f" a{blanks}b "]) == ["a b"]
