"""URL verdicts against a plain reading of the rules."""

import re

import duckdb
import pytest

from quayside.llm import queries, url_filter

URLS = [
    None, "", "no scheme", "://", "http://", "HTTP://EXAMPLE.org/es/a?x=1", "https://a.example.org/en/12#f", "http://example.org/en/2", "http://notexample.org/es/",
    "http://x.com/de/1", "http://x.com/fr/de/", "http://x.com?u=/de/", "http://org/", "http://org", "http://x.net/casino", "http://x.net/casinos", "http://free-bets.x.net/",
    "http://x.net/free/free", "http://adult-x.net/", "http://x.net/a\nb://c", "http://É.NET/ß", "http://x.net/" + "free" * 5000, "http://x.net/win_free", "http://xfree.net/win1",
    "http://clinic.net/adult-vaccines", "http://clinic.net/adult/dating",
]


def plain(url):
    """Host, path and rule by hand; hits by regular expressions."""
    url = url or ""
    rest = url.split("://", 1)[1] if "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in queries.URL_RULES if (lower == r.host or lower.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.name), default=None)
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in url)
    words = [t for t in {*url_filter.STRICT_TERMS, *url_filter.SOFT_TERMS} if re.search(rf"(?<![A-Za-z0-9]){t}(?![A-Za-z0-9])", text)]
    weak = [t for t in words if t in url_filter.SOFT_TERMS]
    bad = len(words) > len(weak) or (len(weak) >= 2 and sum(url_filter.SOFT_TERMS[t] for t in weak) >= 2)
    return lower, path, best.name if best else None, best.verdict if best else "block" if bad else "allow"


def test_against_plain_reading(spark):
    rows = [(i if i else None, u, "x", "y") for i, u in enumerate([*URLS, *URLS[:4]])]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, rule string")
    got = url_filter.judge_urls(pages, queries.URL_RULES).collect()
    want = sorted(((k, *plain(u)) for k, u, *_ in rows), key=repr)
    assert sorted(((r.page_id, r.host, r.path, r.rule, r.verdict) for r in got), key=repr) == want


def test_sql_twin_on_odd_urls(spark, tmp_path):
    rows = [(i if i else None, u) for i, u in enumerate([*URLS, *URLS[:4]])]
    folder = tmp_path / "pages.parquet"
    spark.createDataFrame(rows, "page_id long, url string").write.parquet(str(folder))
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW pages AS SELECT * FROM '{folder}/*.parquet'")
    twin = connection.execute(queries.SQL["op4_url_filter"])
    names = [c[0] for c in twin.description]
    got = queries.op4_url_filter(spark, str(tmp_path))
    assert got.columns == names
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(twin.fetchall(), key=repr)


def test_empty_and_limits(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert url_filter.judge_urls(pages, queries.URL_RULES).collect() == []
    with pytest.raises(ValueError):
        url_filter.judge_urls(pages, [url_filter.Rule("allow", "x", "/")] * (url_filter.MAX_RULES + 1))


def test_boundaries_and_overlaps():
    terms = ("bet", "bets", "free")
    assert set(url_filter.terms_in("bets/bet.free1-free", terms)) == {"bets", "bet", "free"}
    assert set(url_filter.terms_in("abet betsy free9", terms)) == set()
