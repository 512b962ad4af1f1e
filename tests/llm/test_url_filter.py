import duckdb
import pytest

from tidewatch.llm.url_filter import OP2_SQL, RULES, judge_urls, rule_table

URLS = [
    "http://a.net/x", "https://Example.NET/en/1", "http://www.example.net/en", "http://example.net/en/?q#f",
    "http://example.com/de/", "http://shop.EXAMPLE.com/de/x?y", "http://notexample.com/de/", "http://x.org/fr/",
    "ftp://net/", "http://net", "no scheme", "", None, "://", "http://a.net?x=/", "http://a.net#/", "http://.net/",
    "http://net./x", "http://x.net:80/x", "http://" + "a." * 300 + "net/" + "p/" * 500, "http://É.org/fr/é", "http://x.org//fr/",
    "http://example.net/en/http://a.com/", "http://user@example.com/de/x", "http://x.org/FR/",
]


def brute(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:].split("#")[0].split("?")[0]
    fits = [
        (len(h + p), len(h), v, h + p)
        for v, h, p in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fits, default=None)
    return host, path, best and best[3], best[2] if best else default


@pytest.mark.parametrize("rules", [RULES, (*RULES, ("allow", "net", "/"), ("block", "org", "/f"), ("allow", "www.example.net", ""))])
def test_against_brute_force(spark, rules):
    rows = [(k, u, "extra", "mine") for k, u in enumerate(URLS)] + [(0, URLS[0], None, None), (None, URLS[1], None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, rule_host string, verdict string")
    got = judge_urls(pages, rule_table(spark, rules)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == brute(r.url, rules), r.url


def test_rule_list_without_rules(spark):
    pages = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    rows = judge_urls(pages, rule_table(spark, RULES).where("false"), default="block").collect()
    assert [(r.rule, r.verdict) for r in rows] == [(None, "block")]
    assert judge_urls(pages.where("false"), rule_table(spark, RULES)).count() == 0


def test_sql_agrees_with_brute_force():
    con = duckdb.connect()
    con.execute("create table pages (page_id bigint, url varchar)")
    con.executemany("insert into pages values (?, ?)", list(enumerate(URLS)))
    for page_id, host, path, rule, verdict in con.sql(
        f"select page_id, host, path, rule, verdict from ({OP2_SQL})"
    ).fetchall():
        assert (host, path, rule, verdict) == brute(URLS[page_id], RULES)
