import random
import re

import duckdb

from conftest import TABLES
from sojourn.llm.queries import ORACLES, QUERIES, URL_RULES
from sojourn.llm.url_filter import HostRule, WildcardAutomaton, judge_urls


def pattern(glob):
    out = re.escape(glob).replace(r"\*\*", "(?s:.*)").replace(r"\*", "[^/]*").replace(r"\?", "[^/]")
    return re.compile(out)


def test_same_matches_as_regular_expressions():
    rnd = random.Random(2)
    make = lambda letters, n: "".join(rnd.choice(letters) for _ in range(rnd.randint(0, n)))
    globs = [make(["a", "b", "/", "*", "**", "?", "."], 6) for _ in range(60)] + ["", "**", "*", "a" * 70 + "**"]
    texts = [make("ab/.", 10) for _ in range(300)] + ["", "a" * 70, "/".join(["a" * 5] * 4)]
    got = WildcardAutomaton(globs).match(texts)
    want = [[bool(pattern(g).fullmatch(t)) for g in globs] for t in texts]
    assert got.tolist() == want


def test_a_very_long_text():
    long = "a" * 30_000 + "/b"
    assert WildcardAutomaton(["**/b", "*/b", "*/c", "a*b"]).match([long, "x/b"]).tolist() == [[True, True, False, False], [True, True, False, False]]


def judged(spark, urls, **more):
    frame = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    return [tuple(r)[1:] for r in sorted(judge_urls(frame, URL_RULES, **more).collect())]


def test_hosts_paths_and_the_longest_rule(spark):
    got = judged(
        spark,
        [
            "https://WWW.Example.com/en/x?q#f", "http://a.example.com/en/1", "http://example.com/EN/1", "http://x.net/es/", "http://x.net/es",
            "http://com/", "http://xcom/", "http://com", "http://evil.org/x.com/", "ftp://a.org/ads/1", "no scheme", "", "http://a.com:80/",
            "http://é.net/fr/ü", "http://a.b/c://d.com/", "http://a.com\n/x",
        ],
    )
    assert got == [
        ("www.example.com", "/en/x", "www.example.com/en/", "allow"),
        ("a.example.com", "/en/1", "example.com/en/", "block"),
        ("example.com", "/EN/1", "com/", "allow"),
        ("x.net", "/es/", "net/es/", "block"),
        ("x.net", "/es", None, "allow"),
        ("com", "/", "com/", "allow"),
        ("xcom", "/", None, "allow"),
        ("com", "", None, "allow"),
        ("evil.org", "/x.com/", None, "allow"),
        ("a.org", "/ads/1", None, "block"),
        ("", "", None, "allow"),
        ("", "", None, "allow"),
        ("a.com:80", "/", None, "allow"),
        ("é.net", "/fr/ü", "net/fr/", "block"),
        ("a.b", "/c://d.com/", None, "allow"),
        ("a.com\n", "/x", None, "allow"),
    ]


def test_the_sql_says_the_same_of_odd_urls(spark):
    con = duckdb.connect()
    rnd = random.Random(8)
    parts = ["http://", "://", "www.", "example.com", "a.net", "ads.", "/en/", "/es/", "/fr", "/", "?", "#", "x.JPG", ".jpg", "cart", "\n", "Ü", ".com"]
    urls = [None, ""] + ["".join(rnd.choice(parts) for _ in range(rnd.randint(1, 7))) for _ in range(3000)]
    frame = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    pages = frame.toPandas()  # noqa: F841
    con.register("pages", pages)
    want = {tuple(r) for r in con.execute(ORACLES["op7_url_filter"]).fetchall()}
    assert {tuple(r) for r in judge_urls(frame, URL_RULES).collect()} == want


def test_odd_tables(spark):
    schema = "page_id long, url string, host string, rule string, v string"
    rows = [(None, "http://a.com/", "h", "r", "v"), (1, None, "", "", ""), (1, None, "", "", ""), (2, "http://" + "a/" * 30_000, "", "", "")]
    got = judge_urls(spark.createDataFrame(rows, schema), [HostRule("block", "a", "/a/a")]).collect()
    assert sorted((r.page_id or 0, r.host, r.verdict) for r in got) == [(0, "a.com", "allow"), (1, "", "allow"), (1, "", "allow"), (2, "a", "block")]
    assert judge_urls(spark.createDataFrame([], schema), URL_RULES).collect() == []
    assert QUERIES["op7_url_filter"](spark, TABLES).count() == spark.read.parquet(f"{TABLES}/pages.parquet").count()
