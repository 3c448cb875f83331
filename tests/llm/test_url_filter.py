import duckdb

from mercato.llm.url_filter import judge_urls
from mercato.llm.url_queries import ENTRIES, URL_SQL, url_filter

URLS = [
    "http://example.org/es/1", "https://EXAMPLE.ORG/es/", "http://example.org/es", "http://a.example.org/en/17?x=/es/",
    "http://example.org/en/2", "http://badexample.org/es/1", "http://x.com/fr/", "http://x.com/de/#/fr/", "http://com/de/x",
    "http://x.com/DE/", "http://org", "http://org/", "ftp://a.b.net/x", "no scheme.org/", "", None, "://", "http:///es/",
    "http://example.org?a=://b.com/de/", "x://y://z.com/fr/", "http://example.org:80/es/1", "http://.org/", "http://a..org/x"]


def pages(spark, urls):
    return spark.createDataFrame([(i, u, "h", "r", "v") for i, u in enumerate(urls)],
                                 "page_id long, url string, host string, rule string, verdict string")


def rows(df):
    return sorted((tuple(r) for r in df.select("page_id", "host", "path", "rule", "verdict").collect()), key=repr)


def test_trie_and_join_agree_with_sql(spark):
    table = pages(spark, URLS + URLS[:3])
    con = duckdb.connect()
    con.register("frame", table.select("page_id", "url").toPandas())
    con.execute("CREATE VIEW pages AS SELECT * FROM frame")
    want = sorted(con.execute(URL_SQL).fetchall(), key=repr)
    assert rows(judge_urls(table, ENTRIES)) == want
    assert rows(judge_urls(table, ENTRIES, most_bytes=0)) == want


def test_query_covers_every_page(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{sf_dir}/pages.parquet'")
    assert rows(url_filter(spark, sf_dir)) == sorted(con.execute(URL_SQL).fetchall(), key=repr)


def test_longer_hosts_first_and_blocking_wins_ties(spark):
    entries = [("com/very/long/path/", "block"), ("a.com/", "allow"), ("b.com/x", "allow"), ("b.com/x", "block"), ("c.com", "block")]
    table = pages(spark, ["http://a.com/very/long/path/", "http://b.com/xyz", "http://c.com", "http://d.com/very/long/path/1"])
    for most in (1 << 20, 0):
        got = [(r[3], r[4]) for r in rows(judge_urls(table, entries, most_bytes=most))]
        assert got == [("a.com/", "allow"), ("b.com/x", "block"), ("c.com", "block"), ("com/very/long/path/", "block")]


def test_no_entries_and_no_rows(spark):
    table = pages(spark, ["http://a.com/"])
    assert rows(judge_urls(table, [], default="block")) == [(0, "a.com", "/", None, "block")]
    listed = spark.createDataFrame([], "entry string, verdict string")
    assert rows(judge_urls(table, listed)) == [(0, "a.com", "/", None, "allow")]
    assert judge_urls(table.limit(0), ENTRIES).count() == 0
    assert rows(judge_urls(spark.createDataFrame([(None, "http://x.com/de/")], "page_id long, url string"), ENTRIES))[0][4] == "block"
