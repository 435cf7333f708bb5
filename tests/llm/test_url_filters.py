import time

from tidemark.llm.url_filters import RULES, judge_urls, links_in


def test_urls(spark):
    link = '<link href="{}" rel=\'canonical\'>'.format
    go = '<META content="0; URL={}" http-equiv=refresh>'.format
    rows = [
        (1, "http://A.example.org/es/x", ""), (2, "https://x.net/a", link("http://a.example.org/es/x#f")),
        (3, "https://y.net/b?q=1", go("https://x.net/a")), (4, "http://b.org/", "<link rel=stylesheet href=/es/>"),
        (5, "http://z.net/c", link("/d")), (6, "http://z.net/d", go("//b.org")), (7, "http://z.net/d#top", None),
        (8, "http://z.net", link("http://example.org/en/12")), (9, "http://w.net/", link("http://z.net")),
        (10, None, link("http://z.net")), (11, "no scheme", ""), (12, "http://m.example.com/de/1", ""),
        (13, "http://com/fr/de/", ""), (14, "http://xcom/fr/", ""), (15, "ftp://example.org/en/1?x#y", ""),
        (16, "http://u.net/p", go("http://v.net/") + link("http://q.org/")), (17, "http://v.net/", link("http://c.com/de/")),
        (18, "://", ""), (19, "http://HOST.Ä/é", ""), (20, "a://b.org?x/", ""), (1, "http://A.example.org/es/x", ""),
        (None, "http://t.net/", link("http://t.net/")), (21, "http://hub.net/", "")]
    rows += [(100 + i, f"http://h{i}.net/", link("http://hub.net/")) for i in range(50)]
    rows += [(200, "http://r.com/de/", go("http://h7.net/"))]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, host string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judge_urls(df.repartition(4)).collect()}
    assert judge_urls(df).count() == len(rows)
    assert got[1] == ("a.example.org", "/es/x", "example.org/es/", "block")
    assert got[2] == ("x.net", "/a", None, "block") and got[3][3] == "block"
    assert got[4] == ("b.org", "/", "org/", "allow")
    assert [got[i][3] for i in (5, 6, 7)] == ["allow"] * 3
    assert got[8] == ("z.net", "", None, "block") and got[9][3] == "block"
    assert got[10] == ("", "", None, "allow") and got[11] == ("", "", None, "allow")
    assert got[12][2:] == ("com/de/", "block") and got[13][2:] == ("com/fr/", "allow")
    assert got[14][2:] == (None, "allow") and got[15][2:] == ("example.org/en/1", "block")
    assert got[16][3] == got[17][3] == "allow"  # an allowed alias outweighs a blocked one
    assert got[18] == ("", "", None, "allow") and got[19][:2] == ("host.Ä", "/é")
    assert got[20] == ("b.org", "", None, "allow") and got[None][3] == "allow"
    assert {got[100 + i][3] for i in range(50)} == {"block"} and got[21][3] == "block"
    more = spark.createDataFrame([("http://hub.net/", "http://o.org/")], "source string, target string")
    assert {r.page_id: r.verdict for r in judge_urls(df, RULES, more).collect()}[21] == "allow"
    assert judge_urls(df.where("false")).count() == 0


def test_relative_links_and_ampersands(spark):
    link = "<link rel=canonical href='{}'>".format
    rows = [(1, "http://a.net/x/y.html", "p.html"), (2, "http://a.net/x/y.html?n=1", "?id=7&amp;k=2"),
            (3, "http://a.net/x/y/z", "../../q/./r/.."), (4, "http://a.net", "s"), (5, "http://a.net/x/", "/go?u=http://b.net/"),
            (6, "http://a.net/x/", "mailto:me@b.net"), (7, "http://a.net/x/", "#top"), (8, "http://a.net/x", "../../../t"),
            (9, "http://a.net/x/", "https://B.net/c?d&amp;e#f"), (10, "http://a.net/x/", "//b.net")]
    df = spark.createDataFrame([(i, u, link(t)) for i, u, t in rows], "page_id long, url string, html string")
    got = {(r.source, r.target) for r in links_in(df).collect()}
    assert got == {
        ("a.net/x/y.html", "a.net/x/p.html"), ("a.net/x/y.html?n=1", "a.net/x/y.html?id=7&k=2"),
        ("a.net/x/y/z", "a.net/q/"), ("a.net/", "a.net/s"), ("a.net/x/", "a.net/go?u=http://b.net/"),
        ("a.net/x", "a.net/t"), ("a.net/x/", "b.net/c?d&e"), ("a.net/x/", "b.net/")}
    blocked = spark.createDataFrame([(1, "http://u.com/de/1?a&b", ""), (2, "http://u.com/x/1", link("../de/1?a&amp;b")),
                                     (3, "http://u.com/x/2", link("1"))], "page_id long, url string, html string")
    assert {r.verdict for r in judge_urls(blocked).collect()} == {"block"}


def test_long_pages(spark):
    """5 MB of unclosed tags, of one tag, and of closed ones: a page is read once."""
    tail = "<link rel=canonical href=/there>"
    pages = [("<link rel=canonical " * 250_000), "<meta " + "x=1 " * 1_250_000 + ">",
             "<link rel=stylesheet href=a>" * 180_000, "<meta http-equiv=refresh content='" * 150_000]
    df = spark.createDataFrame([(i, f"http://a{i}.net/", h + ">" + tail) for i, h in enumerate(pages)],
                               "page_id long, url string, html string")
    start = time.time()
    got = sorted((r.source, r.target) for r in links_in(df).collect())
    assert got == [(f"a{i}.net/", f"a{i}.net/there") for i in range(4)]
    assert time.time() - start < 60
