"""Literal cases of the column expressions, one Spark job per table of cases."""

import datetime

from pyspark.sql import functions as F

from mentionflow.functions import dates as D
from mentionflow.functions import url as U
from mentionflow.functions.classify import activity
from mentionflow.operators import urlfilter

AS_OF = datetime.date(2026, 8, 10)


def column(spark, values, expr, schema="v string"):
    rows = [(i, *(v if isinstance(v, tuple) else (v,))) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, {schema}")
    return [r[0] for r in df.select(expr.alias("x"), "i").orderBy("i").select("x").collect()]


def test_relative_days(spark):
    cases = {"today": 0, "Yesterday": 1, "3 days ago": 3, "1 day ago": 1, "5 hours ago": 0, "12 minutes ago": 0, "2 weeks ago": 14, "a month ago": 30, "a week ago": 7, "3 years ago": 1095, " just now ": 0,
             "Conference 2026": None, "a day ago": None, "an hour ago": None, "": None, None: None, "3 days ago\n": 3}
    assert column(spark, list(cases), D.relative_days("v")) == list(cases.values())


def test_absolute_date(spark):
    d = datetime.date
    cases = {
        "Aug 5, 2026": d(2026, 8, 5), "August 05, 2026": d(2026, 8, 5), "2026-08-05": d(2026, 8, 5), "2026/8/5": d(2026, 8, 5), "8/5/2026": d(2026, 8, 5), "08-05-2026": d(2026, 8, 5), "5 Aug 2026": d(2026, 8, 5),
        "5 august 2026": d(2026, 8, 5), "Sept 5, 2026": d(2026, 9, 5), "20260805": d(2026, 8, 5), "2026": d(2026, 1, 1), "2026-08": d(2026, 8, 1), "2026-08-05T10:00:00Z": d(2026, 8, 5), "2026-08-05T23:30:00.123-02:00": d(2026, 8, 6),
        "2026-08-05T00:30+0200": d(2026, 8, 4), "Wed, 05 Aug 2026 08:00:00 GMT": d(2026, 8, 5), "press release": None, "2026-02-30": None, "12:30": None, "": None, None: None,
    }
    assert column(spark, list(cases), D.absolute_date("v")) == list(cases.values())


def test_final_date_policy(spark):
    keep = D.date_decision("v", "a", AS_OF, 7)["keep"]
    cases = [(("", "Conference"), True), (("", "Pubs"), True), (("", "Trials"), True), (("", "Press"), False), (("", "SMA"), False), ((None, "Other"), False), (("2026-11-10", "Conference"), True),
             (("2028-08-10", "Conference"), False), (("2026-10-10", "Pubs"), False), (("2026-08-20", "Press"), False), (("2026-08-03", "Press"), True), (("2026-08-02", "Press"), False), (("junk", "Press"), False),
             (("junk", "Trials"), True), (("8 days ago", "Conference"), False), (("7 days ago", "Press"), True), (("2026-08-10", None), True)]
    assert column(spark, [c for c, _ in cases], keep, "v string, a string") == [k for _, k in cases]


def test_candidates_keep_what_is_not_definitely_old(spark):
    cases = [(("", "Press"), True), (("junk", "Press"), True), (("2020-01-01", "Press"), False), (("2026-12-01", "Conference"), True), (("2026-12-01", "Press"), False), (("30 days ago", "Pubs"), False)]
    assert column(spark, [c for c, _ in cases], D.is_candidate("v", "a", AS_OF, 7), "v string, a string") == [k for _, k in cases]


def test_platform_and_source(spark):
    cases = {"https://x.com/a": "X", "https://twitter.com": "X", "https://www.linkedin.com/in/a": "LinkedIn", "https://youtu.be/1": "YouTube", "https://mobile.x.com": "X", "https://m.facebook.com/p": "Facebook",
             "https://www.genedx.com": "Website", "https://xerox.com": "Website", "https://notx.com": "Website", "": "Website", "not a url": "Website", None: "Website", "HTTPS://BSKY.app/": "Bluesky"}
    assert column(spark, list(cases), U.platform("v")) == list(cases.values())
    hosts = {"https://www.a.org:8080/x": "www.a.org", "http://user@B.com?q": "b.com", "x": "", "https://a b.com/": ""}
    assert column(spark, list(hosts), U.source("v")) == list(hosts.values())


def test_normalized_url(spark):
    cases = {
        "https://ex.com/a/?utm_source=x&id=1": "https://ex.com/a?id=1", " HTTPS://Ex.COM:443/A//#top ": "https://ex.com/A#top", "http://ex.com:80": "http://ex.com/", "http://ex.com:8080/?": "http://ex.com:8080/",
        "https://ex.com/?a&b=1%202&ref=z&Ref=z": "https://ex.com/?a=&b=1+2&Ref=z", "nope": "", "": "", None: "",
        "https://ex.com/a/./b/%2e%2E/c d/é🎉/..": "https://ex.com/a/c%20d", "https://ex.com/../x/..": "https://ex.com/", "https://ex.com/<a>#é `": "https://ex.com/%3Ca%3E#%C3%A9%20%60", "https://ex.com/a\nb\tc": "https://ex.com/abc",
        "https://ex.com/?q=a/b~*&é=ü+x%zz&%72ef=1&=2": "https://ex.com/?q=a%2Fb%7E*&%C3%A9=%C3%BC+x%25zz&=2", "https://ex.com/...?x=%2B": "https://ex.com/...?x=%2B",
    }
    got = column(spark, list(cases), U.normalized("v"))
    assert got == list(cases.values())
    again = column(spark, got, U.normalized("v"))
    assert again == got


def test_blocked_and_junk(spark):
    keep = {"https://www.webmd.com/multiple-sclerosis/x": True, "https://www.genedx.com": True, "https://www.healthgrades.com/x": False, "https://es.doximity.com": False, "https://www.webmd.com/Doctor/a": False, "https://md.com": False,
            "https://a.com/x.PDF": False, "https://a.com/x.pdf?b=1": False, "https://a.com/x.pdf#p": True, "https://webcache.a.com/": False, "https://www.google.com/search?q=a": False, "bad": False}
    df = spark.createDataFrame([(u,) for u in keep], "url string")
    assert {r.url for r in urlfilter.usable(df).collect()} == {u for u, k in keep.items() if k}


def test_first_by_normal_url_whatever_the_partitioning(spark):
    rows = [("e", f"https://a.com/{i % 5}/?ref={i}", 1, i, 0) for i in range(40)]
    df = urlfilter.usable(spark.createDataFrame(rows, "e string, url string, cluster_no int, item_pos int, result_pos int"))
    one, seven = (sorted(map(tuple, urlfilter.first_by_normal_url(df.repartition(n), ["e"]).collect())) for n in (1, 7))
    assert one == seven and [r[4] for r in sorted(one, key=lambda r: r[4])] == [0, 1, 2, 3, 4]
    again = urlfilter.first_by_normal_url(urlfilter.first_by_normal_url(df, ["e"]), ["e"])
    assert again.count() == 5


def test_social_author(spark):
    cases = [(("https://x.com/a", "Cassie Shields | And that's a wrap", "X"), "Cassie Shields"), (("https://www.instagram.com/p/1", '"AACP on Instagram: hi', "Instagram"), "AACP"),
             (("https://www.facebook.com/autismsciencefd/posts/1", "A title", "Facebook"), "autismsciencefd"), (("https://a.org", "Jane Roe | x", "Website"), ""), (("https://www.facebook.com/watch/1", "Facebook Watch | video", "Facebook"), ""),
             ((None, None, "X"), "")]
    got = column(spark, [c for c, _ in cases], U.social_author("u", "t", F.col("p")), "u string, t string, p string")
    assert got == [a for _, a in cases]


def test_activity(spark):
    cases = [
        (("https://x.com/a", "Poster", "", "X"), "SMA"), (("https://clinicaltrials.gov/1", "", "", "Website"), "Trials"), (("https://a.org", "See NCT01234567.", "", "Website"), "Trials"), (("https://a.org", "xNCT01234567", "", "Website"), "Other"),
        (("https://www.nature.com/articles/1", "A paper", "", "Website"), "Pubs"), (("https://a.org/doi/1", "Poster 5", "", "Website"), "Conference"), (("https://nature.com/supplement/1", "", "", "Website"), "Conference"),
        (("https://a.org/", "Grand Rounds today", "", "Website"), "Conference"), (("https://a.org/events/1", "", "", "Website"), "Conference"), (("https://a.org/", "P4.2-066 x", "", "Website"), "Conference"), (("https://a.org/", "He said", "so", "Website"), "Press"),
        (("https://a.org/news", "", "", "Website"), "Press"), (("https://a.org/", "époster unsaid", "", "Website"), "Conference"), (("https://a.org/", "unsaid", None, "Website"), "Other"), ((None, None, None, "Website"), "Other"),
    ]
    got = column(spark, [c for c, _ in cases], activity("u", "t", "d", F.col("p")), "u string, t string, d string, p string")
    assert got == [a for _, a in cases]
