import time
from collections import Counter, defaultdict

import pytest

from dugout.llm import line_dedup as L


def test_ratio(spark):
    pages = [(i, f"https://User@Site.example:80/p{i}", f"menu\nline {i}\nfooter" + ("\nrare" if i < 2 else "")) for i in range(20)]
    pages += [(100 + i, f"http://two.example/{i}", "menu\nown words") for i in range(2)] + [(200, "not a url", "menu"), (201, None, "menu")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r["page_id"]: r for r in L.drop_boilerplate(df, L.squeezed(L.F.split("html", "\n")), ratio=0.5).collect()}
    assert got[0]["text"] == "line 0\nrare" and got[0]["n_dropped"] == 2 and got[0]["host"] == "site.example" and got[0]["host_pages"] == 20
    assert got[5]["text"] == "line 5" and got[100]["text"] == ""          # both lines on both pages
    assert got[200]["host"] is None and got[201]["host_pages"] == 2 and got[200]["text"] == ""


def test_html(spark):
    html = ("<!DOCTYPE html><HTML><head><title>T  i</title><style>p{}</style><script>var a='<p>';</script></head><body><!-- <p>no</p> -->"
            "<p>one <b>two</b>\n three<br>four</p><p> </p>five &amp; six</body></HTML>")
    row = spark.createDataFrame([(html,)], "html string").select(L.html_lines().alias("x")).first()
    assert row["x"] == ["T i", "one two three", "four", "five &amp; six"]


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_against_plain_count(spark, scale):
    pages = spark.read.parquet(f"/root/testdata/{scale}/pages.parquet")
    rows = pages.select("page_id", L.host_of().alias("host"), L.html_lines().alias("lines")).collect()
    size, on = Counter(r["host"] for r in rows), defaultdict(int)
    for r in rows:
        for x in set(r["lines"]):
            on[r["host"], x] += 1
    keep = lambda h, x: not (on[h, x] >= L.LEAST_PAGES and on[h, x] / size[h] > L.RATIO)
    got = {r["page_id"]: r for r in L.drop_boilerplate(pages).collect()}
    assert len(got) == len(rows)
    assert all(got[r["page_id"]]["text"] == "\n".join(x for x in r["lines"] if keep(r["host"], x)) for r in rows)


def test_a_line_on_one_page_stays(spark):
    rows = [(1, "http://one/", "a\nb\na"), (2, "http://two/1", "a\nb"), (3, "http://two/2", "b\nc")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in L.drop_boilerplate(df, L.squeezed(L.F.split("html", "\n"))).collect()}
    assert got == {1: "a\nb\na", 2: "a", 3: "c"}


def test_unclosed_tags_and_long_pages_take_linear_time(spark):
    kinds = ["<" * 1_000_000, "<!-- " * 200_000, "<script>" * 125_000, "<p " * 330_000, "a > b < c " * 100_000]
    long = "\n".join(f"line {i}" for i in range(100_000))
    rows = [(i, "http://x/", h) for i, h in enumerate(kinds)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    start = time.time()
    got = {r["page_id"]: r for r in L.drop_boilerplate(df).collect()}
    assert time.time() - start < 60
    assert got[0]["text"] == "<" * 1_000_000 and got[1]["n_lines"] == 0 and got[2]["n_lines"] == 0 and got[4]["n_lines"] == 1
    pages = spark.createDataFrame([(i, "http://y/", long + f"\nown {i}") for i in range(3)], "page_id long, url string, html string")
    start = time.time()
    got = L.drop_boilerplate(pages, L.squeezed(L.F.split("html", "\n"))).collect()
    assert time.time() - start < 60
    assert [(r["n_lines"], r["n_dropped"], r["text"]) for r in sorted(got, key=lambda r: r["page_id"])] == [(100_001, 100_000, f"own {i}") for i in range(3)]


def test_odd_rows(spark):
    rows = [(None, None, None, "h")] * 4 + [(1, "http://x/", "a\n" * 50_000, "h"), (1, "http://x/", "a\n" * 50_000, "h"), (2, "http://x/", "", "h")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    got = L.drop_boilerplate(df, L.squeezed(L.F.split(L.F.coalesce("html", L.F.lit("")), "\n"))).collect()
    assert len(got) == 7 and sorted(r["n_lines"] for r in got) == [0, 0, 0, 0, 0, 50_000, 50_000]
    assert L.drop_boilerplate(df.where("page_id = 9")).collect() == []
