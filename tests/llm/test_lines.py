from __future__ import annotations

from collections import Counter, defaultdict

from pyspark.sql import functions as F

from talentsift.llm.lines import drop_boilerplate, host_of, page_text


def brute(rows, ratio, least):
    pages, counts = Counter(h or "" for _, h, _ in rows), defaultdict(Counter)
    for _, host, text in rows:
        counts[host or ""].update({x.strip(" ") for x in (text or "").split("\n")} - {""} if text is not None else set())
    out = []
    for page, host, text in rows:
        h = host or ""
        lines = [] if text is None else text.split("\n")
        kept = [x for x in lines if not (x.strip(" ") and counts[h][x.strip(" ")] >= least and counts[h][x.strip(" ")] > pages[h] * ratio)]
        out.append((page, host, None if text is None else "\n".join(kept), len(lines), len(lines) - len(kept)))
    return Counter(out)


def test_a_hot_host_ties_nulls_and_repeats_match_brute_force(spark):
    rows = [(i, "hot", f"menu\nbody {i}\n menu \n\nhalf {i % 2}") for i in range(200)]
    rows += [(1000 + i, f"h{i % 3}", f"menu\nshared\nown {i}" if i % 4 else f"shared \nown {i}") for i in range(30)]
    rows += [(2000, None, "menu\nx"), (2001, "h0", None), (2002, "h0", ""), (2003, "h0", "y " * 50_000), *[(3000, "same", "copy\ncopy")] * 12]
    # A line on exactly the ratio of the pages stays.
    rows += [(4000 + i, "edge", "edge line" if i < 5 else f"e{i}") for i in range(50)]
    frame = spark.createDataFrame(rows, "page_id bigint, host string, text string")
    frame = frame.selectExpr("*", "'a' as _host", "'b' as n_lines", "'c' as _salt", "'d' as line", "1 as row", "2 as site", "3 as part", "4 as drop", "5 as lines")
    out = drop_boilerplate(frame)
    assert {"_salt", "line", "row", "drop", "site"} <= set(out.columns)
    found = Counter(tuple(r) for r in out.select("page_id", "host", "text", "n_lines", "n_dropped").collect())
    assert found == brute(rows, 0.1, 5)


def test_empty_table(spark):
    assert drop_boilerplate(spark.createDataFrame([], "page_id bigint, host string, text string")).count() == 0


def test_page_text_and_host(spark):
    html = "<html><head><style>p{}</style></head><body><p class='x'>One <b>two</b><br/>three</p><!-- no --><script>var t='<p>';</script><pre>4</pre></body></html>"
    row = spark.createDataFrame([(html, "HTTPS://Shop.Example:80/a?b")], "h string, u string").select(page_text(F.col("h")), host_of(F.col("u"))).first()
    assert [x for x in row[0].split("\n") if x] == ["One two", "three", "4"] and row[1] == "shop.example"
