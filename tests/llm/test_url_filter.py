from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from barline.llm.url_filter import Bloom, build_cascade, filter_urls

RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"),
         ("block", "bad.org", ""), ("allow", "bad.org", "/ok"), ("block", "tie.org", "/"), ("allow", "tie.org", "/")]
URLS = ["http://www.example.com/en/1", "https://EXAMPLE.com/en/", "http://a.b.example.com/en/x?y", "http://example.com/e", "http://com",
        "http://com/", "http://x.net/es/1", "http://xnet/es/1", "http://bad.org", "http://bad.org#x", "http://s.bad.org/ok1",
        "http://notbad.org/", "http://tie.org/", None, "", "no scheme", "://", "http://", "http:///path", "http://a..com/en/", "x://h/p://q",
        "http://user@example.com:80/en/", "http://Ünet.net/es/é", "http://" + "a." * 500 + "com/" + "p" * 50_000]


def judge(url, rules):
    at = (url or "").find("://")
    rest = url[at + 3:] if at >= 0 else ""
    cut = min([i for c in "/?#" if (i := rest.find(c)) >= 0] or [len(rest)])
    host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
    tail = rest[cut:]
    path = tail[:min([i for c in "?#" if (i := tail.find(c)) >= 0] or [len(tail)])]
    fits = [(len(h + p), len(h), v == "block", h + p, v) for v, h, p in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[3:] if fits else (None, "allow")))


@pytest.mark.parametrize("most_bytes", [1 << 28, 2])
def test_equals_brute_force(spark, most_bytes):
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(URLS + URLS)], "page_id long, url string, verdict string")
    rules = spark.createDataFrame(RULES + [("block", "", "/"), ("allow", None, "/"), ("allow", "a", None)], "verdict string, host string, path string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in filter_urls(pages, rules, most_bytes=most_bytes).collect()}
    assert got == {i: judge(u, RULES) for i, u in enumerate(URLS + URLS)}


def test_cascade_is_exact_over_the_universe(spark):
    n = 20_000
    keys = spark.range(n).select(F.concat(F.lit("k"), "id").alias("key")).withColumns(
        {"h1": F.xxhash64("key"), "h2": F.xxhash64("key", F.lit(1))})
    listed = keys.where(F.substring("key", -1, 1) == "7")
    cascade = build_cascade(listed, keys.union(keys), share=0.2)
    rows = keys.toPandas()
    h1, h2 = (rows[c].to_numpy(np.int64).view(np.uint64) for c in ("h1", "h2"))
    assert (cascade.lists(h1, h2) == rows["key"].str.endswith("7").to_numpy()).all()
    assert len(cascade.levels) > 2


def test_empty(spark):
    none = spark.createDataFrame([], "verdict string, host string, path string")
    pages = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    assert filter_urls(pages, none).first()["verdict"] == "allow"
    assert filter_urls(pages.limit(0), spark.createDataFrame(RULES, none.schema)).count() == 0
    assert not Bloom.of(0, 0.5).holds(np.ones(3, np.uint64), np.ones(3, np.uint64), 0).any()
