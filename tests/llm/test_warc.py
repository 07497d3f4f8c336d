from __future__ import annotations

import gzip
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from barline.llm import warc

ROWS = [(3, "http://B.example.com/x?q", "<p>é</p>"), (1, "http://a.example.com/", "same"), (9, "http://c.org", "same"),
        (2, None, None), (4, "http://a.example.com/", ""), (9, "http://c.org", "same"), (None, "http://n.org", "same"),
        (5, "http://x.org/a\r\nb: c", "long " * 100_000)] + [(100 + i, "http://hot.org/", f"v{i % 7}") for i in range(600)]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*r, "x") for r in ROWS], "page_id long, url string, html string, key string")


def expected(rows):
    out, first = Counter(), {}
    for i, _, h in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        body = (h or "").encode()
        digest = warc.base32_sha1(body)
        if digest in first:
            out[i, len(body), digest, "revisit", first[digest]] += 1
        else:
            first[digest] = i
            out[i, len(body), digest, "response", None] += 1
    return out


def test_round_trip(pages):
    got = warc.archived(pages).collect()
    assert Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got) == expected(ROWS)


def test_look_up_reads_payloads(spark, pages, tmp_path, monkeypatch):
    manifest = warc.write_archives(pages, f"file://{tmp_path}/warc")
    asked = spark.createDataFrame([("com,example,b)/x?q", 3), ("org,hot)/", None), ("org,nothing)/", None), ("org,hot)/", 105)], "key string, page_id long")
    got = warc.look_up(asked, manifest).collect()
    assert len(got) == 602
    one = next(r for r in got if r["page_id"] == 3)
    assert bytes(one["payload"]) == "<p>é</p>".encode() and one["url"] == "http://B.example.com/x?q"
    assert sum(r["page_id"] == 105 for r in got) == 2
    assert all(bytes(r["payload"]).decode().startswith("v") for r in got if r["key"] == "org,hot)/" and r["record_type"] == "response")
    assert warc.look_up(asked.limit(0), manifest).count() == 0
    # archives are plain WARC: a reader may go through all members
    records = 0
    for row in manifest.collect():
        data = gzip.open(row["archive"].removeprefix("file://")).read()
        records += data.count(b"WARC/1.1\r\n") - 1
        assert b"\r\nb: c" not in data
    assert records == len(ROWS)


def test_small_payloads_are_all_responses(pages):
    manifest = warc.write_archives(pages.where("page_id is not null"), min_payload=5)
    keys = pages.where("page_id is not null").select(warc.surt(F.col("url")).alias("key"), "page_id").distinct()
    assert {r["record_type"] for r in warc.look_up(keys, manifest).collect()} == {"response"}


def test_empty(spark, pages):
    assert warc.archived(pages.limit(0)).count() == 0


@pytest.mark.parametrize("how", ["repartition", "join", "hash"])
def test_revisits_when_the_pages_come_out_of_a_shuffle(spark, how):
    """Each pass over a shuffled input may coalesce it differently."""
    rows = [(2**60 + i, f"http://h{i % 50}.org/{i}", f"v{i % 300}" * 50) for i in range(900)] + [(2**60, "http://h0.org/0", "v0" * 50)] * 3 + [(None, "http://n.org", "v1" * 50)]
    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k", "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
                "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        pages = spark.createDataFrame(rows, "page_id long, url string, html string")
        if how == "repartition":
            pages = pages.repartition("page_id")
        elif how == "join":
            pages = pages.hint("merge").join(spark.range(50).selectExpr("concat('v', id % 300) as v", "id"), F.expr("substring(html, 1, 3) = v"), "left").drop("v", "id")
        else:
            pages = pages.repartition(7, F.rand(3))
        got = warc.archived(pages).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got) == expected(rows)


def test_pages_that_change_between_passes_raise(spark):
    drawn = F.udf(lambda: str(random.SystemRandom().randrange(40))).asNondeterministic()
    pages = spark.range(400).select(F.col("id").alias("page_id"), F.lit("http://a.org").alias("url"), drawn().alias("html"))
    with pytest.raises(Exception, match="in one pass over the pages and not in another"):
        warc.write_archives(pages).count()
