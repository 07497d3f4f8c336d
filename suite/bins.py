"""Queries: ranks, equal-count bins, calibration."""

from __future__ import annotations

from pyspark.sql import functions as F

from barline.functions.order_stats import rank_first
from barline.operators import binning as b
from suite.base import lines, query, r6, rq, scored_docs, table


def _part_rows(spark, sf):
    """Parts with scores that many rows share."""
    return table(spark, sf, "part").select("p_partkey", F.col("p_size").cast("double").alias("p"),
                                           F.col("p_retailprice").alias("y"))


@query("W5_rank_first", "", """
    SELECT p_partkey, row_number() OVER (ORDER BY p_size, p_partkey) AS rank FROM part""")
def ranks(spark, sf):
    return rank_first(_part_rows(spark, sf), "p", "p_partkey").select("p_partkey", "rank")


@query("W5_rank_first_lines", "", """
    WITH g AS (SELECT l_partkey, sum(l_quantity) AS q FROM lineitem GROUP BY l_partkey)
    SELECT l_partkey, row_number() OVER (ORDER BY q, l_partkey) AS rank FROM g""")
def ranks_lines(spark, sf):
    sums = lines(spark, sf).groupBy("l_partkey").agg(F.sum("l_quantity").alias("q"))
    return rank_first(sums, "q", "l_partkey").select("l_partkey", "rank")


@query("W5_rank_first_by_flag", "", """
    WITH g AS (SELECT l_returnflag, l_orderkey, sum(l_quantity) AS q FROM lineitem GROUP BY ALL)
    SELECT l_returnflag, l_orderkey, row_number() OVER (PARTITION BY l_returnflag ORDER BY q, l_orderkey) AS rank FROM g""")
def ranks_by_flag(spark, sf):
    sums = lines(spark, sf).groupBy("l_returnflag", "l_orderkey").agg(F.sum("l_quantity").alias("q"))
    return rank_first(sums, "q", "l_orderkey", ["l_returnflag"]).drop("q")


def _spec_sql(source: str, value: str, tie: str, n: int) -> str:
    return f"""
    r AS (SELECT {value} AS v, cast((row_number() OVER (ORDER BY {value}, {tie}) - 1) * {n} // count(*) OVER () AS integer) AS bin
          FROM {source} WHERE {value} IS NOT NULL),
    spec AS (SELECT bin, coalesce(lag(max(v)) OVER (ORDER BY bin), cast('-Infinity' AS double)) AS edge_lo,
             max(v) AS edge_hi, min(v) AS p_low, max(v) AS p_high, avg(v) AS p_center, count(*) AS n FROM r GROUP BY bin)"""


@query("W6_equal_count_bins", "scored_docs", f"""
    WITH {_spec_sql("scored_docs", "p", "doc_id", 10)}
    SELECT bin, edge_lo, edge_hi, p_low, p_high, {rq("p_center")} AS p_center, n FROM spec""")
def equal_count(spark, sf):
    spec = b.equal_count_bins(scored_docs(spark, sf), "p", "doc_id", 10)
    return spec.withColumn("p_center", r6("p_center"))


@query("W6_equal_count_bins_parts", "", f"""
    WITH s AS (SELECT p_partkey, cast(p_size AS double) AS p FROM part), {_spec_sql("s", "p", "p_partkey", 16)}
    SELECT bin, edge_lo, edge_hi, p_low, p_high, {rq("p_center")} AS p_center, n FROM spec""")
def equal_count_parts(spark, sf):
    spec = b.equal_count_bins(_part_rows(spark, sf), "p", "p_partkey", 16)
    return spec.withColumn("p_center", r6("p_center"))


@query("W7_assign_bins", "scored_docs", f"""
    WITH {_spec_sql("scored_docs", "p", "doc_id", 10)},
    x AS (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN NULL ELSE cast(n_chars AS double) END AS v FROM documents),
    a AS (SELECT doc_id, v, (SELECT count(*) FROM spec WHERE edge_hi < v) AS raw FROM x)
    SELECT doc_id, cast(CASE WHEN v IS NULL THEN -1 ELSE least(raw, 9) END AS integer) AS bin_clip,
           cast(CASE WHEN v IS NULL OR raw > 9 THEN -1 ELSE raw END AS integer) AS bin_ignore FROM a""")
def assign(spark, sf):
    spec = b.equal_count_bins(scored_docs(spark, sf), "p", "doc_id", 10)
    value = F.when(F.col("doc_id") % 5 != 0, F.col("n_chars").cast("double"))
    docs = table(spark, sf, "documents").select("doc_id", value.alias("v"))
    clip = b.assign_bins(docs, "v", spec, "clip", name="bin_clip")
    return b.assign_bins(clip, "v", spec, "ignore", name="bin_ignore").drop("v")


@query("W8_rank_bins", "", """
    WITH x AS (SELECT p_partkey, CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE cast(p_size AS double) END AS p FROM part),
    n AS (SELECT count(*) AS n FROM x),
    r AS (SELECT p_partkey, row_number() OVER (ORDER BY p, p_partkey) AS r_first, rank() OVER (ORDER BY p) AS r_min,
            rank() OVER (ORDER BY p) + count(*) OVER (PARTITION BY p) - 1 AS r_max, dense_rank() OVER (ORDER BY p) AS r_dense
          FROM x WHERE p IS NOT NULL)
    SELECT x.p_partkey, m.method, cast(CASE WHEN r.p_partkey IS NULL THEN -1 ELSE floor(((CASE m.method
        WHEN 'first' THEN r_first WHEN 'min' THEN r_min WHEN 'max' THEN r_max WHEN 'dense' THEN r_dense
        ELSE (r_min + r_max) / 2.0 END) - 1) * 7 / n.n) END AS integer) AS bin
    FROM x CROSS JOIN n LEFT JOIN r USING (p_partkey)
    CROSS JOIN (VALUES ('first'), ('average'), ('min'), ('max'), ('dense')) AS m(method)""")
def rank_bins(spark, sf):
    rows = _part_rows(spark, sf).withColumn("p", F.when(F.col("p_partkey") % 10 != 0, F.col("p")))
    out = None
    for method in ("first", "average", "min", "max", "dense"):
        made = b.rank_bins(rows, "p", "p_partkey", 7, method).select("p_partkey", F.lit(method).alias("method"), "bin")
        out = made if out is None else out.unionByName(made)
    return out


_ASSIGNED = """
    a AS (SELECT d.doc_id, d.n_chars, l.quality, l.toxic, (SELECT count(*) FROM spec WHERE edge_hi < d.n_chars * 2) AS bin
          FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)"""


def _labelled(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", (F.col("n_chars") * 2).alias("v"), "n_chars")
    return docs.join(table(spark, sf, "labels"), "doc_id", "left")


@query("W9_summarize_bins", "scored_docs", f"""
    WITH {_spec_sql("scored_docs", "p", "doc_id", 10)}, {_ASSIGNED}
    SELECT s.bin, s.p_low, s.p_high, {rq("s.p_center")} AS p_center, coalesce(c.n, 0) AS n, {rq("c.mean_y")} AS mean_y
    FROM spec s LEFT JOIN (SELECT bin, count(*) AS n, avg(quality) AS mean_y FROM a GROUP BY bin) c ON c.bin = s.bin""")
def summarize(spark, sf):
    spec = b.equal_count_bins(scored_docs(spark, sf), "p", "doc_id", 10)
    out = b.summarize_bins(_labelled(spark, sf), "v", "quality", spec)
    return out.drop("w_sum").withColumns({"p_center": r6("p_center"), "mean_y": r6("mean_y")})


@query("W9_summarize_bins_weighted", "scored_docs", f"""
    WITH {_spec_sql("scored_docs", "p", "doc_id", 10)}, {_ASSIGNED}
    SELECT s.bin, s.p_low, s.p_high, {rq("s.p_center")} AS p_center, coalesce(c.n, 0) AS n, {rq("c.mean_y")} AS mean_y,
      c.w_sum FROM spec s LEFT JOIN (
      SELECT bin, count(*) AS n, sum(toxic * quality) / nullif(cast(sum(toxic) AS double), 0) AS mean_y,
             cast(sum(toxic) AS double) AS w_sum
      FROM a WHERE toxic IS NOT NULL GROUP BY bin) c ON c.bin = s.bin""")
def summarize_weighted(spark, sf):
    spec = b.equal_count_bins(scored_docs(spark, sf), "p", "doc_id", 10)
    out = b.summarize_bins(_labelled(spark, sf), "v", "quality", spec, weight="toxic")
    return out.withColumns({"p_center": r6("p_center"), "mean_y": r6("mean_y")})


@query("W10_calibration", "scored_docs", f"""
    SELECT bin, {rq("avg(p)")} AS mean_p, {rq("avg(y)")} AS mean_y, count(*) AS n, min(p) AS p_low, max(p) AS p_high
    FROM (SELECT p, y, cast((row_number() OVER (ORDER BY p, doc_id) - 1) * 10 // count(*) OVER () AS integer) AS bin
          FROM scored_docs) GROUP BY bin""")
def calibrate(spark, sf):
    out = b.calibration(scored_docs(spark, sf), "p", "y", "doc_id", 10)
    return out.withColumns({"mean_p": r6("mean_p"), "mean_y": r6("mean_y")})


@query("W10_calibration_lines", "", f"""
    WITH g AS (SELECT l_orderkey, sum(l_quantity) AS p, avg(l_discount) AS y FROM lineitem GROUP BY l_orderkey)
    SELECT bin, {rq("avg(p)")} AS mean_p, round(avg(y), 4) AS mean_y, count(*) AS n, min(p) AS p_low, max(p) AS p_high
    FROM (SELECT p, y, cast((row_number() OVER (ORDER BY p, l_orderkey) - 1) * 20 // count(*) OVER () AS integer) AS bin
          FROM g) GROUP BY bin""")
def calibrate_lines(spark, sf):
    sums = lines(spark, sf).groupBy("l_orderkey").agg(F.sum("l_quantity").alias("p"), F.avg("l_discount").alias("y"))
    out = b.calibration(sums, "p", "y", "l_orderkey", 20)
    return out.withColumns({"mean_p": r6("mean_p"), "mean_y": F.round("mean_y", 4)})
