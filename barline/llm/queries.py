"""The operators as queries over the given tables, with their SQL where there is any."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barline.llm.store import small_batches
from barline.session import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = lambda spark, sf: fn(small_batches(prepare(spark)), sf)
        if sql:
            SQL[name] = sql.strip()
        return fn

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


NGRAM_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, text, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL),
full_docs AS (SELECT * FROM words WHERE len(w) > 0),
classes AS (SELECT text, min(doc_id) AS class_id, count(*) AS copies, any_value(w) AS w FROM full_docs GROUP BY text),
shingles AS (
  SELECT DISTINCT class_id, unnest(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' '))) AS s
  FROM classes),
sizes AS (SELECT class_id, count(*) AS n FROM shingles GROUP BY class_id),
pairs AS (
  SELECT a.class_id AS a, b.class_id AS b, count(*) AS c
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.class_id < b.class_id GROUP BY 1, 2),
near AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.class_id = a JOIN sizes y ON y.class_id = b
  WHERE 5 * c >= 4 * (x.n + y.n - c)),
linked AS (SELECT a, b FROM near UNION ALL SELECT b, a FROM near),
reach(node, seen) AS (SELECT a, b FROM linked UNION SELECT r.node, n.b FROM reach r JOIN linked n ON n.a = r.seen),
comp AS (SELECT node, least(node, min(seen)) AS component FROM reach GROUP BY node),
links AS (SELECT a AS class_id, sum(copies) AS docs FROM linked JOIN classes ON class_id = b GROUP BY a)
SELECT d.doc_id, coalesce(c.class_id, d.doc_id) AS class_id,
  cast(coalesce(c.copies - 1 + coalesce(l.docs, 0), 0) AS bigint) AS n_links,
  coalesce(k.component, c.class_id, d.doc_id) AS component_id,
  coalesce(k.component, c.class_id, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN full_docs f ON f.doc_id = d.doc_id LEFT JOIN classes c ON c.text = f.text
LEFT JOIN links l ON l.class_id = c.class_id LEFT JOIN comp k ON k.node = c.class_id
"""


@query("op4_ngram_join", NGRAM_SQL)
def op4(spark: SparkSession, sf: str) -> DataFrame:
    from barline.llm.ngram_join import ngram_join

    return ngram_join(table(spark, sf, "documents")).drop("digest")


@query("op5_byte_bpe")
def op5(spark: SparkSession, sf: str) -> DataFrame:
    from barline.llm.byte_bpe import encode_texts

    return encode_texts(table(spark, sf, "documents"), vocabulary("byte_bpe_multi_50k.tiktoken"), digests=True)


@query("op10_best_two_fit")
def op10(spark: SparkSession, sf: str) -> DataFrame:
    from barline.llm.packing import pack

    packed = pack(table(spark, sf, "documents"), vocabulary("byte_bpe_50k.json"))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32",
                         F.col("sequence_id").cast("long").alias("sequence_id"), F.col("offset").cast("long").alias("offset"))


@query("op8_adaptive_rules")
def op8(spark: SparkSession, sf: str) -> DataFrame:
    from barline.llm.quality_rules import quality_rules

    return quality_rules(table(spark, sf, "documents"))


@query("op9_importance_resampling")
def op9(spark: SparkSession, sf: str) -> DataFrame:
    from barline.llm.importance import importance_sample

    return importance_sample(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query("op7_skip_chain_crf")
def op7(spark: SparkSession, sf: str) -> DataFrame:
    from barline.llm.pii import personal_data

    return personal_data(table(spark, sf, "documents"))


URL_SQL = """
WITH parts AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
judged AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM parts),
rules(verdict, rule_host, rule_path) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
  ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
best AS (
  SELECT row, arg_max((rule_host || rule_path, verdict), length(rule_host || rule_path)) AS b
  FROM (SELECT *, row_number() OVER () AS row FROM judged) j
  JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY row)
SELECT page_id, host, path, b[1] AS rule, coalesce(b[2], 'allow') AS verdict
FROM (SELECT *, row_number() OVER () AS row FROM judged) j LEFT JOIN best USING (row)
"""
URL_RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
             ("block", "net", "/es/"), ("block", "net", "/fr/")]


@query("op1_bloom_cascade", URL_SQL)
def op1(spark: SparkSession, sf: str) -> DataFrame:
    from barline.llm.url_filter import filter_urls

    rules = spark.createDataFrame(URL_RULES, "verdict string, host string, path string")
    return filter_urls(table(spark, sf, "pages").select("page_id", "url"), rules).drop("url")


WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, octet_length(encode(body)) AS n, sha1(body) AS x FROM p),
k AS (SELECT *, min(page_id) OVER (PARTITION BY x) AS first,
        array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + cast(
          (cast('0x' || substr(x, cast(1 + 5 * (i // 4) AS integer), 5) AS integer) >> cast(15 - 5 * (i % 4) AS integer)) & 31 AS integer), 1)), '') AS digest
      FROM d)
SELECT page_id, cast(n AS bigint) AS payload_bytes, digest AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM k
"""


@query("op2_capture_index", WARC_SQL)
def op2(spark: SparkSession, sf: str) -> DataFrame:
    from barline.llm.warc import archived

    found = archived(table(spark, sf, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


EMBEDDING_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: cast(x AS double)) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL),
u AS (SELECT vec_id, label, e, sqrt(list_dot_product(e, e)) AS n FROM v),
near AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE a.n > 0 AND b.n > 0 AND list_dot_product(a.e, b.e) / (a.n * b.n) >= 0.93),
reach(node, seen) AS (SELECT a, b FROM near UNION SELECT r.node, n.b FROM reach r JOIN near n ON n.a = r.seen),
comp AS (SELECT node, least(node, min(seen)) AS component FROM reach GROUP BY node),
links AS (SELECT a, count(*) AS n FROM near GROUP BY a)
SELECT vec_id, cast(coalesce(n, 0) AS bigint) AS n_links, coalesce(component, vec_id) AS component_id,
  coalesce(component, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN links ON a = vec_id LEFT JOIN comp ON node = vec_id
"""


@query("op3_projection_forest", EMBEDDING_SQL)
def op3(spark: SparkSession, sf: str) -> DataFrame:
    from barline.llm.rp_forest import near_vectors

    return near_vectors(table(spark, sf, "embeddings"))


@query("op6_min_cost_reshard")
def op6(spark: SparkSession, sf: str) -> DataFrame:
    from barline.llm.reshard import old_shards, reshard, slots

    rows, _ = reshard(old_shards(spark, f"{sf}/documents.parquet"))
    narrow = rows.select("doc_id", "size", "text_crc32", "shard", "old_shard", "block")
    return slots(narrow).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                                F.lit(None).cast("int").alias("grown_shard"))


#: CRC-32 of the ids as text, for queries that name their distinct ids ``ids(id)``.
CRC_SQL = """
bits(b, k, v) AS (
  SELECT range, 0, range FROM range(256)
  UNION ALL SELECT b, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM bits WHERE k < 8),
crc_table AS (SELECT list(v ORDER BY b) AS t FROM bits WHERE k = 8),
crc(id, i, v) AS (
  SELECT id, 0, cast(4294967295 AS bigint) FROM ids
  UNION ALL SELECT id, i + 1, xor(v >> 8, t[cast(xor(v & 255, ascii(substr(cast(id AS varchar), i + 1, 1))) AS integer) + 1])
  FROM crc, crc_table WHERE i < length(cast(id AS varchar))),
crcs AS (SELECT id, xor(v, 4294967295) AS crc FROM crc WHERE i = length(cast(id AS varchar))),
"""
MERKLE_SQL = "WITH RECURSIVE ids AS (SELECT DISTINCT doc_id AS id FROM documents), " + CRC_SQL + """
docs AS (
  SELECT d.doc_id, lang, lower_az, crc % 3 = 0 AS tampered, row_number() OVER (PARTITION BY lang ORDER BY d.doc_id NULLS FIRST) - 1 AS pos,
    FIELDS(text) AS leaf, FIELDS(lower_az) AS other
  FROM (SELECT *, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_az FROM documents) d
  LEFT JOIN crcs ON id = d.doc_id),
langs AS (SELECT lang, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS g, count(*) AS n FROM docs GROUP BY lang),
low(g, level, pos, h, n) AS (
  SELECT g, 0, pos, leaf, n FROM docs JOIN langs ON docs.lang IS NOT DISTINCT FROM langs.lang
  UNION ALL
  SELECT g, level + 1, pos // 8, sha256(string_agg(h, '' ORDER BY pos)), (n + 7) // 8 FROM low WHERE n > 1 GROUP BY g, level, pos // 8, n),
subroots AS (SELECT g, level AS height, h FROM low WHERE n = 1),
high(level, pos, h, n) AS (
  SELECT 0, g, h, (SELECT count(*) FROM langs) FROM subroots
  UNION ALL
  SELECT level + 1, pos // 8, sha256(string_agg(h, '' ORDER BY pos)), (n + 7) // 8 FROM high WHERE n > 1 GROUP BY level, pos // 8, n),
root AS (SELECT level AS height, h AS root FROM high WHERE n = 1),
runs AS (
  SELECT g, level, pos // 8 AS run, list(h ORDER BY pos) AS hs FROM low WHERE n > 1 GROUP BY ALL
  UNION ALL
  SELECT s.g, s.height + h.level, h.pos // 8 AS run, list(h.h ORDER BY pos) FROM high h, subroots s
  WHERE n > 1 AND (s.g >> (3 * (h.level + 1))) = h.pos // 8 GROUP BY ALL),
fold(doc_id, g, level, pos, acc, proof) AS (
  SELECT doc_id, l.g, 0, pos, CASE WHEN tampered THEN other ELSE leaf END, ''
  FROM docs JOIN langs l ON docs.lang IS NOT DISTINCT FROM l.lang
  UNION ALL
  SELECT f.doc_id, f.g, f.level + 1, CASE WHEN f.level + 1 = s.height THEN f.g ELSE f.pos // 8 END,
    sha256(array_to_string(hs[1:f.pos % 8], '') || acc || array_to_string(hs[f.pos % 8 + 2:], '')),
    proof || array_to_string(hs[1:f.pos % 8], '') || array_to_string(hs[f.pos % 8 + 2:], '')
  FROM (SELECT f.doc_id, f.g, f.level, acc, proof, CASE WHEN f.level = 0 AND s0.height = 0 THEN f.g ELSE f.pos END AS pos
        FROM fold f JOIN subroots s0 ON s0.g = f.g) f
  JOIN subroots s ON s.g = f.g JOIN runs r ON r.g = f.g AND r.level = f.level AND r.run = f.pos // 8)
SELECT d.doc_id, leaf, s.h AS subroot, root, sha256(proof) AS proof_sha256, acc AS folded_root, acc = root AS verified
FROM docs d JOIN langs l ON d.lang IS NOT DISTINCT FROM l.lang JOIN subroots s ON s.g = l.g CROSS JOIN root
JOIN fold f ON f.doc_id IS NOT DISTINCT FROM d.doc_id AND f.level = s.height + root.height
"""
MERKLE_FIELDS = "sha256(" + " || ".join(
    f"coalesce(octet_length(encode(cast({c} AS varchar))) || ':' || cast({c} AS varchar), '-')"
    for c in ("d.doc_id", "source", "lang", "n_chars", "@")) + ")"
for _text in ("lower_az", "text"):
    MERKLE_SQL = MERKLE_SQL.replace(f"FIELDS({_text})", MERKLE_FIELDS.replace("@", _text))


@query("op11_merkle_manifest", MERKLE_SQL)
def op11(spark: SparkSession, sf: str) -> DataFrame:
    from barline.llm.merkle import FIELDS, fold, leaf_hash, merkle_manifest, proof_hash

    docs = table(spark, sf, "documents")
    lowered = leaf_hash(FIELDS, {"text": F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")})
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    made = merkle_manifest(docs, also={"tampered": F.when(chosen, lowered)})
    folded = made.withColumn("folded_root", fold(F.coalesce("tampered", "leaf"), F.col("path")))
    return folded.select("doc_id", "leaf", "subroot", "root", proof_hash(F.col("path")).alias("proof_sha256"), "folded_root",
                         (F.col("folded_root") == F.col("root")).alias("verified"))


@query("op12_toxicity")
def op12(spark: SparkSession, sf: str) -> DataFrame:
    from barline.llm.toxicity import toxicity

    return toxicity(table(spark, sf, "documents"), table(spark, sf, "labels"))


TRIE_SQL = "WITH RECURSIVE ids AS (SELECT DISTINCT conv_id AS id FROM conversations WHERE conv_id IS NOT NULL), " + CRC_SQL + r"""
turns AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS pos,
    sha256(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, '')) AS k,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS w
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT id AS c, crc % 4 AS h, id - id % 20 AS giver FROM crcs),
given AS (SELECT v.c, t.pos, k, w FROM convs v JOIN turns t ON t.c = giver AND t.pos < h),
heads AS (SELECT c, count(*) AS p FROM given GROUP BY c),
rebuilt AS (
  SELECT * FROM given UNION ALL
  SELECT t.c, t.pos - h + coalesce(p, 0), k, w FROM turns t JOIN convs USING (c) LEFT JOIN heads USING (c) WHERE t.pos >= h),
paths AS (
  SELECT c, 0 AS depth, '' AS node, 0 AS w FROM convs UNION ALL
  SELECT c, pos + 1, sha256(string_agg(k, '') OVER (PARTITION BY c ORDER BY pos)), w FROM rebuilt),
nodes AS (SELECT depth, node, min(c) AS conv_id, count(*) AS n, any_value(w) AS w FROM paths GROUP BY ALL),
tops AS (
  SELECT n.*, u.conv_id AS parent, u.node AS parent_node
  FROM nodes n LEFT JOIN paths p ON p.c = n.conv_id AND p.depth = n.depth - 1
  LEFT JOIN nodes u ON u.depth = p.depth AND u.node = p.node),
kids AS (SELECT depth - 1 AS depth, parent_node AS node, count(*) AS children FROM tops WHERE depth > 0 GROUP BY ALL),
full_nodes AS (SELECT t.*, coalesce(children, 0) AS children FROM tops t LEFT JOIN kids USING (depth, node)),
sums AS (
  SELECT p.depth, p.node, count(*) FILTER (children = 0) AS leaves, sum((n - 1) * f.w) AS saved
  FROM full_nodes f JOIN paths p ON p.c = f.conv_id AND p.depth <= f.depth GROUP BY ALL),
last AS (SELECT c, max(depth) AS depth FROM paths GROUP BY c),
ends AS (SELECT depth, node, string_agg(cast(c AS varchar), ',' ORDER BY c) AS ids FROM paths JOIN last USING (c, depth) GROUP BY ALL)
SELECT conv_id, depth, parent AS parent_conv_id, n AS n_convs, children AS n_children, leaves AS n_leaves,
  cast(saved AS bigint) AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM full_nodes JOIN sums USING (depth, node) LEFT JOIN ends USING (depth, node)
"""


@query("op13_prefix_trie", TRIE_SQL)
def op13(spark: SparkSession, sf: str) -> DataFrame:
    from barline.llm.prefix_trie import prefix_trie

    return prefix_trie(table(spark, sf, "conversations"))
