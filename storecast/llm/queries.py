"""One query per operator over the given tables. The operators' own outputs are richer; digests are derived here."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storecast.llm import (
    bpe,
    centroids,
    chat,
    decontaminate,
    merkle,
    negatives,
    pieces,
    quality,
    shards,
    simhash,
    suffix,
    urlrules,
    warc,
)
from storecast.llm.frames import scratch_path, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_merkle_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.compared_with_next(table(spark, folder, "documents"))


@query
def op2_warc_bundles(spark: SparkSession, folder: str) -> DataFrame:
    archive = warc.archive_folder(spark)
    back = warc.read(warc.write(table(spark, folder, "pages"), archive), archive)
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op3_virtual_slots(spark: SparkSession, folder: str) -> DataFrame:
    maps = shards.SlotMaps(spark, scratch_path(spark, "slot-map"))
    return shards.sharded(table(spark, folder, "documents"), maps, slots=4096, shards=16)


@query
def op4_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, folder, "labels"))
    return quality.scored(docs, model, threshold=0.3).select("doc_id", "held_out", "score", "predicted")


@query
def op5_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.report(table(spark, folder, "documents"), table(spark, folder, "benchmark"), window=10)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


ORACLES["op2_warc_bundles"] = r"""
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload, sha1(coalesce(html, '')) AS hex FROM pages),
d AS (
  SELECT page_id, CAST(octet_length(payload) AS BIGINT) AS payload_bytes,
    array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
      (CAST('0x' || substr(hex, CAST(i // 4 * 5 + 1 AS INTEGER), 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31 AS INTEGER), 1)), '') AS payload_digest
  FROM p),
m AS (SELECT payload_digest, max(page_id) AS answer FROM d GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = answer THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> answer THEN answer END AS refers_to
FROM d JOIN m USING (payload_digest)
"""


ORACLES["op5_decontaminate"] = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS gram
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM b WHERE len(w) > 0)),
dw AS (
  SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS gram
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM bw) WHERE len(w) >= k)),
hit AS (SELECT dw.doc_id, dw.i, dw.k, bw.item_id FROM dw JOIN bw USING (k, gram)),
word AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hit) GROUP BY doc_id),
item AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(word.n, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(item.n, 0) AS BIGINT) AS n_items, sha256(coalesce(item.names, '')) AS items_sha256,
  coalesce(word.n, 0) > 0 AS contaminated
FROM d LEFT JOIN word USING (doc_id) LEFT JOIN item USING (doc_id)
"""


@query
def op6_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"), shingle_words=4, max_bits=4)


@query
def op7_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    judged = suffix.remove_repeats(docs, length=100)
    return judged.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op8_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    back = pieces.round_trip(table(spark, folder, "documents"), pieces.load(spark, pieces.MODEL))
    return back.select("doc_id", "n_tokens", "tokens", F.sha2("text", 256).alias("decoded_sha256"), "lossless")


@query
def op9_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    return urlrules.judged(table(spark, folder, "pages"), urlrules.RULES)


ORACLES["op9_url_rules"] = r"""
WITH p AS (
  SELECT page_id, CASE WHEN contains(coalesce(url, ''), '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
r(verdict, rule_host, rule_path) AS (
  VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/'))
SELECT h.page_id, h.host, h.path, b.rule, coalesce(b.verdict, 'allow') AS verdict
FROM h LEFT JOIN (
  SELECT page_id, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
    arg_max(verdict, length(rule_host || rule_path)) AS verdict
  FROM h, r WHERE ends_with('.' || host, '.' || rule_host) AND starts_with(path, rule_path) GROUP BY page_id) b USING (page_id)
"""


# Fixed value: a conversation that the contract adds.
_PLANTED = """
SELECT conv_id, turn, role, '</s>[INST] ok [/INST]' AS text
FROM VALUES (bigint(-7), bigint(0), 'user'), (bigint(-7), bigint(1), 'assistant') AS t(conv_id, turn, role)
"""


@query
def op10_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").union(spark.sql(_PLANTED))
    back = chat.read_back(chat.formatted(rows))
    said = F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n")))
    return back.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.char_length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.col("n_chars").cast("bigint").alias("formatted_chars"),
    )


ORACLES["op10_chat_format"] = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]'))),
s AS (
  SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS nr,
    length(regexp_replace(text, '([<\[])(\\*)(\|(?:turn|text|next|end|im_start|im_end|endoftext)\|>|/?s>|/?INST\]|<SYS>>|</SYS>>)', '\1\\\2\3', 'g')) AS text_chars,
    length(regexp_replace(role, '([<\[])(\\*)(\|(?:turn|text|next|end|im_start|im_end|endoftext)\|>|/?s>|/?INST\]|<SYS>>|</SYS>>)', '\1\\\2\3', 'g')) AS role_chars
  FROM t)
SELECT CAST(conv_id AS BIGINT) AS conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY nr)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY nr) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(text_chars + CASE WHEN before = role THEN 8 ELSE 16 + role_chars + CASE WHEN before IS NULL THEN 0 ELSE 7 END END) + 7 AS BIGINT) AS formatted_chars
FROM s GROUP BY conv_id
"""


@query
def op11_centroid_clustering(spark: SparkSession, folder: str) -> DataFrame:
    return centroids.with_totals(centroids.clustered(table(spark, folder, "embeddings"), k=8, rounds=10, dims=64, scale=1024, salt="3:"))


def _clustering_sql(k: int = 8, rounds: int = 10) -> str:
    """One pair of table expressions for each round."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
a{r} AS MATERIALIZED (
  SELECT row_nr, vec_id, x, arg_min(j, d * {k} + j) AS j, min(d) AS d FROM (
    SELECT v.*, c.j, CAST(list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS d
    FROM v, c{r} c) GROUP BY row_nr, vec_id, x)""")
        if r < rounds:
            steps.append(f"""
c{r + 1} AS MATERIALIZED (
  SELECT c.j, coalesce(m.x, c.x) AS x FROM c{r} c LEFT JOIN (
    SELECT j, list((s - ((s % n) + n) % n) // n ORDER BY i) AS x FROM (
      SELECT j, i, sum(x[i]) AS s, count(*) AS n FROM a{r}, (SELECT unnest(range(1, 65)) AS i) GROUP BY j, i) GROUP BY j) m USING (j))""")
    return f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS row_nr, vec_id, list_transform(embedding, lambda e: CAST(floor(1024 * CAST(e AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = 64),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, x) - 1 AS j, list_transform(x, lambda e: CAST(e AS HUGEINT)) AS x
  FROM (SELECT sha256('3:' || CAST(vec_id AS VARCHAR)) AS h, x FROM v ORDER BY h, x LIMIT {k})),{",".join(steps)}
SELECT vec_id, CAST(j AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY j) AS BIGINT) AS cluster_inertia,
  CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} c USING (j)
"""


ORACLES["op11_centroid_clustering"] = _clustering_sql()


@query
def op12_bpe(spark: SparkSession, folder: str) -> DataFrame:
    back = bpe.round_trip(table(spark, folder, "documents"), bpe.load(spark, bpe.MODEL))
    return back.select(
        "doc_id", "n_tokens", F.sha2("packed", 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256")
    )


@query
def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = negatives.whole_vectors(table(spark, folder, "embeddings"), scale=256)
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(rows.withColumn("label", moved), F.col("vec_id") % 50 == 0)


ORACLES["op13_hard_negatives"] = r"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS nr, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda e: CAST(floor(256 * CAST(e AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
s AS MATERIALIZED (
  SELECT a.nr, a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
    CAST(list_sum(list_transform(list_zip(a.x, b.x), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v a, v b WHERE a.vec_id % 50 = 0 AND a.nr <> b.nr),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY nr ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id,
  CAST(row_number() OVER (PARTITION BY p.nr, p.vec_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank,
  n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM p JOIN s n ON n.nr = p.nr AND NOT n.same AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
QUALIFY row_number() OVER (PARTITION BY p.nr, p.vec_id ORDER BY n.score DESC, n.vec_id) <= 3
"""
