"""Registered queries of the subpackage: each applies one operator, with production
parameters, to its whole table. ``ORACLE`` holds DuckDB SQL where SQL can express one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eddy.llm import (byte_pieces, chat, hard_negatives, mixing, parity_join, pieces, quality_rules, recurrent_lm, resampling,
                      sketch, toxicity, url_filters, warc)
from eddy.llm.scratch import Scratch

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


URL_RULES = [url_filters.Rule(*r) for r in (
    ("org", "/", True), ("example.org", "/es/", False), ("example.org", "/en/1", False),
    ("com", "/fr/", True), ("com", "/de/", False))]


@_query
def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, host, path, rule, verdict, inherited for every page."""
    return url_filters.judge(_table(spark, sf_dir, "pages"), URL_RULES, spark)


@_query
def op2_parity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_shingles, component_id, n_links for every document."""
    return parity_join.classes(_table(spark, sf_dir, "documents"), spark)


@_query
def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, size, source_size, target, copies, taken for every document."""
    return mixing.mix(_table(spark, sf_dir, "documents"), spark)


@_query
def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC files and read back: page_id, payload_bytes,
    payload_digest, record_type, refers_to."""
    folder = Scratch(spark, "archive").path("warc")
    manifests = warc.write(_table(spark, sf_dir, "pages"), folder, spark)
    return warc.read(manifests, folder, payloads=False).select(
        F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


@_query
def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketch of every document and of its edited text, and their likeness."""
    return sketch.fingerprints(_table(spark, sf_dir, "documents"))


def piece_model() -> str:
    """The 32k piece model among the public tokenizers, installed at one path on all nodes."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@_query
def op6_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """n_tokens, ids_sha256, decoded_sha256, span_bytes of every document."""
    return pieces.digests(_table(spark, sf_dir, "documents"), piece_model())


@_query
def op7_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probability of every document by the recurrent model and by word counts."""
    return recurrent_lm.scores(_table(spark, sf_dir, "documents"), spark)


def _rule_sql(host: str, path: str, column: str) -> str:
    """CASE over the rules, longest first (allow before block among equals)."""
    order = sorted(URL_RULES, key=lambda r: (-len(r.name), not r.allow))
    when = " ".join(
        f"WHEN ({host} = '{r.host}' OR ends_with({host}, '.{r.host}')) AND starts_with({path}, '{r.path}') "
        f"THEN {repr(r.name) if column == 'name' else str(r.allow).lower()}" for r in order)
    return f"CASE {when} END"


# Aliases in the supplied pages are canonical spellings only, so a component is all urls of
# one spelling; that, and the rules, plain SQL can say.
ORACLE["op1_url_filters"] = f"""WITH a AS (
  SELECT page_id, url, strpos(url, '://') > 0 AS known,
         CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
b AS (SELECT *, regexp_extract(rest, '^[^/?#]*') AS raw FROM a),
c AS (SELECT *, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path,
             list_filter(string_split(regexp_extract(url, '^[^?#]*\\?([^#]*)', 1), '&'),
                         lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_|ref=|ref$)')) AS kept FROM b),
d AS (SELECT *, regexp_replace(host, '^(www|m)\\.', '') AS bare, regexp_replace(path, '/+$', '') AS trimmed FROM c),
e AS (SELECT *, bare || trimmed || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END AS spelling,
             {_rule_sql("host", "path", "name")} AS rule, {_rule_sql("host", "path", "allow")} AS allow,
             {_rule_sql("bare", "trimmed", "allow")} AS spelled FROM d),
f AS (SELECT spelling, bool_or(x) AS shared FROM (SELECT spelling, unnest([allow, spelled]) AS x FROM e WHERE known)
      GROUP BY spelling)
SELECT page_id, host, path, rule, CASE WHEN coalesce(allow, shared, true) THEN 'allow' ELSE 'block' END AS verdict,
       allow IS NULL AND shared IS NOT NULL AS inherited
FROM e LEFT JOIN f ON e.spelling = f.spelling AND e.known"""


@_query
def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every conversation, and of conversation -1, read back from its format."""
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").cast(rows.schema["turn"].dataType).alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    chats = chat.format_chats(rows.unionAll(probe))
    lines = F.transform(F.col("turns"), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return (chats.withColumn("turns", chat.read_chats(F.col("formatted")))
            .withColumn("learnt", chat.loss_text(F.col("segments")))
            .select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                    F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
                    F.length("learnt").cast("long").alias("loss_chars"), F.sha2("learnt", 256).alias("loss_sha256"),
                    F.length("formatted").cast("long").alias("formatted_chars"), "valid", "bad_moves"))


@_query
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, severity (expected grade 0 to 3), p_toxic, grade, toxic for every document."""
    docs = _table(spark, sf_dir, "documents")
    return toxicity.judge(docs, toxicity.fit(docs, _table(spark, sf_dir, "labels")))


@_query
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule counts of every document, base_failed, the forest's anomaly score and kept."""
    docs = _table(spark, sf_dir, "documents")
    return quality_rules.judge(docs, quality_rules.fit(docs, _table(spark, sf_dir, "labels")))


@_query
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of all
    anchors (ids divisible by 50) among all vectors."""
    rows = _table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = hard_negatives.quantised(rows, F.col("vec_id"), label, F.col("embedding"))
    return hard_negatives.mine(vectors, F.col("id") % 50 == 0, spark)


ORACLE["op11_hard_negatives"] = """WITH a AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT u.r, u.vec_id AS anchor_id, v.vec_id, u.label = v.label AS same,
             CAST(list_dot_product(u.q, v.q) AS BIGINT) AS score
      FROM a u JOIN a v ON len(u.q) = len(v.q) AND u.vec_id <> v.vec_id WHERE u.vec_id % 50 = 0),
p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS k FROM s WHERE same)
      WHERE k <= 5),
n AS (SELECT p.anchor_id, p.vec_id AS positive_id, p.score AS positive_score, s.vec_id AS negative_id,
             s.score AS negative_score,
             CAST(row_number() OVER (PARTITION BY p.r, p.k ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
      FROM p JOIN s ON s.r = p.r AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3"""


@_query
def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_features, weight, score, rank of every document, the target being benchmark."""
    return resampling.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), spark)


def _crc_entries() -> list[int]:
    """The byte table of CRC-32, from its polynomial."""
    out = []
    for x in range(256):
        for _ in range(8):
            x = x >> 1 ^ (0xEDB88320 if x & 1 else 0)
        out.append(x)
    return out


_LOWERED = "translate(coalesce(text,''),'ABCDEFGHIJKLMNOPQRSTUVWXYZ','abcdefghijklmnopqrstuvwxyz')"

ORACLE["op12_resampling"] = f"""WITH crc AS MATERIALIZED (SELECT {_crc_entries()} AS t),
d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWERED}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS MATERIALIZED (SELECT regexp_extract_all({_LOWERED}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
fd AS MATERIALIZED (SELECT r, unnest(list_concat(w, list_concat(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i+1]),
   list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i+1] || ' ' || w[i+2])))) AS f FROM d),
fb AS MATERIALIZED (SELECT unnest(list_concat(w, list_concat(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i+1]),
   list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i+1] || ' ' || w[i+2])))) AS f FROM b),
u AS MATERIALIZED (SELECT f, hex(encode(f)) AS x FROM (SELECT f FROM fd UNION SELECT f FROM fb)),
k AS MATERIALIZED (SELECT f, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
   list_transform(range(0, len(x) // 2), lambda i: CAST('0x' || substr(x, 2 * i + 1, 2) AS BIGINT))),
   lambda s, c: xor(s >> 8, t[(xor(s, c) & 255) + 1]))) % 10000 AS bucket FROM u, crc),
s AS (SELECT bucket, count(*) AS n FROM fd JOIN k USING (f) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM fb JOIN k USING (f) GROUP BY bucket),
g AS MATERIALIZED (SELECT i AS bucket, CAST(floor(1000 * ln(((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM s) + 10000)::DOUBLE)
   / ((coalesce(s.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM t) + 10000)::DOUBLE))) AS BIGINT) AS gain
   FROM range(10000) x(i) LEFT JOIN s ON s.bucket = i LEFT JOIN t ON t.bucket = i),
w AS (SELECT r, sum(gain) AS weight FROM fd JOIN k USING (f) JOIN g USING (bucket) GROUP BY r),
z AS (SELECT d.r, doc_id, len(w) AS words, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
   CAST('0x' || substr(sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h
   FROM d LEFT JOIN w ON d.r = w.r),
y AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score FROM z),
e AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS k FROM y WHERE words >= 20)
SELECT doc_id, CAST(words + greatest(words - 1, 0) + greatest(words - 2, 0) AS BIGINT) AS n_features, weight, score,
   CASE WHEN k <= 5 * (SELECT count(*) FROM e) // 100 THEN k END AS rank
FROM y LEFT JOIN e USING (r)"""


def byte_ranks() -> str:
    """The multilingual rank file among the public tokenizers, installed at one path on all nodes."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@_query
def op13_byte_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """n_tokens, ids_sha256, decoded_sha256 of every document."""
    import public_tokenizers

    path = byte_ranks()
    tokens = byte_pieces.encode(_table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN, spark)
    return byte_pieces.digests(tokens, path)
