"""One query per operator, over whole tables, and the SQL that checks it where SQL can."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamlog import workspace
from streamlog.llm import (
    exact_dedup,
    hard_negatives,
    iblt,
    language_id,
    license_scan,
    maxent_lm,
    packing,
    simhash,
    source_mix,
    substring_dedup,
    token_counts,
    vector_codes,
    warc,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = workspace.new_dir(spark, "warc")
    warc.write(spark.read.parquet(f"{sf_dir}/pages.parquet"), path, "page_id", "url", "html")
    records = warc.read(spark, path).where("kind = 'record'").drop("payload")
    return warc.row_ids(records, page_id="record_id", refers="refers_to").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", F.col("refers").alias("refers_to")
    )


ORACLES["op1_warc_salvage"] = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS first FROM p)
SELECT page_id, n AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
    (CAST('0x' || substr(h, CAST(1 + 5 * (i // 4) AS INT), 5) AS INT) >> CAST(15 - 5 * (i % 4) AS INT)) & 31 AS INT), 1)), '')
    AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM f
"""


@query
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = exact_dedup.new_index(spark)
    rows = exact_dedup.deduplicate(documents(spark, sf_dir), index)
    return rows.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


ORACLES["op2_exact_dedup"] = """
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n,
  sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', '', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM (
  SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id,
    count(*) OVER (PARTITION BY text_sha256) AS group_size FROM d)
"""


@query
def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(documents(spark, sf_dir))


@query
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = language_id.remainder(F.col("doc_id"), 5) == 0
    model = language_id.fit(docs.where(~held_out))
    return language_id.predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query
def op5_maxent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = language_id.remainder(F.col("doc_id"), 10) == 0
    model, n_tokens = maxent_lm.fit(docs.where(~held_out))
    return maxent_lm.score(docs, model, n_tokens, held_out).withColumn("held_out", held_out)


@query
def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = source_mix.mix(documents(spark, sf_dir))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


ORACLES["op6_source_mix"] = """
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 15) AS BIGINT) AS h FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, 2.0::DOUBLE * source_size AS cap,
    [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight FROM s),
l AS (SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
t AS (SELECT source, source_size, least(cap, max(level) OVER () * weight) AS target FROM l),
b AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS copies FROM t),
c AS (SELECT d.*, source_size, target, copies, target - copies * source_size AS budget,
    sum(size) OVER (PARTITION BY d.source ORDER BY h) AS upto, sum(size) OVER (PARTITION BY d.source, h) AS tied
  FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target, size * (copies + CASE WHEN upto <= budget THEN 1
  WHEN upto - tied <= budget AND tied - (budget - (upto - tied)) < budget - (upto - tied) THEN 1 ELSE 0 END) AS taken FROM c
"""


@query
def op7_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.classes(documents(spark, sf_dir))
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = packing.pieces(documents(spark, sf_dir), tokenizer_path())
    rows = cut.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.assign(rows)


@query
def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = substring_dedup.deduplicate(documents(spark, sf_dir), finish=lambda kept: hashlib.sha256(kept).hexdigest())
    return rows.select("doc_id", "n_words", "n_removed", F.col("kept").alias("kept_sha256"))


ORACLES["op9_substring_dedup"] = """
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word, len(w) AS n FROM d),
g AS (SELECT doc_id, i, word, n, array_to_string(list(word) OVER (PARTITION BY doc_id ORDER BY i
    ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING), ' ') AS run FROM p),
f AS (SELECT doc_id, i, word, i + 19 <= n AND row_number() OVER (PARTITION BY run, i + 19 <= n ORDER BY doc_id, i) > 1 AS again FROM g),
c AS (SELECT doc_id, i, word, coalesce(bool_or(again) OVER (PARTITION BY doc_id ORDER BY i
    ROWS BETWEEN 19 PRECEDING AND CURRENT ROW), false) AS gone FROM f),
k AS (SELECT doc_id, count(*) AS n_words, count(*) FILTER (gone) AS n_removed,
    coalesce(string_agg(word, ' ' ORDER BY i) FILTER (NOT gone), '') AS kept FROM c GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k ON d.doc_id = k.doc_id
"""


@query
def op10_iblt_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return iblt.compare(documents(spark, sf_dir))


#: Usable vectors as integers, for SQL.
_INTEGERS = """
SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
"""


@query
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = vector_codes.encode(embeddings(spark, sf_dir))
    return vector_codes.with_label_error(coded).select(
        F.col("id").alias("vec_id"), F.lower(F.hex("code")).alias("code"), "error", "label_error",
        F.lit(vector_codes.books_sha256(books)).alias("codebooks_sha256"),
    )


def _code_rounds(rounds: int) -> str:
    steps = []
    for t in range(rounds + 1):
        steps.append(f"""
a{t} AS MATERIALIZED (SELECT id, x.part, min(64 * CAST(list_inner_product(x.x, x.x) - 2 * list_inner_product(x.x, c.c)
    + list_inner_product(c.c, c.c) AS BIGINT) + c.entry) AS best FROM x JOIN c{t} c ON x.part = c.part GROUP BY id, x.part)""")
        if t < rounds:
            steps.append(f"""
s{t} AS (SELECT part, entry, i, sum(v) AS s, count(*) AS n FROM (SELECT x.part, best % 64 AS entry, unnest(x.x) AS v,
    unnest(range(len(x.x))) AS i FROM a{t} JOIN x ON a{t}.id = x.id AND a{t}.part = x.part) GROUP BY part, entry, i),
n{t} AS (SELECT part, entry, list(CAST(floor(s / n) AS BIGINT) ORDER BY i) AS c FROM s{t} GROUP BY part, entry),
c{t + 1} AS MATERIALIZED (SELECT o.part, o.entry, coalesce(n.c, o.c) AS c FROM c{t} o LEFT JOIN n{t} n ON o.part = n.part AND o.entry = n.entry)""")
    return ",".join(steps)


ORACLES["op11_vector_codes"] = f"""
WITH v AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, q) - 1 AS id, * FROM ({_INTEGERS})),
p AS (SELECT unnest(range(16)) AS part),
x AS MATERIALIZED (SELECT id, part, q[part * (len(q) // 16) + 1:(part + 1) * (len(q) // 16)] AS x FROM v, p),
c0 AS (SELECT part, id AS entry, x AS c FROM x WHERE id < 64),{_code_rounds(vector_codes.ROUNDS)},
b AS (SELECT sha256(string_agg(k, ',' ORDER BY part, entry)) AS codebooks_sha256
    FROM (SELECT part, entry, array_to_string(c, ',') AS k FROM c{vector_codes.ROUNDS})),
r AS (SELECT id, string_agg(printf('%02x', best % 64), '' ORDER BY part) AS code, CAST(sum(best // 64) AS BIGINT) AS error
    FROM a{vector_codes.ROUNDS} GROUP BY id)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM v JOIN r ON v.id = r.id, b
"""


@query
def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"))


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vec_id, label = F.col("vec_id"), F.col("label")
    moved = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives.mine(embeddings(spark, sf_dir), vec_id % 50 == 0, label_col=moved)


ORACLES["op13_hard_negatives"] = f"""
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, q
    FROM ({_INTEGERS}) WHERE label IS NOT NULL),
s AS (SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, CAST(list_inner_product(a.q, r.q) AS BIGINT) AS score
    FROM v a JOIN v r ON a.vec_id % 50 = 0 AND a.vec_id <> r.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER w AS INT) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT same AND 100 * score BETWEEN 50 * positive_score AND 95 * positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 3
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
