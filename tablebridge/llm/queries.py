"""The contract queries of the corpus operators: thin projections of what the operators return."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablebridge.llm import ann, bpe_codec, decontam, language_id, minhash, pii, quality, secret_scan, substrings, token_counts

#: Production parameters.
VOCABULARY = "byte_bpe_50k.json"
TOKEN_LIMIT = 1024
#: A deployment passes its own secret key to the operator; the query's is fixed so that its result is.
PII_KEY = "tablebridge"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _vocabulary() -> bytes:
    return token_counts.read_vocabulary(public_tokenizers.path(VOCABULARY))


def _fold(column: str, modulus: int) -> F.Column:
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.token_counts(_table(spark, sf_dir, "documents"), _vocabulary())
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row with a null doc_id has a null held_out and takes no part in training."""
    docs = _table(spark, sf_dir, "documents")
    net = language_model(docs.where(_fold("doc_id", 4) != 2))
    return language_id.predict(docs, net).withColumn("held_out", _fold("doc_id", 4) == 2).select("doc_id", "held_out", "lang_pred", "score")


def language_model(docs: DataFrame) -> language_id.ByteNet | None:
    windows, labels = language_id.labelled_windows(docs)
    return language_id.fit(windows, labels) if labels else None


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row with a null doc_id has a null held_out; labels with one take no part in training."""
    docs = _table(spark, sf_dir, "documents")
    model = quality.fit(docs, _table(spark, sf_dir, "labels").where(_fold("doc_id", 3) != 1))
    scored = quality.score(docs, model)
    return scored.select("doc_id", (_fold("doc_id", 3) == 1).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def op4_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(_table(spark, sf_dir, "embeddings"), "id % 100 = 0", k=10)


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.findings(_table(spark, sf_dir, "documents"), path_col="source").where("is_secret")
    return found.select("doc_id", "at", F.length("value").cast("long").alias("n_chars"), F.round("score", 6).alias("score"), F.sha2("value", 256).alias("value_sha256"))


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), minhash.Settings(words=2))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = pii.pseudonymize(_table(spark, sf_dir, "documents").select("doc_id", "text"), PII_KEY)
    counts = [F.size(F.array_remove(F.transform("pii", lambda m: F.when(m["kind"] == kind, 1).otherwise(0)), 0)).cast("long").alias(f"n_{kind}") for kind in pii.PATTERNS]
    return made.select("doc_id", "text", F.size("pii").cast("long").alias("n_replaced"), *counts)


def op8_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_codec.round_trip(_table(spark, sf_dir, "documents"), _vocabulary())


def op9_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(_table(spark, sf_dir, "documents"), 50, digest=True)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_language_id": op2_language_id,
    "op3_quality": op3_quality,
    "op4_neighbours": op4_neighbours,
    "op5_secret_scan": op5_secret_scan,
    "op6_minhash": op6_minhash,
    "op7_pii": op7_pii,
    "op8_bpe_codec": op8_bpe_codec,
    "op9_substrings": op9_substrings,
    "op10_decontamination": op10_decontamination,
}

#: DuckDB SQL where SQL can express the operator. Trained models and tokenizers aren't SQL; string tiling, secrets and
#: pseudonyms are tested against brute force.
ORACLE_SQL: dict[str, str] = {
    "op4_neighbours": """
WITH v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE embedding IS NOT NULL
), d AS (
  SELECT a.vec_id AS query_id, b.vec_id, sqrt(list_sum(list_transform(list_zip(a.e, b.e), lambda p: (p[1] - p[2]) * (p[1] - p[2])))) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS INTEGER) AS rank, vec_id, score
FROM d QUALIFY rank <= 10
""",
    "op6_minhash": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) > 1 THEN list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) ELSE w END) AS g FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
both_ AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (
  SELECT a, b FROM both_ JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)
), edge AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach(doc_id, r) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.doc_id, edge.b FROM reach JOIN edge ON edge.a = reach.r)
SELECT d.doc_id, coalesce(max(n.n), 0) AS n_shingles, min(reach.r) AS component_id, d.doc_id = min(reach.r) AS kept
FROM documents d JOIN reach ON reach.doc_id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id
""",
    "op9_substrings": r"""
WITH w AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
win AS (
  SELECT doc_id, p, array_to_string(w[p : p + 49], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS p FROM w WHERE len(w) >= 50)
), first AS (SELECT k, min(doc_id) AS first FROM win GROUP BY k),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 50)) AS i FROM win JOIN first USING (k) WHERE first.first < doc_id),
word AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM w),
kept AS (
  SELECT word.doc_id, count(*) FILTER (WHERE gone.i IS NOT NULL) AS n_removed, coalesce(string_agg(word.word, ' ' ORDER BY word.i) FILTER (WHERE gone.i IS NULL), '') AS t
  FROM word LEFT JOIN gone ON gone.doc_id = word.doc_id AND gone.i = word.i GROUP BY word.doc_id
)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, coalesce(kept.n_removed, 0) AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256
FROM w LEFT JOIN kept ON kept.doc_id = w.doc_id
""",
}
