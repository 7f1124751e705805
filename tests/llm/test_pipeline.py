"""The pipeline against brute force over its own stages' definitions."""

import hashlib
import random
import re

import corpus_pipeline
from pyspark.sql import functions as F
from tablebridge.llm import decontam, language_id, minhash, queries, secret_scan

SF_DIR = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def test_run(spark, library):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    net = queries.language_model(docs.where(queries._fold("doc_id", 4) != 2))
    scorer = language_id.Scorer(net)
    kept = {i: r for i, r in rows.items() if any(map(str.isalpha, r.text)) and scorer.probabilities(language_id.cut_windows(r.text.encode(), net.window)).mean(axis=0)[-1] <= 0.5}
    sets, up = {}, {i: i for i in kept}
    for i, r in kept.items():
        w = WORDS.findall(r.text.translate({k: k + 32 for k in range(65, 91)}))
        sets[i] = frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) or frozenset([tuple(w)])

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in kept:
        for b in kept:
            if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    kept = {i: r for i, r in kept.items() if find(i) == i}
    items = [decontam.token_hashes(r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    clean = {}
    for i, r in kept.items():
        h = decontam.token_hashes(r.text)
        if not any(sum(t[2] for t in decontam.tiles(item, h, 5)) >= 0.8 * len(item) for item in items):
            clean[i] = r
    masked = {r.doc_id: r.text for r in secret_scan.redact(docs, path_col="source").collect()}
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SF_DIR).collect()}
    assert set(got) == set(clean) and len(got) < len(rows)
    for i, r in got.items():
        ids = library.encode(masked[i], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(masked[i].encode()).hexdigest()


def test_stages_keep_columns(spark, odd):
    docs = odd.withColumnRenamed("score", "n_chars").drop("id", "kept")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_DIR)
        assert out.columns == docs.columns, name
        assert stage(spark, docs.where("false"), SF_DIR).count() == 0
    assert minhash.Settings().words == 5 and minhash.Settings().percent == 80


def test_language_stage_rejects_what_is_no_language_it_knows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    r, n = random.Random(3), docs.count()
    junk = ["".join(r.sample(x.text, len(x.text))) for x in docs.limit(40).collect() if len(x.text) > 300]
    junk += ["Все счастливые семьи похожи друг на друга, каждая несчастливая семья несчастлива по-своему. " * 3, "人人生而自由,在尊严和权利上一律平等。" * 6, "1234 5678 !!", None, ""]
    planted = spark.createDataFrame([(10**6 + i, t) for i, t in enumerate(junk)], "doc_id long, text string")
    kept = corpus_pipeline.identify_language(spark, docs.unionByName(planted, allowMissingColumns=True), SF_DIR)
    got = {x.doc_id for x in kept.select("doc_id").collect()}
    assert len([i for i in got if i < 10**6]) >= 0.995 * n and not [i for i in got if i >= 10**6]


def test_null_ids_pass_all_stages(spark, odd):
    docs = odd.withColumnRenamed("score", "n_chars").drop("id", "kept")
    base = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(150)
    rows = base.unionByName(docs.limit(0), allowMissingColumns=True)
    rows = rows.unionByName(base.limit(3).withColumn("doc_id", F.lit(None).cast("long")), allowMissingColumns=True)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        rows = stage(spark, rows, SF_DIR)
    kept = rows.collect()
    assert [x.doc_id for x in kept].count(None) == 3
    assert len(corpus_pipeline.STAGES[-1][1](spark, rows, SF_DIR).where("doc_id is null").collect()) == 3


def test_stages_name_the_operators():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "decontamination", "secret_scan", "bpe"]
