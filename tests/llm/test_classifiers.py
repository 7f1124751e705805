"""Held-out accuracy and odd rows of the trained operators."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from tablebridge.llm import language_id, quality, queries

SF_DIR = "/root/testdata/sf0.01"


def test_language_is_learned(spark):
    got = queries.op2_language_id(spark, SF_DIR).join(spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == 1000 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)
    held = [r.lang_pred == r.lang for r in got if r.held_out]
    assert np.mean(held) > 0.97


def test_windows_cover_the_text():
    raw = bytes(range(256)) * 3 + b"tail"
    w = language_id.cut_windows(raw, 100)
    assert set(w.ravel().tolist()) == set(raw) and bytes(w[-1])[-4:] == b"tail" and language_id.cut_windows(b"ab", 8).tolist() == [[97, 98] + [32] * 6]
    assert len(w) == -(-len(raw) // 100)


def test_network_tables_equal_filters():
    net = language_id.train(["der die das " * 30, "the of and " * 30] * 4, ["de", "en"] * 4, window=32, epochs=2)
    x = np.frombuffer(b"the die of das and der the of  x" * 2, dtype=np.uint8).reshape(2, 32)
    want = np.concatenate([sum(f[k][x[:, k : k + 32 - w + 1]] for k in range(w)).max(axis=1) for w, f in net.filters.items()], axis=1)
    assert np.allclose(language_id.Scorer(net).pooled(x), want, atol=1e-4)


def test_odd_languages(odd, empty):
    net = language_id.train(["der die das und nicht " * 30, "the of and that with " * 30] * 4, ["de", "en"] * 4)
    got = language_id.predict(odd, net).collect()
    for g, r in zip(got, odd.collect(), strict=True):
        letters = any(c.isalpha() for c in r.text or "")
        assert (g.lang_pred == "und") == (not letters) and (letters or g.score == 0)
    assert language_id.predict(empty, net).count() == 0
    assert {r.lang_pred for r in language_id.predict(odd, None).collect()} == {"und"}
    assert language_id.labelled_windows(empty)[1] == []
    kept = language_id.keep_identified(odd, net)
    assert kept.columns == odd.columns and kept.where("doc_id in (1, 2, 3, 7)").count() == 0 and kept.where("doc_id = 4").count() in (0, 2)
    x, labels = language_id.labelled_windows(odd.withColumn("lang", F.when(F.col("doc_id") == 4, F.lit(None).cast("string")).otherwise(F.col("lang"))))
    assert len(x) == len(labels) <= 4 * 8 and not any(bytes(w).startswith(b"word ") and bytes(w).strip() == b"word" for w in x)
    nulls = odd.where("doc_id is null")
    assert language_id.predict(nulls, net).first()["lang_pred"] != "und" and nulls.select((queries._fold("doc_id", 4) == 2).alias("h")).first()["h"] is None


def test_every_label_is_learned(spark):
    rows = spark.range(900).selectExpr("id as doc_id", "concat('l', id % 300) as lang", "repeat(concat('w', id % 300, ' x '), 20) as text")
    x, labels = language_id.labelled_windows(rows, per_label=3)
    assert len(set(labels)) == 300 and x.shape[1] == 256


def test_long_texts_send_few_windows(spark):
    rows = spark.range(4).selectExpr("id as doc_id", "'en' as lang", "repeat('the of and ', 200000) as text")
    x, labels = language_id.labelled_windows(rows)
    assert len(x) == len(labels) == 16


def test_quality_is_learned(spark):
    got = queries.op3_quality(spark, SF_DIR).join(spark.read.parquet(f"{SF_DIR}/labels.parquet"), "doc_id").where("held_out").collect()
    assert len(got) > 80 and np.mean([r.predicted == r.quality for r in got]) > 0.93
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)


def test_odd_quality(spark, odd, empty):
    labels = spark.createDataFrame([(4, 1), (5, 0), (6, None), (7, 0), (4, 1)], "doc_id long, quality int")
    model = quality.fit(odd, labels)
    got = quality.score(odd, model).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    bias = [r.score for r in got if r.doc_id in (1, 2, 3)]
    assert len(set(bias)) == 1
    assert {r.score for r in quality.score(odd, None).collect()} == {0.5}
    assert quality.fit(odd, labels.where("false")) is None and quality.fit(empty, labels) is None and quality.score(empty, model).count() == 0


def test_sparse_scores_equal_dense_ones():
    texts = ["a b c", "A!! B!! B!!", "x x x x", ""]
    model = quality.train([(*quality.combined(t), k % 2) for k, t in enumerate(texts)], epochs=3)
    for t in texts:
        dense = np.zeros(1 << quality.BITS)
        np.add.at(dense, quality.features(t)[0], quality.features(t)[1])
        assert abs(model.score(t) - 1 / (1 + np.exp(-(dense @ model.weights + model.bias)))) < 1e-9
