"""The quality classifier: its parts against plain versions, the whole by held-out accuracy."""

import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from obligato.llm import quality
from obligato.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_held_out_rows_are_told_apart(spark):
    rows = QUERIES["op13_nbsvm_quality"](spark, SF).collect()
    labels = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{SF}/labels.parquet'").fetchall())
    assert sorted(r.doc_id for r in rows) == list(range(len(rows)))
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1 for r in rows)
    unseen = [r for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean([r.predicted == labels[r.doc_id] for r in unseen]) >= 0.95
    good, bad = ([r.score for r in unseen if labels[r.doc_id] == x] for x in (1, 0))
    assert np.mean([a > b for a in good for b in bad]) >= 0.99


def test_labels_of_held_out_rows_change_nothing(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = quality.learn(docs, labels), quality.learn(docs, turned)
    assert (a.weights == b.weights).all() and (a.slope, a.middle) == (b.slope, b.middle)


def test_ngrams_are_those_of_a_plain_version(monkeypatch):
    def plain(text):
        text, found = text.lower(), {quality.BUCKETS - 1}
        for size in range(2, quality.LONGEST + 1):
            for i in range(len(text) - size + 1):
                code = ord(text[i])
                for c in text[i + 1:i + size]:
                    code = (code * 1_000_003 + ord(c)) % 2**64
                found.add(((code * (2 * size + 1) * 0x9E3779B97F4A7C15) % 2**64 >> 46) % quality._REPEATS)
        words = text.split()
        again = [int(a == b) for a, b in zip(words, words[1:])]
        for size in range(1, quality.PAIRS + 1):
            for i in range(len(again) - size + 1):
                found.add(quality._REPEATS + (1 << size) + int("".join(map(str, again[i:i + size])), 2))
        return sorted(found)

    ngrams = quality.Ngrams()
    texts = ["", "a", "ab", "Der Der der die 日本語 \U0001f389 x x x x y y", "längerer Text " * 50]
    for stretch in (1 << 20, 5):
        monkeypatch.setattr(quality, "STRETCH", stretch)
        assert [ngrams(t).tolist() for t in texts] == [plain(t) for t in texts]
    assert ngrams(None).tolist() == [quality.BUCKETS - 1]


def test_dual_coordinate_descent_reaches_the_least_loss():
    dice = np.random.default_rng(1)
    rows = [np.sort(dice.choice(12, 4, replace=False)) for _ in range(60)]
    signs, scale, cost = np.where(dice.random(60) < 0.5, 1.0, -1.0), dice.normal(size=12), np.full(60, 0.7)
    x = np.zeros((60, 12))
    for i, r in enumerate(rows):
        x[i, r] = scale[r] / np.sqrt((scale[r] ** 2).sum())

    def loss(w):
        return (w @ w) / 2 + (cost * np.maximum(0, 1 - signs * (x @ w))).sum()

    weights = quality.fit_hinge(rows, signs, scale, cost, epochs=5000, tolerance=1e-9)
    assert loss(weights) <= min(loss(weights + dice.normal(scale=s, size=12)) for s in (0.3, 0.03, 0.003) for _ in range(300)) + 1e-3


def test_log_count_ratios():
    texts = [("ab", True), ("abc", True), ("ab", False), (None, False), ("xy", False)] * 3
    ngrams = quality.Ngrams()
    ratios = quality.log_count_ratios([ngrams(t) for t, _ in texts], np.array([g for _, g in texts]))
    shared, good, bad = (next(iter(set(ngrams(t).tolist()) - set(ngrams(u).tolist()) - {quality.BUCKETS - 1}))
                         for t, u in (("ab", ""), ("bc", ""), ("xy", "")))
    n_good, n_bad = quality.BUCKETS + 18, quality.BUCKETS + 15  # with one for every bucket
    assert np.allclose(ratios[[shared, good, bad]], np.log([7 / n_good, 4 / n_good, 1 / n_good]) - np.log([4 / n_bad, 1 / n_bad, 4 / n_bad]))


def test_the_sample_is_bounded_and_drawn_from_both_classes(spark):
    docs = spark.range(20_000).selectExpr("id AS doc_id", "CONCAT('text ', id) AS text").union(
        spark.range(5_000).selectExpr("3 AS doc_id", "CONCAT('text 3 again ', id) AS text"))
    labels = spark.range(20_000).selectExpr("id AS doc_id", "CAST(id % 10 > 0 AS INT) AS quality")
    rows, many = quality.labelled(docs, labels, 300)
    drawn = [r.good for r in rows.collect()]
    assert 200 < sum(drawn) < 400 and 200 < len(drawn) - sum(drawn) < 400
    assert sum(many.values()) == sum(zlib.crc32(str(i).encode()) % 5 > 0 for i in range(20_000))
    rows, _ = quality.labelled(docs, labels.where("doc_id = 3"), 300)
    assert [r.text for r in rows.collect()] == ["text 3"] * (zlib.crc32(b"3") % 5 > 0)


@pytest.mark.parametrize("kept", ["quality IS NULL", "quality = 1", "false"])
def test_missing_classes_and_tables(spark, kept):
    docs = spark.createDataFrame([(i, None if i % 3 else "some text", "en", 0.5, 1) for i in range(20)] + [(None, "x", "en", 0.5, 1)] * 2,
                                 "doc_id long, text string, lang string, score double, predicted int")
    labels = spark.createDataFrame([(i, 1) for i in range(20)] + [(None, 0), (3, None)], "doc_id long, quality int")
    model = quality.learn(docs, labels.where(kept))
    rows = quality.score(docs, model).collect()
    assert len(rows) == 22 and len({r.score for r in rows}) == 1 and [r.held_out for r in rows if r.doc_id is None] == [True, True]
    assert rows[0].score == (0.5 if kept != "quality = 1" else pytest.approx(1, abs=0.1))
    assert quality.score(docs.limit(0), model).count() == 0


def test_repeated_and_torn_labels(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(1, 5)] + [(1, "text 1"), (4, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 1), (1, 0), (2, 0), (2, 1), (3, 0), (3, None), (4, 0), (9, 1)], "doc_id long, quality int")
    rows, many = quality.labelled(docs, labels)
    got = sorted((r.text, r.good) for r in rows.collect())
    known = {1: True, 2: True, 3: False, 4: False, 9: True}
    used = {i: g for i, g in known.items() if zlib.crc32(str(i).encode()) % 5}
    assert got == [(f"text {i}", g) for i, g in used.items() if i < 9]
    assert many == {g: sum(x == g for x in used.values()) for g in (False, True)}
