"""Rows without ids, equal rows and odd column names: spread over tasks, decided row by row."""

from collections import Counter

import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F

from obligato.llm import line_dedup, packing, secrets, simhash, syncmers, token_files

N = 6000
KINDS = {"a third without id": "IF(id % 3 = 0, NULL, id)", "one id": "7", "equal rows": "IF(id % 3 = 0, NULL, id)"}


def rows(spark, kind):
    text = "IF(id % 3 = 0, 'the same text in many rows', CONCAT('text ', id))" if kind == "equal rows" else "CONCAT('text ', id, ' and more')"
    return spark.range(N).selectExpr(f"CAST({KINDS[kind]} AS LONG) AS doc_id", f"{text} AS text")


def even(counts, times=2.5):
    counts = sorted(counts)
    return counts[-1] <= times * counts[len(counts) // 2]


@pytest.mark.parametrize("kind", KINDS)
def test_token_files_deal_rows_evenly(spark, tmp_path, kind):
    token_files.write_token_files(rows(spark, kind), str(tmp_path))
    files = token_files.TokenFiles(spark, str(tmp_path))
    assert even([r.n for r in files.blocks.groupBy("shard").agg(F.sum(F.size("doc_ids")).alias("n")).collect()])
    found = files.documents().orderBy("start").collect()
    assert len(found) == N and [r.start for r in found][:1] == [0]
    assert all(a.start + a.n_tokens == b.start for a, b in zip(found, found[1:]))
    ids = [r.doc_id for r in found]
    assert ids == sorted(ids, key=lambda i: (i is not None, i))


@pytest.mark.parametrize("kind", KINDS)
def test_packing_salts_are_even(spark, kind, monkeypatch):
    seen = []
    plan = packing.plan
    monkeypatch.setattr(packing, "plan", lambda histogram, capacity: seen.append(dict(histogram)) or plan(histogram, capacity))
    packed = packing.pack_documents(rows(spark, kind)).cache()
    assert sum(seen[0].values()) == packed.count() == N
    ends = packed.groupBy("sequence_id").agg(F.max(F.col("offset") + F.col("length")).alias("end"), F.sum("length").alias("n")).collect()
    assert all(r.end == r.n <= packing.SEQUENCE for r in ends)
    cut = packing.materialized(packing.cut_documents(rows(spark, kind)))
    salted = cut.select(F.pmod(F.monotonically_increasing_id(), F.lit(32)).alias("salt")).groupBy("salt").count()
    assert even([r["count"] for r in salted.collect()])


@pytest.mark.parametrize("kind", ["a third without id", "one id"])
def test_successors_of_hot_ids_are_spread(spark, kind):
    docs = rows(spark, kind).withColumn("text", F.concat(F.substring(F.md5("text"), 1, 12), F.lit(" "), "text")).cache()
    parts = syncmers.in_descending_parts(docs, 16)
    sizes = [r["count"] for r in parts.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) <= N + 40 and even(sizes)
    order = sorted(map(tuple, docs.collect()), key=lambda r: (-(r[0] if r[0] is not None else -1 << 63), r[1]))
    want = {(i, t): order[(k + 1) % N][1] for k, (i, t) in enumerate(order)}
    shown = parts.select(F.spark_partition_id().alias("p"), F.monotonically_increasing_id().alias("n"), "extra", "doc_id", "text").orderBy("n").collect()
    got = {(a.doc_id, a.text): b.text for a, b in zip(shown, shown[1:]) if a.p == b.p and not a.extra}
    assert got == want


TEXT = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty"
NAMES = ["_id", "_keys", "_digest", "_kept", "_row", "row", "digest", "id", "no_id", "n", "t", "key", "fp", "kept keys.x"]


def odd_named(spark, pairs):
    frame = spark.createDataFrame(pairs, "doc_id long, text string")
    return frame.select("*", *[F.concat(F.lit(c), F.col("doc_id").cast("string")).alias(c) for c in NAMES], F.length("text").alias("n_chars"))


def test_near_duplicates_are_decided_row_by_row(spark):
    pairs = [(5, TEXT), (None, TEXT), (None, TEXT), (9, TEXT), (9, TEXT), (None, "only here without an id at all"), (None, "only here without an id at all"),
             (3, "something else entirely, written once"), (3, "something else entirely, written once"), (4, None), (2, ""), (6, "   ")]
    kept = simhash.keep_one_of_each(odd_named(spark, pairs))
    assert kept.columns == odd_named(spark, pairs).columns
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    assert got == sorted([(5, TEXT), (None, "only here without an id at all"), (3, "something else entirely, written once"), (2, "")], key=repr)
    assert {r["_id"] for r in kept.collect()} == {"_id5", None, "_id3", "_id2"}
    # An id that stands with two texts keeps both where they are no near-duplicates.
    two = spark.createDataFrame([(1, TEXT), (1, "quite another text of the same id")], "doc_id long, text string")
    assert simhash.keep_one_of_each(two).count() == 2
    assert simhash.keep_one_of_each(two.limit(0)).count() == 0


def test_a_third_of_equal_rows_does_not_meet_in_one_task(spark):
    copies = spark.range(30_000).selectExpr("CAST(IF(id % 3 = 0, NULL, id) AS LONG) AS doc_id",
                                            "IF(id % 3 = 0, 'the same text in many rows', CONCAT('text ', id, ' is ', id * 7, ' by ', id * 11)) AS text").repartition(8)
    kept = simhash.keep_one_of_each(copies)
    assert "WindowGroupLimit" in kept._jdf.queryExecution().executedPlan().toString()
    assert kept.where("doc_id IS NULL").count() == 1


def test_stages_take_columns_of_any_name(spark):
    line = "A line that stands in very many documents of this table."
    pairs = [(i, f"{line}\nbody {i}") for i in range(4)] + [(None, None), (8, "api_key = 'Zx81kQp0-LmN4rT'")]
    docs = odd_named(spark, pairs)
    lined = line_dedup.rewrite_documents(docs)
    assert lined.schema.simpleString() == docs.schema.simpleString()
    assert Counter(r.text for r in lined.collect()) == Counter(["body 0", "body 1", "body 2", f"{line}\nbody 3", None, pairs[-1][1]])
    assert {r["_keys"] for r in lined.collect()} == {r["_keys"] for r in docs.collect()}
    clean = secrets.redact(docs, secrets.train(docs))
    assert clean.columns == docs.columns and [r.text for r in clean.where("doc_id = 8").collect()] == ["[SECRET]'"]
    assert TaskContext.get() is None
