"""Near-duplicates by SimHash, with pigeonring filtering.

Distinct fingerprints are cut into d + 1 segments on a ring (d: the largest bit distance of a link). By the
pigeonring principle, two fingerprints within d bits have a start segment from which every chain of
consecutive segments stays within its proportional budget: the first l segments together differ
in at most l * d / (d + 1) bits. The first segment must then be equal, which is the join key; the
longer chains prune candidates before the full Hamming check.

A segment value shared by more than ``BUCKET`` distinct fingerprints (a large group of near copies) is
never paired out. Its fingerprints meet in keys instead: each one emits itself with up to
ceil(d / 2) bits flipped, and shares a key with exactly the fingerprints it links to; linking each key's
members to its smallest gives the same components with rows in proportion to the members.
"""

from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from obligato.llm.common import ids_and_texts, map_rows, materialized, whole_row
from obligato.llm.components import connected_components

SHINGLE_WORDS, MAX_DISTANCE, SEED = 3, 2, 42
BUCKET = 64
_COUNTED_AT_ONCE = 1 << 15


def fingerprint(text: str | None, words_per_shingle: int = SHINGLE_WORDS) -> int:
    """64 majority bits over the shingles' XXH64, repeats included; 0 for a text without words."""
    # bytes.lower and bytes.split know only ASCII letters and the white space 09-0D and 20.
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined, digest, k = b" ".join(words), xxhash.xxh64_intdigest, words_per_shingle
    if len(words) < k:
        hashes = [digest(joined, SEED)]
    else:
        ends = np.cumsum([len(w) + 1 for w in words])
        starts = np.concatenate(([0], ends[:-1])).tolist()
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, (ends[k - 1:] - 1).tolist())]
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), _COUNTED_AT_ONCE):
        h = np.array(hashes[i:i + _COUNTED_AT_ONCE], "<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(h, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, words_per_shingle: int = SHINGLE_WORDS, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fp (the 64 bits as a long)."""

    def make():
        return lambda rows: {"doc_id": rows["doc_id"],
                             "fp": [f - (f >> 63 << 64) for f in (fingerprint(t, words_per_shingle) for t in rows["text"])]}

    return map_rows(ids_and_texts(docs, doc_id, text), {"doc_id": "long", "fp": "long"}, make)


def _segments(parts: int) -> list[tuple[int, int]]:
    """(shift, width) of each segment."""
    cuts = [64 * i // parts for i in range(parts + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _segment(column: str, shift: int, width: int) -> str:
    return f"(shiftrightunsigned({column}, {shift}) & {(1 << width) - 1}L)" if width < 64 else column


def links(distinct: DataFrame, max_distance: int = MAX_DISTANCE, bucket: int = BUCKET) -> DataFrame:
    """Edges (u, v) between distinct fingerprints whose components are those of all links within the distance."""
    d, parts = max_distance, max_distance + 1
    segments = _segments(parts)
    keyed = distinct.select("fp", F.posexplode(F.array(*[F.expr(_segment("fp", *s)) for s in segments])).alias("i", "key"))
    sizes = keyed.groupBy("i", "key").agg(F.count("*").alias("n")).where("n > 1")
    keyed = materialized(keyed.join(sizes, ["i", "key"]))

    small = keyed.where(F.col("n") <= bucket).select("i", "key", "fp")
    pairs = small.withColumnRenamed("fp", "u").join(small.withColumnRenamed("fp", "v"), ["i", "key"]).where("u < v")
    differ = [f"bit_count({_segment('(u ^ v)', *s)})" for s in segments]
    chains = F.lit(False)
    for i in range(parts):
        ring = [differ[(i + step) % parts] for step in range(parts)]
        within = [F.expr(" + ".join(ring[:n])) <= n * d // parts for n in range(2, parts)]
        chain = F.col("i") == i
        for condition in within:
            chain = chain & condition
        chains = chains | chain
    near = pairs.where(chains).where(F.expr("bit_count(u ^ v)") <= d).select("u", "v")

    crowded = keyed.where(F.col("n") > bucket).select("fp").distinct()
    return near.unionByName(_star_links(crowded, d))


def _star_links(distinct: DataFrame, d: int) -> DataFrame:
    low, high = d // 2, d - d // 2
    flips = [(sum(1 << b for b in bits), n <= low) for n in range(high + 1) for bits in combinations(range(64), n)]
    masks = F.array(*[F.struct(F.lit(m - (m >> 63 << 64)).alias("mask"), F.lit(near).alias("near")) for m, near in flips])
    keys = distinct.select("fp", F.explode(masks).alias("m")).select("fp", F.expr("fp ^ m.mask").alias("key"), "m.near")
    # Two that share a key, one of them within the lower number of flips, are at most d bits apart, and all such pairs share one.
    centres = keys.groupBy("key").agg(F.min(F.when(F.col("near"), F.col("fp"))).alias("u"), F.count("*").alias("n"))
    return keys.join(centres.where("n > 1"), "key").where("u <> fp").select("u", F.col("fp").alias("v"))


def near_duplicates(docs: DataFrame, words_per_shingle: int = SHINGLE_WORDS, max_distance: int = MAX_DISTANCE, *,
                    doc_id: str = "doc_id", text: str = "text", bucket: int = BUCKET) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (the smallest doc_id reachable by links), one row per input row.

    Null and empty texts have fingerprint 0 and link like any other. A null id never names a component
    that has another id. Repeated rows are copies. Other columns are not read; texts may be of any length;
    no rows give no rows. Copies are joined by their common fingerprint, never in pairs.
    """
    prints = materialized(fingerprints(docs, words_per_shingle, doc_id=doc_id, text=text))
    distinct = materialized(prints.groupBy("fp").agg(F.min("doc_id").alias("first")))
    joined = connected_components(links(distinct.select("fp"), max_distance, bucket)).withColumnRenamed("node", "fp")
    named = distinct.join(joined, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    smallest = named.groupBy("component").agg(F.min("first").alias("component_id"))
    named = materialized(named.join(smallest, "component").select("fp", "component_id"))
    return prints.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one_of_each(docs: DataFrame, words_per_shingle: int = SHINGLE_WORDS, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """The documents, all columns unchanged, with one row of each group of near-duplicates: that of the smallest doc_id.

    Rows are decided one by one: of rows of one id the least by its text's digest stays, of equal rows (id and text) any one,
    and a row without an id only where its group has no id at all. Null and empty texts are near-duplicates of each other;
    columns may have any name; no rows give no rows. One shuffle of the texts, before which a task keeps one of its equal rows.
    """
    digest = F.md5(F.coalesce("text", F.lit("")).cast("binary"))

    def make():
        return lambda rows: {"doc_id": rows["doc_id"], "digest": rows["digest"],
                             "fp": [f - (f >> 63 << 64) for f in (fingerprint(t, words_per_shingle) for t in rows["text"])]}

    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", digest.alias("digest"))
    prints = materialized(map_rows(ids, {"doc_id": "long", "digest": "string", "fp": "long"}, make))
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), F.coalesce("doc_id", F.lit(0)).alias("id"), "digest")
    distinct = materialized(prints.groupBy("fp").agg(F.min(place).alias("first")))
    joined = connected_components(links(distinct.select("fp"), max_distance)).withColumnRenamed("node", "fp")
    named = distinct.join(joined, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    kept = named.groupBy("component").agg(F.min("first").alias("first")).select("first.*")

    keys = ["no_id", "id", "digest"]
    rows = docs.select(whole_row(docs).alias("row"), F.col("doc_id").isNull().alias("no_id"),
                       F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"), digest.alias("digest"))
    once = rows.withColumn("n", F.row_number().over(Window.partitionBy(*keys).orderBy("digest"))).where("n = 1")
    return once.join(kept, keys, "left_semi").select(*[F.col("row")[c].alias(c) for c in docs.columns])
