"""Document fingerprints from closed syncmers, and their likeness by positional matching.

A k-mer of code points is a closed syncmer if the smallest hash among its inner s-mers lies at its first or
last place. Whether it is one depends on its own characters only, so equal passages give equal
anchors wherever they stand, and an edit disturbs only the anchors that it touches. A fingerprint
holds all anchors of a text, repeated ones too, with their places, about one in eight code points
whatever the length. Two fingerprints are alike as far as their anchors are common and follow the same
order in both texts; the n-th place of a hash in one text is matched with its n-th place in the other.
"""

from bisect import bisect_left
from itertools import accumulate
from math import nextafter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, functions as F

from obligato.llm.common import arrow_schema, ddl, ids_and_texts, sha256, slices

K, S = 24, 9
#: Characters of fingerprints after which a task hands its rows on.
BATCH_CHARS = 1 << 24
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9))
_LAST_ID = -(1 << 63)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX[1]
    return x ^ (x >> np.uint64(29))


def _window_hashes(points: np.ndarray, size: int) -> np.ndarray:
    """Polynomial hashes of all windows, built from windows of half the size."""
    if size == 1:
        return (points + np.uint64(1)) * _MIX[0]
    half = size // 2
    shorter = _window_hashes(points, half)
    both = shorter[:-half] * _power(half) + shorter[half:]
    return both if size == 2 * half else both[:-1] * _power(1) + (points[size - 1:] + np.uint64(1)) * _MIX[0]


def _power(n: int) -> np.uint64:
    return np.uint64(pow(0x100000001B3, n, 1 << 64))


def _window_minima(x: np.ndarray, size: int) -> np.ndarray:
    done, minima = 1, x
    while done < size:
        step = min(done, size - done)
        minima = np.minimum(minima[:-step], minima[step:])
        done += step
    return minima


def anchors(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (32 bits) and places of all closed syncmers; a text too short for one is an anchor as a whole."""
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
    if not len(points):
        return np.zeros(0, np.uint32), np.zeros(0, np.uint32)
    if len(points) >= K:
        inner = _mixed(_window_hashes(points, S))
        span = K - S + 1
        least = _window_minima(inner, span)
        at = np.flatnonzero((inner[:len(least)] == least) | (inner[span - 1:] == least))
        if len(at):
            return (_mixed(_window_hashes(points, K)[at]) >> np.uint64(32)).astype(np.uint32), at.astype(np.uint32)
    return np.array([xxhash.xxh32_intdigest(text.encode())], np.uint32), np.zeros(1, np.uint32)


def fingerprint(text: str) -> np.ndarray:
    """(anchors, 2): hash and place of all anchors, by place."""
    return np.stack(anchors(text), axis=1)


def as_string(print_: np.ndarray) -> str:
    return print_.astype(">u4").tobytes().hex()


def from_string(print_: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(print_), ">u4").astype(np.uint32).reshape(-1, 2)


def _numbered(print_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each anchor's hash and its number among those of the same hash as one key, ascending, and the anchors' indexes."""
    order = np.argsort(print_[:, 0], kind="stable")
    hashes = print_[order, 0].astype(np.uint64)
    at = np.arange(len(hashes))
    first = np.maximum.accumulate(np.where(np.concatenate(([True], hashes[1:] != hashes[:-1])), at, 0)) if len(at) else at
    return hashes << np.uint64(32) | (at - first).astype(np.uint64), order


def _in_order(places: np.ndarray) -> int:
    """Length of the longest increasing subsequence of distinct values."""
    if (places[1:] > places[:-1]).all():
        return len(places)
    ends: list[int] = []  # of increasing runs of places, by length
    for p in places.tolist():
        i = bisect_left(ends, p)
        ends[i:i + 1] = [p]
    return len(ends)


def _likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    (keys_a, order_a), (keys_b, order_b) = a, b
    if not len(keys_a) or not len(keys_b):
        return float(len(keys_a) == len(keys_b))
    _, in_a, in_b = np.intersect1d(keys_a, keys_b, assume_unique=True, return_indices=True)
    matched = order_b[in_b][np.argsort(order_a[in_a])]
    j = _in_order(matched) / (len(keys_a) + len(keys_b) - len(matched))
    return 2 * j / (1 + j)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """0 to 1: the share of all anchors of the two texts that match in order (Dice).

    Two empty texts are alike (1); an empty and another text are not (0).
    """
    return _likeness(_numbered(a), _numbered(b))


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by the following text's first as many (or all)."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def fingerprint_documents(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fingerprint of every whole text. Null and empty texts have the empty fingerprint; null ids and repeated rows stay."""
    schema = {"doc_id": "long", "fingerprint": "string"}
    out = arrow_schema(schema)

    def run(batches):
        for batch in slices(batches):
            ids, prints, chars = [], [], 0
            for i, t in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text"))):
                ids.append(i)
                prints.append(as_string(fingerprint(t or "")))
                chars += len(prints[-1])
                if chars > BATCH_CHARS:
                    yield pa.RecordBatch.from_pydict({"doc_id": ids, "fingerprint": prints}, schema=out)
                    ids, prints, chars = [], [], 0
            yield pa.RecordBatch.from_pydict({"doc_id": ids, "fingerprint": prints}, schema=out)

    return ids_and_texts(docs, doc_id, text).mapInArrow(run, ddl(schema))


def _text_number(text: Column) -> Column:
    """The first six bytes as a number: texts in order have their numbers in order."""
    return F.conv(F.rpad(F.hex(F.substring(text.cast("binary"), 1, 6)), 12, "0"), 16, 10).cast("double")


def _cuts_of_hot_ids(docs: DataFrame, parts: int) -> dict[int | None, list[float]]:
    """For ids (also NULL) of more rows than two parts should have, numbers of texts at which their rows are cut."""
    counts = docs.groupBy("doc_id").agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    # Fewer than parts / 2 of them. Larger ids than a double tells apart are left whole.
    hot = [r for r in counts.where(F.col("n") * parts > total * 2).select("doc_id", (F.col("n") * parts / total).alias("share")).collect()
           if r.doc_id is None or abs(r.doc_id) < 1 << 53]
    if not hot:
        return {}
    steps = F.array(*[F.lit(i / parts) for i in range(1, parts)])
    chosen = F.col("doc_id").isin([r.doc_id for r in hot if r.doc_id is not None])
    rows = docs.where(F.coalesce(chosen, F.lit(False)) | (F.col("doc_id").isNull() if any(r.doc_id is None for r in hot) else F.lit(False)))
    found = {r.doc_id: r.cuts for r in rows.groupBy("doc_id").agg(F.percentile_approx(_text_number(F.col("text")), steps).alias("cuts")).collect()}
    out = {}
    for r in hot:
        wanted = max(1, round(r.share))
        out[r.doc_id] = sorted({found[r.doc_id][i * (parts - 1) // wanted] for i in range(1, wanted)})
    return out


def in_descending_parts(docs: DataFrame, parts: int) -> DataFrame:
    """Rows (doc_id, text; texts not null) in ranges of descending doc_id, then text, one per partition and sorted, each
    followed by its successor.

    Adds ``extra``: the first row of the next range (after the last: of the first), copied so that every row
    has its successor beside it. Ranges are cut at quantiles of the ids; null ids come last. The rows of an id that has too
    many for one range are cut by their texts' first bytes; rows that are equal there stay together. One shuffle of the texts.
    """
    hot = _cuts_of_hot_ids(docs, parts) if parts > 1 else {}
    ids = docs.select("doc_id").where("doc_id IS NOT NULL")
    cuts = ids.agg(F.percentile_approx("doc_id", [i / parts for i in range(1, parts)], 10_000)).first()[0] if parts > 1 else None
    own = [float(i) for i in hot if i is not None]
    splits = [-float("inf"), *sorted({*map(float, cuts or [0]), *own, *[nextafter(i, float("inf")) for i in own]}), float("inf")]
    # Buckets from the largest ids on, the one without ids last; a hot id has one for itself, of several ranges.
    bounds = list(zip(splits, splits[1:]))[::-1]
    cuts_of = [hot.get(int(a), []) if a in own else [] for a, _ in bounds] + [hot.get(None, [])]
    first = [0, *accumulate(len(c) + 1 for c in cuts_of)]

    def part(rows: DataFrame) -> DataFrame:
        # Cuts are compared as doubles: for very large ids less exact, but still in order.
        placed = Bucketizer(splits=splits, inputCol="_x", outputCol="_bucket", handleInvalid="keep").transform(
            rows.withColumn("_x", F.col("doc_id").cast("double")))
        bucket = F.when(F.col("doc_id").isNull(), len(bounds)).otherwise(len(bounds) - 1 - F.col("_bucket").cast("int"))
        at = F.element_at(F.array(*map(F.lit, first)), bucket + 1)
        if any(cuts_of):
            own_cuts = F.element_at(F.array(*[F.array(*map(F.lit, c)).cast("array<double>") for c in cuts_of]), bucket + 1)
            number = _text_number(F.col("text"))
            at = at + F.when(F.size(own_cuts) > 0, F.size(F.filter(own_cuts, lambda c: c <= number))).otherwise(0)
        return placed.withColumn("part", at).drop("_x", "_bucket")

    order = F.coalesce("doc_id", F.lit(_LAST_ID))
    heads = {r.part: r.head for r in part(docs).groupBy("part").agg(F.max(order).alias("head")).collect()}
    if not heads:
        return docs.select(F.lit(0).alias("part"), F.lit(False).alias("extra"), "*")
    used = sorted(heads)
    before = {p: used[i - 1] for i, p in enumerate(used)}
    of = lambda values: F.element_at(F.array(*[F.lit(values.get(p)) for p in range(first[-1])]), F.col("part") + 1)
    copies = part(docs).where(order == of(heads)).groupBy("part").agg(F.max("doc_id").alias("doc_id"), F.min("text").alias("text"))
    both = part(docs).select("part", F.lit(False).alias("extra"), "doc_id", "text").unionByName(
        copies.select(of(before).cast("int").alias("part"), F.lit(True).alias("extra"), "doc_id", "text"))
    return (both.repartitionById(first[-1], F.col("part"))
            .sortWithinPartitions("extra", F.coalesce("doc_id", F.lit(_LAST_ID)).desc(), "text"))


def compare_with_edits(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, one row per input row.

    The next document is that of the next smaller id (after the last: the first; a lone document
    follows itself). Null texts count as empty, null ids come last, repeated rows of an id follow each
    other in text order; other columns are not read; texts may be of any length; no rows give no rows.
    """
    schema = {"doc_id": "long", "n_chars": "long", "edited_sha256": "string", "fingerprint": "string",
              "edited_fingerprint": "string", "near_edited": "double", "near_next": "double"}
    out = arrow_schema(schema)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def record(rows):
        columns = map(list, zip(*rows)) if rows else ([] for _ in schema)
        return pa.RecordBatch.from_pydict(dict(zip(schema, columns)), schema=out)

    def run(batches):
        held = None  # the row that still waits for its successor
        for batch in slices(batches):
            rows, chars = [], 0
            for i, t, extra in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "extra"))):
                t = t or ""
                own = fingerprint(t)
                keys = _numbered(own)
                if held:
                    last_id, last_text, last, last_keys = held
                    changed = edited(last_text, t)
                    new = fingerprint(changed)
                    rows.append((last_id, len(last_text), sha256(changed.encode()), as_string(last), as_string(new),
                                 _likeness(last_keys, _numbered(new)), _likeness(last_keys, keys)))
                    chars += 16 * (len(last) + len(new))
                    if chars > BATCH_CHARS:
                        yield record(rows)
                        rows, chars = [], 0
                held = None if extra else (i, t, own, keys)
                if extra:  # only the first of the copied rows follows the range
                    break
            yield record(rows)

    rows = ids_and_texts(docs, doc_id, text).withColumn("text", F.coalesce("text", F.lit("")))
    return in_descending_parts(rows, parts).drop("part").mapInArrow(run, ddl(schema))
