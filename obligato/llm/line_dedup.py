"""Lines that repeat across documents go, except in one document, by two Bloom filters.

Each task sets the hashes of its documents' lines in a filter "once", and those it meets again in a filter
"twice". Filters are merged block by block: what is in both "once" filters enters "twice". A line that two
documents share is always in the merged "twice"; few others are. Only lines found there (suspected
repeats) are shuffled, as text, and counted exactly, so that a filter of any size gives the same
result; its size grows with the number of lines up to ``MAX_BITS``, which bounds the broadcast.
"""

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from obligato.llm.common import arrow_schema, ddl, ids_and_texts, map_rows, materialized, sha256, slices, whole_row

MIN_CHARS, MIN_DOCUMENTS = 20, 3
BITS_PER_LINE, MIN_BITS, MAX_BITS = 8, 1 << 16, 1 << 30
BLOCK = 8192  # bytes
_SPACE = b" \t\n\x0b\x0c\r"
_BLOCKS = {"block": "int", "once": "binary", "twice": "binary"}


def line_key(line: bytes) -> bytes:
    return line.strip(_SPACE).lower()


def long_keys(text: str | None, min_chars: int) -> set[bytes]:
    """Distinct keys of at least ``min_chars`` code points."""
    keys = {line_key(line) for line in (text or "").encode().split(b"\n")}
    return {k for k in keys if len(k) >= min_chars and (len(k) >= 4 * min_chars or len(k.decode()) >= min_chars)}


def _places(keys: list[bytes], bits: int) -> tuple[np.ndarray, np.ndarray]:
    h = np.array([xxhash.xxh3_64_intdigest(k) for k in keys], np.uint64)
    return (h & np.uint64(bits - 1)).astype(np.int64), (h >> np.uint64(32) & np.uint64(bits - 1)).astype(np.int64)


def _has(filter_: np.ndarray, places: tuple[np.ndarray, ...]) -> np.ndarray:
    first, second = ((filter_[p >> 3] >> (p & 7).astype(np.uint8)) & 1 for p in places)
    return (first & second).astype(bool)


def _set(filter_: np.ndarray, places: tuple[np.ndarray, ...]) -> None:
    for p in places:
        np.bitwise_or.at(filter_, p >> 3, np.uint8(1) << (p & 7).astype(np.uint8))


def _filters_of_task(texts: Iterator[list[str | None]], bits: int, min_chars: int) -> tuple[np.ndarray, np.ndarray]:
    once, twice = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
    for part in texts:
        seen: dict[bytes, int] = {}
        for text in part:
            for key in long_keys(text, min_chars):
                seen[key] = seen.get(key, 0) + 1
        if seen:
            places = _places(list(seen), bits)
            again = _has(once, places) | (np.fromiter(seen.values(), np.int64) > 1)
            _set(twice, tuple(p[again] for p in places))
            _set(once, places)
    return once, twice


def repeats_filter(docs: DataFrame, min_chars: int = MIN_CHARS, bits: int | None = None) -> np.ndarray:
    """The merged "twice" filter of rows (doc_id, text): at most ``MAX_BITS`` / 8 bytes."""
    if bits is None:
        lines = docs.agg(F.sum(F.length("text") - F.length(F.translate("text", "\n", "")) + 1)).first()[0] or 0
        bits = min(MAX_BITS, max(MIN_BITS, 1 << (BITS_PER_LINE * lines - 1).bit_length() if lines else 0))
    out = arrow_schema(_BLOCKS)

    def row(block: int, once: np.ndarray, twice: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict(
            {"block": [block], "once": [zlib.compress(once.tobytes(), 1)], "twice": [zlib.compress(twice.tobytes(), 1)]}, schema=out)

    def build(batches):
        once, twice = _filters_of_task((part.column("text").to_pylist() for part in slices(batches)), bits, min_chars)
        for block in range(0, -(-len(once) // BLOCK)):
            at = slice(block * BLOCK, (block + 1) * BLOCK)
            if once[at].any():
                yield row(block, once[at], twice[at])

    def merge(batches):
        block, once, twice = None, None, None
        for part in slices(batches):
            for b, o, t in zip(*(part.column(c).to_pylist() for c in _BLOCKS)):
                o, t = (np.frombuffer(zlib.decompress(x), np.uint8) for x in (o, t))
                if b != block:
                    if block is not None:
                        yield row(block, once, twice)
                    block, once, twice = b, o, t
                else:
                    once, twice = once | o, twice | t | (once & o)
        if block is not None:
            yield row(block, once, twice)

    built = docs.select("text").mapInArrow(build, ddl(_BLOCKS))
    merged = built.repartition("block").sortWithinPartitions("block").mapInArrow(merge, ddl(_BLOCKS))
    twice = np.zeros(bits // 8, np.uint8)
    for r in merged.select("block", "twice").toLocalIterator():
        part = np.frombuffer(zlib.decompress(bytes(r.twice)), np.uint8)
        twice[r["block"] * BLOCK:r["block"] * BLOCK + len(part)] = part
    return twice


def text_digest(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def lines_to_drop(docs: DataFrame, min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS, bits: int | None = None) -> DataFrame:
    """doc_id, digest, keys (MD5 digests of the line keys that rows of this id and text lose), of rows (doc_id, text).

    A row's keys are gathered by its id and its text's digest (``text_digest``), so an array never holds more
    than one text's keys, however many rows have no id or the same one.
    """
    shared = docs.sparkSession.sparkContext.broadcast(repeats_filter(docs, min_chars, bits))

    def make():
        twice = shared.value

        def work(rows):
            ids, digests, keys = [], [], []
            for i, text, digest in zip(rows["doc_id"], rows["text"], rows["digest"]):
                own = list(long_keys(text, min_chars))
                keys += (found := [k.decode() for k, hit in zip(own, _has(twice, _places(own, 8 * len(twice)))) if hit] if own else [])
                ids += [i] * len(found)
                digests += [digest] * len(found)
            return {"doc_id": ids, "digest": digests, "key": keys}

        return work

    rows = docs.select("doc_id", "text", text_digest(F.col("text")).alias("digest"))
    suspects = materialized(map_rows(rows, {"doc_id": "long", "digest": "binary", "key": "string"}, make))
    # An id is one document however many rows it has; a row without an id is a document by itself.
    n = F.count_distinct("doc_id") + F.count_if(F.col("doc_id").isNull())
    repeats = suspects.groupBy("key").agg(n.alias("n"), F.max("doc_id").alias("keeper")).where(F.col("n") >= min_documents)
    # Stored, so that the join takes both sides straight from a shuffle and a very common line can be split.
    lost = suspects.join(materialized(repeats), "key").where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    return lost.groupBy("doc_id", "digest").agg(F.collect_set(F.unhex(F.md5("key"))).alias("keys"))


def without(text: str | None, lost: list[bytes] | None) -> tuple[int, int, str]:
    """Lines before, lines dropped, and the other lines."""
    lines = (text or "").encode().split(b"\n")
    if not lost:
        return len(lines), 0, text or ""
    gone = set(lost)
    kept = [line for line in lines if hashlib.md5(line_key(line), usedforsecurity=False).digest() not in gone]
    return len(lines), len(lines) - len(kept), b"\n".join(kept).decode()


def _with_lost_keys(docs: DataFrame, rows: DataFrame, **options) -> DataFrame:
    # Stored, so that the join can split the rows of an id and text that very many rows repeat.
    lost = materialized(lines_to_drop(rows, **options)).select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"), F.col("keys").alias("_keys"))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_id")) & (text_digest(F.col("text")) == F.col("_digest"))
    return docs.join(lost, same, "left").drop("_id", "_digest")


def dedup_lines(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """doc_id, n_lines, n_dropped, text (the lines that stay), one row per input row.

    Null and empty texts are one empty line. Rows of one id are one document, and rows of the largest id all
    keep the line; each row without an id counts as a document but keeps a line only if no row
    with an id has it. Other columns are not read; texts may be of any length; no rows give no rows.
    """
    rows = ids_and_texts(docs, doc_id, text)

    def make():
        def work(part):
            n, dropped, texts = zip(*map(without, part["text"], part["_keys"])) if part["text"] else ((), (), ())
            return {"doc_id": part["doc_id"], "n_lines": list(n), "n_dropped": list(dropped), "text": list(texts)}

        return work

    return map_rows(_with_lost_keys(rows, rows, **options), {"doc_id": "long", "n_lines": "long", "n_dropped": "long", "text": "string"}, make)


def line_digests(docs: DataFrame) -> DataFrame:
    """dedup_lines with the kept text as its SHA-256."""
    rows = ids_and_texts(docs, "doc_id", "text")

    def make():
        def work(part):
            found = list(map(without, part["text"], part["_keys"]))
            return {"doc_id": part["doc_id"], "n_lines": [f[0] for f in found], "n_dropped": [f[1] for f in found],
                    "kept_sha256": [sha256(f[2].encode()) for f in found]}

        return work

    schema = {"doc_id": "long", "n_lines": "long", "n_dropped": "long", "kept_sha256": "string"}
    return map_rows(_with_lost_keys(rows, rows), schema, make)


def rewrite_documents(docs: DataFrame) -> DataFrame:
    """The documents with the lines that stay as their text and n_chars of it; the other columns are unchanged, whatever their names.

    A null text stays null; null ids and repeated rows as in ``dedup_lines``; no rows give no rows.
    """
    # The text travels once, beside the other columns.
    rest = docs.drop("text")
    whole = docs.select(whole_row(rest).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    joined = _with_lost_keys(whole, ids_and_texts(docs, "doc_id", "text"))
    names, others = docs.columns, rest.columns

    def run(batches):
        for part in slices(batches):
            columns = dict(zip(others, part.column("row").flatten()))
            texts = [t if t is None else without(t, k)[2] for t, k in zip(part.column("text").to_pylist(), part.column("_keys").to_pylist())]
            columns["text"] = pa.array(texts, pa.string())
            if "n_chars" in columns:
                columns["n_chars"] = pa.array([t if t is None else len(t) for t in texts], pa.int64()).cast(columns["n_chars"].type)
            yield pa.RecordBatch.from_pydict({name: columns[name] for name in names})

    return joined.select("row", "text", "_keys").mapInArrow(run, docs.schema)
