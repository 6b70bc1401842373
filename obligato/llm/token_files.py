"""Token-id files: one zstandard frame per document, under one shared dictionary.

Layout of a set of files (Parquet as container, so that any store Spark reaches can hold it):

* ``dictionary``: one row with the shared dictionary, its hash and the bytes per id (2 or 4);
* ``blocks``: rows in ascending doc_id order, each with up to ``BLOCK_DOCUMENTS`` documents: the
  dictionary's hash, shard and block number, doc ids, token counts, the offset index and the payload.

The dictionary is trained on the id arrays of a bounded sample of documents (``SAMPLE_DOCUMENTS``,
the first ``SAMPLE_BYTES`` of each); it decides only how small the frames are. A short document is read
by its offsets, without decompressing its neighbours.
"""

import functools
import hashlib
import os
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from obligato.llm.common import Remembered, arrow_schema, encoded_apart, ddl, ids_and_texts, map_rows, slices

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

WORD_VOCABULARY = "word_bpe_49k.json"
END_ID = 1
SAMPLE_DOCUMENTS, SAMPLE_BYTES, DICTIONARY_BYTES = 400, 8192, 65536
BLOCK_DOCUMENTS, BLOCK_BYTES = 1000, 1 << 20
FIRST_CHARS = 32
REMEMBERED_WORDS = 500_000
_LETTER, _MARK, _SPACE = (np.isin(np.arange(256), list(x)) for x in (b"abcdefghijklmnopqrstuvwxyz", b".,;:!?", b" \t\n\x0b\x0c\r"))

_BLOCKS = {"dict_hash": "string", "shard": "int", "block": "int", "first_doc": "long", "last_doc": "long",
           "doc_ids": "array<long>", "n_tokens": "array<long>", "offsets": "array<long>", "payload": "binary"}


class WordBpe:
    """A vocabulary that drops white space and case: words are encoded once each and their ids joined."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_file(path)
        self._library.no_truncation()
        self._library.no_padding()
        self._plain = Tokenizer.from_file(path)
        self._plain.normalizer = None
        self.id_bytes = 2 if self._library.get_vocab_size() <= 1 << 16 else 4
        self._remembered = Remembered(self._encode_words, REMEMBERED_WORDS)

    def encode_many(self, texts: list[str | None], end: int) -> list[bytes]:
        """Each text's ids and the end id, as little-endian unsigned integers of ``id_bytes``; null counts as empty."""
        kind, found = f"<u{self.id_bytes}", self._remembered.ids(map(_words, texts))
        last = np.array([end], kind).tobytes()
        return [ids.astype(kind).tobytes() + last for ids in found]


    def _encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Words of small ASCII letters need no normalizing."""
        plain = np.array([w.isascii() and w.islower() for w in words], bool)
        flat, lengths = np.zeros(0, np.uint32), np.zeros(len(words), np.int64)
        starts = np.zeros(len(words), np.int64)
        for library, chosen in ((self._plain, np.flatnonzero(plain)), (self._library, np.flatnonzero(~plain))):
            if len(chosen):
                ids, lengths[chosen] = encoded_apart(library, [words[i] for i in chosen.tolist()])
                starts[chosen] = len(flat) + np.cumsum(lengths[chosen]) - lengths[chosen]
                flat = np.concatenate((flat, ids))
        after = np.cumsum(lengths)
        return flat[np.repeat(starts - after + lengths, lengths) + np.arange(after[-1])], lengths


def _words(text: str | None) -> list[bytes]:
    """The text's words; in plain texts without their case and with the mark after a word as a word, so that fewer differ.

    Neither changes the ids, as the vocabulary knows no case and a mark after a letter is a token of its own. Texts
    with a bracket (special tokens know their case) or a combining mark (which may join a letter) stay as they are.
    """
    data = (text or "").encode()
    if not (b"<" in data or b"\xcc" in data or b"\xcd" in data):
        b = np.frombuffer(data.lower() + b" ", np.uint8)
        marks = np.flatnonzero(_LETTER[b[:-2]] & _MARK[b[1:-1]] & _SPACE[b[2:]]) + 1
        data = np.insert(b, marks, ord(" ")).tobytes()
    return data.split()


@functools.cache
def word_bpe(path: str) -> WordBpe:
    return WordBpe(path)


def _hash(dictionary: bytes) -> str:
    return hashlib.sha256(dictionary).hexdigest()[:16]


def _codec(kind, dictionary: bytes, **options):
    if not dictionary:
        return kind(**options)
    shared = zstandard.ZstdCompressionDict(dictionary)
    if "level" in options:
        shared.precompute_compress(**options)  # else each frame would digest the dictionary again
    return kind(dict_data=shared, **options)


def train_dictionary(docs: DataFrame, path: str, end: int) -> bytes:
    """Trained on the sample of documents with the smallest id hashes; empty if there is too little to learn from."""
    hashed = docs.select("doc_id", F.xxhash64("doc_id").alias("h")).orderBy("h", "doc_id").limit(SAMPLE_DOCUMENTS)
    chosen = [r.doc_id for r in hashed.collect() if r.doc_id is not None]

    def make():
        bpe = word_bpe(path)
        return lambda rows: {"ids": [x[:SAMPLE_BYTES] for x in bpe.encode_many(rows["text"], end)]}

    # Repeated rows of a sampled id could be many: the sample keeps its bound.
    sample = map_rows(docs.where(F.col("doc_id").isin(chosen)), {"ids": "binary"}, make).limit(SAMPLE_DOCUMENTS)
    arrays = [bytes(r.ids) for r in sample.collect()]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, arrays).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def write_token_files(docs: DataFrame, folder: str, path: str | None = None, *, end: int = END_ID, doc_id: str = "doc_id",
                      text: str = "text") -> None:
    """Writes the ids of all whole texts in ascending doc_id order.

    Null and empty texts are written as the end id alone; null ids come first; repeated rows are
    written each (equal ids by their texts' first ``FIRST_CHARS``, then by hash); other columns are not read; an empty table gives files without
    blocks. Rows are dealt by doc_id ranges, so each task streams its share and holds one block.
    """
    path = path or public_tokenizers.path(WORD_VOCABULARY)
    spark, docs = docs.sparkSession, ids_and_texts(docs, doc_id, text)
    dictionary = train_dictionary(docs, path, end)
    dict_hash, id_bytes = _hash(dictionary), word_bpe(path).id_bytes
    spark.createDataFrame([(dict_hash, bytearray(dictionary), id_bytes)], "dict_hash string, dictionary binary, id_bytes int") \
        .coalesce(1).write.parquet(f"{folder}/dictionary")
    out = arrow_schema(_BLOCKS)

    def pack(batches):
        bpe, codec, shard = word_bpe(path), _codec(zstandard.ZstdCompressor, dictionary, level=3), TaskContext.get().partitionId()
        ids, counts, frames, held, block = [], [], [], 0, 0

        def flush():
            offsets = np.concatenate(([0], np.cumsum([len(f) for f in frames]))).tolist()
            row = [dict_hash, shard, block, ids[0], ids[-1], ids, counts, offsets, b"".join(frames)]
            return pa.RecordBatch.from_pydict({name: [value] for name, value in zip(_BLOCKS, row)}, schema=out)

        for part in slices(batches):
            rows = part.to_pydict()
            for i, x in zip(rows["doc_id"], bpe.encode_many(rows["text"], end)):
                ids.append(i)
                counts.append(len(x) // id_bytes)
                frames.append(codec.compress(x))
                held += len(frames[-1])
                if held >= BLOCK_BYTES or len(ids) == BLOCK_DOCUMENTS:
                    yield flush()
                    ids, counts, frames, held, block = [], [], [], 0, block + 1
        if ids:
            yield flush()

    # Rows of one id, or without one, are dealt by the beginnings of their texts, and equal rows by their places.
    keys = {"first": F.substring("text", 1, FIRST_CHARS), "hash": F.xxhash64("text"), "place": F.monotonically_increasing_id()}
    dealt = docs.withColumns(keys).repartitionByRange("doc_id", *keys)
    ordered = dealt.sortWithinPartitions("doc_id", *keys).select("doc_id", "text")
    ordered.mapInArrow(pack, ddl(_BLOCKS)).write.option("compression", "none").parquet(f"{folder}/blocks")


class TokenFiles:
    """Reads a set of files; the dictionary (at most ``DICTIONARY_BYTES``) travels with the tasks."""

    def __init__(self, spark: SparkSession, folder: str):
        head = spark.read.parquet(f"{folder}/dictionary").first()
        self._dictionary, self._hash, self._id_bytes = bytes(head.dictionary), head.dict_hash, head.id_bytes
        if _hash(self._dictionary) != self._hash:
            raise ValueError("the dictionary does not fit its hash")
        # Declared: an empty set of files has no schema of its own to read.
        self.blocks = spark.read.schema(ddl(_BLOCKS)).parquet(f"{folder}/blocks")

    def _each(self, blocks: DataFrame, schema: dict[str, str], answer, wanted: frozenset | None = None) -> DataFrame:
        """One row per document: ``answer(doc_id, shard, block, start in the block, ids as unsigned 32-bit)``."""
        dictionary, dict_hash, id_bytes, out = self._dictionary, self._hash, self._id_bytes, arrow_schema(schema)

        def run(batches):
            codec = _codec(zstandard.ZstdDecompressor, dictionary)
            for part in slices(batches, 1):
                row = {name: values[0] for name, values in part.to_pydict().items()}
                if row["dict_hash"] != dict_hash:
                    raise ValueError("a block was written with another dictionary")
                rows, start, payload = [], 0, memoryview(row["payload"])
                for i, n, a, b in zip(row["doc_ids"], row["n_tokens"], row["offsets"], row["offsets"][1:]):
                    if wanted is None or i in wanted:
                        ids = np.frombuffer(codec.decompress(payload[a:b]), f"<u{id_bytes}")
                        rows.append(answer(i, row["shard"], row["block"], start, ids.astype("<u4")))
                    start += n
                columns = zip(*rows) if rows else [()] * len(schema)
                yield pa.RecordBatch.from_pydict(dict(zip(schema, map(list, columns))), schema=out)

        return blocks.mapInArrow(run, ddl(schema))

    def documents(self) -> DataFrame:
        """doc_id, start (ids of all documents before it), n_tokens, ids_crc32, read back from the frames."""
        schema = {"doc_id": "long", "shard": "int", "block": "int", "at": "long", "n_tokens": "long", "ids_crc32": "long"}
        rows = self._each(self.blocks, schema, lambda i, shard, block, at, ids: (
            i, shard, block, at, len(ids), zlib.crc32(ids.tobytes())))
        return rows.join(self._block_starts(), ["shard", "block"]).select(
            "doc_id", (F.col("at") + F.col("block_start")).alias("start"), "n_tokens", "ids_crc32")

    def _block_starts(self) -> DataFrame:
        """Where each block starts: within its shard, and all shards before it (one row per shard in that last step)."""
        totals = self.blocks.select("shard", "block", F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
        shards = totals.groupBy("shard").agg(F.sum("n").alias("n")).select(
            "shard", F.coalesce(F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("first"))
        inside = F.sum("n").over(Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
        return totals.select("shard", "block", F.coalesce(inside, F.lit(0)).alias("inside")).join(shards, "shard").select(
            "shard", "block", (F.col("first") + F.col("inside")).alias("block_start"))

    def fetch(self, doc_ids: list[int]) -> DataFrame:
        """doc_id, ids of a few documents: other blocks are pruned by their id range, other frames are not decompressed."""
        near = F.lit(False)
        for i in doc_ids:
            near = near | (F.col("last_doc") >= i) & (F.col("first_doc").isNull() | (F.col("first_doc") <= i))  # null ids come first
        schema = {"doc_id": "long", "ids": "array<long>"}
        return self._each(self.blocks.where(near), schema, lambda i, shard, block, at, ids: (i, ids.tolist()), frozenset(doc_ids))
