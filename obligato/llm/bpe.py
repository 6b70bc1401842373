"""Byte-level BPE by forced-boundary splitting, and its inverse.

A byte pair that occurs inside no vocabulary token can never be merged, so every place where such a
pair stands is a certain token boundary. Texts are cut there, fragments are encoded independently
(each distinct fragment once) and the ids are concatenated. Some certain boundaries are left alone,
because a cut there would change how the pre-tokenizer sees the neighbours:

* after white space: ``\\s+(?!\\S)`` looks at the character that follows;
* before an apostrophe: a contraction such as ``'s`` must not become the start of a fragment;
* inside a character: fragments must be text.
"""

import functools
import json
import os

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame

from obligato.llm.common import Remembered, encoded_apart, ids_and_texts, map_rows, sha256

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

BYTE_VOCABULARY = "byte_bpe_50k.json"

#: Distinct fragments remembered by a Python worker; the memory is emptied when it is full.
REMEMBERED_FRAGMENTS = 200_000

# Last bytes of the white-space characters beyond ASCII, and the bytes before those.
_WIDE_SPACE_ENDS = [0x85, 0xA0, *range(0x80, 0x8B), 0xA8, 0xA9, 0xAF, 0x9F]
_WIDE_SPACE_STARTS = [0xC2, 0x9A, 0x80, 0x81]
_WIDE_ENDS, _WIDE_STARTS = (np.isin(np.arange(256), x) for x in (_WIDE_SPACE_ENDS, _WIDE_SPACE_STARTS))
# The bytes that byte-level vocabularies show as themselves; the others follow from code point 256 on.
_SHOWN_BYTES = [*range(33, 127), *range(161, 173), *range(174, 256)]


@functools.cache
def _byte_of_symbol() -> dict[str, int]:
    hidden = [b for b in range(256) if b not in _SHOWN_BYTES]
    return {chr(b): b for b in _SHOWN_BYTES} | {chr(256 + n): b for n, b in enumerate(hidden)}


class ByteBpe:
    """Encoder and decoder for one byte-level vocabulary file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, "rb") as file:
            added = {t["id"]: t["content"].encode() for t in json.load(file)["added_tokens"]}
        self._library = Tokenizer.from_file(path)
        self._library.no_truncation()
        self._library.no_padding()
        symbols = _byte_of_symbol()
        vocabulary = self._library.get_vocab(with_added_tokens=True)
        self.token_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.token_bytes[i] = added[i] if i in added else bytes(map(symbols.__getitem__, token))
        self._cut = self._certain_cuts()
        self._remembered = Remembered(lambda fragments: encoded_apart(self._library, fragments), REMEMBERED_FRAGMENTS)

    def _certain_cuts(self) -> np.ndarray:
        """cut[a * 256 + b]: whether a text may be cut between the bytes a and b."""
        cut = np.ones((256, 256), bool)
        for token in self.token_bytes:
            b = np.frombuffer(token, np.uint8)
            cut[b[:-1], b[1:]] = False
        cut[[*range(9, 14), *range(0x1C, 0x21)], :] = False
        cut[:, ord("'")] = False
        cut[:, 0x80:0xC0] = False
        return cut.ravel()

    def fragments(self, data: bytes) -> list[bytes]:
        if len(data) < 2:
            return [data] if data else []
        b = np.frombuffer(data, np.uint8)
        at = np.flatnonzero(self._cut[b[:-1].astype(np.uint16) << 8 | b[1:]]) + 1
        wide = _WIDE_ENDS[b[at - 1]] & _WIDE_STARTS[b[at - 2]] & (at > 1)
        at = at[~wide].tolist()
        return [data[i:j] for i, j in zip([0, *at], [*at, len(data)])]

    def encode_many(self, texts: list[str | None]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers; a null text counts as empty."""
        found = self._remembered.ids(self.fragments((t or "").encode()) for t in texts)
        return [ids.astype("<u4", copy=False).tobytes() for ids in found]

    def decode(self, ids: bytes) -> str:
        tokens = self.token_bytes
        return b"".join([tokens[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")


@functools.cache
def byte_bpe(path: str) -> ByteBpe:
    """One encoder per Python worker."""
    return ByteBpe(path)


def encode_documents(docs: DataFrame, path: str | None = None, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ids (binary: little-endian unsigned 32-bit integers), one row per input row.

    Whole texts of any length. Null and empty texts give no ids; a null doc_id is kept; repeated rows
    are encoded each; other columns are not read, so none can clash; no rows give no rows. Special
    strings inside a text become their special token, as by the library's default.
    """
    path = path or public_tokenizers.path(BYTE_VOCABULARY)

    def make():
        bpe = byte_bpe(path)
        return lambda rows: {"doc_id": rows["doc_id"], "ids": bpe.encode_many(rows["text"])}

    return map_rows(ids_and_texts(docs, doc_id, text), {"doc_id": "long", "ids": "binary"}, make)


def decode_documents(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, text of rows (doc_id, ids); null ids give an empty text. Ids that end inside a character give U+FFFD there."""
    path = path or public_tokenizers.path(BYTE_VOCABULARY)

    def make():
        bpe = byte_bpe(path)
        return lambda rows: {"doc_id": rows["doc_id"], "text": [bpe.decode(ids or b"") for ids in rows["ids"]]}

    return map_rows(encoded.select("doc_id", "ids"), {"doc_id": "long", "text": "string"}, make)


def roundtrip_digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Encodes, then decodes from the ids alone; digests of both, in one pass over the texts."""
    path = path or public_tokenizers.path(BYTE_VOCABULARY)
    schema = {"doc_id": "long", "n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string"}

    def make():
        bpe = byte_bpe(path)

        def work(rows):
            ids = bpe.encode_many(rows["text"])
            return {"doc_id": rows["doc_id"], "n_tokens": [len(x) // 4 for x in ids], "ids_sha256": [sha256(x) for x in ids],
                    "decoded_sha256": [sha256(bpe.decode(x).encode()) for x in ids]}

        return work

    return map_rows(ids_and_texts(docs, "doc_id", "text"), schema, make)
