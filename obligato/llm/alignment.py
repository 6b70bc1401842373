"""Alignment of two tokenizers, with corpus-wide counts of linked token pairs by external spill counting.

A text's tokens under two tokenizers are cut into groups where tokens of both end at the same byte; every
token of one side is linked with every token of the other side in its group. How many documents hold a
pair linked is counted over the whole corpus in four steps, each bounded in memory:

1. Tasks link the tokens of their documents and write runs (``RUN_DOCUMENTS`` and ``RUN_LINKS`` bound one):
   the run's pairs with their documents, radix-partitioned by the first side's id, sorted by first id, second
   id and document, and compressed with zstandard.
2. Per radix, a heap merges the pair counts of up to ``FAN_IN`` runs on average, first ids in order, in as
   many rounds as there are runs for. A run holds a pair once with its number of documents, so a frequent
   id is no larger than its distinct pairs. When an id's last pair is merged, its maximum is known.
3. Every run of a radix meets the counts of the radix and gives each of its documents its share.
4. The shares of a run come together with the run's documents.

Equal rows (id and text) are one document: it is worked and counted once and returned as often as it stands.
"""

import functools
import hashlib
import heapq
import re
import uuid
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from obligato.llm.bpe import BYTE_VOCABULARY, REMEMBERED_FRAGMENTS, ByteBpe
from obligato.llm.common import SLICE_ROWS, Remembered, arrow_schema, ddl, encoded_apart, ids_and_texts, shared_folder, slices

PIECE_VOCABULARY = "piece_bpe_32k.model"
RUN_DOCUMENTS, RUN_LINKS = 8192, 4_000_000  # the first one below 2^16
RADICES, FAN_IN = 64, 256
#: Bytes of words and fragments that a Python worker remembers, beside their number.
REMEMBERED_BYTES = 1 << 26
#: Groups with more links than this are linked by their distinct ids.
WIDE = 4096

_BLANK = "▁"  # a fixed value of the vocabulary: how pieces show a blank

_RUN = {"run": "long", "radix": "int", "pairs": "binary", "documents": "binary", "places": "binary", "times": "binary"}
_DIGEST = {"place": "int", "doc_id": "long", "copies": "long", "n_a": "long", "n_b": "long", "n_groups": "long",
           "n_links": "long", "groups_sha256": "string"}
_WRITTEN = {"kind": "string"} | _RUN | _DIGEST


class Units(Remembered):
    """Remembered units whose bytes are bounded as well as their number: by ``REMEMBERED_BYTES`` and those of one slice."""

    def _clear(self) -> None:
        super()._clear()
        self._held = 0

    def _add(self, units: list, known: int) -> None:
        self._held += sum(map(len, units))
        super()._add(units, known)

    def ids(self, texts: Iterator[list]) -> list[np.ndarray]:
        if self._held > REMEMBERED_BYTES:
            self._clear()
        return super().ids(texts)


class PlainByteBpe(ByteBpe):
    """Byte-level BPE for which special strings inside a text are plain text."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__(path)
        self._special = [t.content.encode() for t in self._library.get_added_tokens_decoder().values() if t.special]
        self._plain = Tokenizer.from_file(path)
        self._plain.encode_special_tokens = True
        self._remembered = Units(self._encode_plain, REMEMBERED_FRAGMENTS)

    def _encode_plain(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        odd = [n for n, u in enumerate(units) if any(s in u for s in self._special)]
        if not odd:
            return encoded_apart(self._library, units)
        found = dict(zip(odd, (np.array(e.ids, np.uint32) for e in self._plain.encode_batch_fast(
            [units[n].decode() for n in odd], add_special_tokens=False))))
        rest = [n for n in range(len(units)) if n not in found]
        if rest:
            flat, lengths = encoded_apart(self._library, [units[n] for n in rest])
            found |= dict(zip(rest, np.split(flat, np.cumsum(lengths)[:-1])))
        ids = [found[n] for n in range(len(units))]
        return np.concatenate(ids), np.array(list(map(len, ids)))

    def ids_of(self, texts: list[str]) -> list[np.ndarray]:
        return self._remembered.ids(self.fragments(t.encode()) for t in texts)


class Pieces:
    """Sentence pieces, word by word: no piece holds a blank after another character, so a blank always starts a unit."""

    def __init__(self, path: str):
        import sentencepiece

        self._library = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self._library.id_to_piece(i) for i in range(self._library.get_piece_size())]
        if any(_BLANK in p.lstrip(_BLANK) for p in pieces):
            raise ValueError("a piece holds a blank after another character; units would not be independent")
        self.bytes = [bytes([int(p[3:5], 16)]) if self._library.is_byte(i) else p.replace(_BLANK, " ").encode() for i, p in enumerate(pieces)]
        self._units = Units(self._encode, REMEMBERED_FRAGMENTS)

    def _encode(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        # The library puts a blank before a text, which is the unit's first one, but not before an empty text.
        ids = [x or [self._library.piece_to_id(_BLANK)] for x in self._library.encode(units, num_threads=1)]
        return np.fromiter(chain.from_iterable(ids), np.uint32), np.fromiter(map(len, ids), np.int64, len(ids))

    def ids_of(self, texts: list[str]) -> list[np.ndarray]:
        return self._units.ids(map(_units_of, texts))


def _units_of(text: str) -> list[str]:
    """The units of a blank and the text, each without its first blank: blanks, then what follows them."""
    if "  " not in text and text[0] != " " and text[-1] != " ":
        return text.split(" ")
    return [unit[1:] for unit in re.findall(" +[^ ]*", f" {text}")]


class Aligner:
    """Tokens of both sides of a slice of texts, their groups and links."""

    def __init__(self, a_path: str, b_path: str):
        self._a, self._b = PlainByteBpe(a_path), Pieces(b_path)
        self._a_bytes, self._b_bytes = self._a.token_bytes, self._b.bytes
        self._a_size, self._b_size = (np.array(list(map(len, x)), np.int64) for x in (self._a_bytes, self._b_bytes))
        self.second = len(self._b_bytes)
        #: A token's decimal id with what follows it: the next token, the other side, the next group.
        self._shown = [f"{i}{after}" for i in range(max(len(self._a_bytes), len(self._b_bytes))) for after in ",|;"]

    def _tokens(self, texts: list[str | None]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """The texts that both sides give back byte by byte: place, bytes and ids."""
        used = [n for n, t in enumerate(texts) if t]
        a_ids = self._a.ids_of([" " + texts[n] for n in used])
        b_ids = self._b.ids_of([texts[n] for n in used])
        for n, a, b in zip(used, a_ids, b_ids):
            data = b" " + texts[n].encode()
            if data == b"".join(map(self._a_bytes.__getitem__, a.tolist())) == b"".join(map(self._b_bytes.__getitem__, b.tolist())):
                yield n, len(data), a, b

    def links(self, texts: list[str | None]) -> tuple[dict[str, list], np.ndarray, np.ndarray, np.ndarray]:
        """Digest columns of each text; then the distinct (place, pair) with how often each is linked.

        A pair is a number: first id * size of the second vocabulary + second id.
        """
        n = len(texts)
        out = {"n_a": [0] * n, "n_b": [0] * n, "n_groups": [0] * n, "n_links": [0] * n, "groups_sha256": [""] * n}
        tokens = list(self._tokens(texts))
        if not tokens:
            return out, *(np.zeros(0, np.int64) for _ in range(3))
        places, sizes, a_ids, b_ids = zip(*tokens)
        places, a, b = np.array(places), np.concatenate(a_ids).astype(np.int64), np.concatenate(b_ids).astype(np.int64)
        a_ends, b_ends = np.cumsum(self._a_size[a]), np.cumsum(self._b_size[b])
        at = np.searchsorted(b_ends, a_ends)
        shared = b_ends[at] == a_ends
        a_last, b_last = np.flatnonzero(shared), at[shared]
        a_first, b_first = (np.concatenate(([0], x[:-1] + 1)) for x in (a_last, b_last))
        a_many, b_many = a_last - a_first + 1, b_last - b_first + 1
        owner = np.searchsorted(np.cumsum(sizes), a_ends[a_last])
        n_groups = np.bincount(owner, minlength=len(places))
        n_links = np.zeros(len(places), np.int64)
        np.add.at(n_links, owner, a_many * b_many)
        shas = self._shown_groups(a, b, a_ids, b_ids, a_first, b_first, a_last, b_last)
        for k, place in enumerate(places.tolist()):
            out["n_a"][place], out["n_b"][place] = len(a_ids[k]), len(b_ids[k])
            out["n_groups"][place], out["n_links"][place] = int(n_groups[k]), int(n_links[k])
            out["groups_sha256"][place] = shas[k]

        many = a_many * b_many
        few = np.flatnonzero(many <= WIDE)
        group = np.repeat(few, many[few])
        step = np.arange(len(group)) - np.repeat(np.cumsum(many[few]) - many[few], many[few])
        pair = a[a_first[group] + step // b_many[group]] * self.second + b[b_first[group] + step % b_many[group]]
        found = [(pair, places[owner[group]], np.ones(len(pair), np.int64))]
        for g in np.flatnonzero(many > WIDE).tolist():
            x, x_times = np.unique(a[a_first[g]:a_last[g] + 1], return_counts=True)
            y, y_times = np.unique(b[b_first[g]:b_last[g] + 1], return_counts=True)
            wide = (x[:, None] * self.second + y).ravel()
            found.append((wide, np.full(len(wide), places[owner[g]]), np.outer(x_times, y_times).ravel()))
        pair, place, times = (np.concatenate(x) for x in zip(*found))
        both, inverse = np.unique(pair << 16 | place, return_inverse=True)
        total = np.zeros(len(both), np.int64)
        np.add.at(total, inverse, times)
        return out, both & 0xFFFF, both >> 16, total

    def _shown_groups(self, a, b, a_ids, b_ids, a_first, b_first, a_last, b_last) -> list[str]:
        """Per text, the digest of ``a1,a2|b1;a3|b2,b3``."""
        a_mark, b_mark = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        a_mark[a_last], b_mark[b_last] = 1, 2
        order = np.empty(len(a) + len(b), np.int64)
        order[np.arange(len(a)) + np.repeat(b_first, a_last - a_first + 1)] = a * 3 + a_mark
        order[np.arange(len(b)) + np.repeat(a_last + 1, b_last - b_first + 1)] = b * 3 + b_mark
        ends = np.cumsum([len(x) + len(y) for x, y in zip(a_ids, b_ids)]).tolist()
        shown, tokens = self._shown, order.tolist()
        return [hashlib.sha256("".join(map(shown.__getitem__, tokens[i:j]))[:-1].encode()).hexdigest()
                for i, j in zip([0, *ends], ends)]


def _pieces(path: str) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path).get_piece_size()


@functools.cache
def aligner(a_path: str, b_path: str) -> Aligner:
    """One aligner per Python worker."""
    return Aligner(a_path, b_path)


def _pack(values: np.ndarray, kind: str) -> bytes:
    """Numbers as zstandard, their first bytes together, then their second bytes and so on."""
    raw = np.ascontiguousarray(values.astype(kind)).view(np.uint8).reshape(len(values), -1)
    return zstandard.compress(raw.T.tobytes())


def _unpack(data: bytes, kind: str) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(raw.T).view(kind).ravel()


def _pack_sorted(values: np.ndarray) -> bytes:
    return _pack(np.diff(values, prepend=0), "<u4")


def _unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(_unpack(data, "<u4"), dtype=np.int64)


class _Run:
    """The links and digests of documents until they are written."""

    def __init__(self):
        self.digests, self.links, self.n_links = [], [], 0

    def add(self, ids: list, copies: list, digests: dict[str, list], place, pair, times) -> None:
        base = len(self.digests)
        self.digests += zip(range(base, base + len(ids)), ids, copies, *digests.values())
        self.links.append((pair << 16 | place + base, times))
        self.n_links += len(pair)

    def written(self, run: int, second: int) -> Iterator[dict[str, list]]:
        if self.digests:
            yield {"kind": ["document"] * len(self.digests), "run": [run] * len(self.digests), **dict(zip(_DIGEST, map(list, zip(*self.digests))))}
        if not self.n_links:
            return
        links, times = (np.concatenate(x) for x in zip(*self.links))
        radix = (links >> 16) // second % RADICES
        order = np.argsort(radix << 52 | links, kind="stable")
        links, times, radix = links[order], times[order], radix[order]
        bounds = np.searchsorted(radix, np.arange(RADICES + 1)).tolist()
        for r, (i, j) in enumerate(zip(bounds, bounds[1:])):
            if i < j:
                pair, first = np.unique(links[i:j] >> 16, return_index=True)
                place = (links[i:j] & 0xFFFF).astype(np.uint16)
                yield {"kind": ["pairs"], "run": [run], "radix": [r], "pairs": [_pack_sorted(pair)],
                       "documents": [_pack(np.diff(first, append=j - i), "<u4")],
                       # Differences of places wrap around where a pair ends.
                       "places": [_pack(np.diff(place, prepend=np.uint16(0)), "<u2")],
                       "times": [_pack(times[i:j], "<u8")]}


def _by_first(pairs: np.ndarray, second: int) -> Iterator[tuple[int, int, int]]:
    """The stretches of one first id."""
    first = pairs // second
    starts = np.flatnonzero(np.diff(first, prepend=-1))
    return zip(first[starts].tolist(), starts.tolist(), [*starts[1:].tolist(), len(pairs)])


def merge_runs(runs: list[tuple[np.ndarray, np.ndarray]], second: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """k-way merge of sorted runs (pairs, documents) by a heap: each first id's pairs with their sums, ids in order."""
    cursors = [_by_first(pairs, second) for pairs, _ in runs]
    heap = [(*at, n) for n, cursor in enumerate(cursors) if (at := next(cursor, None))]
    heapq.heapify(heap)
    while heap:
        first, taken = heap[0][0], []
        while heap and heap[0][0] == first:
            _, i, j, n = heap[0]
            taken.append((runs[n][0][i:j], runs[n][1][i:j]))
            after = next(cursors[n], None)
            if after:
                heapq.heapreplace(heap, (*after, n))
            else:
                heapq.heappop(heap)
        pairs, inverse = np.unique(np.concatenate([p for p, _ in taken]), return_inverse=True)
        total = np.zeros(len(pairs), np.int64)
        np.add.at(total, inverse, np.concatenate([d for _, d in taken]))
        yield pairs, total


def _copies(copies: Column) -> Column:
    """Steps of at most 10,000 rows: how many rows each step stands for."""
    steps = F.sequence(F.lit(0).cast("long"), F.floor((copies - 1) / 10_000))
    return F.transform(steps, lambda s: F.least(copies - s * 10_000, F.lit(10_000)).cast("int"))


class Alignment:
    """Linked tokens of a table of documents, written as runs in ``folder`` of the cluster's shared storage.

    Whole texts of any length. Null and empty texts, and texts that one side does not give back byte by byte,
    have no tokens. A null id is an id; equal rows (id and text) are one document, rows that share only the
    id are different ones; other columns are not read, so none can clash; no rows give no rows. Special strings
    inside a text are plain text.
    """

    def __init__(self, docs: DataFrame, a_path: str | None = None, b_path: str | None = None, folder: str | None = None,
                 *, doc_id: str = "doc_id", text: str = "text", run_documents: int = RUN_DOCUMENTS,
                 run_links: int = RUN_LINKS, fan_in: int = FAN_IN):
        self._spark, self._run_documents, self._run_links = docs.sparkSession, run_documents, run_links
        self._a = a_path or public_tokenizers.path(BYTE_VOCABULARY)
        self._b = b_path or public_tokenizers.path(PIECE_VOCABULARY)
        self._folder = folder or f"{shared_folder(self._spark)}/alignment-{uuid.uuid4().hex}"
        self._write_runs(docs, doc_id, text)
        self._fan_in = fan_in
        self._groups = [-(-self._of("document").select("run").distinct().count() // fan_in) or 1]
        while self._groups[-1] > 1:
            self._groups.append(-(-self._groups[-1] // fan_in))
        self._count_pairs()

    def _write_runs(self, docs: DataFrame, doc_id: str, text: str) -> None:
        a_path, b_path, schema = self._a, self._b, arrow_schema(_WRITTEN)
        run_documents, run_links = self._run_documents, self._run_links

        def batch(columns: dict[str, list]) -> pa.RecordBatch:
            n = len(columns["run"])
            return pa.RecordBatch.from_pydict({c: columns.get(c, [None] * n) for c in _WRITTEN}, schema=schema)

        def work(batches):
            align, number = aligner(a_path, b_path), TaskContext.get().partitionId() << 32
            run = _Run()
            for part in slices(batches, min(SLICE_ROWS, run_documents)):
                rows = part.to_pydict()
                run.add(rows["doc_id"], rows["copies"], *align.links(rows["text"]))
                if len(run.digests) + SLICE_ROWS > run_documents or run.n_links >= run_links:
                    yield from map(batch, run.written(number, align.second))
                    run, number = _Run(), number + 1
            yield from map(batch, run.written(number, align.second))

        once = ids_and_texts(docs, doc_id, text).groupBy("doc_id", "text").agg(F.count("*").alias("copies"))
        once.mapInArrow(work, ddl(_WRITTEN)).write.partitionBy("kind").parquet(f"{self._folder}/runs")

    def _of(self, kind: str) -> DataFrame:
        columns = _RUN if kind == "pairs" else {"run": "long"} | _DIGEST
        written = self._spark.read.schema(ddl(_WRITTEN)).parquet(f"{self._folder}/runs")
        return written.where(F.col("kind") == kind).select(*columns)

    def _group(self) -> Column:
        return F.pmod(F.xxhash64("run"), F.lit(self._groups[0]))

    def _count_pairs(self) -> None:
        """Writes per radix all pairs in order, the documents that hold each, and whether it is its first id's highest."""
        second = _pieces(self._b)

        def merge(rows: pd.DataFrame) -> pd.DataFrame:
            runs = [(_unpack_sorted(p), _unpack(d, "<i8" if wide else "<u4").astype(np.int64))
                    for p, d, wide in zip(rows["pairs"], rows["documents"], rows["wide"])]
            pairs, totals, highest = [], [], []
            for p, total in merge_runs(runs, second):
                pairs.append(p)
                totals.append(total)
                highest.append(total == total.max())
            return pd.DataFrame({"radix": rows["radix"].iloc[:1].to_numpy(), "part": rows["part"].iloc[:1].to_numpy(), "wide": [True],
                                 "pairs": [_pack_sorted(np.concatenate(pairs))],
                                 "documents": [_pack(np.concatenate(totals), "<i8")],
                                 "highest": [_pack(np.concatenate(highest), "u1")]})

        runs = self._of("pairs").select("radix", "pairs", "documents", self._group().alias("part"), F.lit(False).alias("wide"))
        for groups in [*self._groups[1:], None]:
            runs = runs.groupBy("radix", "part").applyInPandas(
                merge, "radix int, part long, wide boolean, pairs binary, documents binary, highest binary")
            if groups:
                runs = runs.withColumn("part", F.floor(F.col("part") / self._fan_in))
        runs.select("radix", "pairs", "documents", "highest").write.parquet(f"{self._folder}/counts")

    def _counts(self) -> DataFrame:
        return self._spark.read.schema("radix int, pairs binary, documents binary, highest binary").parquet(f"{self._folder}/counts")

    def pairs(self) -> DataFrame:
        """a_id, b_id, documents (how many hold the pair linked), is_best (the highest of its a_id, ties included)."""
        second, kinds = _pieces(self._b), {"a_id": "long", "b_id": "long", "documents": "long", "is_best": "boolean"}
        schema = arrow_schema(kinds)

        def work(batches):
            for part in slices(batches, 1):
                row = {name: column[0] for name, column in part.to_pydict().items()}
                pairs = _unpack_sorted(row["pairs"])
                columns = (pairs // second, pairs % second, _unpack(row["documents"], "<i8"), _unpack(row["highest"], "u1") > 0)
                yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), schema=schema)

        return self._counts().mapInArrow(work, ddl(kinds))

    def _shares(self) -> DataFrame:
        """Per run and radix: places of documents with their sum of counts and number of best links."""

        def shares(_, runs: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
            out = {"run": [], "places": [], "sums": [], "bests": []}
            for p, d, h in zip(counts["pairs"], counts["documents"], counts["highest"]):
                known, total, highest = _unpack_sorted(p), _unpack(d, "<i8"), _unpack(h, "u1").astype(np.int64)
                for run, pairs, documents, places, times in zip(*(runs[c] for c in ("run", "pairs", "documents", "places", "times"))):
                    at = np.repeat(np.searchsorted(known, _unpack_sorted(pairs)), _unpack(documents, "<u4"))
                    place, times = np.cumsum(_unpack(places, "<u2"), dtype=np.uint16), _unpack(times, "<u8").astype(np.int64)
                    sums, bests = np.zeros(RUN_DOCUMENTS, np.int64), np.zeros(RUN_DOCUMENTS, np.int64)
                    np.add.at(sums, place, times * total[at])
                    np.add.at(bests, place, times * highest[at])
                    held = np.flatnonzero(sums)
                    out["run"].append(run)
                    for column, values, kind in (("places", held, "<u2"), ("sums", sums[held], "<i8"), ("bests", bests[held], "<i8")):
                        out[column].append(_pack(values, kind))
            return pd.DataFrame(out)

        runs = self._of("pairs").withColumn("part", self._group())
        counts = self._counts().withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(self._groups[0] - 1).cast("long"))))
        return runs.groupBy("radix", "part").cogroup(counts.groupBy("radix", "part")).applyInPandas(
            shares, "run long, places binary, sums binary, bests binary")

    def documents(self) -> DataFrame:
        """One row per row of the table: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
        columns = ["doc_id", "copies", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]

        def summed(_, documents: pd.DataFrame, shares: pd.DataFrame) -> pd.DataFrame:
            sums, bests = np.zeros(RUN_DOCUMENTS, np.int64), np.zeros(RUN_DOCUMENTS, np.int64)
            for places, s, b in zip(shares["places"], shares["sums"], shares["bests"]):
                at = _unpack(places, "<u2")
                sums[at] += _unpack(s, "<i8")
                bests[at] += _unpack(b, "<i8")
            at = documents["place"].to_numpy(np.int64)
            return documents[columns].assign(n_best=bests[at], count_sum=sums[at])

        done = self._of("document").groupBy("run").cogroup(self._shares().groupBy("run")).applyInPandas(
            summed, "doc_id long, copies long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
                    "n_best long, count_sum long")
        steps = done.withColumn("copies", F.explode(_copies(F.col("copies"))))
        return steps.withColumn("copies", F.explode(F.array_repeat(F.lit(True), F.col("copies")))).select(
            "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
