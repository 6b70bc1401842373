"""Helpers shared by the text operators: batch maps, hot-group salts, shared storage."""

import hashlib
import os
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import chain, count, islice
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Rows handled at once inside a task; a task never holds more than these texts and their results.
SLICE_ROWS = 256

_ARROW = {
    "long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(), "string": pa.string(),
    "binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()),
    "array<string>": pa.list_(pa.string()), "array<binary>": pa.list_(pa.binary()),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    _find_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _find_package(spark: SparkSession) -> None:
    """Python workers of a session started in another folder look for this package where it was loaded from."""
    root, environment = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))


def ddl(schema: dict[str, str]) -> str:
    return ", ".join(f"`{name}` {kind}" for name, kind in schema.items())


def arrow_schema(schema: dict[str, str]) -> pa.Schema:
    return pa.schema([(name, _ARROW[kind]) for name, kind in schema.items()])


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def map_rows(rows: DataFrame, schema: dict[str, str], make: Callable[[], Callable[[dict], dict]]) -> DataFrame:
    """Maps columns to columns inside tasks.

    ``make`` runs once per task and gives a function from a slice of rows (lists by column name) to
    the result's columns; a slice may give more or fewer rows than it had.
    """
    out = arrow_schema(schema)

    def run(batches):
        work = make()
        for part in slices(batches):
            yield pa.RecordBatch.from_pydict(work(part.to_pydict()), schema=out)

    return rows.mapInArrow(run, ddl(schema))


def keep_rows(rows: DataFrame, make: Callable[[], Callable[[dict], list[bool]]]) -> DataFrame:
    """The rows, all columns unchanged, for which the function says True."""

    def run(batches):
        work = make()
        for part in slices(batches):
            yield part.filter(pa.array(work(part.to_pydict()), pa.bool_()))

    return rows.mapInArrow(run, rows.schema)


def whole_row(docs: DataFrame) -> Column:
    """All columns, whatever their names, as one struct."""
    return F.struct(*[F.col("`" + name.replace("`", "``") + "`") for name in docs.columns])


def ids_and_texts(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Only the two columns an operator reads, under fixed names: other columns cannot clash."""
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))


def sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def salt(rows: DataFrame, *columns: str, per_salt: int = 20_000) -> Column:
    """A salt that spreads any group evenly; the number of salts grows with the row count."""
    n = max(16, -(-rows.count() // per_salt))
    return F.pmod(F.xxhash64(*columns), F.lit(n)).cast("int")


def materialized(rows: DataFrame) -> DataFrame:
    """Cuts the lineage with a reliable checkpoint in the folder named by ``spark.checkpoint.dir``.

    Lost executors do not lose it. The session's cleaner removes the files where
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` is on.
    """
    ensure_checkpoint_dir(rows.sparkSession)
    return rows.checkpoint(eager=True)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors reach; a session without one (a local trial) gets one beside its warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = f"{spark.conf.get('spark.sql.warehouse.dir')}/_checkpoints"
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


def encoded_apart(library, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The units' ids in a row, and how many each has, as if each were encoded alone.

    The library cuts a text at its special tokens before anything else, so many units are given as one
    text with a special token between them, which is much faster. Units that hold such a token go alone.
    """
    special = {t.content.encode(): i for i, t in library.get_added_tokens_decoder().items() if t.special}
    if not special:
        ids = [e.ids for e in library.encode_batch_fast([u.decode() for u in units], add_special_tokens=False)]
        return np.fromiter(chain.from_iterable(ids), np.uint32), np.fromiter(map(len, ids), np.int64, len(ids))
    mark, mark_id = next(iter(special.items()))
    alone = {n for n, u in enumerate(units) if b"<" in u and any(s in u for s in special)}
    texts, at = [], 0
    for n in [*sorted(alone), len(units)]:
        for i in range(at, n, 512):
            texts.append(mark + mark.join(units[i:min(i + 512, n)]))
        if n < len(units):
            texts.append(units[n])
        at = n + 1
    ids = [np.array(e.ids, np.uint32) for e in library.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)]
    flat, lengths, n = [], [], 0
    for x in ids:
        if n in alone:
            flat.append(x)
            lengths.append(np.array([len(x)]))
            n += 1
        else:
            starts = np.flatnonzero(x == mark_id)
            flat.append(np.delete(x, starts))
            lengths.append(np.diff(np.append(starts, len(x))) - 1)
            n += len(starts)
    return np.concatenate(flat), np.concatenate(lengths)


class Remembered:
    """Ids of text units, worked out once per distinct unit and joined per text.

    ``encode`` gives new units' ids in a row and how many each has. The memory of a Python worker is bounded: it is
    emptied when it holds more than ``limit`` units.
    """

    def __init__(self, encode: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], limit: int):
        self._encode, self._limit = encode, limit
        self._clear()

    def _clear(self) -> None:
        self._number: defaultdict[bytes, int] = defaultdict(count().__next__)
        self._flat, self._starts = np.zeros(1 << 16, np.uint32), np.zeros(1 << 16, np.int64)

    def _add(self, units: list[bytes], known: int) -> None:
        flat, lengths = self._encode(units)
        ends = self._starts[known] + np.cumsum(lengths)
        size = known + len(units)
        if size >= len(self._starts):
            self._starts = np.resize(self._starts, 2 * size)
        if ends[-1] > len(self._flat):
            self._flat = np.resize(self._flat, 2 * int(ends[-1]))
        self._flat[self._starts[known]:ends[-1]] = flat
        self._starts[known + 1:size + 1] = ends

    def ids(self, texts: Iterator[list[bytes]]) -> list[np.ndarray]:
        """For each text's units, their ids in a row."""
        if len(self._number) > self._limit:
            self._clear()
        known = len(self._number)
        numbers = [np.fromiter(map(self._number.__getitem__, units), np.int64, len(units)) for units in texts]
        if new := len(self._number) - known:
            self._add(list(islice(reversed(self._number), new))[::-1], known)
        all_ = np.concatenate(numbers) if numbers else np.zeros(0, np.int64)
        starts = self._starts[all_]
        lengths = self._starts[all_ + 1] - starts
        after = np.cumsum(lengths)
        joined = self._flat[np.repeat(starts - after + lengths, lengths) + np.arange(after[-1] if len(after) else 0)]
        bounds = np.concatenate(([0], after))[np.cumsum([0, *map(len, numbers)])]
        return [joined[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
