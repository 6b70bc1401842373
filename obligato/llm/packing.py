"""Packing documents into sequences of fixed length as a cutting-stock problem.

Documents longer than a sequence are cut into full sequences and a rest. The rests are the items of a
cutting-stock problem: classes of rest lengths with their counts (a histogram of bounded size, whatever
the corpus), patterns (how many rests of each class share a sequence), and a linear program that
covers all counts with the fewest sequences. Its columns are generated: the simplex prices give each class a
value, a knapsack over the sequence length finds the most valuable pattern, and it enters the basis until
none is worth more than a sequence (or no packing could be better by more than GAP). Whole parts of the solution are used as they are, what is left is filled
largest first. Documents are ranked within their class (salted, so no class meets in one task), and
rank ranges are dealt to the patterns' slots.
"""

import zlib

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame, Window, functions as F

from obligato.llm.bpe import BYTE_VOCABULARY, byte_bpe
from obligato.llm.common import ids_and_texts, map_rows, materialized

SEQUENCE, END_ID = 2048, 1
#: Rest lengths up to EXACT are classes of their own; longer ones share a class of STEP lengths, rounded up.
EXACT, STEP = 256, 4
#: Column generation ends when the program is solved, or within this share of the least sequences that any packing needs.
GAP = 0.001
#: ... or after so many pivots that together improve it by less than a tenth of that share.
PATIENCE = 50


def knapsack(lengths: np.ndarray, values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable multiset of lengths within the capacity: its value and how often each length is taken."""
    useful = np.flatnonzero(values > 0)
    size, worth = lengths[useful], values[useful]
    best, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    fits = np.searchsorted(size, np.arange(capacity + 1), side="right")
    for c in range(1, capacity + 1):
        best[c] = best[c - 1]
        if k := fits[c]:
            total = best[c - size[:k]] + worth[:k]
            i = total.argmax()
            if total[i] > best[c]:
                best[c], choice[c] = total[i], i
    pattern, c = np.zeros(len(lengths), np.int64), capacity
    while c > 0:
        if choice[c] < 0:
            c -= 1
        else:
            pattern[useful[choice[c]]] += 1
            c -= size[choice[c]]
    return best[capacity], pattern


def first_basis(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A feasible basis near the optimum: patterns filled largest first, each used until it exhausts a class.

    A pattern holds the class that it exhausts and none exhausted before it, so the columns are
    triangular up to order, and their inverse is built alongside.
    """
    m = len(lengths)
    left, alive = counts.astype(float), np.ones(m, bool)
    basis, inverse, amounts = np.zeros((m, m)), np.eye(m), np.zeros(m)
    for _ in range(m):
        pattern, room = np.zeros(m), capacity
        for i in np.flatnonzero(alive)[::-1].tolist():
            if lengths[i] <= room:
                pattern[i], room = divmod(room, int(lengths[i]))
                if not room:
                    break
        held = np.flatnonzero(pattern)
        ratios = left[held] / pattern[held]
        out = held[ratios.argmin()]
        basis[:, out], amounts[out] = pattern, ratios.min()
        left = np.maximum(left - amounts[out] * pattern, 0)
        left[out], alive[out] = 0, False
        pivot(inverse, pattern, out)
    return basis, inverse, amounts


def pivot(inverse: np.ndarray, entering: np.ndarray, row: int) -> None:
    """The inverse after a column enters at that row; ``entering`` is the column in terms of the old basis."""
    inverse[row] /= entering[row]
    others = np.where(np.arange(len(entering)) == row, 0, entering)
    for i in np.flatnonzero(others):
        inverse[i] -= others[i] * inverse[row]


def column_generation(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (columns) and how often each is used, real-valued: a basic solution of the linear program."""
    basis, inverse, amounts = first_basis(lengths, counts, capacity)
    least = (counts * lengths).sum() / capacity  # no solution uses fewer sequences than the ids fill
    since, best = 0, amounts.sum()
    # Every basis on the way is a solution, so a program that pivots without progress (many ties) may end early.
    while amounts.sum() > least * (1 + GAP) and since < PATIENCE:
        since, best = (0, amounts.sum()) if amounts.sum() < best * (1 - GAP / 10) else (since + 1, best)
        prices = inverse.sum(axis=0)
        value, pattern = knapsack(lengths, prices, capacity)
        if value <= 1 + 1e-6:  # no column improves the program: it is solved
            break
        entering = np.einsum("ij,j->i", inverse, pattern.astype(float))  # no library threads on the driver
        ratios = np.where(entering > 1e-9, amounts / np.where(entering > 1e-9, entering, 1), np.inf)
        row = int(ratios.argmin())
        step = ratios[row]
        amounts = np.maximum(amounts - step * entering, 0)
        amounts[row] = step
        basis[:, row] = pattern
        pivot(inverse, entering, row)
    return basis, amounts


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Patterns ({class: rests of it}) and how many sequences follow each; they hold exactly the histogram's rests."""
    if not histogram:
        return []
    lengths = np.array(sorted(histogram), np.int64)
    left = np.array([histogram[int(x)] for x in lengths], np.int64)
    used: list[tuple[np.ndarray, int]] = []

    def use(pattern: np.ndarray, times: int) -> None:
        if times > 0 and pattern.any():
            used.append((pattern, int(times)))
            left[:] -= pattern * times

    basis, amounts = column_generation(lengths, left, capacity)
    columns = basis.T.astype(np.int64)
    possible = lambda p: (left[p > 0] // p[p > 0]).min(initial=1 << 62)
    for pattern, amount in zip(columns, amounts):
        use(pattern, min(int(amount), possible(pattern)))
    # Then one more of those patterns that were rounded down most and still fit what is left.
    for i in np.argsort(-(amounts - np.floor(amounts)), kind="stable"):
        if columns[i].any() and (columns[i] * lengths).sum() > capacity * 0.98:
            use(columns[i], min(1, possible(columns[i])))
    while left.any():
        pattern, room = np.zeros(len(lengths), np.int64), capacity
        for i in np.flatnonzero(left)[::-1]:
            pattern[i] = min(left[i], room // lengths[i])
            room -= pattern[i] * lengths[i]
        use(pattern, possible(pattern))
    return [({int(lengths[i]): int(p[i]) for i in np.flatnonzero(p)}, times) for p, times in used]


def cut_documents(docs: DataFrame, path: str | None = None, capacity: int = SEQUENCE, end: int = END_ID) -> DataFrame:
    """doc_id, doc_tokens (with the end id) and the checksums of its pieces: full sequences, then the rest if any."""
    path = path or public_tokenizers.path(BYTE_VOCABULARY)
    last = np.array([end], "<u4").tobytes()

    def make():
        bpe = byte_bpe(path)

        def work(rows):
            ids = [x + last for x in bpe.encode_many(rows["text"])]
            return {"doc_id": rows["doc_id"], "doc_tokens": [len(x) // 4 for x in ids],
                    "crcs": [[zlib.crc32(x[i:i + 4 * capacity]) for i in range(0, len(x), 4 * capacity)] for x in ids]}

        return work

    return map_rows(docs, {"doc_id": "long", "doc_tokens": "long", "crcs": "array<long>"}, make)


def pack_documents(docs: DataFrame, path: str | None = None, capacity: int = SEQUENCE, end: int = END_ID, *,
                   doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Every document has its end id, so null and empty texts are pieces of one id. Null ids and repeated
    rows are packed like any other row; other columns are not read; texts may be of any length; an
    empty table gives no rows. Documents are tokenized once; the checkpointed lengths and
    checksums serve the rest of the work.
    """
    spark = docs.sparkSession
    cut = materialized(cut_documents(ids_and_texts(docs, doc_id, text), path, capacity, end))
    # Salts deal the stored rows in turn, so that equal rows are spread as well.
    salts = max(32, -(-cut.count() // 5000))
    cut = cut.select("*", F.pmod(F.monotonically_increasing_id(), F.lit(salts)).alias("salt"),
                     F.expr(f"doc_tokens div {capacity}").alias("full"), (F.col("doc_tokens") % capacity).alias("rest"))
    before = lambda *by: Window.partitionBy(*by)

    # Rests: class, rank in the class, slot of the rank.
    size = F.when(F.col("rest") <= EXACT, F.col("rest")).otherwise(F.ceil(F.col("rest") / STEP) * STEP)
    rests = cut.where("rest > 0").select(
        "doc_id", (F.col("full") * capacity).alias("start"), F.col("rest").alias("length"),
        F.element_at("crcs", -1).alias("ids_crc32"), "doc_tokens", F.least(size, F.lit(capacity)).cast("long").alias("class"), "salt")
    groups = materialized(rests.groupBy("class", "salt").agg(F.count("*").alias("n")))
    histogram = {r["class"]: r.n for r in groups.groupBy("class").agg(F.sum("n").alias("n")).collect()}
    slots, sequences, rank_of = [], 0, dict.fromkeys(histogram, 0)
    for pattern, times in plan(histogram, capacity):
        for c, n in pattern.items():
            slots.append((c, rank_of[c], rank_of[c] + n * times, sequences, n))
            rank_of[c] += n * times
        sequences += times
    # At most a few rows per pattern, and as many patterns as classes and sequences left over: bounded by the sequence length.
    slots = spark.createDataFrame(slots, "class long, first long, beyond long, sequence long, each long")
    offsets = groups.select("class", "salt", (F.sum("n").over(before("class").orderBy("salt")) - F.col("n")).alias("skipped"))
    order = [F.col(c) for c in ("doc_id", "doc_tokens", "ids_crc32")]
    ranked = rests.join(offsets, ["class", "salt"]).withColumn(
        "rank", F.col("skipped") + F.row_number().over(before("class", "salt").orderBy(*order)) - 1)
    placed = ranked.join(F.broadcast(slots), (ranked["class"] == slots["class"]) & (F.col("rank") >= F.col("first"))
                         & (F.col("rank") < F.col("beyond"))).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        (F.col("sequence") + F.expr("(rank - first) div each")).alias("sequence_id"))
    inside = before("sequence_id").orderBy(F.col("length").desc(), *order)
    placed = placed.withColumn("offset", F.sum("length").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("length"))

    # Full sequences, numbered after the packed ones.
    long = cut.where("full > 0").select("doc_id", "doc_tokens", "crcs", "full", "salt")
    per_salt = long.groupBy("salt").agg(F.sum("full").alias("n")).select(
        "salt", (F.sum("n").over(Window.orderBy("salt")) - F.col("n") + sequences).alias("first"))
    running = before("salt").orderBy("doc_id", "doc_tokens", "crcs").rowsBetween(Window.unboundedPreceding, 0)
    numbered = long.withColumn("skipped", F.sum("full").over(running) - F.col("full")).join(per_salt, "salt")
    whole = numbered.select("*", F.posexplode(F.slice("crcs", 1, F.col("full").cast("int"))).alias("k", "ids_crc32")).select(
        "doc_id", (F.col("k").cast("long") * capacity).alias("start"), F.lit(capacity).cast("long").alias("length"), "ids_crc32",
        "doc_tokens", (F.col("first") + F.col("skipped") + F.col("k")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return placed.unionByName(whole)
