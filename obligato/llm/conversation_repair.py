"""Repair of a conversation's structure by Knuth's lightest-derivation agenda.

A conversation is well formed if its roles read ``(system? (user assistant)+)?``. What has been read of it is an
item (rows read, state of the roles written); a deduction joins such an item with the next row's item and an
edit of that row, or adds an inserted turn. Values are (cost, audit): costs add up and the edits' initials are
appended, so a deduction's value is never less than that of the items it rests on and grows with them. The
agenda pops items lightest first; a popped item is final, and the first goal item to be popped is the answer.

Rows are read in order in one pass. After ``BLOCK`` rows the four items that stand there become the axioms of
the next block, with the running digests of what each has written, so a conversation of any length needs the
memory of a block, beside its audit. Equal audits of one cost cannot differ in what they write.
"""

import hashlib
import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from obligato.llm.common import arrow_schema, ddl

BLOCK = 512
#: Fixed costs of the edits.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1

# White space, and the signs that end a sentence.
_SPACE, _ENDS = " \t\n\x0b\x0c\r", ".!?"
#: What has been written (nothing, a system turn, up to a user's, up to an assistant's) and the next initial.
_NOTHING, _SYSTEM, _USER, _ASSISTANT = range(4)
_NEXT = {(_NOTHING, "s"): _SYSTEM, (_NOTHING, "u"): _USER, (_SYSTEM, "u"): _USER, (_ASSISTANT, "u"): _USER, (_USER, "a"): _ASSISTANT}
_COMPLETE = (_NOTHING, _ASSISTANT)
_NAMES = {"u": "user", "a": "assistant"}

_REPORT = {"conv_id": "long", "gaps": "long", "blank": "long", "duplicate": "long", "truncated": "long", "illegal": "long",
           "cost": "long", "audit": "string", "repaired_sha256": "string"}


def damage(rows: DataFrame) -> DataFrame:
    """Damages conversations by crc32 of ``conv_id:turn`` modulo 20: conv_id, turn, role, text, copies (0: the row is dropped).

    0 drops a row, 1 empties its text, 2 takes its sentence ends, 3 repeats it, 4 gives it to the user. Null
    roles, texts and parts of the key count as one blank. Equal rows come as one row with their number; other columns
    are not read.
    """
    def blank(column: str):
        return F.coalesce(F.col(column).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn")).cast("binary")) % 20
    role = F.when(kind == 4, "user").otherwise(blank("role"))
    text = F.when(kind == 1, "").when(kind == 2, F.translate(blank("text"), _ENDS, "")).otherwise(blank("text"))
    kept = kind != 0
    damaged = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.when(kept, F.col("turn").cast("long")).alias("turn"),
                          F.when(kept, role).alias("role"), F.when(kept, text).alias("text"),
                          F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).cast("long").alias("copies"))
    return damaged.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))


@dataclass
class Row:
    """A row that may be kept, or (``kept`` False) one that must go, and the number of rows right after it that must go."""

    initial: str
    shown: str
    said: str
    kept: bool
    truncated: bool
    gone: int


@dataclass
class Reached:
    """What stands at the beginning of a block: an item's cost, its place among the audits, and what it has written."""

    cost: int
    place: int
    audit: tuple = ()
    sha: "hashlib._Hash" = field(default_factory=hashlib.sha256)


def _edits(row: Row, state: int) -> Iterator[tuple[str, int, int, str | None]]:
    """Deductions that read a row: letters, cost, state reached and what is written."""
    after, cost = "D" * row.gone, DELETE * row.gone
    if not row.kept:
        yield after, cost, state, None
        return
    yield "D" + after, cost + DELETE, state, None
    cost += TRUNCATED * row.truncated
    if (kept := _NEXT.get((state, row.initial))) is not None:
        yield "K" + after, cost, kept, f"{row.shown}:{row.said}"
    for initial, name in _NAMES.items():
        if (given := _NEXT.get((state, initial))) is not None:
            yield "R" + after, cost + REROLE, given, f"{name}:{row.said}"


def lightest(rows: list[Row], entered: dict[int, Reached], last: bool) -> dict[int, Reached]:
    """The agenda over one block: the lightest item of each state behind its last row, or of the goal (state 0)
    where the conversation ends."""
    end, goal = len(rows), (-1, _NOTHING)
    # A value is (cost, place of the entering audit, audit within the block). Entering audits all end with a row, so
    # that none begins another, and their places order whatever follows them.
    agenda = [((0, -1, ""), ("row", i), None) for i in range(end)]
    agenda += [((r.cost, r.place, ""), (0, state), None) for state, r in entered.items()]
    heapq.heapify(agenda)
    final, origin = {}, {r.place: state for state, r in entered.items()}
    wanted = 1 if last else 4
    while agenda and wanted:
        value, item, via = heapq.heappop(agenda)
        if item in final:
            continue
        final[item] = value, via
        at, state = item
        if item == goal or not last and at == end:
            wanted -= 1
            continue
        tails = [(at, state)] if at != "row" else [(state, s) for s in range(4) if (state, s) in final]
        for tail in tails:
            (cost, place, audit), _ = final[tail]
            n, q = tail
            if n < end and ("row", n) in final:
                for letters, price, reached, written in _edits(rows[n], q):
                    heapq.heappush(agenda, ((cost + price, place, audit + letters), (n + 1, reached), (tail, written)))
            if at == "row":
                continue
            for initial, name in _NAMES.items():
                if (reached := _NEXT.get((q, initial))) is not None:
                    heapq.heappush(agenda, ((cost + INSERT, place, audit + "I"), (n, reached), (tail, f"{name}:")))
            if last and n == end and q in _COMPLETE:
                heapq.heappush(agenda, ((cost, place, audit), goal, (tail, None)))
    stands = [(final[item][0], item) for item in ([goal] if last else [(end, s) for s in range(4)]) if item in final]
    out = {}
    for place, ((cost, entry, audit), item) in enumerate(sorted(stands, key=lambda x: x[0][1:])):
        written, step = [], item
        while (via := final[step][1]) is not None:
            written.append(via[1])
            step = via[0]
        state = origin[entry]
        before, sha = entered[state], entered[state].sha.copy()
        for text in reversed([w for w in written if w is not None]):
            if state != _NOTHING:
                sha.update(b"\n")
            sha.update(text.encode())
            state = _USER  # anything but nothing
        out[item[1]] = Reached(cost, place, (before.audit, audit), sha)
    return out


def _joined(audit: tuple) -> str:
    parts = []
    while audit:
        audit, part = audit
        parts.append(part)
    return "".join(reversed(parts))


class Conversation:
    """One conversation, read row by row in order."""

    def __init__(self, conv_id: int | None):
        self._conv_id, self._block, self._reached = conv_id, [], {_NOTHING: Reached(0, 0)}
        self._counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        self._first = self._turn = self._initial = None
        self._turns = 0

    def read(self, turn: int | None, role: str, text: str, copies: int, seen: bool) -> None:
        if turn is not None and turn != self._turn:
            self._first = turn if self._first is None else self._first
            self._turn, self._turns = turn, self._turns + 1
        initial, said, counts = role[:1], text.strip(_SPACE), self._counts
        if self._initial is not None:
            counts["illegal"] += self._initial + initial not in ("su", "ua", "au")
        counts["illegal"] += copies - 1
        self._initial = initial
        kept = bool(said) and not seen
        truncated = kept and said[-1] not in _ENDS
        counts["blank"] += 0 if said else copies
        counts["duplicate"] += copies - kept if said else 0
        counts["truncated"] += truncated
        if len(self._block) == BLOCK:
            self._reached, self._block = lightest(self._block, self._reached, last=False), []
        self._block.append(Row(initial, role, text, kept, truncated, copies - kept))

    def report(self) -> tuple:
        goal = lightest(self._block, self._reached, last=True)[_NOTHING]
        gaps = self._turn - self._first + 1 - self._turns if self._turns else 0
        return self._conv_id, gaps, *self._counts.values(), goal.cost, _joined(goal.audit), goal.sha.hexdigest()


def repair(damaged: DataFrame) -> DataFrame:
    """One row per conversation of rows (conv_id, turn, role, text, copies): faults, the lightest edits and what they leave.

    gaps (turn numbers missing between the first and the last), blank, duplicate, truncated (the first of them that holds for
    a row), illegal (neighbours whose roles may not follow each other), cost, audit, repaired_sha256.

    Rows are taken by turn (nulls first), role and text. A null conv_id is a conversation of its own; roles and texts
    are not null where ``copies`` is above 0; conversations without such rows have zeros and an empty audit; other columns
    are not read; no rows give no rows. A conversation is read by one task, as its digest demands, row by row.
    """
    seen = Window.partitionBy("conv_id", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    ordered = (damaged.select("conv_id", "turn", "role", "text", "copies").repartition("conv_id")
               .withColumn("seen", F.row_number().over(seen) > 1)
               .sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text"))
    schema = arrow_schema(_REPORT)

    def work(batches):
        rows = (row for batch in batches for row in zip(*batch.to_pydict().values()))
        reports = []
        for conv_id, own in groupby(rows, key=itemgetter(0)):
            conversation = Conversation(conv_id)
            for _, turn, role, text, copies, before in own:
                if copies:
                    conversation.read(turn, role, text, copies, before)
            reports.append(conversation.report())
            if len(reports) == 1024:
                yield _batch(reports, schema)
                reports = []
        yield _batch(reports, schema)

    return ordered.mapInArrow(work, ddl(_REPORT))


def _batch(reports: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(dict(zip(schema.names, map(list, zip(*reports)) if reports else [[]] * len(schema))), schema=schema)
