"""Conversation repair against a plain table of the lightest edits, and against its SQL twin."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest

from obligato.llm import conversation_repair as cr
from obligato.llm.queries import ORACLES, QUERIES

AFTER = {("0", "s"): "S", ("0", "u"): "U", ("S", "u"): "U", ("A", "u"): "U", ("U", "a"): "A"}
GIVEN = {"u": "user", "a": "assistant"}


def plainly(rows):
    conversations = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind, kept = zlib.crc32(key.encode()) % 20, conversations[conv]
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        kept += [(turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    out = Counter()
    for conv, kept in conversations.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        turns = {t for t, _, _ in kept if t is not None}
        faults, seen = [], set()
        for _, role, text in kept:
            said = text.strip(" \t\n\x0b\x0c\r")
            faults.append("blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else "")
            seen.add((role, text))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(kept, kept[1:]))
        best = {"0": (0, "", ())}
        for (_, role, text), fault in zip(kept, faults):
            after = {}
            for state, (cost, audit, said) in with_inserts(best).items():
                better(after, state, (cost + 3, audit + "D", said))
                if fault in ("blank", "duplicate"):
                    continue
                cost += fault == "truncated"
                if (state, role[:1]) in AFTER:
                    better(after, AFTER[state, role[:1]], (cost, audit + "K", (*said, f"{role}:{text}")))
                for initial, name in GIVEN.items():
                    if (state, initial) in AFTER:
                        better(after, AFTER[state, initial], (cost + 2, audit + "R", (*said, f"{name}:{text}")))
            best = after
        ended = with_inserts(best)
        cost, audit, said = min(ended[s] for s in ("0", "A") if s in ended)
        out[conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            illegal, cost, audit, hashlib.sha256("\n".join(said).encode()).hexdigest()] += 1
    return out


def better(table, state, value):
    table[state] = min(value, table.get(state, value))


def with_inserts(table):
    table = dict(table)
    for _ in range(3):
        for state, (cost, audit, said) in list(table.items()):
            for initial, name in GIVEN.items():
                if (state, initial) in AFTER:
                    better(table, AFTER[state, initial], (cost + 2, audit + "I", (*said, f"{name}:")))
    return table


def made(seed):
    dice = random.Random(seed)
    roles, texts = ["user", "assistant", "system", "tool", "", None, "user", "assistant"], ["Hi.", "x", "", None, " \t", "Yes! ", "no\n", "ok?"]
    rows = [(dice.choice([*range(200), None]), dice.choice([None, *range(12)]), dice.choice(roles), dice.choice(texts)) for _ in range(2000)]
    rows += [(1000, t, dice.choice(roles), dice.choice([f"a{t}.", f"b{t}", "c."])) for t in range(2 * cr.BLOCK + 100)]
    return rows + [(1001, 5, "user", "same.")] * 50 + [(1002, t, "user", "No end") for t in range(30)]


def reports(rows):
    return Counter(map(tuple, cr.repair(cr.damage(rows)).collect()))


def test_every_fault_null_tie_and_block(spark):
    rows = made(3)
    frame = spark.createDataFrame([(*r, 7, "x", True) for r in rows],
                                  "conv_id long, turn long, role string, text string, copies int, audit string, seen boolean")
    assert reports(frame) == plainly(rows)
    assert reports(frame.limit(0)) == Counter()


def test_blocks_of_any_size_give_the_same(monkeypatch):
    def report():
        conversation = cr.Conversation(1)
        for turn, role, text in rows:
            conversation.read(turn, role, text, 1 + turn % 2, False)
        return conversation.report()

    dice = random.Random(9)
    rows = [(t, dice.choice(["user", "assistant", "system", "x"]), dice.choice(["Hm.", "hm", ""])) for t in range(60)]
    whole = report()
    for size in (1, 2, 3, 7):
        monkeypatch.setattr(cr, "BLOCK", size)
        assert report() == whole


def test_a_popped_item_is_lightest():
    rows = [cr.Row("u", "user", "a", True, False, 0), cr.Row("u", "user", "b", True, False, 0), cr.Row("a", "assistant", "c", True, False, 0)]
    goal = cr.lightest(rows, {0: cr.Reached(0, 0)}, last=True)[0]
    assert (goal.cost, cr._joined(goal.audit)) == (2, "KIKK")
    assert goal.sha.hexdigest() == hashlib.sha256(b"user:a\nassistant:\nuser:b\nassistant:c").hexdigest()


@pytest.mark.parametrize("table", ["given", "made"])
def test_the_twin_says_the_same(spark, table, tmp_path):
    folder = "/root/testdata/sf0.001" if table == "given" else str(tmp_path)
    if table == "made":
        spark.createDataFrame(made(4), "conv_id long, turn long, role string, text string").where("conv_id < 900").write.parquet(
            f"{folder}/conversations.parquet")
    files = f"{folder}/conversations.parquet" + ("/*.parquet" if table == "made" else "")
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{files}')")
        twin = Counter(db.sql(ORACLES["op12_lightest_repair"]).fetchall())
    rows = QUERIES["op12_lightest_repair"](spark, folder)
    assert Counter(map(tuple, rows.collect())) == twin and twin
