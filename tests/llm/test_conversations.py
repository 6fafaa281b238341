import hashlib
import itertools
import random
import re
import zlib

import pyarrow.parquet as pq
import pytest

from abundix.llm import conversations
from abundix.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string, copies int, piece int, line string, block string"
BLANKS = " \t\n\x0b\x0c\r"
COST = {"K": 0, "R": 2, "D": 3, "I": 2}


def faults_of(rows):
    seen, out = set(), []
    for _, role, text in rows:
        body = text.strip(BLANKS)
        out.append("x" if not body else "d" if (role, text) in seen else "t" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows, faults):
    """All ways to edit, by breadth: per place and roles written, the least (cost, audit, repaired)."""
    best = {"": (0, "", ())}

    def widen(options):
        done = {}
        while options:
            state, value = min(options.items(), key=lambda x: x[1])
            del options[state]
            done[state] = value
            cost, audit, said = value
            for role in ("user", "assistant"):
                to = step(state, role[0])
                if to is not None and to not in done:
                    offer = (cost + 2, audit + "I", (*said, role + ":"))
                    options[to] = min(options.get(to, offer), offer)
        return done

    def step(state, initial):
        return {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}[state].get(initial)

    for (_, role, text), fault in zip(rows, faults):
        after = {}

        def offer(state, cost, audit, said):
            if state is not None:
                after[state] = min(after.get(state, (cost, audit, said)), (cost, audit, said))

        for state, (cost, audit, said) in widen(best).items():
            offer(state, cost + 3, audit + "D", said)
            if fault not in ("x", "d"):
                more = int(fault == "t")
                offer(step(state, role[:1]), cost + more, audit + "K", (*said, f"{role}:{text}"))
                for new in ("user", "assistant"):
                    offer(step(state, new[0]), cost + 2 + more, audit + "R", (*said, f"{new}:{text}"))
        best = after
    return min(v for s, v in widen(best).items() if s in ("", "a"))


def expected(rows):
    """One conversation's result from its rows (turn, role, text) after damage."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    faults = faults_of(rows)
    turns = [t for t, _, _ in rows if t is not None]
    cost, audit, said = cheapest(rows, faults)
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        faults.count("x"),
        faults.count("d"),
        faults.count("t"),
        sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows)),
        cost,
        audit,
        hashlib.sha256("\n".join(said).encode()).hexdigest(),
    )


def damaged(rows):
    out = {}
    for conv_id, turn, role, text in rows:
        key = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        fate = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        out.setdefault(conv_id, []).extend([(turn, "user" if fate == 4 else role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1))
    return out


def got(df):
    return {r[0]: tuple(r)[1:] for r in df.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256").collect()}


def some_rows(seed, conversations=120, longest=14):
    r = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", "", None, "sys", "User"]
    texts = ["Ok.", "ok", "", " ", None, "Ja!\n", "é ☃?", "long " * 30 + ".", "a\nb"]
    rows = []
    for c in [None, *range(conversations)]:
        for t in range(r.randint(0, longest)):
            role = r.choice(roles) if r.random() < 0.3 else ("user", "assistant")[t % 2]
            text = r.choice(texts) if r.random() < 0.5 else f"word {r.random()}."
            rows.append((c, r.choice([None, t, t, t + 3, 7]), role, text))
    return rows


@pytest.fixture(params=["whole", "blocks"])
def limits(request, monkeypatch):
    if request.param == "blocks":
        monkeypatch.setattr(conversations, "ROWS", 4)
        monkeypatch.setattr(conversations, "BLOCK_BITS", 1)
    return request.param


def test_random_conversations(spark, limits):
    rows = some_rows(1)
    df = spark.createDataFrame([(*r, 9, 1, "l", "b") for r in rows], SCHEMA).drop("copies").repartition(3)
    plain = {}
    for c, t, role, text in rows:
        plain.setdefault(c, []).append((t, " " if role is None else role, " " if text is None else text))
    repaired = conversations.repair(df)
    assert (repaired.long is None) == (limits == "whole")
    assert got(conversations.summarise(repaired)) == {c: expected(v) for c, v in plain.items()}


def test_damaged_conversations(spark, limits):
    rows = some_rows(2)
    df = spark.createDataFrame([(*r, 9, 1, "l", "b") for r in rows], SCHEMA).repartition(3)
    out = conversations.summarise(conversations.repair(conversations.damage(df)))
    assert got(out) == {c: expected(v) for c, v in damaged(rows).items()}
    assert out.count() == len({r[0] for r in rows})


def test_pieces_hold_the_repaired_turns(spark, limits):
    rows = some_rows(3)
    df = spark.createDataFrame([(*r, 1, 1, "l", "b") for r in rows], SCHEMA)
    for conv_id, pieces in itertools.groupby(sorted(conversations.repair(df).pieces().collect(), key=lambda r: (str(r.conv_id), r.piece)), lambda r: r.conv_id):
        pieces = list(pieces)
        assert [p.piece for p in pieces] == list(range(pieces[0].pieces))
        initials = "".join(role[:1] for p in pieces for role in p.roles)
        assert re.fullmatch("(s?(ua)+)?", initials), conv_id


def test_long_runs_match_single_steps():
    for symbol in ("u", "ut", "a", "st", "?t", "x"):
        after = conversations.END
        for count in range(1, 40):
            after = conversations._before(conversations._power(symbol, 0), after)
            assert conversations._over_run(symbol, count, conversations.END) == after


def test_one_conversation_has_almost_all_rows(spark, monkeypatch):
    monkeypatch.setattr(conversations, "ROWS", 500)
    monkeypatch.setattr(conversations, "BLOCK_BITS", 6)
    r = random.Random(5)
    rows = [(1, t // 2, r.choice(["user", "user", "assistant", "system"]), r.choice(["Yes.", f"{t}.", f"{t}", ""])) for t in range(4000)]
    rows += [(2, t, "user", "Hi.") for t in range(9)]
    df = spark.createDataFrame([(*x, 1, 1, "l", "b") for x in rows], SCHEMA).repartition(4)
    whole = {}
    for c, *row in rows:
        whole.setdefault(c, []).append(tuple(row))
    assert got(conversations.summarise(conversations.repair(df))) == {c: expected(v) for c, v in whole.items()}


def test_empty_table_and_rows_that_are_gone(spark):
    df = spark.createDataFrame([(1, 1, "user", "a.", 0, 1, "l", "b"), (None, None, None, None, 0, 1, "l", "b")], SCHEMA)
    empty = hashlib.sha256(b"").hexdigest()
    assert got(conversations.summarise(conversations.repair(df))) == {1: (0,) * 6 + ("", empty), None: (0,) * 6 + ("", empty)}
    assert conversations.summarise(conversations.repair(df.where("false"))).count() == 0


def test_query_as_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r.values()) for r in pq.read_table(f"{folder}/conversations.parquet", columns=["conv_id", "turn", "role", "text"]).to_pylist()]
    assert got(QUERIES["op11_conversation_repair"](spark, folder)) == {c: expected(v) for c, v in damaged(rows).items()}
