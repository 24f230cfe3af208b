"""Conversation repair against plain dynamic programming and against all sequences of edits."""

from collections import defaultdict
import hashlib
import itertools
import re
import zlib

from hypothesis import given, settings, strategies as st

from skyledger.llm import repair
from skyledger.llm.repair import Conversation, audited, damaged, repaired

FOLLOWS = {("0", "s"): "s", ("0", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def cheapest(rows):
    """(cost, audit) by a table of whole strings; rows of (initial, must go, truncated)."""

    def inserted(best):
        for _ in range(3):
            for (s, said), e in FOLLOWS.items():
                if s in best and said != "s":
                    way = (best[s][0] + 2, best[s][1] + "I")
                    best[e] = min(best.get(e, way), way)
        return best

    best = inserted({"0": (0, "")})
    for initial, gone, cut in rows:
        now = {}
        for s, (cost, audit) in best.items():
            ways = [(s, cost + 3, "D")]
            for said in "" if gone else "sua":
                if (s, said) in FOLLOWS and (said == initial or said != "s"):
                    ways.append((FOLLOWS[s, said], cost + cut + 2 * (said != initial), "K" if said == initial else "R"))
            for e, c, x in ways:
                now[e] = min(now.get(e, (c, audit + x)), (c, audit + x))
        best = inserted(now)
    return min(best[s] for s in "0a" if s in best)


def of_all(rows):
    """(cost, audit) by trying every sequence of edits, up to two inserts in a place."""
    best = None
    for edits in itertools.product("DKR", repeat=len(rows)):
        for puts in itertools.product(range(3), repeat=len(rows) + 1):
            audit, state, cost = "I" * puts[0], "0", 0
            for edit, (initial, gone, cut), n in zip(edits, rows, puts[1:]):
                audit += edit + "I" * n
                cost += {"D": 3, "K": 0, "R": 2}[edit] + (cut if edit != "D" else 0)
                if gone and edit != "D":
                    break
            else:
                k = iter(rows)
                for edit in audit:
                    initial = next(k)[0] if edit != "I" else None
                    if edit == "D":
                        continue
                    said = initial if edit == "K" else "a" if state == "u" else "u"
                    state = FOLLOWS.get((state, said))
                    if state is None:
                        break
                else:
                    way = (cost + 2 * sum(puts), audit)
                    if state in "0a" and (best is None or way < best):
                        best = way
    return best


def run(rows):
    """(cost, audit) of the library, and the most rows it held back."""
    c, out, held = Conversation(1), [], 0
    for k, (initial, gone, cut) in enumerate(rows):
        out += c.row(k, {"s": "system", "u": "user", "a": "assistant"}.get(initial, initial), f"t{k}", "blank" if gone else "truncated" if cut else None)
        held = max(held, len(c.waiting))
    out += c.end()
    assert [e[1] for e in out] == list(range(len(out)))
    return (sum(e[6] for e in out), "".join(e[2] for e in out)), held


ROWS = st.lists(st.tuples(st.sampled_from("suax"), st.booleans() | st.just(False), st.integers(0, 1)))


@settings(max_examples=400, deadline=None)
@given(ROWS)
def test_cheapest_edits(rows):
    assert run(rows)[0] == cheapest(rows)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("suax"), st.booleans() | st.just(False), st.integers(0, 1)), max_size=4))
def test_all_sequences_of_edits(rows):
    assert run(rows)[0] == of_all(rows)


def test_only_the_unresolved_end_is_held():
    rows = [("s", False, 0)] + [("u", False, 0), ("a", False, 1), ("a", False, 0), ("u", True, 0), ("u", False, 0), ("a", False, 0)] * 3000
    way, held = run(rows)
    assert held < 20 and len(way[1].replace("I", "")) == len(rows)


def test_survivors_that_never_meet():
    """All turns of one role: two phases stay alike to the end; the whole ends are compared, quickly."""
    rows = [("u", False, 0)] * 20_000
    way, _ = run(rows)
    assert way[0] == 20_000
    short = [("u", False, 0)] * 301
    assert run(short)[0] == cheapest(short)


def hurt(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        n = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if n:
            text = {1: "", 2: re.sub("[.!?]", "", text)}.get(n, text)
            out += [(conv, turn, "user" if n == 4 else role, text)] * (2 if n == 3 else 1)
    return out


def by_hand(rows):
    turns = defaultdict(list)
    for r in hurt(rows):
        turns[r[0]].append(r[1:])
    out = []
    for conv in {r[0] for r in rows}:
        told = sorted(turns[conv], key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        faults, seen, plain = [], set(), []
        for turn, role, text in told:
            said = text.encode().strip(b" \t\n\x0b\x0c\r").decode()
            fault = "blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else None
            seen.add((role, text))
            faults.append(fault)
            plain.append((role[:1], fault in ("blank", "duplicate"), int(fault == "truncated")))
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(plain, plain[1:]))
        cost, audit = cheapest(plain)
        lines, state, k = [], "0", iter(told)
        for edit in audit:
            _, role, text = next(k) if edit != "I" else (None, None, "")
            if edit == "D":
                continue
            if edit != "K":
                role = "assistant" if state == "u" else "user"
            state = FOLLOWS[state, role[:1]]
            lines.append(f"{role}:{text}")
        known = [t for t, _, _ in told if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        out.append((conv, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def found(told):
    return sorted((tuple(r) for r in audited(repaired(damaged(told)), told).select(COLUMNS).collect()), key=repr)


def test_odd_conversations(spark):
    rows = [(c, t, ("user", "assistant", "system", None, "", "usher")[(c * 7 + t * t) % 6], (None, "", "Yes.", "no", "ok! \n", "é?\x1c", "long " * 9000)[(c + 3 * t) % 7]) for c in range(60) for t in range(c % 13)]
    rows += rows[:50] + [(None, t, "user", f"x{t}.") for t in range(4)] + [(70, None, "user", "a."), (70, None, None, None), (70, 9, "user", "a."), (71, 5, "assistant", "q")]
    rows += [(72, t, "user", "same text") for t in range(400)] + [(73 + k, 0, "user", "hi.") for k in range(60)]
    told = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, fault string, place int")
    assert found(told) == by_hand(rows)
    assert found(told.limit(0)) == []
    edits = repaired(told)
    assert edits.columns == ["conv_id", "place", "edit", "turn", "fault", "breaks", "cost", "role", "text"]
    assert edits.where("edit <> 'I'").count() == len(rows)


def test_conversations_that_lose_all_rows(spark):
    gone = [c for c in range(400) if zlib.crc32(f"{c}:0".encode()) % 20 == 0][:3]
    told = spark.createDataFrame([(c, 0, "user", "hi.") for c in gone], "conv_id long, turn long, role string, text string")
    empty = hashlib.sha256(b"").hexdigest()
    assert found(told) == sorted(((c, 0, 0, 0, 0, 0, 0, "", empty) for c in gone), key=repr)


def test_named_columns_and_clashes(spark):
    rows = spark.createDataFrame([("c", 1.5, "user", "hi.", 3)], "thread string, at double, who string, said string, of int")
    edits = repaired(rows, "thread", "at", "who", "said").collect()
    assert [(e.thread, e.edit, e.who, e.said) for e in edits] == [("c", "K", "user", "hi."), ("c", "I", "assistant", "")]
    assert repair.KEEP == "K"
