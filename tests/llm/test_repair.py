"""Conversation repair against enumeration and against a walk over grammar states."""

import hashlib
import random
import re
from itertools import product

import pytest

from slotwise.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string, span int, seg string, audit int"


def brute(codes, entry=repair.START, close=None):
    """(cost, audit) by trying all edits; at most one insert before a kept turn, as more never pay."""
    best = None
    for edits in product(("D", "T", "IT", "IIT"), repeat=len(codes)):
        for tail in ("", "I", "II"):
            cost, audit, out, ok = 0, "", "", True
            for code, edit in zip(codes, edits, strict=True):
                if edit == "D":
                    cost, audit = cost + 3, audit + "D"
                    continue
                for _ in edit[:-1]:
                    out += "a" if out.endswith("u") else "u"
                    cost, audit = cost + 2, audit + "I"
                role = "?sua"[code & 3]
                want = "a" if out.endswith("u") else "u"
                cost += bool(code & 4)
                if role == want or (role == "s" and out == ""):
                    out, audit = out + role, audit + "K"
                else:
                    out, audit, cost = out + want, audit + "R", cost + 2
            for _ in tail:
                out += "a" if out.endswith("u") else "u"
                cost, audit = cost + 2, audit + "I"
            ok = re.fullmatch("(s?(ua)+)?", out)
            if ok and (best is None or (cost, audit) < best):
                best = (cost, audit)
    return best


def test_aligned_like_enumeration():
    rnd = random.Random(2)
    for n in (0, 1, 2, 3, 4, 5):
        for _ in range(60):
            codes = bytes(rnd.randrange(8) for _ in range(n))
            cost, audit, state = repair.aligned(codes, repair.START, repair.CLOSE)
            assert (cost + repair.CLOSE[state], audit + repair.CLOSING[state]) == brute(codes), codes


def expected(turns):
    """Every conversation by a walk that keeps the best (cost, audit) for each grammar state."""
    out = {}
    for conv in {t[0] for t in turns}:
        rows = []
        for _, turn, role, text, *_ in (t for t in turns if t[0] == conv):
            role, text = " " if role is None else role, " " if text is None else text
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            rows.append(((turn is not None, turn or 0), role, digest, text, turn))
        rows.sort(key=lambda r: r[:3])
        seen, ways = set(), {0: (0, "", ())}
        sums = dict(blank=0, duplicate=0, truncated=0, illegal=0)
        for k, (_, role, _, text, _) in enumerate(rows):
            core = text.strip(" \t\n\v\f\r")
            sums["illegal"] += k > 0 and rows[k - 1][1][:1] + role[:1] not in ("su", "ua", "au")
            fault = "blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                sums[fault] += 1
            cut, after = fault == "truncated", {}

            def offer(state, way):
                if state not in after or way[:2] < after[state][:2]:
                    after[state] = way

            for state, (cost, audit, said) in ways.items():
                offer(state, (cost + 3, audit + "D", said))
                if fault in ("blank", "duplicate"):
                    continue
                if state == 0 and role[:1] == "s":
                    offer(1, (cost + cut, audit + "K", (*said, f"{role}:{text}")))
                at = state
                for insert in range(2):
                    new = 3 if at == 2 else 2
                    own = role[:1] == "?sua"[new]
                    inserted = ("assistant:" if state == 2 else "user:",) * insert
                    line = f"{role if own else 'user' if new == 2 else 'assistant'}:{text}"
                    offer(new, (cost + 2 * insert + cut + (0 if own else 2), audit + "I" * insert + "KR"[not own], (*said, *inserted, line)))
                    at = 3 if at == 2 else 2
            ways = after
        ends = []
        for state, (cost, audit, said) in ways.items():
            more = {0: (), 1: ("user:", "assistant:"), 2: ("assistant:",), 3: ()}[state]
            ends.append((cost + 2 * len(more), audit + "I" * len(more), said + more))
        cost, audit, said = min(ends)
        numbers = {r[4] for r in rows} - {None}
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        out[conv] = (gaps, *sums.values(), cost, audit, hashlib.sha256("\n".join(said).encode()).hexdigest())
    return out


def reported(turns, rows, size=repair.SEGMENT):
    plain, found = repair.repairs(rows, size)
    lines = repair.repaired(plain, found)
    return {r.conv_id: tuple(r)[1:] for r in repair.report(turns, found, lines).collect()}


@pytest.mark.parametrize("size", [4, 512])
def test_repair_like_a_walk_over_states(spark, size):
    rnd = random.Random(7)
    roles = ["user", "assistant", "user", "assistant", "user", "system", "tool", "", None, "ux"]
    texts = ["Well.", "So", "", " \n", "Yes!", None, "é?", "Is it? \t", "more. x", "z" * 3000 + "."]
    turns = []
    for conv in [*range(60), None]:
        for turn in range(rnd.randrange(1, 14)):
            row = (conv, rnd.choice([turn, turn, turn, turn + 3, None]), rnd.choice(roles[rnd.randrange(3) :]), rnd.choice([*texts, f"T{rnd.random()}."]), 1, "x", 2)
            turns += [row] * rnd.choice([1, 1, 1, 3])
    for turn in range(700):  # a long one, over several ranges and segments
        turns.append((99, turn, rnd.choice(["user", "assistant"]) if rnd.random() < 0.2 else ("user", "assistant")[turn % 2], f"{turn}{rnd.choice('..x')}", 1, "x", 2))
    rnd.shuffle(turns)
    rows = spark.createDataFrame(turns, SCHEMA).repartition(5)
    assert reported(rows, rows, size) == expected(turns)


def test_repair_of_nothing(spark):
    rows = spark.createDataFrame([(1, 0, "user", "hi.", 1, "x", 2), (None, None, None, None, 1, "x", 2)], SCHEMA)
    empty = hashlib.sha256(b"").hexdigest()
    assert reported(rows, rows.where("false")) == {1: (0, 0, 0, 0, 0, 0, "", empty), None: (0, 0, 0, 0, 0, 0, "", empty)}
    assert reported(rows.where("false"), rows.where("false")) == {}
    got = reported(rows, rows)
    assert got[None] == (0, 1, 0, 0, 0, 3, "D", empty) and got[1][5:7] == (2, "KI")


def test_repaired_turns_follow_the_grammar(spark):
    rnd = random.Random(3)
    turns = [(c, t, rnd.choice(["user", "assistant", "system"]), f"{c}-{t}.", 1, "x", 2) for c in range(20) for t in range(rnd.randrange(9))]
    rows, found = repair.repairs(spark.createDataFrame(turns, SCHEMA))
    said = {}
    for r in repair.repaired(rows, found).orderBy("conv_id", "span", "seg", "i").collect():
        said.setdefault(r.conv_id, []).append(r)
        assert r.edit in "KRI" and (r.edit == "I") == (r.turn is None) == (r.text == "")
    assert said
    for some in said.values():
        assert re.fullmatch("(s?(ua)+)?", "".join(r.role[0] for r in some))
