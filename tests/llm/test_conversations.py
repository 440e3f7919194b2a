import hashlib
import heapq
import random
import zlib

import pytest

from cadence.llm import conversations as C

SPACES = " \t\n\x0b\x0c\r"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        s = lambda x: " " if x is None else str(x)
        kind = zlib.crc32(f"{s(conv)}:{s(turn)}".encode()) % 20
        role, text = s(role), s(text)
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = text.replace(".", "").replace("!", "").replace("?", "")
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def cheapest(turns):
    """(cost, audit, lines) by a search over (cost, audit) of all edits, one turn and letter at a time."""
    must = {i: f for i, f in enumerate(faults(turns)) if f}
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, state, lines = heapq.heappop(heap)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(turns) and state in ("", "a"):
            return cost, audit, lines
        after = {"": "su", "s": "u", "u": "a", "a": "u"}[state]
        pushes = [("I", 5, i, "user" if "u" in after else "assistant", "")]
        if i < len(turns):
            role, text = turns[i]
            pushes.append(("D", 2, i + 1, None, None))
            if must.get(i) not in ("blank", "duplicate"):
                extra = 5 * (must.get(i) == "truncated")
                if role[:1] and role[:1] in after:
                    pushes.append(("K", extra, i + 1, role, text))
                pushes.append(("R", 1 + extra, i + 1, "user" if "u" in after else "assistant", text))
        for e, c, j, role, text in pushes:
            if role is None:
                heapq.heappush(heap, (cost + c, audit + e, j, state, lines))
            else:
                heapq.heappush(heap, (cost + c, audit + e, j, role[0], (*lines, f"{role}:{text}")))


def faults(turns):
    seen, out = set(), []
    for role, text in turns:
        body = text.strip(SPACES)
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def brute(rows):
    out = {}
    after = damaged(rows)
    for conv in {r[0] for r in rows}:
        mine = sorted((r[1:] for r in after if r[0] == conv), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        numbers = [t for t, _, _ in mine if t is not None]
        turns = [r[1:] for r in mine]
        f = faults(turns)
        cost, audit, lines = cheapest(turns)
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        out[conv] = (max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0, f.count("blank"), f.count("duplicate"),
                     f.count("truncated"), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def report(spark, rows):
    import __spark_entry__  # noqa: F401
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, block int, hash string")
    got = C.conversation_report(C.damage(frame.repartition(3))).collect()
    assert len(got) == len({r.conv_id for r in got})
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in got}


def conversations(rng, n, turns=9):
    rows = []
    for c in range(n):
        conv = None if c == 3 else c
        for t in range(rng.randrange(turns)):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", None, "", "Ä"])
            text = rng.choice(["a.", "b!", "c? \n", "d", " ", "", None, f"é{t}.", "x" * 300 + ".", "a. ", "\x1c"])
            rows.append((conv, rng.choice([t, t, t, None, 2, t + 5]), role, text))
    return rows


def expected(rows):
    """Without the conversations that lost all rows, which the query adds."""
    left = {r[0] for r in damaged(rows)}
    return {k: v for k, v in brute(rows).items() if k in left}


def test_against_search(spark):
    rows = conversations(random.Random(1), 120)
    rows += rows[:40]  # repeated rows
    assert report(spark, rows) == expected(rows)


def test_conversations_over_many_blocks(spark, monkeypatch):
    rng = random.Random(2)
    rows = conversations(rng, 30)
    for t in range(400):  # two hot conversations, one without an id, one of equal rows
        rows.append((777, rng.choice([None, t // 2]), rng.choice(["user", "assistant", "system"]), rng.choice([f"say {t}.", f"say {t % 7}", f"q{t}?", "dup."])))
        rows.append((None, t, ("user", "assistant")[t % 2], f"say {t}."))
        rows.append((778, 5, "user", "same."))
    monkeypatch.setattr(C, "BLOCK_BYTES", 40)
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert C.repair(C.damage(frame)).where("conv_id = 777").count() > 20  # the second stage is reached
    assert report(spark, rows) == expected(rows)


def test_long_runs_match_single_turns():
    rng = random.Random(4)
    for _ in range(300):
        symbols = "".join(rng.choice(C.SYMBOLS) * rng.choice([1, 1, 2, 3, 13, 40]) for _ in range(rng.randrange(5)))
        turns = []
        for i, c in enumerate(symbols):
            role = {"s": "system", "u": "user", "a": "assistant", "o": "tool", "x": "user"}[c.lower()]
            turns.append((role, " " if c == "x" else f"{i}" if c.isupper() else f"{i}."))
        cost, audit, lines = cheapest(turns)
        assert C.repair_symbols(symbols) == (audit, cost)
        text, role = C.edited(audit, symbols, C.START, 0, len(turns))
        texts, roles = [t for _, t in turns] + [""], [r for r, _ in turns] + ["user", "assistant"]
        assert tuple(f"{roles[r]}:{texts[t]}" for r, t in zip(role, text)) == lines
        cut = rng.randrange(len(symbols) + 1)  # by parts
        after = C.times(C.matrix(symbols[cut:]), C.END)
        left, state, total = C.unroll(symbols[:cut], C.START, after, False)
        assert (left + C.unroll(symbols[cut:], state)[0], total) == (audit, cost)


def test_a_million_equal_turns():
    audit, cost = C.repair_symbols("u" * 1_000_000)
    assert (len(audit), cost) == (1_000_000, 500_000)


@pytest.mark.parametrize("rows", [[], [(1, None, None, None)], [(1, 1, "user", "x" * 3_000_000 + ".")]])
def test_small_tables(spark, rows):
    assert report(spark, rows) == expected(rows)


def test_query_keeps_conversations_without_rows(spark, tmp_dir):
    rows = conversations(random.Random(5), 60, 3)
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_dir}/conversations.parquet")
    got = {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256)
           for r in C.op12_conversation_repair(spark, tmp_dir).collect()}
    assert got == brute(rows)
    assert len(got) > len({r[0] for r in damaged(rows)})
