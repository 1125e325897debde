"""Conversation repair against an exhaustive search, over few and many blocks."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter

import pytest

from papertrove.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string, part int, kinds string, summary int, digest int, fault int"


def conversations(spark, rows):
    return spark.createDataFrame([(*row, 1, "clash", 2, 3, 4) for row in rows], SCHEMA)


def brute(rows):
    """Faults and the least cheapest audit of sorted ``(turn, role, text)`` rows, by trying every edit from every state."""
    seen, faults = set(), []
    for _, role, text in rows:
        shown = text.rstrip(repair.SPACES)
        fault = "blank" if not shown else "duplicate" if (role, text) in seen else None
        faults.append(fault or ("truncated" if shown[-1] not in ".!?" else None))
        seen.add((role, text))
    best = {"": (0, "", ())}

    def put(into, last, value):
        if last not in into or value[:2] < into[last][:2]:
            into[last] = value

    def inserted(states):
        grown = dict(states)
        for _ in range(4):
            for last, (cost, audit, turns) in list(grown.items()):
                role = "assistant" if last == "u" else "user"
                put(grown, role[0], (cost + 3, audit + "I", (*turns, (role, ""))))
        return grown

    for (_, role, text), fault in zip(rows, faults, strict=True):
        moved = {}
        for last, (cost, audit, turns) in inserted(best).items():
            put(moved, last, (cost + 4, audit + "D", turns))
            if fault in ("blank", "duplicate"):
                continue
            stays = cost + 3 * (fault == "truncated")
            wanted = "assistant" if last == "u" else "user"
            if role[:1] == wanted[0] or (role[:1] == "s" and last == ""):
                put(moved, role[0], (stays, audit + "K", (*turns, (role, text))))
            put(moved, wanted[0], (stays + 3, audit + "R", (*turns, (wanted, text))))
        best = moved
    done = inserted(best)
    cost, audit, turns = min(done[last] for last in ("", "a") if last in done)
    present = [turn for turn, _, _ in rows if turn is not None]
    gaps = max(present) - min(present) + 1 - len(set(present)) if present else 0
    counts = Counter(faults)
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    digest = hashlib.sha256("\n".join(f"{role}:{text}" for role, text in turns).encode()).hexdigest()
    return gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, digest


def expected(rows):
    groups = {}
    for conv, turn, role, text in rows:
        groups.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    out = {}
    for conv, held in groups.items():
        held.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
        out[conv] = brute(held)
    return out


def random_rows(seed, sizes):
    rng = random.Random(seed)
    texts = ["ok.", "yes!", "cut off", "", "  \n", "why?", None, "é.", *(f"text {i}." for i in range(12))]
    rows = []
    for conv, size in sizes:
        for turn in range(size):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "usher"])
            rows.append((conv, rng.choice([turn, turn, turn + 2, None]), role, rng.choice(texts)))
    return rows


def collected(frame):
    found = frame.drop("n_repaired").collect()
    assert len({r["conv_id"] for r in found}) == len(found)
    return {r["conv_id"]: tuple(r)[1:] for r in found}


@pytest.mark.parametrize("block, fan", [(4096, 4096), (3, 2)])
def test_repair_equals_exhaustive_search(spark, monkeypatch, block, fan):
    monkeypatch.setattr(repair, "BLOCK_ROWS", block)
    monkeypatch.setattr(repair, "FAN", fan)
    sizes = [(i, i % 9 + 1) for i in range(40)] + [(50, 150), (None, 30), (-3, 60)]
    rows = random_rows(5, sizes) + [(60, 0, "user", "Hi."), (61, 0, "system", "Be brief."), (62, None, "user", "")]
    assert collected(repair.repair_conversations(conversations(spark, rows))) == expected(rows)


def test_repeated_rows_and_one_long_conversation(spark, monkeypatch):
    monkeypatch.setattr(repair, "BLOCK_ROWS", 64)
    monkeypatch.setattr(repair, "FAN", 4)
    rows = [(1, 5, "user", "same."), (1, 6, "assistant", "x.")] + [(1, 5, "user", "same.")] * 400
    rows += random_rows(6, [(2, 3000)]) + [(3, 1, "user", "word " * 50_000 + ".")]
    found = collected(repair.repair_conversations(conversations(spark, rows)))
    assert found == expected(rows)
    assert found[1][6] == "K" + "D" * 400 + "K"


def test_crossings_agree_with_summaries():
    rng = random.Random(3)
    for _ in range(200):
        kinds = [rng.randrange(12) for _ in range(rng.randrange(1, 30))]
        items = [repair.ROW_ITEMS[k] for k in kinds]
        cut = rng.randrange(len(items) + 1)
        parts = [repair._fold(iter(part)) for part in (items[:cut], items[cut:]) if part]
        whole = repair._fold(iter(items))
        assert repair._fold(iter(parts)) == whole
        costs, places = repair._forward(items, repair.EMPTY)
        assert list(whole[0][repair.EMPTY]) == costs
        leaving = repair.last_state(costs, places)
        states = repair.crossings(items, repair.EMPTY, leaving)
        spent = sum(items[i][0][states[i]][states[i + 1]] for i in range(len(items)))
        assert spent == costs[leaving]


def test_damage(spark):
    rows = [(conv, turn, role, "One. Two!") for conv in (1, 2, None) for turn in (*range(40), None) for role in ("user", "assistant", None)]
    got = Counter(tuple(r) for r in repair.damaged(conversations(spark, rows)).collect())
    want = Counter()
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(key.encode()) % 20
        text = {1: "", 2: "One Two"}.get(fault, text)
        role = "user" if fault == 4 else " " if role is None else role
        want[conv, turn, role, text] += {0: 0, 3: 2}.get(fault, 1)
    assert got == +want


def test_every_conversation_has_a_row(spark):
    dropped = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    row = repair.damage_and_repair(conversations(spark, [(dropped, 0, "user", "Hi.")])).collect()
    nothing = hashlib.sha256().hexdigest()
    assert [tuple(r) for r in row] == [(dropped, 0, 0, 0, 0, 0, 0, "", nothing)]
    assert repair.damage_and_repair(conversations(spark, [])).collect() == []
