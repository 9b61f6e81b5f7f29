"""Operator 11 against a plain recursion over (cost, audit)."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest
from brute import SF_SMALL

from eventlake.llm import op11_structure_repair as op11

KIND = "conv_id long, turn long, role string, text string, seg long, n long"
NEXT = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
FULL = {"u": "user", "a": "assistant"}


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2) for r in rows], KIND)


def in_order(rows):
    digest = lambda r: hashlib.sha256(f"{len(r[2])}:{r[2]}{r[3]}".encode()).digest()
    return sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], digest(r)))


def brute(rows):
    """The report of one conversation's rows after damage."""
    rows = in_order([(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows])
    faults, seen = [], set()
    for _, _, role, text in rows:
        body = re.sub(r"[ \t-\r]+\Z", "", text)
        kind = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
        seen.add((role, text))
        faults.append(kind)

    @lru_cache(None)
    def best(i, state, inserts=0):
        """(cost, audit, repaired lines) from row i on."""
        found = []
        if i == len(rows) and state in ("", "a"):
            found.append((0, "", ()))
        step = "a" if state == "u" else "u"
        if inserts < 3:
            cost, audit, lines = best(i, step, inserts + 1)
            found.append((cost + 3, "I" + audit, (FULL[step] + ":", *lines)))
        if i < len(rows):
            _, _, role, text = rows[i]
            cost, audit, lines = best(i + 1, state)
            found.append((cost + 4, "D" + audit, lines))
            if faults[i] not in ("blank", "duplicate"):
                late = 3 * (faults[i] == "truncated")
                cost, audit, lines = best(i + 1, step)
                found.append((cost + 3 + late, "R" + audit, (f"{FULL[step]}:{text}", *lines)))
                to = NEXT[state].get(role[:1])
                if to is not None:
                    cost, audit, lines = best(i + 1, to)
                    found.append((cost + late, "K" + audit, (f"{role}:{text}", *lines)))
        return min(found, key=lambda f: f[:2]) if found else (10**9, "", ())

    cost, audit, lines = best(0, "")
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    pairs = [a[2][:1] + b[2][:1] for a, b in zip(rows, rows[1:])]
    counts = [faults.count(k) for k in ("blank", "duplicate", "truncated")]
    return (gaps, *counts, sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def by_conversation(rows):
    out = {}
    for r in rows:
        out.setdefault(r[0], []).append(r)
    return out


def report(df):
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    return {r.conv_id: tuple(r[n] for n in names) for r in df.collect()}


def sample(seed=1, n=400):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(rng.randint(1, 9)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = rng.choice(["Hi.", "Yes!", "What?", "cut", "", " \t", None, "a.\n", f"word {t}.", f"end {c}"])
            rows.append((c, rng.choice([t, t, t, 2 * t, None]), role, text))
    rows += [(None, 1, "user", "No id."), (None, 2, "assistant", "None at all."), (-5, None, None, None)]
    rows += rows[:40]  # repeated rows
    return rows


def long_ones():
    """Conversations of hundreds of rows, one of them the same row again and again."""
    rng = random.Random(4)
    rows = [(9001, t, rng.choice(["user", "assistant", "system", "tool"]), rng.choice(["Ok.", "cut", f"{t}!", ""])) for t in range(150)]
    rows += [(9002, 0, "system", "Be brief.")] + [(9002, 1, "user", "Again!")] * 130 + [(9002, 2, "assistant", "No.")]
    return rows + [(9003, t, "assistant" if t % 2 else "user", f"{t}.") for t in range(101)]


@pytest.mark.parametrize("segment", [1024, 3])
def test_against_recursion(spark, monkeypatch, segment):
    monkeypatch.setattr(op11, "SEGMENT", segment)
    rows = sample(n=400 if segment > 3 else 60) + long_ones()
    df = frame(spark, rows).repartition(7)
    want = {c: brute(r) for c, r in by_conversation(rows).items()}
    assert report(op11._report(df, df)) == want


def test_small_pieces(spark, monkeypatch):
    """Copies and open conversations across the pieces in which rows arrive."""
    monkeypatch.setattr(op11, "PIECE", 4)
    monkeypatch.setattr(op11, "SEGMENT", 10)
    rows = sample(seed=2, n=30) + long_ones()
    df = frame(spark, rows)
    assert report(op11._report(df, df)) == {c: brute(r) for c, r in by_conversation(rows).items()}


def test_rows_of_the_operator(spark):
    rows = [(1, 0, "system", "Rules."), (1, 1, "assistant", "Hello."), (1, 2, "user", "cut"), (1, 3, "user", "Why?")]
    repaired, summary = op11.repair(frame(spark, rows))
    got = [(r.letter, r.role, r.text) for r in repaired.orderBy("seg", "step").collect()]
    one = summary.first()
    assert one.audit == brute(rows)[6] and one.cost == brute(rows)[5]
    assert [g[0] for g in got] == [x for x in one.audit if x != "D"]
    assert re.fullmatch("(s?(ua)+)?", "".join(g[1][0] for g in got))


def test_empty(spark):
    none = frame(spark, [])
    assert op11._report(none, none).collect() == []
    gone = frame(spark, [(4, 1, "user", "x")])
    assert report(op11._report(gone, none)) == {4: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        shown = [" " if v is None else str(v) for v in (conv, turn, role, text)]
        kind = zlib.crc32(f"{shown[0]}:{shown[1]}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", shown[3]) if kind == 2 else shown[3]
        role = "user" if kind == 4 else shown[2]
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def test_query(spark):
    given = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    after = by_conversation(damage(given))
    want = {c: brute(after.get(c, [])) for c in {r[0] for r in given}}
    got = op11.op11_structure_repair(spark, SF_SMALL)
    assert [f.dataType.simpleString() for f in got.schema] == ["bigint"] * 7 + ["string"] * 2
    assert report(got) == want


def test_damage_of_special_rows(spark):
    rows = sample(seed=9, n=80)
    got = sorted(map(repr, map(tuple, op11.damaged(frame(spark, rows)).collect())))
    assert got == sorted(map(repr, damage(rows)))
