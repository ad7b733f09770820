"""Conversation repair against a plain dynamic programme that keeps the least audit per state."""
import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from segmark.llm import conversations as cv
from segmark.llm.queries import QUERIES

BLANKS = " \t\n\v\f\r"
ROW = "conv_id long, turn long, role string, text string, state int, cost string, part string"


def hurt(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        convs[conv]
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        convs[conv] += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return convs


def repaired(rows):
    """gaps, blank, duplicate, truncated, illegal, cost, audit, repaired of one conversation's rows."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    seen, faults = set(), []
    for _, role, text in rows:
        shown = text.rstrip(BLANKS)
        faults.append("blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else "")
        seen.add((role, text))
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    best = {"": (0, "", ())}  # by the initial of the last row written

    def put(to, key, value):
        if key not in to or value[:2] < to[key][:2]:
            to[key] = value

    def grown(best):
        for _ in range(3):
            for x, (c, a, o) in list(best.items()):
                y = "a" if x == "u" else "u"
                put(best, y, (c + 3, a + "I", (*o, {"u": "user:", "a": "assistant:"}[y])))
        return best

    for (_, role, text), fault in zip(rows, faults):
        new = {}
        for x, (c, a, o) in grown(best).items():
            put(new, x, (c + 4, a + "D", o))
            if fault in ("blank", "duplicate"):
                continue
            c += 3 * bool(fault)
            y = "a" if x == "u" else "u"
            put(new, y, (c + 3, a + "R", (*o, {"u": "user", "a": "assistant"}[y] + ":" + text)))
            if role[:1] == y:
                put(new, y, (c, a + "K", (*o, f"{role}:{text}")))
            if role[:1] == "s" and x == "":
                put(new, "s", (c, a + "K", (*o, f"{role}:{text}")))
        best = new
    best = grown(best)
    c, a, o = min((best[x] for x in ("", "a") if x in best), key=lambda v: v[:2])
    return (gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, c, a, "\n".join(o))


def got(df):
    cols = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired")
    rows = cv.repair_conversations(df).collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: tuple(r[c] for c in cols) for r in rows}


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "c", "p") for r in rows], ROW)


def by_conv(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        out[conv].append((turn, " " if role is None else role, " " if text is None else text))
    return {c: repaired(r) for c, r in out.items()}


def noisy(rng, convs, longest):
    texts = ["Fine.", "Why?", "no stop", "", " \t", "Yes! \n", "x" * 300 + ".", None]
    roles = ["user", "assistant", "system", "tool", "u", "", None]
    return [(c, rng.choice([None, *range(longest)]) if rng.random() < 0.2 else t, rng.choices(roles, [9, 9, 2, 1, 1, 1, 1])[0],
             rng.choice(texts) if rng.random() < 0.5 else f"Turn {rng.random()}.") for c in convs for t in range(rng.randint(1, longest))]


def test_any_rows_in_any_chunks(spark, monkeypatch):
    rng = random.Random(1)
    rows = noisy(rng, [None, *range(60)], 14) + noisy(rng, [99], 700)
    rows += [(7, 3, "user", "Same."), (7, 3, "user", "Same."), (8, None, None, None)] * 5
    want = by_conv(rows)
    for size in (1 << 12, 5):
        monkeypatch.setattr(cv, "CHUNK_ROWS", size)
        assert got(table(spark, rows)) == want


def test_costs_that_never_converge(spark, monkeypatch):
    """Rows of unknown roles swap the two states for ever: every pass settles one more chunk."""
    monkeypatch.setattr(cv, "CHUNK_ROWS", 9)
    rows = [(1, t, "tool", f"Text {t}.") for t in range(101)] + [(2, t, "user", "Again.") for t in range(60)] + [(3, 0, "system", "Only.")]
    assert got(table(spark, rows)) == by_conv(rows)


def test_passes_stop_when_costs_differ_by_constants(spark, monkeypatch):
    monkeypatch.setattr(cv, "CHUNK_ROWS", 20)
    runs = []
    real = cv._rerun
    monkeypatch.setattr(cv, "_rerun", lambda df: runs.append(1) or real(df))
    rng = random.Random(3)
    rows = [(1, t, rng.choice(["user", "assistant"]), f"Text {t}.") for t in range(900)]
    assert got(table(spark, rows)) == by_conv(rows)
    assert len(runs) <= 4  # 45 chunks


def test_empty(spark):
    assert got(table(spark, [])) == {}
    assert cv.repaired_after_damage(table(spark, [])).collect() == []


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_on_the_given_table(spark, sf):
    path = f"/root/testdata/{sf}"
    rows = [tuple(r) for r in spark.read.parquet(f"{path}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = {c: repaired(r) if r else (0, 0, 0, 0, 0, 0, "", "") for c, r in hurt(rows).items()}
    df = QUERIES["op13_conversation_repair"](spark, path)
    assert {r.conv_id: tuple(r)[1:] for r in df.collect()} == {c: (*w[:-1], hashlib.sha256(w[-1].encode()).hexdigest()) for c, w in want.items()}


def test_a_conversation_without_rows_is_returned(spark):
    gone = next((c, t) for c in range(100) for t in range(50) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0)
    r = cv.repaired_after_damage(table(spark, [(*gone, "user", "Hello.")])).first()
    assert (r.conv_id, r.gaps, r.cost, r.audit, r.repaired) == (gone[0], 0, 0, "", "")
