"""Repair of conversations against an exhaustive search and SQL."""

import hashlib
import heapq
import random
import re
import zlib

import pytest
from llm_data import TINY

from tierstone.llm import conversations, queries

SCHEMA = "conv_id long, turn long, role string, text string, part int, digest string, cost long, c long, kind string"
BLANK = " \t\n\x0b\x0c\r"


def plain_faults(rows):
    found, seen = [], set()
    for _, role, text in rows:
        body = text.strip(BLANK)
        if not body:
            found.append("blank")
        elif (role, text) in seen:
            found.append("duplicate")
        else:
            found.append("fine" if body[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return found


def plain_edits(rows, faults):
    """Cheapest first, then by letters, over (row, initials so far) until a legal end."""
    legal, open_ = re.compile("(s?(ua)+)?"), re.compile("s?(ua)*u?")
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, letters, i, initials, lines = heapq.heappop(heap)
        state = (i, "s" if initials == "s" else initials[-1:])
        if i == len(rows) and legal.fullmatch(initials):
            return cost, letters, "\n".join(lines)
        if state in done:
            continue
        done.add(state)
        steps = [(2, "I", 0, x, f"{r}:") for x, r in (("u", "user"), ("a", "assistant"))]
        if i < len(rows):
            _, role, text = rows[i]
            steps.append((3, "D", 1, "", None))
            if faults[i] in ("fine", "truncated"):
                more = faults[i] == "truncated"
                steps.append((more, "K", 1, role[:1] or "-", f"{role}:{text}"))
                steps += [(2 + more, "R", 1, r[0], f"{r}:{text}") for r in ("user", "assistant")]
        for price, letter, rows_on, x, line in steps:
            if open_.fullmatch(initials + x):
                after = lines if line is None else (*lines, line)
                heapq.heappush(heap, (cost + price, letters + letter, i + rows_on, initials + x, after))


def plainly(rows):
    found = []
    for conv_id in {r[0] for r in rows}:
        kept = [(t, " " if role is None else role, " " if text is None else text) for c, t, role, text in rows if c == conv_id]
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
        faults = plain_faults(kept)
        cost, letters, text = plain_edits(kept, faults)
        turns = {r[0] for r in kept} - {None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(kept, kept[1:])]
        found.append((
            conv_id, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, letters, hashlib.sha256(text.encode()).hexdigest(),
        ))
    return sorted(found, key=repr)


def ours(spark, rows):
    df = spark.createDataFrame([(*r, 1, "d", 2, 3, "k") for r in rows], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in conversations.repair(df).collect()), key=repr)


def invented(seed, conversations_, longest):
    rng, rows = random.Random(seed), []
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "User", "", None]
    texts = ["Yes.", "No", "", " \n", "Why?", "Stop!\t", "half a sent", "Ünicode… ok.", None, "a.\nb"]
    for c in range(conversations_):
        for t in range(rng.randrange(longest + 1)):
            turn = rng.choice([t, t, t, t + 1, None])
            rows.append((c, turn, rng.choice(roles), rng.choice(texts)))
    return rows


@pytest.mark.parametrize("segment", [1, 3, 4096])
def test_equals_exhaustive_search(spark, monkeypatch, segment):
    monkeypatch.setattr(conversations, "SEGMENT", segment)
    rows = invented(segment, 150, 9)
    assert ours(spark, rows) == plainly(rows)


def test_segments_change_no_edit(monkeypatch):
    rng = random.Random(5)
    codes = bytes(rng.choice([0, 4, 8, 4, 8, 12, 5, 9, 10, 3]) for _ in range(700))
    whole = conversations.cheapest_edits(codes)
    for segment in (1, 7, 64, 700, 701):
        monkeypatch.setattr(conversations, "SEGMENT", segment)
        assert conversations.cheapest_edits(codes) == whole


def test_auction_prices_are_distances():
    """Against sums over all ways through two layers."""
    behind = (5, 0, 3, 1)
    for initial in "sua?":
        for fault in range(4):
            prices = conversations.layer_prices(initial, fault, behind)
            for q in range(4):
                ways, state, paid = [], q, 0
                for _ in range(4):
                    ways += [paid + c + behind[z] for _, c, z in conversations._arcs(state, initial, fault)]
                    state, paid = conversations.TURN_AFTER[state], paid + conversations.INSERT
                assert prices[q] == min(ways)


def test_one_conversation_with_most_rows(spark):
    rng = random.Random(8)
    rows = [(7, t, rng.choice(["user", "assistant"]), f"{rng.randrange(300)}.") for t in range(3000)]
    rows += [(7, 5, "user", "again and again.")] * 500 + [(c, 0, "user", "Hi.") for c in range(20, 60)]
    (found,) = [r for r in ours(spark, rows) if r[0] == 7]
    kept = sorted(
        ((t, r, x) for c, t, r, x in rows if c == 7), key=lambda r: (r[0], r[1], hashlib.md5(r[2].encode()).hexdigest())
    )
    faults = plain_faults(kept)
    codes = bytes(conversations.row_code(r, ("fine", "blank", "duplicate", "truncated").index(f)) for (_, r, _), f in zip(kept, faults))
    assert (found[6], found[7]) == conversations.cheapest_edits(codes)
    assert found[3] == faults.count("duplicate") > 2000 and found[7].count("I") + 3500 == len(found[7])


def test_odd_rows(spark):
    rows = [(None, None, None, None), (None, 3, "user", "Hm."), (1, None, "system", "S."), (1, None, "system", "S."),
            (2, -5, "user", "x" * 200_000), (2, 9, "assistant", "fine."), (3, 0, "s", "."), (4, 1, "assistant", None)]
    assert ours(spark, rows) == plainly(rows)
    assert ours(spark, []) == []


def test_damage_follows_the_checksum(spark):
    rows = [(c, t, "assistant", "One. Two!") for c in range(40) for t in range(3)] + [(None, None, None, None), (50, None, None, "x")]
    df, dropped = conversations.damage(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    found = sorted((tuple(r) for r in df.collect()), key=repr)
    wanted = []
    for c, t, role, text in rows:
        space = lambda x: " " if x is None else str(x)
        kind = zlib.crc32(f"{space(c)}:{space(t)}".encode()) % 20
        role, text = space(role), space(text)
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        wanted += [(c, t, "user" if kind == 4 else role, text, kind == 0)] * (2 if kind == 3 else 1)
    assert found == sorted(wanted, key=repr)
    assert {r[4] for r in found} == {True, False}


def test_conversation_without_rows_left(spark):
    df = spark.createDataFrame([(1, 0, "user", "A."), (2, 0, "user", "B.")], "conv_id long, turn long, role string, text string")
    found = {r["conv_id"]: tuple(r)[1:] for r in conversations.repair(df, dropped=df["conv_id"] == 1).collect()}
    assert found[1] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert found[2] == (0, 0, 0, 0, 0, 2, "KI", hashlib.sha256(b"user:B.\nassistant:").hexdigest())


def test_query_equals_sql(spark, duck):
    df = queries.QUERIES["op12_auction_repair"](spark, TINY)
    answer = duck.sql(f"SELECT {', '.join(df.columns)} FROM ({queries.ORACLES['op12_auction_repair']})").fetchall()
    assert sorted((tuple(r) for r in df.collect()), key=repr) == sorted(answer, key=repr) != []
