"""Conversation repair against a search over all edits."""

import hashlib
import random
import re
import zlib
from collections import defaultdict
from functools import lru_cache

import pytest

from feedlake.llm import dialogue_repair as D
from tests.conftest import SF_SMALL

WHITE = "\x20\t\n\x0b\x0c\r"
KIND = "conv_id long, turn long, role string, text string, key string, times long, audit string"


def best(rows):
    """(cost, audit, repaired) by trying every edit, two inserted rows in a row included; rows: (role, text, must go, cut off)."""
    @lru_cache(None)
    def go(i, state, inserted):
        ways = []
        if i == len(rows):
            if state in ("", "a"):
                ways.append((0, "", ()))
        else:
            role, text, gone, cut = rows[i]
            c, a, r = go(i + 1, state, 0)
            ways.append((c + 3, "D" + a, r))
            if not gone:
                allowed = {"": "su", "s": "u", "u": "a", "a": "u"}[state]
                if role[:1] and role[:1] in allowed:
                    c, a, r = go(i + 1, role[0], 0)
                    ways.append((c + cut, "K" + a, (f"{role}:{text}", *r)))
                for to in ("user", "assistant"):
                    if to[0] in allowed:
                        c, a, r = go(i + 1, to[0], 0)
                        ways.append((c + 2 + cut, "R" + a, (f"{to}:{text}", *r)))
        if inserted < 2:
            to = "assistant" if state == "u" else "user"
            c, a, r = go(i, to[0], inserted + 1)
            ways.append((c + 2, "I" + a, (f"{to}:", *r)))
        return min(ways, key=lambda w: w[:2]) if ways else (10 ** 9, "", ())

    return go(0, "", 0)


def brute(rows):
    """The contract's columns of one conversation's rows after damage, in order."""
    seen, marks, counts = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
    for _, role, text in rows:
        blank = not text.strip(WHITE)
        again = not blank and (role, text) in seen
        cut = not blank and not again and text.strip(WHITE)[-1] not in ".!?"
        seen.add((role, text))
        for name, is_so in (("blank", blank), ("duplicate", again), ("truncated", cut)):
            counts[name] += is_so
        marks.append((role, text, blank or again, cut))
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    illegal = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in zip(rows[:-1], rows[1:], strict=True))
    cost, audit, repaired = best(tuple(marks))
    return (gaps, *counts.values(), illegal, cost, audit, hashlib.sha256("\n".join(repaired).encode()).hexdigest())


def damaged(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        out[conv]
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out[conv] += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def key(conv, role, text):
    name = "null" if conv is None else f"={conv}"
    return hashlib.sha256(f"{name}:{len(role)}:{role}{text}".encode()).digest()


def expected(rows):
    want = {}
    for conv, own in damaged(rows).items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), key(conv, r[1], r[2])))
        want[conv] = brute(own)
    return want


@pytest.mark.parametrize("seed", range(3))
def test_audits(seed):
    draw, shared = random.Random(seed), D.Automaton()
    signatures = sorted({"".join(draw.choice("suaxSUAX-") for _ in range(draw.randrange(0, 9))) for _ in range(600)}, key=lambda s: s[::-1])
    for s in signatures:
        rows = tuple(("x" if c == D.GONE else c.lower(), "t", c == D.GONE, c.isupper()) for c in s)
        assert shared.solve(s) == best(rows)[:2], s
    # Common ends are walked once, and nodes fall into few classes.
    assert shared.made < sum(map(len, signatures)) and len(shared.solver.classes) < 100


def test_long_signature():
    cost, audit = D.Automaton().solve("su" + "au" * 200_000)
    assert (cost, len(audit)) == (2, 400_003) and audit.endswith("KI")


def awkward():
    draw = random.Random(5)
    words = ["Yes.", "No!", "Why?", "cut off", "", " \n", "é.", "wait… ", "end. \t", "a.b", ".", None]
    roles = ["user", "assistant", "system", "tool", "", "unit", None, "User"]
    out = [(c if c < 60 else None, draw.choice([None, 0, 1, 2, 3, 4, 9]) if c % 3 == 0 else t, draw.choice(roles[:3] if c % 2 else roles), draw.choice(words))
           for c in range(64) for t in range(draw.randrange(1, 9))]
    out += [(1000, t, "user" if t % 2 == 0 else "assistant", draw.choice(words[:4] + ["x" * 9000 + "."])) for t in range(700)]      # one hot conversation
    out += [(2000 + c, t, "user" if t % 2 == 0 else "assistant", "Hi." if t == 0 else f"So {t}.") for c in range(80) for t in range(4)]
    out += [(3000, None, None, None)] * 3 + [(3001, t, "user", "same.") for t in range(30)]
    return out + out[:20]


def test_repair(spark):
    rows = awkward()
    docs = spark.createDataFrame([(*r, "clash", 7, "clash") for r in rows], KIND).repartition(7)
    got = D.repair(D.damage(docs), times_col="times")
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    # The hot conversation is checked without the search, which is for short ones.
    found = {r[0]: tuple(r[1:]) for r in map(tuple, got.collect())}
    long = found.pop(1000)
    want = expected([r for r in rows if r[0] != 1000])
    assert found == want
    own = sorted(damaged(rows)[1000], key=lambda r: (r[0], r[1], key(1000, r[1], r[2])))
    seen, letters = set(), ""
    for _, role, text in own:
        gone = not text.strip(WHITE) or (role, text) in seen
        seen.add((role, text))
        letters += D.GONE if gone else role[0] if text.strip(WHITE)[-1] in ".!?" else role[0].upper()
    assert long[5:7] == D.Automaton().solve(letters)
    assert long[2] > 0 and sum(x in "KRD" for x in long[6]) == len(own)
    assert D.repair(docs.limit(0)).count() == 0


def test_rows_that_are_not_there(spark):
    rows = spark.createDataFrame([(1, 5, "user", "a.", "", 0, ""), (2, 1, "user", "Hi.", "", 1, ""), (2, 9, "assistant", "Ho.", "", 1, "")], KIND)
    nothing, whole = hashlib.sha256().hexdigest(), hashlib.sha256(b"user:Hi.\nassistant:Ho.").hexdigest()
    assert sorted(map(tuple, D.repair(rows, times_col="times").collect())) == [
        (1, 0, 0, 0, 0, 0, 0, "", nothing), (2, 7, 0, 0, 0, 0, 0, "KK", whole)]


def test_query_matches_search(spark):
    from feedlake.llm.queries import QUERIES
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r[0]: tuple(r[1:]) for r in map(tuple, QUERIES["op11_suffix_dawg_repair"](spark, SF_SMALL).collect())}
    assert got == expected(rows)
