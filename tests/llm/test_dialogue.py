import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

from doctext.llm.dialogue import Parse, damage, faults, parse, repair, repaired, undamaged
from doctext.llm.queries import QUERIES

SPACE = " \t\n\x0b\x0c\r"
NAMES = {"u": "user", "a": "assistant"}


def search(rows):
    """(cost, audit, repaired text) by search over whole audits and outputs."""
    heap, best = [(0, "", 0, "", ())], None
    while heap:
        cost, audit, i, out, lines = heapq.heappop(heap)
        if best and cost > best[0]:
            break
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", out) and (best is None or (cost, audit) < best[:2]):
            best = (cost, audit, "\n".join(lines))
        if not re.fullmatch("s?(ua)*u?", out):
            continue
        for x, name in NAMES.items():
            heapq.heappush(heap, (cost + 2, audit + "I", i, out + x, (*lines, name + ":")))
        if i < len(rows):
            role, text, go, cut = rows[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, out, lines))
            if not go:
                heapq.heappush(heap, (cost + cut, audit + "K", i + 1, out + (role[:1] or "?"), (*lines, f"{role}:{text}")))
                for x, name in NAMES.items():
                    heapq.heappush(heap, (cost + 2 + cut, audit + "R", i + 1, out + x, (*lines, f"{name}:{text}")))
    return best


def walk(rows):
    """The same by recursion over rests, for long conversations: the first
    letters of equally cheap ways always differ."""
    moves = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    rest = {"": (0, "", ()), "a": (0, "", ())}

    def insert(rest):
        for _ in range(4):
            for q in ("", "s", "u", "a"):
                for x, name in NAMES.items():
                    if (q, x) in moves and moves[q, x] in rest:
                        c, a, t = rest[moves[q, x]]
                        if q not in rest or (c + 2, "I" + a) < rest[q][:2]:
                            rest[q] = (c + 2, "I" + a, (name + ":", t))
        return rest
    rest = insert(rest)
    for role, text, go, cut in reversed(rows):
        new = {}
        for q in ("", "s", "u", "a"):
            ways = [(rest[q][0] + 3, "D" + rest[q][1], rest[q][2])]
            if not go:
                if (q, role[:1]) in moves:
                    c, a, t = rest[moves[q, role[:1]]]
                    ways.append((c + cut, "K" + a, (f"{role}:{text}", t)))
                for x, name in NAMES.items():
                    if (q, x) in moves:
                        c, a, t = rest[moves[q, x]]
                        ways.append((c + 2 + cut, "R" + a, (f"{name}:{text}", t)))
            new[q] = min(ways, key=lambda w: w[:2])
        rest = insert(new)
    cost, audit, t = rest[""]
    lines = []
    while t:
        lines.append(t[0])
        t = t[1]
    return cost, audit, "\n".join(lines)


def brute(rows, hurt=True):
    """All of the operator in plain Python, from (conv_id, turn, role, text)."""
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        n = lambda v: " " if v is None else str(v)
        kind = zlib.crc32(f"{n(conv)}:{n(turn)}".encode()) % 20 if hurt else 9
        role, text = n(role), n(text)
        groups[conv]
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        groups[conv] += [(turn, role, text)] * (2 if kind == 3 else 1)
    out = {}
    for conv, got in groups.items():
        got.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, taken, count = set(), [], dict(blank=0, duplicate=0, truncated=0)
        for turn, role, text in got:
            bare = text.strip(SPACE)
            fault = ("blank" if not bare else "duplicate" if (role, text) in seen
                     else "truncated" if bare[-1] not in ".!?" else None)
            seen.add((role, text))
            if fault:
                count[fault] += 1
            taken.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
        turns = {t for t, _, _ in got if t is not None}
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(taken, taken[1:]))
        cost, audit, text = walk(taken)
        out[conv] = (conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, *count.values(), illegal, cost, audit,
                     hashlib.sha256(text.encode()).hexdigest())
    return out


def test_parser_against_search():
    rng = random.Random(1)
    for _ in range(600):
        rows = [(rng.choice(["system", "user", "assistant", "user", "assistant", "tool", ""]), rng.choice("xyz"),
                 rng.random() < .15, rng.random() < .2) for _ in range(rng.randint(0, 6))]
        p = Parse()
        for r in rows:
            p.row(*r)
        cost, audit, digest = p.end()
        want = search(rows)
        assert (cost, audit, digest) == (*want[:2], hashlib.sha256(want[2].encode()).hexdigest())
        assert walk(rows) == want


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r[0]: tuple(r) for r in QUERIES["op11_conversations"](spark, sf).collect()}
    assert got == brute(rows)


NASTY = [
    (1, 0, "user", "Hi."), (1, 1, "assistant", None), (1, None, "system", "Be kind."), (2, 0, None, "x."),
    (2, 0, None, "x."), (None, None, None, None), (None, 3, "user", "a?"), (None, 3, "assistant", "b"), (3, 7, "tool", " \t\n"),
    (4, 0, "user", "long word " * 20000), (4, 1, "user", "é ü."), (4, 2, "", "."), (5, 4, "userx", "x!"), (5, 4, "Xser", "x!"),
] + [(6, t, "user", "same.") for t in range(400)] + [(7, 5, "user", "Again.")] * 50


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, gone int, fault string")


def test_nasty_rows(spark):
    df = frame(spark, NASTY)
    assert {r[0]: tuple(r) for r in repair(damage(df)).collect()} == brute(NASTY)
    assert {r[0]: tuple(r) for r in repair(undamaged(df)).collect()} == brute(NASTY, hurt=False)


def test_all_rows_dropped_and_empty_table(spark):
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    assert [tuple(r) for r in repair(damage(frame(spark, [(gone, 0, "user", "x.")]))).collect()] == [
        (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert repair(damage(frame(spark, []))).count() == 0


def test_repaired_rows_have_the_digest(spark):
    df = damage(frame(spark, NASTY))
    lines = defaultdict(list)
    for r in repaired(df).orderBy("conv_id", "seq").collect():
        lines[r["conv_id"]].append(f"{r['role']}:{r['text']}")
    for r in parse(faults(df)).collect():
        assert hashlib.sha256("\n".join(lines[r["conv_id"]]).encode()).hexdigest() == r["repaired_sha256"]
