import hashlib
import random
import re
import zlib
from itertools import product

from axonweave.llm import conversations as C
from axonweave.llm.conversations import damaged, outcome, parse, repair, repaired, structure_repair

SCHEMA = "conv_id long, turn long, role string, text string"
LEGAL = re.compile("(s?(ua)+)?")


def by_every_edit(classes):
    """All edits of each row with all insertions between them."""
    rows = [(classes[i], classes[i + 1]) for i in range(0, len(classes), 2)]
    ways = []
    for initial, fault in rows:
        cut = fault == "t"
        ways.append([("D", "", 3)] + ([] if fault == "d" else [("K", initial, cut), ("R", "u", 2 + cut), ("R", "a", 2 + cut)]))
    inserts = ["", "u", "a", "ua", "au"]
    best = None
    for plan in product(*ways):
        for gaps in product(inserts, repeat=len(rows) + 1):
            roles = gaps[0] + "".join(p[1] + g for p, g in zip(plan, gaps[1:]))
            if LEGAL.fullmatch(roles):
                cost = sum(p[2] for p in plan) + 2 * sum(map(len, gaps))
                audit = "I" * len(gaps[0]) + "".join(p[0] + "I" * len(g) for p, g in zip(plan, gaps[1:]))
                best = min(best or (cost, audit), (cost, audit))
    return best


def row_by_row(rows):
    """rows (initial, fault) -> cost and audit, from left to right."""
    def closed(at):
        for _ in range(4):
            for i, (c, a) in list(at.items()):
                for r in "ua":
                    j = C.STEPS.get((i, r))
                    if j is not None:
                        at[j] = min(at.get(j, (c + 2, a + "I")), (c + 2, a + "I"))
        return at

    at = closed({0: (0, "")})
    for initial, fault in rows:
        then = {}
        for i, (c, a) in at.items():
            ways = [(i, c + 3, a + "D")]
            if fault not in ("blank", "duplicate"):
                cut = fault == "truncated"
                ways += [(C.STEPS[i, initial], c + cut, a + "K")] if (i, initial) in C.STEPS else []
                ways += [(C.STEPS[i, r], c + 2 + cut, a + "R") for r in "ua" if (i, r) in C.STEPS]
            for j, cost, audit in ways:
                then[j] = min(then.get(j, (cost, audit)), (cost, audit))
        at = closed(then)
    return min(at[j] for j in (0, 3) if j in at)


def brute(rows):
    """Original rows (conv_id, turn, role, text) -> what the query returns."""
    some = lambda x: " " if x is None else str(x)
    groups = {r[0]: [] for r in rows}
    for conv, turn, role, text in rows:
        role, text, d = some(role), some(text), zlib.crc32(f"{some(conv)}:{some(turn)}".encode()) % 20
        if d:
            text = "" if d == 1 else re.sub("[.!?]", "", text) if d == 2 else text
            groups[conv] += [(turn, "user" if d == 4 else role, text)] * (2 if d == 3 else 1)
    out = {}
    for conv, rows in groups.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).hexdigest()))
        seen, faults = set(), []
        for _, role, text in rows:
            bare = text.rstrip("\x20\t\n\x0b\x0c\r")
            faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = [r[0] for r in rows if r[0] is not None]
        initials = [r[1][:1] for r in rows]
        cost, audit = row_by_row(list(zip(initials, faults)))
        left, lines, role = iter(rows), [], None
        for e in audit:
            if e == "D":
                next(left)
                continue
            due = "assistant" if role == "u" else "user"
            name, text = (due, "") if e == "I" else next(left)[1:]
            name = due if e == "R" else name
            role = name[0]
            lines.append(f"{name}:{text}")
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
                     cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def rows_of(frame):
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in frame.collect()}


def made(seed, sizes):
    r = random.Random(seed)
    texts = ["Yes.", "No", "", " \t", "Why?", "ok!\n ", "é🙂.", "Long " * 50 + ".", None, "a\x0b.\x0c", "x\u00a0"]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", None, "", "umpire"]
    return [(c, None if r.random() < 0.05 else t + (r.random() < 0.1) * 3, r.choice(roles), r.choice(texts)) for c, n in sizes.items() for t in range(n)]


def test_parse_against_every_edit():
    r = random.Random(7)
    kinds = [a + b for a in "sua-" for b in "-td"]
    cases = ["".join(x) for n in (0, 1) for x in product(kinds, repeat=n)] + ["".join(r.choice(kinds) for _ in range(r.choice((2, 2, 3)))) for _ in range(60)]
    for classes in cases:
        assert outcome(parse(classes)) == by_every_edit(classes), classes


def test_long_spans_against_row_by_row():
    r = random.Random(8)
    name = {"-": "", "t": "truncated", "d": "blank"}
    for _ in range(40):
        classes = "".join(r.choice("suaua-") + r.choice("----td") for _ in range(r.randint(1, 150)))
        assert outcome(parse(classes)) == row_by_row([(classes[i], name[classes[i + 1]]) for i in range(0, len(classes), 2)])


def test_against_brute_force(spark):
    rows = made(1, {c: c % 9 for c in range(40)} | {None: 7, 100: 300, 101: 1})
    frame = spark.createDataFrame(rows, SCHEMA)
    want = brute(rows)
    assert rows_of(structure_repair(frame)) == want
    # many blocks to a conversation, and several rounds of putting them together
    assert rows_of(structure_repair(frame.repartition(5), block_bits=2, merge_bits=2)) == want


def test_rows_that_are_alike(spark):
    rows = [(1, t % 3, "user", "Same.") for t in range(500)] + [(2, None, "assistant", None)] * 9 + [(1, 5, "assistant", "Last.")]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", cost string, pos int")
    assert rows_of(structure_repair(frame, block_bits=3, merge_bits=2)) == brute(rows)


def test_tables(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.1/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert rows_of(structure_repair(spark.read.parquet("/root/testdata/sf0.1/conversations.parquet"))) == brute(rows)


def test_empty_and_dropped(spark):
    assert structure_repair(spark.createDataFrame([], SCHEMA)).collect() == []
    gone = next(i for i in range(100) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    assert rows_of(structure_repair(spark.createDataFrame([(gone, 0, "user", "Hi.")], SCHEMA))) == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())}


def test_damage_and_repair_apart(spark):
    frame = spark.createDataFrame([(1, 0, "assistant", "Hi."), (1, 1, "user", "Bye.")], SCHEMA)
    assert rows_of(repair(frame))[1][5:7] == (4, "IKKI")
    assert list(repaired([("assistant", "Hi."), ("user", "Bye.")], "IKKI")) == ["user:", "assistant:Hi.", "user:Bye.", "assistant:"]
    assert damaged(frame).columns == ["conv_id", "turn", "role", "text"]
