import hashlib
import random
import re
from collections import Counter

from axonweave.llm.pii import KINDS, digest, masked, personal_data

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum((x if i % 2 == 0 else x * 2 - 9 * (x > 4)) for i, x in enumerate(map(int, reversed(d)))) % 10 == 0


def base(text):
    out = []
    for k in KINDS:
        for m in re.finditer(PATTERNS[k], text or ""):
            d = re.sub("[^0-9]", "", m.group())
            ok = {"email": True, "ip": all(int(p) <= 255 for p in m.group().split(".")) if k == "ip" else 0, "card": 12 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[k]
            if ok:
                out.append((m.start(), KINDS.index(k), m.end(), k))
    return sorted(out)


def rows(spark, texts):
    docs = spark.createDataFrame([(i, t, "a", 7) for i, t in enumerate(texts)], "doc_id long, text string, base string, start int")
    return {r.doc_id: r for r in digest(personal_data(docs)).collect()}


TEXTS = [
    None, "", "a@b.co", "🙂 x.y+z@mail-1.example.com_q@r.st é 1.2.3.4.5.6.7.8", "a@b_c@d.com..x", "999.1.1.1 255.255.255.255 0000255.01.1.1 256.1.1.1",
    "4111 1111 1111 1111, 4111-1111-1111-1112 4111  1111 1111 1111", "+1 (017) 555-7713 then +49.30-123456 +1 2", "4111111111111111" * 2, "1 2 3 4 5 6 7 8 9 0 " * 3000,
    "9" * 60_000, "x" * 200_000, "a@" + "b." * 30_000 + "c", "1." * 20_000, "@@ + ++1 23456789", "a@b.c, d@e.f; 79927398713 79927398710003 0",
]


def test_base_against_brute_force(spark):
    got = rows(spark, TEXTS)
    for i, t in enumerate(TEXTS):
        want = base(t)
        listed = ",".join(f"{k}:{a}:{b}" for a, _, b, k in want)
        assert got[i].base_sha256 == hashlib.sha256(listed.encode()).hexdigest(), (i, listed[:200], got[i].spans[:200])
        assert [got[i][f"n_{k}"] for k in KINDS] == [sum(w[3] == k for w in want) for k in KINDS]


def test_base_on_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in digest(personal_data(spark.createDataFrame(docs))).collect()}
    for d in docs:
        listed = ",".join(f"{k}:{a}:{b}" for a, _, b, k in base(d.text))
        assert got[d.doc_id].base_sha256 == hashlib.sha256(listed.encode()).hexdigest()


def test_context_finds_unseen(spark):
    texts = [f"please call +1 (2{i:02}) 555-12{i:02} today" for i in range(8)] + ["please call 555-0000 today", "sold 555-9999 units", "units 555-8888 sold"]
    got = rows(spark, texts)
    assert got[8].spans == "context_phone:12:20"
    assert got[9].spans == "" and got[10].spans == ""


def test_rounds_go_on_until_nothing_is_found(spark):
    """The strings of each step stand beside the word of the step before, and a few beside their own."""
    texts = [f"w0 +1 (2{i:03}) 555-12{i:02} e{i}" for i in range(200)]
    for step, n in enumerate((80, 30, 11, 3), 1):
        for word in (step - 1, step):
            texts += [f"w{word} {step}55-00{i:02} s{step}x{word}x{i}" for i in range(n)]
    got = rows(spark, texts)
    assert all("context_phone" in got[i].spans for i in range(200, len(texts)))


def test_contexts_are_read_whole(spark):
    gap, long = " " * 500, "k" * 300
    texts = [f"{long}{gap}+1 (2{i:02}) 555-12{i:02}{gap}{i}end" for i in range(8)] + [f"{long}{gap}020 555 00{gap}x", f"{'j' * 200 + long}{gap}020 555 01{gap}y"]
    got = rows(spark, texts)
    assert got[8].spans == f"context_phone:{len(long + gap)}:{len(long + gap) + 10}" and got[9].spans == ""


def test_planted_contexts_recall_and_precision(spark):
    """Identifiers that no base pattern takes, beside words that stand beside others that do, put into documents."""
    rng = random.Random(4)
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))

    def card():
        d = "4" + digits(14)
        return next(d + str(x) for x in range(10) if luhn(d + str(x)))

    def bad_card():
        d = card()
        return d[:-1] + str((int(d[-1]) + 3) % 10)

    known = {"email": ("write to", lambda: f"n{digits(3)}@mail.example.com", "for"), "ip": ("server at", lambda: f"10.{rng.randint(0, 255)}.3.{rng.randint(0, 255)}", "answers"), "card": ("charged card", card, "expiring"), "phone": ("call me under", lambda: f"+1 (0{digits(2)}) 555-{digits(4)}", "tonight")}
    unseen = {"email": lambda: f"n{digits(4)}@localhost", "ip": lambda: f"10,{rng.randint(0, 255)},3,{rng.randint(0, 255)}", "card": bad_card, "phone": lambda: f"0{digits(2)} {digits(3)} {digits(4)}"}
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect() if r.text]
    texts, planted = [], {}
    for n, (d, t) in enumerate(docs):
        kind = KINDS[n % 4]
        before, make, after = known[kind]
        value = unseen[kind]() if n % 5 == 0 else make()
        at = t.rfind(" ", 0, rng.randint(0, len(t))) + 1
        texts.append((d, f"{t[:at]}{before} {value} {after} {t[at:]}"))
        if n % 5 == 0:
            planted[d] = (kind, at + len(before) + 1, at + len(before) + 1 + len(value))
    found = {r.doc_id: [(s.split(":")[0], *map(int, s.split(":")[1:])) for s in r.spans.split(",") if s.startswith("context")] for r in digest(personal_data(spark.createDataFrame(texts, "doc_id long, text string"))).collect()}
    caught = Counter(k for d, (k, a, b) in planted.items() if (f"context_{k}", a, b) in found[d])
    total = Counter(k for k, _, _ in planted.values())
    every = sum(map(len, found.values()))
    print({k: round(caught[k] / total[k], 3) for k in total}, caught.total() / total.total(), "of what is found:", caught.total() / max(every, 1))
    assert all(caught[k] >= 0.9 * total[k] for k in total) and caught.total() >= 0.9 * every


def test_masked(spark):
    docs = spark.createDataFrame([(1, "mail a@b.co or +1 (017) 555-7713.", 3), (2, None, 4), (3, "none", 5), (3, "none", 5)], "doc_id long, text string, s int")
    assert sorted(map(tuple, masked(docs).collect())) == [(1, "mail [EMAIL] or [PHONE].", 3), (2, None, 4), (3, "none", 5), (3, "none", 5)]


def test_empty(spark):
    assert digest(personal_data(spark.createDataFrame([], "doc_id long, text string"))).collect() == []
