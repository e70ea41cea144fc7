import random
import re

from axonweave.llm.jaccard import jaccard_components


def brute(rows, width=3, percent=90):
    sets = []
    for _, text in rows:
        low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        w = re.findall("[^\x20\x09-\x0d]+", low)
        sets.append({tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set())
    top = list(range(len(rows)))

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                top[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), d), d)
    return sorted((d, len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(rows))


def made(rng, n):
    vocabulary = [f"w{k}" for k in range(60)]
    rows = []
    while len(rows) < n:
        base = [rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 3, 5, 30, 80, 120]))]
        for _ in range(rng.choice([1, 1, 3, 8])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            base = copy if rng.random() < 0.4 else base
            rows.append(" ".join(copy).upper() if rng.random() < 0.2 else "\t".join(copy))
    rng.shuffle(rows)
    return [(i, t) for i, t in enumerate(rows)]


def result(spark, rows):
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, sid string, n int")
    return sorted(tuple(r) for r in jaccard_components(docs).select("doc_id", "n_shingles", "component_id").collect())


def test_against_brute_force(spark):
    rows = made(random.Random(5), 250)
    assert result(spark, rows) == brute(rows)


def test_edges(spark):
    long = " ".join(f"v{i % 900}" for i in range(30_000))
    rows = [(5, None), (6, ""), (7, " \n"), (1, "one"), (2, "ONE"), (3, "one two"), (4, "one two"), (8, "É x y"), (9, "é x y"), (10, long), (11, long + " tail"), (12, "one two"), (12, "one two")]
    assert result(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert result(spark, []) == []
