import random
import re

import pandas as pd

from shelfstack.llm import jaccard
from shelfstack.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text, n):
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) < n:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def brute(rows, n, percent):
    sets = {d: shingle_set(t, n) for d, t in rows}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in ids}


def corpus(seed=3):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for family in range(40):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 3, 4, 5, 30, 60, 120]))]
        for copy in range(rng.choice([1, 1, 2, 12])):
            text = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                text[rng.randrange(len(text))] = rng.choice(vocabulary).upper()
            if rng.random() < 0.3:
                text = text + [rng.choice(vocabulary)] * rng.randrange(4)
            rows.append((len(rows) * 7 % 1009, rng.choice([" ", "\n", " \t"]).join(text)))
    return rows


def test_agrees_with_brute_force(spark):
    rows = corpus() + [(2000, None), (2001, ""), (2002, " \n"), (2003, "ü x"), (2004, "Ü x"), (2005, "a b"), (2006, "A B"), (2007, "long " * 40_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS n", "'x' AS component", "2 AS kind").repartition(5)
    for n, percent in ((4, 85), (5, 80)):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(docs, n, percent).collect()}
        assert got == brute(rows, n, percent)


def test_one_list_of_many_near_copies_without_their_original(spark):
    base = [f"b{i}" for i in range(150)]
    rows = []
    for i in range(60):  # two edits each: close to the base, which is absent; some close to each other
        text = list(base)
        text[(i * 5) % 150] = f"x{i % 9}"
        text[(i * 11 + 40) % 150] = f"y{i}"
        rows.append((i, " ".join(text)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 5, 85).collect()}
    assert got == brute(rows, 5, 85)


def test_repeated_rows_null_ids_and_empty_table(spark):
    text = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(5, text), (5, text), (None, text), (3, text), (9, "other words")], "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.jaccard_components(docs, 5, 80).collect()), key=repr)
    assert got == sorted([(5, 26, 3), (5, 26, 3), (None, 26, None), (3, 26, 3), (9, 1, 9)], key=repr)
    assert jaccard.jaccard_components(docs.limit(0), 5, 80).count() == 0


def test_different_texts_of_one_id_link_by_either(spark):
    one, two = [f"a{i}" for i in range(40)], [f"b{i}" for i in range(40)]
    rows = [(5, one), (5, two), (7, one[:-1]), (9, two[:-1]), (3, ["c"] * 20), (8, one), (2, ["d", "e"]), (11, ["d", "e"]), (11, two)]
    docs = spark.createDataFrame([(d, " ".join(t)) for d, t in rows], "doc_id long, text string")
    got = {(r.doc_id, r.component_id) for r in jaccard.jaccard_components(docs, 5, 80).collect()}
    assert got == {(5, 2), (7, 2), (9, 2), (8, 2), (2, 2), (11, 2), (3, 3)}


def test_chunks_of_a_list_give_each_pair_from_its_first_list(monkeypatch):
    rng = random.Random(4)
    maps = [bytes([rng.randrange(4)] * 8) for _ in range(30)]
    rows = [(k, 40 + k % 3, maps[k], k % 5, [x for x in range(9) if rng.random() < 0.2]) for k in range(30)]

    def cross(chunks):
        pairs = []
        for low in range(chunks):
            for high in range(low, chunks):
                part = [(*r, r[0] % chunks, low, high) for r in rows if r[0] % chunks in (low, high)]
                frame = pd.DataFrame(part, columns=["set_key", "n", "map", "component", "lists", "chunk", "low", "high"])
                pairs += list(jaccard._cross(85)(frame).itertuples(index=False, name=None))
        return pairs

    def fits(x, y):
        apart = sum((a ^ b).bit_count() for a, b in zip(x[2], y[2]))
        return x[3] != y[3] and not set(x[4]) & set(y[4]) and (x[1] + y[1] - apart) * 185 >= 170 * (x[1] + y[1])

    expected = [(x[0], y[0]) for i, x in enumerate(rows) for y in rows[i + 1 :] if fits(x, y)]
    for chunks in (1, 2, 5):
        assert sorted(cross(chunks)) == expected != []


def test_components(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, 90), (90, 95), (95, 95), (100, 90)]
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, 90: 90, 95: 90, 100: 90}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
