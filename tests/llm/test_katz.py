import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from shelfstack.llm import katz

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)) + ["</s>"]


class Brute:
    """The same model, one dictionary at a time."""

    def __init__(self, train):
        self.one, self.two = Counter(), Counter()
        for text in train:
            t = tokens(text)
            self.one.update(t)
            self.two.update(zip(["<s>", *t], t))
        self.total = sum(self.one.values())
        self.d1, self.d2 = self.factors(self.one), self.factors(self.two)
        self.after, self.size = defaultdict(dict), Counter()
        for (h, w), c in self.two.items():
            self.after[h][w] = c
            self.size[h] += c

    def factors(self, counts):
        times = Counter(counts.values())
        return katz.discounts([times[r] for r in range(1, 7)])

    def cut(self, c, d):
        return c * d[c - 1] if c <= 5 else c - 0.5

    def p1(self, w):
        if not self.total:
            return 1.0
        if w in self.one:
            return self.cut(self.one[w], self.d1) / self.total
        return 1 - sum(self.cut(c, self.d1) for c in self.one.values()) / self.total

    def p(self, h, w):
        seen = self.after.get(h)
        if not seen:
            return self.p1(w)
        if w in seen:
            return self.cut(seen[w], self.d2) / self.size[h]
        left = 1 - sum(self.cut(c, self.d2) for c in seen.values()) / self.size[h]
        return left / (1 - sum(self.p1(x) for x in seen)) * self.p1(w)

    def score(self, text):
        t = tokens(text)
        return sum(math.log10(self.p(h, w)) for h, w in zip(["<s>", *t], t))

    def base(self, text):
        return sum(math.log10((self.one[w] + 1) / (self.total + len(self.one) + 1)) for w in tokens(text))


def corpus():
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(300)]
    text = lambda: " ".join(rng.choice(vocabulary[: rng.choice([5, 30, 300])]) for _ in range(rng.randrange(50)))
    rows = [(i, text(), i % 7 == 2) for i in range(250)]
    rows += [(900, None, False), (901, "", True), (902, "W1 w1\tnever-seen w2", True), (903, "x " * 9000, False), (904, "é É", True), (None, "w1 w2", True)]
    return rows + [(905, "w3 w4 w3", True)] * 2 + [(906, "w5 w6", False)] * 2


def test_agrees_with_brute_force_and_sums_to_one(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string, held_out boolean").selectExpr("*", "1 AS key", "'x' AS score", "2 AS bucket")
    got = katz.scored(docs.repartition(3)).collect()
    assert len(got) == len(rows)
    model = Brute([t for _, t, held in rows if not held])
    text = {d: t for d, t, _ in rows}
    for r in got:
        t = tokens(text[r.doc_id])
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(t), sum(w in model.one for w in t), model.total)
        assert r.score == pytest.approx(model.score(text[r.doc_id]), rel=1e-9)
        assert r.base_score == pytest.approx(model.base(text[r.doc_id]), rel=1e-9)
    for h in ("<s>", "w1", "w299", "never-seen"):
        assert sum(model.p(h, w) for w in [*model.one, "unknown"]) == pytest.approx(1)


def test_small_tables(spark):
    kind = "doc_id long, text string, held_out boolean"
    assert katz.scored(spark.createDataFrame([], kind)).count() == 0
    (r,) = katz.scored(spark.createDataFrame([(1, "a b", True)], kind)).collect()
    assert (r.n_tokens, r.n_known, r.train_tokens, r.score) == (3, 0, 0, 0.0)
    got = {r.doc_id: r for r in katz.scored(spark.createDataFrame([(1, "a b", False), (2, "a c", True)], kind)).collect()}
    assert got[2].n_known == 2 and math.isfinite(got[2].score) and got[1].score > got[2].score


def test_histories_with_frequent_successors_only(spark):
    train = ["alpha beta"] * 20 + [f"word{i} alpha beta" for i in range(30)]
    rows = [(i, t, False) for i, t in enumerate(train)] + [(900, "alpha gamma", True), (901, "alpha beta", True), (902, "alpha word3", True)]
    got = {r.doc_id: r for r in katz.scored(spark.createDataFrame(rows, "doc_id long, text string, held_out boolean")).collect()}
    model = Brute(train)
    assert set(model.two[k] for k in model.two if k[0] == "alpha") == {50}
    assert sum(model.p("alpha", w) for w in [*model.one, "unknown"]) == pytest.approx(1)
    for i, text in ((900, "alpha gamma"), (901, "alpha beta"), (902, "alpha word3")):
        assert got[i].score == pytest.approx(model.score(text), rel=1e-9)
    assert -8 < min(r.score for r in got.values()) and got[901].score > max(got[900].score, got[902].score)
    # No token that is rare, either.
    rows = [(i, "alpha beta", False) for i in range(20)] + [(900, "beta gamma", True)]
    got = {r.doc_id: r for r in katz.scored(spark.createDataFrame(rows, "doc_id long, text string, held_out boolean")).collect()}
    assert got[900].score == pytest.approx(Brute(["alpha beta"] * 20).score("beta gamma")) and got[900].score > -8


def test_a_text_is_named_once_however_many_buckets_there_are(spark):
    rng = random.Random(6)
    rows = [(i, " ".join(f"w{rng.randrange(3000)}" for _ in range(60)), i % 7 == 2) for i in range(600)]
    docs = spark.createDataFrame(rows, "key long, text string, held_out boolean").coalesce(1)
    few, many = (katz._bigrams(docs, n, np.zeros(0, np.uint64)).selectExpr("sum(length(blob))").first()[0] for n in (4, 64))
    assert many < 1.4 * few
    packs = katz._bigrams(docs, 4, np.zeros(0, np.uint64)).where("part < 0").collect()
    assert sorted(k for p in packs for k in katz._records(bytes(p.blob), katz.NAME)["key"].tolist()) == list(range(600))
