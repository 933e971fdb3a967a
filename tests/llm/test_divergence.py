import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shelfstack.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def by_hand(rows, least, most):
    """The whole result by loops over dictionaries."""
    rows = [(lang or "", source or "", TERM.findall((text or "").translate(LOWER))) for _, text, lang, source in rows]
    held, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, terms in rows:
        groups[lang].add(source)
        held[lang].update(set(terms))
        counts[lang, source].update(terms)
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in held[lang].items() if n >= least]
        n = {s: {t: counts[lang, s][t] for t in kept} for s in sources}
        n[None] = {t: sum(n[s][t] for s in sources) for t in kept}
        p = {s: {t: 1 + 10**9 * (c + 5) // (sum(of.values()) + 5 * len(kept)) for t, c in of.items()} for s, of in n.items()}
        for s in sources:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(p[s][t] - p[None][t], t) for t in kept if n[s][t] and p[s][t] > p[None][t]]
            for part, found, cap in (("pair", pairs, None), ("term", terms, most)):
                found.sort(key=lambda f: (-f[0], f[1].encode()))
                out += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(found[:cap])]
    return sorted(out)


def documents(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    return docs.withColumns({c: F.lit("x") for c in ("key", "term", "ordinal", "value", "rank", "prefix")})


def made_rows(seed=3, n=300):
    rng = random.Random(seed)
    vocabulary = ["the", "a", "Tea", "TEA", "été", "Été", "naïve", "中文", "x" * 300, "zebra", "zebras", "zeal", "o", "\U0001f600"]
    rows = [
        (i, " ".join(rng.choice(vocabulary[: rng.randint(3, 14)]) + rng.choice(["", "-", "9", " \n", "\0"]) for _ in range(rng.randint(0, 12))),
         rng.choice(["en", "de", "e", None, "en\0a"]), f"s{rng.randint(0, 3) * rng.randint(0, 2)}") for i in range(n)]
    rows += rows[:20] + [(None, None, "fr", None), (1, "", "fr", "b"), (2, "rare", "fr", "c"), (3, None, "solo", "only"), (4, "word " * 20_000, "en", "long")]
    return rows


@pytest.mark.parametrize("sizes", [{}, {"shard_bytes": 40, "round_bytes": 2500}])
def test_whole_result_against_loops(spark, sizes):
    rows = made_rows()
    got = divergence.divergence(documents(spark, rows).repartition(3), least=5, most=4, **sizes)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    want = by_hand(rows, 5, 4)
    assert {w[2] for w in want} == {"pair", "term"}
    assert sorted(map(tuple, got.collect())) == want


def test_blocks_slices_and_early_sums(spark, monkeypatch):
    """Workers import the module anew, so limits are set where the driver reads them."""
    monkeypatch.setattr(divergence, "SOURCES", 2)
    monkeypatch.setattr(divergence, "SLICE", 3)
    rows = made_rows(8, 200)
    assert sorted(map(tuple, divergence.divergence(documents(spark, rows), least=4, most=50).collect())) == by_hand(rows, 4, 50)


def test_nothing_kept_and_empty_table(spark):
    rows = [(1, "one", "a", "s"), (2, "two", "a", "t"), (3, "three", "b", "u")]
    got = sorted(map(tuple, divergence.divergence(documents(spark, rows)).collect()))
    assert got == [("a", "s", "pair", "t", 0, 1), ("a", "t", "pair", "s", 0, 1)]
    assert divergence.divergence(documents(spark, [])).count() == 0


def test_shares_are_exact_beyond_doubles(spark):
    n, total, kept = 10**14 + 7, 3 * 10**14 + 1, 1234567
    row = spark.createDataFrame([(n, total, kept)], "n long, total long, kept long")
    got = row.select(divergence.share(F.col("n"), F.col("total"), F.col("kept"))).first()[0]
    assert got == 1 + 10**9 * (n + 5) // (total + 5 * kept)


def test_transducer_is_minimal_and_orders_its_keys():
    rng = random.Random(1)
    keys = sorted({bytes(rng.choice(b"abc\xff") for _ in range(rng.randint(0, 6))) for _ in range(300)})
    made = divergence.compiled(keys)
    machine = divergence._joined([{**made, "base": 7}])
    assert machine.ordinals(pa.array(keys, pa.binary())).tolist() == list(range(7, 7 + len(keys)))
    assert [machine.spell(i + 7) for i in range(len(keys))] == keys
    others = [k + b"z" for k in keys[:50]] + [b"zz", b"abcabcabcabc"]
    assert set(machine.ordinals(pa.array(others, pa.binary())).tolist()) == {-1}
    # As many states as there are different sets of ways to go on.
    prefixes = {k[:i] for k in keys for i in range(len(k) + 1)}
    ways = {frozenset(k[len(p):] for k in keys if k.startswith(p)) for p in prefixes}
    assert len(machine.final) == len(ways)


def test_shards_are_one_list(spark):
    keys = sorted({f"key{i * 7919 % 1000}".encode() for i in range(500)})
    shards = divergence.compile_vocabulary(spark.createDataFrame([(k,) for k in keys], "key binary").repartition(4), 500)
    assert shards.count() > 3
    parts = list(divergence.rounds(shards, 4000))
    assert len(parts) > 1
    for machine, low, high in parts:
        got = machine.ordinals(pa.array(keys, pa.binary())).tolist()
        assert got == [i if low <= i < high else -1 for i in range(len(keys))]


def test_terms_do_not_cross_rows():
    row, found = divergence.terms(pa.array(["ab", "CD e", None, "", "é1É", "x"]))
    assert list(zip(row.tolist(), [v.decode() for v in found.cast(pa.large_binary()).to_pylist()])) == [
        (0, "ab"), (1, "cd"), (1, "e"), (4, "é"), (4, "É"), (5, "x")]
