import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfstack.llm import packing
from shelfstack.llm.texts import utf8

ODD = [
    None, "", " \t\n ", "it's IT'S we'll ''s \"'s 'tis", "<|endoftext|> <|startoftext|>x", "été İstanbul ΣΣ 中文",
    "a,b.c!1,234-5", "x" * 3000, "word, " * 4000, "  thin spaces ", "\U0001f600‍\U0001f600 ok",
]


@pytest.fixture(scope="module")
def tokenizer():
    found = Tokenizer.from_file(packing.MODEL)
    found.encode_special_tokens = True
    return found


def checked(plan, counts):
    """How many sequences a plan has that holds every piece once and overfills none."""
    held = Counter()
    for lengths, times in plan:
        assert sum(lengths) < len(counts) and times > 0
        for x in lengths:
            held[x] += times
    assert [held[x] for x in range(len(counts))] == list(counts)
    return sum(times for _, times in plan)


def fewest(lengths, size):
    """The least number of sequences, by trying every place of every piece."""
    best = len(lengths)
    lengths = sorted(lengths, reverse=True)

    def go(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(lengths):
            best = len(rooms)
            return
        for room in set(rooms):
            if room >= lengths[i]:
                left = list(rooms)
                left.remove(room)
                go(i + 1, [*left, room - lengths[i]])
        go(i + 1, [*rooms, size - lengths[i]])

    go(0, [])
    return best


def test_plans_against_all_plans():
    rng = random.Random(4)
    better = 0
    for _ in range(120):
        size = rng.choice([10, 20, 37])
        lengths = [rng.randint(1, size) for _ in range(rng.randint(0, 9))]
        counts = np.bincount(lengths, minlength=size + 1).tolist() if lengths else [0] * (size + 1)
        least, first, found = fewest(lengths, size), checked(packing.best_fit(counts), counts), checked(packing.complete(counts), counts)
        assert packing.least_sequences(np.array(counts)) <= least == found <= first
        better += found < first
    # Best fit takes 3 sequences for these, the search 2.
    counts = np.bincount([5, 4, 3, 3, 3, 2], minlength=11).tolist()
    assert checked(packing.best_fit(counts), counts) == 3 > checked(packing.complete(counts), counts)


@pytest.mark.parametrize("low, high", [(300, 1100), (1, 2049), (600, 760), (2048, 2049), (512, 513)])
def test_many_pieces_near_the_bound(low, high):
    counts = np.bincount(np.random.default_rng(1).integers(low, high, 30_000), minlength=2049).tolist()
    found, first = checked(packing.complete(counts), counts), checked(packing.best_fit(counts), counts)
    assert found <= first and found <= 1.02 * packing.least_sequences(np.array(counts))


def test_fillings_are_undominated_and_ordered():
    counts = np.bincount([6, 5, 3, 2, 2, 1], minlength=11)
    got = list(packing.fillings(6, 10, counts))
    assert got[0] == (6,)
    assert all(sum(x) <= 6 for x in got)
    assert (5, 1) not in got and (3, 2, 1) not in got  # 6 does for all of these


def test_units_give_the_ids_of_whole_texts(tokenizer):
    rng = random.Random(2)
    signs = "aAbS stTrReEvmMlLd'''\"\",.-!1234 \t\ńİΣé中\U0001f600‍̣<|>"
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 60))) for _ in range(3000)] + [t or "" for t in ODD]
    data, offsets = utf8(pa.array(texts))
    ids, count = packing.Encoder(open(packing.MODEL, encoding="utf-8").read()).encode(data, offsets)
    ends = np.cumsum(count)
    for i, want in enumerate(tokenizer.encode_batch(texts, add_special_tokens=False)):
        assert ids[ends[i] - count[i] : ends[i]].tolist() == [*want.ids, 0]


def test_long_texts_are_encoded_in_stretches(tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "BLOCK", 50)
    monkeypatch.setattr(packing, "KNOWN_UNITS", 3)
    texts = ["it's  a-long text, " * 40, "", "y" * 500 + " z", " "]
    ids, count = packing.Encoder(open(packing.MODEL, encoding="utf-8").read()).encode(*utf8(pa.array(texts)))
    want = [[*e.ids, 0] for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert ids.tolist() == sum(want, []) and count.tolist() == list(map(len, want))


def test_every_document_is_packed_once(spark, tokenizer):
    rows = [(i, t, 1) for i, t in enumerate(ODD)] + [(3, ODD[3], 2), (3, "other", 2), (None, "none", 3), (None, None, 3)]
    rows += [(100 + i, "same words here " * 30, 4) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length int").withColumn("part", F.lit(1)).withColumn("ids", F.lit("x"))
    pieces = packing.packed(docs.repartition(5), ids=F.col("ids"), crc=F.crc32("ids"))
    got = pieces.collect()
    documents = defaultdict(list)
    for r in got:
        assert r.length * 4 == len(r.ids) <= 4 * 2048 and r.crc == zlib.crc32(r.ids)
        documents[r.doc_id].append(r)
    for key in {k for k, _, _ in rows}:
        texts = [t or "" for k, t, _ in rows if k == key]
        want = Counter()
        for e in tokenizer.encode_batch(texts, add_special_tokens=False):
            ids = [*e.ids, 0]
            for p in range(-(-len(ids) // 2048)):
                want[p, p * 2048, tuple(ids[p * 2048 : p * 2048 + 2048])] += 1
        assert want == Counter((r.piece, r.start, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in documents[key])
    held = defaultdict(list)
    for r in got:
        held[r.sequence_id].append((r.offset, r.length))
    for places in held.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(held) == -(-sum(r.length for r in got) // 2048)
    whole = {r.sequence_id: r.ids for r in packing.sequences(pieces).collect()}
    assert {k: len(v) for k, v in whole.items()} == {k: 4 * sum(n for _, n in v) for k, v in held.items()}
    for r in got:
        assert whole[r.sequence_id][4 * r.offset : 4 * (r.offset + r.length)] == bytes(r.ids)


def test_empty_table(spark):
    got = packing.packed(spark.createDataFrame([], "doc_id long, text string"))
    assert got.count() == 0 and "sequence_id" in got.columns
