import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from shelfstack.llm import syncmers


def brute(rows):
    ordered = sorted(((d is not None, d or 0, t or ""), (d, t or "")) for d, t in rows)
    out = []
    for i, (_, (d, t)) in enumerate(ordered):
        after = ordered[(i + 1) % len(ordered)][1][1]
        cut = len(t) // 4
        edited = t[: len(t) - cut] + after[:cut]
        out.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest()))
    return sorted(out, key=repr)


def words(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randrange(2, 9))) for _ in range(n))


def test_edited_texts_follow_the_order_of_ids(spark):
    rows = [(i * 37 % 1000, words(i, i % 60)) for i in range(300)] + [(5000, None), (5001, ""), (5002, "ab"), (None, "no id " * 9), (5003, "x" * 100_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS key", "'x' AS print", "2 AS n_chars").repartition(7)
    got = syncmers.fingerprinted(docs).collect()
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=repr) == brute(rows)
    long = [r for r in got if 150 < r.n_chars < 5000]
    assert np.mean([r.near_edited for r in long]) > 0.6 and np.mean([r.near_next for r in long]) < 0.1
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert {r.fingerprint for r in got if r.n_chars == 0} == {""}


@pytest.mark.parametrize("rows", [[], [(1, "only one row")], [(1, "same"), (1, "same"), (1, "same")], [(2, None), (2, None)]])
def test_small_tables(spark, rows):
    got = syncmers.fingerprinted(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=repr) == brute(rows)
    assert all(r.near_next == 1.0 for r in got)


def test_anchors_do_not_depend_on_what_is_around():
    inside = words(3, 40).encode()
    alone = {h for _, h in zip(*syncmers.syncmers(np.frombuffer(inside, np.uint8)))}
    within = {h for _, h in zip(*syncmers.syncmers(np.frombuffer(b"before " + inside + b" after", np.uint8)))}
    assert alone and alone <= within


def test_matches_the_definition():
    data = np.frombuffer(words(9, 30).encode(), np.uint8)
    at, _ = syncmers.syncmers(data)
    inner = [int(syncmers.mix(np.frombuffer(data[i : i + 8].tobytes(), np.uint64))[0]) for i in range(len(data) - 7)]
    want = [i for i in range(len(data) - syncmers.KMER + 1) if min(inner[i : i + 17]) in (inner[i], inner[i + 16])]
    assert at.tolist() == want


def test_rows_do_not_share_anchors():
    texts = [words(i, 20) for i in range(5)] + [None, "", "ab", words(0, 20)]
    got = syncmers.fingerprints(pa.array(texts))
    assert got[0] == got[-1] and got[5] == got[6] == b"" and len(got[7]) == 8
    assert [syncmers.fingerprints(pa.array([t]))[0] for t in texts] == got
