import hashlib
import random

import numpy as np
import pyarrow as pa

from shelfstack.llm import suffixes


def brute(rows):
    first, out = {}, []
    texts = [(d, (t or "").encode()) for d, t in rows]
    for d, b in texts:
        for i in range(len(b) - 49) if d is not None else ():
            first[b[i : i + 50]] = min(d, first.get(b[i : i + 50], d))
    for d, b in texts:
        gone = bytearray(len(b))
        for i in range(len(b) - 49) if d is not None else ():
            if first[b[i : i + 50]] < d:
                gone[i : i + 50] = b"\1" * 50
        kept = bytes(x for x, y in zip(b, gone) if not y)
        spans = sum(1 for i in range(len(gone)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def run(spark, rows, **more):
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS ranges", "'x' AS copied", "2 AS row").repartition(3)
    got = suffixes.deduplicated(docs, "doc_id", **more).collect()
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got), key=repr)


def test_agrees_with_brute_force(spark):
    rng = random.Random(5)
    letters = "abé cd"
    pool = ["".join(rng.choice(letters) for _ in range(rng.choice([20, 49, 50, 51, 70, 200]))) for _ in range(25)]
    rows = [(i * 3 % 101, "".join(rng.choice(pool) for _ in range(rng.randrange(6))) + "x" * rng.randrange(3)) for i in range(80)]
    rows += [(200, None), (201, ""), (202, "a" * 49), (203, "a" * 50), (204, "a" * 130), (205, "ab" * 60), (206, "ba" * 60), (207, "a" * 50)]
    rows += [(210, rows[3][1]), (211, rows[3][1]), (212, "z" * 200_000), (213, "z" * 60 + "q")]
    assert run(spark, rows) == brute(rows)


def test_rows_of_one_id_null_ids_and_empty_table(spark):
    text = "".join(chr(97 + i * i % 23) for i in range(90))
    rows = [(5, text), (5, text), (5, "other " + text[:60]), (None, text), (9, text), (9, text[:55])]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []


def test_keeps_the_rest_of_the_text(spark):
    text = "".join(chr(97 + i * i % 23) for i in range(80))
    docs = spark.createDataFrame([(1, text), (2, "before " + text + " after")], "doc_id long, text string")
    kept = {r.doc_id: r.kept for r in suffixes.deduplicated(docs, "doc_id", with_text=True).collect()}
    assert kept == {1: text, 2: "before  after"}


def test_bucket_pointers_order_windows():
    rng = np.random.default_rng(1)
    raw = rng.integers(97, 99, 4000).astype(np.uint8)
    raw[1000:1200] = raw[2000:2200]
    size = np.array([900, 1500, 1600])
    pointer = suffixes.bucket_pointers(raw, size)
    starts = [p for a, n in zip((0, 900, 2400), size) for p in range(a, a + n - 49)]
    strings = {p: raw[p : p + 50].tobytes() for p in starts}
    ordered = sorted(starts, key=strings.get)
    assert all((pointer[a] < pointer[b]) == (strings[a] < strings[b]) for a, b in zip(ordered, ordered[1:]))


def test_slices_of_a_bucket_give_the_same_ranges(monkeypatch):
    rng = random.Random(8)
    pool = ["".join(rng.choice("abcd ") for _ in range(rng.choice([60, 90]))) for _ in range(6)]
    texts = ["".join(rng.choice(pool) for _ in range(4)) for _ in range(40)]
    data = [np.frombuffer(t.encode(), np.uint8) for t in texts]
    found = [suffixes.anchors(d, np.array([0, len(d)])) for d in data]
    keys = [(v[at] & suffixes._KEY).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes() for at, v, _ in found]
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(40), pa.int64()), "text": texts, "anchors": pa.array(keys, pa.binary())})
    group = pa.Table.from_batches(suffixes._unit_postings(1)(iter([batch]))).to_pandas()

    def ranges(size):
        monkeypatch.setattr(suffixes, "SLICE_BYTES", size)
        out = suffixes._unit_ranges(3)(group)
        assert out["bucket"].is_unique and len(out) <= 3
        every = [tuple(r) for b in out["blob"] for r in suffixes._unpack(b, suffixes.RANGE).tolist()]
        return sorted(every)

    assert ranges(1) == ranges(500) == ranges(1 << 30) != []


def test_packed_records_come_back():
    rng = np.random.default_rng(2)
    anchor, doc = rng.integers(0, 1 << 63, 500).astype(np.uint64), rng.integers(-(1 << 63), (1 << 63) - 1, 500)
    records = suffixes._keyed(anchor, doc)
    again = suffixes._unpack(suffixes._pack(records), suffixes.ANCHOR)
    assert (again == records).all() and (suffixes._keys(again) == anchor & suffixes._KEY).all()
