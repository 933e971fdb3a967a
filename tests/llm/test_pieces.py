import os
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from shelfstack.llm import pieces

pytestmark = pytest.mark.skipif(not os.path.exists(pieces.MODEL), reason="no public vocabulary here")
ODD = [None, "", " ", "   a", "a  b   ", "\n\n\t", "漢字と日本語 ñandú 😀😀", "▁x", "<0x0A> </s> <s>", " " * 70, "x" * 700, "    " * 30 + "y",
       "I'm  don't", "à́e", "a" * 21, "======----", "0000000000000000 ", "ab" * 9000]


def random_texts(n=400):
    rng = np.random.default_rng(0)
    letters = list("abcdefgh  \n\t.éßñ漢😀aeioutnrs")
    return ["".join(rng.choice(letters, rng.integers(1, 120))) for _ in range(n)]


def test_agrees_with_the_public_library_and_decodes(spark):
    from sentencepiece import SentencePieceProcessor

    library = SentencePieceProcessor(model_file=pieces.MODEL)
    rows = list(enumerate(ODD + random_texts() + ODD))
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS token_ids", "2 AS row").repartition(3)
    got = pieces.encoded(docs, "doc_id", "text")
    for r in got.collect():
        if r.text is None:
            assert (r.token_ids, r.n_tokens, r.round_trip) == (None, 0, True)
            continue
        assert r.token_ids == library.encode(r.text), r.text
        assert r.n_tokens == len(r.token_ids)
        assert r.round_trip == ("▁" not in r.text)
    back = {r.doc_id: r.text for r in pieces.decoded(got).collect()}
    assert back == {i: t and t.replace("▁", " ") for i, t in rows}


def test_empty_table_and_carried_columns(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, n_chars long")
    got = pieces.encoded(docs)
    assert got.columns == ["doc_id", "text", "n_chars", "token_ids", "n_tokens", "round_trip"] and got.count() == 0


def test_other_model_kinds_are_refused(tmp_path):
    with pytest.raises(Exception):
        pieces.compile_machine(str(tmp_path / "none.model"))


@pytest.fixture(scope="module")
def context():
    return pieces.Context(pieces.compile_machine())


@pytest.mark.parametrize("stretch", [1, 7, 64, 1 << 17])
def test_any_stretches_give_the_library_s_pieces(context, monkeypatch, stretch):
    from sentencepiece import SentencePieceProcessor

    library = SentencePieceProcessor(model_file=pieces.MODEL)
    texts = ODD[:-1] + random_texts(60) + ["", None, "one two " * 40]
    monkeypatch.setattr(pieces, "STRETCH", stretch)
    ids, per_row, same = pieces.encode_batch(context, pa.array(texts, pa.string()))
    want = [library.encode(t or "") for t in texts]
    assert ids.tolist() == sum(want, []) and per_row.tolist() == [len(w) for w in want]
    assert same.tolist() == ["▁" not in (t or "") for t in texts]
    raw, bounds = pieces.decode_ids(context.machine, ids, per_row)
    assert [raw[a:b].tobytes().decode() for a, b in zip(bounds, bounds[1:])] == [(t or "").replace("▁", " ") for t in texts]


@pytest.mark.parametrize("rows", [1, 800])
def test_memory_does_not_follow_the_batch(context, rows):
    """Beside texts and ids a stretch is held, for many rows as for one long text."""
    rng = np.random.default_rng(1)
    words = ["".join(w) for w in rng.choice(list("abcdefghijklmnop"), (400_000, 7))]
    each = len(words) // rows
    texts = pa.array([" ".join(words[i * each : (i + 1) * each]) for i in range(rows)])
    pieces.encode_batch(context, texts.slice(0, 1) if rows > 1 else pa.array(["a b"]))
    tracemalloc.start()
    ids, per_row, same = pieces.encode_batch(context, texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert same.all() and len(ids) == per_row.sum() > 800_000
    assert peak < 100e6, peak


def test_a_worker_s_transducers_and_weights_are_small(context):
    machine = context.machine
    arrays = [v for v in (getattr(machine, f) for f in machine.__dataclass_fields__) if isinstance(v, np.ndarray)]
    assert sum(a.nbytes for a in arrays) < 10e6
    assert context.key.nbytes + context.kept.nbytes < 12e6


def test_rows_of_the_trie_share_no_place():
    rng = np.random.default_rng(3)
    dense = np.where(rng.random((3000, 200)) < rng.choice([0.004, 0.02, 0.5], (3000, 1), p=[0.9, 0.09, 0.01]), rng.integers(1, 1 << 20, (3000, 200)), 0)
    dense[:, 0] = 0
    dense = dense[dense.any(1)]
    node, code = np.nonzero(dense)
    base, source, target = pieces._displaced(len(dense), np.stack([node, code, dense[node, code]], 1))
    place = base[:, None] + np.arange(200)
    place = np.minimum(place, len(source) - 1)
    found = np.where(source[place] == np.arange(len(dense))[:, None], target[place], 0)
    used = code.max() + 1
    assert np.array_equal(found[:, :used], dense[:, :used])
