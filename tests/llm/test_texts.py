import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from shelfstack.llm import jaccard, language, suffixes, texts


def batch(rows, words):
    rng = np.random.default_rng(5)
    some = ["".join(w) for w in rng.choice(list("abcdefghijklmnop"), (20_000, 5))]
    text = [" ".join(rng.choice(some, words)) for _ in range(rows)]
    return pa.RecordBatch.from_pydict({"doc_id": np.arange(rows), "text": text, "lang": ["xx"] * rows})


def peak(run):
    tracemalloc.start()
    run()
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return most


def test_anchors_of_a_large_batch_take_little_memory():
    large = batch(400, 600)
    suffixes.anchors(*texts.utf8(large.column("text").slice(0, 40)))  # tables of powers stay
    assert peak(lambda: list(suffixes._anchor_postings(4)(iter([large])))) < 45e6


def test_shingles_of_a_large_batch_take_little_memory():
    large = batch(400, 600)

    def run():
        for block in texts.blocks([large], limit=texts.SMALL_BLOCK_BYTES):
            jaccard._sets(block, 5)

    run()
    assert peak(run) < 20e6


def test_counts_of_trigrams_are_whole_for_a_few_texts_only():
    many = batch(256, 30)
    list(language._document_frequencies(iter([many])))
    assert peak(lambda: list(language._document_frequencies(iter([many])))) < 8e6


@pytest.mark.parametrize("rows", [1, 5, 16, 17, 40])
def test_vectors_do_not_depend_on_the_rows_beside_them(rows):
    some = [*batch(rows, 20).column("text").to_pylist(), None, "", "1 2"][-rows:]
    idf = np.random.default_rng(2).random(language.BINS).astype(np.float32) + 1
    points, letters = language._vectors_of(some, idf)
    counts, want = language.trigram_counts(some)
    assert np.array_equal(points, language.vectors(counts, idf)) and np.array_equal(letters, want)


def test_functions_hand_back_memory_after_their_last_batch(monkeypatch):
    done = []
    monkeypatch.setattr(texts, "hand_back", lambda: done.append(1))
    seen = []
    for x in texts.handing_back(lambda batches: (b * 2 for b in batches))([1, 2, 3]):
        seen.append(x)
        assert not done
    assert seen == [2, 4, 6] and done == [1]


def test_blocks_and_powers_do_not_change_hashes(monkeypatch):
    column = pa.array(["a b c d e f g " * k for k in (1, 3000, 20, 60_000)] + [None, ""])
    want = texts.word_hashes(column)
    monkeypatch.setattr(texts, "_powers", (np.ones(1, np.uint64), np.ones(1, np.uint64)))
    parts = [texts.word_hashes(b.column("text"))[0] for b in texts.blocks([pa.RecordBatch.from_pydict({"text": column})], limit=texts.SMALL_BLOCK_BYTES)]
    assert len(parts) > 1 and np.array_equal(np.concatenate(parts), want[0])
