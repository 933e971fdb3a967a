"""Language-model scores by Katz backoff over bigrams, with Good-Turing discounts.

Tokens are words and one end per text; a text's first token follows a start. Counts up to ``DISCOUNTED``
are discounted by Good-Turing, larger ones by ``TAIL``, so that every history, also one with frequent
successors only, keeps something for the others; what that frees of a history's probability goes to its unseen successors in
proportion to their unigram probability, with a backoff weight that makes the history's distribution sum
to one exactly. Unigrams back off in the same way to one class for all unknown tokens.

The corpus is read twice. First unigram counts are gathered by token. Then all bigrams of all texts are
gathered by their last token (those of very frequent tokens by both), packed and with their documents, so
that one place has a bigram's training count, its token's count and everyone who asks for it. From there
come the counts of counts, the documents' sums as far as they do not depend on discounts, and for every
history its seen mass; histories are gathered once more for their backoff weights. The tables of these
steps are written to the shared folder, partitioned by kind.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfstack.llm.storage import shuffle_width, stored, text_batches
from shelfstack.llm.texts import SpanHash, blocks, mix, utf8, words

DISCOUNTED = 5
TAIL = 0.5  # taken off every larger count, as off the others where the counts of counts are too thin
_START, _END = np.uint64(1), np.uint64(2)
_HEAVY = 2000  # tokens with more than one in so many of all tokens: there can't be more of them than this
_FLUSH = 1_000_000  # tokens that a task packs at a time
_ROWS = 22  # bits for a text's place among those that a task packs at a time; each has an end, so that there are not many more than _FLUSH
_PACKS = 20  # bits for the number of such a pack in its task; the task's number has the others
_PARTS = 4  # a bucket of bigrams is worked off in so many parts, to bound a task's memory
COUNT = np.dtype([("word", "u8"), ("count", "u8")])
PART = np.dtype([("doc", "u8"), ("sum", "f8"), ("base", "f8"), ("tokens", "u4"), ("known", "u4")] + [(f"r{r}", "u4") for r in range(1, DISCOUNTED + 1)])
HISTORY = np.dtype([("word", "u8"), ("seen", "f8"), ("more", "u8"), ("large", "u4")] + [(f"n{r}", "u4") for r in range(1, DISCOUNTED + 1)])
NAME = np.dtype([("doc", "u8"), ("key", "u8")])
ASKED = np.dtype([("word", "u8"), ("doc", "u8"), ("count", "u4")])


def _pack(*columns: np.ndarray) -> bytes:
    raw = b"".join(np.ascontiguousarray(c).tobytes() for c in columns)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _raw(blob: bytes) -> bytes:
    return pa.decompress(blob[8:], int.from_bytes(blob[:8], "little"), codec="zstd", asbytes=True)


def _records(blob: bytes, kind: np.dtype) -> np.ndarray:
    raw = _raw(blob)
    size, at = len(raw) // kind.itemsize, 0
    out = np.empty(size, kind)
    for f in kind.names:
        out[f] = np.frombuffer(raw, kind[f], size, at)
        at += kind[f].itemsize * size
    return out


def _columns(records: np.ndarray) -> bytes:
    return _pack(*(records[f] for f in records.dtype.names))


def _tokens(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token, the token before it, and row of all tokens of a batch, ends and starts included."""
    data, offsets = utf8(batch.column("text"))
    start, end, row = words(data, offsets)
    rows = np.arange(batch.num_rows)
    token = np.concatenate((SpanHash(data, lower=True)(start, end), np.full(batch.num_rows, _END)))
    row = np.concatenate((row, rows))
    order = np.argsort(row, kind="stable")
    token, row = token[order], row[order]
    before = np.r_[_START, token[:-1]]
    before[np.r_[True, row[1:] != row[:-1]]] = _START
    return token, before, row


def _heads(*columns: np.ndarray) -> np.ndarray:
    """Where a new combination begins in sorted columns."""
    new = np.zeros(len(columns[0]), bool)
    if len(new):
        new[0] = True
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def _sizes(first: np.ndarray, total: int) -> np.ndarray:
    return np.diff(np.r_[first, total])


def _by_bucket(bucket: np.ndarray, records: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    order = np.argsort(bucket, kind="stable")
    bucket, records = bucket[order], records[order]
    first = _heads(bucket)
    return bucket[first].astype(np.int32), [_columns(p) for p in np.split(records, first[1:])] if len(first) else []


def _unigrams(train: DataFrame, buckets: int) -> DataFrame:
    """Per bucket of tokens: their packed counts, and what of these goes into the totals."""

    def pack(parts: list[np.ndarray]) -> pa.RecordBatch:
        word, count = np.unique(np.concatenate(parts), return_counts=True)
        records = np.empty(len(word), COUNT)
        records["word"], records["count"] = word, count
        bucket, blobs = _by_bucket((mix(word) % np.uint64(buckets)).astype(np.int64), records)
        return pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(blobs, pa.binary())], ["bucket", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in blocks(batches):
            parts.append(_tokens(batch)[0])
            held += len(parts[-1])
            if held > _FLUSH:
                yield pack(parts)
                parts, held = [], 0
        if held:
            yield pack(parts)

    def add(group: pd.DataFrame) -> pd.DataFrame:
        every = np.concatenate([_records(b, COUNT) for b in group["counts"]])
        every = every[np.argsort(every["word"], kind="stable")]
        first = _heads(every["word"])
        out = every[first]
        out["count"] = np.add.reduceat(every["count"], first)
        times = np.bincount(np.minimum(out["count"], DISCOUNTED + 2).astype(np.int64), minlength=DISCOUNTED + 3)
        return pd.DataFrame({
            "bucket": group["bucket"][:1], "counts": [_columns(out)], "tokens": [int(out["count"].sum())], "types": [len(out)],
            "times": [times[1 : DISCOUNTED + 2].tolist()]})

    return train.select("text").mapInArrow(run, "bucket int, counts binary").groupBy("bucket") \
        .applyInPandas(add, "bucket int, counts binary, tokens long, types long, times array<long>")


def discounts(times: list[int]) -> np.ndarray:
    """Good-Turing factors of the counts 1 to ``DISCOUNTED`` from how many types have each count, up to one more.

    Where the counts of counts are too thin for factors between 0 and 1, the factor of ``r`` is ``(r - TAIL) / r``.
    """
    r = np.arange(1, DISCOUNTED + 1)
    n = np.asarray(times, float)
    plain = (r - TAIL) / r
    if n[0] <= 0 or n[-1] <= 0:
        return plain
    top = (DISCOUNTED + 1) * n[-1] / n[0]
    with np.errstate(divide="ignore", invalid="ignore"):
        turing = ((r + 1) * n[1:] / (r * n[:-1]) - top) / (1 - top)
    return np.where(np.isfinite(turing) & (turing > 0) & (turing < 1), turing, plain)


def _discounted(count: np.ndarray, factors: np.ndarray) -> np.ndarray:
    count = count.astype(np.int64)
    return np.where(count <= DISCOUNTED, count * np.r_[0.0, factors, 1.0][np.minimum(count, DISCOUNTED + 1)], count - TAIL)


def _bigrams(docs: DataFrame, buckets: int, heavy: np.ndarray) -> DataFrame:
    """Per bucket: bigrams with the texts that have them, and in part -1 which rows these texts are.

    A text is named by its task, pack and place, which a blob has once for all its texts; its row's ``key`` is sent
    once and not with every bucket that has some of its bigrams.
    """

    def place(word: np.ndarray, before: np.ndarray) -> np.ndarray:
        spread = np.isin(word, heavy)
        at = mix(word) + np.where(spread, mix(before ^ np.uint64(0x5555)), np.uint64(0))
        return (at % np.uint64(buckets * _PARTS)).astype(np.int64)

    def pack(parts: list[tuple[np.ndarray, ...]], base: int) -> Iterator[pa.RecordBatch]:
        word, before, at_row, keys, held = (np.concatenate(p) for p in zip(*parts))
        bucket = place(word, before)
        order = np.lexsort((at_row, before, word, bucket))
        bucket, word, before, at_row = (x[order] for x in (bucket, word, before, at_row))
        entry = _heads(bucket, word, before, at_row)
        count = _sizes(entry, len(word)).astype(np.uint32)
        bucket, word, before, at_row = (x[entry] for x in (bucket, word, before, at_row))
        marked = at_row.astype(np.uint32) << np.uint32(1) | held[at_row]
        out_b, blobs = [], []
        first = _heads(bucket)
        for a, b in zip(first, np.r_[first[1:], len(bucket)]):
            pair, single = _heads(word[a:b], before[a:b]), _heads(word[a:b])
            sizes = np.array([len(single), len(pair), b - a, base], np.uint64)
            blobs.append(_pack(
                sizes, word[a:b][single], before[a:b][pair], _sizes(single, b - a).astype(np.uint32), _sizes(pair, b - a).astype(np.uint32),
                marked[a:b], count[a:b]))
            out_b.append(bucket[a])
        names = np.empty(len(keys), NAME)
        names["doc"], names["key"] = np.uint64(base) + np.arange(len(keys), dtype=np.uint64), keys
        bucket, part = np.divmod(np.array(out_b, np.int32), _PARTS)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.r_[bucket, bucket[:1]]), pa.array(np.r_[part, np.int32(-1)]), pa.array([*blobs, _columns(names)], pa.binary())],
            ["bucket", "part", "blob"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size, rows, packs = [], 0, 0, TaskContext.get().partitionId() << _PACKS
        for batch in blocks(batches):
            token, before, row = _tokens(batch)
            held = batch.column("held_out").to_numpy(zero_copy_only=False).astype(np.uint32)
            parts.append((token, before, row + rows, batch.column("key").to_numpy().view(np.uint64), held))
            size, rows = size + len(token), rows + batch.num_rows
            if size > _FLUSH:
                yield from pack(parts, packs << _ROWS)
                parts, size, rows, packs = [], 0, 0, packs + 1
        if size:
            yield from pack(parts, packs << _ROWS)

    return docs.select("key", "held_out", "text").mapInArrow(run, "bucket int, part int, blob binary")


def _unpacked(blob: bytes) -> tuple[np.ndarray, ...]:
    raw = _raw(blob)
    singles, pairs, entries, base = (int(x) for x in np.frombuffer(raw, np.uint64, 4))
    at, out = 32, []
    for kind, n in ((np.uint64, singles), (np.uint64, pairs), (np.uint32, singles), (np.uint32, pairs), (np.uint32, entries), (np.uint32, entries)):
        out.append(np.frombuffer(raw, kind, n, at))
        at += np.dtype(kind).itemsize * n
    word, before, per_word, per_pair, marked, count = out
    return np.repeat(word, per_word), np.repeat(before, per_pair), np.uint64(base) + (marked >> np.uint32(1)), count, marked & np.uint32(1) == 0


def _joined(buckets: int, total: int, types: int, factors: np.ndarray, unknown: float, heavy: np.ndarray, heavy_count: np.ndarray):
    """For one bucket of bigrams: counts of counts, sums of texts, masses of histories, and unseen bigrams."""

    def part(blobs: pd.Series) -> tuple[np.ndarray, ...]:
        parts = [_unpacked(b) for b in blobs]
        word, before, doc, count, train = (np.concatenate(p) for p in zip(*parts))
        del parts
        order = np.lexsort((before, word))
        word, before, doc, count, train = (x[order] for x in (word, before, doc, count, train))
        pair, single = _heads(word, before), _heads(word)
        learned = np.where(train, count, 0).astype(np.int64)
        pair_count = np.add.reduceat(learned, pair)
        word_count = np.add.reduceat(learned, single)
        if len(heavy):  # of a heavy token only a part is here
            at = np.minimum(np.searchsorted(heavy, word[single]), len(heavy) - 1)
            word_count = np.where(heavy[at] == word[single], heavy_count[at], word_count)
        pair_of, word_of = np.repeat(np.arange(len(pair)), _sizes(pair, len(word))), np.repeat(np.arange(len(single)), _sizes(single, len(word)))
        p = np.where(word_count > 0, _discounted(word_count, factors) / max(total, 1), unknown)
        c, cw, n = pair_count[pair_of], word_count[word_of], count.astype(float)
        # What a token adds to its text: log c(h, w) of frequent bigrams, log p(w) of unseen ones; and less log c(w) for the token after it.
        value = np.where(c > DISCOUNTED, np.log10(np.maximum(c - TAIL, 1)), np.where(c == 0, np.log10(p)[word_of], 0.0))
        value -= np.where((word != _END) & (cw > 0), np.log10(np.maximum(cw, 1)), 0.0)
        names, at = np.unique(doc, return_inverse=True)
        add = lambda w: np.bincount(at, weights=w, minlength=len(names))
        sums = np.zeros(len(names), PART)
        sums["doc"], sums["sum"] = names, add(n * value)
        sums["base"] = add(n * np.log10((cw + 1) / (total + types + 1)))
        sums["tokens"], sums["known"] = add(n), add(np.where(cw > 0, n, 0))
        for r in range(1, DISCOUNTED + 1):
            sums[f"r{r}"] = add(np.where(c == r, n, 0))
        seen = np.flatnonzero(pair_count > 0)
        told, own = np.unique(before[pair[seen]], return_inverse=True)
        masses = np.zeros(len(told), HISTORY)
        masses["word"] = told
        masses["seen"] = np.bincount(own, weights=p[word_of[pair[seen]]], minlength=len(told))
        sc = pair_count[seen]
        masses["more"] = np.bincount(own, weights=np.where(sc > DISCOUNTED, sc, 0), minlength=len(told))
        masses["large"] = np.bincount(own, weights=sc > DISCOUNTED, minlength=len(told))
        for r in range(1, DISCOUNTED + 1):
            masses[f"n{r}"] = np.bincount(own, weights=sc == r, minlength=len(told))
        open_ = np.flatnonzero(c == 0)
        asked = np.zeros(len(open_), ASKED)
        asked["word"], asked["doc"], asked["count"] = before[open_], doc[open_], count[open_]
        return sums, masses, asked, np.bincount(np.minimum(sc, DISCOUNTED + 2), minlength=DISCOUNTED + 3)[1 : DISCOUNTED + 2]

    def run(group: pd.DataFrame) -> pd.DataFrame:
        packed = group["part"] >= 0
        done = list(zip(*(part(blobs) for _, blobs in group[packed].groupby("part")["blob"])))
        sums, masses = _added(np.concatenate(done[0]), "doc"), _added(np.concatenate(done[1]), "word")
        asked, times = np.concatenate(done[2]), np.sum(done[3], axis=0)
        names = np.concatenate([np.zeros(0, NAME), *(_records(b, NAME) for b in group["blob"][~packed])])
        rows = []
        for kind, records, name in (("sums", sums, "doc"), ("names", names, "doc"), ("histories", masses, "word"), ("asked", asked, "word")):
            rows += [(kind, b, x) for b, x in zip(*_by_bucket((mix(records[name]) % np.uint64(buckets)).astype(np.int64), records))]
        rows.append(("times", 0, times.astype(np.int64).tobytes()))
        return pd.DataFrame(rows, columns=["kind", "bucket", "blob"])

    return run


def _added(records: np.ndarray, name: str) -> np.ndarray:
    """One record for each value of ``name``, the other fields added up."""
    records = records[np.argsort(records[name], kind="stable")]
    first = _heads(records[name])
    out = records[first]
    for f in records.dtype.names if len(first) else ():
        if f != name:
            out[f] = np.add.reduceat(records[f], first)
    return out


def _weights(buckets: int, factors: np.ndarray):
    """For one bucket of histories: what unseen bigrams add to their texts by the histories' backoff weights."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        told = [_records(b, HISTORY) for b in group["blob"][group["kind"] == "histories"]]
        asked = [_records(b, ASKED) for b in group["blob"][group["kind"] == "asked"]]
        if not asked:
            return pd.DataFrame({"bucket": np.zeros(0, np.int32), "blob": []})
        asked = np.concatenate(asked)
        value = np.zeros(len(asked))
        if told:
            word, weight, count = backoff(np.concatenate(told), factors)
            at = np.minimum(np.searchsorted(word, asked["word"]), len(word) - 1)
            known = word[at] == asked["word"]
            # The texts' sums hold -log c(h) for every token with a known history; an unseen bigram takes that back.
            value = np.where(known, np.log10(weight[at]) + np.log10(count[at]), 0.0)
        names, own = np.unique(asked["doc"], return_inverse=True)
        sums = np.zeros(len(names), PART)
        sums["doc"], sums["sum"] = names, np.bincount(own, weights=value * asked["count"], minlength=len(names))
        bucket, blobs = _by_bucket((mix(names) % np.uint64(buckets)).astype(np.int64), sums)
        return pd.DataFrame({"bucket": bucket, "blob": blobs})

    return run


def backoff(told: np.ndarray, factors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Histories, their backoff weights and their counts, from the masses found in any number of places."""
    told = told[np.argsort(told["word"], kind="stable")]
    first = _heads(told["word"])
    total = lambda f: np.add.reduceat(told[f].astype(float), first)
    r = np.arange(1, DISCOUNTED + 1)
    kinds = np.stack([total(f"n{i}") for i in r])
    count = (r[:, None] * kinds).sum(0) + total("more")
    freed = (((1 - factors) * r) @ kinds + TAIL * total("large")) / count
    return told["word"][first], freed / np.maximum(1 - total("seen"), np.finfo(float).tiny), count


def _summed(group: pd.DataFrame) -> pd.DataFrame:
    """For one bucket of texts: their sums, by the keys of their rows."""
    named = group["kind"] == "names"
    names = np.concatenate([_records(b, NAME) for b in group["blob"][named]])
    sums = _added(np.concatenate([_records(b, PART) for b in group["blob"][~named]]), "doc")
    key = names["key"][np.argsort(names["doc"], kind="stable")]
    return pd.DataFrame({"key": key.view(np.int64), **{f: sums[f] if f in ("sum", "base") else sums[f].astype(np.int64) for f in PART.names[1:]}})


def scored(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` per row (``doc_id, text, held_out``).

    The model learns from rows that are not held out. Null and empty texts are one end token. Rows that are
    repeated count as often as they are there. Without training rows every token is unknown and has the whole
    probability, 1. Other columns are not looked at; an empty table gives no rows. Texts are read whole.
    """
    text_batches(docs.sparkSession)
    spark = docs.sparkSession
    buckets = shuffle_width(spark)
    rows = docs.select("doc_id", F.coalesce("held_out", F.lit(False)).alias("held_out"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("key", F.xxhash64("doc_id", "text", "held_out"))
    single = stored(_unigrams(rows.where("NOT held_out"), buckets), "unigrams")
    totals = single.agg(
        F.sum("tokens").alias("tokens"), F.sum("types").alias("types"),
        F.array(*[F.sum(F.col("times")[i]) for i in range(DISCOUNTED + 1)]).alias("times")).first()
    total, types = totals.tokens or 0, totals.types or 0
    times = [t or 0 for t in totals.times]
    factors = discounts(times)

    def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column("counts"):
                counts = _records(blob.as_py(), COUNT)
                counts = counts[counts["count"] > total // _HEAVY]
                yield pa.RecordBatch.from_pydict({"word": counts["word"].view(np.int64), "count": counts["count"].astype(np.int64)})

    heavy = sorted((np.uint64(r.word % (1 << 64)), r["count"]) for r in single.select("counts").mapInArrow(frequent, "word long, count long").collect())
    names, sizes = np.array([w for w, _ in heavy], np.uint64), np.array([c for _, c in heavy], np.int64)
    taken = float(((1 - factors) * np.arange(1, DISCOUNTED + 1) * np.array(times[:-1])).sum()) + TAIL * (types - sum(times[:-1]))
    freed = taken / total if total else 1.0
    pairs = _bigrams(rows, buckets, names).groupBy("bucket").applyInPandas(
        _joined(buckets, total, types, factors, freed, names, sizes), "kind string, bucket int, blob binary")
    table = stored(pairs, "bigrams", "kind")
    times = np.zeros(DISCOUNTED + 1, np.int64)
    for r in table.where("kind = 'times'").select("blob").collect():  # one row of six numbers per bucket
        times += np.frombuffer(r.blob, np.int64)
    pair_factors = discounts(times.tolist())
    backed = table.where("kind IN ('histories', 'asked')").groupBy("bucket").applyInPandas(_weights(buckets, pair_factors), "bucket int, blob binary")
    kinds = ", ".join(f"{f} {'double' if f in ('sum', 'base') else 'long'}" for f in PART.names[1:])
    sums = table.where("kind IN ('sums', 'names')").select("kind", "bucket", "blob").union(backed.select(F.lit("sums"), "bucket", "blob"))
    sums = sums.groupBy("bucket").applyInPandas(_summed, f"key long, {kinds}")
    sums = sums.groupBy("key").agg(*[F.max(f).alias(f) for f in PART.names[1:]])  # repeated rows have equal sums
    texts = rows.where("NOT held_out").count()
    score = F.col("sum")
    for r in range(1, DISCOUNTED + 1):
        score = score + F.col(f"r{r}") * F.lit(float(np.log10(r * pair_factors[r - 1])))
    out = rows.select("doc_id", "held_out", "key").join(sums, "key")
    return out.select(
        "doc_id", "held_out", F.col("tokens").alias("n_tokens"), F.col("known").alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
        F.col("base").alias("base_score"), (score - F.lit(float(np.log10(texts)) if texts else 0.0)).alias("score"))
