"""Exact substring deduplication with sparse suffix sorting by bucket-pointer refinement.

A string of ``length`` bytes is removed from a document when it also starts in a document with a smaller
id. Only suffixes at places that can repeat are sorted:

1. Every window of ``length`` bytes picks as anchor its ``SEED``-byte string of least hash, so equal
   windows pick equal anchors. Anchors (about one in 14 bytes) are gathered by hash, packed; a document
   learns which of its anchors occur in other documents.
2. The windows of one anchor form a unit of at most ``2 * length - SEED`` bytes. Units of repeated
   anchors are gathered by anchor. Where all occurrences of an anchor have the same unit, its windows
   start first in the unit's smallest document. Otherwise the distinct units' suffixes are sorted: buckets
   of equal 8-byte prefixes are refined by sorting on the bucket pointers 8, then 16, then 18 bytes
   further on, each round using the pointers of the round before, until buckets agree on 50 bytes;
   suffixes alone in their bucket are not sorted again.
3. Removed ranges go back to their documents, which are cut. The documents' one shuffle serves 2 and 3.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfstack.llm.storage import materialised, shuffle_width, text_batches
from shelfstack.llm.texts import SMALL_BLOCK_BYTES, SpanHash, blocks, handing_back, mix, utf8

LENGTH = 50
SEED = 24
_SPAN = LENGTH - SEED + 1  # anchors to choose from in a window
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
_KEY = np.uint64((1 << 48) - 1)  # bits by which anchors are gathered; two that agree on them only cost work
SLICE_BYTES = 1 << 22  # units of about this many bytes are sorted at a time
ANCHOR = np.dtype([("low", "u4"), ("high", "u2"), ("doc", "i8")])
UNIT = np.dtype([("anchor", "u8"), ("unit", "u8"), ("doc", "i8"), ("text", "u4"), ("at", "u4"), ("size", "u1")])
PLACE = np.dtype([("anchor", "u8"), ("new", "u1"), ("doc", "i8"), ("text", "u4"), ("at", "u4"), ("size", "u1")])
RANGE = np.dtype([("doc", "i8"), ("text", "u4"), ("start", "i8"), ("size", "i8")])


def _squeezed(raw: bytes) -> bytes:
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unsqueezed(blob: bytes) -> bytes:
    return pa.decompress(blob[8:], int.from_bytes(blob[:8], "little"), codec="zstd", asbytes=True)


def _pack(records: np.ndarray) -> bytes:
    """Columns one after the other, documents as differences, compressed."""
    columns = {f: np.ascontiguousarray(records[f]) for f in records.dtype.names}
    columns["doc"] = np.diff(columns["doc"], prepend=np.int64(0))
    return _squeezed(b"".join(c.tobytes() for c in columns.values()))


def _unpack(blob: bytes, kind: np.dtype) -> np.ndarray:
    blob = _unsqueezed(blob)
    size, at = len(blob) // kind.itemsize, 0
    out = np.empty(size, kind)
    for f in kind.names:
        out[f] = np.frombuffer(blob, kind[f], size, at)
        at += kind[f].itemsize * size
    out["doc"] = np.cumsum(out["doc"])
    return out


def _keyed(anchor: np.ndarray, doc: np.ndarray) -> np.ndarray:
    out = np.empty(len(anchor), ANCHOR)
    out["low"], out["high"], out["doc"] = anchor & np.uint64(0xFFFFFFFF), (anchor & _KEY) >> np.uint64(32), doc
    return out


def _keys(records: np.ndarray) -> np.ndarray:
    return records["high"].astype(np.uint64) << np.uint64(32) | records["low"]


def _by_bucket(records: np.ndarray, bucket: np.ndarray) -> pd.DataFrame:
    """Records with their documents in order, packed by bucket."""
    order = np.lexsort((records["doc"], bucket))
    records, bucket = records[order], bucket[order]
    first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]][: len(records)])
    parts = np.split(records, first[1:]) if len(records) else []
    return pd.DataFrame({"bucket": bucket[first].astype(np.int32), "blob": [_pack(p) for p in parts]})


def _sliding(x: np.ndarray, width: int, of) -> np.ndarray:
    """``of`` (minimum or maximum) over ``x[i : i + width]`` for every full window, by doubling."""
    done, out = 1, x
    while done < width:
        step = min(done, width - done)
        out = of(out[: len(out) - step], out[step:])
        done += step
    return out


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions of anchors, hashes of the strings at all positions, and each window's least hash.

    The least hash is 0 where no window of ``LENGTH`` bytes starts in its document.
    """
    total = len(data)
    if total < LENGTH:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    at = np.arange(total - SEED + 1)
    value = SpanHash(data)(at, at + SEED)
    value[value == 0] = 1
    least = _sliding(value, _SPAN, np.minimum)  # windows that start at 0 .. total - LENGTH
    # Windows that reach over the end of a row do not count.
    near = (offsets[1:-1, None] - np.arange(1, LENGTH)).ravel()
    least[near[(near >= 0) & (near < len(least))]] = 0
    around = np.concatenate((np.zeros(_SPAN - 1, np.uint64), least, np.zeros(_SPAN - 1, np.uint64)))
    highest = _sliding(around, _SPAN, np.maximum)  # over the windows that hold the string at each position
    return np.flatnonzero(highest == value), value, least


def _own_windows(at: np.ndarray, value: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last start of the windows of which each anchor is the least string: a contiguous run."""
    low, high = np.empty(len(at), np.int64), np.empty(len(at), np.int64)
    for a in range(0, len(at), 8192):
        here = at[a : a + 8192]
        window = here[:, None] - np.arange(_SPAN - 1, -1, -1)
        inside = (window >= 0) & (window < len(least))
        mine = inside & (least[np.clip(window, 0, len(least) - 1)] == value[here][:, None])
        rows = np.arange(len(here))
        low[a : a + 8192] = window[rows, mine.argmax(1)]
        high[a : a + 8192] = window[rows, _SPAN - 1 - mine[:, ::-1].argmax(1)]
    return low, high


def _rows_of(at: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.searchsorted(offsets, at, "right") - 1


def _text_keys(spans: SpanHash, offsets: np.ndarray) -> np.ndarray:
    """Tells apart the texts of rows that share a ``doc_id``."""
    return (spans(offsets[:-1], offsets[1:]) >> np.uint64(32)).astype(np.uint32)


def _anchor_postings(buckets: int):
    """Per bucket, the (anchor, document) pairs of a run of documents, packed."""

    def flush(parts: list[np.ndarray]) -> pa.RecordBatch:
        every = np.concatenate(parts)
        packed = _by_bucket(every, (_keys(every) >> np.uint64(20)) % np.uint64(buckets))
        return pa.RecordBatch.from_pydict({"bucket": packed["bucket"].to_numpy(), "blob": pa.array(packed["blob"], pa.binary())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in blocks(batches, limit=SMALL_BLOCK_BYTES):
            data, offsets = utf8(batch.column("text"))
            at, value, _ = anchors(data, offsets)
            parts.append(_keyed(value[at], batch.column("doc_id").to_numpy()[_rows_of(at, offsets)]))
            held += len(at)
            if held > 1_000_000:
                yield flush(parts)
                parts, held = [], 0
        if held:
            yield flush(parts)

    return run


def _repeated(buckets: int):
    """Of one bucket of anchors: those that several documents have, packed by bucket of documents."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        every = np.concatenate([_unpack(b, ANCHOR) for b in group["blob"]])
        key = _keys(every)
        order = np.argsort(key, kind="stable")
        every, key = every[order], key[order]
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        size = np.diff(np.r_[first, len(every)])
        several = np.minimum.reduceat(every["doc"], first) != np.maximum.reduceat(every["doc"], first)
        every = every[np.repeat(several, size)]
        return _by_bucket(every, _document_bucket(every["doc"], buckets))

    return run


def _document_bucket(doc: np.ndarray, buckets: int) -> np.ndarray:
    return mix(doc.astype(np.int64).view(np.uint64)) % np.uint64(buckets)


def _by_document(group: pd.DataFrame) -> pd.DataFrame:
    """Of one bucket of documents: each document's repeated anchors, six bytes each."""
    every = np.concatenate([_unpack(b, ANCHOR) for b in group["blob"]])
    every = every[np.argsort(every["doc"], kind="stable")]
    first = np.flatnonzero(np.r_[True, every["doc"][1:] != every["doc"][:-1]])
    keys = [_keys(p).view(np.uint8).reshape(-1, 8)[:, :6].tobytes() for p in np.split(every, first[1:])]
    return pd.DataFrame({"doc_id": every["doc"][first], "anchors": keys})


def _ranges_by_document(group: pd.DataFrame) -> pd.DataFrame:
    """Of one bucket of documents: each document's ranges, packed."""
    every = np.concatenate([_unpack(b, RANGE) for b in group["blob"]])
    every = every[np.argsort(every["doc"], kind="stable")]
    first = np.flatnonzero(np.r_[True, every["doc"][1:] != every["doc"][:-1]])
    return pd.DataFrame({"doc_id": every["doc"][first], "ranges": [_pack(p) for p in np.split(every, first[1:])]})


def _unit_postings(buckets: int):
    """Per bucket, the units of repeated anchors: their places, and each distinct unit's bytes once."""

    def flush(places: list[np.ndarray], texts: list[tuple]) -> pa.RecordBatch:
        every = np.concatenate(places)
        raw = np.concatenate([t[0] for t in texts])
        start = np.concatenate([t[1] for t in texts])
        shift = np.repeat(np.cumsum([0, *[len(t[0]) for t in texts[:-1]]]), [len(t[1]) for t in texts])
        start = start + shift
        bucket = ((every["anchor"] >> np.uint64(20)) % np.uint64(buckets)).astype(np.int32)
        order = np.lexsort((every["doc"], every["unit"], every["anchor"], bucket))
        every, bucket, start = every[order], bucket[order], start[order]
        new = np.r_[True, (every["unit"][1:] != every["unit"][:-1]) | (every["anchor"][1:] != every["anchor"][:-1])]
        first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        out_b, out_p, out_t = [], [], []
        for a, b in zip(first, np.r_[first[1:], len(every)]):
            new[a] = True
            own = np.flatnonzero(new[a:b]) + a
            size = every["size"][own].astype(np.int64)
            index = np.repeat(start[own] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            sent = np.empty(b - a, PLACE)
            for f in ("anchor", "doc", "text", "at", "size"):
                sent[f] = every[f][a:b]
            sent["new"] = new[a:b]
            out_b.append(bucket[a])
            out_p.append(_pack(sent))
            out_t.append(_squeezed(raw[index].tobytes()))
        return pa.RecordBatch.from_arrays(
            [pa.array(out_b, pa.int32()), pa.array(out_p, pa.binary()), pa.array(out_t, pa.binary())], ["bucket", "places", "texts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, texts, held = [], [], 0
        for batch in blocks(batches, limit=SMALL_BLOCK_BYTES):
            data, offsets = utf8(batch.column("text"))
            at, value, least = anchors(data, offsets)
            row = _rows_of(at, offsets)
            salt = mix(np.arange(batch.num_rows, dtype=np.uint64))
            wanted, ends = utf8(batch.column("anchors"))
            keys = np.zeros((len(wanted) // 6, 8), np.uint8)
            keys[:, :6] = wanted.reshape(-1, 6)
            known = mix(keys.view(np.uint64).ravel() ^ np.repeat(salt, np.diff(ends) // 6))
            hit = np.isin(mix(value[at] & _KEY ^ salt[row]), known)
            at, row = at[hit], row[hit]
            if not len(at):
                continue
            low, high = _own_windows(at, value, least)
            spans = SpanHash(data)
            found = np.empty(len(at), UNIT)
            found["anchor"], found["unit"] = value[at], spans(low, high + LENGTH)
            found["doc"] = batch.column("doc_id").to_numpy()[row]
            found["text"] = _text_keys(spans, offsets)[row]
            found["at"], found["size"] = low - offsets[row], high - low + LENGTH
            places.append(found)
            index_size = found["size"].astype(np.int64)
            index = np.repeat(low - (np.cumsum(index_size) - index_size), index_size) + np.arange(index_size.sum())
            texts.append((data[index], np.cumsum(index_size) - index_size))
            held += len(found)
            if held > 200_000:
                yield flush(places, texts)
                places, texts, held = [], [], 0
        if held:
            yield flush(places, texts)

    return run


def bucket_pointers(raw: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Sorts the suffixes of the strings in ``raw`` by their first ``LENGTH`` bytes.

    ``raw`` holds strings of the given sizes, one after the other. The result has a pointer for every byte
    at which a window starts: the place of its bucket in the sorted order, the same for equal windows
    only. Bytes without a window keep pointers of less depth.
    """
    total = int(size.sum())
    left = np.repeat(np.cumsum(size), size) - np.arange(total)  # bytes from here to the end of the string
    padded = np.concatenate((raw, np.zeros(8, np.uint8))).astype(np.uint64)
    prefix = np.zeros(total, np.uint64)
    for j in range(8):
        prefix = prefix << np.uint64(8) | padded[j : j + total]
    order = np.argsort(prefix, kind="stable")
    ordered = prefix[order]
    head = np.r_[True, ordered[1:] != ordered[:-1]]
    start = np.flatnonzero(head)
    pointer = np.empty(total, np.int64)
    pointer[order] = np.repeat(start, np.diff(np.r_[start, total]))
    alone = np.zeros(total, bool)
    alone[order] = np.repeat(np.diff(np.r_[start, total]) == 1, np.diff(np.r_[start, total]))
    for depth, step in ((16, 8), (32, 16), (LENGTH, LENGTH - 32)):
        active = np.flatnonzero(~alone & (left >= depth))
        if not len(active):
            break
        old, key = pointer[active], pointer[active + step]
        order = np.lexsort((key, old))
        old, key, where = old[order], key[order], active[order]
        bucket = np.r_[True, old[1:] != old[:-1]]
        part = bucket | np.r_[True, key[1:] != key[:-1]]
        bucket_start, part_start = np.flatnonzero(bucket), np.flatnonzero(part)
        sizes = np.diff(np.r_[part_start, len(old)])
        inside = part_start - bucket_start[np.cumsum(bucket)[part_start] - 1]
        # Too short suffixes stay behind in the bucket; pointers of parts stay below the next bucket.
        pointer = pointer.copy()
        pointer[where] = np.repeat(old[part_start] + inside, sizes)
        alone[where] = np.repeat(sizes == 1, sizes)
    return pointer


def _gathered(group: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of one bucket by anchor and unit, where each one's unit starts, and the units' bytes."""
    records, origin, texts, offset = [], [], [], 0
    for blob, text in zip(group["places"], group["texts"]):
        place, raw = _unpack(blob, PLACE), np.frombuffer(_unsqueezed(text), np.uint8)
        first = np.flatnonzero(place["new"])
        size = place["size"][first].astype(np.int64)
        start, count = np.cumsum(size) - size, np.diff(np.r_[first, len(place)])
        out = np.empty(len(place), UNIT)
        for f in ("anchor", "doc", "text", "at", "size"):
            out[f] = place[f]
        out["unit"] = np.repeat(SpanHash(raw)(start, start + size), count)
        records.append(out)
        origin.append(np.repeat(offset + start, count))
        texts.append(raw)
        offset += len(raw)
    every, origin, raw = np.concatenate(records), np.concatenate(origin), np.concatenate(texts)
    order = np.lexsort((every["unit"], every["anchor"]))
    return every[order], origin[order], raw


def _unit_ranges(buckets: int):
    """Of one bucket of anchors: the ranges that start in documents with smaller ids, by bucket of documents."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        every, origin, raw = _gathered(group)
        # Whole anchors are taken together until their units make up a slice.
        first = np.flatnonzero(np.r_[True, every["anchor"][1:] != every["anchor"][:-1]])
        filled = np.cumsum(np.add.reduceat(every["size"].astype(np.int64), first)) // SLICE_BYTES
        cuts = [*first[np.flatnonzero(np.diff(filled, prepend=-1))], len(every)]
        found = np.concatenate([_slice_ranges(every[a:b], origin[a:b], raw) for a, b in zip(cuts, cuts[1:])])
        return _by_bucket(found, _document_bucket(found["doc"], buckets))

    return run


def _slice_ranges(every: np.ndarray, origin: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """The ranges of places sorted by anchor and unit that start in documents with smaller ids."""
    anchor_new = np.r_[True, every["anchor"][1:] != every["anchor"][:-1]]
    unit_new = anchor_new | np.r_[True, every["unit"][1:] != every["unit"][:-1]]
    first = np.flatnonzero(unit_new)
    count = np.diff(np.r_[first, len(every)])
    smallest = np.minimum.reduceat(every["doc"], first)
    groups = np.cumsum(anchor_new)[first] - 1
    single = np.bincount(groups)[groups] == 1
    unit = np.repeat(np.arange(len(first)), count)

    later = single[unit] & (every["doc"] > smallest[unit])
    start = [every["at"][later].astype(np.int64)]
    length = [every["size"][later].astype(np.int64)]
    owner = [np.flatnonzero(later)]

    mixed = np.flatnonzero(~single)
    if len(mixed):
        size = every["size"][first[mixed]].astype(np.int64)
        base = np.cumsum(size) - size
        text = raw[np.repeat(origin[first[mixed]] - base, size) + np.arange(size.sum())]
        pointer = bucket_pointers(text, size)
        windows = size - LENGTH + 1
        at = np.repeat(base - (np.cumsum(windows) - windows), windows) + np.arange(windows.sum())
        low = np.repeat(smallest[mixed], windows)
        order = np.argsort(pointer[at], kind="stable")
        head = np.flatnonzero(np.r_[True, np.diff(pointer[at][order]) != 0])
        least = np.empty(len(at), np.int64)
        least[order] = np.repeat(np.minimum.reduceat(low[order], head), np.diff(np.r_[head, len(at)]))
        # Every place of a mixed unit against the first documents of the unit's windows.
        number = np.full(len(first), -1)
        number[mixed] = np.arange(len(mixed))
        who = np.flatnonzero(number[unit] >= 0)
        own = number[unit[who]]
        n = windows[own]
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        covered = least[np.repeat((np.cumsum(windows) - windows)[own], n) + step] < np.repeat(every["doc"][who], n)
        edge = step == 0
        begins = covered & (edge | ~np.r_[False, covered[:-1]])
        last = np.r_[edge[1:], True]
        ends = covered & (last | ~np.r_[covered[1:], False])
        place = np.repeat(who, n)
        owner.append(place[begins])
        start.append(every["at"][place[begins]].astype(np.int64) + step[begins])
        length.append(step[ends] - step[begins] + LENGTH)
    owner = np.concatenate(owner)
    found = np.empty(len(owner), RANGE)
    found["doc"], found["text"] = every["doc"][owner], every["text"][owner]
    found["start"], found["size"] = np.concatenate(start), np.concatenate(length)
    return found


def _removed(size: int, text: int, blob: bytes | None, copy: bool) -> np.ndarray:
    """Maximal removed runs of one text as (start, end) rows."""
    if copy and size >= LENGTH:
        return np.array([[0, size]])
    if not blob:
        return np.zeros((0, 2), np.int64)
    every = _unpack(blob, RANGE)
    every = every[every["text"] == text]
    if not len(every):
        return np.zeros((0, 2), np.int64)
    every = every[np.argsort(every["start"], kind="stable")]
    reach = np.maximum.accumulate(every["start"] + every["size"])
    new = np.r_[True, every["start"][1:] > reach[:-1]]
    first = np.flatnonzero(new)
    return np.stack([every["start"][first], reach[np.r_[first[1:] - 1, len(every) - 1]]], 1)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in blocks(batches, limit=SMALL_BLOCK_BYTES):
        data, offsets = utf8(batch.column("text"))
        keys = _text_keys(SpanHash(data), offsets)
        blobs, copies = batch.column("ranges").to_pylist(), batch.column("copy").to_pylist()
        kept, removed, spans, sha = [], [], [], []
        for i in range(batch.num_rows):
            whole = data[offsets[i] : offsets[i + 1]]
            runs = _removed(len(whole), keys[i], blobs[i], copies[i])
            edges = [0, *runs.ravel().tolist(), len(whole)]
            rest = b"".join(whole[a:b].tobytes() for a, b in zip(edges[::2], edges[1::2]))
            kept.append(rest)
            removed.append(int((runs[:, 1] - runs[:, 0]).sum()))
            spans.append(len(runs))
            sha.append(hashlib.sha256(rest).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), pa.array(np.diff(offsets)), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()),
             pa.array(sha), pa.array([k.decode("utf-8", "ignore") for k in kept], pa.string())],
            ["row", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def deduplicated(docs: DataFrame, *keep: str, with_text: bool = False) -> DataFrame:
    """The columns ``keep`` with ``n_bytes, n_removed, n_spans, kept_sha256``, one row per row of ``docs``.

    Every byte covered by a ``LENGTH``-byte string that also starts in a row with a smaller ``doc_id`` is
    removed; overlaps count, strings are judged on the input, and none crosses rows. Null and empty texts
    have no bytes. Rows of one ``doc_id`` do not remove from each other, and a null ``doc_id`` takes no part.
    ``with_text`` adds the text ``kept``, without bytes of characters that a cut split. Texts are read whole; an empty table
    gives no rows; other columns are carried only if named.
    """
    text_batches(docs.sparkSession)
    spark = docs.sparkSession
    buckets = shuffle_width(spark)
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.struct(*(keep or ("doc_id",))).alias("row"))
    texts = plain.where("doc_id IS NOT NULL AND octet_length(text) >= " + str(LENGTH)).select("doc_id", "text")

    # Whole copies of a text with a smaller id go entirely, and need no places of their own.
    hashed = texts.select("doc_id", F.xxhash64("text").alias("h"), F.xxhash64(F.lit(1), "text").alias("g"), F.octet_length("text").alias("n"))
    firsts = hashed.groupBy("h", "g", "n").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high")
    judged = hashed.join(firsts, ["h", "g", "n"], "left").groupBy("doc_id").agg(
        F.every(F.coalesce(F.col("doc_id") > F.col("low"), F.lit(False))).alias("copy"), F.collect_set("h").alias("copied"))
    copies = materialised(judged.where("copy").select("doc_id", "copied"))

    packed = "bucket int, blob binary"
    repeated = texts.mapInArrow(handing_back(_anchor_postings(buckets)), packed).groupBy("bucket").applyInPandas(_repeated(buckets), packed) \
        .groupBy("bucket").applyInPandas(_by_document, "doc_id long, anchors binary")
    wanted = materialised(repeated.join(copies, "doc_id", "left_anti"))

    # Both joins read the same columns of the same rows, so that one shuffle of the documents serves both.
    numbered = plain.where("doc_id IS NOT NULL")
    units = numbered.join(wanted, "doc_id").select("doc_id", "text", "row", "anchors") \
        .mapInArrow(handing_back(_unit_postings(buckets)), "bucket int, places binary, texts binary")
    ranges = units.groupBy("bucket").applyInPandas(_unit_ranges(buckets), packed) \
        .groupBy("bucket").applyInPandas(_ranges_by_document, "doc_id long, ranges binary")
    found = numbered.join(ranges.join(copies, "doc_id", "full"), "doc_id", "left")
    copy = F.coalesce(F.array_contains("copied", F.xxhash64("text")), F.lit(False))
    apart = plain.where("doc_id IS NULL").select("row", "text", F.lit(None).cast("binary").alias("ranges"), F.lit(False).alias("copy"))
    kind = docs.select(F.struct(*(keep or ("doc_id",))).alias("row")).schema["row"].dataType.simpleString()
    cut = found.select("row", "text", "ranges", copy.alias("copy")).union(apart).mapInArrow(
        handing_back(_cut), f"row {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept string")
    return cut.select("row.*", "n_bytes", "n_removed", "n_spans", "kept_sha256", *(["kept"] if with_text else []))
