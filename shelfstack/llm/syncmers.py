"""Document fingerprints from closed syncmers.

A ``KMER``-byte string is a closed syncmer if the least of the ``INNER``-byte strings in it, by hash, is its
first or its last. That depends on the string alone, so a passage has the same anchors wherever it stands.
A fingerprint holds the ``ANCHORS`` anchors of least hash with their places; two fingerprints are alike by
the anchors they share at one shift.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfstack.llm.storage import shuffle_width, text_batches
from shelfstack.llm.texts import SpanHash, blocks, mix, utf8

KMER = 24
INNER = 8
ANCHORS = 32
SHIFT_SLACK = 64  # bytes by which shifts of matching anchors may differ
_SPAN = KMER - INNER + 1
ANCHOR = np.dtype([("hash", ">u4"), ("at", ">u4")])
_FIRST = -(1 << 63)


def syncmers(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and 64-bit hashes of all closed syncmers of a byte string."""
    if len(data) < KMER:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    inner = data.astype(np.uint64)
    for step in (1, 2, 4):  # the 8 bytes from each place on, as one number
        inner = inner[:-step] | inner[step:] << np.uint64(8 * step)
    inner = mix(inner)
    done, least = 1, inner
    while done < _SPAN:
        step = min(done, _SPAN - done)
        least = np.minimum(least[: len(least) - step], least[step:])
        done += step
    at = np.flatnonzero((least == inner[: len(least)]) | (least == inner[_SPAN - 1 :]))
    value = inner[at] * np.uint64(3) + inner[at + INNER] * np.uint64(5) + inner[at + 2 * INNER] * np.uint64(7)
    return at, mix(value)


def fingerprints(column: pa.Array) -> list[bytes]:
    """The fingerprint of every text of a column, as bytes; empty for null and empty texts."""
    data, offsets = utf8(column)
    at, value = syncmers(data)
    row = np.searchsorted(offsets, at, "right") - 1
    whole = at + KMER <= offsets[row + 1]
    at, value, row = at[whole], (value[whole] >> np.uint64(32)).astype(np.uint32), row[whole]
    order = np.lexsort((at, value, row))
    at, value, row = at[order] - offsets[row[order]], value[order], row[order]
    # Of equal anchors in one text the first counts.
    new = np.r_[True, (row[1:] != row[:-1]) | (value[1:] != value[:-1])][: len(row)]
    at, value, row = at[new], value[new], row[new]
    count = np.bincount(row, minlength=len(column))
    start = np.cumsum(count) - count
    kept = np.arange(len(row)) - start[row] < ANCHORS
    records = np.empty(kept.sum(), ANCHOR)
    records["hash"], records["at"] = value[kept], at[kept]
    bounds = np.r_[0, np.cumsum(np.minimum(count, ANCHORS))]
    out = [records[a:b].tobytes() for a, b in zip(bounds, bounds[1:])]
    # A text without any anchor is an anchor as a whole.
    bare = np.flatnonzero((count == 0) & (np.diff(offsets) > 0))
    if len(bare):
        single = np.zeros(len(bare), ANCHOR)
        single["hash"] = SpanHash(data)(offsets[bare], offsets[bare + 1]) >> np.uint64(32)
        for i, r in zip(bare, single):
            out[i] = r.tobytes()
    return out


def likeness(one: bytes, two: bytes) -> float:
    """From 0 to 1: the share of anchors in common at one shift, as the Dice coefficient of the whole texts' anchors."""
    if one == two:
        return 1.0
    x, y = np.frombuffer(one, ANCHOR), np.frombuffer(two, ANCHOR)
    if not len(x) or not len(y):
        return 0.0
    hx, hy = x["hash"].astype(np.int64), y["hash"].astype(np.int64)
    union = np.union1d(hx, hy)
    # Beyond its last anchor, a full fingerprint does not tell what its text has.
    last = min([h[-1] for h in (hx, hy) if len(h) == ANCHORS], default=union[-1])
    seen = int((union <= last).sum())
    _, i, j = np.intersect1d(hx, hy, assume_unique=True, return_indices=True)
    shift = x["at"][i].astype(np.int64) - y["at"][j].astype(np.int64)
    shift = np.sort(shift[hx[i] <= last])
    if not len(shift):
        return 0.0
    most = int((np.searchsorted(shift, shift + SHIFT_SLACK, "right") - np.arange(len(shift))).max())
    return 2.0 * most / (seen + most)


def _placed(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` (``key``) in buckets of consecutive keys, a few for each shuffle partition.

    The first row of a bucket is put (``late``) into the bucket before as well, and the first of all into the last.
    """
    buckets = 2 * shuffle_width(docs.sparkSession)
    keys = docs.select("key")
    steps = F.array(*[F.lit(i / buckets) for i in range(1, buckets)])
    found = keys.agg(F.percentile_approx("key", steps, F.lit(10 * buckets)).alias("edges")).first()
    edges = sorted(set(found.edges or []))
    bucket = F.size(F.filter(F.array(*map(F.lit, edges)).cast("array<bigint>"), lambda e: e <= F.col("key"))) if edges else F.lit(0)
    firsts = sorted((r.bucket, r.key) for r in keys.withColumn("bucket", bucket).groupBy("bucket").agg(F.min("key").alias("key")).collect())
    placed = docs.withColumn("bucket", bucket).withColumn("late", F.lit(0))
    if not firsts:
        return placed
    before = {key: firsts[i - 1][0] for i, (_, key) in enumerate(firsts)}
    to = F.create_map(*[F.lit(x) for pair in before.items() for x in pair])
    again = docs.where(F.col("key").isin(list(before))).withColumn("bucket", to[F.col("key")]).withColumn("late", F.lit(1))
    return placed.unionByName(again)


def fingerprinted(docs: DataFrame) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next`` per row.

    The edited text has the last quarter (rounded down) of a text's code points replaced by as many first
    code points of the next text, or all it has. The next text is that of the next row by ``doc_id``, then
    text; a null ``doc_id`` comes first, and the first row follows the last, also where there is only one.
    Null texts count as empty; an empty text has an empty fingerprint, alike (1.0) only with another empty
    one. Equal texts have equal fingerprints. Other columns are not looked at; texts are read whole.
    """
    text_batches(docs.sparkSession)
    source = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_FIRST)).alias("key"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches):
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(fingerprints(batch.column("text")), pa.binary())], [*batch.schema.names, "print"])

    kind = source.schema["doc_id"].dataType.simpleString()
    marked = _placed(source).mapInArrow(mark, f"key long, doc_id {kind}, text string, bucket int, late int, print binary")
    following = Window.partitionBy("bucket").orderBy("late", "key", "text")
    ahead = marked.withColumns({"next_text": F.lead("text").over(following), "next_print": F.lead("print").over(following)})
    n = F.length("text")
    cut = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - cut), F.substring("next_text", F.lit(1), cut))
    texts = ahead.where("late = 0").select("doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "print", "next_print")
    hashed = texts.withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "edited"):
            own, after = batch.column("print").to_pylist(), batch.column("next_print").to_pylist()
            changed = fingerprints(batch.column("edited"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_chars"), batch.column("edited_sha256"),
                 pa.array([p.hex() for p in own]), pa.array([p.hex() for p in changed]),
                 pa.array([likeness(p, q) for p, q in zip(own, changed)]), pa.array([likeness(p, q) for p, q in zip(own, after)])],
                ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    return hashed.mapInArrow(
        compare, f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
