"""Language identification by nearest centroids of character n-gram vectors.

A text is the bag of its letter trigrams (lower-cased, words padded by one blank), hashed into ``BINS``
bins, weighted by TF-IDF with a damped count and scaled to length one. Each language has several
centroids, found by spherical k-means on a bounded sample of its labelled texts. The nearest centroid
by cosine names the language; a text that lies farther from it than nearly every training text of that
centroid and of like length is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfstack.llm.storage import text_batches
from shelfstack.llm.texts import blocks, handing_back

_BITS = 14
BINS = 1 << _BITS  # so many that texts of unrelated languages seldom meet by collision
CENTROIDS = 4
SAMPLE_PER_LANGUAGE = 1000  # labelled texts per language that the centroids are fitted on, about
LOW = 0.01  # quantile of the similarities that a centroid's own fitted texts of like length have
REJECT_SHARE = 0.8  # rejected below this share of that quantile
_FLOOR_TEXTS = 50  # fitted texts that a quantile is taken from; where a length class has fewer, its neighbours help
UNDETERMINED = "und"
_LETTER = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
_FEW = 16  # texts whose counts are whole at a time
_BLOCK = 64  # vectors of a sample that are whole at a time
_LENGTHS = 12  # length classes: powers of two of the number of trigrams


@dataclass(frozen=True)
class Model:
    languages: list[str]
    owner: np.ndarray  # language of each centroid
    centroids: np.ndarray  # one row per centroid, scaled to length one
    idf: np.ndarray
    floor: np.ndarray  # per centroid and length class, the similarity under which a text is rejected


def trigram_counts(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Counts of trigram bins per text, and the number of letters per text."""
    joined = "\n".join([t or "" for t in texts]).lower()
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    # Lower-casing may change a text's length, so rows are found again by their own lengths.
    lengths = np.array([len((t or "").lower()) for t in texts], np.int64)
    letter = _LETTER[points]
    clean = np.where(letter, points, 32).astype(np.uint32)
    row = np.repeat(np.arange(len(texts)), lengths + 1)[: len(points)]
    padded = np.concatenate(([np.uint32(32)], clean, [np.uint32(32)]))
    a, b, c = padded[:-2], padded[1:-1], padded[2:]
    keep = letter  # the middle character is a letter
    code = (a[keep] * np.uint32(0x9E3779B1) ^ b[keep] * np.uint32(0x85EBCA77)) * np.uint32(0xC2B2AE3D) ^ c[keep] * np.uint32(0x27D4EB2F)
    code ^= code >> np.uint32(15)
    code *= np.uint32(0x2C1B3C6D)
    at = row[keep] * BINS + (code >> np.uint32(32 - _BITS)).astype(np.int64)
    counts = np.bincount(at, minlength=len(texts) * BINS).reshape(len(texts), BINS)
    return counts, np.bincount(row[keep], minlength=len(texts))


def vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    weighted = np.log1p(counts, dtype=np.float32) * idf
    return weighted / np.maximum(np.linalg.norm(weighted, axis=1, keepdims=True), 1e-12)


def _vectors_of(texts: list[str | None], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of texts, and their numbers of letters; counts are whole for a few texts at a time."""
    points, letters = np.empty((len(texts), BINS), np.float32), np.empty(len(texts), np.int64)
    for at in range(0, len(texts), _FEW):
        counts, letters[at : at + _FEW] = trigram_counts(texts[at : at + _FEW])
        points[at : at + _FEW] = vectors(counts, idf)
    return points, letters


def _length_class(letters: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(np.maximum(letters, 1)).astype(int), _LENGTHS - 1)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in blocks(batches, limit=1 << 20):
        for at in range(0, batch.num_rows, 128):
            yield batch.slice(at, 128)


def _document_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, texts = np.zeros(BINS, np.int64), 0
    for batch in _slices(batches):
        for at in range(0, batch.num_rows, _FEW):
            counts, letters = trigram_counts(batch.column("text").slice(at, _FEW).to_pylist())
            total += (counts > 0).sum(0)
            texts += int((letters > 0).sum())
    yield pa.RecordBatch.from_pydict({"bin": np.arange(BINS + 1), "n": np.append(total, texts)})


def _features(batches: Iterator[pa.RecordBatch], idf: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Each text's vector, as the bins that it has and their weights."""
    for batch in _slices(batches):
        points, letters = _vectors_of(batch.column("text").to_pylist(), idf)
        bins = [np.flatnonzero(p).astype(np.uint16) for p in points]
        yield pa.RecordBatch.from_pydict({
            "lang": batch.column("lang"), "doc_id": batch.column("doc_id"), "letters": letters,
            "bins": pa.array([b.tobytes() for b in bins], pa.binary()),
            "weights": pa.array([p[b].tobytes() for p, b in zip(points, bins)], pa.binary())})


class _Points:
    """The vectors of one language's sample, kept as bins and weights; whole ones exist for a block of rows at a time."""

    def __init__(self, bins: list[bytes], weights: list[bytes]):
        self.bins = [np.frombuffer(b, np.uint16) for b in bins]
        self.weights = [np.frombuffer(w, np.float32) for w in weights]

    def __len__(self) -> int:
        return len(self.bins)

    def whole(self, rows: np.ndarray) -> np.ndarray:
        out = np.zeros((len(rows), BINS), np.float32)
        for point, i in zip(out, rows):
            point[self.bins[i]] = self.weights[i]
        return out

    def like(self, rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
        """The cosines of some rows with ``centres``."""
        return np.concatenate([self.whole(rows[at : at + _BLOCK]) @ centres.T for at in range(0, len(rows), _BLOCK)])

    def total(self, rows: np.ndarray) -> np.ndarray:
        out = np.zeros(BINS, np.float32)
        for i in rows:  # a vector has a bin once
            out[self.bins[i]] += self.weights[i]
        return out


def _spherical_means(points: _Points, rows: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """Centroids of some rows by k-means with cosine, from ``k`` points far from each other."""
    chosen = [int(rng.integers(len(rows)))]
    while len(chosen) < min(k, len(rows)):
        nearest = points.like(rows, points.whole(rows[chosen])).max(1)
        chosen.append(int(nearest.argmin()))
    centres = points.whole(rows[chosen])
    for _ in range(15):
        own = points.like(rows, centres).argmax(1)
        for j in range(len(centres)):
            if (own == j).any():
                mean = points.total(rows[own == j])
                centres[j] = mean / max(np.linalg.norm(mean), 1e-12)
    return centres


def _floors(near: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """For one centroid: per length class, the similarity that nearly all of its texts have, less some slack.

    Texts of longer classes count for a shorter one with the similarity that falls with the root of the length.
    """
    out = np.zeros(_LENGTHS)
    for c in range(_LENGTHS):
        away = np.abs(classes - c)
        own = away <= np.sort(away)[min(_FLOOR_TEXTS, len(away)) - 1]
        like = near[own] * 2.0 ** (-0.5 * np.maximum(classes[own] - c, 0))
        out[c] = REJECT_SHARE * np.quantile(like, LOW)
    return out


def fit(train: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> Model:
    """Fits a model on ``train`` (``doc_id, text, lang``); rows without text or label teach nothing.

    The trigrams' document frequencies cover every row. The centroids are fitted on about ``per_language``
    whole texts of each language, chosen by a hash of the row; the vectors of that sample are all that
    reaches the driver, which holds them as bins and weights. Without any labelled text the model is empty and every text is undetermined.
    """
    text_batches(train.sparkSession)
    train = train.where("text IS NOT NULL AND lang IS NOT NULL").select("doc_id", "text", "lang")
    frequency = train.select("text").mapInArrow(handing_back(_document_frequencies), "bin long, n long").groupBy("bin").agg(F.sum("n").alias("n"))
    n = np.zeros(BINS + 1)
    for r in frequency.collect():  # BINS + 1 rows
        n[r.bin] = r.n
    idf = (np.log((1 + n[-1]) / (1 + n[:-1])) + 1).astype(np.float32)
    sizes = train.groupBy("lang").agg(F.count("*").alias("n"))
    sizes = sizes.withColumn("least", F.lit(float(per_language)) / F.col("n"))
    draw = F.pmod(F.xxhash64("doc_id", F.lit("language")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = train.join(F.broadcast(sizes), "lang").where(draw < F.col("least"))
    rows = sample.select("lang", "doc_id", "text").mapInArrow(
        handing_back(lambda batches: _features(batches, idf)), "lang string, doc_id long, letters long, bins binary, weights binary").collect()
    rows.sort(key=lambda r: (r.lang, r.doc_id is None, r.doc_id or 0, r.bins))
    languages = sorted({r.lang for r in rows})
    owner, centroids, floor = [], [], []
    rng = np.random.default_rng(7)
    for number, language in enumerate(languages):
        own = [r for r in rows if r.lang == language and r.letters > 0]
        if not own:
            continue
        points = _Points([r.bins for r in own], [r.weights for r in own])
        size = np.array([r.letters for r in own])
        centres = _spherical_means(points, np.flatnonzero(size >= min(64, np.median(size))), CENTROIDS, rng)
        owner += [number] * len(centres)
        centroids.append(centres)
        like = points.like(np.arange(len(points)), centres)
        mine, classes = like.argmax(1), _length_class(size)
        best = like.max(1)
        for j in range(len(centres)):  # a centroid with few texts, often outliers, takes all of its language
            own = mine == j if (mine == j).sum() >= _FLOOR_TEXTS else mine >= 0
            floor.append(_floors(best[own], classes[own]))
    if not centroids:
        return Model([], np.zeros(0, int), np.zeros((0, BINS), np.float32), idf, np.zeros((0, _LENGTHS)))
    return Model(languages, np.array(owner), np.concatenate(centroids).astype(np.float32), idf, np.array(floor))


def identify(docs: DataFrame, model: Model, *keep: Column | str) -> DataFrame:
    """The columns ``keep`` with ``lang_pred``, ``score`` (cosine, 0 to 1) and ``rejected``.

    Only the text decides. A text that is null, empty or has no letter, and any text under an empty model,
    is ``und`` with score 0 and rejected. Every text is read whole, whatever its length; equal texts get
    equal results; other columns, also of the same names, are not looked at.
    """
    text_batches(docs.sparkSession)
    source = docs.select(F.struct(*(keep or docs.columns)).alias("kept"), docs["text"].alias("text"))
    kind = source.schema["kept"].dataType

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            points, letters = _vectors_of(batch.column("text").to_pylist(), model.idf)
            if len(model.languages):
                like = points @ model.centroids.T
                best = like.argmax(1)
                similarity = np.clip(like[np.arange(len(best)), best].astype(float), 0.0, 1.0)
                names = np.array(model.languages, object)[model.owner[best]]
                far = similarity < model.floor[best, _length_class(letters)]
            else:
                similarity, names, far = np.zeros(len(letters)), np.full(len(letters), UNDETERMINED, object), True
            void = (letters == 0) | (not model.languages)
            names[void], similarity[void] = UNDETERMINED, 0.0
            rejected = void | far
            yield pa.RecordBatch.from_arrays(
                [batch.column("kept"), pa.array(names, pa.string()), pa.array(similarity), pa.array(rejected)],
                ["kept", "lang_pred", "score", "rejected"])

    schema = T.StructType([
        T.StructField("kept", kind), T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())])
    return source.mapInArrow(handing_back(score), schema).select("kept.*", "lang_pred", "score", "rejected")


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    """Whether CRC32 of the id's digits leaves ``part`` when divided by ``parts``; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % parts == part, F.lit(False))
