"""URL rules by Bloom filter cascades: exact membership over the corpus's keys, without joins.

A rule is a host and a path prefix. A URL's keys are its host's suffixes of as many
labels as rules have, each followed by the path's prefixes of the lengths that rules have; its longest listed key is the rule that decides. The
first level of a cascade encodes the listed keys. Every other key of the corpus that passes it is encoded
in the second, every listed key that passes that in the third, and so on until nothing passes wrongly;
the level that first turns a key away then tells whether it is listed. A level's size follows the listed
keys, not the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil, log, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfstack.llm.storage import materialised
from shelfstack.llm.texts import mix

PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_MOST_LEVELS = 64


@dataclass(frozen=True)
class Level:
    bits: np.ndarray  # 64 to a word
    size: int
    hashes: int
    number: int

    def positions(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """The bits of each key, a row per hash function."""
        salt = np.uint64(0x9E3779B97F4A7C15 * (self.number + 1) % (1 << 64))
        a, b = mix(one ^ salt), mix(two ^ salt) | np.uint64(1)
        return np.stack([(a + np.uint64(j) * b) % np.uint64(self.size) for j in range(self.hashes)])

    def has(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        at = self.positions(one, two)
        return ((self.bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)) == 1).all(0)


@dataclass(frozen=True)
class Cascade:
    levels: list[Level]

    def listed(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Whether each key is listed; exact for listed keys and all keys of the corpus."""
        out = np.zeros(len(one), bool)
        open_ = np.arange(len(one))
        for level in self.levels:
            out[open_] = level.number % 2 == 1  # turned away here
            open_ = open_[level.has(one[open_], two[open_])]
            out[open_] = level.number % 2 == 0  # passed, so far
        return out


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The lower-cased host and the path; both empty for null and for URLs without ``://``."""
    part = lambda i: F.coalesce(F.regexp_extract(url, PARTS, i), F.lit(""))
    return F.translate(part(1), _CAPITALS, _CAPITALS.lower()), part(2)


def url_keys(host: Column, path: Column, lengths: list[int], labels: list[int]) -> Column:
    """All keys that could be rules for a URL, the longest first, of equal ones that with the longer host.

    ``lengths`` are those of the rules' paths and ``labels`` the numbers of their hosts' labels: no other part
    of a host or path is looked at, however long they are.
    """
    parts = F.split(host, r"\.")
    counts = F.filter(F.array(*map(F.lit, labels)).cast("array<int>"), lambda k: k <= F.size(parts))
    suffixes = F.transform(counts, lambda k: F.array_join(F.slice(parts, -k, k), "."))
    fitting = F.filter(F.array(*map(F.lit, lengths)).cast("array<int>"), lambda n: n <= F.length(path))
    keys = F.flatten(F.transform(suffixes, lambda s: F.transform(
        fitting, lambda n: F.struct((F.length(s) + n).alias("n"), F.length(s).alias("h"), F.concat(s, F.substring(path, F.lit(1), n)).alias("key")))))
    return F.transform(F.sort_array(keys, asc=False), lambda k: k["key"])


def _hashes(key: Column) -> list[Column]:
    return [F.xxhash64(key).alias("one"), F.xxhash64(F.lit(7), key).alias("two")]


def _level(keys: DataFrame, count: int, rate: float, number: int) -> Level:
    """A filter of the keys' hashes (``one``, ``two``), its words put together by Spark."""
    hashes = max(1, ceil(-log(rate, 2)))
    blank = Level(np.zeros(0, np.uint64), max(64, ceil(count * hashes / log(2))), hashes, number)

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = blank.positions(*(batch.column(c).to_numpy().view(np.uint64) for c in ("one", "two"))).ravel()
            yield pa.RecordBatch.from_pydict({
                "word": (at >> np.uint64(6)).astype(np.int64), "mask": (np.uint64(1) << (at & np.uint64(63))).view(np.int64)})

    rows = keys.select("one", "two").mapInArrow(words, "word long, mask long").groupBy("word").agg(F.bit_or("mask").alias("mask")).collect()
    bits = np.zeros(blank.size // 64 + 1, np.int64)
    for r in rows:  # the filter itself: its size follows the listed keys
        bits[r.word] = r.mask
    return Level(bits.view(np.uint64), blank.size, hashes, number)


def _passing(keys: DataFrame, level: Level) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = (batch.column(c).to_numpy().view(np.uint64) for c in ("one", "two"))
            yield batch.filter(pa.array(level.has(one, two)))

    return keys.mapInArrow(run, keys.schema)


def build_cascade(listed: DataFrame, universe: DataFrame) -> Cascade:
    """A cascade for the listed keys over a universe of keys (both with one column ``key``).

    Repeated and null keys are no matter; listed keys need not be in the universe. Keys stand for their two
    64-bit hashes; should a listed and another key agree in both, building fails rather than mixing them up.
    """
    inside = materialised(listed.where("key IS NOT NULL").distinct().select("key", *_hashes(F.col("key"))))
    n = inside.count()
    if n == 0:
        return Cascade([])
    total = universe.agg(F.approx_count_distinct("key")).first()[0]
    rate = min(0.5, n / (sqrt(2) * max(total, 1)))
    levels = [_level(inside, n, rate, 0)]
    every = universe.where("key IS NOT NULL").select("key", *_hashes(F.col("key")))
    outside = materialised(_passing(every, levels[0]).distinct().join(inside, "key", "left_anti"))
    turned = (outside, inside)  # what is encoded next, and what must not pass it
    while (count := turned[0].count()) and len(levels) < _MOST_LEVELS:
        levels.append(_level(turned[0], count, 0.5, len(levels)))
        turned = (materialised(_passing(turned[1], levels[-1])), turned[0])
    if count:
        raise ValueError("two keys agree in both hashes")
    return Cascade(levels)


def judged(pages: DataFrame, rules: list[tuple[str, str, str]], *keep: str) -> DataFrame:
    """The columns ``keep`` with ``host, path, rule, verdict`` for every row of ``pages`` (``url``).

    ``rules`` are (host, path, ``allow`` or ``block``). A rule fits its host and all subdomains where the
    path starts with the rule's; the longest decides, and of equally long ones that with the longer host; a
    key under both verdicts blocks. Without a rule the key is not in any list: ``rule`` is null and the
    verdict ``allow``. Null URLs and URLs without ``://`` have an empty host and path. Other columns are not
    looked at; an empty table or list of rules is fine.
    """
    spark = pages.sparkSession
    lengths, labels = sorted({len(path) for _, path, _ in rules}), sorted({host.count(".") + 1 for host, _, _ in rules})
    host, path = host_and_path(pages["url"])
    named = pages.select(F.struct(*(keep or pages.columns)).alias("row"), host.alias("host"), path.alias("path"))
    keyed = named.withColumn("keys", url_keys(F.col("host"), F.col("path"), lengths, labels) if lengths else F.array().cast("array<string>"))
    universe = keyed.select(F.explode("keys").alias("key"))
    cascades = []
    for verdict in ("block", "allow"):
        keys = sorted({(h + p,) for h, p, v in rules if v == verdict})
        cascades.append(build_cascade(spark.createDataFrame(keys, "key string"), universe))
    block, allow = cascades

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("hashes")
            flat = lists.flatten()
            one, two = (flat.field(c).to_numpy().view(np.uint64) for c in ("one", "two"))
            blocked = block.listed(one, two)
            hit = np.flatnonzero(blocked | allow.listed(one, two))
            edges = lists.offsets.to_numpy().astype(np.int64)
            edges = edges - edges[0]
            rows, first = np.unique(np.searchsorted(edges, hit, "right") - 1, return_index=True)
            index, stop = np.full(batch.num_rows, -1, np.int32), np.zeros(batch.num_rows, bool)
            index[rows], stop[rows] = hit[first] - edges[rows], blocked[hit[first]]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("host"), batch.column("path"), batch.column("keys"), pa.array(index), pa.array(stop)],
                ["row", "host", "path", "keys", "at", "stop"])

    hashed = keyed.withColumn("hashes", F.transform("keys", lambda k: F.struct(*_hashes(k))))
    kind = named.schema["row"].dataType.simpleString()
    found = hashed.mapInArrow(decide, f"row {kind}, host string, path string, keys array<string>, at int, stop boolean")
    return found.select(
        "row.*", "host", "path", F.when(F.col("at") >= 0, F.get("keys", F.col("at"))).alias("rule"),
        F.when(F.col("stop"), "block").otherwise("allow").alias("verdict"))
