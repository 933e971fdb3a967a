"""Exact n-gram Jaccard join of documents by grouped prefixes.

Shingles are ordered from rare to frequent, by a fixed-size table of counts and then by hash. Two sets
that are alike enough share a shingle among the first ``n - need(n) + 1`` of each, so only those
prefixes are shuffled. Documents with the same prefix and size form one group, and equal sets in it one
class; groups that share a prefix shingle and pass the size and position filters become candidate
pairs, which are expanded to classes and verified on whole sets.

A shingle shared by many groups is not expanded into all pairs at once. Round one compares everyone on
its list with the list's most copied group. Round two compares the other pairs of a list, as far as their
classes are still in different components; a pair comes from its first common list only, and long lists
are dealt into chunks that meet in pairs. Every link between two components of round one is
therefore compared, and components come out exact. Before whole sets are fetched, 1024-bit maps of the
sets bound their overlap: every bit in which two maps differ is a shingle that the sets do not share.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfstack.llm.components import components
from shelfstack.llm.storage import materialised, shuffle_width, stored, text_batches
from shelfstack.llm.texts import SMALL_BLOCK_BYTES, blocks, handing_back, mix, shingles, utf8, word_hashes

COUNT_BITS = 18  # the count table has 2**18 entries, whatever the corpus
_SLICES = 64
MAP_BITS = 1024
SHORT_LIST = 64  # up to this many groups, a list's pairs are formed where it lies; longer ones after round one
CHUNK = 2048  # about so many classes of a long list meet as many others in one group of round two
POSTING = np.dtype([("token", "u8"), ("group", "u8"), ("n", "u4"), ("at", "u4"), ("docs", "u4")])


def need(n: np.ndarray, percent: int) -> np.ndarray:
    """The least overlap of a set of size ``n`` with any set it links to."""
    return -(-percent * n // 100)


def _bin(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - COUNT_BITS)).astype(np.int64)


def _sets(batch: pa.RecordBatch, n: int) -> tuple[np.ndarray, np.ndarray]:
    return shingles(*word_hashes(batch.column("text")), n)


def _set_keys(row: np.ndarray, token: np.ndarray, size: np.ndarray) -> np.ndarray:
    """One key per set, whatever the order of its shingles."""
    whole = np.zeros(len(size), np.uint64)
    np.add.at(whole, row, mix(token ^ np.uint64(0xA5A5A5A5)))
    return mix(whole + size.astype(np.uint64))


def shingle_counts(docs: DataFrame, n: int) -> np.ndarray:
    """How many shingles of all documents fall into each entry of the count table."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << COUNT_BITS, np.int64)
        for batch in blocks(batches, limit=SMALL_BLOCK_BYTES):
            total += np.bincount(_bin(_sets(batch, n)[1]), minlength=len(total))
        parts = total.reshape(_SLICES, -1)
        yield pa.RecordBatch.from_pydict({"slice": np.arange(_SLICES), "counts": [p.tobytes() for p in parts]})

    def add(group: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(c, np.int64) for c in group["counts"])
        return pd.DataFrame({"slice": group["slice"][:1], "counts": [total.tobytes()]})

    kind = "slice long, counts binary"
    rows = docs.select("text").mapInArrow(handing_back(count), kind).groupBy("slice").applyInPandas(add, kind).collect()
    table = {r.slice: np.frombuffer(r.counts, np.int64) for r in rows}
    blank = np.zeros((1 << COUNT_BITS) // _SLICES, np.int64)
    return np.concatenate([table.get(i, blank) for i in range(_SLICES)])


def _pack(records: np.ndarray) -> bytes:
    """Columns one after the other, which compress better than rows."""
    return b"".join(np.ascontiguousarray(records[f]).tobytes() for f in POSTING.names)


def _unpack(blob: bytes) -> np.ndarray:
    size = len(blob) // POSTING.itemsize
    out, at = np.empty(size, POSTING), 0
    for f in POSTING.names:
        width = POSTING[f].itemsize * size
        out[f] = np.frombuffer(blob, POSTING[f], size, at)
        at += width
    return out


def _prefixes(docs: DataFrame, n: int, percent: int, counts: np.ndarray) -> DataFrame:
    """``kind`` 0: each document's size and keys; ``kind`` 1: packed prefix postings by bucket."""
    buckets = shuffle_width(docs.sparkSession)
    rank = np.argsort(np.argsort(counts, kind="stable"), kind="stable").astype(np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[np.ndarray] = []
        held = 0
        for batch in blocks(batches, limit=SMALL_BLOCK_BYTES):
            row, token = _sets(batch, n)
            rows = batch.num_rows
            size = np.bincount(row, minlength=rows)
            order = np.lexsort((token, rank[_bin(token)], row))
            token = token[order]
            start = np.cumsum(size) - size
            place = np.arange(len(token)) - start[row]
            prefix = size - need(size, percent) + 1
            front = place < prefix[row]
            head = np.zeros(rows, np.uint64)
            np.add.at(head, row[front], mix(token[front]))
            group = mix(head ^ mix(size.astype(np.uint64)))
            keys = _set_keys(row, token, size)
            bits = np.zeros((rows, MAP_BITS), bool)
            bits[row, (token % np.uint64(MAP_BITS)).astype(np.int64)] = True
            maps = [m.tobytes() for m in np.packbits(bits, axis=1)]
            yield _rows(0, batch.column("doc_id"), size, group, keys, None, maps)
            kept = np.zeros(front.sum(), POSTING)
            kept["token"], kept["group"] = token[front], group[row[front]]
            kept["n"], kept["at"], kept["docs"] = size[row[front]], place[front], 1
            waiting.append(kept)
            held += len(kept)
            if held > 500_000:
                yield _postings(waiting, buckets)
                waiting, held = [], 0
        if held:
            yield _postings(waiting, buckets)

    kind = "kind int, doc_id long, n long, group_key long, set_key long, bucket int, blob binary"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(handing_back(run), kind)


def _rows(kind, doc_id, n, group, keys, bucket, blob) -> pa.RecordBatch:
    size = len(doc_id) if doc_id is not None else len(bucket)
    cell = lambda x, t: pa.nulls(size, t) if x is None else pa.array(x, t)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(size, kind, np.int32)), doc_id if doc_id is not None else pa.nulls(size, pa.int64()),
         cell(n, pa.int64()), cell(None if group is None else group.view(np.int64), pa.int64()),
         cell(None if keys is None else keys.view(np.int64), pa.int64()), cell(bucket, pa.int32()), cell(blob, pa.binary())],
        ["kind", "doc_id", "n", "group_key", "set_key", "bucket", "blob"])


def _merged(parts: list[np.ndarray]) -> np.ndarray:
    """Postings by token and group; those of copies are one with their number."""
    every = np.concatenate(parts)
    every = every[np.lexsort((every["group"], every["token"]))]
    new = np.r_[True, (every["token"][1:] != every["token"][:-1]) | (every["group"][1:] != every["group"][:-1])]
    first = np.flatnonzero(new)
    out = every[first]
    out["docs"] = np.minimum(np.add.reduceat(every["docs"].astype(np.int64), first), 0xFFFFFFFF)
    return out


def _postings(parts: list[np.ndarray], buckets: int) -> pa.RecordBatch:
    every = _merged(parts)
    bucket = (mix(every["token"]) % np.uint64(buckets)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    every, bucket = every[order], bucket[order]
    first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    blobs = [_pack(p) for p in np.split(every, first[1:])]
    return _rows(1, None, None, None, None, bucket[first], blobs)


def _alike(one: np.ndarray, two: np.ndarray, percent: int) -> np.ndarray:
    """Whether sizes, and the places of a common shingle, leave room for enough overlap."""
    n, m = one["n"].astype(np.int64), two["n"].astype(np.int64)
    room = np.minimum(n - one["at"], m - two["at"])
    return (100 * np.minimum(n, m) >= percent * np.maximum(n, m)) & (room * (100 + percent) >= percent * (n + m))


def _distinct_pairs(a: list[np.ndarray], b: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    one, two = np.concatenate(a), np.concatenate(b)
    one, two = np.minimum(one, two), np.maximum(one, two)
    order = np.lexsort((two, one))
    one, two = one[order], two[order]
    new = np.r_[True, (one[1:] != one[:-1]) | (two[1:] != two[:-1])][: len(one)]
    return one[new], two[new]


def _lists(percent: int):
    """For one bucket: ``kind`` 0 pairs with hubs, 1 other pairs of short lists, 2 members ``b`` of long list ``a``."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        every = _merged([_unpack(b) for b in group["blob"]])
        token = every["token"]
        first = np.flatnonzero(np.r_[True, token[1:] != token[:-1]])
        every, count, number = _several(every, np.diff(np.r_[first, len(token)]))
        first = np.cumsum(count) - count
        # The hub of a list, its first member from here on, is its most copied group.
        every = every[np.lexsort((every["group"], -every["docs"].astype(np.int64), number))]
        hub = every[np.repeat(first, count)]
        near = _alike(hub, every, percent) & (np.arange(len(every)) != np.repeat(first, count))
        hubs = _distinct_pairs([hub["group"][near]], [every["group"][near]])
        short = every[np.repeat(count <= SHORT_LIST, count)]
        owner = number[np.repeat(count <= SHORT_LIST, count)]
        own_first = np.r_[True, owner[1:] != owner[:-1]][: len(owner)]
        a, b = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
        for step in range(1, SHORT_LIST):
            at = np.flatnonzero((owner[:-step] == owner[step:]) & ~own_first[:-step]) if step < len(owner) else []
            if not len(at):
                break
            at = at[_alike(short[at], short[at + step], percent)]
            a.append(short["group"][at])
            b.append(short["group"][at + step])
        others = _distinct_pairs(a, b)
        long = np.repeat(count > SHORT_LIST, count)
        members = (every["token"][long], every["group"][long])
        kind = np.repeat(np.arange(3, dtype=np.int32), [len(hubs[0]), len(others[0]), len(members[0])])
        return pd.DataFrame({
            "kind": kind, "a": np.concatenate((hubs[0], others[0], members[0])).view(np.int64),
            "b": np.concatenate((hubs[1], others[1], members[1])).view(np.int64)})

    return run


def _several(every: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Only the postings whose token has two groups or more, their counts, and their list's number."""
    keep = np.repeat(count >= 2, count)
    count = count[count >= 2]
    return every[keep], count, np.repeat(np.arange(len(count)), count)


def _room(one: np.ndarray, two: np.ndarray, sizes: np.ndarray, percent: int) -> np.ndarray:
    """Whether bit maps leave room for enough overlap of sets with these summed sizes."""
    apart = np.bitwise_count(one ^ two).sum(1, dtype=np.int64)
    return (sizes - apart) * (100 + percent) >= 2 * percent * sizes


def _possible(classes: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs whose bit maps leave room for enough overlap."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            one, two = (utf8(batch.column(c))[0].reshape(batch.num_rows, -1) for c in ("x", "y"))
            sizes = batch.column("n").to_numpy() + batch.column("m").to_numpy()
            yield batch.select(["a", "b"]).filter(pa.array(_room(one, two, sizes, percent)))

    one = classes.select(F.col("set_key").alias("a"), F.col("n").alias("n"), F.col("map").alias("x"))
    two = classes.select(F.col("set_key").alias("b"), F.col("n").alias("m"), F.col("map").alias("y"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "n", "m", "x", "y").mapInArrow(handing_back(compare), "a long, b long")


def _verified(docs: DataFrame, classes: DataFrame, pairs: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs of classes (``a``, ``b``) whose whole sets are alike enough."""
    pairs = materialised(_possible(classes, pairs, percent))
    ends = pairs.select(F.col("a").alias("set_key")).union(pairs.select("b")).distinct()
    wanted = materialised(classes.join(ends, "set_key").select("rep", "set_key"))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, limit=SMALL_BLOCK_BYTES):
            row, token = _sets(batch, n)
            size = np.bincount(row, minlength=batch.num_rows)
            parts = np.split(token, np.cumsum(size)[:-1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(_set_keys(row, token, size).view(np.int64)), pa.array([p.tobytes() for p in parts], pa.binary())], ["set_key", "members"])

    # Rows of one doc_id may have several sets, of which only the wanted ones stay.
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text") \
        .join(wanted.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi").select("text")
    found = found.mapInArrow(handing_back(sets), "set_key long, members binary").join(wanted.select("set_key"), "set_key", "left_semi")
    found = materialised(found.dropDuplicates(["set_key"]))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                one, two = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = len(one) + len(two) - len(np.union1d(one, two))
                keep.append(100 * both >= percent * (len(one) + len(two) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = pairs.join(found.select(F.col("set_key").alias("a"), F.col("members").alias("x")), "a")
    both = left.join(found.select(F.col("set_key").alias("b"), F.col("members").alias("y")), "b")
    return both.select("a", "b", "x", "y").mapInArrow(handing_back(compare), "a long, b long")


def _ordered(a: Column, b: Column) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _earlier(members: DataFrame) -> DataFrame:
    """Members of lists with the lists before theirs that hold their group as well."""
    lists = members.select("group_key", "list").distinct().groupBy("group_key").agg(F.collect_list("list").alias("lists"))
    return members.join(lists, "group_key").withColumn("lists", F.filter("lists", lambda x: x < F.col("list")))


def _chunked(members: DataFrame, sizes: DataFrame) -> DataFrame:
    """Members of lists dealt into chunks, once for every chunk that theirs has to meet."""
    rows = members.join(sizes.select("list", F.ceil(F.col("members") / CHUNK).alias("chunks")), "list")
    rows = rows.withColumn("chunk", F.expr("pmod(xxhash64(set_key), chunks)"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    return rows.select(
        "list", "set_key", "n", "map", "component", "lists", "chunk",
        F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"))


def _cross(percent: int):
    """Of two chunks of a list: the pairs of different components that may link and share no earlier list."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["n", "set_key"])
        key, size, own, chunk = (group[c].to_numpy() for c in ("set_key", "n", "component", "chunk"))
        apart = group["low"].iat[0] != group["high"].iat[0]
        maps = np.frombuffer(b"".join(group["map"]), np.uint64).reshape(len(key), -1)
        count = group["lists"].str.len().to_numpy()
        every = np.concatenate([np.asarray(x, np.int64) for x in group["lists"]])
        names, place = np.unique(every, return_inverse=True)
        shared = np.zeros((len(key), len(names)), bool)
        shared[np.repeat(np.arange(len(key)), count), place] = True
        shared = np.packbits(shared, axis=1)
        a, b = [], []
        for i in range(len(key)):  # partners are the next larger sets, up to the size limit
            last = np.searchsorted(size, size[i] * 100 // percent, "right")
            fresh = own[i + 1 : last] != own[i]
            if apart:
                fresh &= chunk[i + 1 : last] != chunk[i]
            near = np.arange(i + 1, last)[fresh]
            near = near[~(shared[i] & shared[near]).any(1)]
            near = near[_room(maps[i], maps[near], size[i] + size[near], percent)]
            a.append(np.full(len(near), key[i]))
            b.append(key[near])
        a, b = np.concatenate(a), np.concatenate(b)
        return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return run


def _shared_ids(keyed: DataFrame) -> DataFrame:
    """Links between the different sets of one ``doc_id``."""
    rows = keyed.where("n > 0 AND doc_id IS NOT NULL").select("doc_id", "set_key")
    several = rows.groupBy("doc_id").agg(F.min("set_key").alias("a"), F.max("set_key").alias("high")).where("a < high")
    return rows.join(several, "doc_id").where("set_key <> a").select("a", F.col("set_key").alias("b")).distinct()


def jaccard_components(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id`` per row of ``docs`` (``doc_id``, ``text``), exactly.

    Two documents link when ``100 * |A & B| >= percent * |A | B|`` for their sets of distinct ``n``-word
    shingles; ``component_id`` is the smallest ``doc_id`` reachable by links, itself included. Null and
    empty texts and texts without words have empty sets and link with nothing; a text of fewer than ``n``
    words is one shingle. Rows of one ``doc_id`` are one document that links if any of them does; of these, rows
    without words stay alone. A null ``doc_id`` links with nothing and has a null component. Other columns are not looked at; an empty
    table gives no rows. Texts are read whole, and no pair is left out for the length of a list.
    """
    text_batches(docs.sparkSession)
    prepared = stored(_prefixes(docs, n, percent, shingle_counts(docs, n)), "prefixes", "kind")
    keyed = prepared.where("kind = 0").select("doc_id", "n", "group_key", "set_key")
    classes = materialised(
        prepared.where("kind = 0 AND n > 0 AND doc_id IS NOT NULL").groupBy("group_key", "set_key", "n")
        .agg(F.min("doc_id").alias("rep"), F.count("*").alias("docs"), F.first("blob").alias("map")))
    lists = materialised(
        prepared.where("kind = 1").select("bucket", "blob").groupBy("bucket").applyInPandas(_lists(percent), "kind int, a long, b long"))
    hub_pairs = lists.where("kind = 0").select("a", "b").distinct()
    other_pairs = lists.where("kind = 1").select("a", "b").distinct()

    # Round one: the most copied class of a group against the group's others, and those of hub pairs.
    best = classes.groupBy("group_key").agg(
        F.max_by("set_key", F.struct("docs", "set_key")).alias("hub"), F.count("*").alias("classes"))
    inside = classes.join(best.where("classes > 1"), "group_key").where("set_key <> hub").select(*_ordered(F.col("hub"), F.col("set_key")))
    one, two = best.select(F.col("group_key").alias("a"), F.col("hub").alias("x")), best.select(F.col("group_key").alias("b"), F.col("hub").alias("y"))
    across = hub_pairs.join(one, "a").join(two, "b").select(*_ordered(F.col("x"), F.col("y")))
    tested = materialised(inside.union(across).where("a <> b").distinct())
    links = materialised(_verified(docs, classes, tested, n, percent).union(_shared_ids(keyed)))
    placed = classes.join(components(links).withColumnRenamed("id", "set_key"), "set_key", "left") \
        .select("group_key", "set_key", "n", "map", F.coalesce("component", "set_key").alias("component"))
    placed = materialised(placed)

    # Round two: what may still link classes of different components.
    members = (
        lists.where("kind = 2").select(F.col("a").alias("list"), F.col("b").alias("group_key"))
        .union(best.where("classes > 1").select(F.col("group_key").alias("list"), "group_key"))
        .join(placed, "group_key"))
    open_lists = members.groupBy("list").agg(
        F.min("component").alias("first"), F.max("component").alias("last"), F.count("*").alias("members")).where("first < last")
    open_members = _earlier(members.join(open_lists.select("list"), "list", "left_semi"))
    again = _chunked(open_members, open_lists).groupBy("list", "low", "high").applyInPandas(_cross(percent), "a long, b long")
    # Pairs of groups stand for the pairs of all their classes.
    x, y = (placed.select(F.col("group_key").alias(g), F.col("set_key").alias(r), F.col("component").alias(c))
            for g, r, c in (("a", "x", "p"), ("b", "y", "q")))
    rest = hub_pairs.union(other_pairs).join(x, "a").join(y, "b").where("p <> q").select(*_ordered(F.col("x"), F.col("y")))
    untested = materialised(again.union(rest).distinct().join(tested, ["a", "b"], "left_anti"))
    found = components(links.union(_verified(docs, classes, untested, n, percent))).withColumnRenamed("id", "set_key")
    final = classes.join(found, "set_key", "left").select("set_key", "rep", F.coalesce("component", "set_key").alias("component"))
    owner = final.join(final.groupBy("component").agg(F.min("rep").alias("least")), "component").select("set_key", "least")
    joined = keyed.join(owner, "set_key", "left")
    return joined.select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("least", "doc_id")).alias("component_id"))
