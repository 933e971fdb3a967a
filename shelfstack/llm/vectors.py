"""Near-duplicate vectors by a robust-pruned flat graph.

Equal vectors are one class first. Classes go to the shards of their nearest centres (several each, so
shards overlap; centres are fitted on a bounded sample), where every vector gets its nearest neighbours,
pruned so that no kept neighbour is much nearer to another one than to the vector, and a few far edges.
The adjacency lists of all shards are united. Then every vector is searched for in its shards: greedily
from medoids over the united graph, expanding the best candidates and everything near the range until
nothing new comes up. Hits are verified in double precision. A sample of vectors is audited against
brute force over all vectors, each link between two classes counting once; below the wanted recall the graph
is built again with more overlap, and where links are too rare for an audit until more overlap brings no more.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfstack.llm.components import components
from shelfstack.llm.storage import materialised

RANGE = 0.95
OVERLAP = 4  # shards per vector at first
SHARD = 1000  # vectors with their nearest centre in one shard, about
SAMPLE_VALUES = 2_000_000  # numbers in the sample that centres are fitted on; at least four vectors to a centre
AUDIT = 200  # vectors compared with all others at first
AUDIT_LINKS = 400  # links between classes that an audit needs; it is widened until it has them
AUDIT_MOST = 3200  # vectors in the widest audit; with too few links there the recall is unknown
RECALL = 0.99  # wanted in the audit
_POOL, _DEGREE, _FAR = 40, 16, 4
_ALPHA = 1.2
_BEAM = 32
_ENTRIES = 32
_SLACK = 0.1  # candidates this far below the range are expanded as well
_UNSEEN = np.float32(-2)


def _unit(x: np.ndarray) -> np.ndarray:
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)


def _matrix(column) -> np.ndarray:
    return np.array([np.asarray(v, np.float64) for v in column], np.float64).reshape(len(column), -1)


def _centres(sample: np.ndarray, count: int) -> np.ndarray:
    """Spherical k-means from sample points, which are dense where vectors are, so that shards stay alike in size."""
    rng = np.random.default_rng(11)
    points = _unit(sample)
    centres = points[rng.permutation(len(points))[:count]].copy()
    for _ in range(6):
        own = np.concatenate([(points[i : i + 2048] @ centres.T).argmax(1) for i in range(0, len(points), 2048)])
        total = np.zeros_like(centres)
        np.add.at(total, own, points)
        norm = np.linalg.norm(total, axis=1, keepdims=True)
        centres = np.where(norm > 1e-9, total / np.maximum(norm, 1e-9), centres)
    return centres.astype(np.float32)


def pruned_graph(v: np.ndarray) -> np.ndarray:
    """Neighbours of every unit vector in ``v``, a row each, -1 behind the last."""
    n = len(v)
    pool = min(_POOL, n - 1)
    out = np.full((n, _DEGREE + _FAR), -1, np.int64)
    if pool < 1:
        return out
    rng = np.random.default_rng(n)
    out[:, _DEGREE:] = rng.integers(0, n, (n, _FAR))
    for a in range(0, n, 256):
        like = v[a : a + 256] @ v.T
        rows = np.arange(len(like))
        like[rows, a + rows] = _UNSEEN
        near = np.argpartition(-like, pool - 1, axis=1)[:, :pool]
        near = np.take_along_axis(near, np.argsort(-np.take_along_axis(like, near, 1), axis=1, kind="stable"), 1)
        own = np.sqrt(np.maximum(2 - 2 * np.take_along_axis(like, near, 1), 0))
        among = np.sqrt(np.maximum(2 - 2 * np.einsum("ijk,ilk->ijl", v[near], v[near]), 0))
        alive = np.ones(near.shape, bool)
        for k in range(_DEGREE):
            some = alive.any(1)
            pick = alive.argmax(1)
            out[a + rows[some], k] = near[rows[some], pick[some]]
            alive &= _ALPHA * among[rows, pick] > own
            alive[rows, pick] = False
    return out


def range_search(v: np.ndarray, graph: np.ndarray, entries: np.ndarray, queries: np.ndarray, limit: float) -> np.ndarray:
    """Similarities of ``queries`` (rows of ``v``) to the vectors that the search comes by, ``_UNSEEN`` elsewhere."""
    n, q = len(v), v[queries]
    like = np.full((len(queries), n), _UNSEEN, np.float32)
    like[:, entries] = q @ v[entries].T
    done = np.zeros(like.shape, bool)
    beam = max(0, n - _BEAM)
    while True:
        least = np.partition(like, beam, axis=1)[:, beam]
        front = (like > _UNSEEN) & ~done & (like >= np.minimum(least, limit - _SLACK)[:, None])
        who, node = np.nonzero(front)
        if not len(who):
            return like
        done[who, node] = True
        for a in range(0, len(who), 20_000):
            next_ = graph[node[a : a + 20_000]]
            key = (who[a : a + 20_000, None] * n + next_)[next_ >= 0]
            key = key[like.ravel()[key] == _UNSEEN]
            who_new, new = np.divmod(np.unique(key), n)
            like[who_new, new] = np.einsum("ij,ij->i", q[who_new], v[new])


def _medoids(v: np.ndarray) -> np.ndarray:
    """The vector nearest to the mean, and others each far from those before."""
    chosen = [int((v @ v.mean(0)).argmax())]
    near = v @ v[chosen[0]]
    while len(chosen) < min(_ENTRIES, len(v)):
        chosen.append(int(near.argmin()))
        near = np.maximum(near, v @ v[chosen[-1]])
    return np.array(chosen)


def _edges(group: pd.DataFrame) -> pd.DataFrame:
    v, rep = _unit(_matrix(group["vector"])), group["rep"].to_numpy()
    graph = pruned_graph(v)
    one, k = np.nonzero(graph >= 0)
    two = graph[one, k]
    apart = one != two
    one, two = rep[one[apart]], rep[two[apart]]
    pairs = np.unique(np.stack([np.r_[one, two], np.r_[two, one]]), axis=1)  # edges go both ways
    own, first = np.unique(pairs[0], return_index=True)
    lists = np.split(pairs[1], first[1:]) if len(own) else []
    return pd.DataFrame({"rep": own, "to": pd.Series(lists, dtype=object)})


def _hits(limit: float):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("rep", kind="stable")
        raw, rep, members = _matrix(group["vector"]), group["rep"].to_numpy(), group["members"].to_numpy()
        here, shards = int(group["shard"].iloc[0]), np.array(group["shards"].tolist())
        v, norm = _unit(raw), np.linalg.norm(raw, axis=1)
        lists = [np.asarray(x, np.int64) for x in group["to"]]
        place = np.searchsorted(rep, np.concatenate(lists)) if lists else np.zeros(0, np.int64)
        flat = np.concatenate(lists)
        place = np.minimum(place, len(rep) - 1)
        local = np.where(rep[place] == flat, place, -1)
        width = np.array([len(x) for x in lists])
        graph = np.full((len(rep), max(1, width.max())), -1, np.int64)
        graph[np.repeat(np.arange(len(rep)), width), np.arange(len(flat)) - np.repeat(np.cumsum(width) - width, width)] = local
        entries = _medoids(v)
        links, low = np.zeros(len(rep), np.int64), np.arange(len(rep))
        found = []
        for a in range(0, len(rep), 256):
            queries = np.arange(a, min(a + 256, len(rep)))
            one, two = np.nonzero(range_search(v, graph, entries, queries, limit) >= limit - 1e-3)
            one = queries[one]
            one, two = one[one != two], two[one != two]
            for b in range(0, len(one), 50_000):
                x, y = one[b : b + 50_000], two[b : b + 50_000]
                fine = np.einsum("ij,ij->i", raw[x], raw[y]) / (norm[x] * norm[y]) >= limit
                found.append(np.stack([x[fine], y[fine]]))
        pairs = np.concatenate(found, 1) if found else np.zeros((2, 0), np.int64)
        pairs = np.unique(np.concatenate((pairs, pairs[::-1]), 1), axis=1)
        x, y = pairs
        # A pair that meets in several shards counts in the first of them.
        both = (shards[x][:, :, None] == shards[y][:, None, :]).any(2)
        first = np.where(both, shards[x], np.iinfo(np.int64).max).min(1, initial=np.iinfo(np.int64).max)
        mine = first == here
        np.add.at(links, x[mine], members[y[mine]])
        near = np.bincount(x[mine], minlength=len(rep))
        while True:  # the smallest index reachable within the shard
            before = low.copy()
            np.minimum.at(low, x, low[y])
            low = low[low]
            if (low == before).all():
                break
        return pd.DataFrame({"rep": rep, "links": links, "near": near, "low": rep[low]})

    return run


def _search(classes: DataFrame, centres: np.ndarray, overlap: int, limit: float) -> DataFrame:
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 1024):
                part = batch.slice(a, 1024)
                like = _unit(_matrix(part.column("vector").to_pylist())) @ centres.T
                top = np.sort(np.argpartition(-like, min(overlap, like.shape[1]) - 1, axis=1)[:, :overlap], axis=1)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(top.tolist(), pa.list_(pa.int64()))], [*part.schema.names, "shards"])

    kind = "rep long, members long, vector array<double>, shards array<long>"
    placed = materialised(classes.select("rep", "members", "vector").mapInArrow(assign, kind))
    spread = placed.select(F.explode("shards").alias("shard"), "rep", "vector")
    graph = spread.groupBy("shard").applyInPandas(_edges, "rep long, to array<long>")
    united = graph.groupBy("rep").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("to")))).alias("to"))
    nodes = placed.join(united, "rep", "left").withColumn("to", F.coalesce("to", F.array().cast("array<long>")))
    spread = nodes.select(F.explode("shards").alias("shard"), "rep", "members", "vector", "shards", "to")
    return materialised(spread.groupBy("shard").applyInPandas(_hits(limit), "rep long, links long, near long, low long"))


def _audited(classes: DataFrame, found: DataFrame, count: int, limit: float) -> float | None:
    """The share of the links between classes that the search has found, over a sample; None if it has too few.

    How many vectors a class holds does not count, so that large groups of copies do not hide the others.
    """
    wanted = AUDIT
    while True:
        whole = wanted >= count
        draw = F.pmod(F.xxhash64("rep", F.lit("audit")), F.lit(1 << 30)) < F.lit(int((1 << 30) * min(1.0, wanted / max(count, 1))))
        sample = classes.where(draw).select("rep", "vector").collect()
        rep = np.array([r.rep for r in sample])
        true = _true_links(classes, rep, _matrix([r.vector for r in sample]), limit) if sample else 0
        if whole or true >= AUDIT_LINKS or wanted >= AUDIT_MOST:
            break
        wanted *= 4
    if not whole and true < AUDIT_LINKS:
        return None
    got = found.where(F.col("rep").isin(rep.tolist())).agg(F.sum("near")).first()[0] or 0
    return min(1.0, got / true) if true else 1.0


def _true_links(classes: DataFrame, rep: np.ndarray, asked: np.ndarray, limit: float) -> int:
    def count_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, norm = 0, np.linalg.norm(asked, axis=1)[:, None]
        for batch in batches:
            for a in range(0, batch.num_rows, 1024):
                part = batch.slice(a, 1024)
                v = _matrix(part.column("vector").to_pylist())
                hit = asked @ v.T / (norm * np.linalg.norm(v, axis=1)[None]) >= limit
                total += int((hit & (rep[:, None] != part.column("rep").to_numpy()[None])).sum())
        yield pa.RecordBatch.from_pydict({"links": [total]})

    return classes.select("rep", "vector").mapInArrow(count_links, "links long").agg(F.sum("links")).first()[0] or 0


def near_vectors(vectors: DataFrame, limit: float = RANGE) -> DataFrame:
    """``vec_id, n_links, component_id, kept, audited_recall`` for every row (``vec_id``, ``embedding``).

    Two vectors link when their cosine, in double precision, is at least ``limit``. Vectors that are null,
    empty or zero, or hold null or non-finite components, link with nothing, and vectors of different
    lengths do not link. A ``vec_id`` stands for one vector; rows that repeat it count as others; a null ``vec_id`` takes no part and
    has a null component. ``component_id`` is the smallest ``vec_id`` reachable and ``kept`` tells whether it
    is the row's own. ``audited_recall`` is null where links are too rare to audit. Labels and other columns are not looked at; an empty table gives no rows.
    """
    usable = (
        F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()
        & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
        & F.exists("embedding", lambda x: x != 0))
    wide = F.transform("embedding", lambda x: x.cast("double"))
    keyed = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), wide.alias("vector"), F.coalesce(usable, F.lit(False)).alias("usable"))
    keyed = keyed.withColumns({"h": F.xxhash64("vector"), "g": F.xxhash64(F.lit(1), "vector")})
    every = materialised(keyed.where("usable").groupBy("h", "g").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("members"), F.first("vector").alias("vector")))
    results, recalls = [], []
    for (length,) in every.select(F.size("vector")).distinct().orderBy(F.size("vector")).collect():
        found, recall = _of_length(every.where(F.size("vector") == length), length, limit)
        results.append(found)
        recalls.append(recall)
    if not results:
        return _rows(keyed.withColumns({"n_links": F.lit(0).cast("long"), "component_id": F.col("vec_id")}), 1.0)
    found = results[0]
    for more in results[1:]:
        found = found.union(more)
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    joined = components(found.select(F.col("rep").alias("a"), F.col("low").alias("b")))
    classes = every.select("h", "g", "rep", "members").join(links, "rep", "left").join(joined.withColumnRenamed("id", "rep"), "rep", "left")
    rows = keyed.select("vec_id", "usable", "h", "g").join(classes, ["h", "g"], "left")
    links_of = F.when(F.col("usable"), F.coalesce("links", F.lit(0)) + F.col("members") - 1).otherwise(0)
    component = F.when(F.col("usable"), F.coalesce("component", "rep")).otherwise(F.col("vec_id"))
    return _rows(rows.select("vec_id", links_of.cast("long").alias("n_links"), component.alias("component_id")), None if None in recalls else min(recalls))


def _rows(found: DataFrame, recall: float | None) -> DataFrame:
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    return found.select("vec_id", "n_links", "component_id", kept.alias("kept"), F.lit(recall).cast("double").alias("audited_recall"))


def _of_length(classes: DataFrame, length: int, limit: float) -> tuple[DataFrame, float | None]:
    count = classes.count()
    size = max(64, SAMPLE_VALUES // length)
    share = F.lit(int((1 << 30) * min(1.0, size / count)))
    sample = classes.where(F.pmod(F.xxhash64("rep", F.lit("centres")), F.lit(1 << 30)) < share).select("rep", "vector").collect()
    sample.sort(key=lambda r: (r.rep, r.vector))
    sample = sample or classes.select("rep", "vector").limit(1).collect()
    centres = _centres(_matrix([r.vector for r in sample]), max(1, min(-(-count // SHARD), len(sample) // 4)))
    overlap = min(OVERLAP, len(centres))
    before = None
    while True:
        found = _search(classes, centres, overlap, limit)
        recall = _audited(classes, found, count, limit)
        if overlap == len(centres) or recall is not None and recall >= RECALL:
            return found, recall
        if recall is None:
            near = found.agg(F.sum("near")).first()[0] or 0
            if before is not None and before >= RECALL * near:
                return found, None
            before = near
        overlap = min(2 * overlap, len(centres))
