"""How sources of one language differ in their terms, counted through a minimal acyclic transducer.

The terms that enough documents of a language hold are sorted as byte keys (the language, then the term) and
compiled to minimal acyclic transducers: equal suffixes share their states, and the sum of the outputs along a
path is the term's place in the sorted list, its ordinal. Texts are then streamed through the transducer to be
counted again, now by ordinal and source. Ordinals follow the terms' UTF-8 order, so they break ties, and the
terms of a result are spelled from their ordinals.

A vocabulary larger than a task should hold is built in shards of consecutive keys, and counted in rounds of as
many shards as ``ROUND_BYTES`` takes. Shares are whole numbers worked out with decimals of 38 digits.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from os.path import commonprefix

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfstack.llm.storage import materialised, stored, text_batches
from shelfstack.llm.texts import blocks, utf8

# Which terms are kept, how shares are smoothed and scaled, and how many terms are reported.
LEAST_DOCUMENTS = 30
SMOOTHING = 5
SCALE = 1_000_000_000
MOST_TERMS = 50

SHARD_BYTES = 2 << 20  # of keys, compiled by one task
ROUND_BYTES = 64 << 20  # of compiled shards, sent to every task
ENTRIES = 1 << 20  # counts a task holds before it passes them on
SLICE = 4096  # ordinals compared at a time
SOURCES = 256  # sources compared with each other at a time

_TERM = np.zeros(256, bool)
_TERM[65:91] = _TERM[97:123] = _TERM[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def terms(column: pa.Array) -> tuple[np.ndarray, pa.DictionaryArray]:
    """The row of every term of a text column, and the terms, A-Z lower-cased."""
    data, offsets = utf8(column)
    inside = _TERM[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    first[edges] = inside[edges]
    at = np.flatnonzero(first)
    bounds = np.r_[np.cumsum(inside)[at] - 1, inside.sum()].astype(np.int64)
    flat = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(at), [None, pa.py_buffer(bounds), pa.py_buffer(_LOWER[data[inside]])])
    return np.searchsorted(offsets, at, "right") - 1, flat.dictionary_encode()


def document_counts(docs: DataFrame) -> DataFrame:
    """In how many rows each term occurs, per ``lang``: ``lang, term, docs`` (``docs`` has ``lang`` and ``text``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches):
            row, found = terms(batch.column("text"))
            lang = batch.column("lang").dictionary_encode()
            width = max(1, len(found.dictionary))
            once = np.unique(row * width + found.indices.to_numpy())
            code = lang.indices.to_numpy().astype(np.int64)[once // width]
            pair, n = np.unique(code * width + once % width, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [lang.dictionary.take(pa.array(pair // width)), found.dictionary.take(pa.array(pair % width)).cast(pa.binary()).cast(pa.string()),
                 pa.array(n)], ["lang", "term", "docs"])

    counted = docs.select("lang", "text").mapInArrow(run, "lang string, term string, docs long")
    return counted.groupBy("lang", "term").agg(F.sum("docs").alias("docs"))


def _escaped(lang: Column) -> Column:
    """A language as bytes that sort alike and end in a mark of their own, so that keys sort by language, then term."""
    return F.concat(F.replace(lang, F.lit("\0"), F.lit("\0\1")), F.lit("\0\0"))


@dataclass(frozen=True)
class Transducer:
    """Minimal acyclic transducers of consecutive runs of keys, their states numbered through."""

    arc: np.ndarray  # state << 8 | byte, ascending
    target: np.ndarray
    skip: np.ndarray  # keys passed over by taking the arc: the state's own, and those of its earlier arcs
    final: np.ndarray
    keys: tuple[bytes, ...]  # the first key of every run
    root: np.ndarray
    base: np.ndarray  # the ordinal of every run's first key

    def ordinals(self, keys: pa.Array) -> np.ndarray:
        """The ordinal of every key, -1 for those that are not in it. All keys take their steps together."""
        data, offsets = utf8(keys)
        at, end = offsets[:-1].copy(), offsets[1:]
        if len(self.keys) > 1:
            run = np.array([bisect_right(self.keys, k) - 1 for k in keys.to_pylist()], np.int64)
        else:
            run = np.zeros(len(keys), np.int64)
        out = np.full(len(keys), -1, np.int64)
        alive = np.flatnonzero(run >= 0) if len(self.keys) else np.zeros(0, np.int64)
        state, ordinal = self.root[run], self.base[run]
        while len(alive):
            done = at[alive] == end[alive]
            stopped = alive[done]
            accepted = stopped[self.final[state[stopped]]]
            out[accepted] = ordinal[accepted]
            alive = alive[~done]
            step = state[alive] << 8 | data[at[alive]]
            arc = np.minimum(np.searchsorted(self.arc, step), len(self.arc) - 1)
            leads = self.arc[arc] == step
            alive, arc = alive[leads], arc[leads]
            ordinal[alive] += self.skip[arc]
            state[alive] = self.target[arc]
            at[alive] += 1
        return out

    def spell(self, ordinal: int) -> bytes:
        """The key of an ordinal."""
        run = int(np.searchsorted(self.base, ordinal, "right")) - 1
        state, rest, out = int(self.root[run]), ordinal - int(self.base[run]), bytearray()
        while not (self.final[state] and rest == 0):
            first, last = np.searchsorted(self.arc, [state << 8, state + 1 << 8])
            arc = first + int(np.searchsorted(self.skip[first:last], rest, "right")) - 1
            out.append(int(self.arc[arc]) & 255)
            rest -= int(self.skip[arc])
            state = int(self.target[arc])
        return bytes(out)


def compiled(keys: Iterable[bytes]) -> dict[str, object]:
    """One run of ascending, distinct keys as a minimal transducer.

    Only the states of the last key are open. What the next key leaves behind is closed from the end: a state
    that equals a known one in finality and arcs is replaced by it, so none is ever there twice.
    """
    known: dict[tuple, int] = {}
    arc, target, skip, final, words = [], [], [], [], []

    def close(ends: bool, arcs: list[tuple[int, int]]) -> int:
        form = (ends, *arcs)
        if form not in known:
            known[form] = state = len(final)
            total = int(ends)
            for byte, to in arcs:
                arc.append(state << 8 | byte)
                target.append(to)
                skip.append(total)
                total += words[to]
            final.append(ends)
            words.append(total)
        return known[form]

    opened: list[list] = [[False, []]]  # per byte of the last key: whether a key ends there, and the closed arcs
    last, least, count = b"", b"", 0

    def close_to(depth: int) -> None:
        while len(opened) > depth + 1:
            ends, arcs = opened.pop()
            opened[-1][1].append((last[len(opened) - 1], close(ends, arcs)))

    for key in keys:
        least = key if not count else least
        shared = len(commonprefix([last, key]))
        close_to(shared)
        last = key
        opened.extend([False, []] for _ in key[shared:])
        opened[-1][0] = True
        count += 1
    close_to(0)
    root = close(*opened[0])
    return {
        "least": least, "count": count, "root": root, "arc": np.array(arc, np.int64).tobytes(), "target": np.array(target, np.int64).tobytes(),
        "skip": np.array(skip, np.int64).tobytes(), "final": np.array(final, bool).tobytes()}


def _joined(shards: list) -> Transducer:
    """Compiled shards, in the order of their keys, as one transducer."""
    parts, states = {name: [] for name in ("arc", "target", "skip", "final", "root")}, 0
    for s in shards:
        final = np.frombuffer(s["final"], bool)
        parts["arc"].append(np.frombuffer(s["arc"], np.int64) + (states << 8))
        parts["target"].append(np.frombuffer(s["target"], np.int64) + states)
        parts["skip"].append(np.frombuffer(s["skip"], np.int64))
        parts["final"].append(final)
        parts["root"].append([s["root"] + states])
        states += len(final)
    joined = {name: np.concatenate(p) if p else np.zeros(0, np.int64) for name, p in parts.items()}
    return Transducer(**joined, keys=tuple(bytes(s["least"]) for s in shards), base=np.array([s["base"] for s in shards], np.int64))


def compile_vocabulary(kept: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """A written table of compiled shards of ``kept`` (``key`` binary, distinct), with the ``base`` of each.

    One row per shard: its size follows ``shard_bytes``, and only its own task holds its keys.
    """
    size = kept.agg(F.coalesce(F.sum(F.length("key")), F.lit(0))).first()[0]
    ranged = kept.select("key").repartitionByRange(max(1, -(-size // shard_bytes)), "key").sortWithinPartitions("key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = compiled(k for batch in batches for k in batch.column("key").to_pylist())
        if made["count"]:
            yield pa.RecordBatch.from_pylist([made], schema=_SHARD)

    shards = stored(ranged.mapInArrow(
        run, "least binary, count long, root long, arc binary, target binary, skip binary, final binary"), "vocabulary")
    earlier = Window.orderBy("least").rowsBetween(Window.unboundedPreceding, -1)
    # The window is over one row per shard, without the arrays.
    bases = shards.select("least", "count").withColumn("base", F.coalesce(F.sum("count").over(earlier), F.lit(0)))
    return shards.join(bases.drop("count"), "least")


_SHARD = pa.schema([
    ("least", pa.binary()), ("count", pa.int64()), ("root", pa.int64()), ("arc", pa.binary()), ("target", pa.binary()),
    ("skip", pa.binary()), ("final", pa.binary())])


def rounds(shards: DataFrame, round_bytes: int = ROUND_BYTES) -> Iterator[tuple[Transducer, int, int]]:
    """The shards as transducers of at most ``round_bytes`` (or one shard), with the range of ordinals of each."""
    size = F.length("arc") + F.length("target") + F.length("skip") + F.length("final")
    sizes = shards.select("base", "count", size.alias("bytes")).orderBy("base").collect()  # a row per shard
    start = 0
    while start < len(sizes):
        stop, held = start + 1, sizes[start]["bytes"]
        while stop < len(sizes) and held + sizes[stop]["bytes"] <= round_bytes:
            held += sizes[stop]["bytes"]
            stop += 1
        low, high = sizes[start]["base"], sizes[stop - 1]["base"] + sizes[stop - 1]["count"]
        yield _joined(shards.where((F.col("base") >= low) & (F.col("base") < high)).orderBy("base").collect()), low, high
        start = stop


def recounted(docs: DataFrame, machine: Transducer) -> DataFrame:
    """How often the transducer's terms occur per ``lang`` and ``source``: ``lang, source, ordinal, n``.

    A task streams its texts through the transducer, sums what it finds and passes the sums on when it holds
    ``ENTRIES``; one key can be in several rows.
    """
    source = docs.select("lang", "source", "text", _escaped(F.col("lang")).cast("binary").alias("prefix"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple[str, str], int] = {}
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def summed() -> tuple[np.ndarray, np.ndarray]:
            key, inverse = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
            n = np.zeros(len(key), np.int64)
            np.add.at(n, inverse, np.concatenate([c for _, c in held]))
            return key, n

        def passed_on() -> Iterator[pa.RecordBatch]:
            key, n = summed()
            names = list(groups)
            for a in range(0, len(key), 1 << 16):
                group = pa.array(key[a : a + (1 << 16)] >> 40)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([g[0] for g in names]).take(group), pa.array([g[1] for g in names]).take(group),
                     pa.array(key[a : a + (1 << 16)] & (1 << 40) - 1), pa.array(n[a : a + (1 << 16)])], ["lang", "source", "ordinal", "n"])

        for batch in blocks(batches):
            row, found = terms(batch.column("text"))
            if not len(row):
                continue
            prefix = batch.column("prefix").dictionary_encode()
            width = len(found.dictionary)
            code = prefix.indices.to_numpy().astype(np.int64)[row] * width + found.indices.to_numpy()
            pair, inverse = np.unique(code, return_inverse=True)
            keys = pc.binary_join_element_wise(
                prefix.dictionary.cast(pa.large_binary()).take(pa.array(pair // width)), found.dictionary.take(pa.array(pair % width)),
                pa.scalar(b"", pa.large_binary()))
            ordinal = machine.ordinals(keys)[inverse]
            named = [groups.setdefault(g, len(groups)) for g in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist())]
            key = np.array(named, np.int64)[row] << 40 | ordinal
            held.append(np.unique(key[ordinal >= 0], return_counts=True))
            if sum(len(k) for k, _ in held) > ENTRIES or len(groups) > ENTRIES:
                held = [summed()]
                if max(len(held[0][0]), len(groups)) > ENTRIES // 2:
                    yield from passed_on()
                    groups, held = {}, []
        if held:
            yield from passed_on()

    return source.mapInArrow(run, "lang string, source string, ordinal long, n long")


def share(n: Column, total: Column, kept: Column) -> Column:
    """``1 + floor(SCALE * (n + SMOOTHING) / (total + SMOOTHING * kept))``, exactly."""
    whole = lambda c: c.cast("decimal(20,0)")
    above = whole(n + SMOOTHING) * F.lit(SCALE).cast("decimal(10,0)")
    return F.lit(1).cast("long") + F.call_function("div", above, whole(total + kept * SMOOTHING))


def divergence(docs: DataFrame, least: int = LEAST_DOCUMENTS, most: int = MOST_TERMS, shard_bytes: int = SHARD_BYTES, round_bytes: int = ROUND_BYTES) -> DataFrame:
    """``lang, source, part, item, value, rank`` for every group of ``lang`` and ``source`` in ``docs``.

    Part ``pair``: every other source of the language, by the sum of the differences of their terms' shares.
    Part ``term``: the ``most`` terms whose share in the group is most above the language's. Terms are those in
    at least ``least`` rows of the language. Ranks follow the value downwards, then the item upwards.

    Null texts, languages and sources count as empty. Every row is a document of its own, also repeated ones;
    ``doc_id`` and other columns are not looked at. A group without kept terms has pairs but no terms; in a
    language that keeps none, all pairs have the value 0. A source alone in its language has no pairs. An
    empty table gives no rows.
    """
    text_batches(docs.sparkSession)
    blank = lambda name: F.coalesce(F.col(name), F.lit("")).alias(name)
    docs = docs.select(blank("lang"), blank("source"), blank("text"))
    kept = document_counts(docs).where(F.col("docs") >= least)
    kept = stored(kept.withColumn("key", F.concat(_escaped(F.col("lang")), F.col("term")).cast("binary")), "kept")
    machines = list(rounds(compile_vocabulary(kept, shard_bytes), round_bytes))
    counts = _counts(docs, machines)
    groups = _groups(docs, kept, counts)
    return _ranked_pairs(counts, groups).unionByName(_ranked_terms(counts, groups, machines, most))


def _counts(docs: DataFrame, machines: list[tuple[Transducer, int, int]]) -> DataFrame:
    """A written table ``lang, source, ordinal, n, all_n``, where ``all_n`` counts the whole language."""
    found = docs.sparkSession.createDataFrame([], "lang string, source string, ordinal long, n long")
    for machine, low, high in machines:
        edges = [machine.spell(o).split(b"\0\0")[0].replace(b"\0\1", b"\0").decode() for o in (low, high - 1)]
        found = found.union(recounted(docs.where(F.col("lang").between(*edges)), machine))
    # Dealt by language and term at once, which serves the sums of groups and of languages.
    summed = found.repartition("lang", "ordinal").groupBy("lang", "source", "ordinal").agg(F.sum("n").alias("n"))
    whole = Window.partitionBy("lang", "ordinal")
    return stored(summed.withColumn("all_n", F.sum("n").over(whole)), "counts")


def _groups(docs: DataFrame, kept: DataFrame, counts: DataFrame) -> DataFrame:
    """Per language and source: ``total`` and ``all_total`` occurrences, ``kept`` terms, and where its ordinals lie."""
    sums = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    sizes = kept.groupBy("lang").agg(F.count("*").alias("kept"))
    first = counts.groupBy("lang").agg(F.min("ordinal").alias("first"))
    groups = docs.select("lang", "source").distinct().join(sums, ["lang", "source"], "left")
    groups = groups.join(sizes.join(first, "lang"), "lang", "left").fillna(0, ["total", "kept", "first"])
    return materialised(groups.withColumn("all_total", F.sum("total").over(Window.partitionBy("lang"))))


def _ranked(rows: DataFrame, tie: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc(tie))
    return rows.withColumn("rank", F.row_number().over(order))


def _ranked_terms(counts: DataFrame, groups: DataFrame, machines: list, most: int) -> DataFrame:
    rated = counts.join(groups, ["lang", "source"]).withColumn(
        "value", share(F.col("n"), F.col("total"), F.col("kept")) - share(F.col("all_n"), F.col("all_total"), F.col("kept")))
    top = materialised(_ranked(rated.where("value > 0"), "ordinal").where(F.col("rank") <= most).select("lang", "source", "ordinal", "value", "rank"))
    spelled = top.sparkSession.createDataFrame([], _RESULT)
    for machine, low, high in machines:
        def spell(batches: Iterator[pa.RecordBatch], machine: Transducer = machine) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                items = [machine.spell(o).split(b"\0\0", 1)[1].decode() for o in batch.column("ordinal").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("lang"), batch.column("source"), pa.array(["term"] * len(items)), pa.array(items, pa.string()),
                     batch.column("value"), batch.column("rank")], _RESULT_NAMES)

        within = top.where((F.col("ordinal") >= low) & (F.col("ordinal") < high))
        spelled = spelled.union(within.mapInArrow(spell, _RESULT))
    return spelled


_RESULT = "lang string, source string, part string, item string, value long, rank int"
_RESULT_NAMES = ["lang", "source", "part", "item", "value", "rank"]


def _ranked_pairs(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """Sums of differences between sources, worked out for ``SLICE`` ordinals and two blocks of sources at a time.

    Every slice of a language gets a row per source with the share of a term that the source lacks. Terms that
    neither block has differ by those, as often as the slice has such terms.
    """
    blocks_of = groups.groupBy("lang").agg(F.ceil(F.count("*") / SOURCES).alias("blocks"))
    groups = groups.join(blocks_of, "lang").withColumn("block", F.pmod(F.xxhash64("source"), F.col("blocks")))
    last = F.greatest(F.col("first") + F.col("kept") - 1, F.col("first"))
    of = lambda ordinal: F.floor(ordinal / SLICE).cast("long")
    absent = F.when(F.col("kept") > 0, share(F.lit(0), F.col("total"), F.col("kept"))).otherwise(F.lit(0))
    heads = groups.withColumn("slice", F.explode(F.sequence(of(F.col("first")), of(last)))).withColumn("ordinal", F.lit(-1).cast("long"))
    heads = heads.withColumn("p", absent)
    rows = counts.join(groups, ["lang", "source"]).withColumn("slice", of(F.col("ordinal"))).withColumn(
        "p", share(F.col("n"), F.col("total"), F.col("kept")))
    within = F.least(last, F.col("slice") * SLICE + SLICE - 1) - F.greatest("first", F.col("slice") * SLICE) + 1
    columns = ["lang", "source", "slice", "ordinal", "p", "block", F.when(F.col("kept") > 0, within).otherwise(0).alias("width"), "blocks"]
    dealt = rows.select(columns).union(heads.select(columns)).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    dealt = dealt.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")}).drop("other", "blocks")

    def differences(table: pa.Table) -> pa.Table:
        ordinal, p, block = (table.column(c).to_numpy() for c in ("ordinal", "p", "block"))
        source = table.column("source").combine_chunks().dictionary_encode()
        names, code = source.dictionary, source.indices.to_numpy()
        head = ordinal < 0
        absent, place = np.zeros(len(names), np.int64), np.zeros(len(names), np.int64)
        absent[code[head]], place[code[head]] = p[head], block[head]
        present, at = np.unique(ordinal[~head], return_inverse=True)
        shares = np.repeat(absent[:, None], len(present), 1)
        shares[code[~head], at] = p[~head]
        low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
        rest = table.column("width")[0].as_py() - len(present)
        pairs, value = [np.zeros((2, 0), np.int64)], [np.zeros(0, np.int64)]
        for i in np.flatnonzero(place == low):
            others = np.flatnonzero(place == high)
            others = others[others > i] if low == high else others
            pairs.append(np.stack([np.full(len(others), i), others]))
            value.append(np.abs(shares[others] - shares[i]).sum(1) + rest * np.abs(absent[others] - absent[i]))
        one, two = np.concatenate(pairs, 1)
        lang = pa.array([table.column("lang")[0].as_py()] * len(one), pa.string())
        columns = [lang, names.take(pa.array(one)), names.take(pa.array(two)), pa.array(np.concatenate(value))]
        return pa.Table.from_arrays(columns, ["lang", "one", "two", "value"])

    partial = dealt.groupBy("lang", "slice", "low", "high").applyInArrow(differences, "lang string, one string, two string, value long")
    sums = partial.groupBy("lang", F.least("one", "two").alias("one"), F.greatest("one", "two").alias("two")).agg(F.sum("value").alias("value"))
    both = sums.select("lang", F.explode(F.array(
        F.struct(F.col("one").alias("source"), F.col("two").alias("item")), F.struct(F.col("two").alias("source"), F.col("one").alias("item")),
    )).alias("pair"), "value").select("lang", "pair.*", F.lit("pair").alias("part"), "value")
    return _ranked(both, "item").select(*_RESULT_NAMES)
