"""Best-fit packing of tokenised documents by bin completion.

Lengths lie between 1 and the sequence's size, so how many pieces there are of each length is a table of
bounded size, whatever the input. The plan is made on that table: around the largest length left, the
undominated fillings of the room beside it are tried, those with the least waste first, each as often as the
counts allow; a branch ends where its waste, or a bound on the rest, rules out a plan better than the best one
known. The first such plan is best-fit decreasing. A plan is a short list of (lengths of a sequence, how
often); Spark then gives the pieces of a length, in the order of their places in the input, to the slots of
that length.

Tokens come from a public tokenizer. No token of it crosses white space, or the border of an ASCII letter with
an ASCII sign that follows it, or that comes before it and is not an apostrophe. Texts are cut there, every
distinct unit is encoded once by a task, and the ids are put together in numpy.
"""

from __future__ import annotations

import os
from bisect import bisect_right
from collections.abc import Callable, Iterator, Sequence
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfstack.llm.storage import stored, text_batches
from shelfstack.llm.texts import SPACE, blocks, utf8

MODEL = "/opt/tokenizers/word_bpe_49k.json"
SIZE = 2048
END = 0  # the id after every document
WORD_END = "</w>"  # marks the last piece of a word in the vocabulary
JOINED = 256
NODES = 8000  # fillings that the search tries
BLOCK = 2 << 20
KNOWN_UNITS = 1 << 20  # units a task remembers before it starts anew

_LETTER = np.zeros(256, bool)
_LETTER[97:123] = True
_SIGN = ~_LETTER & ~SPACE
_SIGN[128:] = False
_OPENS = _SIGN.copy()
_OPENS[39] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Encoder:
    """Token ids of whole texts; every distinct unit goes through the tokenizer once."""

    def __init__(self, model: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tokenizer = Tokenizer.from_str(model)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        words = self.tokenizer.get_vocab(with_added_tokens=False)
        self.ends_word = np.zeros(max(words.values()) + 1, bool)
        self.ends_word[[i for word, i in words.items() if word.endswith(WORD_END)]] = True
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.ids = np.zeros(0, np.uint32)
        self.start = np.zeros(1, np.int64)

    def _units(self, data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, pa.DictionaryArray]:
        """Start of every unit, and the units themselves; ``edges`` are places that no unit crosses."""
        inside = ~SPACE[data]
        first = inside.copy()
        first[1:] &= ~inside[:-1] | (_LETTER[data[:-1]] & _SIGN[data[1:]]) | (_OPENS[data[:-1]] & _LETTER[data[1:]])
        edges = edges[edges < len(data)]
        first[edges] = inside[edges]
        at = np.flatnonzero(first)
        sizes = np.diff(np.r_[np.cumsum(inside)[at] - 1, inside.sum()])
        offsets = np.r_[0, np.cumsum(sizes)].astype(np.int64)
        flat = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])])
        return at, flat.dictionary_encode()

    def _encode_units(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of units one after the other, and how many each has.

        A unit of ASCII letters is one word of the tokenizer, so many of them are encoded as one text with blanks
        between them; the ids that end words tell them apart.
        """
        plain = np.asarray(pc.match_substring_regex(units, "^[a-z]+$"))
        texts = units.cast(pa.large_string())
        words = texts.filter(pa.array(plain)).to_pylist()
        joined = [" ".join(words[i : i + JOINED]) for i in range(0, len(words), JOINED)]
        in_words = self._encode_texts(joined)[0]
        in_others, per_other = self._encode_texts(texts.filter(pa.array(~plain)).to_pylist())
        count = np.empty(len(units), np.int64)
        count[plain] = np.diff(np.flatnonzero(np.r_[True, self.ends_word[in_words]]))
        count[~plain] = per_other
        ids = np.empty(count.sum(), np.uint32)
        from_word = np.repeat(plain, count)
        ids[from_word], ids[~from_word] = in_words, in_others
        return ids, count

    def _encode_texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return np.fromiter(chain.from_iterable(found), np.uint32), np.array(list(map(len, found)), np.int64)

    def _places(self, units: pa.Array) -> np.ndarray:
        """Where each unit stands among the known ones."""
        if len(self.known) > KNOWN_UNITS:
            self._forget()
        keys = units.to_pylist()
        place = np.array(list(map(self.known.get, keys)), float)  # NaN where unknown
        new = np.flatnonzero(np.isnan(place))
        if len(new):
            ids, count = self._encode_units(units.take(pa.array(new)))
            place[new] = np.arange(len(self.known), len(self.known) + len(new))
            self.known.update((keys[i], int(place[i])) for i in new.tolist())
            self.start = np.r_[self.start, self.start[-1] + np.cumsum(count)]
            self.ids = np.concatenate([self.ids, ids])
        return place.astype(np.int64)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all rows one after the other, each row's followed by ``END``, and how many each row has."""
        rows = len(offsets) - 1
        count = np.zeros(rows, np.int64)
        found = []
        for a, b in _stretches(data):
            part = _LOWER[data[a:b]]
            low, high = np.searchsorted(offsets, [a, b])
            at, units = self._units(part, offsets[low:high] - a)
            if not len(at):
                continue
            place = self._places(units.dictionary)[units.indices.to_numpy()]
            size = self.start[place + 1] - self.start[place]
            ends = np.cumsum(size)
            shift = (self.start[place] - ends + size).astype(np.int32)
            found.append(self.ids[np.arange(ends[-1], dtype=np.int32) + np.repeat(shift, size)])
            row = np.searchsorted(offsets, at + a, "right") - 1
            count += np.bincount(row, size, rows).astype(np.int64)
        ids = np.concatenate(found) if found else np.zeros(0, np.uint32)
        return np.insert(ids, np.cumsum(count), END), count + 1


def _stretches(data: np.ndarray) -> Iterator[tuple[int, int]]:
    """Consecutive parts of about ``BLOCK`` bytes that end before white space."""
    a = 0
    while a < len(data):
        b = min(len(data), a + 2 * BLOCK)
        step = BLOCK
        while b < len(data):
            blank = np.flatnonzero(SPACE[data[b : b + step]])
            if len(blank):
                b += int(blank[0])
                break
            b, step = min(len(data), b + step), 2 * step
        yield a, b
        a = b


def pieces(docs: DataFrame, path: str = MODEL, size: int = SIZE) -> DataFrame:
    """Every row of ``docs`` as pieces of at most ``size`` ids: ``doc_id, piece, start, length, ids, part, rank``.

    ``ids`` are little-endian unsigned 32-bit numbers. ``rank`` counts the pieces of one length within the
    task ``part``; both hold for one written copy of the result.
    """
    text_batches(docs.sparkSession)
    model = Path(path).read_text(encoding="utf-8")
    source = docs.select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, seen = Encoder(model), np.zeros(size + 1, np.int64)
        part = TaskContext.get().partitionId()
        for batch in blocks(batches, limit=BLOCK):
            ids, count = encoder.encode(*utf8(batch.column("text")))
            times = -(-count // size)
            row = np.repeat(np.arange(len(count)), times)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
            length = np.minimum(size, count[row] - piece * size)
            offsets = np.r_[0, np.cumsum(length)] * 4
            order = np.argsort(length, kind="stable")
            first = np.flatnonzero(np.r_[True, np.diff(length[order]) != 0])
            runs = np.diff(np.r_[first, len(order)])
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order)) - np.repeat(first, runs) + seen[length[order]]
            seen[length[order][first]] += runs
            data = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), len(row), [None, pa.py_buffer(offsets), pa.py_buffer(ids.astype("<u4"))])
            # A few thousand pieces at a time, so that offsets of the plain type suffice.
            for a in range(0, len(row), 4096):
                cut = slice(a, a + 4096)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(row[cut])), pa.array(piece[cut].astype(np.int32)), pa.array(piece[cut] * size),
                     pa.array(length[cut]), data.slice(a, 4096).cast(pa.binary()), pa.array(np.full(len(row[cut]), part, np.int32)),
                     pa.array(rank[cut])], ["doc_id", "piece", "start", "length", "ids", "part", "rank"])

    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids binary, part int, rank long")


Plan = list[tuple[tuple[int, ...], int]]  # the lengths of a sequence, and how many sequences have them


def best_fit(counts: Sequence[int]) -> Plan:
    """Best-fit decreasing over ``counts`` (how many pieces have each length, up to the size)."""
    size = len(counts) - 1
    open_: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    rooms = 0  # bit r: some sequence has room r

    def put(room: int, lengths: tuple[int, ...], times: int) -> None:
        nonlocal rooms
        if times:
            open_.setdefault(room, []).append((lengths, times))
            rooms |= 1 << room

    for length in range(size, 0, -1):
        left = counts[length]
        while left:
            fitting = rooms >> length
            room = length + (fitting & -fitting).bit_length() - 1 if fitting else size
            if fitting:
                lengths, times = open_[room].pop()
                if not open_[room]:
                    rooms &= ~(1 << room)
            else:
                lengths, times = (), left
            fit = room // length
            full = min(times, left // fit)
            put(room - full and room - fit * length if full else room, lengths + (length,) * fit, full)
            left -= full * fit
            rest = times - full
            if rest and left and left < fit:
                put(room - left * length, lengths + (length,) * left, 1)
                left, rest = 0, rest - 1
            if fitting:
                put(room, lengths, rest)
    return [entry for entries in open_.values() for entry in entries]


def least_sequences(counts: np.ndarray) -> int:
    """A lower bound on the sequences: for every threshold, long pieces alone, and the others around the rest."""
    size = len(counts) - 1
    length = np.arange(size + 1)
    number, total = np.cumsum(counts), np.cumsum(counts * length)
    half = size // 2
    low = np.arange(half + 1)  # pieces shorter than this are left out
    below = np.maximum(low - 1, 0)
    alone = number[size] - number[size - low]
    middling = number[size - low] - number[half]
    room = middling * size - (total[size - low] - total[half])
    small = total[half] - total[below]
    return int((alone + middling + np.maximum(0, -((room - small) // size))).max())


def fillings(room: int, most: int, counts: np.ndarray) -> Iterator[tuple[int, ...]]:
    """Undominated fillings of ``room`` with pieces up to the length ``most``, the least waste first.

    A filling is dominated if two or more of its pieces can give way to one that is left and is no shorter, and
    the room still suffices: whatever fits where that one was fits with them instead.
    """
    lengths = [int(x) for x in np.flatnonzero(counts[: min(room, most) + 1])]
    reach, sums = [], 1  # bit s of reach[i]: the first i + 1 lengths have a filling of sum s
    within = (1 << room + 1) - 1
    for x in lengths:
        left, step = min(int(counts[x]), room // x), 1
        while left:
            step = min(step, left)
            sums |= sums << step * x & within
            left, step = left - step, 2 * step
        reach.append(sums)

    def exact(total: int, last: int) -> Iterator[tuple[int, ...]]:
        if not total:
            yield ()
            return
        for i in range(min(last, bisect_right(lengths, total) - 1), -1, -1):
            if not reach[i] >> total & 1:
                return
            x = lengths[i]
            for times in range(min(int(counts[x]), total // x), 0, -1):
                rest = total - times * x
                if not rest or i and reach[i - 1] >> rest & 1:
                    for tail in exact(rest, i - 1):
                        yield (x,) * times + tail

    def dominated(filling: tuple[int, ...], waste: int) -> bool:
        if len(filling) > 8:
            return False
        parts = {0: 0}
        for x in filling:
            for total, number in list(parts.items()):
                parts[total + x] = max(parts.get(total + x, 0), number + 1)
        return any(
            number > 1 and any(counts[x] > filling.count(x) for x in range(total, min(total + waste, most, room) + 1))
            for total, number in parts.items())

    for waste in range(room + 1):
        if sums >> room - waste & 1:
            for filling in exact(room - waste, len(lengths) - 1):
                if not dominated(filling, waste):
                    yield filling


def complete(counts: Sequence[int], nodes: int = NODES) -> Plan:
    """A plan of as few sequences as the search finds; it ends where the lower bound is met.

    ``nodes`` bounds the fillings that are tried. Every plan holds every piece.
    """
    best = best_fit(counts)
    fewest = sum(times for _, times in best)
    size = len(counts) - 1
    left = np.array(counts, np.int64)
    total = int((left * np.arange(size + 1)).sum())
    bound = least_sequences(left)
    path: Plan = []
    used = waste = tried = 0
    stack: list[Iterator[tuple[int, ...]]] = []
    while fewest > bound and tried < nodes:
        if len(stack) == len(path):  # a new node
            if not left.any() and used < fewest:
                best, fewest = list(path), used
            promising = used + least_sequences(left) < fewest and waste <= (fewest - 1) * size - total
            largest = int(np.flatnonzero(left)[-1]) if promising else 0
            rest = left.copy()
            rest[largest] -= 1
            stack.append(fillings(size - largest, largest, rest) if promising else iter(()))
        filling = next(stack[-1], None)
        if filling is None:
            stack.pop()
            if not stack:
                break
            lengths, times = path.pop()
            used -= times
            waste -= times * (size - sum(lengths))
            np.add.at(left, list(lengths), times)
            continue
        tried += 1
        lengths = (int(np.flatnonzero(left)[-1]), *filling)
        times = min(int(left[x]) // lengths.count(x) for x in set(lengths))
        path.append((lengths, times))
        np.subtract.at(left, list(lengths), times)
        used += times
        waste += times * (size - sum(lengths))
    return best


def slots(plan: Plan) -> dict[str, np.ndarray]:
    """For the pieces of each length, in order: the sequences and places that runs of them go to."""
    rows, taken, first = [], {}, 0
    for lengths, times in plan:
        offset = 0
        for x in lengths:
            rank = taken.get(x, 0)
            rows.append((x, rank, first, offset))
            taken[x] = rank + times
            offset += x
        first += times
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 4)
    return {"key": table[:, 0] << 48 | table[:, 1], "rank": table[:, 1], "sequence": table[:, 2], "offset": table[:, 3]}


def placed(cut: DataFrame, size: int = SIZE, planner: Callable[[Sequence[int]], Plan] = complete) -> DataFrame:
    """``cut`` (a written table of ``pieces``) with ``sequence_id`` and ``offset`` instead of ``part`` and ``rank``.

    What comes to the driver is one count per length. The pieces of a length are numbered by task, then by
    rank, from counts per task and length, so no group of equal lengths is gathered.
    """
    counts = [0] * (size + 1)
    for row in cut.groupBy("length").count().collect():  # a row per length, at most ``size``
        counts[row["length"]] = row["count"]
    where = slots(planner(counts))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = cut.groupBy("part", "length").agg(F.count("*").alias("__rows")).select(
        "part", "length", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__base"))
    ranked = cut.join(bases, ["part", "length"])
    kept = [c for c in cut.columns if c not in ("part", "rank")]
    source = ranked.select(F.struct(*kept).alias("row"), "length", (F.col("__base") + F.col("rank")).alias("rank"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            at = np.searchsorted(where["key"], length << 48 | rank, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(where["sequence"][at] + rank - where["rank"][at]), pa.array(where["offset"][at])],
                ["row", "sequence_id", "offset"])

    kind = source.schema["row"].dataType.simpleString()
    return source.mapInArrow(run, f"row {kind}, sequence_id long, offset long").select("row.*", "sequence_id", "offset")


def packed(docs: DataFrame, path: str = MODEL, size: int = SIZE, **columns: Column) -> DataFrame:
    """Per piece ``doc_id, piece, start, length``, the ``columns``, ``sequence_id, offset``.

    ``docs`` has ``doc_id`` and ``text``; a document is its ids and ``END``. Only documents longer than ``size``
    are cut. ``columns`` are worked out from the pieces' ``ids`` and stored with them; by default the ids
    themselves are. Null and empty texts are one piece of the single id ``END``. Repeated rows and rows
    without ``doc_id`` are documents of their own. A text is encoded whole, in stretches where it is long.
    Other columns are not looked at; an empty table gives no rows. Which piece of several with one length
    goes where depends on how the input lies in files; the number of sequences does not.
    """
    derived = [c.alias(name) for name, c in (columns or {"ids": F.col("ids")}).items()]
    cut = pieces(docs, path, size).select("doc_id", "piece", "start", "length", *derived, "part", "rank")
    return placed(stored(cut, "pieces"), size)


def sequences(packing: DataFrame) -> DataFrame:
    """One row per sequence: ``sequence_id, ids`` (binary), from a packing that carries ``ids``.

    A sequence holds at most the size it was packed for, so its group is small.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda ids, part: F.concat(ids, part["ids"]))
    return packing.groupBy("sequence_id").agg(joined.alias("ids"))
