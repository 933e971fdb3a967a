"""SentencePiece encoding and decoding as shortest paths through weighted transducers.

Three transducers are compiled from a BPE piece model. The normaliser puts one blank before a text that
is not empty and reads U+2581 as a blank. The lexicon maps the bytes of a piece, along a trie, to the
piece; characters without a piece take the byte-fallback arcs, one per byte. The context transducer has a
state for each last piece: an arc weighs nothing where merging the two neighbours' characters by rank
keeps the boundary between them, and infinity elsewhere. Composed with an input, exactly one path has a
finite weight, the BPE segmentation, so the tropical shortest path needs one last piece for each place.

No piece has a blank after another character, so every path passes through the places before runs of
blanks, and the composition falls into independent segments (a word with the blanks before it). Equal
segments of a stretch of text are composed once, all of them in step, place by place, in numpy.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfstack.llm.storage import text_batches
from shelfstack.llm.texts import SpanHash, blocks, handing_back, mix, utf8

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
_BLANK = "▁"
_NEVER = np.int64(1) << 40
_LONG = 96  # bytes; longer segments are composed one by one
STRETCH = 1 << 17  # bytes of text that are composed together; a path takes some hundred bytes per byte
_CACHE_BITS = 21
_WINDOW = 1024  # places of the trie that are tried at a time


@dataclass(frozen=True)
class Machine:
    """The compiled transducers as plain arrays, shipped to every task; sizes are those of the model."""

    piece_bytes: np.ndarray  # all pieces' bytes, one after the other
    piece_start: np.ndarray
    code: np.ndarray  # byte -> its code in the trie; 0 leads nowhere
    base: np.ndarray  # trie: an inner node's arc with code c has the place base[node] + c
    source: np.ndarray  # place -> the node whose arc lies there
    target: np.ndarray  # place -> the node that it leads to
    node_piece: np.ndarray  # node -> piece or -1
    byte_piece: np.ndarray  # byte -> its fallback piece
    rank: np.ndarray  # piece -> merge rank; -1 for single characters and bytes
    right: np.ndarray  # piece -> pieces at its right edge, from whole to part; -1 behind the last
    left: np.ndarray
    merge_key: np.ndarray  # sorted pairs of pieces that make a piece
    merge_piece: np.ndarray
    texts: list[str]  # piece -> its characters
    uneven: np.ndarray  # pieces with a part at an edge that ranks behind what takes it up


def _merges(text: str, score: dict[str, float]) -> Iterator[list[str]]:
    """The parts of ``text`` from its characters on, merge by merge, best score and leftmost first."""
    parts = list(text)
    while True:
        yield list(parts)
        options = [(-score[x + y], i) for i, (x, y) in enumerate(zip(parts, parts[1:])) if x + y in score]
        if not options:
            return
        i = min(options)[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


def _merged(text: str, score: dict[str, float]) -> list[str]:
    return list(_merges(text, score))[-1]


def _displaced(inner: int, arcs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sparse table of arcs (node, code, next node) as rows laid over each other so that no two arcs share a place."""
    arcs = arcs[np.lexsort((arcs[:, 1], arcs[:, 0]))]
    node, code, following = arcs.T
    count = np.bincount(node, minlength=inner)
    first = np.cumsum(count) - count
    width = int(code.max()) + 1
    base = np.zeros(inner, np.int32)
    taken = np.zeros(4 * len(arcs) + 2 * _WINDOW, bool)
    low = 0
    for n in np.argsort(-count, kind="stable")[: int((count > 1).sum())]:
        own = code[first[n] : first[n] + count[n]]
        at = low
        while True:
            fits = ~np.logical_or.reduce([taken[at + c : at + c + _WINDOW] for c in own])
            if fits.any():
                break
            at += _WINDOW
            if at + width + _WINDOW > len(taken):
                taken = np.r_[taken, np.zeros(len(taken), bool)]
        base[n] = at + int(fits.argmax())
        taken[base[n] + own] = True
        if taken[low : low + _WINDOW].mean() > 0.95:
            low += _WINDOW
    single = np.flatnonzero(count == 1)
    free = np.flatnonzero(~np.r_[taken, np.zeros(len(single) + width, bool)][width:])[: len(single)] + width
    base[single] = free - code[first[single]]
    place = base[node] + code
    size = int(base.max()) + width
    source, target = np.full(size, -1, np.int32), np.zeros(size, np.int32)
    source[place], target[place] = node, following
    return base, source, target


def compile_machine(path: str = MODEL) -> Machine:
    """Compiles a BPE piece model with byte fallback; raises where the model is of another kind."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    raw_bytes = [b""] * len(ids)
    byte_piece = np.zeros(256, np.int64)
    score: dict[str, float] = {}
    number: dict[str, int] = {}
    for i in ids:
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            raw_bytes[i] = bytes([int(piece[3:5], 16)])
            byte_piece[raw_bytes[i][0]] = i
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            raw_bytes[i] = piece.replace(_BLANK, " ").encode()
            score[piece], number[piece] = model.get_score(i), i
    if any(_BLANK in p.lstrip(_BLANK) for p in number) or any(c not in number for p in number for c in p):
        raise ValueError("a piece has a blank inside, or a character that is no piece")
    # Ranks count merges from best to worst, as scores order them.
    order = {p: r for r, p in enumerate(sorted((p for p in number if len(p) > 1), key=lambda p: -score[p]))}
    rank = np.full(len(ids), -1, np.int64)
    halves: dict[str, tuple[str, str]] = {}
    reachable = set()
    for p in number:
        if len(p) == 1:
            reachable.add(p)
            continue
        rank[number[p]] = order[p]
        *_, before, last = _merges(p, score)
        if len(last) == 1:
            halves[p] = (before[0], before[1])
            reachable.add(p)

    def edge(p: str, side: int) -> list[int]:
        out = [number[p]]
        while p in halves:
            p = halves[p][side]
            out.append(number[p])
        return out

    edges = [{number[p]: edge(p, side) for p in reachable} for side in (0, 1)]
    tables = []
    for side in (0, 1):
        table = np.full((len(ids), max(map(len, edges[side].values())) + 1), -1, np.int64)
        table[:, 0] = np.arange(len(ids))
        for i, e in edges[side].items():
            table[i, : len(e)] = e
        tables.append(table)
    merges = {number[p[:k]] * len(ids) + number[p[k:]]: i for p, i in number.items() for k in range(1, len(p)) if p[:k] in number and p[k:] in number}
    keys = np.array(sorted(merges), np.int64)
    late = {number[p] for p, two in halves.items() for q in two if rank[number[q]] >= rank[number[p]]}
    uneven = np.zeros(len(ids), bool)
    for side in (0, 1):
        for i, e in edges[side].items():
            uneven[i] |= any(q in late for q in e)

    nodes: dict[bytes, int] = {b"": 0}
    spelled = {raw_bytes[number[p]]: number[p] for p in reachable}
    every = {s[:k] for s in spelled for k in range(len(s) + 1)}
    inner = {s[:-1] for s in every if s}
    for s in sorted(every, key=lambda s: (s not in inner, len(s), s)):
        nodes.setdefault(s, len(nodes))
    used = sorted({b for s in every for b in s})
    code = np.zeros(256, np.int64)
    code[used] = np.arange(1, len(used) + 1)
    arcs = np.array([(nodes[s[:-1]], code[s[-1]], n) for s, n in nodes.items() if s], np.int64)
    base, source, target = _displaced(len(inner), arcs)
    node_piece = np.full(len(nodes), -1, np.int64)
    for s, i in spelled.items():
        node_piece[nodes[s]] = i
    return Machine(
        np.frombuffer(b"".join(raw_bytes), np.uint8), np.cumsum([0, *map(len, raw_bytes)]), code, base, source, target, node_piece, byte_piece, rank,
        tables[1], tables[0], keys, np.array([merges[k] for k in keys.tolist()], np.int64),
        [model.id_to_piece(i) if model.id_to_piece(i) in number else "" for i in ids], uneven)


def _keeps_boundary(m: Machine, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Whether merging by rank leaves the boundary between the pieces ``one`` and ``two`` alone.

    A part at the right edge of ``one`` and one at the left edge of ``two`` merge if that makes a piece,
    both parts exist at one time, and their merge comes before those that take them up; the leftmost of
    equal merges comes first. Where a part ranks behind the piece that takes it up (runs of blanks), ranks
    do not tell what exists at one time, and the pair's merges are gone through.
    """
    keep = np.ones(len(one), bool)
    parts = m.rank.shape[0]
    top_x = np.full(len(one), _NEVER)
    for i in range(m.right.shape[1]):
        x = m.right[one, i]
        some = np.flatnonzero((x >= 0) & keep)
        if not len(some):
            break
        top_y = np.full(len(one), _NEVER)
        for j in range(m.left.shape[1]):
            y = m.left[two, j]
            at = some[(y[some] >= 0) & keep[some]]
            if not len(at):
                break
            key = x[at] * parts + y[at]
            place = np.minimum(np.searchsorted(m.merge_key, key), len(m.merge_key) - 1)
            hit = m.merge_key[place] == key
            at, made = at[hit], m.rank[m.merge_piece[place[hit]]]
            rx, ry, px, py = m.rank[x[at]], m.rank[y[at]], top_x[at], top_y[at]
            keep[at[(rx <= py) & (ry < px) & (made < px) & (made <= py)]] = False
            top_y = np.where(y >= 0, m.rank[np.maximum(y, 0)], top_y)
        top_x = np.where(x >= 0, m.rank[np.maximum(x, 0)], top_x)
    odd = np.flatnonzero(m.uneven[one] | m.uneven[two])
    if len(odd):
        score = {t: -float(r) for t, r in zip(m.texts, m.rank) if t}
        for k in odd:
            x, y = m.texts[one[k]], m.texts[two[k]]
            keep[k] = not x or not y or _merged(x + y, score) == [x, y]
    return keep


class Context:
    """Arc weights of the context transducer, worked out when first asked for and remembered in a fixed table."""

    def __init__(self, machine: Machine):
        self.machine = machine
        small = len(machine.rank) ** 2 <= np.iinfo(np.int32).max
        self.key = np.full(1 << _CACHE_BITS, -1, np.int32 if small else np.int64)
        self.kept = np.zeros(1 << _CACHE_BITS, bool)

    def finite(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        key = one * len(self.machine.rank) + two
        slot = (mix(key.view(np.uint64)) >> np.uint64(64 - _CACHE_BITS)).astype(np.int64)
        found, known = self.kept[slot], self.key[slot] == key
        missing = np.flatnonzero(~known)
        if len(missing):
            fresh, back = np.unique(key[missing], return_inverse=True)
            value = _keeps_boundary(self.machine, *np.divmod(fresh, len(self.machine.rank)))
            found[missing] = value[back]
            self.key[slot[missing]], self.kept[slot[missing]] = key[missing], value[back]
        return found


def _arcs(m: Machine, data: np.ndarray, room: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and piece of all arcs over ``data``; ``room`` is how far an arc may reach from each byte."""
    start, length, piece = [], [], []
    coded = m.code[data]
    lead = (data & 0xC0) != 0x80
    at = np.flatnonzero(lead)
    node = np.zeros(len(at), np.int64)
    width = 1 + (data[at] >= 0xC0) + (data[at] >= 0xE0) + (data[at] >= 0xF0)
    single = np.zeros(len(at), bool)
    index = np.arange(len(at))
    depth = 0
    while len(at):
        place = m.base[node] + coded[at + depth]
        node = np.where(m.source[place] == node, m.target[place], 0)
        depth += 1
        alive = node > 0
        at, node, index = at[alive], node[alive], index[alive]
        final = m.node_piece[node] >= 0
        start.append(at[final])
        length.append(np.full(final.sum(), depth))
        piece.append(m.node_piece[node[final]])
        single[index[final & (width[index] == depth)]] = True
        more = (node < len(m.base)) & (room[at] > depth)
        at, node, index = at[more], node[more], index[more]
    leads = np.flatnonzero(lead)
    unknown = np.zeros(len(data), bool)  # bytes of characters that have no piece
    unknown[leads[~single]] = True
    follow = np.flatnonzero(~lead)
    owner = leads[np.searchsorted(leads, follow, "right") - 1]
    unknown[follow] = unknown[owner]
    fallback = np.flatnonzero(unknown)
    start.append(fallback)
    length.append(np.ones(len(fallback), np.int64))
    piece.append(m.byte_piece[data[fallback]])
    return np.concatenate(start), np.concatenate(length), np.concatenate(piece)


def shortest_paths(context: Context, data: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pieces of the segments in ``data``, one after the other, and the number of pieces of each segment."""
    m = context.machine
    first = np.cumsum(size) - size
    begin = np.repeat(first, size)
    place = np.arange(len(data)) - begin
    start, length, piece = _arcs(m, data, np.repeat(size, size) - place)
    # One node more for each segment: its end.
    segment = np.repeat(np.arange(len(size)), size)
    node = start + segment[start]
    order = np.argsort(place[start], kind="stable")
    node, length, piece = node[order], length[order], piece[order]
    cuts = np.r_[0, np.cumsum(np.bincount(place[start], minlength=1))]
    last = np.full(len(data) + len(size), -1, np.int64)  # the piece of the finite path into each node
    back = np.zeros(len(last), np.int64)
    for i in range(len(cuts) - 1):
        a, b = cuts[i], cuts[i + 1]
        source, reach, arc = node[a:b], length[a:b], piece[a:b]
        if i:
            on_path = last[source] >= 0
            source, reach, arc = source[on_path], reach[on_path], arc[on_path]
            fine = context.finite(last[source], arc)
            source, reach, arc = source[fine], reach[fine], arc[fine]
        last[source + reach], back[source + reach] = arc, reach
    # Walk back from the ends.
    heads = first + np.arange(len(size))
    here, owner = heads + size, np.arange(len(size))
    owners, pieces = [], []
    if (last[here] < 0).any():
        raise ValueError("a segment has no path: the piece model is not one of plain merges")
    while len(here):
        owners.append(owner)
        pieces.append(last[here])
        here = here - back[here]
        left = here > heads[owner]
        here, owner = here[left], owner[left]
    owners, pieces = np.concatenate(owners[::-1]), np.concatenate(pieces[::-1])
    order = np.argsort(owners, kind="stable")
    return pieces[order], np.bincount(owners, minlength=len(size))


def _long_path(context: Context, data: np.ndarray) -> np.ndarray:
    """The same for one long segment, arc by arc."""
    m = context.machine
    start, length, piece = _arcs(m, data, len(data) - np.arange(len(data)))
    order = np.argsort(start, kind="stable")
    cuts = np.searchsorted(start[order], np.arange(len(data) + 1)).tolist()
    length, piece = length[order].tolist(), piece[order].tolist()
    last, back = [-1] * (len(data) + 1), [0] * (len(data) + 1)
    fine: dict[tuple[int, int], bool] = {}
    for i in range(len(data)):
        if i and last[i] < 0:
            continue
        for k in range(cuts[i], cuts[i + 1]):
            pair = (last[i], piece[k])
            if i and pair not in fine:
                fine[pair] = bool(context.finite(np.array([pair[0]]), np.array([pair[1]]))[0])
            if i == 0 or fine[pair]:
                last[i + length[k]], back[i + length[k]] = piece[k], length[k]
        if len(fine) > 1 << 20:
            fine.clear()
    out, at = [], len(data)
    while at:
        out.append(last[at])
        at -= back[at]
    return np.array(out[::-1], np.int64)


def normalised(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of texts after the normaliser; null and empty texts stay empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    column = pc.replace_substring(column, _BLANK, " ")
    dummy = pc.if_else(pc.equal(pc.binary_length(column), 0), pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string()))
    return utf8(pc.binary_join_element_wise(dummy, column, pa.scalar("", pa.large_string())))


def _stretches(begins: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of about ``STRETCH`` bytes that end where a segment does."""
    a = 0
    while a < len(begins):
        b = a + STRETCH
        while b < len(begins) and not begins[b : b + STRETCH].any():
            b += STRETCH
        b = b + int(begins[b : b + STRETCH].argmax()) if b < len(begins) else len(begins)
        yield a, b
        a = b


def _encode_segments(context: Context, data: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pieces of the segments that begin at ``start`` in ``data``, and the number of pieces of each."""
    size = np.diff(np.r_[start, len(data)])
    _, first, which = np.unique(SpanHash(data)(start, start + size), return_index=True, return_inverse=True)
    piece, count = np.zeros(0, np.int32), np.zeros(len(first), np.int64)
    short = np.flatnonzero(size[first] <= _LONG)
    short = short[np.argsort(size[first[short]], kind="stable")]
    parts, owners = [], []
    if len(short):
        n = size[first[short]]
        index = np.repeat(start[first[short]] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        found, number = shortest_paths(context, data[index], n)
        parts.append(found.astype(np.int32))
        owners.append(short)
        count[short] = number
    for u in np.flatnonzero(size[first] > _LONG):
        found = _long_path(context, data[start[first[u]] : start[first[u]] + size[first[u]]])
        parts.append(found.astype(np.int32))
        owners.append(np.array([u]))
        count[u] = len(found)
    if parts:
        piece = np.concatenate(parts)
    order = np.concatenate(owners) if owners else np.zeros(0, np.int64)
    base = np.zeros(len(first), np.int64)
    base[order] = np.cumsum(count[order]) - count[order]
    n = count[which]
    return piece[np.repeat(base[which] - (np.cumsum(n) - n), n) + np.arange(n.sum())], n


def encode_batch(context: Context, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Piece ids of a column of texts, the number of pieces per row, and per row whether decoding gives the text back.

    Texts are encoded stretch by stretch, so that beside texts and ids no more than a stretch is held, however
    many rows there are and however long they are; only a long segment is a stretch by itself.
    """
    data, offsets = normalised(column)
    original, edges = utf8(column)
    blank = data == 32
    begins = blank.copy()
    begins[1:] &= ~blank[:-1]
    begins[offsets[:-1][offsets[:-1] < len(data)]] = True
    # Decoding drops the blank before a text; what else the normaliser changes makes the text shorter.
    same = np.diff(offsets) == np.diff(edges) + (np.diff(edges) > 0)
    per_row = np.zeros(len(column), np.int64)
    found = [np.zeros(0, np.int32)]
    for a, b in _stretches(begins):
        start = np.flatnonzero(begins[a:b])
        ids, n = _encode_segments(context, data[a:b], start)
        row = np.searchsorted(offsets, start + a, "right") - 1
        np.add.at(per_row, row, n)
        decoded, ends = _spelled(context.machine, ids, n)
        if not np.array_equal(decoded, data[a:b]):
            wrong = [decoded[c:d].tobytes() != data[e:f].tobytes() for c, d, e, f in zip(ends, ends[1:], start + a, np.r_[start[1:] + a, b])]
            same[row[wrong]] = False
        found.append(ids)
    return np.concatenate(found), per_row, same


def _spelled(m: Machine, ids: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the pieces ``ids``, and where those of each run of ``count`` ids end, after a 0; slice by slice."""
    n = np.diff(m.piece_start)[ids]
    parts = [np.zeros(0, np.uint8)]
    for a in range(0, len(ids), STRETCH):
        some, size = ids[a : a + STRETCH], n[a : a + STRETCH]
        parts.append(m.piece_bytes[np.repeat(m.piece_start[some] - (np.cumsum(size) - size), size) + np.arange(size.sum())])
    return np.concatenate(parts), np.r_[0, np.cumsum(n)][np.r_[0, np.cumsum(count)]]


def decode_ids(m: Machine, ids: np.ndarray, per_row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the texts that ids stand for, without the blank that the normaliser puts first; and offsets."""
    raw, ends = _spelled(m, ids, per_row)
    first = ends[:-1][ends[1:] > ends[:-1]]
    kept = np.ones(len(raw), bool)
    kept[first[raw[first] == 32]] = False
    return raw[kept], np.r_[0, np.cumsum(kept)][ends]


_contexts: dict[int, Context] = {}


def _context(machine: Machine) -> Context:
    """One context per worker and machine, so that weights outlive a batch."""
    key = hash((len(machine.rank), machine.piece_bytes.tobytes()))
    if key not in _contexts:
        _contexts.clear()
        _contexts[key] = Context(machine)
    return _contexts[key]


def encoded(docs: DataFrame, *keep: str, model: str = MODEL) -> DataFrame:
    """The columns ``keep`` (all by default) with ``token_ids``, ``n_tokens`` and ``round_trip``.

    A null text has null ids and no tokens, an empty one an empty list; both count as round trips. U+2581 in
    a text decodes to a blank, as in the public library, and is no round trip. Texts are encoded whole;
    equal texts get equal ids; a long word without blanks is one long segment. Other columns do not matter,
    also of the same names.
    """
    text_batches(docs.sparkSession)
    machine = docs.sparkSession.sparkContext.broadcast(compile_machine(model))
    source = docs.select(F.struct(*(keep or docs.columns)).alias("row"), docs["text"].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = _context(machine.value)
        for batch in blocks(batches):
            text = batch.column("text")
            ids, per_row, same = encode_batch(context, text)
            edges = pa.array(np.r_[0, np.cumsum(per_row)].astype(np.int32))
            lists = pa.ListArray.from_arrays(edges, pa.array(ids), mask=pc.is_null(text))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), lists, pa.array(per_row), pa.array(same)], ["row", "token_ids", "n_tokens", "round_trip"])

    kind = source.schema["row"].dataType.simpleString()
    return source.mapInArrow(handing_back(run), f"row {kind}, token_ids array<int>, n_tokens long, round_trip boolean") \
        .select("row.*", "token_ids", "n_tokens", "round_trip")


def decoded(encodings: DataFrame, *keep: str, model: str = MODEL) -> DataFrame:
    """The columns ``keep`` with ``text`` from ``token_ids``; null ids give a null text.

    Bytes that are no UTF-8 are replaced by U+FFFD.
    """
    machine = encodings.sparkSession.sparkContext.broadcast(compile_machine(model))
    source = encodings.select(F.struct(*(keep or ("doc_id",))).alias("row"), "token_ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("token_ids")
            per_row = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            raw, bounds = decode_ids(machine.value, lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), per_row)
            texts = [raw[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(bounds, bounds[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(texts, pa.string(), mask=pc.is_null(lists).to_numpy(zero_copy_only=False))], ["row", "text"])

    kind = source.schema["row"].dataType.simpleString()
    return source.mapInArrow(handing_back(run), f"row {kind}, text string").select("row.*", "text")
