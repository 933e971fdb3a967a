"""Fill-in-the-middle: texts cut at two unit boundaries and put together in another order.

One ``fullmatch`` of ``(unit)*`` keeps every repetition of its group, so ``ends(1)`` is the list of all unit
boundaries: its length is the number of units and two of its entries are the cuts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfstack.llm.storage import text_batches
from shelfstack.llm.texts import blocks

# What a unit is, the marks, and the shares in percent.
UNIT = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
CHANGED = 50
SUFFIX_FIRST = 80
SEED = 42

STRETCH = 1 << 20  # code points to a match; the library keeps some 250 bytes for every repetition
_UNITS = regex.compile(f"({UNIT})*")
_BREAK = regex.compile(r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")


def unit_ends(text: str, stretch: int = STRETCH) -> np.ndarray:
    """Where the units of a text end, in code points.

    Texts up to ``stretch`` are one match. A longer one is matched in stretches that end where a unit does,
    which gives the same units in bounded memory.
    """
    found, start = [np.zeros(0, np.int64)], 0
    while start < len(text):
        cut = _BREAK.search(text, start + stretch) if len(text) - start > stretch else None
        end = cut.start() if cut else len(text)
        found.append(np.array(_UNITS.fullmatch(text, start, end).ends(1), np.int64))
        start = end
    return np.concatenate(found)


def draws(key: Column, seed: int = SEED) -> Column:
    """Four numbers under 2**32 from the SHA-256 of seed and key; a null key counts as empty."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return F.array(*[F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)])


def rearranged(docs: DataFrame, *keep: str, changed: int = CHANGED, suffix_first: int = SUFFIX_FIRST, seed: int = SEED) -> DataFrame:
    """The columns ``keep`` with ``n, form, prefix_chars, middle_chars, output`` for every row of ``docs``.

    ``docs`` has ``doc_id`` and ``text``. ``n`` is the number of units. ``changed`` percent of the texts become
    ``spm`` (``suffix_first`` percent of those) or ``psm``, drawn by ``doc_id``; the others, empty and null
    texts and texts that hold a mark stay ``plain``, with null lengths. A text of ``n`` units has ``n + 1``
    places to cut, ends included, so parts can be empty. Equal rows come out alike, also when they are
    repeated; a null ``doc_id`` draws as the empty key. Texts are read whole, whatever their length. Other
    columns are not looked at unless ``keep`` names them; an empty table gives no rows.
    """
    text_batches(docs.sparkSession)
    text = F.coalesce(docs["text"], F.lit(""))
    source = docs.select(F.struct(*[docs[c] for c in keep]).alias("row"), text.alias("text"), draws(docs["doc_id"], seed).alias("draw"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches):
            draw = batch.column("draw").flatten().to_numpy().reshape(-1, 4)
            made = [_one(t, h, changed, suffix_first) for t, h in zip(batch.column("text").to_pylist(), draw.tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), *(pa.array(list(c), kind) for c, kind in zip(zip(*made), _KINDS))],
                ["row", "n", "form", "prefix_chars", "middle_chars", "output"])

    kind = source.schema["row"].dataType.simpleString()
    out = source.mapInArrow(run, f"row {kind}, n long, form string, prefix_chars long, middle_chars long, output string")
    return out.select("row.*", "n", "form", "prefix_chars", "middle_chars", "output")


_KINDS = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())


def _one(text: str, draw: list[int], changed: int, suffix_first: int) -> tuple:
    ends = unit_ends(text)
    n = len(ends)
    if not text or draw[2] % 100 >= changed or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, text
    a, b = (int(ends[k - 1]) if k else 0 for k in sorted((draw[0] % (n + 1), draw[1] % (n + 1))))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if draw[3] % 100 < suffix_first:
        return n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` was made of.

    No part holds a mark, and a mark cannot overlap another, so the first place of each mark is its own. Null
    for a null output or form.
    """
    def between(first: str, then: str) -> Column:
        """What lies between the mark ``first`` at the front and the mark ``then``."""
        return F.substring(output, F.lit(1 + len(first)), F.locate(then, output) - 1 - len(first))

    def after(mark: str) -> Column:
        return F.substring(output, F.locate(mark, output) + len(mark), F.length(output))

    def inner(mark: str) -> Column:
        start = F.locate(mark, output) + len(mark)
        return F.substring(output, start, F.locate(MIDDLE, output) - start)

    spm = F.concat(inner(PREFIX), after(MIDDLE), between(SUFFIX, PREFIX))
    psm = F.concat(between(PREFIX, SUFFIX), after(MIDDLE), inner(SUFFIX))
    return F.when(form == "plain", output).when(form == "spm", spm).when(form == "psm", psm)
