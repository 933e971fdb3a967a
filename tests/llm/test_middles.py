import hashlib
import re

import pytest
from pyspark.sql import functions as F

from shelfstack.llm import middles

ROWS = [
    (1, "one two  three\n", "a"), (1, "one two  three\n", "a"), (2, None, "b"), (3, "", None), (None, "x y z", "c"),
    (4, "has <P> in it", "d"), (5, " \t\n ", "e"), (6, "<P <S<M> x", "f"), (7, "été là  \U0001f600 ¿qué?\r\n", "g"),
    (8, "word  " * 50_000, "h"), (9, "x" * 200_000, "i"), (10, "<P < S> <M <S <P", "j"), (11, " " * 5000 + "x", "k"),
]


def documents(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, output string").withColumn("n", F.lit(7))


def by_hand(doc_id, text):
    """The same by a loop over the units."""
    text = text or ""
    ends = [m.end() for m in re.finditer(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)]
    n = len(ends)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return n, "plain", None, None, text
    a, b = ([0, *ends][k] for k in sorted((h[0] % (n + 1), h[1] % (n + 1))))
    if h[3] % 100 < 80:
        return n, "spm", a, b - a, "<S>" + text[b:] + "<P>" + text[:a] + "<M>" + text[a:b]
    return n, "psm", a, b - a, "<P>" + text[:a] + "<S>" + text[b:] + "<M>" + text[a:b]


def test_rows_are_those_of_a_loop_and_can_be_restored(spark):
    rows = ROWS + [(100 + i, t, None) for i in range(40) for _, t, _ in ROWS[:7] + ROWS[7:8]]
    made = middles.rearranged(documents(spark, rows), "doc_id", "text").withColumn(
        "again", middles.restored(F.col("output"), F.col("form")))
    got = made.collect()
    assert len(got) == len(rows)
    assert {r.form for r in got} == {"plain", "spm", "psm"}
    for r in got:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == by_hand(r.doc_id, r.text)
        assert r.again == (r.text or "")


def test_clashing_columns_and_empty_tables(spark):
    docs = documents(spark, ROWS).withColumnRenamed("n", "draw").withColumn("row", F.lit("r"))
    got = middles.rearranged(docs, "doc_id", "draw", "row")
    assert got.columns == ["doc_id", "draw", "row", "n", "form", "prefix_chars", "middle_chars", "output"]
    assert {r.draw for r in got.collect()} == {7}
    assert middles.rearranged(documents(spark, []), "doc_id").count() == 0


def test_shares_are_parameters(spark):
    docs = documents(spark, [(i, "a b c d", None) for i in range(200)])
    forms = lambda **k: {r.form for r in middles.rearranged(docs, "doc_id", **k).collect()}
    assert forms(changed=0) == {"plain"}
    assert forms(changed=100, suffix_first=0) == {"psm"}
    assert forms(changed=100, suffix_first=100) == {"spm"}


@pytest.mark.parametrize("text", ["", "a", "  ", "a b  c\td", "ab " * 30 + "   ", "\n" + "x" * 50 + " y"])
def test_stretches_give_the_units_of_one_match(text):
    want = [m.end() for m in re.finditer(middles.UNIT, text)]
    for stretch in (1, 2, 7, 1 << 20):
        assert middles.unit_ends(text, stretch).tolist() == want
