"""Key lookups, referential checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfstack.operators.carts import flatten_items
from shelfstack.sources.registry import RELATIONS

SALT = "__salt"


def lookup(
    fact: DataFrame,
    dimension: DataFrame,
    on: str,
    spread_by: str,
    dimension_key: str | None = None,
    salts: int = 1024,
) -> DataFrame:
    """``fact`` LEFT JOIN ``dimension``, every fact row kept and the dimension shuffled once.

    The NULLs of an optional key match nothing and are dealt over ``salts`` partitions by a hash of
    ``spread_by``. Both join sides stay plain shuffles, so AQE splits a hot key, and a dimension whose
    size turns out small is broadcast instead.
    """
    key = dimension_key or on
    right = dimension.withColumnRenamed(key, on) if key != on else dimension
    # Always 0, but not a constant: the optimizer would take a constant out of the join key.
    right = right.withColumn(SALT, F.pmod(F.xxhash64(on), F.lit(1)).cast("int"))
    spread = F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int")
    left = fact.withColumn(SALT, F.when(F.col(on).isNull(), spread).otherwise(0))
    return left.join(right, [on, SALT], "left").drop(SALT)


def with_parent(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Rows of ``child`` whose ``key`` exists in ``parent``."""
    return child.join(parent.select(key), key, "left_semi").select(*child.columns)


def without_parent(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Rows of ``child`` whose ``key`` is missing in ``parent`` (NULL keys included)."""
    return child.join(parent.select(key), key, "left_anti").select(*child.columns)


def follow(
    tables: Mapping[str, DataFrame], child: str, key: str, columns: Sequence[str], spread_by: str
) -> DataFrame:
    """A dataset with ``columns`` of the row its foreign key ``key`` points to.

    A key inside an array (``items.product_id``) is followed item by item: one row per item, its fields as
    columns, and one row of NULLs for an empty array.
    """
    for name, name_key, parent, parent_key in RELATIONS:
        if (name, name_key) == (child, key):
            target = tables[parent].select(parent_key, *columns)
            path, _, leaf = key.rpartition(".")
            rows = flatten_items(tables[child], path) if path else tables[child]
            return lookup(rows, target, leaf, spread_by, dimension_key=parent_key)
    raise ValueError(f"{child}.{key} is no foreign key")


class ForeignKey(NamedTuple):
    name: str
    child: DataFrame
    child_key: str
    parent: DataFrame
    parent_key: str


def foreign_keys(tables: Mapping[str, DataFrame]) -> list[ForeignKey]:
    """The documented relations between the given datasets."""
    return [
        ForeignKey(f"{child}.{key}", tables[child], key, tables[parent], parent_key)
        for child, key, parent, parent_key in RELATIONS
        if child in tables and parent in tables
    ]


def foreign_key_violations(relations: Sequence[ForeignKey]) -> DataFrame:
    """Per relation: filled child values, and the values and distinct keys without a parent.

    A key inside an array counts once per item. Every table is scanned once for all its keys. These are counted
    per target and key, for all relations at once, so that a hot key is one row in the shuffle; the join with the
    parents lies on the same keys and needs no other.
    """
    kinds = {_values(fk)[1] for fk in relations} | {fk.parent.schema[fk.parent_key].dataType.simpleString() for fk in relations}
    kind = "bigint" if kinds <= {"bigint", "int"} else "string"
    targets = {(id(fk.parent), fk.parent_key): fk for fk in relations}
    numbers = {target: number for number, target in enumerate(targets)}
    asked: dict[int, tuple[DataFrame, list[Column]]] = {}
    for i, fk in enumerate(relations):
        target = numbers[id(fk.parent), fk.parent_key]
        asked.setdefault(id(fk.child), (fk.child, []))[1].append(_entries(_values(fk)[0], kind, target, i))
    held: dict[int, tuple[DataFrame, list[Column]]] = {}
    for target, fk in targets.items():
        held.setdefault(id(fk.parent), (fk.parent, []))[1].append(_entries(F.array(fk.parent_key), kind, numbers[target], -1))

    def stacked(frames: Mapping[int, tuple[DataFrame, list[Column]]]) -> DataFrame:
        return reduce(DataFrame.unionByName, [frame.select(F.inline(F.flatten(F.array(*entries)))) for frame, entries in frames.values()])

    counted = stacked(asked).groupBy("target", "key").agg(
        *[F.count_if(F.col("relation") == i).alias(f"r{i}") for i in range(len(relations))])
    known = stacked(held).groupBy("target", "key").agg(F.lit(True).alias("known"))
    missing = F.col("known").isNull()
    totals = counted.join(known, ["target", "key"], "left").agg(*[
        F.struct(
            F.coalesce(F.sum(rows), F.lit(0)).alias("checked_rows"),
            F.coalesce(F.sum(F.when(missing, F.col(rows))), F.lit(0)).alias("orphan_rows"),
            F.count_if(missing & (F.col(rows) > 0)).alias("orphan_keys"),
        ).alias(rows)
        for rows in (f"r{i}" for i in range(len(relations)))
    ])
    names = [F.struct(F.lit(fk.name).alias("relation"), F.col(f"r{i}").alias("of")) for i, fk in enumerate(relations)]
    return totals.select(F.inline(F.array(*names))).select("relation", "of.checked_rows", "of.orphan_rows", "of.orphan_keys")


def _values(fk: ForeignKey) -> tuple[Column, str]:
    """The values of a child's key as an array, and their type."""
    path, _, leaf = fk.child_key.rpartition(".")
    if path:
        values = F.col(path)[leaf]
        return F.coalesce(values, F.array()), fk.child.select(values.alias("v")).schema["v"].dataType.elementType.simpleString()
    return F.array(fk.child_key), fk.child.schema[fk.child_key].dataType.simpleString()


def _entries(values: Column, kind: str, target: int, relation: int) -> Column:
    """The filled values as rows of ``target``, ``relation`` and ``key``."""
    filled = F.filter(values, lambda v: v.isNotNull())
    return F.transform(filled, lambda v: F.struct(F.lit(target).alias("target"), F.lit(relation).alias("relation"), v.cast(kind).alias("key")))
