"""CSV, JSON Lines and Parquet readers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfstack.functions.values import flag, whole_number
from shelfstack.settings import NA_TOKENS, Settings
from shelfstack.sources.registry import Dataset
from shelfstack.sources.schemas import column_types

RESCUED = "_rescued"
RAW_LINE = "_line"
_LEFT = "__left"
# Headers are compared, and all cells of a row are counted also where some columns are not asked for.
RESCUE_OPTIONS = {"enforceSchema": False, "columnPruning": False}
CANNOT_MERGE = ("CANNOT_MERGE_SCHEMAS", "CANNOT_MERGE_INCOMPATIBLE_DATA_TYPE")
# From narrow to wide; the first type of a step stands for it.
WIDER = (
    (T.ByteType,), (T.ShortType,), (T.IntegerType,), (T.LongType,), (T.FloatType,), (T.DoubleType, T.DecimalType),
)
EMPTY_DIRECTORY = ("UNABLE_TO_INFER_SCHEMA", "PATH_NOT_FOUND")


def read_csv(
    spark: SparkSession,
    path: str,
    types: Mapping[str, str] | None = None,
    na_tokens: Sequence[str] = NA_TOKENS,
    na_exempt: Sequence[str] = (),
    multiline: bool = False,
    infer: bool = False,
    rescue: str | None = None,
) -> DataFrame:
    """CSV with a header row; quotes inside a cell are doubled.

    Cells are read as text, NA words become NULL, and ``types`` are cast by column name.
    ``infer`` lets Spark guess the types instead, at the price of a second pass. ``multiline``
    is for cells with line breaks; it keeps Spark from splitting a file over tasks. With ``rescue``
    what does not fit is kept (``csv_cells``), and files whose headers differ stop the read.
    """
    reader = spark.read.options(**csv_options(multiline))
    if rescue:
        cells = reader.options(**RESCUE_OPTIONS).schema(cells_schema(reader.csv(path).columns)).csv(path)
        return csv_cells(cells, types or {}, na_tokens, na_exempt, rescue)
    frame = reader.option("inferSchema", infer).csv(path)
    return apply_types(na_to_null(frame, na_tokens, na_exempt), types or {})


def csv_options(multiline: bool = False) -> dict[str, object]:
    return {"header": True, "escape": '"', "multiLine": multiline, "columnNameOfCorruptRecord": RAW_LINE}


def cells_schema(columns: Sequence[str]) -> T.StructType:
    """All cells as text, and the whole line of rows with too many or too few of them."""
    return T.StructType([T.StructField(name, T.StringType()) for name in (*columns, RAW_LINE)])


def csv_cells(
    cells: DataFrame,
    types: Mapping[str, str],
    na_tokens: Sequence[str] = NA_TOKENS,
    na_exempt: Sequence[str] = (),
    rescue: str = RESCUED,
) -> DataFrame:
    """Text cells read by ``cells_schema``, batch or stream, as typed columns that lose nothing.

    The map ``rescue`` holds the text of every cell that does not fit its type, by column, and under
    ``_line`` the line of a row whose number of cells is wrong; it is NULL where everything fits.
    """
    named = na_to_null(cells, na_tokens, (*na_exempt, RAW_LINE))
    kept = _filled_map({**_misfits(named.drop(RAW_LINE), types), RAW_LINE: F.col(RAW_LINE)})
    return apply_types(named.withColumn(rescue, kept).drop(RAW_LINE), types)


def read_jsonl(
    spark: SparkSession,
    path: str,
    types: Mapping[str, str] | None = None,
    schema: T.StructType | str | None = None,
    rescue: str | None = None,
) -> DataFrame:
    """One JSON object per line, nested fields kept.

    Without ``schema`` Spark scans the files once to find every field; a given schema saves
    that pass. Fields it does not name, and values that do not fit, are dropped, or kept under
    ``rescue`` (``json_lines``).
    """
    if rescue:
        return json_lines(spark.read.text(path), schema or spark.read.json(path).schema, types or {}, rescue)
    reader = spark.read.schema(schema) if schema else spark.read
    return apply_types(reader.json(path), types or {})


def json_lines(
    lines: DataFrame, schema: T.StructType | str, types: Mapping[str, str], rescue: str = RESCUED
) -> DataFrame:
    """Lines of text (``value``), batch or stream, as the columns of ``schema``, typed by ``types``, losing nothing.

    The map ``rescue`` holds, as text, fields that ``schema`` does not name and values that do not fit; under
    ``_line`` it has lines that are no object. Empty lines are no rows. What does not fit inside a nested
    field is not looked for; the field as a whole is.
    """
    struct = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    nested = [f.name for f in struct.fields if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType))]
    text = T.StructType([f if f.name in nested else T.StructField(f.name, T.StringType()) for f in struct.fields])
    kinds = {f.name: _declared(f, types) for f in struct.fields if f.name not in nested}
    parsed = lines.where(F.trim("value") != "").select(
        "value", F.from_json("value", text).alias("row"), F.from_json("value", "map<string,string>").alias("all"))
    unread = F.array_compact(F.array(*[F.when(F.col("row")[name].isNull(), F.lit(name)) for name in nested]).cast("array<string>"))
    known = F.array(*map(F.lit, text.names)).cast("array<string>")
    left = F.map_filter("all", lambda key, value: value.isNotNull() & (~F.array_contains(known, key) | F.array_contains(unread, key)))
    columns = parsed.select(
        *[F.col("row")[name].alias(name) for name in text.names], left.alias(_LEFT),
        F.when(F.col("all").isNull(), F.col("value")).alias(RAW_LINE))
    misfits = _filled_map({**_misfits(columns.drop(_LEFT, RAW_LINE), kinds), RAW_LINE: F.col(RAW_LINE)})
    nothing = F.create_map().cast("map<string,string>")
    both = F.map_concat(F.coalesce(F.col(_LEFT), nothing), F.coalesce(misfits, nothing))
    return apply_types(columns.withColumn(rescue, F.when(F.size(both) > 0, both)).drop(_LEFT, RAW_LINE), kinds)


def _declared(field: T.StructField, types: Mapping[str, str]) -> str:
    """The type to give a scalar: the documented one, but fractions stay where whole numbers are documented."""
    kind = types.get(field.name, "")
    if not kind or kind.startswith("array") or kind == "bigint" and isinstance(field.dataType, T.FractionalType):
        return field.dataType.simpleString()
    return kind


def _misfits(df: DataFrame, types: Mapping[str, str]) -> dict[str, Column]:
    """Per text column with another declared type: its text where that does not fit, else NULL."""
    found = {}
    for field in df.schema.fields:
        kind, col = types.get(field.name, "string"), F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.StringType) and kind != "string" and not kind.startswith("array"):
            found[field.name] = F.when(col.isNotNull() & cast_text(col, kind).isNull(), col)
    return found


def _filled_map(texts: Mapping[str, Column]) -> Column:
    """The texts that are not NULL by name, NULL where there is none."""
    entries = F.array(*[F.struct(F.lit(name).alias("key"), text.alias("value")) for name, text in texts.items()])
    filled = F.filter(entries, lambda entry: entry["value"].isNotNull())
    return F.when(F.size(filled) > 0, F.map_from_entries(filled))


def rescued_cells(df: DataFrame, *keys: str, rescue: str = RESCUED) -> DataFrame:
    """What was rescued, one row per cell: the ``keys`` of its row, ``column_name`` and ``text``.

    Rows without any go after the outer explode: for a plain one Spark asks for filled maps below the projections
    that make them, and so parses and checks every row again for each use of them in that filter.
    """
    cells = df.select(*keys, F.explode_outer(rescue).alias("column_name", "text"))
    return cells.where("column_name IS NOT NULL")


def rescue_rules(df: DataFrame, types: Mapping[str, str], rescue: str = RESCUED) -> dict[str, Column]:
    """For an audit: rows with something rescued, misfits per declared column, rows with unknown fields or broken lines."""
    if rescue not in df.columns:
        return {}
    kept = F.col(rescue)
    fields = [c for c in df.columns if c != rescue]
    unknown = F.size(F.filter(F.map_keys(kept), lambda key: ~key.isin(*fields, RAW_LINE))) > 0
    misfits = {f"misfit_{name}": F.map_contains_key(kept, name) for name in fields if types.get(name, "string") != "string"}
    return {"quarantined": kept.isNotNull(), "broken_line": F.map_contains_key(kept, RAW_LINE), "unknown_field": unknown, **misfits}


def kept_schema(table: DataFrame, rescue: str = RESCUED) -> T.StructType:
    """The schema for the next load of a dataset, taken from the table of its last one.

    Fields that were rescued because no column had their name become columns: whole numbers, numbers, flags or
    text, by what all their values fit; nested ones stay JSON text. Only the column ``rescue`` is read, and one
    row per new field comes back.
    """
    known = [f for f in table.schema.fields if f.name != rescue]
    if rescue not in table.columns:
        return T.StructType(known)
    cells = rescued_cells(table, rescue=rescue).where(~F.col("column_name").isin(*[f.name for f in known], RAW_LINE))
    fits = {kind: F.bool_and(cast_text(F.col("text"), kind).isNotNull()) for kind in ("bigint", "double", "boolean")}
    found = cells.groupBy("column_name").agg(*[fit.alias(kind) for kind, fit in fits.items()]).orderBy("column_name")
    kinds = {row["column_name"]: next((kind for kind in fits if row[kind]), "string") for row in found.collect()}
    return T.StructType(known + [T.StructField(name, T.StructType.fromDDL(f"c {kind}")[0].dataType) for name, kind in kinds.items()])


def read_parquet(
    spark: SparkSession,
    path: str,
    merge_schema: bool = True,
    empty_schema: T.StructType | str | None = None,
    base_path: str | None = None,
) -> DataFrame:
    """A Parquet file, or a directory with or without ``key=value`` partitions.

    Only ``*.parquet`` files count. Columns are matched by name and missing ones are NULL.
    A directory without such files gives no rows when ``empty_schema`` is set.
    """
    reader = spark.read.option("mergeSchema", merge_schema).option("pathGlobFilter", "*.parquet")
    if base_path:
        reader = reader.option("basePath", base_path)
    try:
        return reader.parquet(path)
    except AnalysisException as error:
        if empty_schema is None or error.getCondition() not in EMPTY_DIRECTORY:
            raise
        return spark.createDataFrame([], empty_schema)


def read_parquet_widened(
    spark: SparkSession,
    path: str,
    empty_schema: T.StructType | str | None = None,
) -> DataFrame:
    """A directory of Parquet files whose columns changed their types over time.

    Files whose schemas Spark can merge are read together; each such group is then cast to the common types
    and the groups are stacked by name. Footers are read in Spark's schema merging only: files are halved
    along their paths until both halves merge, so days that changed once cost a few rounds.
    """
    files_ = sorted(row["path"] for row in _parquet_files(spark, path).collect())  # what Spark lists for a read as well
    if not files_:
        if empty_schema is None:
            raise ValueError(f"no Parquet files in {path}")
        return spark.createDataFrame([], empty_schema)
    reader = spark.read.option("basePath", path)
    groups = _mergeable(reader, files_)
    common: dict[str, T.DataType] = {}
    for _, schema in groups:
        for field in schema.fields:
            common[field.name] = common_type(common.get(field.name), field.dataType)
    frames = [
        reader.schema(schema).parquet(*paths).select(*[F.col(f"`{f.name}`").cast(common[f.name]).alias(f.name) for f in schema.fields])
        for paths, schema in groups
    ]
    return reduce(lambda one, two: one.unionByName(two, allowMissingColumns=True), frames)


def _parquet_files(spark: SparkSession, path: str) -> DataFrame:
    """Paths of the ``*.parquet`` files below ``path``; contents are not read."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True).load(path)
    return found.select("path")


def _mergeable(reader: DataFrameReader, paths: list[str]) -> list[tuple[list[str], T.StructType]]:
    """The files in as few groups as their schemas allow, each with its merged schema."""
    groups: list[tuple[list[str], T.StructType]] = []
    todo = [paths]
    while todo:
        part = todo.pop()
        try:
            schema = reader.option("mergeSchema", True).parquet(*part).schema
        except (PySparkException, Py4JJavaError) as error:  # a failed job is not always turned into the former
            if len(part) == 1 or not any(condition in str(error) for condition in CANNOT_MERGE):
                raise
            todo += [part[len(part) // 2 :], part[: len(part) // 2]]
            continue
        for i, (held, known) in enumerate(groups):
            merged = _same_where_shared(known, schema)
            if merged is not None:
                groups[i] = (held + part, merged)
                break
        else:
            groups.append((part, schema))
    return groups


def _same_where_shared(one: T.StructType, two: T.StructType) -> T.StructType | None:
    """The columns of both schemas, None where a shared one has two types."""
    known = {f.name: f.dataType for f in one.fields}
    if any(known.get(f.name, f.dataType) != f.dataType for f in two.fields):
        return None
    return T.StructType(one.fields + [f for f in two.fields if f.name not in known])


def common_type(one: T.DataType | None, two: T.DataType) -> T.DataType:
    """The type that holds the values of both; text where numbers, dates and flags do not go together.

    Whole numbers and fractions are doubles together, as in a data frame. Fields of structs are widened one by
    one; other nested types have to agree.
    """
    if one is None or one == two:
        return two
    ranks = [next((i for i, kinds in enumerate(WIDER) if isinstance(kind, kinds)), None) for kind in (one, two)]
    if None not in ranks:
        return WIDER[max(ranks)][0]()
    if {type(one), type(two)} <= {T.DateType, T.TimestampNTZType, T.TimestampType}:
        return T.TimestampType() if T.TimestampType in (type(one), type(two)) else T.TimestampNTZType()
    if isinstance(one, T.StructType) and isinstance(two, T.StructType):
        fields = {f.name: f.dataType for f in one.fields}
        for f in two.fields:
            fields[f.name] = common_type(fields.get(f.name), f.dataType)
        if list(fields) != two.names or list(fields) != one.names:
            raise ValueError("structs of one column have other fields")
        return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])
    if any(isinstance(kind, (T.StructType, T.ArrayType, T.MapType, T.BinaryType)) for kind in (one, two)):
        raise ValueError(f"no common type of {one.simpleString()} and {two.simpleString()}")
    return T.StringType()


def read_dataset(spark: SparkSession, settings: Settings, dataset: Dataset, last: DataFrame | None = None) -> DataFrame:
    """One registered dataset as it comes, for the Bronze layer.

    ``last`` is the table of the load before: JSON files are then read by its schema, once, and not scanned
    for their fields first.
    """
    path = f"{settings.raw_root.rstrip('/')}/{dataset.key}"
    types = bronze_types(dataset)
    if dataset.format == "csv":
        return read_csv(
            spark, path, types, settings.na_tokens, settings.na_exempt, settings.multiline_csv, rescue=settings.rescue)
    if dataset.format == "jsonl":
        schema = kept_schema(last, settings.rescue) if last is not None and settings.rescue else None
        return read_jsonl(spark, path, types, schema, settings.rescue)
    if dataset.format == "parquet":
        empty = ", ".join(f"`{name}` {kind}" for name, kind in types.items())
        try:
            return read_parquet(spark, path, settings.merge_parquet_schema, empty_schema=empty)
        except (PySparkException, Py4JJavaError) as error:
            if not any(condition in str(error) for condition in CANNOT_MERGE):
                raise
            return read_parquet_widened(spark, path, empty)
    raise ValueError(f"unknown format {dataset.format!r} of dataset {dataset.name}")


def bronze_types(dataset: Dataset) -> dict[str, str]:
    """Documented types of a dataset; dates in CSV files stay text."""
    return column_types(dataset.name, temporal=dataset.format != "csv")


def na_to_null(df: DataFrame, tokens: Sequence[str] = NA_TOKENS, exempt: Sequence[str] = ()) -> DataFrame:
    """NA words in text columns become NULL, but for the ``exempt`` columns."""
    def cleaned(field: T.StructField) -> Column:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.StringType) and field.name not in exempt:
            return F.when(~col.isin(*tokens), col).alias(field.name)
        return col

    return df.select(*[cleaned(field) for field in df.schema.fields])


def cast_text(col: Column, kind: str) -> Column:
    """Text as ``kind``, NULL where it does not fit."""
    if kind == "bigint":
        return whole_number(col)
    return col.try_cast(kind)


def apply_types(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Casts the named text, integer and float columns that are present; unknown columns stay."""
    def typed(field: T.StructField) -> Column:
        col = F.col(f"`{field.name}`")
        kind = types.get(field.name)
        if kind is None or kind.startswith("array") or field.dataType.simpleString() == kind:
            return col
        if isinstance(field.dataType, T.StringType):
            return cast_text(col, kind).alias(field.name)
        if kind == "boolean":
            return F.when(col.isNotNull(), flag(col)).alias(field.name)
        if kind == "bigint" and isinstance(field.dataType, T.FractionalType):
            return col  # a whole-number column with fractions in it stays as read
        return col.try_cast(kind).alias(field.name)

    return df.select(*[typed(field) for field in df.schema.fields])


def cast_failures(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Per text column: filled cells, and those that ``types`` would turn into NULL. One pass."""
    checked = {
        f.name: types[f.name]
        for f in df.schema.fields
        if isinstance(f.dataType, T.StringType) and types.get(f.name, "string") != "string"
    }
    if not checked:
        raise ValueError("no text column with a declared type")
    counts = df.agg(*[
        F.struct(
            F.count(name).alias("filled"),
            F.count_if(F.col(name).isNotNull() & cast_text(F.col(name), kind).isNull()).alias("failed"),
        ).alias(name)
        for name, kind in checked.items()
    ])
    return counts.unpivot([], list(checked), "column_name", "counts").select(
        "column_name", F.col("counts.filled").alias("filled"), F.col("counts.failed").alias("failed")
    )
