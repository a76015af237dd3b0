"""Table readers: CSV, JSON documents, paged exports and per-dataset Parquet."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import to_long
from ..operators.sets import union_all

# Cell texts that count as missing in a CSV export.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

_SPEC = "array<struct<dataset:string,fields:array<struct<field:string>>>>"


def _schema(schema: str | T.StructType) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)


def _typed(c: Column, to: T.DataType) -> Column:
    """Text to the declared type, null where it does not parse."""
    if isinstance(to, T.StringType):
        return c
    if isinstance(to, T.LongType):
        return to_long(c)
    if isinstance(to, T.IntegerType):
        return to_long(c).try_cast("int")
    return F.trim(c).try_cast(to)


def _csv(spark: SparkSession, path, multiline: bool) -> DataFrame:
    # Only the header line is read up front. Quotes inside a cell are doubled, not back-slashed.
    # A file whose header differs from the first one fails the job rather than shifting columns.
    return (
        spark.read.option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("enforceSchema", False)
        .option("multiLine", multiline)
        .csv(path)
    )


def read_csv_table(spark: SparkSession, path, schema: str | T.StructType, multiline: bool = False) -> DataFrame:
    """CSV with a header; columns are found by name, missing-value texts become null.

    ``multiline`` allows line breaks inside quoted cells, at the price of files that cannot be split.
    """
    wanted = _schema(schema)
    raw = _csv(spark, path, multiline)
    known = {f.name: F.when(~F.col(f"`{f.name}`").isin(NA_TOKENS), F.col(f"`{f.name}`")) for f in wanted}
    return raw.select(*[_typed(known[f.name], f.dataType).alias(f.name) for f in wanted])


def read_csv_strings(
    spark: SparkSession, path, usecols: Sequence[str], required: str, multiline: bool = False
) -> DataFrame:
    """Some columns of a CSV as text, hyphens in names turned into underscores, rows without a value
    in ``required`` left out."""
    raw = _csv(spark, path, multiline)
    cols = [
        F.when(~F.col(f"`{c}`").isin(NA_TOKENS), F.col(f"`{c}`")).alias(c.replace("-", "_")) for c in usecols
    ]
    return raw.select(*cols).filter(F.col(required.replace("-", "_")).isNotNull())


def read_columnar_json(spark: SparkSession, path, schema: str | T.StructType, lines: bool = False) -> DataFrame:
    """Documents of the form ``{"columns": [...], "rows": [[...], ...]}``, one per file, or one per
    line with ``lines``.

    Each document says where its columns are, so pages may differ in column order.
    """
    docs = spark.read.schema("columns array<string>, rows array<array<string>>").json(path, multiLine=not lines)
    rows = docs.select("columns", F.explode("rows").alias("row"))
    fields = []
    for f in _schema(schema):
        at = F.array_position("columns", F.lit(f.name)).cast("int")
        fields.append(_typed(F.get("row", at - 1), f.dataType).alias(f.name))
    return rows.select(*fields)


def read_json_records(spark: SparkSession, path, schema: str | T.StructType, lines: bool = False) -> DataFrame:
    """Documents holding an array of objects, or one object per line with ``lines``.

    Blank texts stay blank. A file of lines can be split between tasks, a whole document cannot.
    """
    return spark.read.schema(_schema(schema)).json(path, multiLine=not lines)


def read_pages(
    spark: SparkSession, glob: str, schema: str | T.StructType, layout: str = "records", lines: bool = False
) -> DataFrame:
    """A table exported as many pages, read in one parallel scan instead of page after page."""
    if layout == "csv":
        return read_csv_table(spark, glob, schema)
    reader = {"records": read_json_records, "columnar": read_columnar_json}[layout]
    return reader(spark, glob, schema, lines)


def read_entities(
    spark: SparkSession,
    paths: Mapping[str, str],
    columns: Mapping[str, str],
    defaults: Mapping[str, str] | None = None,
    ids: Sequence[str] = ("entity", "organisation_entity"),
) -> DataFrame:
    """Parquet tables of several datasets as one, tagged with their dataset.

    ``columns`` maps wanted names to types; a file may spell them with hyphens. An absent column takes
    its value from ``defaults``; without one the table is refused. Id columns are coerced to whole
    numbers. Only the wanted columns are read.
    """
    defaults = defaults or {}
    frames = []
    for dataset, path in paths.items():
        raw = spark.read.parquet(path)
        present = {c.replace("-", "_"): c for c in raw.columns}
        cols = []
        for name, kind in columns.items():
            if name == "dataset":
                continue
            if name in present:
                c = F.col(f"`{present[name]}`")
                cols.append((to_long(c) if name in ids else c.try_cast(kind)).alias(name))
            elif name in defaults:
                cols.append(F.lit(defaults[name]).cast(kind).alias(name))
            else:
                raise ValueError(f"dataset {dataset} has no column {name}")
        frames.append(raw.select(F.lit(dataset).alias("dataset"), *cols))
    return union_all(*frames)


def read_specification(specification: DataFrame, col: str = "json") -> DataFrame:
    """(dataset, field) rows from the nested documents in a table's cells."""
    datasets = specification.select(F.explode(F.from_json(F.col(col), _SPEC)).alias("d"))
    return datasets.select(F.col("d.dataset").alias("dataset"), F.explode("d.fields.field").alias("field"))


def dataset_slugs(registry: DataFrame) -> DataFrame:
    """Sorted distinct dataset names."""
    return registry.select("dataset").dropna().distinct().orderBy("dataset")
