"""Reading raw, cleaned and feature tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegerType, StringType, StructType

from shelfcast.functions.dates import parse_date
from shelfcast.schemas import CLEAN_SCHEMAS, RAW_SCHEMAS


@dataclass(frozen=True)
class RetailTables:
    """The four input tables of the pipeline."""

    ventas: DataFrame
    promociones: DataFrame
    clima: DataFrame
    productos: DataFrame

    def as_dict(self) -> dict[str, DataFrame]:
        return {f.name: getattr(self, f.name) for f in fields(self)}

    def map(self, fn: Callable[[str, DataFrame], DataFrame]) -> RetailTables:
        return RetailTables(**{name: fn(name, df) for name, df in self.as_dict().items()})


def _parsed(text: Column, kind: DataType) -> Column:
    """The value of a CSV field, NULL where it cannot be read as ``kind``."""
    if isinstance(kind, IntegerType):
        number = F.trim(text).try_cast("double")
        return F.when(number == F.floor(number), number.try_cast("int"))
    if isinstance(kind, StringType):
        return text
    return F.trim(text).try_cast(kind.simpleString())


def _typed(text: DataFrame, schema: StructType, bad: str, path: str) -> DataFrame:
    """Text columns as the columns of ``schema`` that the file has, found by name."""
    if bad not in ("fail", "null"):
        raise ValueError("bad values either fail or become null")
    columns = []
    for f in schema.fields:
        if f.name not in text.columns:
            continue
        field = F.col(f.name)
        value = _parsed(field, f.dataType)
        if bad == "fail":
            what = F.concat(F.lit(f"{path}: column {f.name} holds no {f.dataType.simpleString()}: "), field)
            unreadable = value.isNull() & (F.trim(field) != "")
            value = F.when(unreadable, F.raise_error(what)).otherwise(value)
        columns.append(value.cast(f.dataType).alias(f.name))
    return text.select(*columns)


def csv_columns(spark: SparkSession, path: str) -> list[str]:
    """Names of the header. Every file has to have the same header."""
    return spark.read.option("header", True).option("enforceSchema", False).csv(path).columns


def read_csv_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of the files other than headers and empty ones: archivo, linea, campos (the fields
    as texts by name) and motivo: NULL, ``campos`` where a line has more or fewer fields than the
    header, ``comillas`` where a quote is left open."""
    names = csv_columns(spark, path)
    quoted = [f"`{n.replace('`', '``')}`" for n in names]
    fields = F.from_csv(
        "linea",
        ", ".join(f"{q} string" for q in [*quoted, "`_linea`"]),
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_linea"},
    )
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("archivo"), F.col("value").alias("linea")
    )
    # a quote behind a backslash is part of a field
    open_quote = F.regexp_count("linea", F.lit(r'(?<!\\)"')) % 2 == 1
    ragged = F.col("campos").getField("_linea").isNotNull()
    header = F.lit(True)
    for name in names:
        header = header & F.col("campos").getField(name).eqNullSafe(F.lit(name))
    return (
        lines.where(F.trim("linea") != "")
        .withColumn("campos", fields)
        .where(~header)
        .withColumn("motivo", F.when(open_quote, "comillas").when(ragged, "campos"))
    )


def read_csv_text(spark: SparkSession, path: str, *, bad: str = "null") -> DataFrame:
    """All columns as text, named by the header. A line that is malformed (see
    ``read_csv_lines``) stops the job with ``bad="fail"``, otherwise it is left out."""
    lines = read_csv_lines(spark, path)
    fields = F.col("campos")
    if bad == "fail":
        what = F.concat_ws(": ", "archivo", F.lit("malformed line"), "motivo", "linea")
        fields = F.when(F.col("motivo").isNotNull(), F.raise_error(what)).otherwise(fields)
    else:
        lines = lines.where("motivo IS NULL")
    return lines.select(fields.alias("campos")).select("campos.*").drop("_linea")


def malformed_lines(spark: SparkSession, path: str) -> DataFrame:
    """The quarantine of a CSV: archivo, linea and motivo of every malformed line."""
    found = read_csv_lines(spark, path).where("motivo IS NOT NULL")
    return found.select("archivo", "linea", "motivo")


def read_table(
    spark: SparkSession,
    path: str,
    *,
    schema: StructType | None = None,
    fmt: str = "csv",
    bad: str = "fail",
) -> DataFrame:
    """Scan one table. CSV has a header row, and its columns may stand in any order; with a
    schema a field that is not empty but cannot be read stops the job, or becomes NULL with
    ``bad="null"`` (``unreadable_values`` counts them). A malformed line stops the job too, or
    is left out (``malformed_lines`` has them). Without a schema types are inferred, which costs
    an extra pass over the files."""
    if fmt == "csv" and schema is not None:
        return _typed(read_csv_text(spark, path, bad=bad), schema, bad, path)
    reader = spark.read
    if fmt == "csv":
        reader = reader.option("header", True).option("inferSchema", True)
    elif schema is not None:
        reader = reader.schema(schema)
    return reader.format(fmt).load(path)


def unreadable_values(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """One row: per column of ``schema`` that the CSV has, the fields that cannot be read."""
    text = read_csv_text(spark, path)
    return text.agg(
        *(
            F.count_if(
                (F.trim(F.col(f.name)) != "") & _parsed(F.col(f.name), f.dataType).isNull()
            ).alias(f.name)
            for f in schema.fields
            if f.name in text.columns
        )
    )


def _read_all(
    spark: SparkSession, paths: Mapping[str, str], schemas: Mapping[str, StructType], **options
) -> RetailTables:
    return RetailTables(
        **{name: read_table(spark, paths[name], schema=schemas.get(name), **options) for name in RAW_SCHEMAS}
    )


def read_raw_tables(
    spark: SparkSession,
    paths: Mapping[str, str],
    *,
    fmt: str = "csv",
    infer: bool = False,
    bad: str = "fail",
) -> RetailTables:
    typed = fmt == "csv" and not infer
    return _read_all(spark, paths, RAW_SCHEMAS if typed else {}, fmt=fmt, bad=bad)


def read_clean_tables(
    spark: SparkSession, paths: Mapping[str, str], *, fmt: str = "parquet"
) -> RetailTables:
    """Cleaned tables with their dates typed, whatever the file format kept of them."""
    tables = _read_all(spark, paths, CLEAN_SCHEMAS if fmt == "csv" else {}, fmt=fmt)
    return tables.map(lambda _, df: parse_date(df) if "fecha" in df.columns else df)


def read_model_dataset(spark: SparkSession, path: str, *, fmt: str = "parquet") -> DataFrame:
    """The feature dataset with a typed date; a missing path raises AnalysisException."""
    return parse_date(read_table(spark, path, fmt=fmt))


def preview(df: DataFrame, keys: list[str], n: int = 5) -> DataFrame:
    """First ``n`` rows in key order (a top-n, not a full sort)."""
    return df.orderBy(*keys).limit(n)
