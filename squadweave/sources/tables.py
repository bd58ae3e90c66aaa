"""Headered tables in and out, page tables, and batches in load order."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from squadweave.functions.fixed_values import MISSING, NA_TOKENS
from squadweave.functions.text import na_to_null, strip_char


def null_tokens(df: DataFrame, tokens: tuple[str, ...] = NA_TOKENS) -> DataFrame:
    """Every string column with NA tokens as null."""
    return df.select(
        *[
            na_to_null(F.col(f"`{field.name}`"), tokens).alias(field.name)
            if isinstance(field.dataType, T.StringType)
            else F.col(f"`{field.name}`")
            for field in df.schema.fields
        ]
    )


# Holds a line that does not have the declared fields.
BROKEN = "_broken_line"


def _csv(
    spark: SparkSession, path: str, schema: T.StructType, order: str | None, multi_line: bool, broken: str | None = None
) -> DataFrame:
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    if broken:
        texts = texts.add(broken, T.StringType())
    rows = spark.read.csv(
        path, schema=texts, header=True, escape='"', multiLine=multi_line, columnNameOfCorruptRecord=broken or "_none"
    )
    if order is None:
        return rows
    # Within a file block one task numbers the rows as it reads them.
    return rows.select(
        "*",
        F.struct(
            F.col("_metadata.file_name").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        ).alias(order),
    )


def _rows(spark, path: str, schema: T.StructType, order: str | None, multi_line: bool, well_formed: bool) -> DataFrame:
    if not well_formed:
        return _csv(spark, path, schema, order, multi_line)
    return _parsed(_csv(spark, path, schema, order, multi_line, BROKEN), schema).filter(F.col(BROKEN).isNull()).drop(BROKEN)


def _parsed(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """``rows`` with every column in a filter that all of them pass: a line parsed in part is not seen to be broken."""
    return rows.filter(F.length(F.concat_ws("", *[F.col(f"`{field.name}`") for field in schema.fields])) >= 0)


def load_rows(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    order: str | None = None,
    multi_line: bool = False,
    well_formed: bool = False,
) -> DataFrame:
    """Headered CSV rows as they are, all strings; only empty fields are null.

    ``order`` names a column for the place of the row in its file. With
    ``well_formed`` lines with too many or too few fields are left out;
    ``malformed_rows`` has them.
    """
    return _rows(spark, path, schema, order, multi_line, well_formed)


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    na_tokens: tuple[str, ...] = NA_TOKENS,
    order: str | None = None,
    multi_line: bool = False,
    well_formed: bool = False,
) -> DataFrame:
    """Headered CSV with a declared schema; NA tokens and empty fields are null.

    Numbers that do not parse are null too. A byte order mark is skipped by the
    reader. ``well_formed`` is as for ``load_rows``.
    """
    rows = null_tokens(_rows(spark, path, schema, order, multi_line, well_formed), na_tokens)
    return rows.select(
        *[
            F.col(f"`{f.name}`") if isinstance(f.dataType, T.StringType)
            else F.col(f"`{f.name}`").try_cast("double").try_cast(f.dataType).alias(f.name)
            for f in schema.fields
        ],
        *([order] if order else []),
    )


def malformed_rows(
    spark: SparkSession, path: str, schema: T.StructType, order: str | None = None, multi_line: bool = False
) -> DataFrame:
    """Lines of headered CSV files with more or fewer fields than the schema, as they stand in the file: ``line``, and ``order``.

    ``load_rows`` and ``read_table`` cut or pad such a line; ``well_formed``
    makes them leave it out.
    """
    broken = _parsed(_csv(spark, path, schema, order, multi_line, BROKEN), schema).filter(F.col(BROKEN).isNotNull())
    return broken.select(F.col(BROKEN).alias("line"), *([order] if order else []))


def write_table(df: DataFrame, path: str, columns: list[str] | None = None, form: str = "parquet") -> None:
    """Write the columns in the given order, replacing what is there."""
    chosen = df if columns is None else df.select(*[F.col(f"`{name}`") for name in columns])
    writer = chosen.write.mode("overwrite")
    if form == "csv":
        writer.csv(path, header=True, escape='"')
    else:
        writer.format(form).save(path)


def read_pages(spark: SparkSession, path: str, page_list: DataFrame, form: str = "parquet") -> DataFrame:
    """Raw pages ``(url, html)`` with the college, season, batch and page number of the page list.

    A listed page without content gives no row. How finely the scan is split
    is up to ``spark.sql.files.maxPartitionBytes``.
    """
    raw = spark.read.format(form).schema("url string, html string").load(path)
    return raw.join(page_list, "url")


def read_page_files(spark: SparkSession, path: str) -> DataFrame:
    """One page per file: ``(url, html)`` with the file path in place of the url."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("url"), F.col("value").alias("html")
    )


def union_batches(batches: list[DataFrame], number: str = "batch_no") -> DataFrame:
    """All rows of all batches, each row with the number of its batch."""
    numbered = [df.withColumn(number, F.lit(at)) for at, df in enumerate(batches)]
    return reduce(DataFrame.unionByName, numbered)


def derive_dimension(df: DataFrame, column: str, drop: str = "/", out: str = "name", missing: str = MISSING) -> DataFrame:
    """Distinct values of a column in code point order, without ``drop`` characters."""
    return (
        df.filter(F.col(column) != missing)
        .select(strip_char(F.col(column), drop).alias(out))
        .distinct()
        .orderBy(out)
    )


def present(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with no null in the columns.

    One test per column, as a join adds them too: a frame used on both sides
    of a join then stays one and the same plan and is shuffled once.
    """
    for column in columns:
        df = df.filter(F.col(column).isNotNull())
    return df


def distinct_union(frames: list[DataFrame], column: str) -> DataFrame:
    return reduce(DataFrame.union, [df.select(column) for df in frames]).distinct()


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).filter(F.col(column).isNotNull()).distinct()


def sort_values(df: DataFrame, column: str) -> DataFrame:
    return df.orderBy(F.col(column).asc_nulls_last())


def top_k(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    """The first ``k`` rows. Give enough order columns to leave no ties."""
    return df.orderBy(*order).limit(k)


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    return df.limit(n)


def row_count(df: DataFrame) -> int:
    return df.count()
