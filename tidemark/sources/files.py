"""File and table readers and writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.session import scratch_path
from tidemark.sources.schemas import (
    CALENDAR_SCHEMA,
    CATEGORIES_SCHEMA,
    EVENT_SCHEMA,
    LISTING_SCHEMA,
    MESSAGE_SCHEMA,
)

Schema = StructType | str | None


def read_events(spark: SparkSession, path: str, schema: Schema = EVENT_SCHEMA) -> DataFrame:
    """Activity log from JSON lines, local or on an object store (``s3a://...``).

    ``schema=None`` infers the schema, which costs one more pass over the files.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: Schema = None,
    multi_line: bool = False,
) -> DataFrame:
    """CSV with a header row; columns are taken by header name.

    With a schema, the file may hold more columns and in another order. With
    ``multi_line``, quoted cells may hold line breaks (see :func:`csv_records`);
    inferring a schema then reads each file in one task.
    """
    reader = spark.read.option("header", True).option("escape", '"')
    whole = reader.option("multiLine", multi_line)
    if schema is None:
        return whole.option("inferSchema", True).csv(path)
    # Names are those of the first file's header; no more of it is read for them.
    raw = _parsed(csv_records(spark, path), whole.csv(path).columns) if multi_line else reader.csv(path)
    wanted = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return raw.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in wanted])


def _parsed(records: DataFrame, names: list[str]) -> DataFrame:
    """Records as string columns, by Spark's own parser."""
    quoted = [name.replace("`", "``") for name in names]
    cells = F.from_csv("record", ", ".join(f"`{name}` string" for name in quoted), {"escape": '"'})
    return records.select(cells.alias("cells")).select("cells.*")


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(record): the records of CSV files without their headers, each file read in many tasks.

    A line break belongs to a cell if an odd number of quotes stands before it in its
    file, which holds for files whose quotes stand around cells or are doubled inside
    them. Quotes are counted per line and per block, the parts in which Spark reads a
    file. Running sums of the blocks, a short row each, tell how every block begins
    and where the record that reaches into it began. So only records of several
    lines are shuffled a second time, to be joined. Blank lines between records are
    skipped, as Spark's reader does; a record ends with a line feed, with or without a carriage return.
    """
    lines = spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        # Within a block, lines come in order.
        F.monotonically_increasing_id().alias("line"),
        "value",
        (F.length("value") - F.length(F.translate("value", '"', ""))).alias("quotes"),
    )
    block, before = ["file", "block"], [Window.unboundedPreceding, -1]
    ahead = Window.partitionBy("file").orderBy("block").rowsBetween(*before)
    sums = lines.groupBy(*block).agg(F.sum("quotes").alias("sum"))
    starts = sums.select(*block, F.coalesce(F.sum("sum").over(ahead), F.lit(0)).alias("quotes_ahead"))
    inside = Window.partitionBy(*block).orderBy("line")
    upto = lines.withColumn("upto", F.sum("quotes").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    placed = upto.join(starts, block)
    total = F.col("upto") + F.col("quotes_ahead")
    first = (total - F.col("quotes")) % 2 == 0
    placed = placed.select(*block, "line", "value", first.alias("first"), (total % 2 == 0).alias("last"))
    head = (F.col("block") == 0) & (F.row_number().over(inside) == 1)
    # A record is named by its first line.
    name = F.when(F.col("first"), F.struct("block", "line", "head"))
    begun = placed.withColumn("head", head).withColumn("own", F.last(name, ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    latest = begun.groupBy(*block).agg(F.max(F.when(F.col("first"), F.col("own"))).alias("latest"))
    reaching = latest.select(*block, F.last("latest", ignorenulls=True).over(ahead).alias("reaching"))
    named = begun.join(reaching, block).select("file", "block", "line", "value", "first", "last", F.coalesce("own", "reaching").alias("name"))
    # What is no record of its own must not be parsed as one, also where Spark moves a
    # condition on a cell ahead of these filters; so the text itself depends on them.
    single, header = F.col("first") & F.col("last"), F.col("name.head")
    whole = named.filter(single & ~header).select(F.when(single & ~header, F.col("value")).alias("record"))
    # The lines of one record are as many as its cells have breaks.
    parts = named.filter(~single & ~header).groupBy("file", "name").agg(
        F.sort_array(F.collect_list(F.struct("block", "line", "value"))).alias("lines")
    )
    joined = parts.select(F.array_join(F.col("lines.value"), "\n").alias("record"))
    ended = F.regexp_replace("record", r"\r$", "").alias("record")
    return whole.unionByName(joined).select(ended).filter(F.trim("record") != "")


def read_calendar(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, CALENDAR_SCHEMA)


def read_listings(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, LISTING_SCHEMA, multi_line=True)


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, MESSAGE_SCHEMA, multi_line=True)


def read_categories(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, CATEGORIES_SCHEMA)


def read_table(spark: SparkSession, source: str, schema: StructType | str | None = None) -> DataFrame:
    """A stored table: a Parquet path (anything with a slash) or a catalog name."""
    if "/" not in source:
        return spark.table(source)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(source)


def write_table(df: DataFrame, target: str, partition_by: list[str] | None = None) -> None:
    """Write a Parquet path or a catalog table, replacing what is there."""
    writer = df.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if "/" in target:
        writer.save(target)
    else:
        writer.saveAsTable(target)


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines; null fields are left out."""
    df.write.mode("overwrite").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header row, quotes doubled inside cells."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def stored(df: DataFrame, name: str, schema: StructType | None = None) -> DataFrame:
    """Write to a new path under the shared folder and read back.

    For results that are read several times: later jobs start from the small
    table instead of the source, also after an executor is lost. ``schema`` names
    the types to read with, where a type has the form of the columns written.
    """
    path = scratch_path(df.sparkSession, name)
    write_table(df, path)
    return read_table(df.sparkSession, path, schema)
