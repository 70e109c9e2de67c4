"""Read the governed tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vouch.functions.checks import plain_number
from vouch.functions.frames import union_all
from vouch.functions.nulls import column, nan_to_null, tokens_to_null
from vouch.sources.schemas import HEALTHCARE_SCHEMAS
from vouch.sources.staging import new_folder, settle, stage


def load_tables(
    spark: SparkSession,
    path: str,
    schemas: dict[str, T.StructType] | None = None,
    file_format: str = "csv",
    multi_line: bool = False,
) -> dict[str, DataFrame]:
    """Each table of ``schemas`` from ``path/<table>.<file_format>``, by name.

    CSV columns are taken by header name; the files of a table must have the same header. Null tokens become NULL and text
    that does not fit the declared type does too; columns without a declared type stay text.
    ``multi_line`` allows line breaks inside quoted fields, but then a file cannot be split
    between tasks. A large CSV that is read more than once is best staged first
    (``sources.staging``).
    """
    schemas = HEALTHCARE_SCHEMAS if schemas is None else schemas
    if file_format == "csv":
        return {
            name: conform(read_csv(spark, f"{path}/{name}.csv", multi_line), schema)
            for name, schema in schemas.items()
        }
    return {
        name: nan_to_null(spark.read.format(file_format).load(f"{path}/{name}.{file_format}"))
        for name in schemas
    }


def read_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """A CSV with header, every column as text; a quote inside quotes is doubled."""
    # files whose headers differ in names or order end the job instead of mixing their columns
    reader = spark.read.option("header", True).option("enforceSchema", False).option("escape", '"')
    return reader.option("multiLine", multi_line).csv(path)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Text columns with null tokens removed and declared types applied."""
    declared = {f.name: f.dataType for f in schema}
    return nan_to_null(
        df.select(
            *[
                _typed(tokens_to_null(column(c)), declared.get(c, T.StringType())).alias(c)
                for c in df.columns
            ]
        )
    )


def _typed(text: Column, data_type: T.DataType) -> Column:
    if isinstance(data_type, T.StringType):
        return text
    if isinstance(data_type, T.IntegralType):
        # whole numbers are often written as 3.0 next to nulls
        number = plain_number(text).try_cast("double")
        whole = F.when(number == F.floor(number), number.try_cast(data_type))
        return F.coalesce(text.try_cast(data_type), whole)
    if isinstance(data_type, T.NumericType):
        return plain_number(text).try_cast(data_type)
    return text.try_cast(data_type)

#: Why a record is malformed: more fields than the header, or a quote that its line does not close.
SURPLUS, UNCLOSED = "surplus_fields", "unclosed_quote"
#: Stands between columns where a line is wanted whole: three control characters in a row.
_NO_SEPARATOR = "\u0001\u0002\u0001"


class MalformedInput(ValueError):
    """More malformed records than a load accepts."""


@dataclass(frozen=True)
class Loaded:
    """Tables without their malformed records, those records, and the counts of both.

    ``malformed``: table_name, file, reason, line. ``report``: table_name, loaded_count,
    malformed_count, surplus_fields, unclosed_quote.
    """

    tables: dict[str, DataFrame]
    malformed: DataFrame
    report: DataFrame


def load_checked(
    spark: SparkSession,
    path: str,
    schemas: dict[str, T.StructType] | None = None,
    max_malformed: int | None = 0,
    multi_line: bool = False,
    folder: str | None = None,
) -> Loaded:
    """Each table of ``schemas`` from ``path/<table>.csv``, its malformed records set apart and counted.

    A record is malformed if it has more fields than the header, or if a quote is left open: then
    its line break or the file's end stands inside a field. Records with fewer fields are
    padded with NULL, as are empty ones. With more than ``max_malformed`` such records in a table (None: any
    number) MalformedInput is raised, which names the tables and the first records.

    A CSV is read once: every line is parsed and written with its fault to ``folder`` (a new one in
    the shared folder unless given), and tables and counts are read from there. ``multi_line``
    allows line breaks inside quoted fields; quotes are then left to the reader and a file is not split.
    """
    schemas = HEALTHCARE_SCHEMAS if schemas is None else schemas
    folder = folder or new_folder(spark)
    parse = _parsed_records if multi_line else _parsed_lines
    parsed = {name: parse(spark, f"{path}/{name}.csv") for name in schemas}
    staged = stage({name: df for name, (_, df) in parsed.items()}, folder)
    tables, bad = {}, []
    for name, schema in schemas.items():
        columns = parsed[name][0]
        good = staged[name].where("reason is null").select(*[column(f"c{i}").alias(c) for i, c in enumerate(columns)])
        tables[name] = conform(good, schema)
        bad.append(staged[name].where("reason is not null").select(F.lit(name).alias("table_name"), "file", "reason", "line"))
    counts = [
        df.agg(
            F.count_if(F.col("reason").isNull()).alias("loaded_count"),
            F.count_if(F.col("reason").isNotNull()).alias("malformed_count"),
            *[F.count_if(F.col("reason") == reason).alias(reason) for reason in (SURPLUS, UNCLOSED)],
        ).select(F.lit(name).alias("table_name"), "*")
        for name, df in staged.items()
    ]
    loaded = Loaded(tables, union_all(bad), settle(union_all(counts)))
    if max_malformed is not None:
        over = loaded.report.where(F.col("malformed_count") > max_malformed).orderBy("table_name").collect()
        if over:
            first = loaded.malformed.where(F.col("table_name") == over[0].table_name).limit(3).collect()
            counted = ", ".join(f"{r.table_name}: {r.malformed_count}" for r in over)
            shown = "; ".join(f"{r.reason}: {r.line[:200]}" for r in first)
            raise MalformedInput(f"more than {max_malformed} malformed records ({counted}), such as {shown}")
    return loaded


def _parsed_lines(spark: SparkSession, path: str) -> tuple[list[str], DataFrame]:
    """The header's names, and c0, c1, ..., reason, line (where malformed), file of every line after it."""
    columns = read_csv(spark, path).columns
    reader = spark.read.option("header", True).option("enforceSchema", False).option("sep", _NO_SEPARATOR).option("quote", "")
    raw = reader.csv(path)
    lines = raw.select(column(raw.columns[0]).alias("text"), F.input_file_name().alias("file"))
    fields = ", ".join(f"c{i} STRING" for i in range(len(columns)))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "fault", "escape": '"'}
    parsed = lines.withColumn("r", F.from_csv("text", f"{fields}, fault STRING", options))
    # the reader marks too few fields as well, so those of marked lines are counted
    surplus = F.col("r.fault").isNotNull() & (_fields("text") > len(columns))
    reason = F.when(_quotes("text") % 2 == 1, UNCLOSED).when(surplus, SURPLUS)
    line = F.when(F.col("reason").isNotNull(), F.col("text")).alias("line")
    return columns, parsed.withColumn("reason", reason).select(*[f"r.c{i}" for i in range(len(columns))], "reason", line, "file")


def _parsed_records(spark: SparkSession, path: str) -> tuple[list[str], DataFrame]:
    """As ``_parsed_lines``, of records that may take several lines."""
    columns = read_csv(spark, path, True).columns
    names = [f"c{i}" for i in range(len(columns))]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, "beyond", "fault"]])
    # one column more than the header has: the reader marks all records but those with one field too many
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", True).option("columnNameOfCorruptRecord", "fault")
    records = reader.schema(schema).csv(path).withColumn("file", F.input_file_name())
    surplus = F.col("fault").isNull() | (_fields("fault") > len(columns))
    reason = F.when(_quotes("fault") % 2 == 1, UNCLOSED).when(surplus, SURPLUS)
    line = F.when(F.col("reason").isNotNull(), F.coalesce("fault", F.concat_ws(",", *names, "beyond"))).alias("line")
    return columns, records.withColumn("reason", reason).select(*names, "reason", line, "file")


def _quotes(text: str) -> Column:
    return F.length(F.col(text)) - F.length(F.replace(F.col(text), F.lit('"'), F.lit("")))


def _fields(text: str) -> Column:
    """The number of fields of a record; separators inside quotes do not count."""
    bare = F.regexp_replace(text, r'"(?:[^"]|"")*"', "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1
