"""Scans of the input tables (S1, S3) with NaN -> NULL at the source.

Parquet scans are lazy; Catalyst prunes columns and pushes filters into the
reader, so callers select only what they need and nothing else is read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)

# Tokens that pandas' CSV reader treats as missing by default; Spark's CSV
# reader takes one ``nullValue``, so the rest are mapped after the scan.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Replace NaN in float/double columns by NULL (pandas treats both as missing)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.when(~F.isnan(F.col(f.name)), F.col(f.name)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one driver table (``<sf_dir>/<name>.parquet``), NaN -> NULL."""
    return nan_to_null(spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet"))


def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """S3: feature Parquet scan with column pruning and NaN -> NULL."""
    df = spark.read.parquet(path)
    if columns is not None:
        df = df.select(*[c for c in columns if c in df.columns])
    return nan_to_null(df)


# The raw files by table, and their text columns. Every other column is a
# number: keys and the target whole, the rest doubles.
RAW_FILES = {
    "app": "application_train.csv",
    "app_test": "application_test.csv",
    "bureau": "bureau.csv",
    "bb": "bureau_balance.csv",
    "prev": "previous_application.csv",
    "pos": "POS_CASH_balance.csv",
    "ins": "installments_payments.csv",
    "cc": "credit_card_balance.csv",
}
TEXT_PREFIXES = ("NAME_", "CODE_", "CHANNEL_", "PRODUCT_", "FLAG_OWN_")
TEXT_COLUMNS = (
    "CREDIT_ACTIVE", "CREDIT_CURRENCY", "CREDIT_TYPE", "EMERGENCYSTATE_MODE", "FLAG_LAST_APPL_PER_CONTRACT", "FONDKAPREMONT_MODE",
    "HOUSETYPE_MODE", "OCCUPATION_TYPE", "ORGANIZATION_TYPE", "STATUS", "WALLSMATERIAL_MODE", "WEEKDAY_APPR_PROCESS_START",
)
WHOLE_COLUMNS = ("TARGET",)
WHOLE_PREFIXES = ("SK_ID_",)


def raw_schema(columns: list[str]) -> T.StructType:
    """The types of a raw table from its column names, by the rule above."""
    def kind(c: str) -> T.DataType:
        if c in TEXT_COLUMNS or c.startswith(TEXT_PREFIXES):
            return T.StringType()
        return T.LongType() if c in WHOLE_COLUMNS or c.startswith(WHOLE_PREFIXES) else T.DoubleType()
    return T.StructType([T.StructField(c, kind(c)) for c in columns])


#: Name of the column that tells where a row stands in the input.
POSITION = "_position"


def with_position(df: DataFrame, name: str = POSITION) -> DataFrame:
    """A file scan with each row's place in the input, ascending in file name, split and row, as one decimal.

    A decimal is a fixed-width aggregation buffer, so its minimum is a hash aggregate. (Files whose splits Spark
    packs in another order still compare by name and start of the split.)"""
    files = sorted(df.inputFiles())
    path, start = F.col("_metadata.file_path"), F.col("_metadata.file_block_start")
    rank = F.lit(0) if len(files) < 2 else F.array_position(F.array(*[F.lit(f) for f in files]), path)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))          # rows of a task are in order
    number = (rank.cast("decimal(38,0)") * F.lit(10 ** 12).cast("decimal(13,0)") + start) * F.lit(10 ** 10).cast("decimal(11,0)") + place
    return df.select("*", number.cast("decimal(38,0)").alias(name))


def read_raw_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
                 null_tokens: tuple[str, ...] = NULL_TOKENS, strict: bool = True, position: bool = False) -> DataFrame:
    """Raw CSV scan without an inference pass, typed by ``schema`` or, without one, by
    ``raw_schema`` of the header line.

    Every field is read as text; one of ``null_tokens`` is NULL in any column. Text that is
    no number of its column's type is an error, with ``strict=False`` NULL. A NaN or a column
    the file lacks is NULL; a column the schema lacks is left out. With ``strict=False`` the fields
    that were no numbers, and lines of the wrong length, are found by ``raw_rejects``. ``position`` adds
    the row's place in the input (``with_position``), by which cleaning keeps the first of several rows of a key.
    """
    raw = spark.read.option("header", True).option("nullValue", "").csv(path)
    schema = schema or raw_schema(raw.columns)
    cols = []
    if position:
        raw = with_position(raw)
        cols.append(F.col(POSITION))
    for f in schema.fields:
        if f.name not in raw.columns:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        text = F.when(~F.col(f"`{f.name}`").isin(*[t for t in null_tokens if t]), F.col(f"`{f.name}`"))
        if not isinstance(f.dataType, T.StringType):
            value = text.try_cast(f.dataType)
            if strict:
                bad = F.raise_error(F.concat(F.lit(f"{f.name}: not a {f.dataType.simpleString()}: "), text))
                value = F.when(text.isNotNull() & value.isNull(), bad.cast(f.dataType)).otherwise(value)
            text = value
        cols.append(text.alias(f.name))
    return nan_to_null(raw.select(*cols))


def raw_rejects(spark: SparkSession, path: str, schema: T.StructType | None = None,
                null_tokens: tuple[str, ...] = NULL_TOKENS) -> DataFrame:
    """S1's side table: ``(file, line, column, text, reason)`` of every field that is no number of its column's type, and of
    every line with too few or too many fields (``column`` is then NULL and ``text`` the line).

    ``line`` counts the file's lines from 1, header and malformed lines included; blank lines, which the CSV reader skips,
    are not counted, and quoted line breaks count as one line. One scan finds the rejects; a second, of no column,
    counts the rows of each split, of which there is one row a split."""
    names = spark.read.option("header", True).csv(path).columns
    schema = schema or raw_schema(names)
    types = {f.name: f.dataType for f in schema.fields}
    text = T.StructType([T.StructField(c, T.StringType()) for c in [*names, "_line"]])
    raw = (spark.read.option("header", True).option("nullValue", "").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_line")
           .option("columnPruning", False).schema(text).csv(path))        # whole lines are parsed, or wrong lengths go unseen
    file, split = F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split")
    rows = raw.select(file, split, F.monotonically_increasing_id().alias("place"), *[F.col(f"`{c}`") for c in names], "_line")

    def bad(c: str):
        value = F.when(~F.col(f"`{c}`").isin(*[t for t in null_tokens if t]), F.col(f"`{c}`"))
        kind = types[c]
        wrong = F.col("_line").isNull() & value.isNotNull() & value.try_cast(kind).isNull()
        return F.when(wrong, F.struct(F.lit(c).alias("column"), value.alias("text"), F.lit(f"not a {kind.simpleString()}").alias("reason")))

    found = [bad(c) for c in names if c in types and not isinstance(types[c], T.StringType)]
    length = F.when(F.col("_line").isNotNull(), F.struct(F.lit(None).cast("string").alias("column"), F.col("_line").alias("text"),
                                                         F.lit(f"not {len(names)} fields").alias("reason")))
    rejects = rows.select("file", "split", "place", F.explode(F.array_compact(F.array(length, *found))).alias("r"))
    # with column pruning on, a scan of no column counts the lines without parsing any
    counted = spark.read.option("header", True).option("mode", "PERMISSIVE").schema(T.StructType(text.fields[:-1])).csv(path)
    splits = counted.select(file, split, F.monotonically_increasing_id().alias("place")).groupBy("file", "split").agg(
        F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    starts = splits.select("file", "split", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    line = F.col("before") + F.col("place") - F.col("first") + 2
    return rejects.join(starts, ["file", "split"]).select("file", line.alias("line"), "r.column", "r.text", "r.reason")


def read_raw_tables(spark: SparkSession, raw_dir: str, strict: bool = True) -> dict[str, DataFrame]:
    """The eight raw tables of a folder, keyed as the feature job takes them. Applicants carry their place in
    the file, by which the cleaner keeps the first row of a key (C1)."""
    return {name: read_raw_csv(spark, f"{raw_dir.rstrip('/')}/{file}", strict=strict, position=name in ("app", "app_test"))
            for name, file in RAW_FILES.items()}


def read_raw_rejects(spark: SparkSession, raw_dir: str) -> DataFrame:
    """``raw_rejects`` of the eight raw tables, with the table's name."""
    out = None
    for name, file in RAW_FILES.items():
        part = raw_rejects(spark, f"{raw_dir.rstrip('/')}/{file}").select(F.lit(name).alias("table"), "*")
        out = part if out is None else out.unionByName(part)
    return out
