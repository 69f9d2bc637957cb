"""Encoders E1-E6 and column alignment J5/J6.

Codes come from a written dictionary (``Dictionary``): the distinct (column,
level) pairs, ranked in byte order over range partitions, one folder per column.
Encoding is an equi-join per column with its levels; Spark broadcasts a column's
levels if their files are small and otherwise shuffles, with AQE splitting a
level that many rows hold. No level reaches the driver, only the number of
levels of each column. Only wide one-hot columns, whose names are levels, need
them there; ``one_hot_positions`` and ``one_hot_vector`` are the same view
without.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.operators.clean import is_numeric
from riskframe.operators.prefix import numbered
from riskframe.session import durable, intermediate_dir


def categorical_columns(df: DataFrame) -> list[str]:
    """String and boolean columns (the reference's object/bool/category dtypes)."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.BooleanType))]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if is_numeric(f.dataType)]


def category_levels(df: DataFrame, cols: list[str]) -> dict[str, list[str]]:
    """Sorted distinct non-null levels per column, on the driver: the names of wide one-hot columns."""
    if not cols:
        return {}
    pairs = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in cols])).alias("p"))
    out: dict[str, list[str]] = {c: [] for c in cols}
    for r in pairs.select("p.c", "p.v").where(F.col("v").isNotNull()).distinct().toLocalIterator():
        out[r["c"]].append(r["v"])
    return {c: sorted(v, key=lambda x: x.encode()) for c, v in out.items()}


@dataclass
class Dictionary:
    """Levels and codes of categorical columns, as tables under ``path``."""

    path: str                   # <path>/column=<i>: level, code
    sizes: dict[str, int]       # columns in their order, with their number of levels

    def levels(self, spark: SparkSession, col: str) -> DataFrame:
        """(level, code) of one column, by ascending code in byte order of the levels."""
        if not self.sizes[col]:
            return spark.createDataFrame([], "level string, code long")
        at = list(self.sizes).index(col)
        return spark.read.schema("level string, code long").parquet(f"{self.path}/column={at}")

    def save(self, spark: SparkSession, path: str) -> "Dictionary":
        """A copy under another folder."""
        for i, (col, n) in enumerate(self.sizes.items()):
            if n:
                self.levels(spark, col).write.mode("overwrite").parquet(f"{path}/column={i}")
        return Dictionary(path, self.sizes)


def fit_dictionary(df: DataFrame, cols: list[str] | None = None) -> Dictionary:
    """The sorted distinct non-null levels of the columns and their positions (E1), found in one pass.

    (column, level) pairs are combined before they are shuffled, ranked over all columns at once, and a
    column's codes start at its own first position."""
    cols = categorical_columns(df) if cols is None else cols
    spark = df.sparkSession
    path = f"{intermediate_dir(spark)}/dictionaries/{uuid.uuid4().hex}"
    if not cols:
        return Dictionary(path, {})
    pairs = df.select(F.explode(F.array(*[F.struct(F.lit(i).alias("column"), F.col(c).cast("string").alias("level")) for i, c in enumerate(cols)])).alias("p"))
    distinct = pairs.select("p.column", "p.level").where(F.col("level").isNotNull()).distinct()
    ranked = durable(numbered(distinct, "column", "level"))
    starts = ranked.groupBy("column").agg(F.min("position").alias("start"), F.count(F.lit(1)).alias("n")).collect()      # one row a column
    found = {r["column"]: r["n"] for r in starts}
    start = F.create_map(*[F.lit(x) for r in starts for x in (r["column"], r["start"])]) if starts else None
    if starts:
        ranked.select("column", "level", (F.col("position") - start[F.col("column")]).alias("code")) \
            .write.mode("overwrite").partitionBy("column").parquet(path)
    return Dictionary(path, {c: found.get(i, 0) for i, c in enumerate(cols)})


def ordinal_encode(df: DataFrame, cols: list[str] | None = None, dictionary: Dictionary | None = None,
                   null_as_level: bool = False, suffix: str = "") -> DataFrame:
    """Each categorical value -> its position in the sorted level list.

    With ``null_as_level`` (E3) NULL and unseen levels get the extra code ``number of levels`` so that no
    code is negative or missing."""
    cols = categorical_columns(df) if cols is None else cols
    dictionary = fit_dictionary(df, cols) if dictionary is None else dictionary
    out, code = df, {}
    for i, c in enumerate(cols):
        if dictionary.sizes[c]:
            code[c], level = f"_code{i}", f"_level{i}"
            levels = dictionary.levels(df.sparkSession, c).select(F.col("level").alias(level), F.col("code").alias(code[c]))
            out = out.join(levels, F.col(c).cast("string") == F.col(level), "left").drop(level)
    names = []
    for c in df.columns:
        if c not in cols:
            names.append(F.col(c))
            continue
        e = F.col(code[c]) if c in code else F.lit(None)
        if null_as_level:
            e = F.coalesce(e, F.lit(dictionary.sizes[c]))
        names.append(e.cast("int").alias(c + suffix))
    return out.select(*names)


def ordinal_dims(encoded: DataFrame, cols: list[str]) -> DataFrame:
    """E3's second output: per categorical column its position and cardinality
    (max code + 1), from one aggregation."""
    if not cols:
        return encoded.sparkSession.createDataFrame([], "feature string, position int, cardinality int")
    row = encoded.agg(*[F.max(c).alias(c) for c in cols]).first()
    pos = {c: i for i, c in enumerate(encoded.columns)}
    data = [(c, pos[c], int(row[c]) + 1 if row[c] is not None else 0) for c in cols]
    return encoded.sparkSession.createDataFrame(data, "feature string, position int, cardinality int")


def one_hot(df: DataFrame, cols: list[str] | None = None, levels: dict[str, list[str]] | None = None,
            dtype: str = "int") -> DataFrame:
    """One 0/1 column ``<col>_<level>`` per level (all levels kept);
    NULL gives all zeros. Non-encoded columns come first, as in the reference."""
    cols = categorical_columns(df) if cols is None else cols
    levels = category_levels(df, cols) if levels is None else levels
    keep = [F.col(c) for c in df.columns if c not in cols]
    dummies = []
    for c in cols:
        s = F.col(c).cast("string")
        for lv in levels[c]:
            dummies.append(F.when(s == F.lit(lv), 1).otherwise(0).cast(dtype).alias(f"{c}_{lv}"))
    return df.select(*keep, *dummies)


def one_hot_positions(df: DataFrame, cols: list[str] | None = None, dictionary: Dictionary | None = None, out: str = "onehot") -> DataFrame:
    """E2 without level names: the encoded columns become one ``array<long>`` of the positions that hold a 1.

    A column's block of positions starts after the blocks of those before it, a level stands at its
    code; NULL and unseen levels have none. Position i is the i-th column of ``one_hot``."""
    cols = categorical_columns(df) if cols is None else cols
    dictionary = fit_dictionary(df, cols) if dictionary is None else dictionary
    starts, total = {}, 0
    for c in cols:
        starts[c], total = total, total + dictionary.sizes[c]
    coded = ordinal_encode(df, cols, dictionary)
    at = F.array(*[F.col(c).cast("long") + F.lit(starts[c]) for c in cols])
    return coded.select(*[c for c in df.columns if c not in cols], F.array_compact(at).alias(out))


def one_hot_vector(df: DataFrame, cols: list[str] | None = None, dictionary: Dictionary | None = None, out: str = "onehot") -> DataFrame:
    """E2 as one sparse ML vector over all levels of all columns, in the order of ``one_hot_positions``."""
    from pyspark.ml.feature import OneHotEncoder, VectorAssembler
    cols = categorical_columns(df) if cols is None else cols
    dictionary = fit_dictionary(df, cols) if dictionary is None else dictionary
    cols_in = [c for c in cols if dictionary.sizes[c]]
    coded = ordinal_encode(df, cols, dictionary, null_as_level=True)
    # the sizes are stated, so fitting reads nothing; the last category is "no level" and is dropped
    nominal = {c: {"ml_attr": {"type": "nominal", "num_vals": dictionary.sizes[c] + 1}} for c in cols_in}
    kept = [c for c in df.columns if c not in cols]
    x = coded.select(*kept, *[F.col(c).cast("double").alias(f"_c_{c}", metadata=nominal[c]) for c in cols_in])
    if not cols_in:
        raise ValueError("no column has a level")
    blocks = [f"_v_{c}" for c in cols_in]
    x = OneHotEncoder(inputCols=[f"_c_{c}" for c in cols_in], outputCols=blocks, dropLast=True).fit(x).transform(x)
    return VectorAssembler(inputCols=blocks, outputCol=out).transform(x).select(*kept, out)


def align_columns(*dfs: DataFrame, fill=0) -> tuple[DataFrame, ...]:
    """Every frame gets the union of all columns, sorted by name; a
    missing column is the constant ``fill`` (existing NULLs stay NULL)."""
    types: dict[str, T.DataType] = {}
    for d in dfs:
        for f in d.schema.fields:
            types.setdefault(f.name, f.dataType)
    names = sorted(types)
    out = []
    for d in dfs:
        have = set(d.columns)
        out.append(d.select(*[F.col(n) if n in have else F.lit(fill).cast(types[n]).alias(n) for n in names]))
    return tuple(out)


def align_to_features(df: DataFrame, feature_list: list[str]) -> DataFrame:
    """The saved training order, restricted to columns that exist."""
    have = set(df.columns)
    return df.select(*[c for c in feature_list if c in have])


def numeric_coercion(df: DataFrame, cols: list[str] | None = None, dtype: str = "float") -> DataFrame:
    """Booleans -> 0/1, numbers kept, anything else parsed as a number or NULL; all as float32."""
    cols = df.columns if cols is None else cols
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if f.name not in cols:
            out.append(c)
        elif isinstance(f.dataType, T.BooleanType):
            out.append(c.cast("int").cast(dtype).alias(f.name))
        elif is_numeric(f.dataType):
            out.append(c.cast(dtype).alias(f.name))
        else:
            out.append(F.expr(f"try_cast(`{f.name}` AS DOUBLE)").cast(dtype).alias(f.name))
    return df.select(*out)


def fill_zero(df: DataFrame) -> DataFrame:
    """E5: NULL -> 0 in numeric columns."""
    return df.fillna(0)


def feature_columns(df: DataFrame, drop: tuple[str, ...] = ("TARGET", "SK_ID_CURR", "fold", "row_id")
                    ) -> list[str]:
    """The model inputs: every column but target, ids and fold (T9, T10 fixed)."""
    return [c for c in df.columns if c not in drop]


def assemble(df: DataFrame, features: list[str], out: str = "features") -> DataFrame:
    """Numeric feature vector (NULL kept as NaN for the caller to fill)."""
    from pyspark.ml.feature import VectorAssembler
    va = VectorAssembler(inputCols=features, outputCol=out, handleInvalid="keep")
    return va.transform(df)
