"""Feature encoding fitted on the training rows only.

Statistics are small aggregates (one row), applied as literals, so encoding
is a narrow projection with no join and no shuffle.
"""

from __future__ import annotations

from pyspark.ml import Transformer
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.operators.ordering import row_number
from wattline.schema import DAY_OF_WEEK_VALUES, FEATURE_NUMERIC, LOAD_TYPE_VALUES, q


def fit_scaler(train: DataFrame, cols: list[str]) -> dict[str, tuple[float, float]]:
    """E1 fit: mean and population std per column; zero variance -> scale 1."""
    row = train.agg(*[F.avg(q(c)).alias(f"m_{i}") for i, c in enumerate(cols)],
                    *[F.stddev_pop(q(c)).alias(f"s_{i}") for i, c in enumerate(cols)]).first()
    out = {}
    for i, c in enumerate(cols):
        s = row[f"s_{i}"]
        out[c] = (row[f"m_{i}"], s if s not in (None, 0.0) else 1.0)
    return out


def apply_scaler(df: DataFrame, stats: dict[str, tuple[float, float]], suffix: str = "") -> DataFrame:
    return df.withColumns({f"{c}{suffix}": (F.col(q(c)) - F.lit(m)) / F.lit(s) for c, (m, s) in stats.items()})


def onehot_fixed(df: DataFrame, col: str, categories: list[str], drop: str | None = "first",
                 prefix: str | None = None, unknown: str = "error") -> DataFrame:
    """Indicators for fixed categories; the dropped one is all-zero.
    Unknown values, null among them, fail (``unknown='error'``) or give all zeros ('ignore')."""
    prefix = prefix or col
    keep = categories[1:] if drop == "first" else [c for c in categories if c != drop] if drop else categories
    v = F.col(q(col))
    out = df
    if unknown == "error":
        out = out.withColumn(col, F.when(v.isin(categories), v).otherwise(
            F.raise_error(F.concat(F.lit(f"unknown category in {col}: "), F.coalesce(v, F.lit("null"))))))
    return out.withColumns({f"{prefix}_{c}": (F.col(q(col)) == F.lit(c)).cast("double") for c in keep})


def ordinal(df: DataFrame, col: str, categories: list[str], name: str | None = None,
            unknown_value: float = -1.0) -> DataFrame:
    """Position in `categories`, unknown -> -1."""
    v = F.col(q(col))
    expr = None
    for i, c in enumerate(categories):
        expr = F.when(v == c, F.lit(float(i))) if expr is None else expr.when(v == c, F.lit(float(i)))
    return df.withColumn(name or f"{col}_ord", expr.otherwise(F.lit(unknown_value)))


WEEK_ORDER = ["Weekend", "Weekday"]  # 'Weekend' is dropped -> indicator of Weekday


def encoded_columns() -> list[str]:
    """The 14 model features, in order: 6 numeric, Tue..Sun, Weekday, Load_Type."""
    return (list(FEATURE_NUMERIC) + [f"dow_{d}" for d in DAY_OF_WEEK_VALUES[1:]]
            + ["week_Weekday", "load_type_ord"])


class ReadingsEncoder(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """E5 as an ML Transformer that holds train-only statistics as parameters, so that it
    can be saved and loaded inside a pipeline."""

    means = Param(Params._dummy(), "means", "mean of each numeric feature", TypeConverters.toListFloat)
    scales = Param(Params._dummy(), "scales", "standard deviation of each numeric feature", TypeConverters.toListFloat)
    outputCol = Param(Params._dummy(), "outputCol", "output vector column", TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(outputCol="features")

    @classmethod
    def fit_on(cls, train: DataFrame) -> "ReadingsEncoder":
        stats = fit_scaler(train, list(FEATURE_NUMERIC))
        return cls()._set(means=[stats[c][0] for c in FEATURE_NUMERIC], scales=[stats[c][1] for c in FEATURE_NUMERIC])

    def encode(self, df: DataFrame) -> DataFrame:
        pairs = zip(self.getOrDefault(self.means), self.getOrDefault(self.scales), strict=True)
        out = apply_scaler(df, dict(zip(FEATURE_NUMERIC, pairs, strict=True)))
        out = onehot_fixed(out, "day_of_week", DAY_OF_WEEK_VALUES, drop="first", prefix="dow")
        out = onehot_fixed(out, "week_status", WEEK_ORDER, drop="first", prefix="week")
        return ordinal(out, "load_type", LOAD_TYPE_VALUES, name="load_type_ord")

    def _transform(self, df: DataFrame) -> DataFrame:
        enc = self.encode(df)
        return VectorAssembler(inputCols=encoded_columns(), outputCol=self.getOrDefault(self.outputCol)).transform(enc)


#: Most categories that become columns of their own.
MOST_CATEGORIES = 1000


def learned_onehot(train: DataFrame, df: DataFrame, cols: list[str]) -> DataFrame:
    """Categories learned from the training rows, a column each; unseen values and nulls
    encode as all zeros. A column with over MOST_CATEGORIES values is refused (ValueError):
    `sparse_indicators` takes any number."""
    out = df
    for c in cols:
        seen = train.select(q(c)).where(F.col(q(c)).isNotNull()).distinct().limit(MOST_CATEGORIES + 1).collect()
        if len(seen) > MOST_CATEGORIES:
            raise ValueError(f"{c} has over {MOST_CATEGORIES} values; it is not a category")
        cats = sorted(r[0] for r in seen)
        out = out.withColumns({f"{c}_{v}": (F.col(q(c)) == F.lit(v)).cast("double") for v in cats})
        out = out.na.fill(0.0, [f"{c}_{v}" for v in cats])
    return out


def category_dictionary(train: DataFrame, cols: list[str]) -> DataFrame:
    """(column, value, index): the categories of each column in the training rows, by column
    (as listed), then value, numbered from 0. Nulls are no category. A table of any size."""
    seen = None
    for i, c in enumerate(cols):
        one = train.select(F.lit(i).alias("place"), F.col(q(c)).cast("string").alias("value")).where("value is not null").distinct()
        seen = one if seen is None else seen.unionByName(one)
    names = F.array(*[F.lit(c) for c in cols])
    return row_number(seen, ["place", "value"], "index", base=0).select(F.get(names, F.col("place")).alias("column"), "value", "index")


def sparse_indicators(train: DataFrame, df: DataFrame, cols: list[str], out: str = "indicators") -> DataFrame:
    """E6 for columns of any number of categories: `out` holds a row's indicators as a sparse
    vector, a struct (size, indices, values) with ascending indices of `category_dictionary`.
    Unseen values and nulls have none. The dictionary is joined, never broadcast unmeasured."""
    known = category_dictionary(train, cols)
    size = known.agg(F.count(F.lit(1)).cast("int").alias("_size"))
    rows = df
    for i, c in enumerate(cols):
        one = known.where(F.col("column") == c).select(F.col("value").alias("_v"), F.col("index").cast("int").alias(f"_i{i}"))
        rows = rows.join(one, F.col(q(c)).cast("string") == F.col("_v"), "left").drop("_v")
    found = F.array_compact(F.array(*[F.col(f"_i{i}") for i in range(len(cols))]))
    rows = rows.crossJoin(F.broadcast(size))  # one row
    return rows.withColumn(out, F.struct(F.col("_size").alias("size"), found.alias("indices"), F.transform(found, lambda _: F.lit(1.0)).alias("values"))) \
               .drop("_size", *[f"_i{i}" for i in range(len(cols))])
