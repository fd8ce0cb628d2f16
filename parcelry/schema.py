"""The listing record and the column groups the rest of the package refers to."""

from pyspark.sql import types as T

LISTING = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("detail_url", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("location", T.StringType()),
        T.StructField("timeline_hours", T.IntegerType()),
        T.StructField("area_m2", T.IntegerType()),
        T.StructField("bedrooms", T.IntegerType()),
        T.StructField("bathrooms", T.IntegerType()),
        T.StructField("floors", T.IntegerType()),
        T.StructField("frontage", T.BooleanType()),
        T.StructField("price_million_vnd", T.DoubleType()),
    ]
)

ROOM_COLUMNS = ["bedrooms", "bathrooms", "floors"]
MEASURE_COLUMNS = ["area_m2", *ROOM_COLUMNS]
# Numeric columns that are identifiers or calendar parts, not measurements.
NON_MEASURES = ["id", "timeline_hours", "day", "month", "year"]

NUMERIC_TYPES = (T.NumericType,)


def numeric_columns(df, exclude=()):
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES) and f.name not in exclude]


def string_columns(df):
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def require_columns(df, columns):
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise KeyError(f"columns not found: {missing}")
