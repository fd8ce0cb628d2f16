"""Reading and writing listing tables and label dictionaries."""

from pyspark.sql import functions as F, types as T

from parcelry.functions.scalar import nan_to_null
from parcelry.operators.lookup import collect_bounded
from parcelry.schema import LISTING

FORMATS = ("csv", "json", "parquet")


def without_nan(df):
    """NaN as NULL: Spark sorts NaN above every number, while here it means a missing cell."""
    kinds = (T.DoubleType, T.FloatType)
    return df.withColumns({f.name: nan_to_null(f.name) for f in df.schema.fields if isinstance(f.dataType, kinds)})


def read_field(text, kind):
    """The value of a cell as it was written: whole numbers also as ``60.0``, flags also as ``True`` or ``1``; NULL if unreadable."""
    text = F.trim(text)
    number = nan_to_null(text.try_cast("double"))
    if isinstance(kind, (T.IntegerType, T.LongType)):
        return F.when(number == F.floor(number), number.try_cast(kind))
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return number.cast(kind)
    if isinstance(kind, T.BooleanType):
        return F.when(F.lower(text).isin("true", "t", "yes", "y"), True).when(F.lower(text).isin("false", "f", "no", "n"), False).when(number == 1, True).when(number == 0, False)
    return text.try_cast(kind)


def typed(rows, schema, prefix=""):
    """Columns of text converted one by one; strings stay as they are."""
    texts = {f.name: F.col(f"{prefix}`{f.name}`") for f in schema.fields}
    return rows.select(*[(texts[f.name] if isinstance(f.dataType, T.StringType) else read_field(texts[f.name], f.dataType)).alias(f.name) for f in schema.fields])


def as_text(schema):
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])


def csv_cells(spark, path, schema):
    return spark.read.schema(as_text(schema)).option("header", True).option("escape", '"').csv(path)


def read_listings_csv(spark, path, schema=LISTING):
    """Listing table with a header; the schema is given, never inferred, and each cell is converted by ``read_field``."""
    return typed(csv_cells(spark, path, schema), schema)


def unreadable_cells(spark, path, schema=LISTING):
    """For each column of a CSV table, how many cells hold something that its type cannot take."""
    texts = csv_cells(spark, path, schema)
    kept = [f for f in schema.fields if not isinstance(f.dataType, T.StringType)]
    lost = [F.count_if((F.trim(f"`{f.name}`") != "") & (F.lower(F.trim(f"`{f.name}`")) != "nan") & read_field(F.col(f"`{f.name}`"), f.dataType).isNull()).alias(f.name) for f in kept]
    return texts.agg(*lost).unpivot([], [f.name for f in kept], "column", "cells")


def load_buying_properties(spark, path):
    return read_listings_csv(spark, path)


def load_rental_properties(spark, path):
    return read_listings_csv(spark, path)


def json_records(spark, path, schema):
    """Each non-empty line as ``r``, a record of texts with ``_bad``, which is set where the line is no JSON."""
    marked = as_text(schema).add("_bad", T.StringType())
    record = F.from_json("value", marked, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    return spark.read.text(path).filter(F.trim("value") != "").select(record.alias("r"))


def read_jsonl(spark, path, schema=LISTING):
    """One record per line; lines that are not valid JSON are skipped, all others kept, field by field as ``read_field`` reads them."""
    return typed(json_records(spark, path, schema).filter(F.col("r._bad").isNull()), schema, "r.")


def rejected_lines(spark, path, schema=LISTING):
    """How many lines of a log are kept and how many are no JSON."""
    bad = F.col("r._bad").isNotNull()
    return json_records(spark, path, schema).agg(F.count_if(~bad).alias("kept"), F.count_if(bad).alias("rejected"))


def seen_ids(records):
    """Distinct non-empty ids of a checkpoint log."""
    return records.filter(F.coalesce(F.col("id"), F.lit("")) != "").select("id").distinct()


def append_jsonl(df, path):
    df.write.mode("append").option("ignoreNullFields", False).json(path)
    return path


def write_table(df, path, format="csv", partition_by=()):
    """Write to ``path.format`` and return it; an unknown format is refused before any work. JSON is written with gzip, which its readers undo."""
    if format not in FORMATS:
        raise ValueError(f"unsupported format {format!r}: use one of {', '.join(FORMATS)}")
    target = f"{path}.{format}"
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if format == "csv":
        writer = writer.option("header", True).option("escape", '"')
    if format == "json":
        writer = writer.option("compression", "gzip")
    getattr(writer, format)(target)
    return target


def save_dataset(df, filename, folder, formats=(), label_maps=None):
    """Write a table in several formats, and its label dictionaries beside it.

    The table is computed once if parquet is among the formats: the others are written from what is read back.
    """
    for format in formats:
        if format not in FORMATS:
            raise ValueError(f"unsupported format {format!r}: use one of {', '.join(FORMATS)}")
    base = f"{folder.rstrip('/')}/{filename}"
    if "parquet" in formats and len(formats) > 1:
        df = df.sparkSession.read.schema(df.schema).parquet(write_table(df, base, "parquet"))
        paths = [f"{base}.parquet" if format == "parquet" else write_table(df, base, format) for format in formats]
    else:
        paths = [write_table(df, base, format) for format in formats]
    for name, labels in (label_maps or {}).items():
        paths.append(write_label_map(labels, f"{base}_{name}_mapping"))
    return paths


def write_label_map(labels, path):
    """A dictionary table (key, label) as JSON lines; keys are stored as text."""
    key, label = labels.columns
    labels.select(F.col(f"`{key}`").cast("string").alias("key"), F.col(f"`{label}`").alias("label")).write.mode("overwrite").json(path)
    return path


def read_label_map(spark, path, label_type="string"):
    return spark.read.schema(f"key string, label {label_type}").json(path)


def read_stop_words(spark, path):
    """Non-empty lines of a word list; the list is a parameter of the text operators and must be small."""
    rows = collect_bounded(spark.read.text(path).select(F.trim("value").alias("w")).filter("w != ''").distinct())
    if rows is None:
        raise ValueError(f"{path} is too big for a word list")
    return [r[0] for r in rows]
