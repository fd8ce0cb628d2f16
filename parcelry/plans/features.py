"""From the listing table to a model-ready train and test table."""

from pyspark.sql import functions as F

from parcelry.functions import scalar as S
from parcelry.operators import clean
from parcelry.operators.prep import MICEImputation, OneHotEncoding, PreprocessingPipeline, RobustScaling
from parcelry.operators.prep.encoders import collapse_rare
from parcelry.operators.reshape import hash_unit, train_test_split
from parcelry.schema import MEASURE_COLUMNS, ROOM_COLUMNS
from parcelry.session import written

# Outlier cut-offs and the smallest category kept.
CAPS = {"floors": 0.995, "area_m2": 0.98, "bedrooms": 0.99, "bathrooms": 0.99}
MIN_LISTINGS = 15
CATEGORIES = ["province", "ward_province_clean"]
OTHER_WARD = "OtherWard | "


def with_location_and_date(df, reference=S.REFERENCE_DATE):
    ward, province = S.ward_and_province("location")
    df = df.withColumns({"ward": ward, "province": province}).drop("location")
    moment = S.listed_at("timeline_hours", reference)
    day, month, year = S.date_parts(moment)
    return df.withColumns({"day": day, "month": month, "year": year}).drop("timeline_hours")


def drop_unusable(df):
    df = clean.drop_all_missing(df, ROOM_COLUMNS)
    df = clean.drop_sparse_where_missing(df, "area_m2", ROOM_COLUMNS)
    df = clean.drop_sparse_where_missing(df, "price_million_vnd", ROOM_COLUMNS)
    return df.filter(F.col("price_million_vnd") > 0)


def cyclic_dates(df):
    day_sin, day_cos = S.cyclic_day("day", "month", "year")
    month_sin, month_cos = S.cyclic_month("month")
    return df.withColumns({"day_sin": day_sin, "day_cos": day_cos, "month_sin": month_sin, "month_cos": month_cos}).drop("day", "month")


def listing_features(df, caps=CAPS, minimum=MIN_LISTINGS):
    """Cleaned rows with every derived feature and ``log_price``; ``id`` stays as the row's key."""
    df = drop_unusable(with_location_and_date(df.drop("title", "detail_url")))
    df = clean.cap_at_quantiles(df, caps)
    df = df.withColumn("log_price", F.log1p("price_million_vnd")).drop("price_million_vnd")
    df = df.fillna("Unknown", ["ward", "province"]).withColumn("ward_province", S.area_key("ward", "province"))
    df = collapse_rare(df, "ward_province", minimum, F.concat(F.lit(OTHER_WARD), F.col("province")), "ward_province_clean")
    df = cyclic_dates(df.withColumn("frontage", S.flag("frontage")))
    return clean.add_missing_flags(df, MEASURE_COLUMNS)


def preprocessing():
    return PreprocessingPipeline(
        [
            MICEImputation(MEASURE_COLUMNS, max_iter=5, random_state=42, n_nearest_features=5),
            RobustScaling([*MEASURE_COLUMNS, "year"]),
            OneHotEncoding(CATEGORIES),
        ]
    )


def train_and_test(df, test_size=0.2, seed=42, key="id"):
    """(train, test, fitted steps) from a listing table; the steps see the training part only."""
    features = written(listing_features(df), "features")
    train, test = train_test_split(features, hash_unit(key, seed), test_size)
    steps = preprocessing().fit(train)
    finish = lambda part: steps.transform(part).drop("ward", "ward_province")
    return finish(train), finish(test), steps


def area_labels(train, prefix="ward_province_clean_"):
    """(key, label) for every one-hot area column: the label is the name without its prefix."""
    names = [c for c in train.columns if c.startswith(prefix)]
    keys = train.sparkSession.createDataFrame([(c,) for c in names], "key string")
    return keys.withColumn("label", F.expr(f"substring(key, {len(prefix) + 1})"))
