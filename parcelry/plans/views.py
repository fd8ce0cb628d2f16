"""The exploration tables: location, price, size and timeline views of the listings."""

from pyspark.sql import functions as F

from parcelry.functions import scalar as S
from parcelry.operators.clean import mask_negatives
from parcelry.operators.joins import SELECTED_PROVINCES, merged_province
from parcelry.operators.quantiles import column_quantiles
from parcelry.plans.features import with_location_and_date

# The columns of each exploration table.
LOCATION = ["id", "ward", "province", "area_m2", "price_million_vnd", "bedrooms", "bathrooms", "floors", "frontage"]
PRICE = ["id", "price_million_vnd", "area_m2", "bedrooms", "bathrooms", "floors", "frontage", "price_segment"]
SIZE = ["id", "area_m2", "bedrooms", "bathrooms", "floors"]
TIMELINE = ["id", "day", "month", "year", "price_million_vnd", "ward", "province", "area_m2"]


def exploration_table(listings, missing_segment="High"):
    """Listings with location, date, price segment and merged province; negatives are missing."""
    df = mask_negatives(with_location_and_date(listings))
    q1, q3 = column_quantiles(df, ["price_million_vnd"], [0.25, 0.75])["price_million_vnd"]
    df = df.withColumn("price_segment", S.quantile_segment("price_million_vnd", q1, q3, missing_segment))
    return merged_province(df)


def regional(df, provinces=SELECTED_PROVINCES):
    return df.filter(F.col("province").isin(provinces))


def topic(df, columns):
    return df.select(*columns)
