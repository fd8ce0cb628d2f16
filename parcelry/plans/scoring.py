"""Batch price predictions and what-if grids."""

from functools import reduce

from pyspark.sql import Window, functions as F

from parcelry.functions import scalar as S
from parcelry.operators.clean import add_missing_flags
from parcelry.operators.joins import grid, stack_frames
from parcelry.operators.lookup import lookup
from parcelry.operators.regression import predict
from parcelry.plans.features import OTHER_WARD, cyclic_dates
from parcelry.schema import MEASURE_COLUMNS

# The house profiles and value ranges of the what-if reports.
PROFILES = {
    "Small": {"area_m2": 50, "bedrooms": 2, "bathrooms": 1, "floors": 2, "frontage": False},
    "Medium": {"area_m2": 75, "bedrooms": 3, "bathrooms": 2, "floors": 3, "frontage": True},
    "Large": {"area_m2": 100, "bedrooms": 4, "bathrooms": 3, "floors": 4, "frontage": True},
}
SENSITIVITY = {
    "area_m2": list(range(30, 201, 30)),
    "bedrooms": list(range(1, 7)),
    "bathrooms": list(range(1, 6)),
    "floors": list(range(1, 8)),
}
HOUSE = "house_type string, area_m2 int, bedrooms int, bathrooms int, floors int, frontage boolean"


def scoring_features(houses, known_areas):
    """Model inputs from ward, province, date and measures; an area outside ``known_areas`` (label) is collapsed."""
    houses = houses.withColumn("__area", S.area_key("ward", "province"))
    known = known_areas.select(F.col("label").alias("__area"), F.lit(True).alias("__known")).distinct()
    joined = lookup(houses, known, "__area")
    clean_area = F.when(F.col("__known"), F.col("__area")).otherwise(F.concat(F.lit(OTHER_WARD), F.coalesce("province", F.lit(""))))
    df = joined.withColumns({"ward_province_clean": clean_area, "frontage": S.flag("frontage")}).drop("__area", "__known")
    return add_missing_flags(cyclic_dates(df), MEASURE_COLUMNS)


def predict_prices(houses, steps, score, known_areas, name="predicted_price"):
    """Predicted price per row. ``steps`` are fitted; ``score`` adds ``prediction`` (log price) to a table.

    Columns of ``houses`` that the features replace are restored by name.
    """
    kept = houses.withColumn("__row", F.struct(*[F.col(f"`{c}`") for c in houses.columns]))
    scored = score(steps.transform(scoring_features(kept, known_areas)))
    return scored.select("__row.*", F.expm1("prediction").alias(name))


def profile_frame(spark, profiles=PROFILES):
    rows = [(name, *[p[k] for k in ("area_m2", "bedrooms", "bathrooms", "floors", "frontage")]) for name, p in profiles.items()]
    return spark.createDataFrame(rows, HOUSE)


def ward_grid(wards, year, month, profiles=PROFILES, day=15):
    """Every profile in every (ward, province) row."""
    return grid(profile_frame(wards.sparkSession, profiles), wards).withColumns(
        {"year": F.lit(year), "month": F.lit(month), "day": F.lit(day)}
    )


def monthly_grid(wards, year, profiles=PROFILES, day=15):
    """Every profile in every ward in every month of a year."""
    months = F.explode(F.sequence(F.lit(1), F.lit(12)))
    return grid(profile_frame(wards.sparkSession, profiles), wards).withColumns({"year": F.lit(year), "day": F.lit(day)}).withColumn("month", months)


def sensitivity_grid(ward, province, year, month, spark, profiles=PROFILES, ranges=SENSITIVITY, day=15):
    """Every profile with one measure at a time set to each value of its range."""
    base = profile_frame(spark, profiles).withColumns(
        {"ward": F.lit(ward), "province": F.lit(province), "year": F.lit(year), "month": F.lit(month), "day": F.lit(day)}
    )
    frames = []
    for feature, values in ranges.items():
        value = F.explode(F.lit([int(v) for v in values]))
        frames.append(base.withColumns({"feature": F.lit(feature)}).withColumn(feature, value).withColumn("value", F.col(feature)))
    return stack_frames(*frames)


def scenarios(houses):
    """Eight variants of every house: as it is, one room or floor more, without and with frontage, enlarged."""
    more = lambda c, by, least=0: S.at_least(F.col(c) + F.lit(by), least)
    # Names and steps of the scenarios.
    changes = {
        "Base Case": {},
        "+1 Bedroom": {"bedrooms": more("bedrooms", 1)},
        "+1 Bathroom": {"bathrooms": more("bathrooms", 1)},
        "+1 Floor": {"floors": more("floors", 1)},
        "No Frontage": {"frontage": F.lit(False)},
        "With Frontage": {"frontage": F.lit(True)},
        "Renovated (+10m²)": {"area_m2": more("area_m2", 10, 10)},
        "Major Renovation (+30m²)": {"area_m2": more("area_m2", 30, 10)},
    }
    fields = houses.columns
    types = {f.name: f.dataType for f in houses.schema.fields}
    variants = [
        F.struct(F.lit(name).alias("scenario"), *[change.get(c, F.col(c)).cast(types[c]).alias(c) for c in fields]) for name, change in changes.items()
    ]
    return houses.select(F.inline(F.array(*variants)))


def scenario_deltas(scored, key, price="predicted_price"):
    """Price of each scenario less the base case of the same house: one pass over the eight rows of a house."""
    base = F.max(F.when(F.col("scenario") == "Base Case", F.col(price))).over(Window.partitionBy(*key))
    return scored.withColumn("price_delta", F.col(price) - base)
