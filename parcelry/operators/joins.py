"""Joins and unions of listing tables."""

from functools import reduce

from pyspark.sql import functions as F

from parcelry.functions.scalar import strip
from parcelry.operators.lookup import lookup
from parcelry.operators.skew import split_join

# Provinces before the 2025 merger, grouped by the province they became.
MERGED_PROVINCES = {
    "Hà Nội": ["Hà Nội"],
    "Tuyên Quang": ["Tuyên Quang", "Hà Giang"],
    "Lai Châu": ["Lai Châu"],
    "Điện Biên": ["Điện Biên"],
    "Sơn La": ["Sơn La"],
    "Lạng Sơn": ["Lạng Sơn"],
    "Cao Bằng": ["Cao Bằng"],
    "Quảng Ninh": ["Quảng Ninh"],
    "Lào Cai": ["Lào Cai", "Yên Bái"],
    "Thái Nguyên": ["Thái Nguyên", "Bắc Kạn"],
    "Phú Thọ": ["Phú Thọ", "Vĩnh Phúc", "Hòa Bình"],
    "Bắc Ninh": ["Bắc Ninh", "Bắc Giang"],
    "Hưng Yên": ["Hưng Yên", "Thái Bình"],
    "Hải Phòng": ["Hải Phòng", "Hải Dương"],
    "Ninh Bình": ["Ninh Bình", "Hà Nam", "Nam Định"],
    "Thanh Hoá": ["Thanh Hoá"],
    "Nghệ An": ["Nghệ An"],
    "Hà Tĩnh": ["Hà Tĩnh"],
    "Huế": ["Huế"],
    "Quảng Trị": ["Quảng Trị", "Quảng Bình"],
    "Đà Nẵng": ["Đà Nẵng", "Quảng Nam"],
    "Quảng Ngãi": ["Quảng Ngãi", "Kon Tum"],
    "Gia Lai": ["Gia Lai", "Bình Định"],
    "Đắk Lắk": ["Đắk Lắk", "Phú Yên"],
    "Khánh Hòa": ["Khánh Hòa", "Ninh Thuận"],
    "Lâm Đồng": ["Lâm Đồng", "Đắk Nông", "Bình Thuận"],
    "Đồng Nai": ["Đồng Nai", "Bình Phước"],
    "Hồ Chí Minh": ["Hồ Chí Minh", "Bà Rịa Vũng Tàu", "Bình Dương"],
    "Tây Ninh": ["Tây Ninh", "Long An"],
    "Đồng Tháp": ["Đồng Tháp", "Tiên Giang"],
    "Vĩnh Long": ["Vĩnh Long", "Bến Tre", "Trà Vinh"],
    "Cần Thơ": ["Cần Thơ", "Sóc Trăng", "Hậu Giang"],
    "Cà Mau": ["Cà Mau", "Bạc Liêu"],
    "An Giang": ["An Giang", "Kiên Giang"],
}

# The provinces the regional views keep.
SOUTH = ["Hồ Chí Minh", "Bình Dương", "Bà Rịa Vũng Tàu", "Đồng Nai", "Bình Phước", "Cần Thơ", "Sóc Trăng", "Hậu Giang"]
CENTRAL_COAST = ["Đà Nẵng", "Huế", "Quảng Nam", "Bình Định", "Gia Lai"]
NORTH = ["Hà Nội", "Bắc Ninh", "Bắc Giang", "Hưng Yên", "Thái Bình", "Hải Phòng", "Hải Dương"]
SELECTED_PROVINCES = SOUTH + CENTRAL_COAST + NORTH


def join_views(left, right, on="id"):
    """Inner join of two views of the listings; repeated ids multiply.

    Both sides grow with the data. Ids that are hot on either side are split
    over tasks, the others joined as Spark sees fit.
    """
    return split_join(left, right, on)


def keep_matching(df, table, on):
    return lookup(df, table.select(on).distinct() if isinstance(on, str) else table.select(*on).distinct(), on, "left_semi")


def drop_matching(df, table, on):
    """Anti join that also keeps rows without a key."""
    return lookup(df, table.select(on).distinct() if isinstance(on, str) else table.select(*on).distinct(), on, "left_anti")


def renaming_table(spark, groups):
    """(old, new) rows, old names lower-cased; the first group that lists a name wins."""
    first = {}
    for new, olds in groups.items():
        for old in olds:
            first.setdefault(old.strip().lower(), new)
    return spark.createDataFrame(sorted(first.items()), "old string, new string")


def translate(df, column, table, name, default="Other"):
    """Look ``column`` up in an (old, new) table, ignoring case and outer spaces on both sides.

    Names given twice take the smallest new name, since a table has no first row.
    """
    names = table.groupBy(F.lower(strip("old")).alias("__old")).agg(F.min("new").alias("__new"))
    joined = lookup(df.withColumn("__old", F.lower(strip(column))), names, "__old", "left")
    return joined.withColumn(name, F.coalesce(F.col("__new"), F.lit(default))).drop("__old", "__new")


def merged_province(df, column="province", name="province_after_merger"):
    return translate(df, column, renaming_table(df.sparkSession, MERGED_PROVINCES), name)


def grid(*frames):
    """All combinations of parameter frames. They are parameter lists, not data."""
    return reduce(lambda a, b: a.crossJoin(b), frames)


def stack_frames(*frames):
    """Union by column name; columns a frame lacks are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
