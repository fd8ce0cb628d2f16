import unicodedata

from pyspark.sql import functions as F

from catalogue.registry import places, register, table, title_of
from parcelry.functions import listing as L
from parcelry.plans import extraction

BASE = "https://listings.example"

# Line items as page mark-up: two cards per page, so that splitting matters.


def phrases(rows):
    n, q = F.col("l_linenumber").cast("string"), F.col("l_quantity").cast("int").cast("string")
    k, a = F.col("l_partkey") % 9, F.col("l_suppkey") % 6
    price = (
        F.when(k == 0, F.concat(n, F.lit(" triệu "), q, F.lit("0 nghìn")))
        .when(k == 1, F.concat(n, F.lit(" Tỷ "), q, F.lit(" triệu")))
        .when(k == 2, F.concat(n, F.lit(" tỷ rưỡi")))
        .when(k == 3, F.concat(n, F.lit(" triệu rưỡi/tháng")))
        .when(k == 4, F.concat(n, F.lit(" tỷ")))
        .when(k == 5, F.concat(q, F.lit(" triệu")))
        .when(k == 6, F.concat(n, F.lit(".5 tỷ")))
        .when(k == 7, q)
        .otherwise(F.lit("Thỏa thuận"))
    )
    unit = F.element_at(F.array(*[F.lit(u) for u in ["giờ", "ngày", "tuần", "tháng", "năm", "phút"]]), (a + 1).cast("int"))
    return rows.withColumns({"price_text": price, "age_text": F.concat(F.lit("Đăng "), n, F.lit(" "), unit, F.lit(" trước"))})


PRICE = """CASE l_partkey % 9 WHEN 0 THEN round(l_linenumber + CAST(l_quantity AS INTEGER) * 10 / 1000.0, 3)
 WHEN 1 THEN l_linenumber * 1000.0 + CAST(l_quantity AS INTEGER) WHEN 2 THEN l_linenumber * 1000.0 + 500
 WHEN 3 THEN l_linenumber + 0.5 WHEN 4 THEN l_linenumber * 1000.0 WHEN 5 THEN l_quantity
 WHEN 6 THEN l_linenumber WHEN 7 THEN l_quantity END"""
AGE = "CAST(CASE l_suppkey % 6 WHEN 0 THEN 1 WHEN 1 THEN 24 WHEN 2 THEN 168 WHEN 3 THEN 720 WHEN 4 THEN 8760 END * l_linenumber AS INTEGER)"
FLOORS = "CASE l_orderkey % 5 WHEN 0 THEN l_linenumber + 1 WHEN 1 THEN l_linenumber + 1 WHEN 2 THEN l_linenumber END"
TITLE = """CASE l_orderkey % 5 WHEN 0 THEN 'Bán nhà ' || CAST(l_linenumber AS VARCHAR) || ' tầng mặt tiền'
 WHEN 1 THEN 'Nhà ' || CAST(l_linenumber AS VARCHAR) || ' lầu 1 trệt' WHEN 2 THEN 'Căn hộ tầng ' || CAST(l_linenumber AS VARCHAR)
 WHEN 3 THEN 'Nhà MẶT  PHỐ đẹp' ELSE 'Đất nền giá tốt' END"""


def card(ident, href):
    t = F.lit
    return F.concat(
        t('<a class="box card-cm" href="'), href, t('">\n<div class="heart left"><span class="btn-save js-btn-save add-like" post_id="'), ident,
        t('"></span></div><h3 class="title line-2"><i class="vip">VIP</i> '), title_of(), t(" </h3>"),
        t('<div class="description"><b>'), F.col("n_name"), t("</b> , "), F.col("r_name"), t(" </div>"),
        t('<div class="description-item">'), F.col("l_quantity").cast("int").cast("string"), t(".5 m²</div>"),
        t('<div class="description-item">'), F.col("l_linenumber").cast("string"), t(" Phòng  ngủ</div>"),
        t('<div class="description-item">'), F.col("l_linenumber").cast("string"), t("WC</div>"),
        t('<div class="price">'), F.col("price_text"), t('</div><div class="time">'), F.col("age_text"), t("</div></a>"),
    )


def listing_pages(spark, folder):
    # The side without measures is held, whatever its estimated size: else a small lineitem is copied to the few tasks of the suppliers.
    located = table(spark, folder, "lineitem").join(places(spark, folder).hint("shuffle_hash"), F.col("l_suppkey") == F.col("s_suppkey"))
    rows = phrases(located)
    key, t = F.col("l_orderkey").cast("string"), F.lit
    html = F.concat(
        t('<html><body><ul class="pagination"><li><a href="#">1</a></li><li><a>'), F.col("l_partkey").cast("string"),
        t('</a></li><li><a>Next</a></li></ul><a class="card-cm" href="/outside">no</a><div class="gap-24 d-flex flex-column card-container">'),
        card(key, F.concat(t("/p/"), key)), t('<a class="banner" href="/ad">ad</a>'),
        card(F.concat(key, t("b")), F.concat(t("https://other.example/"), key)), t('</div><div class="related"><a class="card-cm" href="/related">no</a></div></body></html>'),
    )
    return rows.select(F.col("l_orderkey").alias("page_id"), F.concat(t(BASE + "/"), key).alias("url"), html.alias("html"))


CARDS = f"""WITH rows AS (SELECT *, unnest([0, 1]) AS c FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
 JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
cards AS (SELECT CAST(l_orderkey AS VARCHAR) || CASE WHEN c = 1 THEN 'b' ELSE '' END AS id,
 CASE WHEN c = 0 THEN '{BASE}/p/' ELSE 'https://other.example/' END || CAST(l_orderkey AS VARCHAR) AS detail_url,
 {TITLE} AS title, n_name || ', ' || r_name AS location, {AGE} AS timeline_hours, 5 AS area_m2, l_linenumber AS bedrooms,
 l_linenumber AS bathrooms, CAST({FLOORS} AS INTEGER) AS floors, l_orderkey % 5 IN (0, 3) AS frontage,
 CAST({PRICE} AS DOUBLE) AS price_million_vnd FROM rows)
"""


@register("x1_page_listings", f"{CARDS} SELECT * FROM cards")
def x1(spark, folder):
    return extraction.listings_from_pages(listing_pages(spark, folder), BASE)


@register(
    "x1_page_links",
    """SELECT page_id, CAST(len(regexp_extract_all(html, '(?s)<a\\s[^>]*>.*?</a>')) AS INTEGER) AS links FROM pages""",
)
def x1_links(spark, folder):
    links = F.regexp_extract_all("html", F.lit(r"(?s)<a\s[^>]*>.*?</a>"), F.lit(0))
    return table(spark, folder, "pages").select("page_id", F.size(links).alias("links"))


@register("x2_total_pages", "SELECT l_orderkey AS page_id, CAST(greatest(1, l_partkey) AS INTEGER) AS total FROM lineitem")
def x2(spark, folder):
    return listing_pages(spark, folder).select("page_id", F.coalesce(L.last_page("html"), F.lit(1)).alias("total"))


def all_cards(spark, folder):
    return listing_pages(spark, folder).select("page_id", F.explode(L.card_blocks("html")).alias("card"))


@register("x3_id", "SELECT l_orderkey AS page_id, CAST(l_orderkey AS VARCHAR) || unnest(['', 'b']) AS id FROM lineitem")
def x3(spark, folder):
    return all_cards(spark, folder).select("page_id", L.card_id("card").alias("id"))


@register("x4_title", f"SELECT l_orderkey AS page_id, {TITLE} AS title FROM lineitem, range(2)")
def x4(spark, folder):
    return all_cards(spark, folder).select("page_id", L.card_title("card").alias("title"))


@register(
    "x4_page_heading",
    """SELECT page_id, nullif(trim(replace(replace(replace(replace(replace(replace(
 regexp_replace(regexp_extract(html, '(?s)<h1(?:\\s[^>]*)?>(.*?)</h1>', 1), '<[^>]*>', '', 'g'),
 '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&nbsp;', chr(160)), '&amp;', '&')), '') AS title FROM pages""",
)
def x4_heading(spark, folder):
    return table(spark, folder, "pages").select("page_id", L.joined_text(L.element("html", "h1")).alias("title"))


@register(
    "x5_location",
    """SELECT l_orderkey AS page_id, n_name || ', ' || r_name AS location FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
 JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey, range(2)""",
)
def x5(spark, folder):
    return all_cards(spark, folder).select("page_id", L.card_location("card").alias("location"))


def spoken(spark, folder):
    return phrases(table(spark, folder, "lineitem"))


@register("x6_age_hours", f"SELECT l_orderkey, {AGE} AS timeline_hours FROM lineitem")
def x6(spark, folder):
    return spoken(spark, folder).select("l_orderkey", L.age_hours("age_text").alias("timeline_hours"))


@register(
    "x7_area",
    "SELECT l_orderkey, CASE WHEN l_linenumber % 2 = 0 THEN 5 WHEN l_linenumber = 1 THEN NULL ELSE CAST(l_quantity AS INTEGER) END AS area_m2 FROM lineitem",
)
def x7(spark, folder):
    q = F.col("l_quantity").cast("int").cast("string")
    kind = F.col("l_linenumber")
    text = F.when(kind % 2 == 0, F.concat(q, F.lit(".5 m²"))).when(kind == 1, F.concat(q, F.lit(" ha"))).otherwise(F.concat(q, F.lit("m²")))
    facts = F.array(F.lit("3 WC"), text)
    return table(spark, folder, "lineitem").select("l_orderkey", L.first_number(facts, L.AREA).alias("area_m2"))


@register("x8_bedrooms", "SELECT l_orderkey, CASE WHEN l_orderkey % 4 <> 0 THEN l_linenumber END AS bedrooms FROM lineitem")
def x8(spark, folder):
    word = F.when(F.col("l_orderkey") % 4 == 0, F.lit(" phòng ngủ")).otherwise(F.lit(" Phòng ngủ"))
    facts = F.array(F.lit("60 m²"), F.concat(F.col("l_linenumber").cast("string"), word))
    return table(spark, folder, "lineitem").select("l_orderkey", L.first_number(facts, L.BEDROOMS).alias("bedrooms"))


@register("x9_bathrooms", "SELECT l_orderkey, l_linenumber AS bathrooms FROM lineitem")
def x9(spark, folder):
    facts = F.array(F.lit("60 m²"), F.concat(F.col("l_linenumber").cast("string"), F.lit(" WC")), F.lit("9 WC"))
    return table(spark, folder, "lineitem").select("l_orderkey", L.first_number(facts, L.BATHROOMS).alias("bathrooms"))


@register("x10_title_floors", f"SELECT l_orderkey, CAST({FLOORS} AS INTEGER) AS floors FROM lineitem")
def x10(spark, folder):
    return table(spark, folder, "lineitem").select("l_orderkey", L.title_floors(title_of()).alias("floors"))


@register(
    "x11_detail_floors",
    f"""WITH detail AS (SELECT o_orderkey, CAST(CASE o_orderkey % 4 WHEN 0 THEN o_orderkey % 7 + 1 WHEN 1 THEN o_orderkey % 5 + 1
 WHEN 2 THEN o_orderkey % 3 + 1 END AS INTEGER) AS floors FROM orders)
SELECT l_orderkey, coalesce(CAST({FLOORS} AS INTEGER), floors) AS floors FROM lineitem LEFT JOIN detail ON l_orderkey = o_orderkey""",
)
def x11(spark, folder):
    key, t = F.col("o_orderkey"), F.lit
    text = lambda m: (key % m + 1).cast("string")
    body = (
        F.when(key % 4 == 0, F.concat(t("Nhà có <b>"), text(7), t("</b> Tầng, 9t")))
        .when(key % 4 == 1, F.concat(t("Kết cấu "), text(5), t("t kiên cố")))
        .when(key % 4 == 2, F.concat(t("Xây "), text(3), t("L đẹp")))
        .otherwise(t("Liên hệ 12tr"))
    )
    pages = table(spark, folder, "orders").select(
        F.concat(t("/p/"), key.cast("string")).alias("url"), F.concat(t('<div class="col-md-12 text"><p>'), body, t("</p></div>")).alias("html")
    )
    listings = table(spark, folder, "lineitem").select(
        "l_orderkey", F.concat(t("/p/"), F.col("l_orderkey").cast("string")).alias("detail_url"), L.title_floors(title_of()).alias("floors")
    )
    return extraction.complete_floors(listings, extraction.detail_text(pages)).select("l_orderkey", "floors")


@register("x12_frontage", "SELECT l_orderkey, l_orderkey % 5 IN (0, 3) AS frontage FROM lineitem")
def x12(spark, folder):
    return table(spark, folder, "lineitem").select("l_orderkey", L.has_frontage(title_of()).alias("frontage"))


@register("x13_price", f"SELECT l_orderkey, CAST({PRICE} AS DOUBLE) AS price_million_vnd FROM lineitem")
def x13(spark, folder):
    return spoken(spark, folder).select("l_orderkey", L.price_million("price_text").alias("price_million_vnd"))


@register(
    "x14_absolute_url",
    f"""SELECT page_id, CASE WHEN h = '' THEN NULL WHEN starts_with(h, '/') THEN '{BASE}' || h ELSE h END AS link
FROM (SELECT page_id, unnest(regexp_extract_all(html, '<a\\s[^>]*?href="([^"]*)"', 1)) AS h FROM pages)""",
)
def x14(spark, folder):
    links = F.regexp_extract_all("html", F.lit(r'<a\s[^>]*?href="([^"]*)"'), F.lit(1))
    rows = table(spark, folder, "pages").select("page_id", F.explode(links).alias("href"))
    return rows.select("page_id", L.absolute_url(F.nullif("href", F.lit("")), BASE).alias("link"))


@register(
    "x15_unseen_ids",
    "SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS id FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')",
)
def x15(spark, folder):
    seen = table(spark, folder, "orders").filter("o_orderstatus = 'F'").select(F.col("o_orderkey").cast("string").alias("id"))
    return extraction.unseen(table(spark, folder, "lineitem").select(F.col("l_orderkey").cast("string").alias("id")), seen)


def taken_apart(column):
    """The column with every accented letter of the phrases as a letter and its separate marks."""
    letters = sorted({c for c in "ầửổảáàạãâấậăắặẳệêếềểễộôốồọòóơợờớởưựừứữùúủũíìỉĩịýỳỷỹỵẦỐẶ" if unicodedata.normalize("NFD", c) != c})
    for c in letters:
        column = F.replace(column, F.lit(c), F.lit(unicodedata.normalize("NFD", c)))
    return column


@register("x6_age_hours_decomposed", f"SELECT l_orderkey, {AGE} AS timeline_hours FROM lineitem")
def x6_apart(spark, folder):
    return spoken(spark, folder).select("l_orderkey", L.age_hours(taken_apart(F.col("age_text"))).alias("timeline_hours"))


@register("x10_title_floors_decomposed", f"SELECT l_orderkey, CAST({FLOORS} AS INTEGER) AS floors, l_orderkey % 5 IN (0, 3) AS frontage FROM lineitem")
def x10_apart(spark, folder):
    """Storeys and frontage from titles whose accents are separate marks."""
    title = taken_apart(title_of())
    return table(spark, folder, "lineitem").select("l_orderkey", L.title_floors(title).alias("floors"), L.has_frontage(title).alias("frontage"))


@register("x13_price_decomposed", f"SELECT l_orderkey, CAST({PRICE} AS DOUBLE) AS price_million_vnd FROM lineitem")
def x13_apart(spark, folder):
    return spoken(spark, folder).select("l_orderkey", L.price_million(taken_apart(F.col("price_text"))).alias("price_million_vnd"))
