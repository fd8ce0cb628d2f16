import random
import re

import pytest
from pyspark.sql import functions as F

from catalogue import extract
from parcelry.functions import listing as L, scalar as S, text as T
from parcelry.operators.joins import merged_province
from parcelry.plans import extraction

PRICES = {
    "5 tỷ": 5000, "5 tỷ rưỡi": 5500, "3 tỷ 200 triệu": 3200, "7 triệu 500 nghìn": 7.5, "7 triệu 250 ngàn": 7.25, "7 triệu rưỡi": 7.5,
    "18 triệu": 18, "2.5 tỷ": 2, "thỏa thuận": None, "giá 5 tỷ": None, "12": 12, "5 TỶ": 5000, "3 tỷ 5": 3000, "4 triệu 2 tỷ": 4, "9 nghìn": 9,
    "3tỷ200triệu": 3200, "5 triệu 3 triệu": 5, "99999999999 tỷ": 99999999999000.0, None: None,
}
AGES = {"3 giờ": 3, "2 Ngày trước": 48, "1 tuần": 168, "2 tháng": 1440, "1 NĂM": 8760, "5 phút": None, "99999999999 năm": None, None: None}
FLOORS = {"nhà 3 tầng": 4, "3 lầu 1 trệt": 4, "tầng 5": 5, "3 lầu 1 lửng": 4, "NHÀ 2 TẦNG": 3, "đất": None, None: None, "lầu 2, 4 tầng": 5}
DETAILS = {"nhà 3 tầng đẹp": 3, "cao 4t, 2 lầu": 2, "kết cấu 4t": 4, "xây 2 l": 2, "12tr": None, "5 tầng1": None, None: None}
FRONTS = {"Mặt tiền": True, "mặt phố": True, "MẶT ĐƯỜNG": True, "mặt  hồ": False, None: False}


def values(spark, cases, build):
    rows = [(i, t) for i, t in enumerate(cases)]
    out = spark.createDataFrame(rows, "i int, t string").select("i", build(F.col("t")).alias("v")).orderBy("i").collect()
    return {t: r["v"] for (i, t), r in zip(rows, out)}


def with_hard_spaces(cases):
    return {(k.replace(" ", " ") if k else k): v for k, v in cases.items()}


@pytest.mark.parametrize("spaced", [dict, with_hard_spaces])
@pytest.mark.parametrize(
    "cases, build",
    [(PRICES, L.price_million), (AGES, L.age_hours), (FLOORS, L.title_floors), (DETAILS, L.detail_floors), (FRONTS, L.has_frontage)],
    ids=["price", "age", "floors", "details", "frontage"],
)
def test_phrases(spark, cases, build, spaced):
    cases = spaced(cases)
    assert values(spark, cases, build) == cases


def test_first_matching_fact_wins(spark):
    df = spark.createDataFrame([(["3 WC", "70.5 m²", "60 m²", "2 Phòng  ngủ"],)], "f array<string>")
    row = df.select(*[L.first_number("f", p) for p in (L.AREA, L.BEDROOMS, L.BATHROOMS)]).first()
    assert tuple(row) == (5, 2, 3)


CARD = (
    '<a data-x="1" class="card-cm vip" href="/a?x=1&amp;y=2"><div class="heart"><span class="btn-save js-btn-save add-like" post_id="77"></span></div>'
    '<h3 class="title"><i class="star">*</i> Nhà <b>3 tầng</b> &lt;mới&gt; </h3><div class="description">Ba Đình\n <!-- x --> , Hà Nội</div>'
    '<div class="description-item">60 m²</div><div class="price"> 5 tỷ </div><div class="time">2 ngày</div></a>'
)


def test_page_to_listings(spark):
    html = (
        f'<a class="card-cm" href="/no">x</a><ul class="pagination"><li><a>1</a></li><li><a> 12 </a></li><li><a>»</a></li></ul>'
        f'<div class="gap-24 d-flex flex-column card-container">{CARD}<a class="card-cmx" href="/b">b</a><a class="card-cm">c</a></div>'
    )
    pages = spark.createDataFrame([("u", html), ("v", "<p>none</p>"), ("w", None)], "url string, html string")
    rows = extraction.listings_from_pages(pages, "https://h.example/").collect()
    assert len(rows) == 1
    assert tuple(rows[0]) == ("77", "https://h.example/a?x=1&y=2", "Nhà3 tầng<mới>", "Ba Đình, Hà Nội", 48, 60, None, None, 4, False, 5000.0)
    assert [r[0] for r in pages.select(L.last_page("html")).collect()] == [12, None, None]


def test_unseen_keeps_each_new_id_once(spark):
    rows = spark.createDataFrame([("1",), ("2",), ("2",), ("",), (None,)], "id string")
    seen = spark.createDataFrame([("1",)], "id string")
    assert [r[0] for r in extraction.unseen(rows, seen).collect()] == ["2"]


def test_new_listings_take_floors_from_their_detail_page(spark):
    card = CARD.replace("3 tầng", "đẹp")
    html = f'<div class="gap-24 d-flex flex-column card-container">{card}{card.replace("77", "78")}{CARD.replace("77", "79")}</div>'
    pages = spark.createDataFrame([("u", html), ("v", html)], "url string, html string")
    detail = '<div class="x col-md-12 text"><p>Cao <b>6</b> tầng</p></div>'
    details = spark.createDataFrame([("https://h.example/a?x=1&y=2", detail)], "url string, html string")
    seen = spark.createDataFrame([("78",)], "id string")
    rows = extraction.new_listings(pages, details, seen, "https://h.example").collect()
    assert sorted((r["id"], r["floors"]) for r in rows) == [("77", 6), ("79", 4)]


def test_merged_provinces(spark):
    df = spark.createDataFrame([(" hà GIANG ",), ("Bình Dương",), ("Paris",), (None,)], "province string")
    assert [r[0] for r in merged_province(df).select("province_after_merger").collect()] == ["Tuyên Quang", "Hồ Chí Minh", "Other", "Other"]


def test_dates(spark):
    df = spark.createDataFrame([(25,), (None,)], "h int").select(S.listed_at("h").alias("d"))
    assert [str(r[0]) for r in df.collect()] == ["2025-09-19 23:00:00", "None"]


def test_segments_and_cuts(spark):
    df = spark.createDataFrame([(1.0,), (5.0,), (9.0,), (None,)], "x double")
    assert [r[0] for r in df.select(S.quantile_segment("x", 2, 6)).collect()] == ["Low", "Mid", "High", "High"]
    assert [r[0] for r in df.select(S.cut("x", [0, 1, 8], ["a", "b"])).collect()] == ["a", "b", None, None]
    assert [r[0] for r in df.select(S.at_least("x", 4.0)).collect()] == [4.0, 5.0, 9.0, None]


def test_tokens(spark):
    df = spark.createDataFrame([("Bán NHÀ, 3x tầng-của tôi!",), ("",), (None,), ("x",)], "t string")
    words = T.without_stop_words(T.tokens(T.normalise_title("t")), ["của", "bán nhà"])
    assert [r[0] for r in df.select(words).collect()] == [["bán", "nhà", "x", "tầng", "tôi"], [], [], ["x"]]
    pairs = [r[0] for r in df.select(T.bigrams(T.long_words("t"))).collect()]
    assert pairs[0] == ["bán nhà", "nhà 3x", "3x tầng", "tầng của", "của tôi"]
    assert pairs[1] == [] and pairs[3] == []


@pytest.mark.parametrize("build", [T.composed, L.age_hours, L.title_floors, L.detail_floors, L.has_frontage, L.price_million, L.card_blocks, lambda c: L.absolute_url(c, "b")])
def test_a_text_is_computed_once(spark, build):
    plan = spark.createDataFrame([("a", "b")], "one string, two string").select(build(F.concat("one", F.lit("MARKER"), "two")).alias("v"))
    assert plan._jdf.queryExecution().analyzed().toString().split("\n")[0].count("MARKER") == 1


def test_compositions_lie_in_small_maps():
    sizes = [part.count("'") // 4 for part in T.composition_buckets().split("map(")[1:]]
    assert len(sizes) == T.BUCKETS and max(sizes) < 16 and sum(sizes) == len(T.compositions()) + T.BUCKETS


def test_the_texts_of_a_card_are_made_ready_once(spark):
    pages = spark.createDataFrame([("v", "<p>none</p>")], "url string, html string")
    plan = extraction.listings_from_pages(pages, "https://h.example/")._jdf.queryExecution().optimizedPlan().toString()
    # title, facts, age and price: each text is tested for marks, and each of its letters
    assert plan.count(f", {T.MARKS})") == 8


def cut_by_counting(page):
    """Links of the card container by counting its tags one by one."""
    opening = re.search(r'(?s)<div[^>]*class="gap-24 d-flex flex-column card-container"[^>]*>', page)
    inside = page[opening.end():] if opening else ""
    depth = 0
    for tag in re.finditer(r"(?i)<div(?=[\s>/])|</div\s*>", inside):
        depth += -1 if tag.group().endswith(">") else 1
        if depth < 0:
            inside = inside[: tag.end()]
            break
    return [a for a in re.findall(r"(?s)<a\s[^>]*>.*?</a>", inside) if "card-cm" in a]


def test_cards_end_with_their_container_however_deep_it_is(spark):
    draw = random.Random(4)
    parts = ["<div>", "<DIV class='x'>", "</div>", "</div >", "</Div\n>", "<divider>", "<", "</di", "<br/>", "text <b>ừ</b>\n", "</div", "<div"]
    wrap = lambda inside: f'<p>no</p><div id="c" class="gap-24 d-flex flex-column card-container">{inside}'
    link = lambda i: f'<a class="card-cm" href="/{i}"><div>a < b</div></a>'
    pages = [wrap("".join([link(0), *(draw.choice([*parts, "<div>", "</div>", link(i)]) for i in range(1, 40)), link(40)])) for _ in range(150)]
    pages += [wrap("<div>" * n + link(1) + "</div>" * (n + 1) + link(2)) for n in range(9)]
    pages += [wrap("<div>" + link(1)) + wrap(link(2) + "</div>" + link(3)), "", "<div>", wrap("")]
    rows = spark.createDataFrame(list(enumerate(pages)), "i int, html string").select("i", L.card_blocks("html").alias("c")).collect()
    got = {r["i"]: r["c"] for r in rows}
    assert [got[i] for i in range(len(pages))] == [cut_by_counting(p) for p in pages]
    assert any(len(c) > 2 for c in got.values()) and got[158] == [link(1)]


@pytest.fixture
def places_and_lines(spark, tmp_path):
    tables = {
        "lineitem": spark.createDataFrame([(k, k % 7, k % 3, k % 5, float(k)) for k in range(20)], "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double"),
        "supplier": spark.createDataFrame([(0, 0), (1, 1), (1, 0)], "s_suppkey long, s_nationkey long"),
        "nation": spark.createDataFrame([(0, "Ba Đình", 0), (1, "Thủ Đức", 0)], "n_nationkey long, n_name string, n_regionkey long"),
        "region": spark.createDataFrame([(0, "Hà Nội")], "r_regionkey long, r_name string"),
    }
    for name, rows in tables.items():
        rows.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_line_items_are_dealt_out_before_their_pages_are_read(spark, places_and_lines):
    pages = extract.listing_pages(spark, places_and_lines)
    assert "ShuffledHashJoin [l_suppkey" in pages._jdf.queryExecution().executedPlan().toString()
    # suppliers 0 and 1 have 14 of the 20 lines, and supplier 1 is there twice
    assert pages.count() == 7 + 2 * 7


@pytest.mark.parametrize("tag, css", [("div", "time"), ("h3", "title"), ("h3", None)])
def test_elements_are_read_from_tag_to_tag(spark, tag, css):
    # not character by character; the content is that of the plain pattern
    assert "*?<" not in L.element_pattern(tag, css) and ".*?" not in L.element_pattern(tag, css)
    plain = rf"(?s)<{tag}(?:\s[^>]*)?>(.*?)</{tag}>" if css is None else rf'(?s)<{tag}\s[^>]*?class="(?:[^"]*\s)?{css}(?:\s[^"]*)?"[^>]*>(.*?)</{tag}>'
    draw = random.Random(5)
    parts = [f'<{tag} class="{css}">', f'<{tag} id="1" class="x {css} y" z>', f"<{tag}>", f'<{tag} class="a > {css}">', f"</{tag}>", f"</{tag} >", "</", "<", ">", "\n", "ừ 😀", "<b>"]
    rows = list(enumerate("".join(draw.choice(parts) for _ in range(12)) for _ in range(300)))
    got = spark.createDataFrame(rows, "i int, m string").select("i", L.elements("m", tag, css).alias("all"), L.element("m", tag, css).alias("one")).collect()
    wanted = {i: re.findall(plain, m) for i, m in rows}
    assert {r["i"]: r["all"] for r in got} == wanted
    assert {r["i"]: r["one"] for r in got} == {i: (w or [""])[0] for i, w in wanted.items()}
