"""Listing fields from card mark-up and from the phrases inside it.

All are column expressions. Patterns spell out white space as ``WS``, which
includes the no-break space: Java's ``\\s`` is ASCII only, and its Unicode mode
is several times slower. ``(?iu)`` folds the case of accented letters. A number
too big for its type becomes NULL instead of an error.
"""

from functools import reduce

from pyspark.sql import functions as F

from parcelry.functions.scalar import strip
from parcelry.functions.text import bound, composed

# The characters Unicode counts as white space. Those up to U+00FF one by one, which Java keeps as
# one table, the others behind one test of their range: each alternative costs every character a call.
WS = r"[\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0[\u1680-\u3000&&[\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]]]"

# Hours per unit of relative age.
HOURS_PER_UNIT = {"giờ": 1, "ngày": 24, "tuần": 168, "tháng": 720, "năm": 8760}


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def non_empty(text):
    """NULL for an empty text. Unlike ``nullif`` this computes its argument once."""
    return F.get(F.array_remove(F.array(text), F.lit("")), F.lit(0))


def find(text, pattern, group=1):
    """First match of the group, or NULL."""
    return non_empty(F.regexp_extract(_col(text), pattern, group))


def find_number(text, pattern, group=1, kind="int"):
    """Number in the first match, or NULL. An empty text is not cast: failing casts are slow."""
    return find(text, pattern, group).try_cast(kind)


# --- mark-up ----------------------------------------------------------------

NAMED_ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&nbsp;": " ", "&amp;": "&"}
_TAGS = rf"(?s){WS}*(?:(?:<!--.*?-->|<[^>]*>){WS}*)+"


def _decode(text):
    return reduce(lambda c, kv: F.replace(c, F.lit(kv[0]), F.lit(kv[1])), NAMED_ENTITIES.items(), text)


def _read_text(m, separator):
    """Text pieces, each trimmed, around the separator; ``m`` is used several times, so it should be at hand."""
    bare = F.when(m.contains("<"), F.regexp_replace(m, _TAGS, separator)).otherwise(m)
    return strip(F.when(m.contains("&"), _decode(bare)).otherwise(bare))


def _text(markup, separator):
    """Text pieces, each trimmed, around the separator; NULL when empty.

    The mark-up is bound, so that testing for tags and entities before the
    costly replacements does not compute it again.
    """
    return non_empty(bound(markup, lambda m: _read_text(m, separator)))


def joined_texts(markups):
    """``joined_text`` of each item of a list."""
    return F.transform(_col(markups), lambda m: non_empty(_read_text(m, "")))


def joined_text(markup):
    """Text pieces, each trimmed, put together without a separator; NULL when empty."""
    return _text(markup, "")


def spaced_text(markup):
    """Text pieces, each trimmed, put together with one space; NULL when empty."""
    return _text(markup, " ")


def up_to(end):
    """Pattern of the text before the next ``end``, which begins with ``<``: from tag to tag, not character by character."""
    return rf"(?>[^<]*)(?:<(?!{end})(?>[^<]*))*+"


def element_pattern(tag, css_class=None):
    """Pattern of an element; with a class, of one that lists this class among its classes."""
    within = up_to(f"/{tag}>")
    if css_class is None:
        return rf"<{tag}(?:\s[^>]*)?>({within})</{tag}>"
    return rf'<{tag}\s[^>]*?class="(?:[^"]*\s)?{css_class}(?:\s[^"]*)?"[^>]*>({within})</{tag}>'


#: Levels of equal tags inside each other that one pattern follows; ``up_to_close`` takes any number.
NESTED = 4


def balanced_pattern(tag, levels=NESTED):
    """Pattern of text and whole elements of this tag, nested at most so deep, that ends before any other of its tags."""
    text = up_to(rf"(?i:{tag}[\s>/]|/{tag}\s*>)")
    return reduce(lambda inner, _: rf"{text}(?:<(?i:{tag})(?=[\s>/]){inner}</(?i:{tag})\s*+>{text})*+", range(levels), text)


def element(markup, tag, css_class=None):
    """Inner mark-up of the first such element, empty without one. Elements of one tag must not nest."""
    return F.regexp_extract(_col(markup), element_pattern(tag, css_class), 1)


def elements(markup, tag, css_class=None):
    return F.regexp_extract_all(_col(markup), F.lit(element_pattern(tag, css_class)), F.lit(1))


def up_to_close(markup, tag):
    """Mark-up up to the close tag that matches an open tag just before it; all of it if there is none."""
    # texts with the tag that ends each, then the rest, which may look like a close tag: whether it does or not, all is kept
    pattern = rf"(?is).*?(?:<{tag}(?=[\s>/])|</{tag}\s*>|\z)"

    def step(state, piece):
        depth = state["depth"] + F.when(piece.endswith(">"), -1).otherwise(1)
        return F.when(state["depth"] < 0, state).otherwise(F.struct(depth.alias("depth"), (state["seen"] + 1).alias("seen")))

    def cut(m, pieces, end):
        return F.when(end["depth"] < 0, F.array_join(F.slice(pieces, F.lit(1), end["seen"]), "")).otherwise(m)

    start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("seen"))
    within = lambda m, pieces: bound(F.aggregate(pieces, start, step), lambda end: cut(m, pieces, end))
    return bound(markup, lambda m: bound(F.regexp_extract_all(m, F.lit(pattern), F.lit(0)), lambda pieces: within(m, pieces)))


def card_blocks(page):
    """Mark-up of every linked listing card inside the page's card container."""
    opening = r'(?s)<div[^>]*class="gap-24 d-flex flex-column card-container"[^>]*>'
    # the first container if it closes within the levels that the pattern follows, else nothing: then its tags are counted
    closed = rf"{opening}(?:({balanced_pattern('div')}</(?i:div)\s*+>)|.*)"
    counted = lambda p: up_to_close(F.regexp_extract(p, f"{opening}(.*)", 1), "div")
    container = lambda p: bound(F.regexp_extract(p, closed, 1), lambda c: F.when(c != "", c).otherwise(counted(p)))
    links = F.regexp_extract_all(bound(page, container), F.lit(rf"<a\s[^>]*>{up_to('/a>')}</a>"), F.lit(0))
    is_card = r'^<a\s(?=[^>]*href=")(?=[^>]*class="(?:[^"]*\s)?card-cm(?:\s[^"]*)?")'
    return F.filter(links, lambda a: a.rlike(is_card))


def last_page(page):
    """Largest all-digit link text of the pagination list; NULL without one."""
    texts = joined_texts(elements(element(page, "ul", "pagination"), "a"))
    numbers = F.filter(texts, lambda t: t.rlike(r"^\d+$"))
    return F.array_max(F.transform(numbers, lambda t: t.try_cast("int")))


def card_id(card):
    heart = F.regexp_extract(_col(card), rf'<div[^>]*class="(?:[^"]*\s)?heart(?:\s[^"]*)?"[^>]*>({up_to("/div>")})</div>', 1)
    span = F.regexp_extract(heart, r'<span[^>]*class="btn-save js-btn-save add-like"[^>]*>', 0)
    return find(span, r'post_id="([^"]*)"')


def card_href(card):
    return _decode(find(card, r'^<a\s[^>]*?href="([^"]*)"'))


def card_title(card):
    return joined_text(F.regexp_replace(element(card, "h3", "title"), r"(?s)<i(?:\s[^>]*)?>.*?</i>", "<i>"))


def card_location(card):
    return F.regexp_replace(spaced_text(element(card, "div", "description")), rf"{WS}+,", ",")


def card_age(card):
    return joined_text(element(card, "div", "time"))


def card_price(card):
    return joined_text(element(card, "div", "price"))


def card_facts(card):
    """Texts of the description items, in order."""
    return joined_texts(elements(card, "div", "description-item"))


def absolute_url(href, base_url):
    return bound(href, lambda h: F.when(h.startswith("/"), F.concat(F.lit(base_url.rstrip("/")), h)).otherwise(h))


# --- phrases ----------------------------------------------------------------


#: Between the texts of a list in ``facts_text``: no phrase has it.
BETWEEN = "\0"


def facts_text(facts):
    """The texts of a list as one, with something between them that no phrase has."""
    return F.array_join(_col(facts), BETWEEN)


def _read(text, read, ready, plain=composed):
    """``read`` of the text after ``plain``, which is computed once; a text that is ready has been through it."""
    return bound(text if ready else plain(text), read)


def spoken(text):
    """Lower case, letters with their marks as one character."""
    return F.lower(composed(text))


def age_hours(text, ready=False):
    """Hours of a relative age; units without an entry (minutes) give NULL. A text that is ready has been through ``spoken``."""
    pattern = rf"(\d+){WS}*({'|'.join(HOURS_PER_UNIT)})"
    hours = F.create_map(*[F.lit(x) for pair in HOURS_PER_UNIT.items() for x in pair])
    read = lambda t: (find_number(t, pattern, 1, "bigint") * F.try_element_at(hours, find(t, pattern, 2))).try_cast("int")
    return _read(text, read, ready, spoken)


def first_number(facts, pattern, ready=False):
    """Number of the first item of a list of texts that matches. The pattern must not match ``BETWEEN`` nor look for an item's ends.

    A list that is ready has been through ``facts_text`` and ``composed``.
    """
    return find_number(facts if ready else composed(facts_text(facts)), pattern)


# The phrases that name area and rooms. "70.5 m²" gives 5: the digits must touch the unit.
AREA = rf"(\d+){WS}*m²"
BEDROOMS = rf"(\d+){WS}*Phòng{WS}*ngủ"
BATHROOMS = rf"(\d+){WS}*WC"


def title_floors(title, ready=False):
    """Storeys named in a title: a count gains the ground floor, a storey number does not.

    A title with both a count and a number follows the count. A title that is ready has been through ``composed``.
    """

    def read(t):
        # The two words for a storey, here and below.
        counted = F.try_add(find_number(t, rf"(?iu)(\d+){WS}*(?:tầng|lầu)"), F.lit(1))
        numbered = find_number(t, rf"(?iu)(?:tầng|lầu){WS}*(\d+)")
        return F.coalesce(counted, numbered)

    return _read(title, read, ready)


def detail_floors(text):
    """Storeys named in a detail text; the written word wins over its abbreviations."""
    start, end = r"(?<![\p{L}\p{N}_])", r"(?![\p{L}\p{N}_])"
    spellings = [rf"{start}(\d+){WS}*{unit}{end}" for unit in ("(?:tầng|lầu)", "t", "l")]
    return bound(spoken(text), lambda t: F.coalesce(*[find_number(t, p) for p in spellings]))


def has_frontage(title, ready=False):
    """Whether a title names a street front. A title that is ready has been through ``composed``."""
    title = _col(title) if ready else composed(title)
    return F.coalesce(title.rlike(rf"(?iu)mặt{WS}+(?:tiền|phố|đường)"), F.lit(False))


def price_million(text, ready=False):
    """Price phrase in millions. It must start with the number. A text that is ready has been through ``spoken``.

    A number with "tỷ" or "triệu" may be followed by the next smaller amount or
    by "rưỡi", a half. A decimal such as "2.5 tỷ" is read up to its point, as a
    bare number.
    """
    pattern = rf"(?s)^(?:(\d+)(?:{WS}*(tỷ|triệu)(?:{WS}*(\d+){WS}*(triệu|nghìn|ngàn)|{WS}*(rưỡi))?)?)?.*\z"
    # one search for all five: none of them has the mark between
    parts = lambda t: F.split(F.regexp_replace(t, pattern, "$1|$2|$3|$4|$5"), r"\|")

    def value(p):
        whole, unit, part, part_unit, half = (F.get(p, F.lit(i)) for i in range(5))
        whole, part = (non_empty(n).try_cast("double") for n in (whole, part))
        billions = F.when(part_unit == "triệu", part).when(half != "", 500.0).otherwise(0.0)
        millions = F.when(part_unit.isin("nghìn", "ngàn"), part / 1000).when(half != "", 0.5).otherwise(0.0)
        return F.when(unit == "tỷ", whole * 1000 + billions).when(unit == "triệu", F.round(whole + millions, 3)).otherwise(whole)

    return _read(text, lambda t: bound(parts(t), value), ready, spoken)
