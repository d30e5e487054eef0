"""Column rules of cleaning: numbers, ranges, flags, heights, bands and categories."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Limits of areas, floors, heights and positions.
AREA = (20.0, 100_000.0)
FLOORS = (1, 100)
FLOOR_HEIGHT, USUAL_FLOOR_HEIGHT = (1.5, 50.0), (2.5, 6.0)
HEIGHT = (2.0, 500.0)
LONGITUDE, LATITUDE = (29.0, 31.5), (59.4, 60.4)
CONSISTENT = (0.6, 1.4)

#: Parts of words and the category that the first of them found gives. The order decides: words with
#: the prefix for "non-" hold those without it, and so never reach their own rule.
TAG_CATEGORIES = [
    (("жил", "квартир"), "Жилое"),
    (("нежил", "офис", "коммерч"), "Нежилое"),
    (("комплекс",), "Комплекс"),
    (("промышл", "склад", "производ"), "Промышленное"),
    (("культур", "образ", "медиц", "спорт", "социал"), "Социальное"),
    (("постройк", "сооруж", "строен", "гараж"), "Постройка/сооружение"),
]
PURPOSE_CATEGORIES = [
    (("жилое",), "Жилое"),
    (("нежилое",), "Нежилое"),
    (("многоквартирный",), "Жилое"),
    (("индивидуальный",), "ИЖС"),
    (("офис",), "Нежилое"),
    (("торгов",), "Коммерческое"),
    (("склад",), "Складское"),
    (("производ", "промышл"), "Промышленное"),
    (("образован", "медицин", "культур", "спортив"), "Социальное"),
    (("гараж",), "Гараж"),
    (("хозяйствен",), "Хозяйственное"),
]
#: The categories of the exploratory notebooks, which differ from those above.
EXPLORED_CATEGORIES = [
    (("жил",), "Жилое"),
    (("нежил",), "Нежилое"),
    (("комплекс",), "Комплекс"),
    (("постройк", "сооруж", "строен"), "Постройка/сооружение"),
    (("торг", "промышл", "бизнес", "услуг"), "Коммерческое"),
    (("культур", "образ", "медиц", "спорт"), "Социальное"),
]
OTHER, UNKNOWN = "Прочее", "Неизвестно"

#: Upper ends of floor bands.
BANDS = [(4, "3-4"), (5, "5"), (9, "6-9"), (12, "10-12"), (16, "13-16"), (25, "17-25")]

#: Codes of categories for models.
FLOOR_BAND_CODES = {"1": 0, "2": 1, "3-4": 2, "5": 3, "6-9": 4, "10-12": 5, "13-16": 5, "10-16": 5, "17-25": 6, "17+": 6, "26+": 7, "unknown": -1}
PURPOSE_CODES = {"Жилое": 0, "Жилой": 0, "Нежилое": 1, "Нежилой": 1, "Промышленное": 2, "Социальное": 3, "Торговое": 4, "Прочее": 5, "Неизвестно": -1}
CATEGORY_CODES = {"Жилое": 0, "Нежилое": 1, "Комплекс": 2, "Промышленное": 3, "Социальное": 4, "Постройка": 5}
HEIGHT_SOURCE_CODES = {"direct": 2, "height_consistent": 2, "calculated": 1, "height_calculated": 1, "missing": 0}

NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def number(c: Column) -> Column:
    """Text as a number; null where it isn't one (suffixes that casts would take included)."""
    return F.when(c.cast("string").rlike(NUMBER), F.trim(c.cast("string")).try_cast("double"))


def within(c: Column, low: float, high: float) -> Column:
    """The value, null outside the range."""
    return F.when(c.between(low, high), c)


def flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("int")


def clipped(c: Column, low: float | None = None, high: float | None = None) -> Column:
    """Limited to the range; null stays null, which least() and greatest() alone would drop."""
    out = c
    if low is not None:
        out = F.greatest(out, F.lit(low))
    if high is not None:
        out = F.least(out, F.lit(high))
    return F.when(c.isNotNull(), out)


def ordered_pair(a: Column, b: Column) -> tuple[Column, Column]:
    """Least first where both are known."""
    both = a.isNotNull() & b.isNotNull()
    return F.when(both, F.least(a, b)).otherwise(a), F.when(both, F.greatest(a, b)).otherwise(b)


def middle(a: Column, b: Column) -> Column:
    return F.coalesce((a + b) / 2, b, a)


def tidy(c: Column) -> Column:
    """Trimmed text, null for what stands for nothing."""
    t = F.trim(c.cast("string"))
    return F.when(~t.isin("nan", "None", ""), t)


def first_match(c: Column, rules: list[tuple[tuple[str, ...], str]], default: str) -> Column:
    """The label of the first rule with a part that the lower-cased text holds."""
    text = F.lower(F.trim(c))
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for parts, label in rules:
        hit = F.lit(False)
        for p in parts:
            hit = hit | F.contains(text, F.lit(p))
        out = out.when(hit, label)
    return out.otherwise(default)


def tag_category(tag: Column) -> Column:
    return first_match(tag, TAG_CATEGORIES, OTHER)


def purpose_category(purpose: Column) -> Column:
    return F.when(purpose.isNull(), UNKNOWN).otherwise(first_match(purpose, PURPOSE_CATEGORIES, OTHER))


def floor_band(floors: Column) -> Column:
    out = F.when(floors.isNull() | (floors <= 0), "unknown").when(floors == 1, "1").when(floors == 2, "2")
    for most, name in BANDS:
        out = out.when(floors <= most, name)
    return out.otherwise("26+")


def height_from_floors(floors: Column, floor_height: Column) -> Column:
    return floors * F.coalesce(floor_height, F.lit(3.0))


def consistency_ratio(height: Column, from_floors: Column) -> Column:
    return F.when(from_floors > 0, F.try_divide(height, from_floors))


def height_source(height: Column, floors: Column, inconsistent: Column) -> Column:
    return F.when(height.isNotNull() & (inconsistent == 0), "height_consistent").when(height.isNotNull(), "height_inconsistent").when(floors.isNotNull(), "stairs_only").otherwise("unknown")


def encoded(c: Column, codes: dict[str, int], default: int = -1) -> Column:
    table = F.create_map(*[F.lit(x) for kv in codes.items() for x in kv])
    return F.coalesce(F.try_element_at(table, c), F.lit(default))


def tags(text: Column) -> Column:
    """A list written as text, by its commas; quotes, brackets and empty parts go."""
    inner = F.regexp_replace(F.coalesce(text, F.lit("")), r"^\s*\[|\]\s*$", "")
    quoted = F.regexp_extract_all(inner, F.lit(r"""'([^']*)'|"([^"]*)\"|([^,'"]+)"""), F.lit(0))
    return F.filter(F.transform(quoted, lambda x: F.trim(F.regexp_replace(x, "['\"]", ""))), lambda x: x != "")


def explored_tags(text: Column) -> Column:
    """A list written as text, cut at every comma, as the exploratory notebooks read it; empty for null."""
    inner = F.btrim(F.trim(F.coalesce(text, F.lit(""))), F.lit("[]"))
    parts = F.transform(F.split(inner, ","), lambda x: F.btrim(F.trim(x), F.lit("'\"")))
    return F.filter(parts, lambda x: x != "")


def explored_category(tag: Column) -> Column:
    return first_match(tag, EXPLORED_CATEGORIES, OTHER)


def city_part(address: Column) -> Column:
    """What stands before the first comma."""
    return F.trim(F.split_part(address, F.lit(","), F.lit(1)))


#: Upper ends and codes of floor bands taken from the number itself.
BAND_CODES = [(4, 2), (5, 3), (9, 4), (16, 5), (25, 6)]


def band_code(floors: Column) -> Column:
    """The code of a floor band from the number of floors, cut to a whole one, where no band is given."""
    whole = floors.cast("int")
    out = F.when(floors.isNull(), -1).when(whole == 1, 0).when(whole == 2, 1)
    for most, code in BAND_CODES:
        out = out.when(whole <= most, code)
    return out.otherwise(7)
