"""Addresses to one canonical form, from one line or from parts. Native column functions over token arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The city's spellings and its canonical name.
CITY_PATTERN = r"(?U)\bсанкт[-\s]?петербург\b|\bспб\b|\bпитер\b"
CITY = "санкт петербург"

#: Street types as written and as kept.
STREET_TYPES = {
    "улица": "ул", "ул": "ул", "ул.": "ул",
    "проспект": "пр-кт", "пр-т": "пр-кт", "пр-кт.": "пр-кт", "пр-т.": "пр-кт", "пр": "пр-кт",
    "переулок": "пер", "пер.": "пер",
    "шоссе": "ш", "ш.": "ш",
    "площадь": "пл", "пл.": "пл",
    "набережная": "наб", "наб.": "наб", "наб": "наб",
    "проезд": "проезд", "пр-д": "проезд",
    "бульвар": "б-р", "б-р": "б-р",
}

#: Words before a house, building, structure and letter; a token counts if it starts with one as a whole word.
HOUSE = r"(?U)^(д|дом|дома)\b"
BUILDING = r"(?U)^(к|корп|корпус)\b"
STRUCTURE = r"(?U)^(стр|строен|строение)\b"
LETTER = r"(?U)^(лит|литера)\b"
NUMBER = r"^\d+([/\-]\d+)?[а-я]?$"


def squeezed(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def lowered(c: Column) -> Column:
    return F.regexp_replace(F.translate(F.lower(c), "ё", "е"), r"\([^)]*\)", " ")


def clean_text(c: Column) -> Column:
    """Lower case without brackets and marks; empty for null."""
    return F.coalesce(squeezed(F.regexp_replace(lowered(c), r"[,.;]+", " ")), F.lit(""))


def part(c: Column) -> Column:
    """One part of a split address; null if nothing is left."""
    s = squeezed(lowered(F.trim(c)))
    return F.when(s != "", s)


def place(tokens: Column, test, start: Column | int = 0, stop: Column | None = None) -> Column:
    """Number of the first token from start, before stop, that passes; null if none does."""
    low = F.lit(start) if isinstance(start, int) else start
    high = F.size(tokens) if stop is None else stop
    found = F.filter(F.sequence(F.lit(0), F.size(tokens)), lambda i: (i >= low) & (i < high) & F.coalesce(test(F.get(tokens, i), i), F.lit(False)))
    return F.get(found, F.lit(0))


def without(tokens: Column, at: Column, many: Column | int) -> Column:
    return F.filter(tokens, lambda _, i: (i < at) | (i >= at + many))


def take_after(df: DataFrame, name: str, words: str) -> DataFrame:
    """Column name: the token after the first of the words, else the first that looks like a number; it leaves the tokens."""
    t = F.col("tokens")
    keyed = df.withColumn("_k", place(t, lambda x, _: x.rlike(words), stop=F.size(t) - 1)).withColumn("_n", place(t, lambda x, _: x.rlike(NUMBER)))
    value = F.coalesce(F.get(t, F.col("_k") + 1), F.get(t, F.col("_n")))
    rest = F.when(F.col("_k").isNotNull(), without(t, F.col("_k"), 2)).when(F.col("_n").isNotNull(), without(t, F.col("_n"), 1)).otherwise(t)
    return keyed.withColumn(name, value).withColumn("tokens", rest).drop("_k", "_n")


def usable(c: Column) -> Column:
    return c.isNotNull() & (c != "") & (c != "0")


def assembled(street_type: Column, street: Column, number: Column, parts: list[tuple[str, Column]]) -> Column:
    house = F.concat(number, *[F.when(usable(c), F.concat(F.lit(prefix), c)).otherwise("") for prefix, c in parts])
    named = F.when(usable_text(street_type) & usable_text(street), F.concat_ws(" ", street_type, street))
    return F.concat_ws(" ", F.lit(f"г {CITY}"), named, F.when(usable(number), house))


def usable_text(c: Column) -> Column:
    return c.isNotNull() & (c != "")


def house_parts(number: Column) -> tuple[Column, Column]:
    """A house number and the letter that follows it at once, if any."""
    simple = number.rlike(r"^\d+[а-я]?$")
    letter = F.regexp_extract(number, r"^\d+([а-я])$", 1)
    return F.when(simple, F.regexp_extract(number, r"^(\d+)", 1)).otherwise(number), F.when(simple & (letter != ""), letter)


def parse_line(df: DataFrame, column: str, out: str = "addr_norm") -> DataFrame:
    """df with the canonical form of one-line addresses. A street's name is what follows its type, up to a number."""
    names = [c for c in df.columns if c != out]
    base = df.select(F.struct(*names).alias("row"), clean_text(F.col(column)).alias("s"))
    base = base.withColumn("rest", F.when(F.col("s").rlike(CITY_PATTERN), city_removed(F.col("s"))).otherwise(F.col("s")))
    t = F.col("tokens")
    base = base.withColumn("tokens", F.filter(F.split("rest", " "), lambda x: x != ""))
    types = F.create_map(*[F.lit(x) for kv in STREET_TYPES.items() for x in kv])
    base = base.withColumn("at", place(t, lambda x, _: x.isin(*STREET_TYPES)))
    any_word = "|".join(w.removeprefix("(?U)") for w in (HOUSE, BUILDING, STRUCTURE, LETTER))
    base = base.withColumn("to", F.coalesce(place(t, lambda x, _: x.rlike(NUMBER) | x.rlike("(?U)" + any_word), start=F.col("at") + 1), F.size(t)))
    base = base.withColumn("street_type", F.try_element_at(types, F.get(t, F.col("at"))))
    base = base.withColumn("street", F.when(F.col("at").isNotNull(), F.array_join(F.slice(t, F.col("at") + 2, F.greatest(F.col("to") - F.col("at") - 1, F.lit(0))), " ")))
    base = base.withColumn("tokens", F.when(F.col("at").isNotNull(), without(t, F.col("at"), F.col("to") - F.col("at"))).otherwise(t))
    for name, words in (("house", HOUSE), ("housing", BUILDING), ("structure", STRUCTURE)):
        base = take_after(base, name, words)
    key = place(t, lambda x, _: x.rlike(LETTER), stop=F.size(t) - 1)
    after = place(t, lambda x, i: x.rlike("^[а-я]$") & F.get(t, F.greatest(i - 1, F.lit(0))).rlike(r"^\d+$"), start=1)
    base = base.withColumn("letter", F.coalesce(F.get(t, key + 1), F.get(t, after)))
    number, own = house_parts(F.col("house"))
    address = assembled(F.col("street_type"), F.col("street"), number, [(" корп", F.col("housing")), (" стр", F.col("structure")), (" лит", F.coalesce("letter", own))])
    return base.select("row.*", F.when(F.col("s") != "", address).alias(out))


def city_removed(c: Column) -> Column:
    """Without the first spelling of the city that occurs; later patterns are left alone."""
    out = c
    for pattern in reversed(CITY_PATTERN.removeprefix("(?U)").split("|")):
        p = "(?U)" + pattern
        out = F.when(c.rlike(p), squeezed(F.regexp_replace(c, p, " "))).otherwise(out)
    return out


def parse_parts(df: DataFrame, out: str = "addr_norm") -> DataFrame:
    """df with the canonical form of addresses in columns type_street, name_street, number, fraction, housing, building, letter."""
    get = lambda c: part(F.col(c)) if c in df.columns else F.lit(None).cast("string")
    types = F.create_map(*[F.lit(x) for kv in STREET_TYPES.items() for x in kv])
    raw = get("type_street")
    number, own = house_parts(get("number"))
    parts = [("/", get("fraction")), (" корп", get("housing")), (" к", get("building")), (" лит", F.coalesce(get("letter"), own))]
    return df.withColumn(out, assembled(F.coalesce(F.try_element_at(types, raw), raw), get("name_street"), number, parts))


def address_key(street: Column, number: Column, housing: Column, building: Column) -> Column:
    """Street, number and marked parts; null with fewer than two."""
    parts = F.filter(F.array(street, number, F.concat(F.lit("к"), housing), F.concat(F.lit("стр"), building)), lambda x: x.isNotNull())
    return F.when(F.size(parts) >= 2, F.array_join(parts, " "))


def normalised(c: Column) -> Column:
    """The light form that fused records carry: abbreviations before names go."""
    s = F.translate(F.lower(c), "ё", "е")
    for p in (r"\bг\.\s*", r"\bгород\s+", r"\bул\.\s*", r"\bулица\s+", r"\bд\.\s*", r"\bдом\s+", r"\bлит\.\s*"):
        s = F.regexp_replace(s, "(?U)" + p, "")
    s = F.regexp_replace(s, r"(?U)\bкорп\.\s*", "корпус ")
    s = F.btrim(F.regexp_replace(s, r"(?U)\s+", " "), F.lit(" ,.-"))
    return F.when(s != "", s)


def id_list(c: Column) -> Column:
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != "")
