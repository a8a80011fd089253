"""Scalar functions on text, dates, amounts and areas.  Unknown is NULL or neutral, never a guess."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..params import AREA, BEGINS, FEET, FORM_END, FORM_LABELS, LAND_CLASSES, NUMBER, PLACEHOLDERS, POSSESSION, REGISTRAR_STATES, SQFT


def strip(text: Column) -> Column:
    """Without white space at either end (trim takes blanks only)."""
    return F.btrim(text, F.lit(" \t\n\x0b\f\r"))


def blank(text: Column) -> Column:
    return text.isNull() | (strip(text) == "")


def flags(*found: Column) -> Column:
    """Array of the flags that are not NULL, in order."""
    return F.array_compact(F.array(*found)) if found else F.array().cast("array<string>")


def parse_date(text: Column) -> Column:
    """Day-month-year, padded or not."""
    return F.try_to_date(strip(text), "d-M-yyyy")


def date_flag(text: Column, field: str) -> Column:
    return F.when(~blank(text) & parse_date(text).isNull(), f"{field}.unparseable")


def parse_amount(text: Column) -> Column:
    """Digits grouped by commas; anything else is NULL."""
    digits = F.replace(strip(text), F.lit(","), F.lit(""))
    return F.when(digits.rlike(r"^\d+$"), digits.try_cast("bigint"))


def amount_flag(text: Column, field: str) -> Column:
    return F.when(~blank(text) & parse_amount(text).isNull(), f"{field}.unparseable")


def digits_amount(text: Column) -> Column:
    """All digits of the text as one number."""
    digits = F.regexp_replace(text, r"[^0-9]", "")
    return F.when(digits != "", digits.try_cast("bigint"))


def norm(value: Column) -> Column:
    """Text by which values are compared: NULL is empty, dates ISO, case and outer white space do not count."""
    return F.coalesce(F.lower(strip(value.cast("string"))), F.lit(""))


def listing_key(fields: Sequence[Column]) -> Column:
    return F.substring(F.sha2(F.concat_ws("|", *[norm(f) for f in fields]), 256), 1, 24)


def without_placeholder(text: Column) -> Column:
    return F.when(~F.upper(strip(text)).isin(*PLACEHOLDERS), text)


def collapse_teaser(pieces: Column) -> Column:
    """Struct of the full text and whether teaser and text disagree."""
    clean = F.filter(F.transform(pieces, strip), lambda p: p != "")
    teaser, rest = F.try_element_at(clean, F.lit(1)), F.array_join(F.slice(clean, 2, 1 << 30), " ")
    core = F.when(teaser.endswith("..."), strip(F.regexp_replace(teaser, r"\.\.\.$", ""))).otherwise(teaser)
    agrees = (core != "") & F.startswith(rest, F.substring(core, 1, 20))
    text = (
        F.when(F.size(clean) == 0, "").when(F.size(clean) == 1, teaser).when(agrees, rest)
        .otherwise(F.concat(teaser, F.lit(" | "), rest))
    )
    return F.struct(text.alias("text"), ((F.size(clean) > 1) & ~agrees).alias("uncertain"))


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with ``value`` worked out once however often ``use`` names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def form_fields(text: Column) -> Column:
    """Map of field to value of a numbered form: each label's text runs to the next label that occurs, or to the end.

    One pattern of all labels cuts the text; the number that a label begins with names its field.  A label counts where it
    stands first; further ones belong to the value that they stand in.  The form's end cuts the last value.
    """
    labels = "(?=[0-9])(?:" + "|".join(FORM_LABELS.values()) + ")"  # all begin with their number: other places fail at the first sign
    numbers = {pattern.split(r"\.")[0].replace("\\", ""): name for name, pattern in FORM_LABELS.items()}
    table = F.create_map(*[F.lit(x) for pair in numbers.items() for x in pair])
    cut = F.struct(
        F.regexp_extract_all(text, F.lit(labels), 0).alias("heads"), F.split(text, labels, -1).alias("pieces"),
        F.regexp_instr(text, F.lit(FORM_END)).alias("end"), F.length(text).alias("length"),
    )
    name = lambda head: F.try_element_at(table, F.substring_index(head, ".", 1))
    entry = lambda key, value: F.struct(key.alias("key"), value.alias("value"))
    none = F.array().cast("array<string>")

    def named(b: Column) -> Column:
        places = F.when(F.size(b["heads"]) > 0, F.sequence(F.lit(1), F.size(b["heads"]))).otherwise(F.array().cast("array<int>"))
        names = F.coalesce(F.transform(b["heads"], name), none)
        return _bound(F.struct(names.alias("names"), places.alias("places")), lambda n: starts(b, n["names"], n["places"]))

    def starts(b: Column, names: Column, places: Column) -> Column:
        first = F.filter(places, lambda k: F.array_position(names, F.element_at(names, k)) == k)
        return _bound(first, lambda first: values(b, names, first))

    def values(b: Column, names: Column, first: Column) -> Column:
        size = F.length(F.element_at(b["pieces"], -1))
        begin = b["length"] - size + 1
        over = F.when(b["end"] <= 0, 0).when(b["end"] <= begin, size).otherwise(size - b["end"] + begin)  # signs of the last value beyond the end

        def value(k: Column, i: Column) -> Column:
            following = F.coalesce(F.get(first, i + 1), F.size(b["heads"]) + 1)
            own = F.element_at(b["pieces"], k + 1)
            again = lambda acc, j: F.concat(acc, F.element_at(b["heads"], j), F.element_at(b["pieces"], j + 1))
            whole = F.when(following == k + 1, own).otherwise(F.aggregate(F.sequence(k + 1, following - 1), own, again))
            last = i == F.size(first) - 1
            kept = F.when(last, F.substring(whole, F.lit(1), F.greatest(F.length(whole) - over, F.lit(0)))).otherwise(whole)
            return entry(F.element_at(names, k), F.trim(F.regexp_replace(kept, r"\s+", " ")))

        return F.transform(first, value)

    return F.map_from_entries(_bound(cut, named))


def area_mentions(text: Column) -> Column:
    """Figures with their units, as text."""
    found = F.regexp_extract_all(text, F.lit("(?i)" + AREA), 0)  # one pass over the text; numbers and units are told apart in what it found
    spaced = F.transform(found, lambda m: F.regexp_replace(m, rf"^({NUMBER})\s*", "$1 "))
    return F.coalesce(spaced, F.array().cast("array<string>"))


def area_sqft(mention: Column) -> Column:
    """Square feet of one mention; units are tried in a fixed order, feet before metres."""
    read = F.struct(
        F.replace(F.regexp_extract(mention, rf"^\s*({NUMBER})", 1), F.lit(","), F.lit("")).try_cast("double").alias("number"),
        F.trim(F.replace(F.lower(F.regexp_extract(mention, rf"^\s*{NUMBER}\s*(.+?)\s*$", 1)), F.lit("."), F.lit(""))).alias("unit"),
    )

    def sized(r: Column) -> Column:
        number, unit = r["number"], r["unit"]
        feet = F.when(F.greatest(*[unit.contains(w) for w in FEET]), number)
        begun = [F.when(unit.startswith(name), number * SQFT[name]) for name in BEGINS]
        return F.coalesce(*begun, feet, *[F.when(unit.contains(name), number * x) for name, x in SQFT.items() if name not in BEGINS])

    return _bound(read, sized)


def round1(value: Column) -> Column:
    """One decimal, half up, settled on decimals so that every engine agrees; beyond decimals, the value as it is."""
    return F.coalesce(F.round(value.try_cast("decimal(38,6)"), 1).cast("double"), value.cast("double"))


def plot_size(mentions: Column) -> Column:
    """Struct of square feet (NULL if none or ambiguous) and flags."""
    def told(b: Column, known: Column, rounded: Column) -> Column:
        most, least = F.array_max(rounded), F.array_min(rounded)
        one = (F.size(rounded) == 1) | (F.try_divide(most - least, most) < 0.01)
        mean = F.aggregate(known, F.lit(0.0), lambda a, x: a + x) / F.size(known)
        n = b["n"]
        return F.struct(
            F.when((F.size(known) > 0) & one, round1(mean)).alias("sqft"),
            flags(
                F.when(n == 0, "area.none"), F.when(F.size(known) < n, "area.unparsed"),
                F.when((n > 0) & (F.size(known) == 0), "area.unconverted"), F.when((F.size(known) > 0) & ~F.coalesce(one, F.lit(False)), "area.ambiguous"),
            ).alias("flags"),
        )

    found = F.struct(F.size(mentions).alias("n"), F.filter(F.transform(mentions, area_sqft), lambda s: s.isNotNull()).alias("known"))
    rounded = lambda b: F.array_distinct(F.transform(b["known"], round1))
    return _bound(found, lambda b: _bound(rounded(b), lambda r: told(b, b["known"], r)))


def _word(variant: str) -> str:
    escaped = "".join(c if c.isalnum() or c == " " else "\\" + c for c in variant)
    return r"(?i)\b" + r"\s+".join(escaped.split()) + r"\b"


def state_of(text: Column, states: Sequence[tuple[str, Sequence[str]]]) -> Column:
    """Struct of the first state named (in the order of the list, not of the text) and a flag."""
    named = F.array_compact(F.array(*[
        F.when(F.greatest(*[text.rlike(_word(v)) for v in variants]) if len(variants) > 1 else text.rlike(_word(variants[0])), name)
        for name, variants in states
    ]))
    flag = F.when(blank(text), "state.blank").when(F.size(named) == 0, "state.none").when(F.size(named) > 1, "state.ambiguous")
    return F.struct(F.when(~blank(text), F.try_element_at(named, F.lit(1))).alias("state"), flag.alias("flag"))


def registrar_state(cin: Column) -> Column:
    """State of the registrar code in a company number of 21 signs."""
    code = F.upper(F.substring(strip(cin), 7, 2))
    table = F.create_map(*[F.lit(x) for pair in REGISTRAR_STATES.items() for x in pair])
    return F.when(F.length(strip(cin)) == 21, F.try_element_at(table, code))


def state_slug(state: Column) -> Column:
    return F.concat(F.replace(F.replace(F.lower(F.trim(state)), F.lit(" "), F.lit("_")), F.lit("&"), F.lit("and")), F.lit(".csv"))


def possession(text: Column) -> Column:
    """Struct of physical or symbolic and a flag; both or neither is unknown."""
    def told(b: Column) -> Column:
        physical, symbolic = b["physical"], b["symbolic"]
        return F.struct(
            F.when(physical & ~symbolic, "physical").when(symbolic & ~physical, "symbolic").alias("status"),
            F.when(physical & symbolic, "possession.ambiguous").when(~F.coalesce(physical | symbolic, F.lit(False)), "possession.none").alias("flag"),
        )

    return _bound(F.struct(*[text.rlike(POSSESSION[k]).alias(k) for k in ("physical", "symbolic")]), told)


def land_class(text: Column) -> Column:
    return F.coalesce(*[F.when(text.rlike(pattern), name) for name, pattern in LAND_CLASSES])


def currency(amount: Column) -> Column:
    """Rupees with Indian digit groups."""
    digits = F.abs(amount).cast("string")
    head = F.reverse(F.regexp_replace(F.reverse(F.substring(digits, F.lit(1), F.length(digits) - 3)), r"(\d{2})(?=\d)", "$1,"))
    grouped = F.when(F.length(digits) > 3, F.concat(head, F.lit(","), F.substring(digits, -3, 3))).otherwise(digits)
    return (
        F.when(amount.isNull(), "not disclosed").when(amount == 0, "no reserve fixed (per notice)")
        .otherwise(F.concat(F.when(amount < 0, "-").otherwise(""), F.lit("Rs. "), grouped))
    )


def show_date(day: Column) -> Column:
    return F.coalesce(F.date_format(day, "dd MMM yyyy"), F.lit("unknown"))


def show_date_text(text: Column) -> Column:
    """ISO text as a shown date; other text as it is."""
    return F.when(text.isNull(), "unknown").otherwise(F.coalesce(F.date_format(F.try_to_date(F.substring(text, 1, 10), "yyyy-MM-dd"), "dd MMM yyyy"), text))


def nearest_upcoming(today: Column, **days: Column) -> Column:
    """Struct (day, ord, field) of the first date from ``today`` on; of equal dates the first named counts."""
    named = F.array(*[F.struct(d.alias("day"), F.lit(k).alias("ord"), F.lit(n).alias("field")) for k, (n, d) in enumerate(days.items())])
    return F.array_min(F.filter(named, lambda s: s["day"] >= today))


def search_tiers(name: Column, location: Column) -> Column:
    """Search phrases from the narrowest to the broadest, each once."""
    quoted, topic = F.concat(F.lit('"'), name, F.lit('"')), F.lit(" auction OR insolvency OR NCLT")
    place = F.concat(F.lit(" "), location)
    known = location.isNotNull() & (location != "")
    return F.array_distinct(F.array_compact(F.array(
        F.when(known, F.concat(quoted, place, topic)).otherwise(F.concat(quoted, topic)), F.when(known, F.concat(quoted, place)), quoted, name,
    )))


def absolute_link(href: Column, base_url: str) -> Column:
    """NULL for no link or a script; else with the base in front unless it is absolute."""
    usable = href.isNotNull() & (href != "") & ~href.startswith("javascript")
    return F.when(usable, F.when(href.startswith("http"), href).otherwise(F.concat(F.lit(base_url), href)))


def mean_known(*scores: Column) -> Column:
    """Mean of the scores that are known, one decimal; NULL if none is."""
    known = [F.coalesce(s.try_cast("decimal(28,6)"), F.lit(0).cast("decimal(28,6)")) for s in scores]
    total = sum(known[1:], known[0])
    count = sum((s.isNotNull().cast("int") for s in scores[1:]), scores[0].isNotNull().cast("int"))
    return round1(F.try_divide(total, count))
