"""Missing values, numbers, keys and dates."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def null_on_blank(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def first_text(*cs: Column) -> Column:
    """The first that is neither null nor empty."""
    return F.coalesce(*[null_on_blank(c) for c in cs])


def first_list(*cs: Column) -> Column:
    """The first list that is neither null nor empty; else an empty list."""
    return F.coalesce(*[F.when(F.size(c) > 0, c) for c in cs], F.array().cast("array<string>"))


def default(c: Column, value: object) -> Column:
    """c, or value where c is null. A source that knows missing keys keeps a present null; columns can't tell them apart."""
    return F.coalesce(c, F.lit(value))


def to_number(c: Column) -> Column:
    """A double from a number, a boolean or a text; null from blank or other texts. Underscores between digits and outer spaces are allowed."""
    text = F.trim(c.cast("string"))
    plain = F.regexp_replace(text, r"(?<=\d)_(?=\d)", "")
    return F.when(F.lower(text) == "true", 1.0).when(F.lower(text) == "false", 0.0).when(plain.rlike(r"(?i)^[+-]?(\d+\.?\d*([eE][+-]?\d+)?|\.\d+([eE][+-]?\d+)?|nan|inf(inity)?)$"), plain.try_cast("double"))


def norm_key(c: Column, strip: bool = True) -> Column:
    """The key of a build side (stripped) or of a probe side. Lower case stands for case folding: the two differ for a few letters such as sharp s, which are folded here."""
    key = F.trim(c.cast("string")) if strip else c.cast("string")
    return F.replace(F.replace(F.lower(key), F.lit("ß"), F.lit("ss")), F.lit("ς"), F.lit("σ"))


def iso_date(c: Column) -> Column:
    return F.substring(c, 1, 10)


def or_unknown(c: Column) -> Column:
    return F.coalesce(null_on_blank(c), F.lit("unknown"))


def strictly_true(c: Column) -> Column:
    """Null is false, also below a NOT."""
    return F.coalesce(c, F.lit(False))


def three_way(c: Column, yes: str, no: str, other: str) -> Column:
    return F.when(c, yes).when(~c, no).otherwise(other)


def fold(c: Column, domain: Iterable[str], other: str = "other") -> Column:
    return F.when(c.isin(list(domain)), c).otherwise(other)


def label(c: Column, names: Mapping[str, str]) -> Column:
    """The label of a key, or the key itself."""
    pairs = [F.lit(x) for pair in names.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), c), c) if pairs else c


def localized(c: Column, labels: Mapping[str, tuple[str, str]], chinese: bool = False) -> Column:
    """The label of a key in one of two languages, or the key itself."""
    return label(c, {k: names[0 if chinese else 1] for k, names in labels.items()})


def family(c: Column, families: Mapping[str, str]) -> Column:
    return F.when(null_on_blank(c).isNull(), "Unknown").otherwise(label(c, families))


def family_known(c: Column, families: Mapping[str, str]) -> Column:
    """Whether a category has a family of its own (others show as unclassified)."""
    return F.coalesce(c.isin(list(families)), F.lit(False))


def family_zh(c: Column, names: Mapping[str, str], unclassified: str) -> Column:
    """The Chinese name of a family."""
    return F.when(c.isin(list(names)), label(c, names)).otherwise(unclassified)


def badge(c: Column, classes: Mapping[str, list[str]]) -> Column:
    out = F.when(F.lit(False), "")
    for name, states in classes.items():
        out = out.when(c.isin(states), name)
    return out.otherwise("")


def percent(part: Column, total: Column) -> Column:
    """Whole per cent, half up; 0 of nothing."""
    return F.when(total == 0, 0).otherwise(F.floor(part / total * 100 + F.lit(0.5))).cast("int")


def angle(part: Column, total: Column) -> Column:
    """Degrees of a circle; null for nothing."""
    return F.when(total != 0, part / total * 360)


def ratio(a: Column, b: Column, digits: int = 1) -> Column:
    return F.when(b != 0, F.round(a / b, digits))


def number_text(c: Column, digits: int = 0) -> Column:
    """Thousands with commas and at most so many decimals; a dash for what is no finite number."""
    text = F.format_number(c.cast("double"), digits)
    text = F.regexp_replace(F.regexp_replace(text, r"(\.\d*?)0+$", "$1"), r"\.$", "") if digits else text
    finite = c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf"))
    return F.when(finite, text).otherwise("—")


def padded(c: Column, width: int = 3) -> Column:
    return F.when(F.length(c.cast("string")) >= width, c.cast("string")).otherwise(F.lpad(c.cast("string"), width, "0"))


def long_date(c: Column, chinese: bool = False) -> Column:
    return F.date_format(F.to_date(F.substring(c.cast("string"), 1, 10)), "y年M月d日" if chinese else "MMMM d, y")


def publication_year(c: Column, fallback: int = 2022) -> Column:
    """A struct of the year and where it comes from."""
    year = F.year(F.try_to_date(F.substring(c.cast("string"), 1, 10)))
    return F.struct(F.coalesce(year, F.lit(fallback)).alias("year"), F.when(year.isNull(), "fallback").otherwise("earliest_date").alias("year_source"))


def velocity(count: Column, since: Column, until: str) -> Column:
    """Counts a year, of 365.25 days."""
    days = F.datediff(F.lit(until).cast("date"), since.cast("date"))
    return F.when(days > 0, count * 365.25 / days)


def page_bucket(c: Column) -> Column:
    out = F.when(c < 10, "<10")
    for low, high in ((10, 20), (20, 40), (40, 80), (80, 120)):
        out = out.when((c >= low) & (c < high), f"{low}-{high - 1}")
    return out.when(c >= 120, ">=120")
