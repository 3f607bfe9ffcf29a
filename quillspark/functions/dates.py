"""Dates and amounts out of free text, read from its words and the signs between them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: First letters of the months (fixed values).
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")


def _number(word: Column, least: int, most: int) -> Column:
    return F.length(word).between(least, most) & ~word.rlike("[^0-9]")


def _named(word: Column) -> Column:
    return F.length(word).between(3, 9) & ~word.rlike("[^A-Za-z]")


def _month(word: Column) -> Column:
    """1 to 12, or 0."""
    return F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.lower(F.substring(word, 1, 3)))


def _first(triples: Column, shape: Callable[[Column], Column]) -> Column:
    return F.try_element_at(F.filter(triples, shape), F.lit(1))


def iso_date(text: Column) -> Column:
    """The first date as yyyy-mm-dd, '' if there is none: 2024-05-01, else 5/1/2024, else May 1, 2024, else 1-May-2024.

    A date is three neighbouring words with the signs between them; each shape is looked for in the whole text before the next.
    """
    text = F.coalesce(text, F.lit(""))
    word, sign = "[0-9A-Za-z_]+", "[^0-9A-Za-z_]+"
    words = F.regexp_extract_all(text, F.lit(word), 0)
    signs = F.regexp_extract_all(F.regexp_replace(text, f"^{sign}", ""), F.lit(sign), 0)  # signs[i] follows words[i]
    at = lambda xs, i: F.get(xs, i)
    places = F.when(F.size(words) > 2, F.sequence(F.lit(0), F.size(words) - 3)).otherwise(F.array().cast("array<int>"))
    triples = F.transform(places, lambda i: F.struct(at(words, i).alias("a"), at(signs, i).alias("s"), at(words, i + 1).alias("b"), at(signs, i + 1).alias("t"), at(words, i + 2).alias("c")))
    both = lambda x, s: (x["s"] == s) & (x["t"] == s)
    dash = _first(triples, lambda x: both(x, "-") & _number(x["a"], 4, 4) & _number(x["b"], 2, 2) & _number(x["c"], 2, 2))
    slash = _first(triples, lambda x: both(x, "/") & _number(x["a"], 1, 2) & _number(x["b"], 1, 2) & _number(x["c"], 4, 4))
    lead = _first(triples, lambda x: _named(x["a"]) & F.trim(F.regexp_replace(x["s"], r"\s", " ")).isin("", ".") & x["s"].rlike(r"\s$") & _number(x["b"], 1, 2) & x["t"].rlike(r"^,?\s+$") & _number(x["c"], 4, 4))
    inner = _first(triples, lambda x: x["s"].rlike(r"^[-\s]$") & x["t"].rlike(r"^[-\s]$") & _number(x["a"], 1, 2) & _named(x["b"]) & _number(x["c"], 4, 4))

    def written(year: Column, month: Column, day: Column) -> Column:
        return F.concat_ws("-", year, F.lpad(month.cast("string"), 2, "0"), F.lpad(day, 2, "0"))

    return (
        F.when(dash.isNotNull(), written(dash["a"], dash["b"], dash["c"]))
        .when(slash.isNotNull(), written(slash["c"], slash["a"], slash["b"]))
        .when(lead.isNotNull() & (_month(lead["a"]) > 0), written(lead["c"], _month(lead["a"]), lead["b"]))
        .when(inner.isNotNull() & (_month(inner["b"]) > 0), written(inner["c"], _month(inner["b"]), inner["a"]))
        .otherwise("")
    )


def _figures(text: Column) -> Column:
    """Runs of digits and commas that start with a digit."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit("[0-9][0-9,]*"), 0)


def _whole(figure: Column) -> Column:
    return F.replace(figure, F.lit(","), F.lit("")).cast("double").cast("long")


def largest_amount(text: Column) -> Column:
    """The largest figure of at least three signs, null if there is none."""
    return F.array_max(F.transform(F.filter(_figures(text), lambda x: F.length(x) >= 3), _whole))


def first_number(text: Column) -> Column:
    """The first number, cut to a whole, null if there is none."""
    return _whole(F.get(_figures(text), F.lit(0)))
