"""Numbers, money, nested JSON, maps and probabilities as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def grouped_int(text: Column) -> Column:
    """A whole number with groups of any size ("1,04,233"), else null."""
    return F.when(text.rlike(r"^\s*[0-9][0-9,]*\s*$"), F.regexp_replace(text, r"[,\s]", "").try_cast("long"))


def cell_int(text: Column) -> Column:
    """The whole number of a table cell, with a mark or a remark behind it ("276*", "12 (3)"), else null."""
    return grouped_int(F.regexp_replace(F.trim(text), r"\s*(\*+|\([^)]*\))$", ""))


def amounts(text: Column) -> Column:
    """Amounts of money in a text."""
    found = F.regexp_extract_all(text, F.lit(r"(?i)(?:rs\.?|inr|₹)\s*([0-9][0-9,]*)"), F.lit(1))
    return F.transform(found, lambda x: grouped_int(x))


def fee_cell(text: Column, most: int | None = 20_000) -> Column:
    """The fee in a cell: nil and the like are 0, an amount with or without a currency; without one ``most`` at most, or any if
    that is None."""
    bare = cell_int(text)
    return F.when(text.rlike(r"(?i)^\s*(nil|exempt(ed)?|no fee|free|-+)\s*$"), F.lit(0).cast("long")).otherwise(F.coalesce(F.try_element_at(amounts(text), F.lit(1)), bare if most is None else F.when(bare <= most, bare)))


def dig(json: Column, path: str) -> Column:
    """The value at a dotted path."""
    return F.get_json_object(json, "$." + path if path else "$")


def adds_up(total: Column, parts: Column) -> Column:
    """Whether the values of a map sum to the total, or there are none."""
    sums = F.aggregate(F.map_values(parts), F.lit(0).cast("long"), lambda a, b: a + b)
    return F.coalesce((F.size(parts) == 0) | (sums == total), F.lit(True))


def top(probabilities: Column) -> Column:
    return F.array_max(probabilities)


def margin(probabilities: Column) -> Column:
    """What the likeliest has over the next."""
    ordered = F.sort_array(probabilities, asc=False)
    return F.when(F.size(ordered) > 1, F.get(ordered, F.lit(0)) - F.get(ordered, F.lit(1))).otherwise(F.get(ordered, F.lit(0)))


def same_value(a: Column, b: Column) -> Column:
    """Whether two spellings name one value: equal but for case and space, or three or more numbers of one are all
    in the other."""
    numbers = lambda c: F.transform(F.regexp_extract_all(c, F.lit("[0-9]+"), F.lit(0)), lambda n: F.ltrim(n, F.lit("0")))
    x, y = numbers(a), numbers(b)
    inside = lambda p, q: (F.size(p) >= 3) & (F.size(F.array_except(p, q)) == 0)
    flat = lambda c: F.lower(F.regexp_replace(c, r"\s+", ""))
    return (flat(a) == flat(b)) | inside(x, y) | inside(y, x)


# How many characters from its label a value is, and what each nearness adds to its weight.
NEAR_UP_TO, NEAR = (25, 60, 120), (0.1, 0.05, 0.0, -0.1)


def proximity(distance: Column) -> Column:
    """What nearness to its label adds to a value's weight."""
    place = sum((distance > upto).cast("int") for upto in NEAR_UP_TO)
    return F.get(F.array(*[F.lit(x) for x in NEAR]), place)


def pruned(column: Column) -> Column:
    """JSON of a struct without what is null."""
    return F.to_json(column, {"ignoreNullFields": "true"})
