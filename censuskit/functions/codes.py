"""Column functions: calendars, codes, rules and vectors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def calendar_parts(day: Column) -> dict[str, Column]:
    quarter = F.trunc(day, "quarter")
    return {
        "y": F.year(day), "m": F.month(day), "w": F.weekofyear(day), "dd": F.day(day), "wd": F.weekday(day),
        "month_start": F.day(day) == 1, "month_end": day == F.last_day(day), "quarter_start": day == quarter, "quarter_end": day == F.date_sub(F.add_months(quarter, 3), 1),
        "year_start": (F.month(day) == 1) & (F.day(day) == 1), "year_end": (F.month(day) == 12) & (F.day(day) == 31),
    }


def us_federal_holiday(day: Column) -> Column:
    """Fixed days, and the n-th or last weekday of a month (Monday is 0)."""
    y, m, d, wd = F.year(day), F.month(day), F.day(day), F.weekday(day)
    fixed = ((m == 1) & (d == 1)) | ((m == 6) & (d == 19) & (y >= 2021)) | ((m == 7) & (d == 4)) | ((m == 11) & (d == 11)) | ((m == 12) & (d == 25))
    nth = lambda month, weekday, low, high: (m == month) & (wd == weekday) & d.between(low, high)
    return fixed | nth(1, 0, 15, 21) | nth(2, 0, 15, 21) | nth(5, 0, 25, 31) | nth(9, 0, 1, 7) | nth(10, 0, 8, 14) | nth(11, 3, 22, 28)


#: First letter of a resource utilisation group code.
RUG_CATEGORIES = {
    "R": "Rehabilitation", "E": "Extensive Services", "H": "Special Care High", "L": "Special Care Low", "C": "Clinically Complex", "B": "Behavioral", "P": "Reduced Physical",
}


def rug_parts(rug: Column) -> dict[str, Column]:
    group, last = F.substring(rug, 1, 1), F.substring(rug, 3, 1)
    names = F.create_map(*[F.lit(x) for pair in RUG_CATEGORIES.items() for x in pair])
    return {
        "category": F.coalesce(F.try_element_at(names, group), F.lit("Unknown")),
        "depression": F.when(group.isin("H", "L", "C"), last == "2"),
        "nursing": F.when(group.isin("B", "P"), last.try_cast("int")),
    }


def first_rule(values: DataFrame, name: str, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """value, kind, grp of the first rule (pattern, kind, group) that fits."""
    pick = lambda i: F.coalesce(*[F.when(F.col(name).rlike(r[0]), F.lit(r[i])) for r in rules])
    return values.select(name, pick(1).alias("kind"), pick(2).alias("grp"))


def unit_vector(v: Column) -> Column:
    """v divided by its length; a zero vector stays."""
    norm = F.sqrt(F.aggregate(F.transform(v, lambda x: x * x), F.lit(0.0), lambda s, x: s + x))
    unit = lambda n: F.when(n > 0, F.transform(v, lambda x: x / n)).otherwise(v)
    return F.get(F.transform(F.array(norm), unit), F.lit(0))  # a variable, as an expression would be computed for each x
