"""Parsing of loosely typed values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_number(column: str) -> Column:
    """Text to double, NULL where it is no number. Java's ``1d`` / ``1f`` literals are not numbers here."""
    text = F.col(column).cast("string")
    return F.when(~text.rlike(r"[0-9.][dDfF]\s*$"), text.try_cast("double"))


def sum_of_map_text(column: str) -> Column:
    """Sum of the values of a ``{'key': number}`` text, 0 where it is blank or no such text."""
    parsed = F.from_json(F.col(column), "map<string,double>")
    total = F.aggregate(F.map_values(parsed), F.lit(0.0), lambda acc, v: acc + F.coalesce(v, F.lit(0.0)))
    return F.coalesce(total, F.lit(0.0))


def last_entry_per_key(entries: Column) -> Column:
    """A parsed JSON map with repeated keys reduced to the last value of each key."""
    keys, values = F.map_keys(entries), F.map_values(entries)
    distinct = F.array_distinct(keys)
    backwards = F.reverse(keys)
    last = F.transform(
        distinct, lambda k: F.element_at(values, (F.size(keys) - F.array_position(backwards, k) + 1).cast("int"))
    )
    return F.when(F.size(distinct) == F.size(keys), entries).otherwise(F.map_from_arrays(distinct, last))
