"""Property strings of the form ``[k=v, k=v]``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _let(value: Column, body) -> Column:
    """Bind ``value`` once for an expression that uses it several times."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def parse_properties(text: Column) -> Column:
    """Map of a property string; ``=`` and ``, `` may occur inside values.

    A pair starts at ``, `` followed by a key and ``=``. If a key occurs twice the
    first value is kept.
    """
    body = F.regexp_replace(F.trim(text), r"^\[|\]$", "")
    pairs = F.transform(
        F.filter(F.split(body, r", (?=[^\s,=]+=)"), lambda part: F.contains(part, F.lit("="))),
        lambda part: F.struct(
            F.substring_index(part, "=", 1).alias("key"),
            F.substring(part, F.instr(part, "=") + 1, F.length(part)).alias("value"),
        ),
    )

    def first_of_each_key(entries: Column) -> Column:
        keys = entries["key"]
        return F.filter(entries, lambda e, i: F.array_position(keys, e["key"]) == i + 1)

    return F.map_from_entries(_let(pairs, first_of_each_key))
