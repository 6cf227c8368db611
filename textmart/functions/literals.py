"""Small helpers for building plans: literals, single evaluation, explode.

Literal arrays and maps cost one string in the plan and are folded by Catalyst.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SEPARATOR = "\x1f"


def string_array(values: Iterable[str]) -> Column:
    return F.split(F.lit(_SEPARATOR.join(values)), _SEPARATOR)


def string_map(mapping: dict[str, str]) -> Column:
    """A MAP<STRING, STRING>; look a key up with `try_element_at`."""
    return F.map_from_arrays(string_array(mapping), string_array(mapping.values()))


def no_strings() -> Column:
    return F.expr("CAST(array() AS ARRAY<STRING>)")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with the value computed once per row.

    Spark shares a repeated expression only where it is surely evaluated, not in the
    branches of a CASE, where a folded text would be folded again for each branch.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def explode_computed(df: DataFrame, keep: list[str], array: Column | str, out: str) -> DataFrame:
    """`explode` of an array computed in this plan, without NULL elements.

    A plain explode makes the optimiser infer `size(array) > 0` and push it below
    the projection that computes the array, which then is computed twice. The outer
    form infers nothing; its NULL row for an empty array is dropped after it.
    """
    return df.select(*keep, F.explode_outer(array).alias(out)).where(F.col(out).isNotNull())
