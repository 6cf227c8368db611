"""Constraints in the write path: good rows go on, offending ones are told apart with their reasons.

Rows are stored once in the scratch folder, with what can be told from a row alone; how
many rows offend is observed by that write. Repeated keys and orphans are then found on the
stored keys. So what makes the rows, an extraction for instance, runs once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from textmart.functions.literals import no_strings
from textmart.session import scratch_path
from textmart.sizes import broadcast_if_small


class ConstraintError(ValueError):
    """Rows offend against the constraints of a sink that refuses them."""


@dataclass(frozen=True)
class Checked:
    good: DataFrame  # the rows as they came
    bad: DataFrame  # with `reasons`
    counts: dict[str, int]  # rows in all, and rows that offend for each reason


def checked(
    rows: DataFrame, required: Sequence[str] = (), domains: Mapping[str, Sequence[str]] | None = None,
    keys: Sequence[str] = (), parents: DataFrame | None = None, parent_key: str | None = None,
) -> Checked:
    """`null:c` for NULLs in required columns, `domain:c` for values not allowed (NULL is), `repeated` for
    all rows of a key that occurs more than once (NULLs are left to `required`), `orphan` for rows whose parent is not in `parents`."""
    domains = domains or {}
    tests = {f"null:{c}": F.col(c).isNull() for c in required}
    tests |= {f"domain:{c}": F.col(c).isNotNull() & ~F.col(c).isin(list(allowed)) for c, allowed in domains.items()}
    found = F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in tests.items()])) if tests else no_strings()
    seen = Observation()
    told = [F.count_if(test).alias(name) for name, test in tests.items()]
    path = scratch_path(rows.sparkSession, "checked")
    tagged = rows.withColumn("reasons", found)
    tagged.observe(seen, F.count(F.lit(1)).alias("rows"), *told).write.parquet(path)
    stored = rows.sparkSession.read.schema(tagged.schema).parquet(path)
    counts = dict(seen.get)
    marks = []
    if keys:
        whole = stored.select(*keys).dropna()
        repeated = whole.groupBy(*keys).agg(F.count(F.lit(1)).alias("_times")).where("_times > 1")
        counts["repeated"] = repeated.agg(F.sum("_times")).first()[0] or 0
        stored = stored.join(broadcast_if_small(repeated), list(keys), "left")
        marks.append(F.when(F.col("_times").isNotNull(), F.lit("repeated")))
    if parents is not None:
        known = parents.select(F.col(parent_key).alias("_parent")).dropna().distinct()
        stored = stored.join(broadcast_if_small(known), F.col(parent_key) == F.col("_parent"), "left")
        marks.append(F.when(F.col(parent_key).isNotNull() & F.col("_parent").isNull(), F.lit("orphan")))
    every = stored.select(*rows.columns, F.array_compact(F.concat("reasons", F.array(*marks) if marks else no_strings())).alias("reasons"))
    if parents is not None:
        counts["orphan"] = every.where(F.array_contains("reasons", "orphan")).count()
    return Checked(every.where(F.size("reasons") == 0).drop("reasons"), every.where(F.size("reasons") > 0), counts)


def refuse(**parts: Checked) -> None:
    """Raise if any part has offending rows, naming how many and why."""
    offences = {f"{part} {reason}": n for part, c in parts.items() for reason, n in c.counts.items() if reason != "rows" and n}
    if offences:
        raise ConstraintError(", ".join(f"{name}: {n} rows" for name, n in offences.items()))
