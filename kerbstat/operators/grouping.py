"""Grouped measures with a HAVING threshold, a total order and a top-k cut."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbstat.functions.flags import severe_flag


def row_count() -> Column:
    return F.count("*")


def mean_severity(places: int | None = 3) -> Column:
    mean = F.avg("severity")
    return mean if places is None else F.round(mean, places)


def severe_count() -> Column:
    return F.sum(severe_flag(F.col("severity")))


def severe_percent(places: int = 2) -> Column:
    return F.round(severe_count().cast("double") * 100.0 / row_count(), places)


def danger_index(places: int = 4) -> Column:
    """0.4 x mean severity + 0.6 x share of severe accidents."""
    share = severe_count().cast("double") / row_count()
    return F.round(F.avg("severity") * 0.4 + share * 0.6, places)


def grouped(
    df: DataFrame,
    keys: Mapping[str, Column] | Sequence[str],
    measures: Mapping[str, Column],
    *,
    min_count: int | None = None,
    descending: Sequence[str] = (),
    limit: int | None = None,
) -> DataFrame:
    """``GROUP BY keys HAVING count(*) > min_count ORDER BY descending, keys LIMIT limit``.

    The keys end the order, so ties at the cut are settled. Groups are combined before the
    shuffle, so a key that holds most rows costs one row per task; with a limit the order
    is a top-k of each partition, never a sort of everything.
    """
    if not isinstance(keys, Mapping):
        keys = {k: F.col(k) for k in keys}
    columns = [value.alias(name) for name, value in keys.items()]
    having = "__rows"
    measured = [value.alias(name) for name, value in measures.items()]
    if min_count is None:
        result = df.groupBy(*columns).agg(*measured)
    else:
        result = df.groupBy(*columns).agg(*measured, row_count().alias(having))
        result = result.filter(F.col(having) > min_count).drop(having)
    order = [F.desc_nulls_last(m) for m in descending] + [F.asc_nulls_last(k) for k in keys]
    result = result.orderBy(*order)
    return result if limit is None else result.limit(limit)


def over_groups(measure: Column) -> Column:
    """A total over already grouped rows, beside each of them.

    The window has no keys, so all groups meet in one task: for keys with a small domain
    (severities, states, weather conditions), one row each. The table itself is still scanned once;
    a total as a subquery would scan it again wherever the two aggregates differ.
    """
    return measure.over(Window.partitionBy())


def with_share(counts: DataFrame, count: str, name: str = "pct") -> DataFrame:
    """Add the percentage that each group's count is of the total of all groups."""
    total = over_groups(F.sum(count))
    return counts.withColumn(name, F.col(count).cast("double") * 100.0 / total)
