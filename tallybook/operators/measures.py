"""Measure stacks: many sources with their own measures on one grain."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.lineage import compute_once


def stack_measures(
    sources: Sequence[tuple[DataFrame, Mapping[str, Column | str]]],
    grain: Sequence[str],
    measures: Mapping[str, str],
) -> DataFrame:
    """Union the sources on the grain and sum every measure; a measure a source lacks adds 0.

    The sums are combined per task before the one shuffle on the grain.
    """
    return total_measures(union_measures(sources, grain, measures), grain, measures)


def stack_in_parts(
    parts: Sequence[Sequence[tuple[DataFrame, Mapping[str, Column | str]]]],
    grain: Sequence[str],
    measures: Mapping[str, str],
) -> DataFrame:
    """The stack of all sources of all parts; each part is summed and stored on its own.

    What the shuffles of a part hold is gone before the next part starts, and its sums are smaller. The sources
    are not read again.
    """
    sums = [compute_once(stack_measures(sources, grain, measures)) for sources in parts]
    return total_measures(reduce(DataFrame.unionByName, sums), grain, measures)


def union_measures(
    sources: Sequence[tuple[DataFrame, Mapping[str, Column | str]]],
    grain: Sequence[str],
    measures: Mapping[str, str],
) -> DataFrame:
    """Union the sources row by row; a measure a source lacks is missing there.

    ``measures`` gives each measure its type.
    """
    shaped = []
    for frame, given in sources:
        columns = [
            (F.col(value) if isinstance(value, str) else value).cast(measures[name]).alias(name)
            for name, value in given.items()
        ]
        shaped.append(frame.select(*grain, *columns))
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), shaped)
    return stacked.selectExpr(
        *[f"`{g}`" for g in grain],
        *[f"`{m}`" if m in stacked.columns else f"CAST(NULL AS {kind}) AS `{m}`" for m, kind in measures.items()],
    )


def total_measures(df: DataFrame, grain: Sequence[str], scale: Mapping[str, str]) -> DataFrame:
    """Sum measures per grain and cast each to its own type after summing."""
    sums = [F.expr(f"CAST(coalesce(sum(`{m}`), 0) AS {kind}) AS `{m}`") for m, kind in scale.items()]
    return df.groupBy(*grain).agg(*sums)


def flow_is(*names: str) -> Column:
    return F.col("flow").isin(*names)


def flow_amount(*names: str, sign: int = 1) -> Column:
    """The row's cents where it belongs to one of the flows."""
    amount = F.col("cents") if sign > 0 else -F.col("cents")
    return F.when(flow_is(*names), amount)
