"""Array expressions that count and sum within a row, so that no shuffle is needed."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def positions(array: Column) -> Column:
    """0, 1, ... size-1; empty for an empty array."""
    return F.when(F.size(array) > 0, F.sequence(F.lit(0), F.size(array) - 1)).otherwise(
        F.array().cast("array<int>")
    )


def run_starts(sorted_values: Column) -> Column:
    """Positions at which a sorted array changes its value."""
    return F.filter(
        positions(sorted_values),
        lambda i: (i == 0) | (F.get(sorted_values, i) != F.get(sorted_values, i - 1)),
    )


def run_lengths(sorted_values: Column, starts: Column, value_name: str, count_name: str) -> Column:
    """One (value, count) struct per distinct value of a sorted array."""
    return F.transform(
        starts,
        lambda start, i: F.struct(
            F.get(sorted_values, start).alias(value_name),
            (F.coalesce(F.get(starts, i + 1), F.size(sorted_values)) - start).alias(count_name),
        ),
    )


def running_total(numbers: Column) -> Column:
    """Sums of all earlier elements: [3, 4, 5] gives [0, 3, 7]."""
    return F.aggregate(
        F.slice(numbers, 1, F.greatest(F.size(numbers) - 1, F.lit(0))),
        F.array(F.lit(0)),
        lambda totals, number: F.concat(totals, F.array(F.element_at(totals, -1) + number)),
    )
