"""Vector expressions over array<float> or array<double> columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from lectern.functions.text import tokens


def squared_distance(left: Column | str, right: Column | str) -> Column:
    """Squared Euclidean distance, summed in double precision."""
    parts = F.zip_with(left, right, lambda a, b: (a.cast("double") - b) * (a.cast("double") - b))
    return F.aggregate(parts, F.lit(0.0), lambda total, part: total + part)


def token_bucket(token: Column, dim: int) -> Column:
    """Bucket of a token: the first 8 hexadecimal digits of its MD5, modulo the dimension."""
    digits = F.conv(F.left(F.md5(token), F.lit(8)), 16, 10).cast("long")
    return (digits % dim).cast("int")


def padded_buckets(text: Column | str, dim: int) -> Column:
    """Sorted buckets of all tokens of a text, and every bucket once more."""
    buckets = F.transform(tokens(text), lambda token: token_bucket(token, dim))
    return F.sort_array(F.concat(buckets, F.sequence(F.lit(0), F.lit(dim - 1))))


def dense_counts(padded: Column, starts: Column) -> Column:
    """array<float> of the number of tokens per bucket, from padded buckets and their run starts.

    Every bucket has a run, one longer than its number of tokens.
    """
    return F.transform(
        starts,
        lambda start, i: (F.coalesce(F.get(starts, i + 1), F.size(padded)) - start - 1).cast("float"),
    )
