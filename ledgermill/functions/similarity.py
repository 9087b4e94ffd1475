"""Ratcliff-Obershelp similarity and cheap upper bounds of it."""

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def ratio(a: str, b: str) -> float:
    """2 M / (|a| + |b|); not symmetric, ``a`` is the draft's text and ``b`` the master's."""
    return SequenceMatcher(None, a, b).ratio()


def similarity(a: Column | str, b: Column | str) -> Column:
    """``ratio`` as an Arrow-batched function of two columns.

    The worker function is local so that it travels by value: executors need no
    copy of this package.
    """

    def batch(left: pd.Series, right: pd.Series) -> pd.Series:
        from difflib import SequenceMatcher

        return pd.Series(
            [
                None if x is None or y is None else SequenceMatcher(None, x, y).ratio()
                for x, y in zip(left, right)
            ],
            dtype="float64",
        )

    return F.pandas_udf(batch, DoubleType())(a, b)


def numbered(items: Column) -> Column:
    """Turn a bag into a set: the k-th copy of an item becomes ``item`` + NUL + k.

    Two bags then share as many items as the sets intersect in.
    """
    ordered = F.sort_array(items)
    return F.transform(
        ordered,
        lambda x, i: F.concat(
            x, F.lit("\x00"), (i - F.array_position(ordered, x) + 1).cast("string")
        ),
    )


def characters(text: Column) -> Column:
    """The characters of a text as a numbered set."""
    return numbered(F.filter(F.split(text, ""), lambda c: c != ""))


def bigrams(text: Column) -> Column:
    """The pairs of neighbouring characters as a numbered set."""
    positions = F.sequence(F.lit(1), F.greatest(F.length(text) - 1, F.lit(1)))
    grams = F.transform(positions, lambda i: F.substr(text, i, F.lit(2)))
    return numbered(F.filter(grams, lambda g: F.length(g) == 2))


def overlap(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b))


def ratio_bound(chars_a: Column, chars_b: Column) -> Column:
    """Upper bound of the ratio: no alignment matches more characters than the bags share."""
    bound = F.try_divide(2.0 * overlap(chars_a, chars_b), F.size(chars_a) + F.size(chars_b))
    return F.coalesce(bound, F.lit(1.0))
