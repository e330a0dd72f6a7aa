"""Percent change between two prices."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from barloom.schemas import BASIS_OPEN, BASIS_PREV

BASES = [BASIS_OPEN, BASIS_PREV]


def percent_change(reference: Column, close: Column) -> Column:
    """Change from reference to close in percent; null for a zero reference.

    Decimal prices give Spark's exact decimal quotient, double prices a double.
    """
    return F.try_divide(close - reference, reference) * F.lit(100)


def chosen_bases(basis: str) -> list[str]:
    if basis == "both":
        return BASES
    if basis not in BASES:
        raise ValueError(f"basis must be 'open', 'prev' or 'both', not {basis!r}")
    return [basis]


def basis_rows(basis: str, open_price: Column, prev_close: Column, close: Column) -> Column:
    """One (basis, pct) struct per chosen basis, to be unnested with ``inline``: one pass for both."""
    references = {BASIS_OPEN: open_price, BASIS_PREV: prev_close}
    return F.array(
        *[
            F.struct(F.lit(b).alias("basis"), percent_change(references[b], close).alias("pct"))
            for b in chosen_bases(basis)
        ]
    )
