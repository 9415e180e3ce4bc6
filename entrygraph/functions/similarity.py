"""Indel similarity: 200 * LCS / (n + m).

The expression forms stay in the JVM but are interpreted; the Arrow form keeps a
row of the table in the bits of one integer and is the one for many pairs. The
form of ``places`` does so too, in the bits of a long, and starts no Python.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def lcs_length(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence, one row of the table at a time."""
    xs, ys = F.split(a, ""), F.split(b, "")
    zero = F.transform(ys, lambda _: F.lit(0))

    def next_row(row: Column, x: Column) -> Column:
        """The row below: each cell from its left neighbour, the cell above and the one above left."""
        start = F.struct(F.array().cast("array<int>").alias("row"), F.lit(0).alias("left"), F.lit(0).alias("corner"))
        cells = F.zip_with(row, ys, lambda above, y: F.struct(above.alias("above"), y.alias("y")))

        def step(acc: Column, c: Column) -> Column:
            value = F.when(c.y == x, acc.corner + 1).otherwise(F.greatest(acc.left, c.above))
            return F.struct(F.array_append(acc.row, value).alias("row"), value.alias("left"), c.above.alias("corner"))

        return F.aggregate(cells, start, step, lambda acc: acc.row)

    rows = F.aggregate(xs, zero, next_row)
    return F.when((F.length(a) == 0) | (F.length(b) == 0), 0).otherwise(F.element_at(rows, -1))


#: Letters of which a row of the table, and twice a row, fit the bits of a long.
LONG = 62


def places(a: Column) -> Column:
    """For each letter of ``a`` the bits of where it stands; of the first LONG letters, as ``lcs_by_places`` takes it."""
    xs = F.slice(F.split(a, ""), 1, LONG)

    def bits(x: Column) -> Column:
        own = F.transform(xs, lambda y, i: F.when(y == x, F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long")))
        return F.aggregate(own, F.lit(0).cast("long"), lambda acc, b: acc + b)

    letters = F.array_distinct(xs)
    return F.map_from_arrays(letters, F.transform(letters, bits))


def lcs_by_places(a: Column, placed: Column, b: Column) -> Column:
    """The same length, where ``placed`` holds the ``places`` of a: one addition a letter of b, or a row at a time if a is long."""
    full = F.call_function("shiftleft", F.lit(1).cast("long"), F.length(a)) - 1
    met = F.transform(F.split(b, ""), lambda y: F.coalesce(F.try_element_at(placed, y), F.lit(0).cast("long")))
    row = F.aggregate(met, full, lambda row, m: ((row + row.bitwiseAND(m)).bitwiseOR(row.bitwiseAND(F.bitwise_not(m)))).bitwiseAND(full))
    short = F.when((F.length(a) == 0) | (F.length(b) == 0), 0).otherwise(F.length(a) - F.bit_count(row))
    return F.when(F.length(a) <= LONG, short).otherwise(lcs_length(a, b))


def ratio(lcs: Column, total: Column) -> Column:
    """The similarity from 0 to 100, rounded half to even to one decimal, as ties are judged by it."""
    return F.bround(F.when(total == 0, 100.0).otherwise(200.0 * lcs / total), 1)


def lcs_batched(a: Column, b: Column) -> Column:
    """The same length for batches of pairs: one addition a character on the bits of a whole row."""

    def lengths(xs: pd.Series, ys: pd.Series) -> pd.Series:
        masks: dict[str, dict[str, int]] = {}
        out = []
        for x, y in zip(xs, ys):
            if x is None or y is None:
                out.append(None)
                continue
            if (places := masks.get(x)) is None:
                places = masks[x] = {}
                for i, c in enumerate(x):
                    places[c] = places.get(c, 0) | 1 << i
            full = (1 << len(x)) - 1
            row = full
            for c in y:
                met = row & places.get(c, 0)
                row = ((row + met) | (row - met)) & full
            out.append(len(x) - row.bit_count())
        return pd.Series(out, dtype="Int32")

    return F.pandas_udf(lengths, "int")(a, b)
