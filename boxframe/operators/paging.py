"""Pages of an ordered table by rank selection, without sorting the table into one task.

A page is the range of rows between two keys. The key at a rank is found by
narrowing: a few sampled keys cut the range, one aggregation counts the rows
below and at each of them, and the part that holds the rank is cut again, until
few enough rows are left to look at. Every step reads a narrow table of keys;
the page itself is a filter on the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxframe.session import cut_lineage

#: Sampled keys per step, and rows of a part that are looked at one by one.
PIVOTS = 64
FEW = 20_000
_TIE = "_tie"


def _key(cols: list[str]) -> Column:
    return F.struct(*[F.col(c) for c in cols])


def _literal(df: DataFrame, cols: list[str], row) -> Column:
    return F.struct(*[F.lit(row[c]).cast(df.schema[c].dataType).alias(c) for c in cols])


def key_at_rank(keys: DataFrame, cols: list[str], rank: int, few: int = FEW, pivots: int = PIVOTS):
    """The row (``cols`` of ``keys``) at the 1-based ``rank`` of the ascending order by ``cols``, NULLs first.

    ``None`` beyond the last row. ``keys`` is read a few times and should be a table.
    """
    key, low, high, below = _key(cols), None, None, 0
    left = keys.count()
    if rank < 1 or rank > left:
        return None
    while True:
        part = keys
        if low is not None:
            part = part.where(key > _literal(keys, cols, low))
        if high is not None:
            part = part.where(key < _literal(keys, cols, high))
        if left <= few:
            return part.orderBy(*cols).limit(rank - below).tail(1)[0]
        # the keys of smallest hash are a sample that does not depend on the partitioning
        seen = part.orderBy(F.xxhash64(*cols), *cols).limit(pivots).distinct().orderBy(*cols).collect()
        sums = []
        for i, row in enumerate(seen):
            lit = _literal(keys, cols, row)
            sums += [F.sum(F.when(key < lit, 1).otherwise(0)).alias(f"l{i}"), F.sum(F.when(key <= lit, 1).otherwise(0)).alias(f"e{i}")]
        counts = part.agg(*sums).first()
        start, end = below, below + left
        for i, row in enumerate(seen):
            before, upto = start + counts[f"l{i}"], start + counts[f"e{i}"]
            if before < rank <= upto:
                return row
            if upto < rank:
                low, below = row, upto
            elif before >= rank:
                high, end = row, before
                break
        left = end - below


def rows_page(df: DataFrame, order_cols: list[str], start: int, size: int, few: int = FEW) -> DataFrame:
    """Distinct rows among the first ``start + size`` of an ordered frame that are not among the first ``start``.

    Every page is EXCEPT DISTINCT over whole rows (nested columns included), the
    first one too. Rows of equal ``order_cols`` are ordered by a hash of the
    whole row, so pages are the same in every run; equal rows are on the page
    of the first of them.
    """
    cols = [*order_cols, _TIE]
    tied = df.withColumn(_TIE, F.xxhash64(*df.columns))
    keys = cut_lineage(tied.select(*cols), "page-keys")
    page, key = tied, _key(cols)
    if start > 0:
        low = key_at_rank(keys, cols, start, few)
        if low is None:
            return df.limit(0)
        page = page.where(key > _literal(keys, cols, low))
    high = key_at_rank(keys, cols, start + size, few)
    if high is not None:
        page = page.where(key <= _literal(keys, cols, high))
    elif size <= 0:
        return df.limit(0)
    return page.drop(_TIE).distinct()
