"""Plan-time statistics (row counts, largest groups) that pick a strategy.

They only choose between equivalent plans (window vs range partitions,
broadcast vs shuffle, per-image vs grid join). Nothing that a result depends
on (a split's size, the chunks of a large image) may come from here: the
remembered value does not follow files that change behind a path. Each value is computed by one small Spark job and remembered per
input plan (``semanticHash``) for the application, so queries over the same
inputs do not repeat the job.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

_MEMO: dict[tuple, object] = {}


def memo(tag: str, frames: list[DataFrame], compute: Callable[[], object]):
    try:
        key = (tag, frames[0].sparkSession.sparkContext.applicationId, *[f.semanticHash() for f in frames])
    except Exception:  # noqa: BLE001 - no stable hash: just compute
        return compute()
    if key not in _MEMO:
        _MEMO[key] = compute()
    return _MEMO[key]


def row_count(df: DataFrame) -> int:
    return memo("count", [df], df.count)


def largest_group(df: DataFrame, cols: list[str]) -> int:
    from pyspark.sql import functions as F

    return memo("largest:" + ",".join(cols), [df],
                lambda: df.groupBy(*cols).count().agg(F.max("count")).first()[0] or 0)
