"""Latest-version deduplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def latest_per_key(df: DataFrame, keys: list, order_desc: list, key_names: list[str] | None = None,
                   total: bool = False) -> DataFrame:
    """One row per key: the row whose ``order_desc`` tuple is greatest,
    NULLs ranking below any value (``ORDER BY … DESC NULLS LAST``).

    Keys may be expressions (``coalesce(a, b)``); rows with NULL keys
    group together, as a window partition would.  Built on ``max_by`` in a
    grouped aggregate rather than ``row_number`` over a window: the
    aggregate is partially evaluated before the shuffle, so a key holding
    a large share of all rows is reduced per task instead of sorted in one.
    Give a final unique tie-breaker in ``order_desc`` for a deterministic
    survivor, or ask for a ``total`` order: ties are broken by all columns,
    sorted by name, and a row is moved once: as part of that order, without
    the keys that are given by name.
    """
    if total:
        held = {k for k in keys if isinstance(k, str)}
        names = [k if isinstance(k, str) else f"_k{i}" for i, k in enumerate(keys)]
        rest = F.struct(*[F.col(c) for c in sorted(df.columns) if c not in held])
        order = F.struct(*[_c(o).alias(f"_o{i}") for i, o in enumerate(order_desc)], rest.alias("_r"))
        best = df.groupBy(*[_c(k).alias(n) for k, n in zip(keys, names)]).agg(F.max(order)["_r"].alias("_r"))
        return best.select(*[F.col(c) if c in held else F.col("_r")[c].alias(c) for c in df.columns])
    names = key_names or [f"_k{i}" for i in range(len(keys))]
    key_cols = [_c(k).alias(n) for k, n in zip(keys, names)]
    row = F.struct(*[F.col(c) for c in df.columns])
    order = F.struct(*[_c(o).alias(f"_o{i}") for i, o in enumerate(order_desc)])
    return (df.groupBy(*key_cols)
            .agg(F.max_by(row, order).alias("_r"))
            .select("_r.*"))
