"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(*cols, sep: str = "") -> Column:
    """md5 over the text of each part, NULL parts as empty text.

    The default joins parts with no separator, which is what the
    reference's keys are built from (so ``'A'+'BC'`` collides with
    ``'AB'+'C'``); pass ``sep`` for a collision-free key.  Naive
    timestamps render as ``yyyy-MM-dd HH:mm:ss[.ffffff]``, the same text
    PostgreSQL and DuckDB produce.
    """
    parts = [F.coalesce(_as_col(c).cast("string"), F.lit("")) for c in cols]
    if sep:
        return F.md5(F.concat_ws(sep, *parts))
    return F.md5(F.concat(*parts))
