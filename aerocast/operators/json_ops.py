"""JSON / nested-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def has_key(payload, key: str) -> Column:
    """``payload ? key`` — top-level key present (even with a null value);
    false for non-object text."""
    keys = F.json_object_keys(_c(payload))
    return F.coalesce(F.array_contains(keys, F.lit(key)), F.lit(False))


def path_not_null(payload, path: str) -> Column:
    """``json_extract(payload, path) IS NOT NULL``."""
    return F.get_json_object(_c(payload), path).isNotNull()


def explode_json_array(df: DataFrame, payload: str, key: str, alias: str,
                       keep: list[str] | None = None) -> DataFrame:
    """One row per element of ``payload.key``; the element stays JSON text.
    Missing key, JSON null, an empty array or a non-object payload all give
    zero rows (no error)."""
    keep = keep if keep is not None else [c for c in df.columns if c != payload]
    arr = F.from_json(_c(payload), T.StructType([T.StructField(key, T.ArrayType(T.StringType()))]))[key]
    return df.select(*keep, F.explode(arr).alias(alias))


def lockstep_explode(arrays: dict[str, Column], element_types: dict[str, str]) -> Column:
    """Generator expression: element i of every array in one row, padded
    with NULL to the longest array; a missing (NULL) array counts as empty
    (``arrays_zip`` alone would return NULL for the whole row set).  Use as
    ``df.select(..., lockstep_explode({...}, {...}))`` — one output column
    per dict key."""
    zipped = F.arrays_zip(*[F.coalesce(a, F.array().cast(f"array<{element_types[n]}>")).alias(n)
                            for n, a in arrays.items()])
    return F.inline(zipped)


def flatten_struct(df: DataFrame, sep: str = ".") -> DataFrame:
    """Nested struct columns → flat columns named ``a.b.c`` (like
    ``json_normalize``); arrays stay as they are."""
    def walk(dt: T.StructType, prefix: list[str]):
        for f in dt.fields:
            path = prefix + [f.name]
            if isinstance(f.dataType, T.StructType):
                yield from walk(f.dataType, path)
            else:
                yield path
    cols = []
    for path in walk(df.schema, []):
        ref = F.col("`" + path[0] + "`")
        for p in path[1:]:
            ref = ref.getField(p)
        cols.append(ref.alias(sep.join(path)))
    return df.select(*cols)


def nested_to_json(df: DataFrame) -> DataFrame:
    """Struct / array / map columns → JSON text (for raw-layer writes)."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)):
            out.append(F.to_json(F.col(f"`{f.name}`")).alias(f.name))
        else:
            out.append(F.col(f"`{f.name}`"))
    return df.select(*out)
