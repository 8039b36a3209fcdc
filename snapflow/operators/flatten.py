"""Nested-record flattening, as a column projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _flat_columns(dtype: T.StructType, path: list[str], column: Column, sep: str) -> list[Column]:
    out: list[Column] = []
    for field in dtype.fields:
        child = column[field.name]
        name = path + [field.name]
        if isinstance(field.dataType, T.StructType):
            out += _flat_columns(field.dataType, name, child, sep)
        else:
            out.append(child.alias(sep.join(name)))
    return out


def flatten_structs(df: DataFrame, sep: str = ".") -> DataFrame:
    """Replace every struct column by one column per leaf, named ``a.b.c``.

    Arrays (and maps) are kept as they are.  A NULL struct yields NULL leaves;
    the parent column never survives next to its leaves.
    """
    cols: list[Column] = []
    for field in df.schema.fields:
        top = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.StructType):
            cols += _flat_columns(field.dataType, [field.name], top, sep)
        else:
            cols.append(top)
    return df.select(*cols)


def normalize_pair(df: DataFrame, parent: str, children: tuple[str, ...], sep: str = ".") -> DataFrame:
    """Accept ``parent`` nested or already flat; always end with ``parent.child`` columns.

    A parent that is not an object (e.g. NULL or text) gives NULL children.
    Flat input is left unchanged.
    """
    flat = [f"{parent}{sep}{c}" for c in children]
    if all(name in df.columns for name in flat):
        return df.drop(parent) if parent in df.columns else df
    if parent in df.columns:
        dtype = df.schema[parent].dataType
        adds = {}
        for child, name in zip(children, flat):
            if isinstance(dtype, T.StructType) and child in dtype.fieldNames():
                adds[name] = F.col(f"`{parent}`")[child].cast("double")
            else:
                adds[name] = F.lit(None).cast("double")
        return df.withColumns(adds).drop(parent)
    return df.withColumns({name: F.lit(None).cast("double") for name in flat if name not in df.columns})
