"""Variant path access (X1/X2) for raw semi-structured records."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def path(v: Column | str, p: str, type_: str) -> Column:
    """``raw:a:b::type`` -> ``variant_get(raw, '$.a.b', type)``; missing path gives null."""
    return F.variant_get(F.col(v) if isinstance(v, str) else v, p, type_)


def try_path(v: Column | str, p: str, type_: str) -> Column:
    """Like :func:`path` but a value that does not cast gives null instead of an error."""
    return F.try_variant_get(F.col(v) if isinstance(v, str) else v, p, type_)


def kind(v: Column | str, p: str) -> Column:
    """The variant type name at a path ('STRING', 'BIGINT', 'DECIMAL(3,1)', 'OBJECT<..>', 'VOID')
    or null when the path is missing."""
    return F.schema_of_variant(path(v, p, "variant"))


def record(*cols: Column) -> Column:
    """Pack columns into a variant object."""
    return F.to_variant_object(F.struct(*cols))
