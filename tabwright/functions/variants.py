"""Semi-structured values: absent against null, string or object, list or object."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def part(v: Column, path: str) -> Column:
    """The value at ``path`` as a variant; SQL NULL only when the key is absent."""
    return F.try_variant_get(v, path, "variant")


def kind_of(v: Column) -> Column:
    """``STRING``, ``BIGINT``, ``BOOLEAN``, ``OBJECT<...>``, ...; ``VOID`` for an explicit null."""
    return F.schema_of_variant(v)


def is_absent(v: Column, path: str) -> Column:
    return part(v, path).isNull()


def is_explicit_null(v: Column, path: str) -> Column:
    return F.coalesce(F.is_variant_null(part(v, path)), F.lit(False))


def default_when_absent(v: Column, path: str, default: str) -> Column:
    """Text at ``path``; the default only if the key is absent, an explicit null stays NULL."""
    return F.when(is_absent(v, path), F.lit(default)).otherwise(F.try_variant_get(v, path, "string"))


def unwrap_first(v: Column) -> Column:
    """The first element of a non-empty list; anything else, an empty list included, as it is."""
    first = F.when(kind_of(v).startswith("ARRAY"), F.try_variant_get(v, "$[0]", "variant"))
    return F.coalesce(first, v)


def string_or_object(v: Column, path: str, key: str, default: str) -> Column:
    """An object gives its ``key`` or the default; any other value is given as text."""
    value = part(v, path)
    inner = F.coalesce(F.try_variant_get(value, f"$.{key}", "string"), F.lit(default))
    return F.when(kind_of(value).startswith("OBJECT"), inner).otherwise(F.try_variant_get(v, path, "string"))


def member_or(v: Column, path: str, default: str) -> Column:
    """Text at ``path``, or the default when there is none."""
    return F.coalesce(F.try_variant_get(v, path, "string"), F.lit(default))
