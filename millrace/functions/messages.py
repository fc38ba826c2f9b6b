"""JSON message expressions: strict typed reading and compact writing."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# How a parsed JSON value names its own type.
INTEGRAL = "BIGINT"
SCALAR_TYPES = r"^(?:STRING|BIGINT|BOOLEAN|FLOAT|DOUBLE|DECIMAL\(.*)"


def document(message: Column) -> Column:
    """The parsed message, null when it is not JSON."""
    return F.try_parse_json(message)


def value_type(doc: Column, field: str) -> Column:
    """Type name of a field; null when absent, ``VOID`` when it is JSON null."""
    return F.schema_of_variant(F.try_variant_get(doc, f"$.{field}", "variant"))


def is_present(kind: Column) -> Column:
    return F.coalesce(kind != "VOID", F.lit(False))


def is_integral(kind: Column) -> Column:
    """An integer that fits 64 bits: ``12`` but not ``12.0``, ``"12"`` or 20 digits."""
    return F.coalesce(kind == INTEGRAL, F.lit(False))


def is_scalar(kind: Column) -> Column:
    """Text, number or boolean; objects and arrays have no text view."""
    return F.coalesce(kind.rlike(SCALAR_TYPES), F.lit(False))


def text(doc: Column, field: str) -> Column:
    return F.try_variant_get(doc, f"$.{field}", "string")


def whole(doc: Column, field: str) -> Column:
    return F.try_variant_get(doc, f"$.{field}", "bigint")


def compact_json(**fields: Column) -> Column:
    """``{"a":1,...}`` with the fields in the order given."""
    return F.to_json(F.struct(*[value.alias(name) for name, value in fields.items()]))
