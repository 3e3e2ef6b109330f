"""Differences of two schemas as rows, and what they mean for a merge."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

# Kinds of change.
SAME, ADDED, REMOVED, WIDENED, NARROWED, RETYPED = "same", "added", "removed", "widened", "narrowed", "retyped"

#: Types a stored column can be read as without loss, by its own type.
WIDER = {
    "tinyint": ("smallint", "int", "bigint"),
    "smallint": ("int", "bigint"),
    "int": ("bigint",),
    "float": ("double",),
}


def widens(stored: T.DataType, incoming: T.DataType) -> bool:
    """Whether every value of the stored type is one of the incoming type, and files of the first can be read as the second."""
    if isinstance(stored, T.DecimalType) and isinstance(incoming, T.DecimalType):
        return incoming.scale >= stored.scale and incoming.precision - incoming.scale >= stored.precision - stored.scale
    return incoming.simpleString() in WIDER.get(stored.simpleString(), ())


def change(stored: T.DataType | None, incoming: T.DataType | None) -> str:
    if stored is None or incoming is None:
        return ADDED if stored is None else REMOVED
    if stored.simpleString() == incoming.simpleString():
        return SAME
    if widens(stored, incoming):
        return WIDENED
    return NARROWED if widens(incoming, stored) else RETYPED


def changes(stored: T.StructType, incoming: T.StructType) -> list[tuple[str, str | None, str | None, str, bool]]:
    """Column, both types, change, and whether a merge bears it; columns in order of the stored schema, then of the incoming one."""
    before, after = ({f.name: f.dataType for f in s} for s in (stored, incoming))
    rows = []
    for name in [*before, *(n for n in after if n not in before)]:
        old, new = before.get(name), after.get(name)
        kind = change(old, new)
        rows.append((name, old and old.simpleString(), new and new.simpleString(), kind, kind != RETYPED))
    return rows


def drift_report(spark: SparkSession, stored: T.StructType, incoming: T.StructType) -> DataFrame:
    """The changes as a table."""
    kind = "column string, stored_type string, incoming_type string, change string, accepted boolean"
    return spark.createDataFrame(changes(stored, incoming), kind)


def merged_schema(stored: T.StructType, incoming: T.StructType) -> T.StructType | None:
    """Schema that holds both, or None where a column changed its type for another kind.

    Added columns come last and are null in stored rows; removed ones are null in incoming rows; of a
    widened or narrowed column the wider type is taken.
    """
    if not all(accepted for *_, accepted in changes(stored, incoming)):
        return None
    after = {f.name: f.dataType for f in incoming}
    kept = [T.StructField(f.name, after[f.name] if f.name in after and widens(f.dataType, after[f.name]) else f.dataType) for f in stored]
    return T.StructType(kept + [T.StructField(f.name, f.dataType) for f in incoming if f.name not in stored.names])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with the columns of ``schema``, in their order and types; columns it lacks are null."""
    return df.select(*((F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema))
