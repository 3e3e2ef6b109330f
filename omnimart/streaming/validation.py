"""Record validation: decode, check, enrich, and route good and failed records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from omnimart.functions.scalars import iso_timestamp

# Fields every event must carry, and the version written into it.
REQUIRED_FIELDS = ("event_id", "event_type", "source_customer_id", "product_id", "event_at")
SCHEMA_VERSION = "retail-event/2.1"

# Results of a record.
OK, FAILED = "Ok", "ProcessingFailed"

ADDED = ("schema_version", "idempotency_key")

#: Form of a timestamp in JSON text.
JSON_TIME = "yyyy-MM-dd'T'HH:mm:ss[.SSS][XXX]"


def unpack_envelope(envelopes: DataFrame) -> DataFrame:
    """One row per record of ``records: array<struct<recordId, data>>``."""
    return envelopes.select(F.explode("records").alias("r")).select("r.recordId", "r.data")


def payload_fields(json: Column) -> Column:
    """Top-level fields of a JSON object with their types; null for anything else.

    A field given twice keeps its last value.
    """

    def distinct(fields: Column) -> Column:
        keys = F.map_keys(fields)
        last = F.filter(
            F.map_entries(fields),
            lambda entry, i: ~F.array_contains(
                F.slice(keys, i + 2, F.greatest(F.size(keys) - i - 1, F.lit(0))), entry["key"]
            ),
        )
        repeated = F.size(F.array_distinct(keys)) < F.size(keys)
        return F.when(repeated, F.map_from_entries(last)).otherwise(fields)

    # The one-element array names the parsed map, so the text is parsed once.
    parsed = F.array(F.from_json(json, "map<string,variant>"))
    return F.transform(parsed, distinct)[0]


def is_valid(fields: Column) -> Column:
    """All required fields present (null counts as present) and a readable event time."""
    present = [F.map_contains_key(fields, name) for name in REQUIRED_FIELDS]
    complete = present[0]
    for condition in present[1:]:
        complete = complete & condition
    return _readable(complete, F.try_variant_get(fields["event_at"], "$", "string"))


def _readable(complete: Column, event_at: Column) -> Column:
    return F.coalesce(complete & iso_timestamp(event_at).isNotNull(), F.lit(False))


def _added(event_id: Column) -> Column:
    """Text of the added fields and the end of the object, for the JSON text of an event's id."""
    return F.concat(F.lit(f'"{ADDED[0]}":"{SCHEMA_VERSION}","{ADDED[1]}":'), event_id, F.lit("}"))


def enriched_json(fields: Column) -> Column:
    """The event with its schema version and idempotency key, as JSON text."""
    carried = F.arrays_overlap(F.map_keys(fields), F.array(*map(F.lit, ADDED)))
    others = F.map_from_entries(F.filter(F.map_entries(fields), lambda entry: ~entry["key"].isin(*ADDED)))
    # The added ones follow the text of the fields, so that no second map is built for them.
    added = _added(F.coalesce(F.to_json(fields["event_id"]), F.lit("null")))

    def extended(text: Column) -> Column:
        return F.concat(F.substring(text, F.lit(1), F.length(text) - 1), F.when(text == "{}", "").otherwise(","), added)

    # The one-element array names the text, so it is made once.
    return F.transform(F.array(F.to_json(F.when(carried, others).otherwise(fields))), extended)[0]


def is_plain(schema: T.StructType) -> bool:
    """Whether the JSON text of such a row is also that of its parsed fields: nothing nested, no number but integers,
    and no name that stands twice or is added."""
    names = schema.names
    plain = all(isinstance(f.dataType, (T.StringType, T.IntegralType, T.BooleanType, T.TimestampType)) for f in schema)
    return bool(names) and plain and len(set(names)) == len(names) and not {*names} & {*ADDED}


def plain_line(events: DataFrame) -> Column:
    """``value`` and ``valid`` as ``enriched_json`` and ``is_valid`` have them for the fields of a plain row, without
    parsing the row's own text again: which fields are there is known from the columns."""
    text = F.to_json(F.struct(*events.columns), {"ignoreNullFields": "false"})
    there = [name in events.columns for name in REQUIRED_FIELDS]
    # No value of a plain row ends with a brace.
    event_id = F.to_json(F.array("event_id"), {"ignoreNullFields": "false"}) if "event_id" in events.columns else F.lit("[null]")
    value = F.concat(F.rtrim(text, F.lit("}")), F.lit(","), _added(F.rtrim(F.ltrim(event_id, F.lit("[")), F.lit("]"))))
    return F.struct(value.alias("value"), _readable(F.lit(all(there)), _event_text(events)).alias("valid"))


def _event_text(events: DataFrame) -> Column:
    """Time of a plain row as its JSON text has it, without quotes."""
    if "event_at" not in events.columns:
        return F.lit(None).cast("string")
    if isinstance(events.schema["event_at"].dataType, T.TimestampType):
        return F.date_format("event_at", JSON_TIME)
    return F.col("event_at").cast("string")


def base64_line(binary: Column) -> Column:
    """Base64 without the line breaks that the encoder puts in."""
    return F.replace(F.base64(binary), F.lit("\r\n"), F.lit(""))


def validate_records(records: DataFrame) -> DataFrame:
    """``recordId, result, data`` for each record of base64 JSON, in the same order of columns.

    Good records get the enriched event, encoded again with a final newline; failed
    ones, among them any without a record id, keep what was sent. A bad record never
    fails the batch.
    """
    decoded = F.try_validate_utf8(F.expr("try_to_binary(data, 'base64')").cast("string"))
    checked = records.withColumn("_fields", payload_fields(decoded)).withColumn(
        "_good", is_valid(F.col("_fields")) & F.col("recordId").isNotNull()
    )
    encoded = base64_line(F.concat(enriched_json(F.col("_fields")), F.lit("\n")).cast("binary"))
    return checked.select(
        F.coalesce("recordId", F.lit("unknown")).alias("recordId"),
        F.when(F.col("_good"), OK).otherwise(FAILED).alias("result"),
        F.when(F.col("_good"), encoded)
        .otherwise(F.coalesce("data", F.lit("")))
        .alias("data"),
    )


def decode_good(validated: DataFrame, event_schema: str) -> DataFrame:
    """Typed columns of the good records."""
    text = F.expr("try_to_binary(data, 'base64')").cast("string")
    return (
        validated.filter(F.col("result") == OK)
        .select(F.from_json(text, event_schema).alias("e"))
        .select("e.*")
    )
