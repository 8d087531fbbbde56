"""Rows to keyed JSON messages and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def encode_messages(df: DataFrame, key: str, **beside: Column) -> DataFrame:
    """One message per row: the key as text, the whole row as JSON bytes.

    NULL fields are left out of the JSON and timestamps keep milliseconds. ``beside``
    adds columns that travel next to the payload.
    """
    row = F.struct(*[F.col(c) for c in df.columns])
    return df.select(
        F.col(key).cast("string").alias("partitionKey"),
        F.to_json(row).cast("binary").alias("data"),
        *[column.alias(name) for name, column in beside.items()],
    )


def as_schema(schema: StructType | str) -> StructType:
    return StructType.fromDDL(schema) if isinstance(schema, str) else schema


def parsed(payload: Column, schema: StructType | str) -> Column:
    """JSON bytes as a struct; what cannot be read becomes NULL."""
    return F.from_json(payload.cast("string"), as_schema(schema))


def decode_messages(
    df: DataFrame,
    schema: StructType | str,
    arrival: str | None = "arrival_time",
    processing: str | None = "processing_time",
) -> DataFrame:
    """Payload columns, then the arrival time and the time of this micro-batch.

    Pass ``None`` for a time column that is not wanted.
    """
    schema = as_schema(schema)
    times = []
    kept = []
    if arrival:
        times.append(F.col("approximateArrivalTimestamp").alias(arrival))
        kept.append(F.col(arrival))
    if processing:
        kept.append(F.current_timestamp().alias(processing))
    return df.select(parsed(F.col("data"), schema).alias("data"), *times).select("data.*", *kept)


def undecodable(payload: Column, schema: StructType | str) -> Column:
    """True where no field of the payload could be read."""
    row = parsed(payload, schema)
    fields = [row[f.name].isNull() for f in as_schema(schema).fields]
    empty = fields[0]
    for field in fields[1:]:
        empty = empty & field
    return empty


NO_PAYLOAD, NOT_JSON, NOT_AN_OBJECT, BAD_FIELDS, NO_FIELDS = (
    "no payload", "not json", "not an object", "bad fields", "no fields"
)


def faults(payload: Column, schema: StructType | str) -> Column:
    """What is wrong with a payload: STRUCT<reason STRING, fields ARRAY<STRING>>, the reason NULL where nothing is.

    * ``no payload``: it is NULL
    * ``not json``: nothing could be read and it is no JSON
    * ``not an object``: a number, a text, a list or ``null``
    * ``bad fields``: there are values that do not fit the schema; ``fields`` names them. Others may be readable
    * ``no fields``: an object such as ``{}`` with no value for any field of the schema

    A payload is parsed at most twice, once by the schema and once as a VARIANT.
    """
    schema = as_schema(schema)
    text = payload.cast("string")

    def values(read: Column) -> Column:
        """Per field whether it was read, and whether the payload has a value for it."""
        found = []
        for field in schema.fields:
            # a name is quoted in the path, by the quote that it does not have
            quote = '"' if "'" in field.name else "'"
            value = F.try_variant_get(read["whole"], f"$[{quote}{field.name}{quote}]", "variant")
            given = ~F.is_variant_null(F.coalesce(value, F.parse_json(F.lit("null"))))
            found.append(F.struct(
                F.lit(field.name).alias("name"), read["row"][field.name].isNotNull().alias("read"), given.alias("given"),
            ))
        return F.struct(
            read["text"].isNull().alias("nothing"), read["whole"].isNotNull().alias("strict"), read["begun"].alias("is_object"),
            F.array(*found).alias("found"),
        )

    def judged(seen: Column) -> Column:
        found = seen["found"]
        names = F.transform(F.filter(found, lambda v: v["given"] & ~v["read"]), lambda v: v["name"])
        reason = (
            F.when(seen["nothing"], NO_PAYLOAD)
            .when(~seen["strict"] & ~F.exists(found, lambda v: v["read"]), NOT_JSON)
            .when(~seen["strict"], F.lit(None))  # the reader takes some spellings that are no strict JSON
            .when(~seen["is_object"], NOT_AN_OBJECT)
            .when(F.size(names) > 0, BAD_FIELDS)
            .when(~F.exists(found, lambda v: v["given"]), NO_FIELDS)
        )
        return F.struct(reason.alias("reason"), names.alias("fields"))

    # what does not begin like an object is none, strict or not, and the reader gives nothing of it
    begun = F.ltrim(text, F.lit(" \t\n\r")).startswith("{")
    row = F.when(begun, parsed(payload, schema))
    if SparkSession.active().conf.get("spark.sql.columnNameOfCorruptRecord") in schema.names:
        # but for the corrupt text, which is not the same beside other fields: each is read by itself
        row = F.struct(*[parsed(payload, StructType([f]))[f.name].alias(f.name) for f in schema.fields])
    read = F.struct(text.alias("text"), begun.alias("begun"), row.alias("row"), F.try_parse_json(text).alias("whole"))
    # the argument of a lambda is evaluated once, a column that stands in two places is evaluated in both
    return F.transform(F.transform(F.array(read), values), judged)[0]
