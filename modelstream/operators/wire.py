"""Message values to rows and back. Bad input is set apart, never an error that stops a stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from modelstream.functions.features import let
from modelstream.schemas import ENVELOPE, MODEL, RECORD, ddl

_TEXT_MODEL = (
    "struct<name:string,description:string,data_type:string,model_kind:int,data:string,location:string,ts:bigint>"
)


def _parsed(value: Column, kind: str, build: Callable[[Column], Column]) -> Column:
    """`build` of the JSON value, parsed once; null when it is malformed."""
    with_rest = kind[:-1] + ",__rest:string>"
    row = F.from_json(
        value.cast("string"), with_rest, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__rest"}
    )
    return let(row, lambda r: F.when(r.isNotNull() & r.getField("__rest").isNull(), build(r)))


def decode_record(value: Column) -> Column:
    """A RECORD struct; null when the value cannot be decoded. Absent fields read as 0, "" and no features."""
    return _parsed(
        value,
        ddl(RECORD),
        lambda row: F.struct(
            F.coalesce(row.getField("record_id"), F.lit(0)).cast("bigint").alias("record_id"),
            F.coalesce(row.getField("data_type"), F.lit("")).alias("data_type"),
            F.coalesce(row.getField("ts"), F.lit(0)).cast("bigint").alias("ts"),
            F.coalesce(row.getField("features"), F.array().cast("array<double>")).alias("features"),
        ),
    )


def decode_record_or_default(value: Column) -> Column:
    """A RECORD struct; the empty record when the value cannot be decoded."""
    empty = F.struct(
        F.lit(0).cast("bigint").alias("record_id"),
        F.lit("").alias("data_type"),
        F.lit(0).cast("bigint").alias("ts"),
        F.array().cast("array<double>").alias("features"),
    )
    return F.coalesce(decode_record(value), empty)


def decode_model(value: Column) -> Column:
    """A MODEL struct; null when the value cannot be decoded. A kind code nobody knows is kept for the registry to judge.

    The payload is base64 text. A model with a payload has no location, one without has an empty payload.
    """

    def build(row: Column) -> Column:
        payload = F.try_to_binary(row.getField("data"), F.lit("base64"))
        inline = row.getField("data").isNotNull()
        return F.when(
            ~inline | payload.isNotNull(),
            F.struct(
                F.coalesce(row.getField("name"), F.lit("")).alias("name"),
                F.coalesce(row.getField("description"), F.lit("")).alias("description"),
                F.coalesce(row.getField("data_type"), F.lit("")).alias("data_type"),
                F.coalesce(row.getField("model_kind"), F.lit(0)).alias("model_kind"),
                F.when(inline, payload).otherwise(F.lit("").cast("binary")).alias("model"),
                F.when(~inline, F.coalesce(row.getField("location"), F.lit(""))).alias("location"),
                F.coalesce(row.getField("ts"), F.lit(0)).cast("bigint").alias("ts"),
            ),
        )

    return _parsed(value, _TEXT_MODEL, build)


def encode_record(*fields: Column) -> Column:
    """A record as a JSON message value."""
    return F.to_json(F.struct(*fields)).cast("binary")


def encode_model(
    name: Column, description: Column, data_type: Column, kind: Column, payload: Column, location: Column, ts: Column
) -> Column:
    """A model descriptor as a JSON message value with either the payload or the location."""
    return F.to_json(
        F.struct(
            name.alias("name"),
            description.alias("description"),
            data_type.alias("data_type"),
            kind.alias("model_kind"),
            F.base64(payload).alias("data"),
            F.when(payload.isNull(), location).alias("location"),
            ts.cast("bigint").alias("ts"),
        )
    ).cast("binary")


def from_protobuf_record(value: Column, message: str, descriptor_file: str) -> Column:
    """`value` through Spark's protobuf functions, for sessions that carry the connector jar."""
    try:
        from pyspark.sql.protobuf.functions import from_protobuf
    except ImportError as error:  # pragma: no cover
        raise RuntimeError("this session has no protobuf connector") from error
    return from_protobuf(value, message, descriptor_file, {"mode": "PERMISSIVE"})


def data_envelope(record: Column) -> Column:
    """A record as an ENVELOPE; a missing record has the empty type."""
    return F.struct(
        F.coalesce(record.getField("data_type"), F.lit("")).alias("data_type"),
        F.coalesce(record.getField("ts"), F.lit(0)).cast("bigint").alias("ts"),
        record.cast(ddl(RECORD)).alias("data"),
        F.lit(None).cast(ddl(MODEL)).alias("model"),
    )


def model_envelope(model: Column) -> Column:
    """A model as an ENVELOPE; a missing model has the empty type."""
    return F.struct(
        F.coalesce(model.getField("data_type"), F.lit("")).alias("data_type"),
        F.coalesce(model.getField("ts"), F.lit(0)).cast("bigint").alias("ts"),
        F.lit(None).cast(ddl(RECORD)).alias("data"),
        model.cast(ddl(MODEL)).alias("model"),
    )


def envelopes(
    records: DataFrame, models: DataFrame, value: str = "value", bad_input: str = "drop", arrival: str | None = None
) -> DataFrame:
    """Both message streams as one stream of ENVELOPE rows.

    `arrival` names a column of the models with their order of arrival (the offset of a topic). The rows then carry it as ``seq``,
    null for records, and `split_envelopes` gives it to the models: of models of one time the last to arrive counts, which
    nothing inside a message tells.

    Messages of models without a type, or that cannot be decoded, are left out: nothing can meet them. So are such records,
    unless ``bad_input="mark"``: then they pass as the empty record with the empty type, which serving under the policy
    of that name answers. `quarantine` returns the messages themselves.
    """
    if bad_input not in ("drop", "mark"):
        raise ValueError(f"bad_input must be drop or mark, not {bad_input!r}")
    order = [] if arrival is None else [F.col(arrival).cast("bigint").alias("seq")]
    parsed = models.select(model_envelope(decode_model(F.col(value))).alias("e"), *order)
    left = typed(parsed.select("e.*", *[c for c in parsed.columns if c != "e"]))
    decode = decode_record_or_default if bad_input == "mark" else decode_record
    right = records.select(data_envelope(decode(F.col(value))).alias("e")).select("e.*")
    return left.unionByName(typed(right) if bad_input == "drop" else right, allowMissingColumns=arrival is not None)


def typed(rows: DataFrame) -> DataFrame:
    """Rows with a non-empty type."""
    return rows.filter(F.length("data_type") > 0)


def split_envelopes(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The records and the models of an ENVELOPE stream, the models with ``seq`` where the stream carries it."""
    records = rows.filter(F.col("data").isNotNull()).select("data.*")
    models = rows.filter(F.col("data").isNull()).select("model.*", *[c for c in rows.columns if c == "seq"])
    return records, models


def decodable(messages: DataFrame, decoder, value: str = "value") -> DataFrame:
    """The decoded rows of the messages that can be decoded."""
    return messages.select(decoder(F.col(value)).alias("parsed")).filter(F.col("parsed").isNotNull()).select("parsed.*")


def quarantine(messages: DataFrame, decoder, value: str = "value") -> DataFrame:
    """The messages that cannot be decoded, as they came."""
    return messages.filter(decoder(F.col(value)).isNull())


def register_decoders(spark: SparkSession) -> None:
    """SQL functions ``deserialize_record(value)`` and ``deserialize_model(value)``, both ENVELOPE structs or null.

    They are SQL functions, not Python ones: their bodies are inlined into the query that calls them.
    """
    envelope = ddl(ENVELOPE)

    def function(name: str, kind: str, body: str) -> None:
        options = "map('mode', 'PERMISSIVE', 'columnNameOfCorruptRecord', '__rest')"
        row = f"from_json(CAST(value AS STRING), '{kind[:-1]},__rest:string>', {options})"
        # One parsed value per message, however often the body mentions it.
        spark.sql(
            f"""
            CREATE OR REPLACE TEMPORARY FUNCTION {name}(value BINARY) RETURNS {envelope} RETURN
              get(transform(array({row}), r -> CASE WHEN r IS NOT NULL AND r.__rest IS NULL THEN {body} END), 0)
            """
        )

    function(
        "deserialize_record",
        ddl(RECORD),
        f"""CAST(struct(coalesce(r.data_type, ''), coalesce(r.ts, 0L),
              struct(coalesce(r.record_id, 0L), coalesce(r.data_type, ''), coalesce(r.ts, 0L),
                     coalesce(r.features, CAST(array() AS array<double>))), NULL) AS {envelope})""",
    )
    function(
        "deserialize_model",
        _TEXT_MODEL,
        f"""CASE WHEN r.data IS NULL OR try_to_binary(r.data, 'base64') IS NOT NULL THEN
              CAST(struct(coalesce(r.data_type, ''), coalesce(r.ts, 0L), NULL,
                struct(coalesce(r.name, ''), coalesce(r.description, ''), coalesce(r.data_type, ''),
                       coalesce(r.model_kind, 0), coalesce(try_to_binary(r.data, 'base64'), X''),
                       CASE WHEN r.data IS NULL THEN coalesce(r.location, '') END, coalesce(r.ts, 0L))) AS {envelope}) END""",
    )
