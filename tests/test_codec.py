from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from streamweir.functions.codec import decode_messages, encode_messages, faults, undecodable
from streamweir.schemas import CDC, CLICK, ENVELOPE, IMPRESSION, IMPRESSION_LONG, KEYED_MESSAGE
from streamweir.sources.streams import read_messages
from streamweir.streaming.run import drain_to_table
from tests.helpers import bag, instants

PAYLOADS = [
    b"{bad",
    b'{"adId":"x","impressionTime":"2024-01-01T12:00:00.000Z"}',
    b'{"adId":3000000000,"impressionTime":"2024-01-01T12:00:00.000Z"}',
    b'{"adId":7}',
    b'{"adId":8,"impressionTime":"2024-01-01T12:00:00.123Z","more":1}',
]
NOON = datetime(2024, 1, 1, 12)


def envelopes(spark):
    rows = [(p, NOON) for p in PAYLOADS]
    return instants(spark, rows, "data BINARY, approximateArrivalTimestamp TIMESTAMP")


def test_bad_fields_become_null(spark):
    got = bag(decode_messages(envelopes(spark), IMPRESSION, arrival=None, processing=None))
    assert got == {
        (None, None): 1, (None, NOON): 2, (7, None): 1, (8, NOON.replace(microsecond=123000)): 1,
    }


def test_long_ids_need_the_long_schema(spark):
    got = bag(decode_messages(envelopes(spark), IMPRESSION_LONG, arrival=None, processing=None))
    assert got[(3_000_000_000, NOON)] == 1


def test_undecodable_are_counted(spark):
    bad = envelopes(spark).where(undecodable(F.col("data"), IMPRESSION))
    assert [bytes(r.data) for r in bad.collect()] == [b"{bad"]


def test_time_columns(spark):
    got = decode_messages(envelopes(spark), IMPRESSION)
    assert got.columns == ["adId", "impressionTime", "arrival_time", "processing_time"]
    assert got.where("arrival_time <= processing_time").count() == len(PAYLOADS)
    assert got.select("processing_time").distinct().count() == 1


def test_encoding(spark):
    rows = instants(
        spark, [(1, None, datetime(2024, 1, 1, 12, 0, 0, 123456))], "id LONG, name STRING, ts TIMESTAMP"
    )
    sent = encode_messages(rows, "id")
    assert [f.name for f in sent.schema] == StructType.fromDDL(KEYED_MESSAGE).names
    row = sent.first()
    assert (row.partitionKey, bytes(row.data)) == ("1", b'{"id":1,"ts":"2024-01-01T12:00:00.123Z"}')
    back = sent.select(F.from_json(F.col("data").cast("string"), CDC).alias("r")).select("r.*").first()
    assert (back.id, back.name, back.amount) == (1, None, None)


def test_key_is_found_in_any_case(spark):
    rows = instants(spark, [(5, NOON)], "adId INT, clickTime TIMESTAMP")
    row = encode_messages(rows, "adid").first()
    assert row.partitionKey == "5" and b'"adId":5' in bytes(row.data)


def test_schemas_convert_to_ddl_and_back(spark):
    for ddl in (ENVELOPE, KEYED_MESSAGE, CDC, IMPRESSION, CLICK):
        schema = StructType.fromDDL(ddl)
        assert StructType.fromDDL(schema.toDDL()) == schema


def test_message_stream(spark, folder):
    envelopes(spark).write.parquet(f"{folder}/messages")
    decoded = decode_messages(read_messages(spark, f"{folder}/messages"), IMPRESSION, processing=None)
    assert drain_to_table(decoded, f"{folder}/run").count() == len(PAYLOADS)


def test_message_stream_by_connector_name(spark):
    # any streaming format with these two columns will do; this one has others
    try:
        read_messages(spark, fmt="rate")
    except Exception as error:
        assert "data" in str(error)
    else:
        raise AssertionError("the envelope columns were not asked for")


def test_faults_have_reasons_and_name_the_fields(spark):
    cases = {
        None: ("no payload", []),
        b"": ("not json", []),
        b"{bad": ("not json", []),
        b"\xff\xfe": ("not json", []),
        b"{}": ("no fields", []),
        b'{"adId":null,"impressionTime":null}': ("no fields", []),
        b'{"more":1}': ("no fields", []),
        b"null": ("not an object", []),
        b"7": ("not an object", []),
        b'"adId"': ("not an object", []),
        b'["adId"]': ("not an object", []),
        b'{"adId":"x","impressionTime":"2024-01-01T12:00:00.000Z"}': ("bad fields", ["adId"]),
        b'{"adId":3000000000,"impressionTime":"no time"}': ("bad fields", ["adId", "impressionTime"]),
        b'{"adId":{"a":1}}': ("bad fields", ["adId"]),
        b'{"adId":7}': (None, []),
        b'{"adId":8,"impressionTime":"2024-01-01T12:00:00.123Z","more":1}': (None, []),
        b"{'adId':9}": (None, []),
    }
    rows = spark.createDataFrame([(p,) for p in cases], "data BINARY")
    got = rows.select("data", faults(F.col("data"), IMPRESSION).alias("f")).select("data", "f.*").collect()
    assert {None if r.data is None else bytes(r.data): (r.reason, r.fields) for r in got} == cases
    # what could be read is what the reader gives
    read = rows.where(faults(F.col("data"), IMPRESSION)["reason"].isin("no payload", "not json", "no fields"))
    assert read.where(~undecodable(F.col("data"), IMPRESSION)).count() == 0


def test_faults_of_fields_with_odd_names(spark):
    row = spark.createDataFrame([(b'{"a.b":"x","it\\u0027s":"y","c d":1}',)], "data BINARY")
    fault = row.select(faults(F.col("data"), "`a.b` INT, `it's` INT, `c d` INT").alias("f")).select("f.*").first()
    assert (fault.reason, fault.fields) == ("bad fields", ["a.b", "it's"])


def test_faults_parse_a_payload_once_per_reader(spark):
    """However often reason and fields are used, behind an aggregate too; before, each use parsed anew."""
    rows = spark.createDataFrame([(p,) for p in PAYLOADS], "data BINARY").select(faults(F.col("data"), IMPRESSION).alias("f"))
    counted = rows.groupBy("f.reason", F.array_join("f.fields", ",").alias("fields")).count()
    plan = counted._jdf.queryExecution().optimizedPlan().toString()
    assert (plan.count("from_json("), plan.count("parseJson(cast")) == (1, 1)
    assert {(r.reason, r.fields): r["count"] for r in counted.collect()} == {
        ("not json", ""): 1, ("bad fields", "adId"): 2, (None, ""): 2,
    }


def test_faults_of_fields_of_any_kind(spark):
    cases = {
        b'{"a":{"b":1},"c":[1]}': (None, []),
        b'{"a":7,"c":[1]}': ("bad fields", ["a"]),
        b'\n\t {"c":"x"}': ("bad fields", ["c"]),
        b' [{"c":[1]}]': ("not an object", []),
        b"'c'": ("not json", []),
    }
    rows = spark.createDataFrame([(p,) for p in cases], "data BINARY")
    got = rows.select("data", faults(F.col("data"), "a STRUCT<b INT>, c ARRAY<INT>").alias("f")).select("data", "f.*").collect()
    assert {bytes(r.data): (r.reason, r.fields) for r in got} == cases
    # a schema with the column of corrupt records reads that text where it reads nothing else
    kept = rows.select("data", faults(F.col("data"), "c ARRAY<INT>, _corrupt_record STRING").alias("f")).select("data", "f.*").collect()
    assert {bytes(r.data): r.reason for r in kept}[b"'c'"] is None
