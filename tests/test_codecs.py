import pytest
from pyspark.sql import functions as F, types as T

from logweave import functions as fn
from logweave.schemas import EVENT_SCHEMA, ORDER_EVENT_SCHEMA

GOOD = '{"Id":"5","EntityType":"a","Payload":"p"}'


def decode(spark, values, unwrap=False, schema=EVENT_SCHEMA):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, value string")
    out = fn.decode_json(df.withColumn("value", F.col("value").cast("binary")), schema, unwrap=unwrap)
    return [r for r in out.orderBy("i").collect()]


@pytest.mark.parametrize(
    "value, error",
    [
        (GOOD, None),
        ('{"Id":"5"}', None),
        ('{"Id":null}', None),
        ('{"Id":"5","Other":{"x":[1]}}', None),
        ('  {"Id":"5"}  ', None),
        ("{}", None),
        (None, "null_value"),
        ("null", "null_value"),
        (" null ", "null_value"),
        ("", "malformed_json"),
        ("{bad", "malformed_json"),
        ('{"Id":5}', "malformed_json"),
        ('{"Id":true}', "malformed_json"),
        ('{"Id":{"a":1}}', "malformed_json"),
        ("7", "malformed_json"),
        ('"text"', "malformed_json"),
        (f"[{GOOD}]", "malformed_json"),
        (f"{GOOD}{GOOD}", "malformed_json"),
        (f"{GOOD} tail", "malformed_json"),
        (f"{GOOD}]", "malformed_json"),
        (f"{GOOD}}} {{", "malformed_json"),
        (f'{GOOD},"x":2', "malformed_json"),
        (f'{GOOD},"_end":7', "malformed_json"),
        (f'{GOOD},"value":{GOOD}', "malformed_json"),
        (f'null,"value":{GOOD}', "malformed_json"),
        (f"{GOOD},{GOOD}", "malformed_json"),
        (f"{GOOD}],[{GOOD}", "malformed_json"),
        (f'{GOOD},"_end":7}}', "malformed_json"),
        ("{'Id':'5'}", "malformed_json"),
    ],
)
def test_strict_decode(spark, value, error):
    row = decode(spark, [value])[0]
    assert row["_error"] == error
    assert (row["data"] is None) == (error is not None)


def test_field_names_are_case_sensitive(spark):
    assert decode(spark, ['{"id":"5","Id":"6"}'])[0]["data"]["Id"] == "6"
    assert decode(spark, ['{"ID":"5"}'])[0]["data"]["Id"] is None


def test_nested_strings_are_checked(spark):
    schema = T.StructType.fromDDL("a struct<b string>, c array<string>, m map<string,string>, n bigint")
    good = '{"a":{"b":"x"},"c":["y",null],"m":{"k":"z"},"n":3}'
    bad = ['{"a":{"b":1}}', '{"c":["y",2]}', '{"m":{"k":[]}}', '{"n":"3"}', '{"n":1.5}']
    first, *others = decode(spark, [good, *bad], schema=schema)
    assert first["data"].asDict(recursive=True) == {"a": {"b": "x"}, "c": ["y", None], "m": {"k": "z"}, "n": 3}
    assert [r["_error"] for r in others] == ["malformed_json"] * len(bad)


def test_twice_encoded(spark):
    twice = '"{\\"Id\\":\\"5\\",\\"EntityType\\":\\"a \\\\\\"q\\\\\\" \\u00e9\\"}"'
    values = [twice, GOOD, '"{bad"', '"null"', '"unclosed', f"{twice} x", None]
    out = decode(spark, values, unwrap=True)
    assert out[0]["data"]["EntityType"] == 'a "q" é'
    assert out[1]["data"]["Payload"] == "p"
    assert [r["_error"] for r in out] == [
        None, None, "malformed_json", "null_value", "malformed_json", "malformed_json", "null_value",
    ]
    assert decode(spark, [twice])[0]["_error"] == "malformed_json"


def test_last_header_wins_and_bad_ones_are_errors(spark):
    cases = [
        ([("sequenceId", "-1"), ("x", "y"), ("sequenceId", "7")], 7, None),
        ([("sequenceId", "2147483647")], 2147483647, None),
        ([("sequenceId", "3000000000")], None, "bad_sequence_id"),
        ([("sequenceId", "7"), ("sequenceId", "seven")], None, "bad_sequence_id"),
        ([("SequenceId", "7")], None, "missing_header"),
        ([], None, "missing_header"),
    ]
    data = [(i, [(k, v.encode()) for k, v in h]) for i, (h, _, _) in enumerate(cases)]
    df = spark.createDataFrame(data, "i int, headers array<struct<key:string,value:binary>>")
    out = df.select("i", fn.sequence_id(), fn.sequence_error()).orderBy("i").collect()
    assert [(r[1], r[2]) for r in out] == [(seq, error) for _, seq, error in cases]


def test_partition_from_key(spark):
    keys = [("user 7", 1, None), ("7", 1, None), ("a b 9", 0, None), ("user -5", None, "negative_key_number"),
            ("user", None, "no_key_number"), ("user ", None, "no_key_number"), (None, None, "null_key")]
    df = spark.createDataFrame([(i, k) for i, (k, _, _) in enumerate(keys)], "i int, k string")
    df = df.withColumn("k", F.col("k").cast("binary"))
    out = df.select("i", fn.partition_by_suffix("k", 3), fn.partition_error("k")).orderBy("i").collect()
    assert [(r[1], r[2]) for r in out] == [(p, e) for _, p, e in keys]


def test_int64_keys(spark):
    numbers = [0, 1, -1, 255, 2**63 - 1, -(2**63)]
    df = spark.createDataFrame([(n,) for n in numbers], "n long").withColumn("k", fn.encode_int64("n"))
    for row in df.withColumn("back", fn.decode_int64("k")).collect():
        assert bytes(row["k"]) == row["n"].to_bytes(8, "big", signed=True)
        assert row["back"] == row["n"]
    short = spark.createDataFrame([(bytearray(b"\x01"),)], "k binary")
    assert short.select(fn.decode_int64("k")).first()[0] is None


def test_order_event_bytes(spark):
    """Messages written by hand, following the wire format."""
    cases = [
        (b"\x08\x96\x01\x10\x07\x18\x02", (150, 7, "ORDER_STATE_CHANGED", None), None),
        (b"", (0, 0, "ORDER_STATE_UNSPECIFIED", None), None),
        (b"\x08\x01\x22\x06\x08\x02\x10\xc0\x84\x3d", (1, 0, "ORDER_STATE_UNSPECIFIED", 2_001_000), None),
        (b"\x18\x09", None, "unknown_enum"),
        (b"\x08", None, "malformed_message"),
        (None, None, "null_value"),
    ]
    data = [(i, bytearray(b) if b is not None else None) for i, (b, _, _) in enumerate(cases)]
    df = spark.createDataFrame(data, "i int, value binary")
    out = (
        fn.decode_order_events(df)
        .select("i", "_error", "data.order_id", "data.client_id", "data.order_state", F.unix_micros("data.timestamp"))
        .orderBy("i").collect()
    )
    for row, (_, event, error) in zip(out, cases):
        assert row["_error"] == error
        assert tuple(row[2:]) == (event or (None,) * 4)


def test_absent_fields_do_not_cost_digits(spark):
    big = 2**63 - 1
    data = [(big, None, "ORDER_STATE_CREATED", 1), (None, big - 1, None, None), (-big, 0, None, -1)]
    df = spark.createDataFrame(data, "order_id long, client_id long, order_state string, us long").coalesce(1)
    df = df.withColumn("timestamp", F.timestamp_micros("us"))
    out = fn.decode_order_events(fn.encode_order_events(df))
    found = [(r["data"]["order_id"], r["data"]["client_id"], r["data"]["order_state"]) for r in out.collect()]
    assert found == [
        (big, 0, "ORDER_STATE_CREATED"), (0, big - 1, "ORDER_STATE_UNSPECIFIED"), (-big, 0, "ORDER_STATE_UNSPECIFIED"),
    ]
    assert [r[0] for r in out.select(F.unix_micros("data.timestamp")).collect()] == [1, None, -1]
    unknown = df.limit(1).withColumn("order_state", F.lit("no such state"))
    assert fn.encode_order_events(unknown).first()["value"] is None


def test_codecs_round_trip(spark):
    event = F.struct(F.lit("1").alias("Id"), F.lit('a"\n').alias("EntityType"), F.lit(None).cast("string").alias("Payload"))
    order = F.struct(
        F.lit(5).cast("long").alias("order_id"), F.lit(-6).cast("long").alias("client_id"),
        F.lit("ORDER_STATE_CREATED").alias("order_state"), F.timestamp_micros(F.lit(1_500_000)).alias("timestamp"),
    )
    values = {
        "string": (F.lit("täxt"), None), "int64": (F.lit(-9).cast("long"), None),
        "json": (event, EVENT_SCHEMA), "json2": (event, EVENT_SCHEMA), "order_event": (order, ORDER_EVENT_SCHEMA),
    }
    for name, (value, schema) in values.items():
        codec = fn.codec(name, schema)
        df = spark.range(1).select(value.alias("v")).withColumn("wire", codec.encode(F.col("v")))
        row = df.withColumn("back", codec.decode(F.col("wire"))).first()
        assert row["back"] == row["v"], name
        bad = spark.createDataFrame([(bytearray(b"\xff"),)], "wire binary").select(codec.decode(F.col("wire"))).first()
        assert name == "string" or bad[0] is None
    with pytest.raises(ValueError):
        fn.codec("json")


def test_error_classes(spark):
    cases = [
        ("MsgSizeTooLarge", False, "non_retriable", False, False),
        ("LeaderNotAvailable", False, "retriable", True, True),
        ("RequestTimedOut", False, "retriable", True, False),
        ("RequestTimedOut", True, "retriable", False, False),
        ("SomethingNew", None, "unlisted", True, False),
        (None, None, None, False, False),
    ]
    df = spark.createDataFrame([(c[0], c[1], i) for i, c in enumerate(cases)], "error_code string, is_fatal boolean, i int")
    out = fn.classify_errors(df).orderBy("i").collect()
    assert [(r["error_code"], r["is_fatal"], r["error_class"], r["retryable"], r["cooldown"]) for r in out] == cases
