import pytest
from pyspark.sql import functions as F

from obslake.operators import events
from obslake.sources.topics import USER_EVENT_FIELDS, user_event_descriptor


def frames(spark, *values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "n int, value binary")


def test_split(spark):
    df = frames(
        spark, b"\x00\x00\x00\x01\x02\x00body", b"\x01\x00\x00\x00\x01\x00x", b"", None, b"\x00\x00\x00\x00\x01\x02x", b"\x00\x00",
        b"\x00\xff\xff\xff\xff\x00",
    )
    rows = {r.n: r for r in events.split_frames(df).collect()}
    assert set(rows) == {0, 1, 4, 5, 6}
    assert (rows[0].schema_id, bytes(rows[0].payload), rows[0].reject_reason) == (258, b"body", None)
    assert rows[1].reject_reason == "unexpected magic byte 0x01"
    assert rows[4].reject_reason == "unsupported message index" and rows[5].reject_reason == "frame too short"
    assert (bytes(rows[6].payload), rows[6].schema_id) == (b"", 2**32 - 1)


def test_frames_round_trip(spark):
    df = spark.createDataFrame([("u", b"body")], "key string, payload binary")
    row = events.split_frames(events.frame_payload(df, 513)).first()
    assert (row.key, row.schema_id, bytes(row.payload), row.reject_reason) == ("u", 513, b"body", None)


def test_descriptor_of_the_message():
    pb = pytest.importorskip("google.protobuf.descriptor_pb2")
    from google.protobuf import descriptor_pool, message_factory

    files = pb.FileDescriptorSet.FromString(user_event_descriptor())
    pool = descriptor_pool.DescriptorPool()
    pool.Add(files.file[0])
    message = message_factory.GetMessageClass(pool.FindMessageTypeByName("UserEvent"))
    event = message(user_id="u", timestamp_ms=5, properties={"a": "b"})
    assert event.SerializeToString() == b"\x0a\x01u\x18\x05:\x06\x0a\x01a\x12\x01b"
    assert [f.name for f in message.DESCRIPTOR.fields] == USER_EVENT_FIELDS


def test_wrong_magic_fails_the_query(spark):
    good = frames(spark, b"\x00\x00\x00\x00\x01\x00a", b"\x00\x00\x00\x00\x01\x02b")
    assert [bytes(r.payload) for r in events.require_frames(events.split_frames(good)).collect()] == [b"a"]
    with pytest.raises(Exception, match="unexpected magic byte 0x07"):
        events.require_frames(events.split_frames(frames(spark, b"\x07\x00\x00\x00\x01\x00a"))).collect()


REQUEST = (
    "user_id string, event_type string, timestamp_ms long, service_id string, session_id string, "
    "environment string, properties map<string,string>"
)


def test_defaults_and_line(spark):
    df = spark.createDataFrame(
        [("u1", "LOGIN", 5, "svc", None, None, None), ("u2", "BUY", None, "svc", "s", "prod", {"a": "b"}), (" ", "x", 1, None, None, None, None)],
        REQUEST,
    )
    valid, rejected = events.validate_user_events(df)
    assert rejected.first().reject_reason == "userId must not be blank; serviceId must not be blank"
    rows = {r.user_id: r for r in events.build_user_event(valid).collect()}
    assert tuple(rows["u1"]) == ("u1", "LOGIN", 5, "svc", "", "", {})
    assert rows["u2"].properties == {"a": "b"} and rows["u2"].timestamp_ms > 1_700_000_000_000
    line = events.user_event_line(events.build_user_event(valid).filter("user_id = 'u1'")).first().line
    assert line == "[UserEvent] userId=u1 type=LOGIN service=svc env= ts=5"


def test_fixed_arrival_time(spark):
    df = spark.createDataFrame([("u", "t", None, "s", None, None, None)], REQUEST)
    assert events.build_user_event(df, now=F.lit(9)).first().timestamp_ms == 9
