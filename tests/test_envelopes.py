import json
from collections import Counter

import pytest

from skylattice.operators.envelopes import decode_envelopes, encode_envelopes, rejected_messages
from skylattice.schemas import BRONZE
from tests.conftest import plan_of


def decode(spark, *values):
    return decode_envelopes(spark.createDataFrame([(v,) for v in values], "value string"))


def test_fields_come_out_typed(spark):
    state = {"icao24": "e4", "on_ground": False, "velocity": 1, "category": 3, "extra": "x"}
    df = decode(spark, json.dumps({"time": 7, "states": [state, {"icao24": "e5"}]}))
    assert df.schema.simpleString() == BRONZE.simpleString()
    rows = {r.icao24: r for r in df.collect()}
    assert (rows["e4"].time, rows["e4"].velocity, rows["e4"].category) == (7, 1.0, 3)
    assert rows["e5"].on_ground is None and rows["e5"].time == 7


@pytest.mark.parametrize(
    "value",
    [
        "not json",
        '{"time": 1, "states": [',
        '{"time": 1, "states": null}',
        '{"time": 1, "states": []}',
        '{"time": 1}',
        '[{"time": 1}]',
        "",
        None,
    ],
)
def test_messages_without_states_give_no_rows(spark, value):
    assert decode(spark, value).count() == 0


def test_wrongly_typed_field_is_null_and_the_rest_stays(spark):
    value = '{"time": 1, "states": [{"icao24": "a", "velocity": "fast", "category": 2}]}'
    row = decode(spark, value).first()
    assert (row.icao24, row.velocity, row.category) == ("a", None, 2)


def test_bytes_are_decoded(spark):
    value = b'{"time": 1, "states": [{"icao24": "a"}]}'
    df = spark.createDataFrame([(bytearray(value),)], "value binary")
    assert decode_envelopes(df).first().icao24 == "a"


def test_decoding_parses_once_and_does_not_shuffle(spark):
    plan = plan_of(decode(spark, "{}"))
    assert "Exchange" not in plan
    assert sum("from_json" in line for line in plan.splitlines()) == 1


def test_one_poll_is_one_message(bronze):
    df = bronze(*({"time": t, "icao24": a} for t in (1, 2) for a in "abc")).coalesce(1)
    messages = [json.loads(r.value) for r in encode_envelopes(df).collect()]
    assert sorted((m["time"], len(m["states"])) for m in messages) == [(1, 3), (2, 3)]
    assert set(messages[0]["states"][0]) == {f.name for f in BRONZE} - {"time"}


def test_a_wide_poll_is_split_and_nothing_is_lost(bronze):
    rows = [{"time": 1, "icao24": f"a{i % 40}", "velocity": i % 3 + 0.5} for i in range(100)]
    df = bronze(*rows, {"time": None, "icao24": "z"}).repartition(3)
    encoded = encode_envelopes(df, max_states=7)
    assert max(len(json.loads(r.value)["states"]) for r in encoded.collect()) <= 7
    assert Counter(decode_envelopes(encoded).collect()) == Counter(df.collect())


def test_messages_are_bounded_by_bytes_and_nothing_is_lost(bronze):
    rows = [{"time": 1, "icao24": f"a{i}", "callsign": "ä" * (i % 50)} for i in range(300)]
    df = bronze(*rows).coalesce(1)
    encoded = encode_envelopes(df, max_bytes=5000)
    sizes = [len(r.value.encode()) for r in encoded.collect()]
    assert len(sizes) > 10 and max(sizes) < 5000 + 600
    assert Counter(decode_envelopes(encoded).collect()) == Counter(df.collect())


def test_a_poll_of_5000_states_fits_a_topic(bronze):
    df = bronze(*({"time": 1, "icao24": f"a{i}"} for i in range(5000))).coalesce(1)
    assert max(len(r.value) for r in encode_envelopes(df).collect()) < 1_000_000


def test_every_message_is_decoded_or_rejected(spark):
    values = {
        None: "no value",
        "": "no envelope",
        "not json": "no envelope",
        '{"x": 1}': "no envelope",
        '{"time": 1}': "no states",
        '{"time": 1, "states": null}': "no states",
        '{"time": 1, "states": []}': "no states",
        '{"states": [{"icao24": "a"}]}': None,
        '{"time": 1, "states": [{"icao24": "a"}]}': None,
    }
    df = spark.createDataFrame([(v,) for v in values], "value string")
    rejected = {r.value: r.reason for r in rejected_messages(df).collect()}
    assert rejected == {v: reason for v, reason in values.items() if reason}
    assert decode_envelopes(df).count() == 2
    assert "Exchange" not in plan_of(rejected_messages(df))


def test_numbering_and_gathering_share_one_shuffle(bronze):
    plan = plan_of(encode_envelopes(bronze({"time": 1, "icao24": "a"})))
    tree = plan.split("\n\n\n")[0]
    assert tree.count("Exchange") == 1


def test_message_size_must_be_positive(bronze):
    with pytest.raises(ValueError):
        encode_envelopes(bronze({"time": 1}), max_states=0)
