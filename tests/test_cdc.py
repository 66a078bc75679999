import json

from stridelake.operators import cdc as CDC

RAW = "value string, topic string, partition int, offset long, timestamp timestamp"


def _payload(aid, op="c", ts=1000, **kw):
    p = {"activity_id": aid, "employee_id": 7, "start_at": "2024-01-01T10:00:00Z",
         "end_at": "2024-01-01T11:00:00+02:00", "sport_type": "Judo", "distance_m": 12.5,
         "comment": None, "source": "live", "created_at": "2024-01-01T10:00:00Z",
         "__op": op, "__table": "activities", "__source_ts_ms": ts}
    p.update(kw)
    return p


def test_decode_envelope_bare_null_garbage(spark):
    raw = spark.createDataFrame([
        (json.dumps({"schema": {}, "payload": _payload(1)}), "t", 0, 1, None),
        (json.dumps(_payload(2)), "t", 0, 2, None),
        ('{"payload": null}', "t", 0, 3, None),
        ("garbage{", "t", 0, 4, None),
        (None, "t", 0, 5, None),
    ], RAW)
    out = {r.kafka_offset: r for r in CDC.decode_cdc(raw, ingested_at="2024-01-01").collect()}
    assert out[1].activity_id == 1 and out[1].distance_m == 12.5 and out[1]["__op"] == "c"
    assert out[2].activity_id == 2 and out[2].employee_id == 7
    for off in (3, 4, 5):
        assert out[off].activity_id is None
    decoded = CDC.decode_cdc(raw)
    assert CDC.only_valid(decoded).count() == 2 and CDC.malformed(decoded).count() == 3


def _log(spark, rows):
    return spark.createDataFrame(rows, "activity_id long, v string, __op string, __source_ts_ms long, "
                                       "kafka_partition int, kafka_offset long")


def test_latest_by_key_create_update_same_batch(spark):
    log = _log(spark, [(1, "a", "c", 10, 0, 1), (1, "b", "u", 20, 0, 2), (2, "x", "c", 5, 1, 1)])
    cur = {r.activity_id: r.v for r in CDC.current_state(log).collect()}
    assert cur == {1: "b", 2: "x"}


def test_delete_after_latest_and_offset_tie_break(spark):
    log = _log(spark, [
        (1, "a", "c", 10, 0, 1), (1, "a", "d", 30, 0, 3),          # deleted
        (2, "a", "c", 10, 0, 1), (2, "b", "u", 10, 0, 7),          # same ms: offset decides
        (3, "a", "r", 10, 0, 1),                                   # snapshot read = insert
        (4, "a", "d", 5, 0, 1), (4, "z", "c", 9, 0, 2),            # delete then re-create
    ])
    cur = {r.activity_id: r.v for r in CDC.current_state(log).collect()}
    assert cur == {2: "b", 3: "a", 4: "z"}


def test_latest_by_key_is_partial_aggregate(spark):
    log = _log(spark, [(1, "a", "c", 10, 0, 1)])
    plan = CDC.latest_by_key(log, "activity_id")._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan
