"""All streams at once: change records land, Bronze appends them, Silver
enriches Bronze (stream on a stream), notifications tail the same records.
A second wave arrives while the queries run; every stage sees it exactly
once."""

import json
import os

from stridelake.sources.cdc import read_cdc_stream, write_landing
from stridelake.sources.tables import read_table
from stridelake.streaming.bronze import start_bronze
from stridelake.streaming.notifications import start_notifications
from stridelake.streaming.silver import start_silver

TOPIC = "raw.activities"
RAW = "value string, topic string, partition int, offset long, timestamp timestamp"


def _msg(aid, op="c", ts=1000, source="live"):
    return json.dumps({"payload": {
        "activity_id": aid, "employee_id": 1, "start_at": "2024-01-01T10:00:00Z",
        "end_at": "2024-01-01T10:30:00Z", "sport_type": "Running", "distance_m": 4200.0,
        "comment": None, "source": source, "created_at": "2024-01-01T10:00:00Z",
        "__op": op, "__table": "activities", "__source_ts_ms": ts}})


def test_streams_together(spark, tmp):
    p = {k: os.path.join(tmp, k) for k in ("landing", "bronze", "silver", "notif", "bad")}
    emp = spark.createDataFrame([(1, "Ana", "Lopez", "R&D", "CDI", None)],
                                "employee_id int, first_name string, last_name string, business_unit string, "
                                "contract_type string, annual_gross_salary decimal(12,2)")
    sp = spark.createDataFrame([(1, "Running")], "employee_id int, sport string")
    write_landing(spark.createDataFrame([(_msg(1), TOPIC, 0, 1, None), (_msg(2, source="x"), TOPIC, 0, 2, None)], RAW),
                  p["landing"])
    src = lambda: read_cdc_stream(spark, TOPIC, source="landing", landing_path=p["landing"])
    qb = start_bronze(src(), p["bronze"], os.path.join(tmp, "ck_b"))
    qb.processAllAvailable()
    qs = start_silver(spark, p["bronze"], p["silver"], os.path.join(tmp, "ck_s"), lambda s: emp, lambda s: sp)
    qn = start_notifications(src(), p["notif"], p["bad"], os.path.join(tmp, "ck_n"), lambda s: emp)
    try:
        for q in (qs, qn):
            q.processAllAvailable()
        write_landing(spark.createDataFrame([(_msg(1, op="u", ts=2000), TOPIC, 0, 3, None),
                                             (_msg(3), TOPIC, 0, 4, None)], RAW), p["landing"])
        for q in (qb, qs, qn):
            q.processAllAvailable()
        qs.processAllAvailable()
    finally:
        for q in (qb, qs, qn):
            q.stop()
    assert read_table(spark, p["bronze"]).count() == 4
    silver = read_table(spark, p["silver"])
    assert silver.count() == 4 and silver.select("batch_id").distinct().count() >= 2
    notes = sorted((r.activity_id, r.__getitem__("__op")) for r in read_table(spark, p["notif"]).collect())
    assert notes == [(1, "c"), (1, "u"), (3, "c")]
