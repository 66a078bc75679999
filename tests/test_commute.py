from decimal import Decimal

from stridelake.operators import commute as C

EMP = "employee_id int, first_name string, last_name string, home_address string, commute_mode string"
DIST = "employee_id int, distance_m long, api_error string"
WALK, BIKE = "Marche/running", "Vélo/Trottinette/Autres"


def test_boundaries_and_texts(spark):
    emp = spark.createDataFrame([
        (1, "a", "A", "h1", WALK), (2, "b", "B", "h2", WALK), (3, "c", "C", "h3", WALK),
        (4, "d", "D", "h4", "  " + BIKE + " "), (5, "e", "E", "h5", None),
        (6, "f", "F", "h6", BIKE), (7, "g", "G", "h7", "Transports en commun"),
    ], EMP)
    dist = spark.createDataFrame([
        (1, 15000, None), (2, 15004, None), (3, 15010, None), (4, 25010, None),
        (5, 1000, None), (6, None, "timeout"), (7, 3000, None),
    ], DIST)
    out = {r.employee_id: r for r in C.validate_commutes(emp, dist, "2025-01-24").collect()}
    assert out[1].validation_status == "VALID" and out[1].distance_km == Decimal("15.00")
    assert out[2].validation_status == "VALID" and out[2].distance_km == Decimal("15.00")
    assert out[3].validation_status == "ANOMALY"
    assert out[3].anomaly_reason == "Distance 15.01 km supérieure au seuil de 15 km."
    assert out[4].validation_status == "ANOMALY" and out[4].google_travel_mode == "BICYCLE"
    assert out[4].anomaly_reason == "Distance 25.01 km supérieure au seuil de 25 km."
    assert out[5].validation_status == "NOT_APPLICABLE" and out[5].distance_m is None
    assert out[5].threshold_km is None and out[5].google_travel_mode is None
    assert out[6].validation_status == "ERROR" and out[6].api_error == "timeout"
    assert out[6].threshold_km == Decimal("25.00") and out[6].distance_km is None
    assert out[7].validation_status == "NOT_APPLICABLE"


def test_reason_text_like_python_float(spark):
    emp = spark.createDataFrame([(1, "a", "A", "h", WALK), (2, "b", "B", "h", WALK)], EMP)
    dist = spark.createDataFrame([(1, 20000, None), (2, 17250, None)], DIST)
    out = {r.employee_id: r.anomaly_reason for r in C.validate_commutes(emp, dist, "2025-01-24").collect()}
    assert out[1] == f"Distance {round(20000 / 1000, 2)} km supérieure au seuil de 15 km."
    assert out[2] == f"Distance {round(17250 / 1000, 2)} km supérieure au seuil de 15 km."


def test_scope_all_and_counts_with_zeros(spark):
    emp = spark.createDataFrame([(1, "a", "A", "h", WALK), (2, "b", "B", "h", "Autre")], EMP)
    dist = spark.createDataFrame([], DIST)
    cv = C.validate_commutes(emp, dist, "2025-01-24", scope="all")
    out = {r.employee_id: r.validation_status for r in cv.collect()}
    assert out == {1: "ERROR", 2: "NOT_APPLICABLE"}
    counts = {r.validation_status: r.employee_count for r in C.commute_status_counts(cv).collect()}
    assert counts == {"VALID": 0, "ANOMALY": 0, "NOT_APPLICABLE": 1, "ERROR": 1}


def test_anomalies_view_and_prune(spark):
    emp = spark.createDataFrame([(1, "a", "A", "h", WALK), (2, "b", "B", "h", WALK)], EMP)
    dist = spark.createDataFrame([(1, 30000, None), (2, 1000, None)], DIST)
    cv = C.validate_commutes(emp, dist, "2025-01-24")
    an = C.commute_anomalies(cv, emp).collect()
    assert [r.employee_id for r in an] == [1] and an[0].first_name == "a"
    pruned = C.prune_orphans(cv, emp.where("employee_id = 2"))
    assert [r.employee_id for r in pruned.collect()] == [2]


def test_km_rounding_follows_python_round(spark):
    """The validation rounds with Python's round(): half to even on the
    binary double, so 15 005 m is 15.0 km (VALID) and 17 125 m is 17.12."""
    metres = [15005, 15015, 17125, 17135, 25005, 30995]
    emp = spark.createDataFrame([(i, "a", "A", "h", WALK) for i in range(len(metres))], EMP)
    dist = spark.createDataFrame([(i, m, None) for i, m in enumerate(metres)], DIST)
    out = {r.employee_id: r for r in C.validate_commutes(emp, dist, "2025-01-24").collect()}
    for i, m in enumerate(metres):
        km = round(m / 1000, 2)
        assert float(out[i].distance_km) == km
        assert out[i].validation_status == ("VALID" if km <= 15 else "ANOMALY")
        if km > 15:
            assert out[i].anomaly_reason == f"Distance {km} km supérieure au seuil de 15 km."
