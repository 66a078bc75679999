"""Property tests: keyed upsert and latest-by-key are order-insensitive and
idempotent; hot keys do not change results."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st

from stridelake.operators import cdc as CDC
from stridelake.operators import master as M
from stridelake.operators import quality as Q

LOG = "activity_id long, v long, __op string, __source_ts_ms long, kafka_partition int, kafka_offset long"

events = st.lists(st.tuples(st.integers(0, 5), st.integers(0, 1000), st.sampled_from(["c", "u", "d", "r"]),
                            st.integers(0, 50)), min_size=1, max_size=40)


def _expected(rows):
    best = {}
    for aid, v, op, ts, part, off in rows:
        k = (ts, part, off)
        if aid not in best or k > best[aid][0]:
            best[aid] = (k, v, op)
    return {a: v for a, (k, v, op) in best.items() if op != "d"}


@settings(max_examples=15, deadline=None)
@given(events)
def test_current_state_matches_brute_force_in_any_order(spark, evs):
    rows = [(a, v, op, ts, 0, i) for i, (a, v, op, ts) in enumerate(evs)]
    shuffled = rows[:]
    random.Random(len(rows)).shuffle(shuffled)
    got = {r.activity_id: r.v for r in CDC.current_state(spark.createDataFrame(shuffled, LOG)).collect()}
    assert got == _expected(rows)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 9), st.integers(0, 99)), max_size=20),
       st.lists(st.tuples(st.integers(0, 9), st.integers(0, 99)), max_size=20))
def test_upsert_idempotent(spark, target_rows, change_rows):
    target = spark.createDataFrame(list({k: (k, v) for k, v in target_rows}.values()), "k int, v int")
    changes = spark.createDataFrame(list({k: (k, v) for k, v in change_rows}.values()), "k int, v int")
    once = M.upsert_table(target, changes, "k")
    twice = M.upsert_table(once, changes, "k")
    a = sorted(tuple(r) for r in once.collect())
    assert a == sorted(tuple(r) for r in twice.collect())
    want = dict(target_rows and {k: v for k, v in dict((k, v) for k, v in target_rows).items()})
    want.update(dict(change_rows))
    assert dict(a) == want


def test_hot_employee_third_of_rows(spark):
    """One employee owns a third of the activities; every rule still
    reports every row (no capping, no sampling)."""
    n = 30000
    df = spark.range(n).selectExpr(
        "id as activity_id",
        "cast(case when id % 3 = 0 then 7 else id % 1000 + 10 end as int) as employee_id",
        "timestamp'2024-01-01 10:00:00' as start_at",
        "timestamp'2024-01-01 09:00:00' as end_at",            # DQ02 for every row
        "'Judo' as sport_type", "cast(null as decimal(18,2)) as distance_m")
    emps = spark.range(10, 1010).selectExpr("cast(id as int) as employee_id")   # 7 is unknown
    res = Q.dq_results(df, emps, as_of="2030-01-01")
    s = {r.rule_name: r.anomaly_count for r in Q.dq_summary(res).collect()}
    assert s == {"DQ02_INVALID_DURATION": n, "DQ04_UNKNOWN_EMPLOYEE": n // 3}


SPORTS = [None, "", "  ", "\t", "Runing", "Running", "Judo", "Tennis", "Marche", "Randonnée", "Voile", "Yoga"]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from([1, 2, 3, None]), st.integers(-3, 3), st.integers(-3, 3),
                          st.sampled_from(SPORTS), st.sampled_from([None, -5, 0, 12])),
                min_size=1, max_size=30))
def test_dq_rules_match_brute_force(spark, rows):
    import datetime as dt
    from decimal import Decimal
    from stridelake.functions import constants as K
    base, now = dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 11)
    data = [(i, emp, base + dt.timedelta(days=s), base + dt.timedelta(days=s, hours=e), sport,
             None if d is None else Decimal(d)) for i, (emp, s, e, sport, d) in enumerate(rows)]
    acts = spark.createDataFrame(data, "activity_id long, employee_id int, start_at timestamp, end_at timestamp, "
                                       "sport_type string, distance_m decimal(18,2)")
    emps = spark.createDataFrame([(1,), (2,)], "employee_id int")
    got = sorted((r.activity_id, r.rule_name) for r in Q.dq_results(acts, emps, as_of=now).collect())
    want = []
    for aid, emp, start, end, sport, dist in data:
        if dist is not None and dist < 0:
            want.append((aid, K.DQ01))
        if end <= start:
            want.append((aid, K.DQ02))
        if sport is None or sport.strip(" ") == "":
            want.append((aid, K.DQ03))
        if emp not in (1, 2):
            want.append((aid, K.DQ04))
        if start > now:
            want.append((aid, K.DQ05))
        if dist is not None and sport in K.NON_DISTANCE_SPORTS:
            want.append((aid, K.DQ06))
        if dist is None and sport in K.DISTANCE_SPORTS:
            want.append((aid, K.DQ07))
        if sport == "Runing":
            want.append((aid, K.DQ08))
    assert got == sorted(want)


MODES = [None, "Marche/running", "Vélo/Trottinette/Autres", "Transports en commun", " Marche/running"]
STATUSES = [None, "VALID", "ANOMALY", "ERROR", "NOT_APPLICABLE"]


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(MODES), st.integers(0, 20), st.sampled_from(STATUSES),
                          st.sampled_from([None, 30000, 45678.91])), min_size=1, max_size=12))
def test_benefit_eligibility_matches_brute_force(spark, emps):
    import datetime as dt
    from decimal import ROUND_HALF_UP, Decimal
    from stridelake.operators import benefits as B
    emp_rows, act_rows, cv_rows, aid = [], [], [], 0
    for i, (mode, n, status, sal) in enumerate(emps):
        emp_rows.append((i, "f", "l", None if sal is None else Decimal(str(sal)).quantize(Decimal("0.01")), mode))
        for _ in range(n):
            aid += 1
            act_rows.append((aid, i, dt.datetime(2024, 6, 1), Decimal("1.00")))
        if status is not None:
            cv_rows.append((i, status))
    emp = spark.createDataFrame(emp_rows, "employee_id int, first_name string, last_name string, "
                                          "annual_gross_salary decimal(12,2), commute_mode string")
    acts = spark.createDataFrame(act_rows, "activity_id long, employee_id int, start_at timestamp, "
                                           "distance_m decimal(18,2)")
    cv = spark.createDataFrame(cv_rows, "employee_id int, validation_status string")
    out = {r.employee_id: r for r in
           B.benefit_eligibility(emp, acts, cv, B.default_parameters(spark, "2025-01-01"),
                                 "2025-01-24 00:00:00").collect()}
    status_of = dict(cv_rows)
    for i, (mode, n, status, sal) in enumerate(emps):
        r = out[i]
        assert r.activity_count_12m == n and r.wellness_eligible == (n >= 15)
        assert r.wellness_days == (5 if n >= 15 else 0)
        physical = None if mode is None else mode in ("Marche/running", "Vélo/Trottinette/Autres")
        valid = None if i not in status_of else status_of[i] == "VALID"
        # SQL AND: FALSE wins, then NULL
        expect = False if (physical is False or valid is False) else (
            None if (physical is None or valid is None) else True)
        assert r.bonus_eligible == expect
        if expect:
            want = None if sal is None else (Decimal(str(sal)).quantize(Decimal("0.01")) * Decimal("0.05")
                                             ).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)
            assert r.bonus_amount == want
        else:
            assert r.bonus_amount == 0


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(
    st.sampled_from([1, 2, None]),
    st.sampled_from([None, "", "  ", "Running", "Judo", "Randonnée", "Marche"]),
    st.sampled_from([None, 1150.0, 1250.0, 5750.0, -40.0, 0.0, 12345.6]),
    st.sampled_from([("2024-01-01T10:00:00Z", "2024-01-01T10:30:00Z"), ("2024-01-01T10:00:00Z", "2024-01-01T10:00:20Z"),
                     ("2024-01-01T10:00:00Z", "2024-01-01T10:02:30Z"), ("bad", "2024-01-01T10:00:00Z"),
                     (None, None), ("2024-01-01T10:00:00+02:00", "2024-01-01T08:45:30Z")]),
    st.sampled_from([None, "", " ", "  super ", "Historique simulé", "\tActivité live simulée\n", "ok"])),
    min_size=1, max_size=15))
def test_notification_text_matches_python_model(spark, events):
    import datetime as dt
    from stridelake.functions import constants as K
    from stridelake.operators.notify import notifications

    def model(emp_id, sport_type, dist, start, end, comment):
        names = {1: "Ana Lopez", 2: "Bo None"}
        who = names.get(emp_id, f"Employé {emp_id}")
        sport = sport_type or "sport"

        def ts(v):
            try:
                return dt.datetime.fromisoformat(v.replace("Z", "+00:00")) if isinstance(v, str) else None
            except ValueError:
                return None
        t0, t1 = ts(start), ts(end)
        parts = [f"🏃 Bravo {who} ! Tu viens de terminer une activité {sport}"]
        if dist is not None and sport in K.DISTANCE_SPORTS:
            parts.append(f" de {dist / 1000:.1f} km")
        if t0 and t1:
            parts.append(f" en {max(1, round((t1 - t0).total_seconds() / 60))} min")
        parts.append(" ! 🔥🏅")
        c = (comment or "").strip()
        if c and c not in K.IGNORED_COMMENTS:
            parts.append(f'\n💬 "{c}"')
        return "".join(parts)

    rows = [(i, e, s, d, a, b, c, "live", "c", i) for i, (e, s, d, (a, b), c) in enumerate(events)]
    ev = spark.createDataFrame(rows, "activity_id long, employee_id long, sport_type string, distance_m double, "
                                     "start_at string, end_at string, comment string, source string, __op string, "
                                     "kafka_offset long")
    emp = spark.createDataFrame([(1, "Ana", "Lopez"), (2, "Bo", None)], "employee_id int, first_name string, last_name string")
    got = {r.activity_id: r.message for r in notifications(ev, emp).collect()}
    for i, (e, s, d, (a, b), c) in enumerate(events):
        assert got[i] == model(e, s, d, a, b, c), (i, e, s, d, a, b, c)


CELLS = [None, "", " ", "\t", " 12 ", "29.0", "12,7", "-3.9", "1e3", "0", "7.", "n/a", "30940,55", " 25,5\n"]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(CELLS), st.sampled_from(CELLS), st.sampled_from(CELLS)),
                min_size=1, max_size=20))
def test_master_cleaning_matches_python_model(spark, rows):
    from decimal import ROUND_HALF_UP, Decimal

    def blank(v):
        t = "" if v is None else str(v).strip()
        return t or None

    def as_float(v):
        t = blank(v)
        if t is None:
            return None
        try:
            return float(t.replace(",", "."))
        except ValueError:
            return None                       # the engine nulls junk instead of failing the load

    def as_int(v):
        f = as_float(v)
        return None if f is None else int(f)

    def as_money(v):
        t = blank(v)
        if t is None:
            return None
        try:
            return Decimal(t.replace(",", ".")).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)
        except Exception:
            return None

    df = spark.createDataFrame(rows, "paid_leave_days string, annual_gross_salary string, last_name string")
    got = [(r.paid_leave_days, r.annual_gross_salary, r.last_name) for r in M.clean_employees(df).collect()]
    want = [(as_int(a), as_money(b), blank(c)) for a, b, c in rows]
    assert got == want


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(
    st.sampled_from([None, "Marche/running", " Vélo/Trottinette/Autres\t", "Transports en commun", ""]),
    st.one_of(st.none(), st.integers(0, 40000), st.sampled_from([15000, 15005, 15015, 25005, 24995, 17125]))),
    min_size=1, max_size=25))
def test_commute_matches_python_model(spark, rows):
    from stridelake.functions import constants as K
    from stridelake.operators import commute as C
    rules = {m: (t, km) for m, t, km in K.COMMUTE_RULES}

    def model(mode, metres):
        rule = rules.get((mode or "").strip())
        if not rule:
            return ("NOT_APPLICABLE", None, None)
        if metres is None:
            return ("ERROR", None, None)
        km = round(metres / 1000, 2)
        if km <= rule[1]:
            return ("VALID", km, None)
        return ("ANOMALY", km, f"Distance {km} km supérieure au seuil de {rule[1]} km.")

    emp = spark.createDataFrame([(i, "h", m) for i, (m, _) in enumerate(rows)],
                                "employee_id long, home_address string, commute_mode string")
    dist = spark.createDataFrame([(i, d, None if d is not None else "timeout") for i, (_, d) in enumerate(rows)],
                                 "employee_id long, distance_m long, api_error string")
    got = {r.employee_id: (r.validation_status, None if r.distance_km is None else float(r.distance_km),
                           r.anomaly_reason)
           for r in C.validate_commutes(emp, dist, "2025-01-24").collect()}
    assert got == {i: model(m, d) for i, (m, d) in enumerate(rows)}


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.sampled_from([1, 2, 99, None]), st.integers(-2, 2),
                          st.sampled_from([None, "", " ", "Judo"]), st.sampled_from([None, -1, 0, 5])),
                min_size=1, max_size=25))
def test_intake_matches_python_model(spark, rows):
    import datetime as dt
    from decimal import Decimal
    from stridelake.functions import constants as K
    from stridelake.operators import intake as I
    t0 = dt.datetime(2024, 1, 1, 10)
    data = [(i, e, t0, t0 + dt.timedelta(hours=h), s, None if d is None else Decimal(d), None)
            for i, (e, h, s, d) in enumerate(rows)]
    batch = spark.createDataFrame(data, "activity_id long, employee_id long, start_at timestamp, "
                                        "end_at timestamp, sport_type string, distance_m decimal(18,2), "
                                        "comment string")
    emps = spark.createDataFrame([(1,), (2,)], "employee_id long")

    def reason(e, start, end, s, d):
        if e is None or s is None:
            return K.REJECT_MISSING_FIELD
        if len(s) < 1:
            return K.REJECT_EMPTY_SPORT
        if d is not None and d < 0:
            return K.REJECT_NEGATIVE_DISTANCE
        if end <= start:
            return K.REJECT_END_BEFORE_START
        if e not in (1, 2):
            return K.REJECT_UNKNOWN_EMPLOYEE
        return None

    v = I.validate_intake(batch, emps)
    acc = {r.activity_id for r in I.accepted(v).collect()}
    rej = {r.activity_id: r.reject_reason for r in I.rejected(v).collect()}
    assert acc.isdisjoint(rej) and len(acc) + len(rej) == len(data)
    for i, e, start, end, s, d, _ in data:
        want = reason(e, start, end, s, d)
        assert (i in acc) if want is None else (rej[i] == want)


@settings(max_examples=12, deadline=None)
@given(st.lists(st.sampled_from([None, "", " ", "CDI", "CDD", "Stage"]), min_size=1, max_size=60))
def test_profile_distribution_matches_python_model(spark, contracts):
    from collections import Counter
    from decimal import ROUND_HALF_UP, Decimal
    from stridelake.operators import profile as P
    emp = spark.createDataFrame([(i, "m", "bu", c) for i, c in enumerate(contracts)],
                                "employee_id long, commute_mode string, business_unit string, contract_type string")
    sports = spark.createDataFrame([(0, "Judo")], "employee_id long, sport string")
    got = {r.value: (r.n, r.percent) for r in P.profile_distribution(emp, sports).collect()
           if r.dimension == "contracts"}
    labels = Counter((c or "").strip() or "(vide)" for c in contracts)
    total = len(contracts)
    want = {k: (n, (Decimal(100 * n) / Decimal(total)).quantize(Decimal("0.1"), rounding=ROUND_HALF_UP))
            for k, n in labels.items()}
    assert got == want
