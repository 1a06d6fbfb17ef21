"""Column expressions and row operators on hand-made rows."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluice.functions import keys, numbers, time
from sluice.operators import scan, totals
from sluice.operators.rollup import keyed, rollup, rollup_10s, rollup_all
from sluice.schema import GRAINS, KPI_EVENT, REGIONS, region_dimension
from sluice.sources.tables import kpi_events


def one(spark, expr, **values):
    names = list(values)
    kinds = {str: "string", int: "bigint", float: "double", datetime: "timestamp", Decimal: "decimal(18,2)"}
    schema = ", ".join(f"{n} {kinds[type(values[n])]}" for n in names)
    return spark.createDataFrame([tuple(values.values())], schema).select(expr.alias("x")).first().x


@pytest.mark.parametrize(
    "text, grain, period",
    [
        ("BY_REGION_PT1M", "REGION", "PT1M"),
        ("by_state_pt10m", "STATE", "PT10M"),
        ("BY_STORE_PT1H", "STORE", "PT1H"),
        ("STATE_OF_STORE_PT1M_PT10M", "STORE", "PT10M"),
        ("REGION_STATE_PT1M_PT1H", "STATE", "PT1H"),
        ("PT10M_PT1H", None, "PT10M"),
        ("BY_CITY_PT5M", None, "UNK"),
        ("", None, "UNK"),
    ],
)
def test_type_text(spark, text, grain, period):
    assert one(spark, keys.grain_of(F.col("t")), t=text) == grain
    assert one(spark, keys.period_of(F.col("t")), t=text) == period


def test_labels(spark):
    for label, period in {"Hours": "PT1H", "10-Minute": "PT10M", "Minute": "PT1M", "?": "PT1M"}.items():
        assert time.period_for_label(label) == period
        assert one(spark, time.period_of_label(F.col("t")), t=label) == period


def test_local_time_knows_daylight_saving(spark):
    for utc, local in ((datetime(2019, 11, 27, 3), 0), (datetime(2018, 12, 27, 3), 1)):
        text = utc.strftime("PT1H#%Y-%m-%d %H:%M:%S.000#7")
        t = time.parse_time(keys.sort_key_time(F.col("sk")))
        assert one(spark, t.cast("timestamp_ntz"), sk=text) == utc
        assert one(spark, time.local_time(t).cast("timestamp_ntz"), sk=text).hour == local


@pytest.mark.parametrize("text, micros", [("2019-01-01", 0), ("2024-01-01 10:00:00.5", 500000),
                                          ("2024-01-01T10:00:00.123456", 123456), ("soon", None)])
def test_parse_time(spark, text, micros):
    got = one(spark, time.parse_time(F.col("t")), t=text)
    assert (got.microsecond if got else None) == micros


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(seconds=st.lists(st.integers(-(10**9), 4 * 10**9), min_size=1, max_size=50), width=st.sampled_from([10, 60, 3600]))
def test_step(spark, seconds, width):
    df = spark.createDataFrame([(s,) for s in seconds], "s bigint")
    got = df.select("s", time.step_seconds(F.col("s"), width).alias("x")).collect()
    assert all(r.x == r.s // width * width for r in got)


@pytest.mark.parametrize("number, as_int, as_float", [("2.00", 2, None), ("2.50", None, 2.5), ("-1.50", -1, None),
                                                      ("0.00", 0, None), ("-0.99", 0, None)])
def test_json_numbers(spark, number, as_int, as_float):
    d = Decimal(number)
    assert one(spark, numbers.json_int(F.col("d")), d=d) == as_int
    assert one(spark, numbers.json_float(F.col("d")), d=d) == as_float


def test_thousands(spark):
    assert one(spark, numbers.thousands(F.col("n")), n=1234567) == "1,234,567"


def test_regions(spark):
    rows = region_dimension(spark).collect()
    assert [(r.region, r.state) for r in rows] == [(k, s) for k, v in REGIONS.items() for s in v]
    assert len(rows) == 27 and len({r.state for r in rows}) == 26
    assert [r.region for r in rows if r.state == "MA"] == ["NORTH", "NORTHEAST"]


def event(i, event_time, ingest_time, region="NORTH", state="MA", store=1, kpis=(1, 2, 3, 4, 5)):
    return (i, datetime.fromisoformat(event_time), datetime.fromisoformat(ingest_time), region, state, store, *kpis)


@pytest.fixture(scope="module")
def few(spark):
    rows = [
        event(1, "2024-01-01 00:00:01", "2024-01-01 00:00:02"),
        event(2, "2024-01-01 00:00:59", "2024-01-01 00:00:59", kpis=(None, -2, 3, 4, 5)),
        event(3, "2024-01-01 00:00:30", "2024-01-01 00:01:05"),  # late: same event minute, next arrival minute
        event(4, "2024-01-01 00:00:30", "2024-01-01 00:00:45", region="NORTHEAST"),  # MA of the other region
        event(5, "2024-01-01 00:00:30", "2024-01-01 00:00:45", store=2),
    ]
    return spark.createDataFrame(rows, KPI_EVENT)


def test_rollup_of_late_events(few):
    got = {
        (r.region, r.state, r.store_id, r.ingest_time.minute): (r.kpi_1_sum, r.kpi_2_sum, r.n_rec)
        for r in rollup(few, "STATE", "PT1M").collect()
    }
    assert got == {
        ("NORTH", "MA", -1, 0): (2, 2, 3),  # a null KPI is skipped, its row is counted
        ("NORTH", "MA", -1, 1): (1, 2, 1),
        ("NORTHEAST", "MA", -1, 0): (1, 2, 1),
    }
    hour = rollup(few, "REGION", "PT1H").collect()
    assert {(r.region, r.state, r.store_id, r.n_rec) for r in hour} == {
        ("NORTH", "NN", -1, 4), ("NORTHEAST", "NN", -1, 1),
    }


def test_some_grains_and_periods(few):
    whole = rollup_all(few)
    for grains in (["REGION"], ["STATE", "REGION"], list(GRAINS)):
        for periods in (["PT1H"], ["PT1M", "PT10M"]):
            want = whole.filter(F.col("grain").isin(grains) & F.col("period").isin(periods))
            for from_minutes in (True, False):
                got = rollup_all(few, grains, periods, from_minutes)
                assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_ten_second_rollup_has_a_row_per_bucket(few):
    rows = rollup_10s(few, "REGION").filter("region = 'NORTH'").collect()
    assert sorted((r.ingest_time.minute, r.kpi_1_sum or 0) for r in rows) == [(0, 0), (0, 1), (0, 1), (1, 1)]


def test_keys_and_reads(spark, few, small):
    items = keyed(rollup_all(few))
    assert {r.pk for r in items.collect()} == {
        "NORTH", "NORTH#MA", "NORTH#MA#1", "NORTH#MA#2", "NORTHEAST", "NORTHEAST#MA", "NORTHEAST#MA#1",
    }
    assert items.select("pk", "sk").distinct().count() == items.count()
    whole = keyed(rollup_all(kpi_events(spark, small))).cache()
    # reads on typed columns find what reads on text keys find
    for key in (("NORTH",), ("NORTHEAST", "BA"), ("NORTHEAST", "BA", 10)):
        for period in ("PT10M", "PT1H"):
            typed = scan.by_period(scan.by_key(whole, *key), period, "2024-01-15")
            text = scan.by_prefix(whole, "#".join(map(str, key)), f"{period}#2024-01-15")
            assert sorted(map(tuple, typed.collect())) == sorted(map(tuple, text.collect()))
    assert scan.by_key(whole, "SOUTHEAST", "State").isEmpty()
    assert scan.by_key(whole, "NORTH", "").filter("grain <> 'REGION'").isEmpty()
    # pages put together are the whole key, in descending order
    rows = scan.by_period(scan.by_key(whole, "NORTHEAST", "BA"), "PT10M")
    pages, last = [], None
    while page := [r.sk for r in scan.page_after(rows, last, 40).collect()]:
        pages += page
        last = page[-1]
    assert pages == sorted((r.sk for r in rows.collect()), reverse=True)
    # newest rows by typed columns are the newest by sort key
    assert sorted(r.sk for r in scan.newest(rows, 7).collect()) == sorted(pages[:7])
    kept = scan.newest_per_key(whole, 3)
    assert kept.groupBy("pk", "period").count().filter("count > 3").isEmpty()
    top = {r.sk for r in kept.filter("pk = 'NORTHEAST#BA' AND period = 'PT10M'").collect()}
    assert top == set(pages[:3])


def test_dynamic_attributes(spark):
    rows = spark.createDataFrame(
        [("NORTH", datetime(2024, 1, 1, 5), {"kpi1": 1, "kpi9": 7, "count": 3}),
         ("NORTH", datetime(2024, 1, 1, 6), {"kpi1": 2, "kpi2": None})],
        "pk string, ingest_time timestamp_ntz, attributes map<string,bigint>",
    )
    got = {(r.pk, r.day, r.kpi): r.value for r in totals.per_day_dynamic(rows, "attributes").collect()}
    day = "2024-01-01"
    assert got == {("NORTH", day, "kpi1"): 3, ("NORTH", day, "kpi9"): 7, ("NORTH", day, "kpi2"): 0}


def test_unknown_names_are_refused(spark, few):
    with pytest.raises(ValueError):
        scan.kpi_value(few, "kpi_1; drop")
    with pytest.raises(ValueError):
        rollup(few, "REGION", "PT5M")
