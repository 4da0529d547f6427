from datetime import datetime, timezone

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from urbanweave.functions import clock, text
from urbanweave.functions.similarity import lcs_lengths, ratios
from urbanweave.operators import reshape


def one(spark, column, **values):
    return spark.createDataFrame([values or {"x": 1}]).select(column.alias("r")).first()["r"]


@pytest.mark.parametrize("value, width, want", [("1", 2, "01"), ("12", 2, "12"), ("123", 2, "123"), ("", 2, "00")])
def test_zero_pad_keeps_long_text(spark, value, width, want):
    assert one(spark, text.zero_pad(F.lit(value), width)) == want


def test_identifiers(spark):
    assert one(spark, text.building_ref(F.lit("ES.SDGC.BU.9872023VH5797S_part1"))) == "9872023VH5797S"
    assert one(spark, text.last_token(F.lit("ES.SDGC.BU.9872"))) == "9872"
    assert one(spark, text.street_key_of_address(F.lit("ES.SDGC.AD.08.900.1234.17.X"))) == "08.900.1234"
    assert one(spark, text.street_key_of_street(F.lit("ES.SDGC.TN.08.900.1234"))) == "08.900.1234"
    assert one(spark, text.camel_to_snake(F.lit("homesForTouristUseCP"))) == "homes_for_tourist_use_cp"
    assert one(spark, text.period_index(F.lit("mi7"))) == 6
    assert one(spark, text.bin_value(F.lit("HISTO_-0.02"))) == -0.02


def test_compose_key_is_null_if_a_part_is(spark):
    assert one(spark, text.compose_key(F.lit("a"), F.lit(None).cast("string"))) is None
    assert one(spark, text.compose_key(F.lit("a"), F.lit(1))) == "a-1"


def test_coordinates_as_text(spark):
    ring = F.from_json(F.lit("[[[0.5,1.5],[2.0,3.0]]]"), "array<array<array<double>>>")
    assert one(spark, text.coords_to_text(ring, kind="Polygon")) == "[[0.5,1.5],[2.0,3.0]]"
    assert one(spark, text.coords_to_text(F.array(F.lit(1.5), F.lit(2.5)))) == "1.5 2.5"
    assert one(spark, text.coords_to_text(F.array(F.lit(1.5)), "geojson")) == '{"type":"Point","coordinates":[1.5]}'


def test_impossible_dates_are_null(spark):
    made = clock.assemble_timestamp(F.lit("2023"), F.lit("2"), F.lit("30"), F.lit("5"))
    assert one(spark, made) is None
    good = clock.assemble_timestamp(F.lit("2023"), F.lit("02"), F.lit("28"), F.lit("5"))
    assert one(spark, good.cast("string")) == "2023-02-28 05:00:00"


# The last Sundays of March and October.
CHANGES = ["2019-03-31", "2019-10-27", "2020-03-29", "2020-10-25", "2021-03-28", "2021-10-31", "2022-03-27", "2022-10-30",
           "2023-03-26", "2023-10-29"]


def test_clock_changes_are_the_listed_days(spark):
    hours = spark.sql("select explode(sequence(timestamp'2019-01-01', timestamp'2023-12-31 23:00', interval 1 hour)) as t")
    found = [str(r[0])[:13] for r in hours.where(clock.is_clock_change(F.col("t"))).orderBy("t").collect()]
    assert found == [f"{day} 02" for day in CHANGES]


def test_localised_hours_are_distinct_and_hourly(spark):
    hours = spark.sql("select explode(sequence(timestamp'2023-01-01', timestamp'2023-12-31 23:00', interval 1 hour)) as t")
    kept = hours.where(~clock.is_clock_change(F.col("t"))).select("t", clock.epoch_seconds(clock.localise(F.col("t"))).alias("s"))
    rows = kept.toPandas()
    want = pd.to_datetime(rows["t"]).dt.tz_localize("Europe/Madrid", ambiguous="NaT").astype("int64") // 10**9
    assert (rows["s"] == want).all() and rows["s"].is_unique


@pytest.mark.parametrize("seconds, count, want", [(0, 20, 0), (9_999_999, 20, 0), (10_000_000, 20, 1), (-5, 20, 19),
                                                  (200_000_000, 20, 0), (1_590_969_600, 4, 3)])
def test_time_bucket(spark, seconds, count, want):
    assert one(spark, clock.time_bucket(F.lit(seconds), count=count)) == want


@pytest.mark.parametrize("start, freq, want", [
    ("2024-02-10 05:30:00", "P1M", "2024-02-29 05:30:00"), ("2024-02-29 05:30:00", "P1M", "2024-02-29 05:30:00"),
    ("2023-12-31 23:00:00", "PT1H", "2024-01-01 00:00:00"), ("2024-01-01 00:00:00", "P1Y", "2024-12-31 00:00:00")])
def test_period_end(spark, start, freq, want):
    assert one(spark, clock.period_end(F.lit(start).cast("timestamp"), freq).cast("string")) == want


def test_epoch_rounds_down_before_1970(spark):
    assert one(spark, clock.epoch_seconds(F.lit("1969-12-31 23:59:59.5").cast("timestamp"))) == -1


@given(st.integers(-10**9, 2 * 10**9), st.integers(1, 10**8))
@settings(max_examples=200, deadline=None)
def test_bucket_list_covers_every_second(first, length):
    at = lambda s: datetime.fromtimestamp(s, timezone.utc)
    listed = clock.buckets_between(at(first), at(first + length))
    for second in (first, first + length // 2, first + length - 1):
        assert (second // clock.BUCKET_SECONDS) % clock.BUCKET_COUNT in listed


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        above = row[:]
        for j, y in enumerate(b, 1):
            row[j] = above[j - 1] + 1 if x == y else max(above[j], row[j - 1])
    return row[-1]


@given(st.lists(st.tuples(st.text("abcé ", max_size=12), st.text("abcé ", max_size=12)), max_size=20))
@settings(max_examples=150, deadline=None)
def test_lcs_matches_plain_dynamic_programming(pairs):
    left, right = [a for a, _ in pairs], [b for _, b in pairs]
    assert lcs_lengths(left, right).tolist() == [lcs(a, b) for a, b in pairs]


def test_ratio_known_values():
    assert round(float(ratios(["kitten"], ["sitting"])[0]), 2) == 61.54
    assert ratios(["", "a"], ["", ""]).tolist() == [100.0, 0.0]


def test_not_equal_keeps_null(spark):
    rows = spark.createDataFrame([(0,), (1,), (None,)], "n int")
    assert sorted([r.n for r in reshape.not_equal_keep_null(rows, "n", 0).collect()], key=str) == [1, None]
    texts = spark.createDataFrame([("0",), ("12 bis",), (None,)], "n string")
    assert {r.n for r in reshape.not_equal_keep_null(texts, "n", 0).collect()} == {"12 bis", None}


def test_strict_cast_fails_and_lenient_does_not(spark):
    rows = spark.createDataFrame([("1.5",), ("x",)], "v string")
    assert [r.v for r in reshape.cast_columns(rows, ["v"], strict=False).collect()] == [1.5, None]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        reshape.cast_columns(rows, ["v"]).collect()


def test_unpivot_round_trip_and_pandas(spark):
    frame = pd.DataFrame({"id": ["a", "b"], "mi1": [1.0, None], "mi2": [3.0, 4.0]})
    rows = spark.createDataFrame(frame.astype(object).where(frame.notna(), None), "id string, mi1 double, mi2 double")
    long = reshape.unpivot_periods(rows, ["id"], ["mi1", "mi2"], "hour")
    want = frame.melt(id_vars=["id"], var_name="hour", value_name="value")
    key = lambda r: (r[0], r[1], str(r[2]))
    got = sorted([(r.id, r.hour, r.value) for r in long.collect()], key=key)
    assert got == sorted([(a, b, None if pd.isna(c) else c) for a, b, c in want.itertuples(index=False)], key=key)
    back = long.groupBy("id").pivot("hour", ["mi1", "mi2"]).agg(F.first("value"))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect()))


def zones_in_pandas(frame):
    sums = {name: 0.0 for name in reshape.ZONES}
    tests = {"darker": lambda v: v < 0, "dark": lambda v: 0 < v < 0.2, "medium": lambda v: 0.2 < v < 0.4,
             "light": lambda v: 0.4 < v < 0.6, "lighter": lambda v: v > 0.6}
    for name, test in tests.items():
        columns = [c for c in frame.columns if c != "reference" and test(float(c.split("_")[1]))]
        sums[name] = frame[columns].sum(axis=1)
    whole = pd.DataFrame(sums).astype(int)
    return whole.div(whole.sum(axis=1), axis=0) * 100


def test_vegetation_zones_follow_pandas(spark):
    frame = pd.DataFrame({
        "reference": ["a", "b", "c"], "HISTO_-0.02": [1.9, None, 0.0], "HISTO_0": [5.0, 7.0, 9.0], "HISTO_0.1": [2.0, 3.0, 0.0],
        "HISTO_0.2": [4.0, 4.0, 4.0], "HISTO_0.5": [1.0, 1.0, 0.0], "HISTO_0.74": [0.0, 6.0, 0.0]})
    rows = spark.createDataFrame(frame.astype(object).where(frame.notna(), None), "reference string, " + ", ".join(
        f"`{c}` double" for c in frame.columns[1:]))
    got = reshape.row_percentages(reshape.zones_from_columns(rows)).orderBy("reference").toPandas()
    want = zones_in_pandas(frame)
    for name in reshape.ZONES:
        pd.testing.assert_series_equal(got[name], want[name], check_names=False)
    assert got.loc[2, list(reshape.ZONES)].isna().all()  # only bins on the bounds: no zone, no share
    closed = reshape.zones_from_columns(rows, closed="left").orderBy("reference").first()
    assert (closed.dark, closed.medium) == (7.0, 4.0)


def test_flatten_is_the_inverse_of_nest(spark):
    flat = spark.createDataFrame([(1, "x", 2.0)], "`a.b` int, `a.c.d` string, e double")
    nested = reshape.nest_dotted(flat)
    assert nested.schema["a"].dataType.simpleString() == "struct<b:int,c:struct<d:string>>"
    assert reshape.flatten_struct(nested).columns == flat.columns
    assert reshape.flatten_struct(nested).collect() == flat.collect()


def test_rename_months_and_rest(spark):
    rows = spark.createDataFrame([("r", 1.0, 2, 3.0)], "reference string, CONSUMO_M1 double, extra int, CONSUMO_M12 double")
    long = reshape.unpivot_rest(reshape.rename_months(rows, 2023), ["reference"])
    assert {(r.date, r.value) for r in long.collect()} == {("2023-01-01", 1.0), ("extra", 2.0), ("2023-12-01", 3.0)}
