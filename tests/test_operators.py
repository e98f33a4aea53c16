"""Operators on inline mini-tables (FIXTURES §3: A1, A10, W1, W4, S8, U2, R1)."""

from pyspark.sql import functions as F

from casegrid.operators import correlation, frame, patterns, rainfall, risk, upsert


def test_single_row_group_thresholds(spark):
    base = spark.createDataFrame(
        [(2024, "Dysentery", "Colombo", 1, 5.0, 100000.0, 5.0)],
        "year int, disease string, area_reported string, week_number int, cases_reported double, "
        "population double, incidence_per_100k double",
    )
    t = risk.district_thresholds(base).first()
    assert t["std_incidence"] == 0.0 and t["std_cases"] == 0.0
    assert t["lower_threshold"] == t["upper_threshold"] == t["outbreak_threshold"] == t["mean_incidence"] == 5.0
    assert t["weeks"] == 1


def _corr_frame(spark, xs, ys):
    return spark.createDataFrame(
        [("D", "A", float(x), float(y)) for x, y in zip(xs, ys)],
        "disease string, district string, cases_reported double, rainfall_mm double",
    )


def test_correlation_guards(spark):
    const = correlation.per_district(_corr_frame(spark, [3] * 10, range(10)))
    assert const.count() == 0
    nine = correlation.per_district(_corr_frame(spark, range(9), range(9)))
    assert nine.count() == 0
    linear = correlation.per_district(_corr_frame(spark, range(10), [2 * i + 1 for i in range(10)])).first()
    assert linear["correlation"] == 1.0 and linear["n_weeks"] == 10


def test_yoy_zero_previous(spark):
    df = spark.createDataFrame(
        [("D", 2023, 10.0), ("D", 2024, 0.0), ("D", 2025, 5.0)], "disease string, year int, cases_reported double"
    )
    got = {r["year"]: r["yoy_pct_change"] for r in patterns.yoy_change(df).collect()}
    assert got == {2023: None, 2024: -100.0, 2025: None}


def test_peak_month_tie_goes_to_earliest(spark):
    monthly = spark.createDataFrame(
        [("Kalutara", 5, "May", 480.0), ("Kalutara", 10, "Oct", 480.0), ("Kalutara", 1, "Jan", 100.0)],
        "district string, month int, month_name string, avg_rainfall_mm double",
    )
    assert rainfall.peak_months(monthly).first()["peak_month"] == "May"


def test_upsert_last_row_wins_and_idempotent(spark):
    target = spark.createDataFrame([("k1", 1, "id-1")], "k string, v int, id string")
    batch = spark.createDataFrame([("k1", 4, 0), ("k1", 0, 1), ("k2", 7, 2)], "k string, v int, seq int")
    once = upsert.merge_upsert(target, batch, ["k"], ["v"], id_col="id", seq_col="seq").cache()
    got = {r["k"]: (r["v"], r["id"]) for r in once.collect()}
    assert got["k1"] == (0, "id-1")
    assert got["k2"][0] == 7 and got["k2"][1] is not None
    twice = upsert.merge_upsert(once, batch, ["k"], ["v"], id_col="id", seq_col="seq")
    assert {r["k"]: (r["v"], r["id"]) for r in twice.collect()} == got


def test_upsert_integer_ids(spark):
    target = spark.createDataFrame([("a", 1, 7)], "k string, v int, id long")
    batch = spark.createDataFrame([("b", 2), ("c", 3)], "k string, v int")
    out = upsert.merge_upsert(target, batch, ["k"], ["v"], id_col="id").collect()
    ids = {r["k"]: r["id"] for r in out}
    assert ids["a"] == 7 and ids["b"] > 7 and ids["c"] > 7 and ids["b"] != ids["c"]


def test_rainfall_backfill(spark, dims):
    months = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
    cols = "District string, " + ", ".join(f"{m} string" for m in months) + ", Annual string"
    ampara = ("Ampara",) + tuple(str(10 * (i + 1)) for i in range(12)) + ("1,000",)
    wide = spark.createDataFrame([ampara], cols)
    rows = {r["district_id"]: r for r in rainfall.storage_rows(wide, dims).collect()}
    assert set(rows) == {16, 26} and rows[26]["january"] == 10 and rows[26]["annual_rainfall"] == 1000
    kal = ("Kalmunai",) + tuple("1" for _ in range(12)) + ("12",)
    both = {r["district_id"]: r for r in rainfall.storage_rows(spark.createDataFrame([ampara, kal], cols), dims).collect()}
    assert both[26]["january"] == 1


def test_unpivot_keeps_nulls(spark):
    months = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
    cols = "District string, " + ", ".join(f"{m} string" for m in months)
    wide = spark.createDataFrame([("Colombo", "62", None) + ("1",) * 10], cols)
    long = frame.unpivot_months(wide)
    assert long.count() == 12 and long.filter(F.col("avg_rainfall_mm").isNull()).count() == 1
    assert frame.rainfall_long_raw(wide).count() == 11


def test_rain_features_annual_fallback_and_remap(spark, dims):
    months = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
    cols = "Area string, " + ", ".join(f"{m} string" for m in months)
    wide = spark.createDataFrame(
        [("Ampara",) + tuple(str(12 * (i + 1)) for i in range(12)),
         ("Moneragala",) + tuple("1,200" for _ in range(12))],
        cols,
    ).withColumnRenamed("Area", "District")
    annual, national = rainfall.features(wide, dims)
    got = {r["area_key"]: r["avg_annual_rainfall_mm"] for r in annual.collect()}
    assert got == {"Ampara": 78.0, "Monaragala": 1200.0}  # mean of months; canonical names
    jan = national.filter(F.col("month") == 1).first()["national_avg_rainfall_mm"]
    assert jan == (12.0 + 1200.0) / 2


def test_hash_holdout_is_stable_and_complete(spark):
    from casegrid.operators import forecast

    rows = [(2024, w, 1, 100.0, 50.0, a, d, float(w)) for w in range(1, 53) for a in ("A", "B", "C") for d in ("X", "Y")]
    cols = "year int, week_number int, month int, avg_annual_rainfall_mm double, " \
           "national_avg_rainfall_mm double, area_reported string, disease string, cases_reported double"
    df = spark.createDataFrame(rows, cols)
    tr1, te1 = forecast.split_holdout(df, 0.2, 42, "hash")
    tr2, te2 = forecast.split_holdout(df.repartition(7), 0.2, 42, "hash")
    key = lambda f: sorted((r["week_number"], r["area_reported"], r["disease"]) for r in f.collect())
    assert key(te1) == key(te2) and key(tr1) == key(tr2)
    assert tr1.count() + te1.count() == len(rows) and 0 < te1.count() < len(rows)


def test_upsert_integer_ids_over_several_partitions(spark):
    target = spark.createDataFrame([("a", 1, 7)], "k string, v int, id int")
    batch = spark.range(500).select(F.concat(F.lit("n"), "id").alias("k"), F.col("id").cast("int").alias("v")).repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ids = sorted(r["id"] for r in upsert.merge_upsert(target, batch, ["k"], ["v"], id_col="id").collect())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert ids == list(range(7, 508))


def test_rainfall_last_row_by_sequence_and_stand_in(spark, dims):
    months = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
    cols = "District string, " + ", ".join(f"{m} string" for m in months) + ", Annual string, seq int"
    rows = [("Ampara",) + ("5",) * 12 + ("60", 2), ("Ampara",) + ("1",) * 12 + ("12", 1)]
    got = {r["district_id"]: r["january"] for r in rainfall.storage_rows(spark.createDataFrame(rows, cols), dims, "seq").collect()}
    assert got == {16: 5, 26: 5}
