"""Job functions on small CSV folders written to a temp dir."""

import os

import pytest
from pyspark.sql import functions as F

from casegrid.plans import jobs
from casegrid.sources import files
from casegrid.streaming import start_historical_ingest

MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
AREAS = ["Colombo", "Gampaha", "Kalutara", "Ampara", "Kalmune"]


def write(path, text, bom=False):
    with open(path, "w", encoding="utf-8-sig" if bom else "utf-8") as fh:
        fh.write(text)


def make_datasets(root, years=(2023, 2024)):
    os.makedirs(root, exist_ok=True)
    for y in years:
        for i, d in enumerate(["Dysentery", "Meningitis", "Tuberculosis"]):
            lines = ["week_number,area_reported,cases_reported"]
            for w in range(1, 21):
                for j, a in enumerate(AREAS):
                    v = "" if (d == "Tuberculosis" and w == 20) else str((w * (j + 1) + i + y) % 7)
                    lines.append(f"{w},{a},{v}")
            write(f"{root}/{y}_{d}.csv", "\n".join(lines) + "\n", bom=(y == years[0] and i == 0))
    write(f"{root}/district_population.csv",
          'Region,Population\nColombo,"2,375,415"\nGampaha,"2,433,685"\nKalutara,"1,305,552"\n'
          'Ampara,"744,551"\nKalmunai,"400,000"\n')
    header = "District," + ",".join(MONTHS) + ",Annual\n"
    body = ""
    for k, a in enumerate(["Colombo", "Gampaha", "Kalutara", "Ampara"]):
        vals = [str(50 + 10 * m + k) for m in range(12)]
        body += f"{a}," + ",".join(vals) + f',"{sum(int(v) for v in vals):,}"\n'
    write(f"{root}/monthly_rainfall.csv", header + body)
    return root


def test_case_reader_file_columns_and_bom(spark, workdir):
    root = make_datasets(f"{workdir}/data")
    df = files.read_case_files(spark, files.case_file_paths(root, [2023, 2024], ["Dysentery"]))
    assert df.columns[:5] == ["year", "disease", "week_number", "area_reported", "cases_reported"]
    got = {(r["year"], r["disease"]) for r in df.select("year", "disease").distinct().collect()}
    assert got == {(2023, "Dysentery"), (2024, "Dysentery")}
    assert df.filter(F.col("week_number").isNull()).count() == 0  # BOM stripped from the header


def test_missing_file_policy(spark, workdir):
    root = make_datasets(f"{workdir}/data")
    paths = files.case_file_paths(root, [2023, 2030], ["Dysentery"])
    with pytest.warns(UserWarning):
        assert files.read_case_files(spark, paths, missing="skip").count() > 0
    with pytest.raises(FileNotFoundError):
        files.read_case_files(spark, paths, missing="error")
    with pytest.raises(FileNotFoundError):
        files.read_case_files(spark, files.case_file_paths(root, [2030], ["Dysentery"]), missing="silent")


def test_risk_and_analytics_jobs(spark, workdir):
    root = make_datasets(f"{workdir}/data")
    inputs = jobs.surveillance_inputs(spark, root, years=(2023, 2024), missing="silent")
    r = jobs.risk_job(inputs, f"{workdir}/out", year=2024)
    assert r["thresholds"].count() == 15  # 3 diseases x 5 districts
    assert r["weekly_risk"].filter(F.col("risk_level") == "Unknown").count() == 0
    assert os.path.isdir(f"{workdir}/out/district_thresholds_2024")
    a = jobs.analytics_job(spark, inputs, f"{workdir}/analytics")
    # Kalmunai reads Ampara's rainfall through the area remap
    kal = a["frame"].filter(F.col("district") == "Kalmunai").filter(F.col("rainfall_mm").isNull()).count()
    assert kal == 0
    assert a["summary_top_hotspots"].count() == 15
    assert os.path.isdir(f"{workdir}/analytics/rain_disease_correlation")


def test_keyed_loads_are_idempotent(spark, workdir):
    root = make_datasets(f"{workdir}/data")
    inputs = jobs.surveillance_inputs(spark, root, years=(2023, 2024), missing="silent")
    table = f"{workdir}/tables/historicaldata"
    first = jobs.load_historical(spark, inputs, table)
    n = 2 * 3 * 20 * 5 - 2 * 5  # blanks in the last Tuberculosis week are skipped
    assert first["upsert"]["inserted"] == n
    ids = {tuple(r[:4]): r["data_id"] for r in spark.read.parquet(table).collect()}
    second = jobs.load_historical(spark, inputs, table)
    assert second["upsert"] == {"inserted": 0, "updated": n, "unchanged": 0}
    again = {tuple(r[:4]): r["data_id"] for r in spark.read.parquet(table).collect()}
    assert again == ids
    rain = jobs.load_rainfall(spark, inputs, f"{workdir}/tables/rainfall_data")
    assert rain["upsert"]["inserted"] == 5  # 4 areas + Kalmunai backfilled from Ampara
    assert "Kalmunai" not in rain["missing_districts"]
    pop = jobs.load_population(spark, inputs, f"{workdir}/tables/perdistrictpopulation")
    assert pop["upsert"]["inserted"] == 5


def test_forecast_job_round_trip(spark, workdir):
    root = make_datasets(f"{workdir}/data")
    inputs = jobs.surveillance_inputs(spark, root, years=(2023, 2024), missing="silent")
    res = jobs.forecast_job(spark, inputs, f"{workdir}/model", f"{workdir}/out", f"{workdir}/tables",
                            year=2026, num_trees=5, max_depth=5)
    assert res["train"]["rows"] > 0 and res["train"]["mae"] >= 0
    preds = spark.read.option("header", True).csv(f"{workdir}/out/predictions_2026")
    assert preds.count() == 5 * 3 * 52
    assert preds.filter(F.col("predicted_cases").cast("int") < 0).count() == 0
    assert res["store"]["upsert"]["inserted"] == 5 * 3 * 52
    reloaded = jobs.predict_job(spark, inputs, f"{workdir}/model", year=2026)
    assert reloaded.count() == 5 * 3 * 52


def test_streaming_ingest_upserts_new_files(spark, workdir):
    root = make_datasets(f"{workdir}/data")
    drop = f"{workdir}/incoming"
    os.makedirs(drop)
    os.link(f"{root}/2023_Dysentery.csv", f"{drop}/2023_Dysentery.csv")
    table, ckpt = f"{workdir}/tables/hist_stream", f"{workdir}/stream_ckpt"
    start_historical_ingest(spark, drop, table, ckpt).awaitTermination()
    assert spark.read.parquet(table).count() == 100
    # a corrected file for the same weeks arrives later: counts are replaced, no new rows
    text = open(f"{root}/2023_Dysentery.csv", encoding="utf-8-sig").read().replace(",Colombo,", ",Colombo,1")
    write(f"{drop}/x_2023_Dysentery.csv", text)
    start_historical_ingest(spark, drop, table, ckpt).awaitTermination()
    out = spark.read.parquet(table)
    assert out.count() == 100
    assert out.filter((F.col("district_id") == 1) & (F.col("week_number") == 1)).first()["case_count"] >= 10


def test_full_pipeline(spark, workdir):
    root = make_datasets(f"{workdir}/data")
    inputs = jobs.surveillance_inputs(spark, root, years=(2023, 2024), missing="silent")
    res = jobs.full_pipeline(spark, inputs, f"{workdir}/tables", f"{workdir}/out", f"{workdir}/model",
                             risk_year=2024, prediction_year=2026, num_trees=5, max_depth=4)
    assert res["population"]["upsert"]["inserted"] == 5
    assert res["rainfall"]["upsert"]["inserted"] == 5
    assert res["historical"]["upsert"]["inserted"] > 0
    assert res["risk"]["upsert"]["inserted"] == 3 * 5 * 20
    assert res["forecast"]["store"]["upsert"]["inserted"] == 5 * 3 * 52
    for name in ("perdistrictpopulation", "rainfall_data", "historicaldata", "risk_levels", "reports"):
        assert spark.read.parquet(f"{workdir}/tables/{name}").count() > 0


def test_partitioned_upsert_rewrites_only_touched_partitions(spark, workdir):
    from casegrid.operators import upsert

    table = f"{workdir}/tables/part"
    first = spark.createDataFrame([(2023, 1, 10), (2024, 1, 20), (2024, 2, 30)], "year int, wk int, v int")
    assert upsert.upsert_table(spark, table, first, ["year", "wk"], ["v"], id_col="id",
                               partition_cols=["year"]) == {"inserted": 3, "updated": 0, "unchanged": 0}
    ids = {(r["year"], r["wk"]): r["id"] for r in spark.read.parquet(table).collect()}
    files_2023 = sorted(os.listdir(f"{table}/year=2023"))
    batch = spark.createDataFrame([(2024, 1, 21), (2024, 3, 40)], "year int, wk int, v int")
    counts = upsert.upsert_table(spark, table, batch, ["year", "wk"], ["v"], id_col="id", partition_cols=["year"])
    assert counts == {"inserted": 1, "updated": 1, "unchanged": 1}
    rows = {(r["year"], r["wk"]): (r["v"], r["id"]) for r in spark.read.parquet(table).collect()}
    assert rows[(2023, 1)] == (10, ids[(2023, 1)]) and rows[(2024, 1)] == (21, ids[(2024, 1)])
    assert rows[(2024, 2)][0] == 30 and rows[(2024, 3)][0] == 40 and len(rows) == 4
    assert sorted(os.listdir(f"{table}/year=2023")) == files_2023  # untouched partition not rewritten


def test_command_line_entry(spark, workdir):
    from casegrid.__main__ import main

    root = make_datasets(f"{workdir}/data")
    res = main(["risk", "--data", root, "--years", "2023,2024", "--missing", "silent",
                "--out", f"{workdir}/out", "--tables", f"{workdir}/tables", "--year", "2024"])
    assert res["thresholds"] == 15 and res["store"]["upsert"]["inserted"] == 15 * 20
    res = main(["load-rainfall", "--data", root, "--years", "2023,2024", "--tables", f"{workdir}/tables"])
    assert res["upsert"]["inserted"] == 5


def test_streaming_replay_leaves_table_unchanged(spark, workdir):
    # a lost checkpoint makes the stream re-deliver files it already upserted;
    # the idempotent upsert must leave the same rows and ids
    root = make_datasets(f"{workdir}/data")
    drop = f"{workdir}/incoming"
    os.makedirs(drop)
    os.link(f"{root}/2024_Meningitis.csv", f"{drop}/2024_Meningitis.csv")
    table = f"{workdir}/tables/hist_replay"
    start_historical_ingest(spark, drop, table, f"{workdir}/ckpt_a").awaitTermination()
    before = sorted(tuple(r) for r in spark.read.parquet(table).collect())
    start_historical_ingest(spark, drop, table, f"{workdir}/ckpt_b").awaitTermination()
    after = sorted(tuple(r) for r in spark.read.parquet(table).collect())
    assert before == after and len(before) == 100


def test_case_reader_uses_header_names(spark, workdir):
    os.makedirs(f"{workdir}/reordered")
    write(f"{workdir}/reordered/2024_Dysentery.csv", "area_reported,cases_reported,week_number\nColombo,7,3\n")
    row = files.read_case_files(spark, f"{workdir}/reordered/2024_Dysentery.csv").first()
    assert (row["week_number"], row["area_reported"], row["cases_reported"]) == ("3", "Colombo", "7")
    write(f"{workdir}/reordered/2025_Dysentery.csv", "week,area,count\n1,Colombo,2\n")
    with pytest.raises(ValueError):
        files.read_case_files(spark, f"{workdir}/reordered/2025_Dysentery.csv")


def test_streaming_bounded_micro_batches(spark, workdir):
    root = make_datasets(f"{workdir}/data")
    drop = f"{workdir}/incoming"
    os.makedirs(drop)
    for name in ("2023_Dysentery.csv", "2023_Meningitis.csv", "2024_Dysentery.csv"):
        os.link(f"{root}/{name}", f"{drop}/{name}")
    table = f"{workdir}/tables/hist_bounded"
    q = start_historical_ingest(spark, drop, table, f"{workdir}/ckpt_c", max_files_per_trigger=1)
    q.awaitTermination()
    assert len([p for p in q.recentProgress if p["numInputRows"] > 0]) == 3  # one file per batch
    assert spark.read.parquet(table).count() == 300


def test_command_line_train_with_hash_split(spark, workdir):
    from casegrid.__main__ import main

    root = make_datasets(f"{workdir}/data")
    res = main(["train", "--data", root, "--years", "2023,2024", "--missing", "silent",
                "--model", f"{workdir}/model", "--trees", "3", "--depth", "3", "--split", "hash"])
    assert res["rows"] == 2 * 3 * 20 * 5 - 2 * 5 and res["mae"] >= 0
    assert os.path.isdir(f"{workdir}/model/stages")


def test_case_files_go_by_their_own_headers(spark, workdir):
    from casegrid.sources import files

    texts = {"2023_Dysentery.csv": "week_number,area_reported,cases_reported\n1,Colombo,5\n", "2024_Dysentery.csv": "area_reported,extra,cases_reported,week_number\nGalle,x,7,2\n"}
    for name, text in texts.items():
        with open(f"{workdir}/{name}", "w") as f:
            f.write(text)
    got = files.read_case_files(spark, [f"{workdir}/{n}" for n in texts]).drop("_row_seq").collect()
    assert sorted(map(tuple, got)) == [(2023, "Dysentery", "1", "Colombo", "5"), (2024, "Dysentery", "2", "Galle", "7")]


def test_population_keeps_one_row_per_district(spark, workdir):
    """Two spellings of one district: the last row is stored, also on a second run."""
    from casegrid.dims import surveillance_dims
    from casegrid.plans.jobs import Inputs, load_population
    from casegrid.sources import files

    with open(f"{workdir}/population.csv", "w") as f:
        f.write("Region,Population\nNuwara Eliya,\"1,000\"\nColombo,5\nNuwaraEliya,\"2,000\"\nGalle,nan\n")
    inputs = Inputs(None, files.read_population(spark, f"{workdir}/population.csv"), None, surveillance_dims(spark))
    for expected in ({"inserted": 2, "updated": 0, "unchanged": 0}, {"inserted": 0, "updated": 2, "unchanged": 0}):
        assert load_population(spark, inputs, f"{workdir}/table")["upsert"] == expected
    assert sorted(r["population"] for r in spark.read.parquet(f"{workdir}/table").collect()) == [5, 2000]


def test_streaming_takes_the_newest_file_not_the_last_name(spark, workdir):
    drop = f"{workdir}/incoming"
    os.makedirs(drop)
    head = "week_number,area_reported,cases_reported\n"
    for name, cases, age in (("z_2023_Dysentery.csv", 5, 1000), ("2023_Dysentery.csv", 99, 0)):
        write(f"{drop}/{name}", f"{head}1,Colombo,{cases}\n")
        os.utime(f"{drop}/{name}", (1_700_000_000 - age, 1_700_000_000 - age))
    start_historical_ingest(spark, drop, f"{workdir}/t", f"{workdir}/c").awaitTermination()
    assert [r["case_count"] for r in spark.read.parquet(f"{workdir}/t").collect()] == [99]


def test_streaming_fails_on_another_header(spark, workdir):
    drop = f"{workdir}/incoming"
    os.makedirs(drop)
    write(f"{drop}/2023_Dysentery.csv", "area_reported,cases_reported,week_number\nColombo,5,1\n")
    with pytest.raises(Exception, match="(?i)header|column"):
        start_historical_ingest(spark, drop, f"{workdir}/t", f"{workdir}/c").awaitTermination()


def test_years_are_listed_from_the_folder(spark, workdir):
    root = make_datasets(f"{workdir}/data", years=(2023, 2026))
    write(f"{root}/x_2030_Dysentery.csv", "week_number,area_reported,cases_reported\n1,Colombo,1\n")
    inputs = jobs.surveillance_inputs(spark, root)
    assert inputs.years == (2023, 2026) and inputs.missing_files == ()
    assert {r["year"] for r in inputs.cases.select("year").distinct().collect()} == {2023, 2026}


def test_risk_fails_on_a_missing_file_of_its_year(spark, workdir):
    root = make_datasets(f"{workdir}/data", years=(2023,))
    write(f"{root}/2024_Dysentery.csv", "week_number,area_reported,cases_reported\n1,Colombo,1\n")
    inputs = jobs.surveillance_inputs(spark, root, missing="silent")
    assert [p.rsplit("/", 1)[1] for p in inputs.missing_files] == ["2024_Meningitis.csv", "2024_Tuberculosis.csv"]
    with pytest.raises(FileNotFoundError, match="2024_Meningitis"):
        jobs.risk_job(inputs, year=2024)
    assert jobs.risk_job(inputs, year=2023)["thresholds"].count() == 15
    with pytest.warns(UserWarning, match="2024_Meningitis"):
        jobs.risk_job(inputs, missing="skip")


def test_analytics_tables_are_written_in_order(spark, workdir):
    root = make_datasets(f"{workdir}/data")
    inputs = jobs.surveillance_inputs(spark, root)
    jobs.analytics_job(spark, inputs, f"{workdir}/out")

    def rows(name):
        parts = sorted(f for f in os.listdir(f"{workdir}/out/{name}") if f.endswith(".csv"))
        out = []
        for part in parts:
            with open(f"{workdir}/out/{name}/{part}") as f:
                head, *lines = f.read().splitlines()
            out += [dict(zip(head.split(","), line.split(","))) for line in lines]
        return out

    hot = [(r["disease"], int(r["year"]), -float(r["total_cases"]), r["district"]) for r in rows("disease_hotspots")]
    assert len(hot) == 30 and hot == sorted(hot)
    corr = [(r["disease"], -float(r["correlation"]), r["district"]) for r in rows("rain_disease_correlation")]
    assert corr and corr == sorted(corr)
    ranks = [int(r["rank"]) for r in rows("rainfall_district_totals")]
    assert ranks == [1, 2, 3, 4]


def test_prediction_csv_load(spark, workdir):
    """A prediction file on its own: the last row of a key wins, unknown names are counted, a second run updates."""
    from casegrid.__main__ import main

    write(f"{workdir}/p.csv", "area_reported,disease,year,week_number,predicted_cases\nColombo,Dysentery,2026,1,4\n"
          "Atlantis,Dysentery,2026,1,9\nGalle,Flu,2026,1,2\nColombo,Dysentery,2026,1,6\nGalle,Dysentery,2026,2,\n")
    args = ["load-predictions", "--predictions", f"{workdir}/p.csv", "--tables", f"{workdir}/t"]
    first = main(args)
    assert first["upsert"] == {"inserted": 1, "updated": 0, "unchanged": 0}
    assert first["report"]["Dysentery"]["skipped_unknown_district"] == 1
    assert first["report"]["unknown"]["skipped_unknown_disease"] == 1
    assert main(args)["upsert"] == {"inserted": 0, "updated": 1, "unchanged": 0}
    assert [r["case_count"] for r in spark.read.parquet(f"{workdir}/t/reports").collect()] == [6]
    with pytest.raises(FileNotFoundError):
        main(["load-predictions", "--predictions", f"{workdir}/none.csv", "--tables", f"{workdir}/t"])


def test_stored_population_keeps_its_district_column(spark, workdir):
    root = make_datasets(f"{workdir}/data", years=(2023,))
    inputs = jobs.surveillance_inputs(spark, root)
    stored = spark.createDataFrame([(1, 5, 7)], "districts_id int, population int, id int")
    stored.write.parquet(f"{workdir}/t")
    assert jobs.load_population(spark, inputs, f"{workdir}/t")["upsert"] == {"inserted": 4, "updated": 1, "unchanged": 0}
    rows = spark.read.parquet(f"{workdir}/t").collect()
    assert sorted(r["id"] for r in rows) == [7, 8, 9, 10, 11]
    assert {r["districts_id"]: r["population"] for r in rows}[1] == 2375415
    spark.createDataFrame([(1, 5)], "area int, population int").write.parquet(f"{workdir}/bad")
    with pytest.raises(ValueError, match="districts_id"):
        jobs.load_population(spark, inputs, f"{workdir}/bad")


def test_stop_inside_the_swap_leaves_a_table(spark, workdir):
    from casegrid.operators import upsert

    table = f"{workdir}/t"
    first = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    upsert.upsert_table(spark, table, first, ["k"], ["v"])
    os.rename(table, f"{table}.old")  # as if stopped between the two renames
    assert sorted(map(tuple, upsert.read_table(spark, table).collect())) == [("a", 1), ("b", 2)]
    counts = upsert.upsert_table(spark, table, spark.createDataFrame([("b", 3)], "k string, v int"), ["k"], ["v"])
    assert counts == {"inserted": 0, "updated": 1, "unchanged": 1}
    assert sorted(map(tuple, upsert.read_table(spark, table).collect())) == [("a", 1), ("b", 3)]
    assert not os.path.exists(f"{table}.old")


def test_risk_load_counts_unknown_names(spark, workdir):
    root = make_datasets(f"{workdir}/data", years=(2023,))
    write(f"{root}/district_population.csv", 'Region,Population\nColombo,"2,375,415"\nElsewhere,"1,000"\n')
    with open(f"{root}/2023_Dysentery.csv", "a") as f:
        f.write("1,Elsewhere,3\n")
    out = jobs.risk_job(jobs.surveillance_inputs(spark, root))
    stored = jobs.load_risk(spark, out, f"{workdir}/t")
    assert stored["report"] == {"rows": 61, "skipped_unknown_district": 1, "skipped_unknown_disease": 0}
    assert stored["upsert"]["inserted"] == 60


def test_streaming_reports_what_it_skips(spark, workdir):
    drop = f"{workdir}/incoming"
    os.makedirs(drop)
    head = "week_number,area_reported,cases_reported\n"
    write(f"{drop}/2023_Dysentery.csv", f"{head}1,Colombo,5\n2,Atlantis,6\n")
    write(f"{drop}/notes.csv", f"{head}1,Colombo,7\n")
    seen = []
    start_historical_ingest(spark, drop, f"{workdir}/t", f"{workdir}/c",
                            on_batch=lambda epoch, counts: seen.append(counts)).awaitTermination()
    assert seen == [{"rows": 3, "rows_of_misnamed_files": 1, "skipped_unknown_district": 1,
                     "skipped_unknown_disease": 0, "inserted": 1, "updated": 0, "unchanged": 0}]


def test_rainfall_load_names_missing_columns(spark, workdir):
    from casegrid.operators import rainfall

    root = make_datasets(f"{workdir}/data", years=(2023,))
    inputs = jobs.surveillance_inputs(spark, root)
    with pytest.raises(ValueError, match="Annual"):
        rainfall.storage_rows(inputs.rainfall.drop("Annual"), inputs.dims)
