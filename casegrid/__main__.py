"""Command-line entry for ``spark-submit`` (or ``python -m casegrid``).

    zip -r casegrid.zip casegrid
    spark-submit --py-files casegrid.zip --conf spark.checkpoint.dir=hdfs:///ckpt \
        casegrid/__main__.py analytics --data hdfs:///surveillance --out hdfs:///out/analytics

Subcommands run the job functions in ``casegrid.plans.jobs`` on the
surveillance CSV layout; keyed tables live under ``--tables``. The master and
cluster settings come from ``spark-submit``; nothing here is machine-local.
"""

from __future__ import annotations

import argparse
import json
import sys

from casegrid.plans import jobs
from casegrid.dims import surveillance_dims
from casegrid.session import cluster_conf, get_spark
from casegrid.sources import sinks


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="casegrid")
    p.add_argument("command", choices=["risk", "analytics", "train", "predict", "forecast",
                                       "load-population", "load-rainfall", "load-historical",
                                       "load-predictions", "pipeline", "ingest"])
    p.add_argument("--data", help="folder with the case, population and rainfall CSVs")
    p.add_argument("--years", help="years of case files, as 2023,2024; all years in the folder without it")
    p.add_argument("--missing", choices=["skip", "silent", "error"],
                   help="case files that are not there; by default an error for risk, a warning for "
                        "load-historical and pipeline, passed over otherwise")
    p.add_argument("--out", help="output folder for tables")
    p.add_argument("--tables", help="folder of the keyed tables")
    p.add_argument("--model", help="model folder")
    p.add_argument("--year", type=int, help="risk year")
    p.add_argument("--prediction-year", type=int, default=2026)
    p.add_argument("--predictions", help="prediction CSV (load-predictions)")
    p.add_argument("--trees", type=int, default=300)
    p.add_argument("--depth", type=int, default=None)
    p.add_argument("--split", default="random", choices=["random", "hash"], help="hold-out split (train)")
    p.add_argument("--checkpoint", help="streaming checkpoint folder (ingest)")
    p.add_argument("--max-files", type=int, default=None, help="files per micro-batch (ingest)")
    p.add_argument("--cores", type=int, help="cores of the cluster: sets the sizes of session.cluster_conf")
    p.add_argument("--input-tb", type=float, default=1.0, help="input size for --cores, in TB")
    return p


def main(argv: list[str] | None = None) -> dict:
    args = _parser().parse_args(argv)
    spark = get_spark("casegrid", extra_conf=cluster_conf(args.cores, args.input_tb) if args.cores else None)
    if args.command == "ingest":
        from casegrid.streaming import start_historical_ingest

        query = start_historical_ingest(spark, args.data, sinks.table_path(args.tables, "historicaldata"),
                                        args.checkpoint, max_files_per_trigger=args.max_files)
        query.awaitTermination()
        return {"ingest": "done"}
    t = lambda name: sinks.table_path(args.tables, name)
    if args.command == "load-predictions":
        result = jobs.load_predictions(spark, args.predictions, surveillance_dims(spark), t("reports"))
        print(json.dumps(result, default=str))
        return result
    years = tuple(int(y) for y in args.years.split(",")) if args.years else None
    missing = args.missing or ("skip" if args.command in ("load-historical", "pipeline") else "silent")
    inputs = jobs.surveillance_inputs(spark, args.data, years=years, missing=missing)
    if args.command == "risk":
        out = jobs.risk_job(inputs, args.out, args.year, args.missing or "error")
        result = {"thresholds": out["thresholds"].count(), "weekly_rows": out["weekly_risk"].count()}
        if args.tables:
            result["store"] = jobs.load_risk(spark, out, t("risk_levels"))
    elif args.command == "analytics":
        result = {name: None for name in jobs.analytics_job(spark, inputs, args.out)}
    elif args.command == "train":
        trained = jobs.train_job(inputs, args.model, args.trees, args.depth, split=args.split)
        result = {k: v for k, v in trained.items() if k != "model"}
    elif args.command == "predict":
        preds = jobs.predict_job(spark, inputs, args.model, args.prediction_year, args.out)
        result = {"predictions": preds.count()}
    elif args.command == "forecast":
        result = jobs.forecast_job(spark, inputs, args.model, args.out, args.tables, args.prediction_year,
                                   args.trees, args.depth)
    elif args.command == "load-population":
        result = jobs.load_population(spark, inputs, t("perdistrictpopulation"))
    elif args.command == "load-rainfall":
        result = jobs.load_rainfall(spark, inputs, t("rainfall_data"))
    elif args.command == "load-historical":
        result = jobs.load_historical(spark, inputs, t("historicaldata"))
    else:
        result = jobs.full_pipeline(spark, inputs, args.tables, args.out, args.model, args.year,
                                    args.prediction_year, args.trees, args.depth)
    print(json.dumps(result, default=str))
    return result


if __name__ == "__main__":
    main(sys.argv[1:])
