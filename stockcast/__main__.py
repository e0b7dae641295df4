"""Command line: train, predict, report, sample.

  python -m stockcast train   --file_path sales.csv --out DIR [--sample_size N]
  python -m stockcast predict --data_path sales.csv --model_path DIR/models/demand_model --out DIR [--detailed_output]
  python -m stockcast report  --data_path sales.csv --model_path DIR/models/demand_model --out DIR
  python -m stockcast sample  --input sales.csv --output DIR [--samples 500] [--seed 42]

``--star DIR`` reads the TPC-H style tables of DIR instead of a CSV file.
``--input_gb N`` sizes shuffle partitions and scan splits for N GB of input.
Training and sampling skip lines with too many fields (train writes their
count); predict and report read strictly and stop at a bad line.
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import SparkSession

from stockcast.plans import jobs
from stockcast.session import apply_scale_settings, ensure_checkpoint_dir, local_session
from stockcast.sources import CsvSales, StarSales


def _source(spark, path: str | None, star: str | None, mode: str = "lenient"):
    return StarSales(spark, star) if star else CsvSales(spark, path, mode=mode)


def _show(tables) -> None:
    for name, df in tables.items():
        print(name)
        df.show(15, truncate=False)


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="stockcast")
    ap.add_argument("--input_gb", type=float)
    sub = ap.add_subparsers(dest="cmd", required=True)
    t = sub.add_parser("train")
    t.add_argument("--file_path")
    t.add_argument("--star")
    t.add_argument("--sample_size", type=int, default=0)
    t.add_argument("--out", required=True)
    t.add_argument("--rf_depth", type=int, help="forest depth (default 30, the deepest Spark allows)")
    t.add_argument("--trees", type=int, help="forest trees and boosting rounds (default 100)")
    for name in ("predict", "report"):
        p = sub.add_parser(name)
        p.add_argument("--data_path")
        p.add_argument("--star")
        p.add_argument("--model_path", required=True)
        p.add_argument("--out", required=True)
        if name == "predict":
            p.add_argument("--detailed_output", action="store_true")
    s = sub.add_parser("sample")
    s.add_argument("--input")
    s.add_argument("--star")
    s.add_argument("--output", required=True)
    s.add_argument("--samples", type=int, default=500)
    s.add_argument("--seed", type=int, default=42)
    a = ap.parse_args(argv)

    # under spark-submit the cluster's settings apply; plain `python -m` runs locally
    if os.environ.get("SPARK_ENV_LOADED"):
        spark = SparkSession.builder.appName("stockcast").getOrCreate()
    else:
        spark = local_session(app="stockcast")
    ensure_checkpoint_dir(spark)
    if a.input_gb:
        apply_scale_settings(spark, int(a.input_gb * 1e9))
    if a.cmd == "train":
        given = {k: v for k, v in (("rf_depth", a.rf_depth), ("rf_trees", a.trees), ("gbt_rounds", a.trees)) if v}
        r = jobs.train(spark, _source(spark, a.file_path, a.star), a.out, sample_size=a.sample_size,
                       settings=jobs.MD.ModelSettings(**given))
        _show(r.exploration)
        r.metrics.show(truncate=False)
        print(f"best model: {r.best}; saved to {r.model_path}")
        _show(jobs.console_tables(r.restock))
    elif a.cmd == "predict":
        res = jobs.predict(spark, _source(spark, a.data_path, a.star, "strict"), a.model_path, a.out,
                           detailed=a.detailed_output)
        _show(jobs.console_tables(res))
    elif a.cmd == "report":
        for name, path in jobs.report(spark, _source(spark, a.data_path, a.star, "strict"), a.model_path, a.out).items():
            print(f"{name}: {path}")
    else:
        print(jobs.sample(spark, _source(spark, a.input, a.star), a.output, a.samples, a.seed))


if __name__ == "__main__":
    main()
