"""stockcast: retail demand forecasting and restock planning on Spark DataFrames.

Layout
------
``sources``    read sales (CSV, TPC-H style star tables), data checks, sinks
``functions``  column expressions and distributed exact quantiles
``operators``  clean, explore, features, restock, report, sample, model
``plans``      end-to-end jobs (train, predict, reports, sample) and the
               registry of checked queries
"""

from stockcast.config import RestockConfig, PREDICT, TRAINING

__all__ = ["RestockConfig", "PREDICT", "TRAINING"]
