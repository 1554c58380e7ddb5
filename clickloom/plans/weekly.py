"""Weekly monitoring loop: drift per week, next-week evaluation, retrain/promote gate."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from clickloom.operators import drift as D


def run(clean: DataFrame, week1: dt.datetime, baselines: list[D.Baseline], n_weeks: int | None = None) -> DataFrame:
    return D.weekly_gate(D.weekly_report(clean, week1, baselines, n_weeks))
