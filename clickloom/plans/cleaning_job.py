"""The cleaning job end to end: raw events -> cleaned, k-core filtered table.

Step counts are collected with ``observe`` on the final write (one pass), not
with a ``count`` action after every step. The pre-k-core table is written to
the shared folder first so the iterative phase restarts from storage, not
from the raw scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from clickloom.operators import cleaning as C
from clickloom.session import scratch_scope
from clickloom.sources.files import write_parquet


def run(events: DataFrame, out_path: str, pre_kcore_path: str, k: int = C.KCORE_K,
        max_rounds: int = C.KCORE_MAX_ROUNDS, n_files: int | None = None) -> dict:
    spark = events.sparkSession
    obs_clean = Observation("clean")
    history: list = []
    obs_out = Observation("out")
    with scratch_scope(spark):
        # observed metrics allow non-distinct aggregates only
        cleaned = C.clean_events(events).observe(obs_clean, F.count(F.lit(1)).alias("rows_clean"),
                                                 F.sum("price").alias("price_sum_clean"))
        write_parquet(cleaned, pre_kcore_path)
        core = C.kcore(spark.read.parquet(pre_kcore_path), k=k, max_rounds=max_rounds, history=history)
        write_parquet(core.observe(obs_out, F.count(F.lit(1)).alias("rows_out")), out_path, n_files)
    return {"clean": obs_clean.get, "kcore_rounds": history, "output": obs_out.get}
