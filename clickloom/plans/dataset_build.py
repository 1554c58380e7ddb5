"""Dataset build: clean events -> sample -> splits -> vocabularies -> sequences, written as Parquet."""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.operators import features as Fe
from clickloom.operators import interactions as I
from clickloom.operators import sampling as S
from clickloom.operators import sequences as Sq
from clickloom.session import scratch_scope
from clickloom.sources.files import write_parquet


def run(clean: DataFrame, out_dir: str, n_users: int, val_start: dt.datetime, test_start: dt.datetime) -> dict:
    """Everything is written under ``out_dir``; no intermediate table is left behind."""
    with scratch_scope(clean.sparkSession):
        return _run(clean, out_dir, n_users, val_start, test_start)


def _run(clean: DataFrame, out_dir: str, n_users: int, val_start: dt.datetime, test_start: dt.datetime) -> dict:
    sample = S.hash_user_sample(clean, n_users)
    labelled = S.split_label(sample, val_start, test_start)
    write_parquet(labelled, os.path.join(out_dir, "events"), partition_by=["split"])
    ev = clean.sparkSession.read.parquet(os.path.join(out_dir, "events"))
    train = ev.filter(F.col("split") == "train")
    inter = I.interactions(train)
    items = Fe.item_features(ev.drop("split"), inter)
    item_vocab = Fe.id_vocab(items, "product_id", "item_idx", start=1)
    user_vocab = Fe.id_vocab(inter, "user_id", "user_idx", start=0)
    write_parquet(item_vocab, os.path.join(out_dir, "item_vocab"))
    write_parquet(user_vocab, os.path.join(out_dir, "user_vocab"))
    mapped = Sq.map_to_vocab(ev, user_vocab, item_vocab)
    sessions = Sq.session_sequences(mapped, extra_group=["split"])
    write_parquet(sessions, os.path.join(out_dir, "sessions"), partition_by=["split"])
    overlap = S.split_overlap(train, ev.filter(F.col("split") == "test")).first().asDict()
    return {"overlap": overlap}
