"""Stored tables have an owner that drops them."""

from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tests.builders import REPORT_END, REPORT_START, daily_frame, report_rows, span, spend_frame
from tidemark.model import Settings
from tidemark.operators import facts as fa
from tidemark.plans.materialize import Scratch, materialize, shared_folder
from tidemark.plans.pipeline import prepare


def test_a_run_stores_little_and_leaves_nothing(spark, tmp_path):
    cfg = Settings(start_date=REPORT_START, end_date=REPORT_END)
    daily, spend = daily_frame(spark, report_rows()), spend_frame(spark, span(REPORT_START, REPORT_END), lambda d: 50)
    scratch = Scratch(spark, str(tmp_path))
    with prepare(daily, spend, cfg, scratch) as run:
        documents = fa.with_facts_hash(run.facts()).collect()
        assert scratch.tables <= 4 and len(list(Path(scratch.folder).iterdir())) == scratch.tables
    assert len(documents) == 3 and list(tmp_path.iterdir()) == []


def test_tables_are_dropped_after_errors_too(spark, tmp_path):
    with pytest.raises(RuntimeError), Scratch(spark, str(tmp_path)) as scratch:
        assert scratch.keep(spark.range(5)).count() == 5
        raise RuntimeError
    assert list(tmp_path.iterdir()) == []


def session_with(setting, master):
    """As much of a session as the folder is read from."""
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
    return SimpleNamespace(conf=SimpleNamespace(get=lambda *_: setting), sparkContext=context)


def test_folder_comes_from_the_session():
    assert shared_folder(session_with("hdfs://a/b/", "spark://c:7077")) == "hdfs://a/b"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(session_with(None, "spark://c:7077"))


def test_kept_tables_are_under_the_shared_folder(spark):
    kept = materialize(spark.range(3).select(F.col("id") * 2))
    assert f"{shared_folder(spark).rpartition(chr(58))[2]}/tidemark-" in kept.inputFiles()[0]
