"""A whole run: CSV in, translated CSV out, with a report."""

from __future__ import annotations

import dataclasses
import json
import os
import time
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.config import Config
from textloom.operators.metrics import run_metrics, status_counts
from textloom.operators.rows import head, require
from textloom.operators.translate import NUMBER, translate
from textloom.sources.csv import read_csv, write_csv, write_report
from textloom.sources.store import delete, scratch, written

Counters = dict[str, Any]


def report_of(result: DataFrame, rows_loaded: int, config: Config, seconds: float) -> dict[str, Any]:
    """Settings, counters and the number of rows of each status."""
    counters = run_metrics(result, rows_loaded).first().asDict()
    summary = {r["status"]: r["n"] for r in status_counts(result).collect()}  # a row a status
    return {"config": dataclasses.asdict(config), **counters, "validation_summary": summary, "total_elapsed_seconds": round(seconds, 2)}


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def _add(first: Counters, second: Counters) -> Counters:
    """Sums by name, and by status within the summary."""
    return {k: _add(first.get(k, {}), second.get(k, {})) if isinstance(first.get(k, second.get(k)), dict) else first.get(k, 0) + second.get(k, 0) for k in {**first, **second}}


def load_progress(config: Config) -> Counters | None:
    """The counters of a run that was not finished, if they are of these paths."""
    if not config.progress_path or not os.path.exists(config.progress_path):
        return None
    with open(config.progress_path, encoding="utf-8-sig") as f:
        state = json.load(f)
    same = (state.get("input_path"), state.get("output_path")) == (config.input_path, config.output_path)
    return state["counters"] if same and not state.get("completed") else None


def save_progress(config: Config, counters: Counters) -> None:
    """Replaces the state in one step, so that a run that is killed leaves the old or the new."""
    beside = f"{config.progress_path}.tmp"
    write_report({"input_path": config.input_path, "output_path": config.output_path, "completed": False, "counters": counters}, beside)
    os.replace(beside, config.progress_path)


def run(spark: SparkSession, config: Config, most_groups: int | None = None) -> dict[str, Any]:
    """Translates the input file into the output folder and returns the report; writes it too if a path is set.

    With a progress path the input goes through in groups of ``checkpoint_interval`` chunks. A group's rows are appended to
    the output as a folder of their own, named after its first row and overwritten if it is run again, and counters are saved;
    a run that was killed goes on after the last group saved, with all counters. ``most_groups`` ends a run early.
    """
    began = time.perf_counter()
    rows = read_csv(spark, config.validate().input_path, na_values=True)
    require(rows, [config.text_column, config.label_column])
    if config.limit:
        rows = head(rows, config.limit)
    if not config.progress_path:
        result = written(translate(rows, config), "result")
        loaded = rows.count()
        if loaded:
            write_csv(result.orderBy(NUMBER), config.output_path)
        report = report_of(result, loaded, config, time.perf_counter() - began)
    else:
        report = _in_groups(spark, written(rows, "input"), config, most_groups) | {"config": dataclasses.asdict(config), "total_elapsed_seconds": round(time.perf_counter() - began, 2)}
    if config.report_path:
        write_report(report, config.report_path)
    return report


def _in_groups(spark: SparkSession, rows: DataFrame, config: Config, most_groups: int | None) -> dict[str, Any]:
    """``rows`` is a written table, of which a group's files are found by their smallest and largest row numbers."""
    total, size = rows.count(), config.input_chunk_size * config.checkpoint_interval
    counters = load_progress(config)
    resumed = counters is not None and _exists(spark, config.output_path)
    if not resumed:
        counters = {"rows_loaded": 0, "chunks_completed": 0}
        delete(spark, [config.output_path])
    groups = 0
    while counters["rows_loaded"] < total and (most_groups is None or groups < most_groups):
        at = counters["rows_loaded"]
        own = rows.where((F.col(NUMBER) > at) & (F.col(NUMBER) <= at + size))
        with scratch(spark):
            result = written(translate(own, config), "result")
            write_csv(result.orderBy(NUMBER), f"{config.output_path}/rows-{at + 1:015d}")
            loaded = min(size, total - at)
            found = run_metrics(result, loaded).first().asDict() | {"validation_summary": {r["status"]: r["n"] for r in status_counts(result).collect()}}  # a row a status
        counters = _add(counters, found | {"chunks_completed": -(-loaded // config.input_chunk_size)})
        save_progress(config, counters)
        groups += 1
    if counters["rows_loaded"] >= total and os.path.exists(config.progress_path):
        os.remove(config.progress_path)
    return counters | {"resumed": resumed, "input_rows_consumed": counters["rows_loaded"]}


def qe_run(scored: DataFrame, output_path: str) -> tuple[int, float | None]:
    """Writes a scored table; how many rows there were, and the mean of the scores."""
    own = written(scored, "scored")
    rows = write_csv(own, output_path)
    return rows, own.agg(F.avg("qe_score")).first()[0]
