"""Tables that are written once and read back, in the folder that driver and executors share.

A result may read such tables until it is used, so they stay until `release`; what an operator needs
only on its way it writes within `scratch`, which deletes it.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: Paths of the tables that were written and not deleted yet.
_written: dict[str, None] = {}
_scopes: ContextVar[tuple[dict[str, None], ...]] = ContextVar("scopes", default=())


def shared_folder(spark: SparkSession) -> str:
    """What the cluster names in spark.checkpoint.dir; in local mode without it a temporary folder, else the warehouse."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if spark.sparkContext.master.split("[")[0] == "local":
        return f"file://{tempfile.gettempdir()}/textloom-tables"
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_textloom_tables"


def new_path(spark: SparkSession, tag: str) -> str:
    """A path in the shared folder that is deleted with the tables."""
    path = f"{shared_folder(spark)}/{tag}-{uuid.uuid4().hex}"
    _written[path] = None
    for scope in _scopes.get()[-1:]:
        scope[path] = None
    return path


def written(df: DataFrame, tag: str) -> DataFrame:
    """The rows of ``df`` from a table of their own, so that no later use computes them again."""
    path = new_path(df.sparkSession, tag)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table._written_to = path
    return table


def delete(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
        _written.pop(path, None)


def discard(table: DataFrame) -> None:
    """Deletes a table that `written` gave and nothing reads any more."""
    for scope in _scopes.get():
        scope.pop(table._written_to, None)
    delete(table.sparkSession, [table._written_to])


@contextmanager
def scratch(spark: SparkSession) -> Iterator[list[DataFrame]]:
    """Deletes the tables written within at its end, but for those that are put into the list it gives."""
    own: dict[str, None] = {}
    kept: list[DataFrame] = []
    token = _scopes.set((*_scopes.get(), own))
    try:
        yield kept
    finally:
        _scopes.reset(token)
        stay = {t._written_to for t in kept}
        delete(spark, [p for p in own if p not in stay])
        for scope in _scopes.get()[-1:]:
            scope.update(dict.fromkeys(p for p in own if p in stay))


def release(spark: SparkSession) -> None:
    """Deletes every table that is left, once no result that reads one is needed any more."""
    delete(spark, list(_written))
