"""Session settings, and the shared folder that intermediate tables live in."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

Item = TypeVar("Item")
Result = TypeVar("Result")

#: Local property that names the folder of the run a thread works for; threads of ``side_by_side`` inherit it.
_RUN = "dimflow.run"

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A hot key is split by the map outputs it came from, even when that costs a shuffle later on.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators rely on; sizes and memory stay the cluster's choice."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def side_by_side(
    spark: SparkSession, work: Callable[[Item], Result], items: Iterable[Item], threads: int = 8
) -> list[Result]:
    """Run independent Spark jobs at the same time, so that small tables fill the gaps big ones leave."""
    with ThreadPoolExecutor(max_workers=threads) as pool:
        return list(pool.map(inheritable_thread_target(spark)(work), items))


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Where nothing is set, a local session gets a temporary folder; a cluster gets an error, because
    a machine-local folder would be lost with its executor.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="dimflow-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nothing has been written to yet."""
    run = spark.sparkContext.getLocalProperty(_RUN)
    return f"{run or shared_folder(spark) + '/dimflow'}/{name}-{uuid.uuid4().hex}"


@contextmanager
def run_folder(spark: SparkSession) -> Iterator[str]:
    """What is written to the shared folder inside the block goes to a folder of its own, removed at the end.

    Nothing that outlives the block may still read from it: store results in tables first. Inside another
    block nothing new is made, and the outer one removes everything.
    """
    context = spark.sparkContext
    if outer := context.getLocalProperty(_RUN):
        yield outer
        return
    folder = f"{shared_folder(spark)}/dimflow/run-{uuid.uuid4().hex}"
    context.setLocalProperty(_RUN, folder)
    try:
        yield folder
    finally:
        context.setLocalProperty(_RUN, None)
        path = context._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage and fixes the rows, so that several consumers see the same result and a lost
    executor costs a re-read. It also gives the optimizer the true size of the result.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
