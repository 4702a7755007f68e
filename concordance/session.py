"""Session defaults and the small helpers every operator shares."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(app: str = "concordance", master: str | None = None, **conf: str) -> SparkSession:
    """A session with AQE, UTC and Arrow; ``conf`` overrides any default."""
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**defaults, **{k.replace("_", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of the data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` if the cluster names one.

    Only where it is unset on one machine (tests) is a local folder made and set; a cluster
    without one is an error, since each executor would write to its own disk.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
        local = tempfile.mkdtemp(prefix="concordance-")
        atexit.register(shutil.rmtree, local, ignore_errors=True)
        named = "file://" + local
        spark.conf.set("spark.checkpoint.dir", named)
    return named


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` once into the shared folder and read it back.

    Cuts the lineage and survives the loss of an executor; the reader gets exact
    sizes, so later joins are planned from facts.
    """
    spark = df.sparkSession
    path = os.path.join(shared_dir(spark), f"stage-{uuid.uuid4().hex}")
    if not _STAGES:
        atexit.register(clear_stages)
    _STAGES.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_STAGES: list[str] = []


def clear_stages() -> int:
    """Deletes the tables that ``materialise`` wrote, once their queries' results are saved;
    runs by itself when the driver ends. Returns their number."""
    gateway = SparkContext._gateway
    done = 0
    while _STAGES and gateway is not None:
        path = gateway.jvm.org.apache.hadoop.fs.Path(_STAGES.pop())
        try:
            done += path.getFileSystem(gateway.jvm.org.apache.hadoop.conf.Configuration()).delete(path, True)
        except Exception:  # noqa: BLE001 - a folder that can't be reached any more is left
            break
    return done


#: Rows up to which a derived table is broadcast.
SMALL = 100_000


def small(df: DataFrame, rows: int = SMALL) -> DataFrame:
    """``df`` written once and marked for broadcasting if it is small; a larger one is
    joined by shuffle, where adaptive execution splits hot keys."""
    written = materialise(df)
    return F.broadcast(written) if written.limit(rows + 1).count() <= rows else written


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the session's Python workers, once, wherever the driver runs."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    here = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="concordance-")) / "concordance.zip"
    atexit.register(shutil.rmtree, archive.parent, ignore_errors=True)
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(here.rglob("*.py")):
            out.write(path, path.relative_to(here.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)
