"""Session helpers: a local session for tests/bench and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "boxframe") -> SparkSession:
    """A local session for tests and the bench. Cluster jobs get their session from the launcher."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session; only when it is unset and the master is local
    (tests on a laptop) a fresh temporary folder is created and registered. On
    a cluster a machine-local folder would differ from node to node.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="boxframe-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written intermediate tables."""
    base = shared_dir(spark)
    import uuid

    return f"{base.rstrip('/')}/boxframe-{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, name: str = "table", compression: str | None = None) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared checkpoint folder and read it back.

    Cuts the lineage like a reliable checkpoint (the files outlive any
    executor), and unlike an RDD checkpoint the result is columnar: later
    reads prune columns and push filters into the scan.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path, compression=compression)
    return df.sparkSession.read.parquet(path)


def cut_lineage_observed(df: DataFrame, name: str, **totals: Column) -> tuple[DataFrame, dict]:
    """``cut_lineage`` and the aggregates ``totals`` of its rows, observed while they are written instead of by a job of their own."""
    seen = Observation()
    named = [c.alias(k) for k, c in totals.items()]
    stored = cut_lineage(df.observe(seen, *named), name)
    found = seen.get
    return stored, found if found else stored.agg(*named).first().asDict()


def cut_lineage_counted(df: DataFrame, name: str = "table") -> tuple[DataFrame, int]:
    """``cut_lineage`` and the number of rows."""
    stored, found = cut_lineage_observed(df, name, n=F.count(F.lit(1)))
    return stored, found["n"]


def local_path(uri: str) -> str:
    """Strip a ``file:`` scheme so Python code inside tasks can open the path."""
    if uri.startswith("file://"):
        return uri[len("file://"):]
    if uri.startswith("file:"):
        return uri[len("file:"):]
    return uri


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``boxframe`` importable in Python workers (``addPyFile`` of a zip, once per application).

    Functions handed to ``mapInPandas`` are pickled by reference to this
    package, so executors need it; on a cluster this is the same mechanism
    as ``--py-files``.
    """
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    import zipfile

    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    out = os.path.join(tempfile.mkdtemp(prefix="boxframe-pyfiles-"), "boxframe.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _dirs, files in os.walk(pkg_dir):
            if "__pycache__" in dirpath:
                continue
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    _SHIPPED.add(app)
