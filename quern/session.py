"""Session helpers.

Library code never builds its own session: every operator takes the
caller's DataFrames.  ``local_session`` exists for tests, the bench and
the CLI; ``checkpoint_dir`` reads the cluster's shared checkpoint folder
from the session and only falls back to a fresh scratch folder when the
setting is unset (local runs and tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every session needs for the results to be reproducible:
# UTC session clock (IST is applied explicitly), ANSI on (Spark default),
# AQE for runtime coalescing and skew splitting.
CORE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "quern", extra: dict | None = None) -> SparkSession:
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", os.environ.get("QUERN_DRIVER_MEMORY", "16g")))
    for k, v in {**CORE_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set (a shared file system / object store);
    only when it is unset on a ``local[..]`` master (tests) a fresh scratch
    folder is made and registered; any other master without it is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="quern-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder.

    Used between long stages so a lost executor does not replay the whole
    lineage.  Never a local checkpoint: those die with the executor.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: Spark's setting that a statement's shuffle files go when it ends.
FREES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_table(df: DataFrame, name: str, frees: bool = False, **options: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    Cuts the lineage as a checkpoint does, but columnar and compressed, and
    a later read takes only the columns it needs. With ``frees`` the shuffle
    files that made it go as soon as it is written, not when the driver's
    garbage is collected; ``df`` itself should then not be used again.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/tables/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(FREES, None)
    if frees:
        spark.conf.set(FREES, "true")
    try:
        df.write.options(**options).parquet(path)
    finally:
        if frees:
            spark.conf.unset(FREES) if before is None else spark.conf.set(FREES, before)
    return spark.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``quern`` importable in the Python workers (once per context).

    Operators that run Python on executors (page parsing, sequence ratio,
    stateful streaming) call this; it zips the package and registers it
    with ``addPyFile`` so Spark distributes it with the job, on a cluster
    as in local mode.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    import shutil
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    out = tempfile.mkdtemp(prefix="quern-pyfiles-")
    zpath = shutil.make_archive(os.path.join(out, "quern"), "zip", os.path.dirname(pkg_dir), "quern")
    sc.addPyFile(zpath)
    _SHIPPED.add(sc.applicationId)
