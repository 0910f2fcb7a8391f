"""Session helpers.

Library functions never create or reconfigure a session: they take the one
they are given.  ``local_session`` is for tests, the bench and the examples;
on a cluster the job owner builds the session and sets the shared
``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

# Settings a local test or bench session needs; on a cluster the job owner
# sizes shuffle partitions and file splits for the target scale.
LOCAL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def _driver_memory() -> str:
    """60% of this machine's memory, at most 16 GB (local mode: one JVM)."""
    try:
        total = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES")
    except (ValueError, OSError, AttributeError):
        return "4g"
    return f"{max(1, min(16, int(total * 0.6 / 2**30)))}g"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "kensa", extra: dict | None = None) -> SparkSession:
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", _driver_memory()))
    for k, v in {**LOCAL_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the session.

    The cluster names it in ``spark.checkpoint.dir``; only a session on one
    machine (tests) may leave it unset, elsewhere that is an error.
    """
    sc = _context(spark)
    path = spark.conf.get(CHECKPOINT_CONF, None) or (sc.getConf().get(CHECKPOINT_CONF, None) if sc else None)
    if not path:
        if sc is None or not sc.master.split("[")[0] == "local":
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        path = os.path.join(tempfile.gettempdir(), f"kensa-ckpt-{uuid.uuid4().hex[:8]}")
        spark.conf.set(CHECKPOINT_CONF, path)
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def _context(spark: SparkSession):
    """The SparkContext of a classic session; None under Spark Connect,
    where the server owns the context and its checkpoint folder."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect sessions have no context
        return None


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder for written tables."""
    return os.path.join(ensure_checkpoint_dir(spark).rstrip("/"), "kensa", f"{name}-{uuid.uuid4().hex}")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``kensa`` importable on the executors' Python workers.

    Pandas UDFs and ``mapInPandas`` functions are pickled by reference to
    this package, so executors need it.  Zips the package once per
    application and hands it to ``addPyFile``; Spark distributes it.  A
    deployment that already ships it with ``--py-files`` can skip this.
    """
    sc = _context(spark)
    if sc is None:  # Spark Connect: the package must be installed server-side
        return
    app = sc.applicationId
    if app in _SHIPPED:
        return
    import kensa
    import zipfile
    root = os.path.dirname(os.path.abspath(kensa.__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="kensa-pyfiles-"), "kensa.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(dirpath, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(out)
    _SHIPPED.add(app)
