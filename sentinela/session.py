"""Session helpers: a configured SparkSession and the shared checkpoint folder.

On a cluster the operator reads ``spark.checkpoint.dir`` from the session (the
shared folder the cluster names); a folder of our own is created only when the
setting is absent and the master is local, as in tests.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

LOCAL_CONF = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "16g",
}


def get_session(master: str | None = None, app: str = "sentinela", **conf: str) -> SparkSession:
    """Return the active session, or build one (local[*] unless told otherwise)."""
    active = SparkSession.getActiveSession()
    if active is not None and master is None and not conf:
        return active
    builder = SparkSession.builder.appName(app).master(master or os.environ.get("SPARK_MASTER", "local[*]"))
    for k, v in {**LOCAL_CONF, **conf}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the session.

    Uses ``spark.checkpoint.dir`` when set (cluster or spark-defaults). When it
    is unset and the master is local (tests), a private temp folder is created
    and registered. On a cluster with no setting this raises: a machine-local
    folder would not survive an executor loss.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/ABFS) for this job")
        root = tempfile.mkdtemp(prefix="sentinela-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/sentinela/{name}-{uuid.uuid4().hex[:12]}"


#: Rows of an Arrow batch where rows hold whole texts.
TEXT_ROWS = 2000


def small_batches(spark: SparkSession) -> None:
    """Send at most TEXT_ROWS rows at once to Python from now on, fewer if the session
    says so. Spark's 10,000 whole texts are tens of MB a batch, which each task holds
    several times outside the heap: as vectors, as their serialised form, and what the
    allocator keeps while both grow by doubling."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    rows = int(spark.conf.get(key))
    if rows <= 0 or rows > TEXT_ROWS:
        spark.conf.set(key, str(TEXT_ROWS))


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``sentinela`` importable by the Python workers (UDFs, pandas
    functions) of this SparkContext: the package is zipped once and added with
    ``addPyFile`` (what ``spark-submit --py-files`` does). Needed when the
    driver imported the package from a path the workers don't have."""
    import shutil

    try:
        sc = spark.sparkContext
        key = sc.applicationId
    except Exception:  # noqa: BLE001  (Spark Connect sessions have no SparkContext)
        sc, key = None, f"connect-{id(spark)}"
    if key in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    out_dir = tempfile.mkdtemp(prefix="sentinela-pyfiles-")
    archive = shutil.make_archive(os.path.join(out_dir, "sentinela"), "zip", root_dir=os.path.dirname(pkg_dir),
                                  base_dir=os.path.basename(pkg_dir))
    if sc is not None:
        sc.addPyFile(archive)
    else:
        spark.addArtifacts(archive, pyfile=True)
    _SHIPPED.add(key)
