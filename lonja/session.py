"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

_LOCAL_FOLDERS: dict[str, str] = {}


# Runtime settings the jobs are planned for; a value given at session start stays.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A skewed join may be split even where that costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # HotSpot does not compile longer methods: wide joined projections would run interpreted.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(app: str = "lonja", master: str | None = None, **conf: str) -> SparkSession:
    """Session for tests and benchmarks; a cluster normally supplies its own."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {"spark.ui.enabled": "false", **SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> SparkSession:
    """Put the settings on a session that came from elsewhere, unless it names its own."""
    given = dict(spark.sparkContext.getConf().getAll())
    for key, value in SETTINGS.items():
        if key not in given:
            spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, for staged tables that cut lineage.

    The session's ``spark.checkpoint.dir`` decides. A temporary folder is used only in
    local mode, where driver and executors are one machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: staged tables need a folder that all executors share"
        )
    app = context.applicationId
    if app not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[app] = tempfile.mkdtemp(prefix="lonja-")
        context.setCheckpointDir(_LOCAL_FOLDERS[app])
    return _LOCAL_FOLDERS[app]
