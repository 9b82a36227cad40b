"""Table access, current rows and reliable checkpoints."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The parquet table ``name`` under ``root``."""
    return spark.read.parquet(f"{root}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder the cluster names in spark.checkpoint.dir; a local session without one gets one of its own, a cluster is refused.

    Checkpoints are removed with their DataFrames where spark.cleaner.referenceTracking.cleanCheckpoints is true.
    """
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
        if not folder and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="turnloom-"))


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` read back from a reliable checkpoint: its lineage is cut and its partitions stay as they are."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def current_rows(df: DataFrame, keys: list[str], columns: list[str], version: str = "loaded_at") -> DataFrame:
    """One row per key, the one with the latest ``version``.

    Rows with a null key are dropped (they name nothing); a null version is older than any other; among equal
    versions the greatest remaining columns win, so the result doesn't depend on the order of the input.
    Only ``columns`` are carried, and a partial maximum is taken before the shuffle.
    """
    rest = [c for c in columns if c not in keys]
    packed = F.struct(F.col(version).alias("__v"), *[F.col(c) for c in rest])
    kept = df.where(F.concat(*[F.col(k).cast("string") for k in keys]).isNotNull())
    return kept.groupBy(*keys).agg(F.max(packed).alias("__r")).select(*keys, *[F.col("__r")[c].alias(c) for c in rest])


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the executors once per application, so that Python tasks find it wherever they run."""
    import zipfile
    from pathlib import Path

    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="turnloom-")) / "turnloom.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, f"turnloom/{p.relative_to(root)}")
    spark.sparkContext.addPyFile(str(target))
    _shipped.add(app)
