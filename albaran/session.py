"""Session helpers: table access, checkpoint folder, a session for tests and benchmarks."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """The package to the Python workers of all executors, once for each application: they need not have it installed.

    Spark serves the archive to executors that come later, too.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    to = Path(tempfile.mkdtemp(prefix="albaran-code-")) / "albaran.zip"
    with zipfile.ZipFile(to, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, Path("albaran") / f.relative_to(root))
    sc.addPyFile(str(to))
    _SHIPPED.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of a data folder."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """df in at least as many partitions as there are cores, for expressions that cost much more than moving the rows.

    A small file is one task otherwise. Larger inputs have more partitions than cores already and are left alone.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder for checkpoints, which spark.checkpoint.dir names.

    Where that is unset, a local master (one machine, as in tests) gets a temporary folder; on a cluster it is an error,
    as the executors could not share it.
    """
    sc = spark.sparkContext
    now = sc.getCheckpointDir()
    if now:
        return now
    said = spark.conf.get("spark.checkpoint.dir", None)
    if not said and not sc.master.split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(said or tempfile.mkdtemp(prefix="albaran-checkpoint-"))
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Materialise df in the shared checkpoint folder, so that a lost executor costs no recomputation."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def local_session(cores: int = 8, memory: str = "16g", shuffle: int | None = None) -> SparkSession:
    """A local session for tests and benchmarks."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("albaran")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle or cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def settle(df: DataFrame, *names: str) -> DataFrame:
    """df with the named columns computed once: filters and joins on them stay above this point.

    The optimizer moves a filter below projections by writing the projected expressions into it again, which multiplies
    long chains of expressions. A generator of one row is not crossed.
    """
    kept = [F.col(f"`{c}`") for c in df.columns if c not in names]
    return df.select(*kept, F.inline_outer(F.array(F.struct(*[F.col(f"`{n}`") for n in names]))))
