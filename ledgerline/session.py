"""Sessions, and getting this package to the executors."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import zipfile
from collections.abc import Callable
from functools import wraps
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()
_folders: dict[str, str] = {}


def _own_folder(prefix: str) -> str:
    """A folder of the driver's own, for as long as it lives."""
    path = tempfile.mkdtemp(prefix=prefix)
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return path


def ship(spark: SparkSession) -> None:
    """Make the package importable in Python workers, wherever the driver was started. Once for each application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parent
    path = Path(_own_folder("ledgerline-ship-")) / "ledgerline.zip"
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, Path("ledgerline") / f.relative_to(root))
    spark.sparkContext.addPyFile(str(path))
    _shipped.add(app)


def shipped(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """``f(spark, ...)`` after the package has been shipped."""

    @wraps(f)
    def run(spark: SparkSession, *args: object, **kw: object) -> DataFrame:
        ship(spark)
        return f(spark, *args, **kw)

    return run


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or in local mode a folder of our own."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _folders:
        _folders[app] = _own_folder("ledgerline-")
    return _folders[app]


def local(cores: int | str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session with the settings that the queries are compared under."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
