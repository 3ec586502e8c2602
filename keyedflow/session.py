"""Session settings that go with this engine."""

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send the source of this library to the executors, once per application.

    Functions that run in tasks import it there. `spark-submit --py-files` does the same; this is
    for sessions that were started without it.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="keyedflow-source-")) / f"{root.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(root.rglob("*.py")):
            out.write(source, source.relative_to(root.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def local_session(cpus: int | str = "*", memory: str = "8g", partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks; on a cluster use the one the cluster gives."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("keyedflow")
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
