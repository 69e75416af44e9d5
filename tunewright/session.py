"""Session defaults and the shared scratch location."""

import tempfile
import uuid

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # methods beyond this size are not compiled by the JIT; split code is
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def local_session(cores=8, app="tunewright", memory="8g", shuffle=None):
    """Single-JVM session for tests and benchmarks."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.driver.memory", memory)
               .config("spark.ui.enabled", "false")
               .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64KB")
               .config("spark.sql.files.openCostInBytes", "262144")
               .config("spark.python.sql.dataFrameDebugging.enabled", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle or cores)))
    for key, value in _DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.config("spark.ui.showConsoleProgress", "false").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_local_root = []


def shared_dir(spark, purpose):
    """Fresh path under the folder all executors share.

    The cluster names that folder in spark.checkpoint.dir.  Only a local master
    may fall back to a folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        if not _local_root:
            _local_root.append(tempfile.mkdtemp(prefix="tunewright-"))
        root = _local_root[0]
    return f"{root.rstrip('/')}/tunewright/{purpose}-{uuid.uuid4().hex}"


def materialised(spark, df, purpose):
    """Rows written to the shared folder and read back: a cut in the lineage that survives lost executors."""
    path = shared_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
