"""Sessions with the settings that the engine expects, and the folder that all machines share."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def session(name: str = "tesserae", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    defaults = {"spark.sql.adaptive.enabled": "true", "spark.sql.session.timeZone": "UTC", "spark.sql.execution.arrow.pyspark.enabled": "true"}
    for k, v in (defaults | conf).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; where that is unset, one in the warehouse, which is shared as well. Never a machine's own."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/checkpoints"
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def spread(df: DataFrame) -> DataFrame:
    """df in at least two tasks a core, for columns that take long: a file of few bytes is one task otherwise, however long its rows take."""
    n = 2 * df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= n else df.repartition(n)


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """df with columns that are computed once a row. Spark copies other ones into every filter and column that reads them."""
    for name, c in columns.items():
        df = df.select("*", F.explode_outer(F.array(c)).alias(name))
    return df


def cut(df: DataFrame) -> DataFrame:
    """df with its lineage cut by a reliable checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()
