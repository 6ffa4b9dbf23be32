"""Places for tables and files a query writes on its way."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.plans.spec import LakeLayout
from sedimenta.sources import files

_DOCUMENT_ROWS = 5000

def scratch_root(spark: SparkSession) -> str:
    """The shared folder named in ``spark.checkpoint.dir``, or one below the warehouse."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    return (configured or spark.conf.get("spark.sql.warehouse.dir") + "/_scratch").rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder no other query uses, gone when the driver ends. Results are lazy and read
    from it, so it cannot go earlier."""
    folder = f"{scratch_root(spark)}/sedimenta/{name}-{uuid.uuid4().hex}"
    files.delete_at_exit(spark, folder)
    return f"{folder}/data"


def new_lake(spark: SparkSession, name: str) -> LakeLayout:
    root = new_folder(spark, name)
    return LakeLayout(f"{root}/transient", f"{root}/bronze", f"{root}/silver", f"{root}/gold")


def write_json_documents(df: DataFrame, path: str) -> None:
    """Write JSON files that each hold one pretty-printed array of at most 5000 rows."""
    position = F.monotonically_increasing_id()
    numbered = df.withColumn("__document", F.floor(position / F.lit(_DOCUMENT_ROWS)))
    row = F.struct(*[F.col(c) for c in df.columns])
    documents = numbered.groupBy("__document").agg(F.collect_list(row).alias("rows"))
    text = documents.select(F.to_json("rows", {"pretty": "true"}).alias("value"))
    text.write.option("maxRecordsPerFile", 1).text(path)
