"""Intermediate tables in the shared folder that the cluster names in ``spark.checkpoint.dir``."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from panelrank.session import ensure_checkpoint_dir


class Store:
    """One run's folder of Parquet tables under the shared checkpoint folder; ``drop`` removes tables no longer read."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"

    def write(self, df: DataFrame, table: str) -> DataFrame:
        """``df`` written once and reread: lineage is cut, and a lost executor rereads files."""
        path = f"{self.path}/{table}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *tables: str) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for t in tables:
            p = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{t}")
            p.getFileSystem(conf).delete(p, True)
