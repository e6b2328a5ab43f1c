"""Extension: new monthly files, each taken once, through the same cleaning plan."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..plans.cleaning import clean_bm, clean_bv


def clean_new_files(spark: SparkSession, in_dir: str, schema: StructType, kind: str, out_dir: str, checkpoint: str) -> StreamingQuery:
    """Cleans files that came since the last call and appends them to out_dir; the checkpoint knows which those are."""
    clean = {"BM": clean_bm, "BV": clean_bv}[kind]

    def each(batch: DataFrame, number: int) -> None:
        clean(batch, datetime.datetime.now()).write.mode("overwrite").parquet(f"{out_dir}/batch={number}")

    return spark.readStream.schema(schema).parquet(in_dir).writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
