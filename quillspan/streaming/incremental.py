"""Incremental encoding of a growing chunk folder (an extension: the batch operator under Structured Streaming)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from quillspan.operators.incremental import Encoder, encoded
from quillspan.sources.files import prior_vectors


def follow(spark: SparkSession, chunks: str, schema: StructType, vectors: str, checkpoint: str, make: Callable[[], Encoder], id_col: str = "id", text_col: str = "text", once: bool = True) -> StreamingQuery:
    """Encode what arrives below ``chunks`` into ``vectors``, each content id once.

    A batch writes its own folder and overwrites it when it is run again, so a lost executor or a restart leaves
    neither gaps nor repeats. Ids already stored by other batches are left out by an anti-join.
    """
    dim = make().dim

    def write(batch: DataFrame, number: int) -> None:
        fresh = batch.dropDuplicates([id_col])
        stored = prior_vectors(spark, f"{vectors}/batch=*", dim)
        if stored is not None:
            others = spark.read.option("basePath", vectors).parquet(f"{vectors}/batch=*").filter(f"batch <> {number}")
            fresh = fresh.join(others.select(id_col), id_col, "left_anti")
        encoded(fresh, id_col, text_col, make).write.mode("overwrite").parquet(f"{vectors}/batch={number}")

    stream = spark.readStream.schema(schema).parquet(chunks).select(id_col, text_col)
    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
