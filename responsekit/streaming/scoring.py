"""Streaming batch scoring (M11 over a file stream).

Scoring is a stateless projection (stored feature statistics as literals,
then ``PipelineModel.transform``), so it runs unchanged on a streaming
DataFrame: new customer files arriving in ``source_dir`` are scored
micro-batch by micro-batch into an append-only Parquet sink. The file sink
plus the checkpoint location give exactly-once output across restarts and
executor loss.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from responsekit.catalog import CUSTOMER_SCHEMA, ID_COL, TARGET_COL
from responsekit.models.boosted import probability
from responsekit.operators import evaluate as V
from responsekit.plans.predict import features_for_scoring
from responsekit.sources.model_store import load_model


def start_scoring_stream(spark: SparkSession, model_path: str, source_dir: str, sink_dir: str,
                         checkpoint_location: str, fmt: str = "parquet", schema=CUSTOMER_SCHEMA,
                         available_now: bool = True, max_files_per_trigger: int | None = None):
    """Start the query; returns the ``StreamingQuery``."""
    model, meta = load_model(spark, model_path)
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.load(source_dir)
    x = features_for_scoring(stream, meta)
    p = model.predict(x, keep=(ID_COL,)) if hasattr(model, "bases") else probability(model, x, keep=(ID_COL,))
    out = p.select(ID_COL, "p", V.label_threshold(F.col("p"), meta["threshold"]).alias(TARGET_COL))
    w = (out.writeStream.format("parquet").option("path", sink_dir)
         .option("checkpointLocation", checkpoint_location).outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()
