"""Score flights as they arrive with Structured Streaming.

The reference scores a table in batch.  The same prediction step runs on a
stream of flight rows: the fitted baseline is a set of small static tables
(group predictions, defaults, vocabulary), and each micro-batch is joined to
them (stream-static joins, no state kept between batches).  Output is
appended to a Parquet sink with a checkpoint, so a restarted or failed query
resumes exactly where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from pushback.operators import baseline as bl


def score_baseline_stream(stream: DataFrame, model: bl.BaselineModel) -> DataFrame:
    """Streaming DataFrame with ``predicted_baseline`` and ``missing_core_features_baseline``."""
    return bl.predict_baseline(model, stream)


def start_scoring(stream: DataFrame, model: bl.BaselineModel, sink_path: str, checkpoint_path: str,
                  available_now: bool = False, processing_time: str | None = None) -> StreamingQuery:
    """Start the scoring query: append to Parquet at ``sink_path`` (exactly once with the checkpoint)."""
    scored = score_baseline_stream(stream, model).drop("baseline_error_msg")
    w = (scored.writeStream.format("parquet").outputMode("append")
         .option("path", sink_path).option("checkpointLocation", checkpoint_path))
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()
