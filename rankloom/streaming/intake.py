"""Documents that keep arriving: load and read features as files land.

Cleaning, redaction and features look at one row at a time, so the batch expressions run on a stream
as they are and keep no state. Ranking needs the whole pool and stays a batch job over the table
written here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.features import build_features
from ..functions.vocabulary import DEFAULT_VOCABULARY, Vocabulary
from ..sources.readers import prepare_text

ARRIVING = "id string, category string, text string"


def featured_stream(arriving: DataFrame, current_year: int, vocab: Vocabulary = DEFAULT_VOCABULARY) -> DataFrame:
    return build_features(prepare_text(arriving), current_year, vocab)


def start_intake(
    spark: SparkSession, inbox: str, table: str, checkpoint: str, current_year: int, files_per_trigger: int = 1000
) -> StreamingQuery:
    """Follow a folder of parquet files and append cleaned, featured rows to ``table``; stops when caught up."""
    arriving = spark.readStream.schema(ARRIVING).option("maxFilesPerTrigger", files_per_trigger).parquet(inbox)
    return (
        featured_stream(arriving, current_year)
        .withColumn("loaded_at", F.current_timestamp())
        .writeStream.format("parquet")
        .option("path", table)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
