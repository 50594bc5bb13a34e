"""Structured Streaming text job (S7, K1-K3, T-1, T-5).

source (any streaming DataFrame with a ``value`` column, e.g. files)
  -> unframe / clean (T-1) -> sentiment (T-2..T-4)
  -> parquet sink in append mode with a checkpoint, a query name and a trigger.

All steps are stateless per-row expressions, so append mode needs no state
store and no watermark; exactly-once output comes from the file sink's
metadata log plus the checkpoint (read results through Spark).
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from sparkwright.functions.sentiment import LEXICON, classify_text, score_with_table
from sparkwright.functions.text import clean_stream_text
from sparkwright.session import materialize

#: Bytes of a staged file, about; a task reads one.
FILE_BYTES = 32_000_000

LINE_SCHEMA = StructType([StructField("value", StringType(), True)])


def file_line_source(spark: SparkSession, path: str, glob: str | None = None,
                     max_files_per_trigger: int | None = None) -> DataFrame:
    """Unbounded line source over a folder (new files = new data); all
    files, or those whose names match ``glob``."""
    r = spark.readStream.format("text")
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def stage_lines(lines: DataFrame, path: str, parts: int) -> int:
    """Write ``lines`` as text files of about ``FILE_BYTES``; their number is a
    multiple of ``parts``, and that multiple is returned.  So a stream can read
    any number of rows in ``parts`` batches of which no task reads much."""
    size = lines.agg(F.sum(F.octet_length("value"))).first()[0] or 0
    times = max(1, math.ceil(size / (parts * FILE_BYTES)))
    lines.repartition(parts * times).write.text(path)
    return times


def clean_words(lines: DataFrame, strict: bool = True) -> DataFrame:
    """T-1 on a stream or a batch."""
    return clean_stream_text(lines, "value", strict=strict)


def scored_words(words: DataFrame, lexicon: dict = LEXICON) -> DataFrame:
    """T-4."""
    return classify_text(words, "word", lexicon)


def scored_by_table(words: DataFrame, lexicon: DataFrame) -> DataFrame:
    """T-4 for a lexicon table, on a batch or a micro-batch: (word, polarity,
    subjectivity).  The texts are stored once with a number, so that only
    numbers and tokens meet the lexicon."""
    rows = materialize(words.select("word").withColumn("_row", F.monotonically_increasing_id()))
    return score_with_table(rows, "_row", "word", lexicon).drop("_row")


def run_stream(source: DataFrame, out_path: str, checkpoint: str, query_name: str = "all_texts",
               trigger: dict | None = None, repartition: int | None = None,
               strict: bool = True, lexicon: dict = LEXICON) -> StreamingQuery:
    """T-5: start the job.  ``trigger`` is passed to ``writeStream.trigger``,
    e.g. ``{"processingTime": "60 seconds"}`` or ``{"availableNow": True}``.
    ``repartition`` (default none) sets the files per micro-batch; 1 funnels a
    batch through one task, so it is only for small streams."""
    words = scored_words(clean_words(source, strict), lexicon)
    if repartition:
        words = words.repartition(repartition)
    w = (words.writeStream.queryName(query_name).outputMode("append").format("parquet")
         .option("path", out_path).option("checkpointLocation", checkpoint))
    w = w.trigger(**(trigger or {"processingTime": "60 seconds"}))
    return w.start()


def batch_writer(out_path: str, files: int | None = None, after: Callable[[int], None] | None = None,
                 apply: Callable[[DataFrame], DataFrame] | None = None) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` writer whose output depends on the batch id alone:
    batch k replaces the folder ``batch_id=k``.  A batch that is run again
    after a failure (the checkpoint names the same files for it) writes the
    same rows to the same place, so nothing doubles and nothing is lost.

    ``apply`` turns a batch into what is written; it may use joins and
    aggregates, which need no state since each batch is complete.
    ``files``: files per batch.  ``after`` is called when a batch is written,
    before the checkpoint commits it."""
    def write(batch: DataFrame, batch_id: int) -> None:
        rows = apply(batch) if apply else batch
        rows = rows.repartition(files) if files else rows
        rows.write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")
        if after:
            after(batch_id)
    return write


def run_idempotent(source: DataFrame, out_path: str, checkpoint: str, query_name: str = "all_texts",
                   trigger: dict | None = None, files: int | None = 1, strict: bool = True,
                   lexicon: dict | DataFrame = LEXICON,
                   after: Callable[[int], None] | None = None) -> StreamingQuery:
    """T-5 with a sink that survives a restart: start the job, or go on with the
    one that left ``checkpoint``.  The result is read with
    ``spark.read.parquet(out_path)``; its ``batch_id`` column tells the batch.
    ``files=1`` gives one file a trigger (for small streams).  A lexicon table
    (word, polarity, subjectivity) is joined batch by batch."""
    words, apply = clean_words(source, strict), None
    if isinstance(lexicon, dict):
        words = scored_words(words, lexicon)
    else:
        apply = lambda batch: scored_by_table(batch, lexicon)
    w = words.writeStream.queryName(query_name).outputMode("append").option("checkpointLocation", checkpoint)
    return w.foreachBatch(batch_writer(out_path, files, after, apply)).trigger(
        **(trigger or {"processingTime": "60 seconds"})).start()
