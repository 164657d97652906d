"""Karas-layout CSV lines harmonised as a file stream.

Each line carries its own time (``time_s``), so unlike the position-timed
layouts nothing depends on earlier lines: parse, label, convert units per
line. A stream cannot join every file's own header, so the column layout is
given (``columns``, the header of the files); header lines are recognised by
their first field and dropped.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sensorweave import catalog
from sensorweave.functions import labels, paths, timegrid, units
from sensorweave.session import checkpoint_dir
from sensorweave.sources.text import split_csv


def karas_stream(spark: SparkSession, source_dir: str, columns: Sequence[str],
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming ``time_ms, sid, surface, <accelerations in m/s^2>``."""
    columns = [c.lower() for c in columns]
    reader = spark.readStream.format("text").option("pathGlobFilter", "*.csv")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    lines = reader.load(source_dir).select(
        paths.decoded_path(F.col("_metadata.file_path")).alias("path"), F.col("value").alias("line"))
    tok = split_csv(F.col("line"))
    first = F.lower(F.trim(F.try_element_at(tok, F.lit(1))))
    # as in the batch reader, a line with more fields than the header is left out
    rows = lines.filter((F.trim(F.col("line")) != "") & (first != F.lit(columns[0])) & (F.size(tok) <= len(columns)))
    fields = {n: F.try_element_at(tok, F.lit(i + 1)) for i, n in enumerate(columns)}
    accel = [c for c in columns if c not in ("activity", "time_s")]
    return rows.select(
        timegrid.seconds_to_ms(units.coerce_numeric(fields["time_s"])).alias("time_ms"),
        paths.file_stem(F.col("path")).alias("sid"),
        labels.map_label(fields["activity"], catalog.KARAS_SURFACES, labels.NULL).alias("surface"),
        *[units.g_to_ms2(units.coerce_numeric(fields[c])).alias(c) for c in accel])


def start_parquet_sink(df: DataFrame, path: str, name: str = "karas",
                       checkpoint: str | None = None, available_now: bool = False) -> StreamingQuery:
    """Append the stream to Parquet; progress is kept under the shared
    ``spark.checkpoint.dir`` so a restarted job resumes exactly once."""
    ckpt = checkpoint or os.path.join(checkpoint_dir(df.sparkSession), "streams", name)
    writer = (df.writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", ckpt).option("path", path))
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
