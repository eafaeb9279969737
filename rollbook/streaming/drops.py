"""Load each drop when its completion note arrives.

A merge deletes what the dump lacks, so it must see a whole drop. The stream therefore carries notes
that a drop is complete (one small JSON file each), and the drop itself is read as a batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

NOTE_SCHEMA = "run_key string, folder string"


def watch_drops(
    spark: SparkSession, notes: str, checkpoint: str, handle: Callable[[str, str], object], once: bool = True
) -> StreamingQuery:
    """Call ``handle(run_key, folder)`` for every new note, one note per micro-batch, in order of arrival.

    A batch that is repeated after a failure calls ``handle`` again; loads skip steps already done.
    """

    def batch(df: DataFrame, batch_id: int) -> None:
        # One note, because of maxFilesPerTrigger.
        for row in df.distinct().orderBy("run_key").collect():
            handle(row["run_key"], row["folder"])

    stream = spark.readStream.schema(NOTE_SCHEMA).option("maxFilesPerTrigger", 1).json(notes)
    writer = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start() if once else writer.start()
