"""Keep the bronze tables up to date from their streams."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from callmeter.sources.csv_files import CsvStream, read_csv
from callmeter.sources.lake import Lake

# The part of a table that its CSV files make up.
CSV_SOURCE = "csv"


def _store_csv(lake: Lake, schema: StructType, table: str):
    """Store a batch of files as a part of a bronze table, and list what was refused of it.

    A repeated batch replaces its own part, so rows neither double nor get lost.
    """

    def store(files: DataFrame, batch: int) -> None:
        own = Lake(files.sparkSession, lake.prefix, lake.format)
        # The names of a batch's files; ``maxFilesPerTrigger`` bounds their number.
        paths = sorted(r["path"] for r in files.select("path").collect())
        rows, refused = read_csv(own.spark, paths, schema)
        rows = rows.withColumn("ingested_at", F.current_timestamp())
        kept = ", ".join([*schema.fieldNames(), "ingested_at"])
        own.write_part(rows, "bronze", table, CSV_SOURCE, batch, f"SELECT {kept} FROM {{parts}}")
        refused = refused.select(F.lit(table).alias("table_name"), "path", "missing", F.current_timestamp().alias("refused_at"))
        own.write_part(refused, "bronze", "refused_files", table, batch, "SELECT * EXCEPT (source, batch) FROM {parts}")

    return store


def surplus_values(lake: Lake, table: str) -> DataFrame:
    """The records of a bronze table's CSV files that had more values than their header (source_file, surplus_record)."""
    return lake.parts("bronze", table).filter("surplus_record IS NOT NULL").select("source_file", "surplus_record")


def append_stream(lake: Lake, stream: DataFrame | CsvStream, table: str, checkpoint_root: str) -> StreamingQuery:
    """Append what has arrived since the last run to a bronze table, then stop.

    ``checkpoint_root`` is a folder all executors share; each table's progress
    lies below it and lets a failed run resume without loss or repetition.
    CSV files without all columns are listed in ``refused_files``.
    """
    if isinstance(stream, CsvStream):
        lake.name("bronze", table)
        return (
            stream.files.writeStream.foreachBatch(_store_csv(lake, stream.schema, table))
            .option("checkpointLocation", f"{checkpoint_root}/{table}")
            .trigger(availableNow=True)
            .start()
        )
    return (
        stream.writeStream.format(lake.format)
        .option("checkpointLocation", f"{checkpoint_root}/{table}")
        .trigger(availableNow=True)
        .toTable(lake.name("bronze", table))
    )


def run_bronze(lake: Lake, streams: Mapping[str, DataFrame | CsvStream], checkpoint_root: str) -> dict[str, StreamingQuery]:
    """Bring the given bronze tables up to date side by side; returns the ended queries.

    All tables are waited for before the first failure, if any, is raised.
    """
    running = {table: append_stream(lake, stream, table, checkpoint_root) for table, stream in streams.items()}
    failures = []
    for query in running.values():
        try:
            query.awaitTermination()
        except StreamingQueryException as failure:
            failures.append(failure)
    if failures:
        raise failures[0]
    return running
