"""Masks on streams."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from colmask.plans.mask import mask_table
from colmask.session import stored, work_area, work_folder
from colmask.sources.versions import StreamedCopy, Vault


def write_masked_stream(
    stream: DataFrame,
    columns: Mapping[str, str] | Iterable[str],
    path: str,
    checkpoint: str,
    trigger: Mapping[str, object] | None = None,
    **options,
) -> StreamingQuery:
    """Append a stream with masked columns to a parquet folder.

    Masks keep no state, so each row is masked and written once; by default
    the query takes what is there and stops. With the ``token`` strategy the vault
    must have all values already; see ``write_tokenized_stream`` for values that come with the stream.
    """
    return (
        mask_table(stream, columns, **options)
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a stream keeps in its checkpoint for as long as that lasts."""
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint.rstrip('/')}/metadata")
    content = place.getFileSystem(spark._jsc.hadoopConfiguration()).open(place)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(content, "UTF-8"))["id"]
    finally:
        content.close()


def write_tokenized_stream(
    stream: DataFrame,
    columns: Mapping[str, str],
    path: str,
    checkpoint: str,
    vault: Vault,
    trigger: Mapping[str, object] | None = None,
    **options,
) -> StreamingQuery:
    """Add a stream to the ``StreamedCopy`` at ``path``, with tokens for values that the vault may not have yet.

    ``columns`` maps names to strategies; ``options`` are those of ``mask_table``. A batch is written to the work
    folder, gives its new values tokens, is masked, and then committed under its number, all rows or none. A run that
    dies in between makes the batch anew: its values have tokens already and keep them, and a batch that
    was committed is left out. So every row comes once and no value without its token. Streams that share
    a vault agree on its next version, one after the other.
    """
    spark = stream.sparkSession
    tokens = [name for name, strategy in columns.items() if strategy == "token"]
    masked = mask_table(stream, columns, vault=vault.read(), **options)
    copy = StreamedCopy(spark, path, masked.schema.toDDL())

    def add(batch: DataFrame, number: int) -> None:
        name = _stream_id(spark, checkpoint)
        if copy.has_batch(name, number):
            return
        with work_area(spark):
            # Read back by the session that the vault belongs to: a batch comes in one of its own.
            place = work_folder(spark, "batch")
            batch.write.parquet(place)
            rows = spark.read.schema(batch.schema).parquet(place)
            known = None
            if tokens:
                version = vault.add(rows, tokens, few=True)
                known = stored(vault.lookup(rows, tokens, version), "known")
            copy.add_batch(mask_table(rows, columns, vault=known, **options), name, number)

    return (
        stream.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
