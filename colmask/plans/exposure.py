"""Exposure of a table's files, kept as sketches, so that a new file costs its own scan."""

from __future__ import annotations

import random
import time
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colmask import schemas
from colmask.functions.names import free_name, quote_ident
from colmask.operators.sketches import K, exposure_sketch, merged_exposure
from colmask.plans.follow import FILES_AT_ONCE, file_id, in_parts, source_files
from colmask.plans.mask import mask_table
from colmask.session import stored, work_area
from colmask.sources.commits import CommitConflict
from colmask.sources.versions import GrowingTable


class ExposureSketches(GrowingTable):
    """Sketches of files in a folder, for one table, one way to mask it and one choice of sets."""

    def __init__(self, spark: SparkSession, path: str):
        super().__init__(spark, path, schemas.SKETCHES)

    def follow(
        self,
        name: str,
        root: str,
        schema: str,
        columns: Mapping[str, str],
        sets: Mapping[str, Sequence[str]],
        k: int = K,
        source_format: str = "parquet",
        **options,
    ) -> DataFrame:
        """``merged_exposure`` of the files that are under ``root`` now, as they come out of ``mask_table``.

        Only files without a sketch are read; those of files that are gone or replaced take no part. Other masks
        or sets than before are an error: give them a folder of their own.
        """
        wanted = repr((name, sorted(columns.items()), sorted((s, list(c)) for s, c in sets.items()), k))
        while True:
            last = self._commit()
            if last is not None and last["wanted"] != wanted:
                raise ValueError(f"{self.path} holds sketches of other masks or sets: {last['wanted']}")
            now = stored(source_files(self.spark, root), "files")
            here = now.select(F.col("file").cast("string").alias("unit"))
            with work_area(self.spark):
                known = self._rows(last).filter("hash IS NULL").select("unit").distinct()
                new = stored(here.join(known, "unit", "left_anti"), "new")
                paths = now.join(new, now["file"].cast("string") == new["unit"], "left_semi").select("path")
                added = None
                for part in in_parts((r["path"] for r in paths.toLocalIterator()), FILES_AT_ONCE):
                    rows = self.spark.read.format(source_format).schema(schema).option("basePath", root).load(part)
                    mark = free_name(rows.columns, "_file")
                    rows = rows.select(*map(quote_ident, rows.columns), file_id().alias(mark))
                    sketch = stored(exposure_sketch(name, mask_table(rows, columns, **options), mark, sets, k), "sketch")
                    added = sketch if added is None else added.unionByName(sketch)
                try:
                    if added is not None:
                        self._append(added, last, wanted=wanted)
                    return merged_exposure(self.read().join(here, "unit", "left_semi"))
                except CommitConflict:
                    time.sleep(random.uniform(0, 0.2))
