"""Materialising a small intermediate that several scans read.

Each sliced scan reads its input twice (window branch and summary branch),
so a chain of scans over a derived table multiplies the work below it.  A
table that is small next to the data -- the decoded registry event log --
is written once as a reliable checkpoint in the cluster's checkpoint folder
(``spark.checkpoint.dir``); that also cuts its lineage, so a lost executor
does not recompute the decode.  Large tables are never materialised here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from logflow.session import ensure_checkpoint_dir


def materialize(df: DataFrame) -> DataFrame:
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
