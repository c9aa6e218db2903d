"""Cut the lineage of a DataFrame in the folder the cluster shares."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def checkpointed(df: DataFrame) -> DataFrame:
    """`df`, computed once and kept as files in spark.checkpoint.dir, so that a lost executor costs a read only.

    Spark removes the files with the DataFrame if spark.cleaner.referenceTracking.cleanCheckpoints is set. Where no
    folder is set, a local session (as in tests) gets one of its own; on a cluster that is an error.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local") or context.master.startswith("local-cluster"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="gridcast-")
        context.setCheckpointDir(folder)
    return df.checkpoint(eager=True)
