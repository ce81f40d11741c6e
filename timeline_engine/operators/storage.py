"""Durable intermediate results."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import DataFrame


def settled(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared checkpoint folder: plans that
    use it several times stay small, and a lost executor costs a reread. The
    folder is the session's ``spark.checkpoint.dir``; only a local master may do
    without the setting."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        named = context.getConf().get("spark.checkpoint.dir")
        if named is None:
            if not context.master.startswith("local") or context.master.startswith("local-cluster"):
                raise ValueError("spark.checkpoint.dir must name a folder shared by all executors")
            named = tempfile.mkdtemp(prefix="timeline_engine_")
            atexit.register(shutil.rmtree, named, ignore_errors=True)
        context.setCheckpointDir(named)
    return df.checkpoint()
