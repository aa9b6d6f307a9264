"""Helpers several operators use: input columns, checkpoints, hashed sampling."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def checkpointed(frame: DataFrame) -> DataFrame:
    """Write `frame` to the checkpoint folder of the session and cut its lineage.

    The folder is `spark.checkpoint.dir`. Only where it is unset, as in local tests,
    a temporary folder takes its place.
    """
    context = frame.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        folder = frame.sparkSession.conf.get("spark.checkpoint.dir", None)
        if folder is None and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoints-"))
    return frame.checkpoint()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column: str | Column = "text") -> Column:
    """The text, empty for NULL."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def row_keys(docs: DataFrame) -> list[Column]:
    """Two hashes of id and text that tell the rows of `docs` apart, whatever ids repeat."""
    return [F.xxhash64(F.lit(seed), docs["doc_id"].isNull(), docs["doc_id"], docs["text"].isNull(), docs["text"]) for seed in (3, 4)]


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id written as text, modulo `folds`; NULL for a NULL id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def hashed_share(key: Column, share: float, seed: int = 17) -> Column:
    """True for about `share` of the keys, the same ones in every run."""
    return F.pmod(F.xxhash64(F.lit(seed), key), F.lit(1_000_000)) < F.lit(int(share * 1_000_000))
