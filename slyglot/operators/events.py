"""Label events (A11-A13): rows that a moderation service would be sent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slyglot.sources.posts import resolve_handles

NO_STRINGS = "array<string>"


def _event(created_by: str, labels: Column, uri: Column, cid: Column, did: Column) -> list[Column]:
    none = F.array().cast(NO_STRINGS)
    return [
        F.lit(created_by).alias("created_by"),
        F.struct(
            labels.alias("create_label_vals"), none.alias("negate_label_vals")
        ).alias("event"),
        F.struct(uri.alias("uri"), cid.alias("cid"), did.alias("did")).alias("subject"),
        none.alias("subject_blob_cids"),
    ]


def post_events(labeled: DataFrame, created_by: str, emit: bool = True) -> DataFrame:
    """One event per labelled post; none when not asked to emit."""
    absent = F.lit(None).cast("string")
    wanted = labeled.filter(F.lit(emit) & (F.size("labels") > 0))
    return wanted.select(
        *_event(created_by, F.col("labels"), F.col("uri"), F.col("cid"), absent)
    )


def account_events(requests: DataFrame, accounts: DataFrame, created_by: str) -> DataFrame:
    """One event per ``(handle, labels)`` request whose account is known."""
    absent = F.lit(None).cast("string")
    known = resolve_handles(requests, accounts).filter(F.col("did").isNotNull())
    return known.select(*_event(created_by, F.col("labels"), absent, absent, F.col("did")))


def write_events(events: DataFrame, path: str) -> None:
    """Append events to a table of files."""
    events.write.mode("append").parquet(path)
