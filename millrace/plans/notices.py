"""Space notices and circulars: text messages to columns, JSON to documents, labels and counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import degrees_of, minutes_of
from millrace.functions.times import notice_time
from millrace.operators.relational import labelled_counts
from millrace.operators.texts import EVENT_LABELS, NOTICE_KEYS, circular_documents, classify, parse_circulars, pivot_messages


def pointing_notices(messages: DataFrame, group: list[str]) -> DataFrame:
    """One row per notice with its keys as columns; repeated comments are joined in order."""
    wide = pivot_messages(messages, "msg", group, NOTICE_KEYS, repeated=["COMMENTS"])
    return wide.withColumn("NOTICE_DATE", notice_time(F.col("NOTICE_DATE"))).withColumn(
        "MERIT", F.round(F.col("MERIT").try_cast("double"), 0).cast("decimal(10,0)")
    )


def pointings(notices: DataFrame) -> DataFrame:
    """Numeric pointing and observation time of each notice."""
    return notices.select(
        "NOTICE_DATE", "TGT_NAME", degrees_of(F.col("NEXT_POINT_RA")).alias("ra_degrees"),
        degrees_of(F.col("NEXT_POINT_DEC")).alias("dec_degrees"), minutes_of(F.col("OBS_TIME")).alias("obs_minutes"),
    )


def documents(messages: DataFrame, base_url: str) -> DataFrame:
    return circular_documents(parse_circulars(messages, "msg", ["offset", "timestamp"]), base_url)


def labelled(docs: DataFrame, labels: Mapping[str, Sequence[str]] = EVENT_LABELS) -> DataFrame:
    return classify(docs, "content", labels, "event_class")


def label_counts(docs: DataFrame, classified: DataFrame) -> DataFrame:
    return labelled_counts({"documents": docs, "classified_documents": classified}, "event_class")
