"""What the trained operators share: folds by document id and bounded samples of labelled rows."""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import durable


def fold(id_col: str | Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    column = F.col(id_col) if isinstance(id_col, str) else id_col
    return (F.crc32(column.cast("string")) % F.lit(folds)).cast("int")


def in_fold(id_col: str, folds: int, held: int) -> Column:
    """True for held-out rows; a row without an id is held out, so nothing is learnt from it."""
    return F.coalesce(fold(id_col, folds) == held, F.lit(True))


#: Rows that any one label is granted at most.
GRANTED = 500
#: Bytes of text that a sample holds at most.
SAMPLE_BYTES = 64 << 20


def _share(wanted: int, rows: int) -> float:
    """A share of the hashes under which ``wanted`` of so many rows lie but in one case of many millions."""
    return min(1.0, (wanted + 6 * math.sqrt(wanted) + 10) / max(1, rows))


def dealt(known: DataFrame, rows: int) -> DataFrame:
    """At most ``rows`` ids (_id) of distinct pairs (_id, _label): a fifth is granted to the labels evenly, the rest goes by the hash of the id.

    A label that is common enough gets its grant by the hash anyway, so only rare labels change the sample.  From the number of rows
    of each label follows how small a hash must be to come into question; only such ids are looked at one by one, which are
    little more than those chosen, so no task and no driver holds a label.  As many numbers as there are labels come to the driver.
    """
    counts = {r["_label"]: r["n"] for r in known.groupBy("_label").agg(F.count("*").alias("n")).collect()}
    grant = min(GRANTED, max(1, rows // (5 * max(1, len(counts)))))
    of_all = _share(rows, sum(counts.values()))
    spark = known.sparkSession
    ids = known.schema["_id"]
    limits = [(label, min((1 << 63) - 1, int(max(of_all, _share(grant, n)) * 2.0**64) - (1 << 63))) for label, n in counts.items()]
    schema = T.StructType([known.schema["_label"], T.StructField("_limit", T.LongType())])
    small = known.join(F.broadcast(spark.createDataFrame(limits, schema)), "_label").withColumn("_hash", F.xxhash64("_id"))
    asked = small.filter(F.col("_hash") <= F.col("_limit")).select("_hash", "_id", "_label").collect()
    taken = Counter()
    asked.sort(key=lambda r: (r["_hash"], r["_id"]))
    first, rest = [], []
    for r in asked:
        taken[r["_label"]] += 1
        (first if taken[r["_label"]] <= grant else rest).append(r["_id"])
    return spark.createDataFrame([(i,) for i in list(dict.fromkeys([*first, *rest]))[:rows]], T.StructType([ids]))


def labelled_sample(labels: DataFrame, id_col: str, label_col: str, folds: int, held: int, rows: int) -> DataFrame:
    """(id, label) of at most ``rows`` labelled ids outside the held-out fold, chosen by label and the hash of the id.

    An id with contradicting labels is left out; null ids and null labels too.
    """
    known = (
        labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_label"))
        .filter(F.col("_id").isNotNull() & F.col("_label").isNotNull() & ~in_fold("_id", folds, held))
        .groupBy("_id").agg(F.min("_label").alias("_label"), F.max("_label").alias("_other"))
        .filter("_label = _other")
    )
    known = known.select("_id", "_label")
    return known.join(F.broadcast(dealt(known, rows)), "_id").select("_id", "_label")


def sampled_texts(docs: DataFrame, sample: DataFrame, id_col: str, text_col: str, most_bytes: int | None = None) -> DataFrame:
    """(_id, _label, _text) of the sampled ids; one text for an id that stands more than once.

    Texts are taken in the order of the hashes of their ids; one that is longer than what is left of ``most_bytes`` is passed over.
    """
    most_bytes = SAMPLE_BYTES if most_bytes is None else most_bytes
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    # The sample has a fixed number of rows, so it is sent to every task and the texts stay where they are.
    labels = [c for c in sample.columns if c != "_id"]
    found = durable(texts.join(F.broadcast(sample), "_id").groupBy("_id", *labels).agg(F.max("_text").alias("_text")))
    sizes = found.select("_id", F.coalesce(F.octet_length("_text"), F.lit(0)).alias("size"), F.xxhash64("_id").alias("hash")).collect()
    left, over = most_bytes, []
    for r in sorted(sizes, key=lambda r: (r["hash"], r["_id"])):
        if r["size"] > left:
            over.append((r["_id"],))
        else:
            left -= r["size"]
    if not over:
        return found
    return found.join(F.broadcast(docs.sparkSession.createDataFrame(over, T.StructType([found.schema["_id"]]))), "_id", "left_anti")


def unused(name: str, columns: list[str]) -> str:
    """``name``, made longer until no column has it; Spark does not tell capitals from small letters."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name
