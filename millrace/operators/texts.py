"""Key-value messages, chunks, labels and model columns."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import line_key, line_value, words

# Keys of a pointing notice.
NOTICE_KEYS = [
    "TITLE", "NOTICE_DATE", "NOTICE_TYPE", "NEXT_POINT_RA", "NEXT_POINT_DEC", "NEXT_POINT_ROLL", "SLEW_TIME",
    "SLEW_DATE", "OBS_TIME", "TGT_NAME", "TGT_NUM", "MERIT", "INST_MODES", "SUN_POSTN", "SUN_DIST", "MOON_POSTN",
    "MOON_DIST", "MOON_ILLUM", "GAL_COORDS", "ECL_COORDS", "COMMENTS",
]

# Labels of space events with the words that point to them.
EVENT_LABELS = {
    "gamma-ray burst": ["grb", "gamma-ray", "burst"],
    "fast X-ray transient": ["x-ray", "fxt"],
    "gravitational wave": ["gravitational", "ligo", "virgo"],
    "neutrino": ["neutrino", "icecube"],
    "supernova": ["supernova", "sn"],
    "optical transient": ["optical", "magnitude"],
}


def message_lines(df: DataFrame, message: str, keep: Sequence[str]) -> DataFrame:
    """One row per non-empty line: key before the first colon, trimmed rest, position in the message."""
    lines = df.select(*keep, F.posexplode(F.split(message, "\n")).alias("line_no", "line")).filter("line != ''")
    return lines.select(*keep, "line_no", line_key(F.col("line")).alias("key"), line_value(F.col("line")).alias("value"))


def pivot_messages(
    df: DataFrame, message: str, group: Sequence[str], names: Sequence[str], repeated: Sequence[str] = ()
) -> DataFrame:
    """Messages of ``KEY: value`` lines to one row each.

    The lines are looked up inside the message's own row, so nothing is
    shuffled.  A repeated key keeps its greatest value, or all values in line
    order when listed in ``repeated``.
    """
    lines = F.transform(
        F.filter(F.split(message, "\n"), lambda line: line != ""),
        lambda line: F.struct(line_key(line).alias("key"), line_value(line).alias("value")),
    )
    # Sorted by key and value, the last pair of each key holds its greatest value.
    sorted_lines = df.select(*group, lines.alias("_lines")).withColumn("_sorted", F.sort_array("_lines"))
    following = F.col("_sorted")
    last = F.filter("_sorted", lambda p, i: ~F.get(following, i + 1)["key"].eqNullSafe(p["key"]))
    mapped = sorted_lines.withColumn("_values", F.map_from_entries(last))

    def cell(name: str) -> Column:
        if name in repeated:
            values = F.transform(F.filter("_lines", lambda p: p["key"] == name), lambda p: p["value"])
            return F.when(F.size(values) > 0, F.array_join(values, " ")).alias(name)
        return F.try_element_at("_values", F.lit(name)).alias(name)

    return mapped.select(*group, *[cell(n) for n in names])


def chunk_words(df: DataFrame, text: str, size: int = 500, overlap: int = 75) -> DataFrame:
    """Overlapping word chunks of the whole text, numbered, with the md5 of the chunk as id.

    Splitting, slicing and joining are array functions, so the rows stay in the JVM.
    """
    if not 0 <= overlap < size:
        raise ValueError("the overlap must be smaller than the chunk")
    step = size - overlap
    count = F.greatest(F.lit(1), F.ceil((F.size("_words") - overlap) / step)).cast("int")
    pieces = F.transform(
        F.sequence(F.lit(0), count - 1), lambda i: F.array_join(F.slice(F.col("_words"), i * step + 1, F.lit(size)), " ")
    )
    # Blank texts are dropped by a test on the text itself: one on the words would split each text twice.
    split = df.filter(F.col(text).rlike(r"\S")).withColumn("_words", words(F.col(text)))
    chunks = split.select(*[c for c in df.columns if c != text], F.posexplode(pieces).alias("chunk_no", "chunk"))
    return chunks.withColumn("chunk_id", F.md5("chunk"))


def listed_words(text: Column, labels: Mapping[str, Sequence[str]]) -> Column:
    """The words of the text that point to any label, in one pass over the text."""
    every = sorted({w for listed in labels.values() for w in listed})
    return F.filter(F.split(F.lower(text), r"[\s.,;:!?()]+"), lambda w: w.isin(every))


def label_scores(hits: Column, labels: Mapping[str, Sequence[str]]) -> dict[str, Column]:
    """Number of words that point to each label."""

    def count(listed: Sequence[str]) -> Column:
        return F.size(F.filter(hits, lambda w: w.isin(list(listed))))

    return {label: count(listed) for label, listed in labels.items()}


def classify(df: DataFrame, text: str, labels: Mapping[str, Sequence[str]], name: str = "label", other: str = "other") -> DataFrame:
    """The label with most words in the text; the first listed wins ties, no word gives ``other``."""
    hits = df.withColumn("_hits", listed_words(F.col(text), labels))
    scored = F.array(*[F.struct(s.alias("score"), F.lit(-i).alias("rank"), F.lit(label).alias("label"))
                       for i, (label, s) in enumerate(label_scores(F.col("_hits"), labels).items())])
    out = hits.withColumn("_best", F.array_max(scored))
    return out.withColumn(name, F.when(F.col("_best.score") > 0, F.col("_best.label")).otherwise(other)).drop("_best", "_hits")


def sentiment(df: DataFrame, text: str, positive: Sequence[str], negative: Sequence[str], name: str = "sentiment") -> DataFrame:
    """Sign of positive minus negative words."""
    lists = {"p": positive, "n": negative}
    scored = df.withColumn("_hits", listed_words(F.col(text), lists))
    scores = label_scores(F.col("_hits"), lists)
    balance = scores["p"] - scores["n"]
    mood = F.when(balance > 0, "positive").when(balance < 0, "negative").otherwise("neutral")
    return scored.withColumn(name, mood).drop("_hits")


def apply_model(
    df: DataFrame, inputs: Sequence[str], name: str, load: Callable[[], Callable[..., Sequence]], kind: str = "string"
) -> DataFrame:
    """Add a model column: ``load`` runs once per task and returns a function over batches of the inputs.

    Embedding, text generation, translation and classification all have this shape;
    the caller brings the model.
    """

    @F.pandas_udf(kind)
    def run(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        model = load()
        for series in batches:
            yield pd.Series(list(model(*series)), index=series[0].index)

    @F.pandas_udf(kind)
    def run_one(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load()
        for series in batches:
            yield pd.Series(list(model(series)), index=series.index)

    return df.withColumn(name, (run_one if len(inputs) == 1 else run)(*inputs))


def build_prompt(template: Sequence[str | Column]) -> Column:
    """Texts and columns joined to one prompt; null when a column is null."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in template])


def join_context(hits: DataFrame, group: Sequence[str], rank: str, text: str, separator: str = "\n\n") -> DataFrame:
    """Retrieved texts of each query in rank order as one text; a query has at most k hits."""
    ordered = F.sort_array(F.collect_list(F.struct(rank, text)))
    return hits.groupBy(*group).agg(F.array_join(F.transform(ordered, lambda h: h[text]), separator).alias("context"))


CIRCULAR_FIELDS = {
    "schema_url": ("$schema", "string"), "event_id": ("eventId", "string"), "submitter": ("submitter", "string"),
    "submitted_how": ("submittedHow", "string"), "subject": ("subject", "string"), "circular_id": ("circularId", "int"),
    "format": ("format", "string"), "body": ("body", "string"), "created_on_epoch": ("createdOn", "bigint"),
}


def parse_circulars(df: DataFrame, message: str, keep: Sequence[str]) -> DataFrame:
    """JSON circulars to typed columns; the JSON is parsed once, bad JSON gives nulls."""
    parsed = df.select(*keep, F.try_parse_json(message).alias("_m"))
    cells = [F.try_variant_get("_m", f"$['{f}']", t).alias(n) for n, (f, t) in CIRCULAR_FIELDS.items()]
    return parsed.select(*keep, *cells).withColumn("created_on", F.timestamp_millis("created_on_epoch"))


def circular_documents(circulars: DataFrame, base_url: str) -> DataFrame:
    """One text per circular with file-like metadata; a missing part makes the text null and drops the row."""
    text = F.concat("event_id", F.lit(" "), "subject", F.lit(" "), "body", F.lit(" "), "submitter")
    meta = F.struct(
        F.concat(F.lit(base_url), F.col("circular_id").cast("string")).alias("file_path"),
        F.concat(F.col("circular_id").cast("string"), F.lit(".txt")).alias("file_name"),
        F.length(text).cast("bigint").alias("file_size"),
        F.col("created_on").alias("file_modification_time"),
    )
    return circulars.select(text.alias("content"), meta.alias("metadata")).filter("length(trim(content)) > 0")
