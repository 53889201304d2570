"""Recorded aircraft state responses: parsing, and a data source over the files.

A response is one JSON object ``{"time": epoch, "states": [[...], ...]}`` whose
states are positional arrays.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from millrace.functions.values import safe_bool, safe_double, safe_epoch, safe_int

RESPONSE_SCHEMA = "time bigint, states array<array<string>>"

# Fields a usable state must have, and the position of each field.
MIN_FIELDS = 17
POSITIONS = {
    "icao24": 0, "callsign": 1, "origin_country": 2, "time_position": 3, "last_contact": 4, "longitude": 5,
    "latitude": 6, "baro_altitude": 7, "on_ground": 8, "velocity": 9, "true_track": 10, "vertical_rate": 11,
    "sensors": 12, "geo_altitude": 13, "squawk": 14, "spi": 15, "category": 17,
}
TIMES = ("time_position", "last_contact")
DOUBLES = ("longitude", "latitude", "baro_altitude", "velocity", "true_track", "vertical_rate", "geo_altitude")
FLAGS = ("on_ground", "spi")

COLUMNS = [
    "time_ingest", "icao24", "callsign", "origin_country", "time_position", "last_contact", "longitude", "latitude",
    "geo_altitude", "on_ground", "velocity", "true_track", "vertical_rate", "sensors", "baro_altitude", "squawk",
    "spi", "category",
]


def _field(state: Column, name: str) -> Column:
    raw = F.get(state, F.lit(POSITIONS[name]))
    if name in TIMES:
        return safe_epoch(raw)
    if name in DOUBLES:
        return safe_double(raw)
    if name in FLAGS:
        return safe_bool(raw)
    if name == "category":
        return safe_int(raw)
    if name == "sensors":
        return F.from_json(raw, "array<int>")
    return raw


def parse_responses(df: DataFrame, column: str) -> DataFrame:
    """JSON responses to 18 typed columns.

    States with fewer than 17 fields, or without id or position, are dropped;
    values of the wrong type become null.
    """
    parsed = df.select(F.from_json(column, RESPONSE_SCHEMA).alias("r"))
    rows = parsed.select(F.col("r.time").alias("_time"), F.explode("r.states").alias("_s"))
    state = F.col("_s")
    usable = rows.filter(
        (F.size(state) >= MIN_FIELDS)
        & state[POSITIONS["icao24"]].isNotNull()
        & state[POSITIONS["longitude"]].isNotNull()
        & state[POSITIONS["latitude"]].isNotNull()
    )
    cells = [F.timestamp_seconds("_time").alias("time_ingest") if c == "time_ingest" else _field(state, c).alias(c) for c in COLUMNS]
    return usable.select(*cells)


def read_responses(spark, path: str) -> DataFrame:
    """One response per file or per line, read as text and parsed by column expressions."""
    return parse_responses(spark.read.text(path), "value")


# While this file exists the recorder is busy and the stream waits.
BUSY_MARK = "_busy"


class TransientFault(Exception):
    """A read that may succeed later: the stream waits instead of failing."""


class _File(InputPartition):
    def __init__(self, path: str):
        self.path = path


def _listing(folder: str) -> list[str]:
    """Files of the folder in name order; a missing folder is a configuration fault."""
    if not os.path.isdir(folder):
        raise FileNotFoundError(f"no folder {folder!r}")
    if os.path.exists(os.path.join(folder, BUSY_MARK)):
        raise TransientFault(f"{folder!r} is being written")
    found = (entry for entry in os.scandir(folder) if entry.is_file() and entry.name[0] not in "._")
    return sorted((entry.path for entry in found), key=os.path.basename)


def _responses(partition: _File | None) -> Iterator[tuple[str]]:
    if partition is None:  # an empty folder has one empty task
        return
    with open(partition.path, encoding="utf-8") as handle:
        for line in handle:
            if line.strip():
                yield (line.strip(),)


class _BatchReader(DataSourceReader):
    def __init__(self, folder: str):
        self.folder = folder

    def partitions(self) -> list[InputPartition]:
        return [_File(p) for p in _listing(self.folder)]

    def read(self, partition: _File) -> Iterator[tuple[str]]:
        return _responses(partition)


class _StreamReader(DataSourceStreamReader):
    """The offset is the name of the last file taken, so a restart goes on after it."""

    def __init__(self, folder: str):
        self.folder = folder
        self.last = None

    def initialOffset(self) -> dict:
        self.last = ""
        return {"after": ""}

    def latestOffset(self) -> dict:
        try:
            names = [os.path.basename(p) for p in _listing(self.folder)]
        except TransientFault:
            # No new data and the same offset, so no batch starts; before the first
            # successful listing there is no offset to repeat.
            if self.last is None:
                raise
            return {"after": self.last}
        self.last = max([self.last or "", *names[-1:]])
        return {"after": self.last}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        names = ((os.path.basename(p), p) for p in _listing(self.folder))
        return [_File(p) for name, p in names if start["after"] < name <= end["after"]]

    def read(self, partition: _File) -> Iterator[tuple[str]]:
        return _responses(partition)

    def commit(self, end: dict) -> None:
        pass


class RecordedResponses(DataSource):
    """``spark.read.format("recorded_responses").load(folder)``: one task per file, one row per response."""

    @classmethod
    def name(cls) -> str:
        return "recorded_responses"

    def schema(self) -> str:
        return "value string"

    def _folder(self) -> str:
        return self.options.get("path", "")

    def reader(self, schema) -> DataSourceReader:
        return _BatchReader(self._folder())

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _StreamReader(self._folder())


def save_response(path: str, epoch: int, states: list) -> None:
    """Record one response as a file."""
    with open(path, "w", encoding="utf-8") as handle:
        json.dump({"time": epoch, "states": states}, handle)
