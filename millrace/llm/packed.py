"""Token ids in files of fixed-width bit packing.

A segment is one file image: a header, the ids and id offsets of its documents, the byte offset of every block, and the blocks.
A block holds ``BLOCK`` ids, each in the bits that the largest id of the vocabulary needs, lowest bit first; a block begins on
a byte, so any range of ids is read by unpacking the blocks it touches, with array operations.

A dataset is a Parquet folder with one segment per row (written and read by Spark, so it lies in any store Spark reaches):
texts are range-partitioned and sorted by document id, each task cuts its texts into words by array operations, encodes words that
it has not seen before with the tokenizers library, and appends segments of about ``SEGMENT`` ids; a document is never split.  Segments know their place within their partition, so the place
of every id in the whole corpus follows from one total per partition.

Defined results: a null or empty text is only the end id; a very long text is encoded whole and is never split over segments; rows with one
id, repeated ones too, stand next to each other, ordered by text; rows without an id stand first; an empty table gives a dataset without segments;
further columns are not read, so their names cannot clash.
"""

from __future__ import annotations

import json
import os
import zlib
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.pretokens import Ids, Known, Pretokens, flat_ids, portions, special_pattern, with_whole_texts

MAGIC = 0x4B43415053444954
BLOCK = 4096
SEGMENT = 1 << 18
HEADER = 6  # magic, bits, ids, documents, block size, blocks
NULL_ID = np.iinfo(np.int64).min


def bits_for(vocabulary_size: int) -> int:
    """The fewest bits that hold every id below ``vocabulary_size``."""
    return max(1, int(vocabulary_size - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    ids = np.ascontiguousarray(ids, "<u4")
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    spread = np.unpackbits(ids.view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :bits]
    return np.packbits(spread.reshape(-1), bitorder="little").tobytes()


def unpack(data: np.ndarray, bits: int, n: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return data[: n * bits // 8].view(f"<u{bits // 8}").astype(np.uint32)
    spread = np.zeros((n, 32), np.uint8)
    spread[:, :bits] = np.unpackbits(data, count=n * bits, bitorder="little").reshape(n, bits)
    return np.packbits(spread, axis=1, bitorder="little").view("<u4").reshape(-1)


def write_segment(doc_ids: np.ndarray, counts: np.ndarray, ids: np.ndarray, bits: int, block: int = BLOCK) -> bytes:
    blocks = [pack(ids[i : i + block], bits) for i in range(0, len(ids), block)]
    offsets = np.cumsum([0, *counts])
    places = np.cumsum([0, *map(len, blocks)])
    header = np.array([MAGIC, bits, len(ids), len(doc_ids), block, len(blocks)])
    return b"".join(x.astype("<i8").tobytes() for x in (header, doc_ids, offsets, places)) + b"".join(blocks)


class Segment:
    """Random access to the ids of one segment."""

    def __init__(self, data: bytes):
        words = np.frombuffer(data, "<i8", HEADER)
        if words[0] != MAGIC:
            raise ValueError("these bytes are no segment")
        _, self.bits, self.n, docs, self.block, blocks = (int(x) for x in words)
        at = 8 * HEADER
        self.doc_ids = np.frombuffer(data, "<i8", docs, at)
        self.offsets = np.frombuffer(data, "<i8", docs + 1, at + 8 * docs)
        self.places = np.frombuffer(data, "<i8", blocks + 1, at + 8 * (2 * docs + 1))
        self.payload = np.frombuffer(data, np.uint8, offset=at + 8 * (2 * docs + 2 + blocks))

    def ids(self, start: int, end: int) -> np.ndarray:
        """The ids from ``start`` to before ``end``; only the blocks that hold them are unpacked."""
        if end <= start:
            return np.zeros(0, np.uint32)
        first, last = start // self.block, (end - 1) // self.block
        parts = [
            unpack(self.payload[self.places[b] : self.places[b + 1]], self.bits, min(self.block, self.n - b * self.block))
            for b in range(first, last + 1)
        ]
        return np.concatenate(parts)[start - first * self.block : end - first * self.block]


#: Words that a process remembers, at about 40 bytes a word.
REMEMBERED = 1_500_000


class Encoder:
    """The tokenizers library, which sees each word once; texts with a special token go to it whole."""

    def __init__(self, text: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(text)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = special_pattern(json.loads(text)["added_tokens"])
        self.known = Known(REMEMBERED)

    def library(self, texts: list[str]) -> Ids:
        return flat_ids([c.ids for c in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, and the place of the first one of each (one more entry than texts)."""
        whole = [i for i, t in enumerate(texts) if self.special.search(t)]
        if whole:
            flat, sizes = self.library([texts[i] for i in whole])
            apart = dict(zip(whole, np.split(flat, np.cumsum(sizes)[:-1])))
            texts = ["" if i in apart else t for i, t in enumerate(texts)]
        ids, offsets = Pretokens(texts, lower=False).ids(self.known, self.library, self.library)
        return with_whole_texts(ids, offsets, apart) if whole else (ids, offsets)


@lru_cache(maxsize=1)
def _encoder(text: str) -> Encoder:
    return Encoder(text)


def vocabulary_size(text: str, *more: int) -> int:
    data = json.loads(text)
    return 1 + max([*data["model"]["vocab"].values(), *(t["id"] for t in data["added_tokens"]), *more])


def write_packed(docs: DataFrame, tokenizer_path: str, path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2) -> None:
    """Writes the ids of all whole texts, each followed by ``end_id``, as a dataset in ascending order of the ids of the rows."""
    text = Path(tokenizer_path).read_text()
    bits = bits_for(vocabulary_size(text, end_id))
    shipped = docs.sparkSession.sparkContext.broadcast(text)  # a vocabulary file: its size does not depend on the data

    def packed(batches):
        encoder, part = _encoder(shipped.value), TaskContext.get().partitionId()
        seq = begun = size = 0
        doc_ids, counts, ids = [], [], []

        def segment():
            nonlocal seq, begun, size
            data = write_segment(np.concatenate(doc_ids), np.concatenate(counts), np.concatenate(ids), bits)
            row = pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([begun], pa.int64()), pa.array([size], pa.int64()), pa.array([data], pa.binary())],
                names=["part", "seq", "start", "n_ids", "data"],
            )
            seq, begun, size = seq + 1, begun + size, 0
            doc_ids.clear(), counts.clear(), ids.clear()
            return row

        for batch in batches:
            keys = pc.fill_null(batch.column(0), NULL_ID).to_numpy(zero_copy_only=False)
            texts = pc.fill_null(batch.column(1), "").to_pylist()
            for row, end in portions(texts):
                coded, offsets = encoder.encode(texts[row:end])
                # The end id goes after each document.
                coded = np.insert(coded, offsets[1:], end_id)
                offsets = offsets + np.arange(len(offsets))
                at = 0
                while at < end - row:
                    # As many documents as make the segment long enough, at least one.
                    to = min(end - row, int(np.searchsorted(offsets, offsets[at] + SEGMENT - size, "left")))
                    to = max(to, at + 1)
                    doc_ids.append(keys[row + at : row + to]), counts.append(np.diff(offsets[at : to + 1])), ids.append(coded[offsets[at] : offsets[to]])
                    size += int(offsets[to] - offsets[at])
                    at = to
                    if size >= SEGMENT:
                        yield segment()
        if size:
            yield segment()

    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    ordered = rows.repartitionByRange("_id").sortWithinPartitions("_id", "_text")
    ordered.mapInArrow(packed, "part int, seq int, start long, n_ids long, data binary").write.parquet(path)


def _partition_starts(segments: DataFrame) -> dict[int, int]:
    """The place of the first id of every partition; one row per written partition comes to the driver."""
    totals = sorted((r.part, r.n) for r in segments.groupBy("part").agg(F.sum("n_ids").alias("n")).collect())
    starts = np.cumsum([0, *(n for _, n in totals)]).tolist()
    return {part: start for (part, _), start in zip(totals, starts)}


def read_packed(spark: SparkSession, path: str, id_col: str = "doc_id", with_ids: bool = True) -> DataFrame:
    """One row per document from the files: id, start, n_tokens, ids_crc32 and, if wanted, the ids themselves."""
    segments = spark.read.parquet(path)
    starts = _partition_starts(segments)

    def documents(batches):
        for batch in batches:
            for part, start, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                segment = Segment(data.as_buffer())
                ids, at = segment.ids(0, segment.n), segment.offsets
                raw = memoryview(ids.astype("<u4").tobytes())
                crcs = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(at[:-1], at[1:])]
                columns = [
                    pa.array(segment.doc_ids, mask=segment.doc_ids == NULL_ID), pa.array(starts[part] + start + at[:-1]),
                    pa.array(np.diff(at)), pa.array(crcs, pa.int64()),
                ]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    names = [id_col, "start", "n_tokens", "ids_crc32", *["ids"] * with_ids]
    schema = f"`{id_col}` long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids
    return segments.select("part", "start", "data").mapInArrow(documents, schema)


def read_range(spark: SparkSession, path: str, start: int, end: int) -> np.ndarray:
    """The ids at places ``start`` to before ``end`` of the whole corpus; reads the segments that hold them, and of those only their blocks."""
    segments = spark.read.parquet(path)
    starts = _partition_starts(segments)
    wanted = F.lit(False)
    for part, place in starts.items():
        wanted = wanted | ((F.col("part") == part) & (F.col("start") < end - place) & (F.col("start") + F.col("n_ids") > start - place))
    out = []
    for row in sorted(segments.filter(wanted).collect(), key=lambda r: (r.part, r.seq)):
        begun = starts[row.part] + row.start
        out.append(Segment(bytes(row.data)).ids(max(0, start - begun), min(row.n_ids, end - begun)))
    return np.concatenate(out) if out else np.zeros(0, np.uint32)
