"""Fill-in-middle transformation: texts cut at two random unit borders, as prefix, suffix and middle.

A unit is a word with the white space before it, or white space at the end.  One ``fullmatch`` of ``(unit)*`` by the regex
library keeps every repetition of the group, so ``match.ends(1)`` gives the number of units and both places to cut without a
loop over them.  The quantifiers are possessive: no place where a repetition could end otherwise is remembered.

The draws come from the sha256 of the seed and the id, so a row is transformed alike wherever and whenever it runs, and rows with
one id are cut at the same draws.  No shuffle: every row is made from itself.  A task works on a batch of rows at a time, on
texts in portions of about a million characters; a longer text is a portion of its own and is matched whole.

Defined results: a null text is empty, an empty text has no units and stays plain; texts that hold one of the marks stay plain; a null id
draws as an empty one; equal rows give equal rows; an empty table gives an empty result; further columns pass through, and
a column whose name clashes with one made here, in whatever case, is an error.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.pretokens import portions

UNITS = regex.compile(r"([\x20\x09-\x0D]*+[^\x20\x09-\x0D]++|[\x20\x09-\x0D]++)*+")
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Of a hundred texts without marks, those that are cut, and of a hundred of these, those with the suffix first.
CUT_OF_100, SPM_OF_100 = 50, 80
MADE = ("n", "form", "prefix_chars", "middle_chars", "output")


def draws(id_col: str, seed: int, n: int = 4) -> list[Column]:
    """The first groups of eight hex digits of the sha256 of ``seed:id``, as numbers."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(n)]


def cuts(text: str, first: int, second: int) -> tuple[int, int, int]:
    """Number of units, and the places where the prefix and the middle end."""
    ends = UNITS.fullmatch(text).ends(1)
    n = len(ends)
    low, high = sorted((first % (n + 1), second % (n + 1)))
    return n, ends[low - 1] if low else 0, ends[high - 1] if high else 0


def arranged(text: str, form: str, a: int, b: int) -> str:
    if form == "plain":
        return text
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if form == "psm":
        return f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"
    return f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"


def transformed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 42) -> DataFrame:
    """``docs`` with n (units), form (plain, psm, spm), prefix_chars, middle_chars (null if plain) and output (the text to train on)."""
    clash = {c.lower() for c in docs.columns} & set(MADE)
    if clash:
        raise ValueError(f"columns {sorted(clash)} are made here; rename those of the table")
    h = draws(id_col, seed)
    text = F.coalesce(F.col(text_col), F.lit(""))
    marked = text.contains(PREFIX) | text.contains(SUFFIX) | text.contains(MIDDLE)
    plain = (text == "") | marked | (h[2] % 100 >= CUT_OF_100)
    form = F.when(plain, "plain").when(h[3] % 100 < SPM_OF_100, "spm").otherwise("psm")
    drawn = docs.select(*docs.columns, form.alias("form"), h[0].alias("_h1"), h[1].alias("_h2"))
    place, width = docs.columns.index(text_col), len(docs.columns)

    def made(batches):
        for batch in batches:
            texts = pc.fill_null(batch.column(place), "").to_pylist()
            forms, firsts, seconds = (batch.column(width + i).to_pylist() for i in range(3))
            for row, end in portions(texts):
                n, before, middle, outputs = [], [], [], []
                for text, form, first, second in zip(texts[row:end], forms[row:end], firsts[row:end], seconds[row:end]):
                    units, a, b = cuts(text, first, second)
                    n.append(units)
                    before.append(None if form == "plain" else a)
                    middle.append(None if form == "plain" else b - a)
                    outputs.append(arranged(text, form, a, b))
                part = batch.slice(row, end - row)
                columns = [*part.columns[:width], pa.array(n, pa.int64()), part.column(width)]
                columns += [pa.array(before, pa.int64()), pa.array(middle, pa.int64()), pa.array(outputs, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:width], *MADE])

    schema = docs.limit(0).select("*", *[F.lit(None).cast(kind).alias(c) for c, kind in zip(MADE, ("long", "string", "long", "long", "string"))]).schema
    return drawn.mapInArrow(made, schema)


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` was made of; marks cannot stand in a text that was cut, so the first of each is the one set here."""
    psm, spm = F.split(output, f"{SUFFIX}|{MIDDLE}", 3), F.split(output, f"{PREFIX}|{MIDDLE}", 3)
    skip = lambda c, mark: F.substr(c, F.lit(len(mark) + 1))
    return (
        F.when(form == "psm", F.concat(skip(psm[0], PREFIX), psm[2], psm[1]))
        .when(form == "spm", F.concat(spm[1], spm[2], skip(spm[0], SUFFIX)))
        .otherwise(output)
    )
