"""Structure repair of conversations: the cheapest edits that give the roles ``(s?(ua)+)?``, by lightest derivation.

Weighted deduction over the rows of a conversation in order of their turns (nulls first; rows of one turn by role, then by the
md5 of the text).  An item ``[i, q]`` says that the rows from ``i`` on can be repaired if the roles before them left the grammar
in state ``q``; its weight is (cost, rows covered, audit).  Every edit is a hyperedge whose weight function adds its cost and
puts its initial before the audit:

    Keep    [i+1, r] -> [i, q]    0, and 3 more for a truncated row; only if the row's role leads from q to r
    Rerole  [i+1, r] -> [i, q]    3, and 3 more for a truncated row; to the role that q asks for
    Delete  [i+1, q] -> [i, q]    4; the only edit of a blank or repeated row
    Insert  [i, r]   -> [i, q]    3; an empty row of the role that q asks for

Putting a letter in front keeps the order of two audits, so the functions are monotone; a Keep adds no cost but covers one
row more, so every conclusion weighs more than its premise and the functions are superior.  Hence an agenda that pops the
lightest item first gives each item its final weight when it is popped, and stops when the goal is.  Items of one place and
state cover the same rows, so the order among them is that of (cost, audit), ties by the ASCII-least audit.

Rows are ranged over tasks by conversation and turn, and only a few bytes of each: texts stay away from this part.  A
conversation is cut into blocks of ``BLOCK`` rows (and where a task ends); a block that may not be the whole conversation gives its
lightest derivation for every pair of states, and these are hyperedges of the same kind in a second deduction over blocks,
in a tree with ``FAN`` blocks at a node.  So no task holds a long conversation, though its audit, one letter per row, is one value.  Texts are then
read once, in order, beside the audit; a digest of a repaired conversation is one chain over its rows, in one task, one row at a time.

Defined results: a null role or text is one space, so such a text is blank; empty texts are blank; texts are looked at whole;
of repeated rows (same role and text) all but the first are repeated rows; rows without a conversation id are a conversation of their
own; an empty table gives an empty result; further columns are not read, so their names cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from heapq import heappop, heappush

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import durable

#: Fixed values of the repair: white space, ends of sentences, costs.
BLANK = r"[^\x20\x09-\x0D]"
ENDED = r"[.!?][\x20\x09-\x0D]*\z"
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3

#: States: nothing yet, after system, after user, after assistant; what each asks for, and where a role leads.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
WANTED = {START: ("user", AFTER_U), AFTER_S: ("user", AFTER_U), AFTER_U: ("assistant", AFTER_A), AFTER_A: ("user", AFTER_U)}
LEADS = {(START, "s"): AFTER_S, (START, "u"): AFTER_U, (AFTER_S, "u"): AFTER_U, (AFTER_U, "a"): AFTER_A, (AFTER_A, "u"): AFTER_U}
ACCEPTED = (START, AFTER_A)
LEGAL = {"su", "ua", "au"}

#: A row is one symbol: initial of its role (o: any other) and fault (none, truncated, blank, duplicate).
ROLES, FAULTS = "suao", "-tbd"
SYMBOLS = {chr(65 + 4 * i + j): (role, fault) for i, role in enumerate(ROLES) for j, fault in enumerate(FAULTS)}

BLOCK = 512
FAN = 64

#: A hyperedge at a place: state before, state after, cost, rows covered, edits.
Edge = tuple[int, int, int, int, str]


def _row_edges(symbol: str) -> list[Edge]:
    role, fault = SYMBOLS[symbol]
    edges = [(q, q, DELETE, 1, "D") for q in WANTED]
    if fault in "-t":
        more = TRUNCATED if fault == "t" else 0
        edges += [(q, r, more, 1, "K") for (q, initial), r in LEADS.items() if initial == role]
        edges += [(q, r, REROLE + more, 1, "R") for q, (_, r) in WANTED.items()]
    return edges


EDGES = {symbol: _row_edges(symbol) for symbol in SYMBOLS}
INSERTS: list[Edge] = [(q, r, INSERT, 0, "I") for q, (_, r) in WANTED.items()]


def _by_conclusion(edges: Iterable[Edge]) -> dict[int, list[Edge]]:
    """The edges that lead from a premise in a state, by that state."""
    out: dict[int, list[Edge]] = {}
    for edge in edges:
        out.setdefault(edge[1], []).append(edge)
    return out


STEPS = {symbol: _by_conclusion(edges) for symbol, edges in EDGES.items()}
INSERTIONS = _by_conclusion(INSERTS)


def lightest(steps: list[dict[int, list[Edge]]], last: Iterable[int], goals: Iterable[int], inserts: dict[int, list[Edge]]) -> dict[int, tuple[int, str]]:
    """(cost, audit) of the items ``[0, goal]``, from the axioms ``[n, state]`` for the states in ``last``."""
    n = len(steps)
    agenda = [(0, 0, "", n, q) for q in last]
    final: set[tuple[int, int]] = set()
    wanted, found = set(goals), {}
    while agenda and wanted:
        cost, covered, audit, i, q = heappop(agenda)
        if (i, q) in final:
            continue
        final.add((i, q))
        if i == 0 and q in wanted:
            wanted.discard(q)
            found[q] = cost, audit
        for before, _, more, rows, edits in inserts.get(q, ()):
            if (i, before) not in final:
                heappush(agenda, (cost + more, covered + rows, edits + audit, i, before))
        if i:
            for before, _, more, rows, edits in steps[i - 1].get(q, ()):
                if (i - 1, before) not in final:
                    heappush(agenda, (cost + more, covered + rows, edits + audit, i - 1, before))
    return found


@lru_cache(maxsize=20_000)
def _whole(symbols: str) -> tuple[int, str]:
    return lightest([STEPS[s] for s in symbols], ACCEPTED, [START], INSERTIONS)[START]


def whole(symbols: str) -> tuple[int, str]:
    """Cost and audit of a conversation; those of short ones are remembered."""
    return _whole(symbols) if len(symbols) <= 16 else _whole.__wrapped__(symbols)


def table_of(steps: list[dict[int, list[Edge]]], inserts: dict[int, list[Edge]], rows: int) -> list[dict]:
    """The lightest derivation of a block for every pair of states."""
    return [
        {"before": q, "after": r, "cost": cost, "rows": rows, "audit": audit}
        for r in WANTED for q, (cost, audit) in lightest(steps, [r], list(WANTED), inserts).items()
    ]


def edges_of(table: list[dict]) -> dict[int, list[Edge]]:
    return _by_conclusion((e["before"], e["after"], e["cost"], e["rows"], e["audit"]) for e in table)


TABLE = T.ArrayType(T.StructType([
    T.StructField("before", T.IntegerType()), T.StructField("after", T.IntegerType()), T.StructField("cost", T.LongType()),
    T.StructField("rows", T.LongType()), T.StructField("audit", T.StringType()),
]))
ARROW_TABLE = pa.list_(pa.struct([("before", pa.int32()), ("after", pa.int32()), ("cost", pa.int64()), ("rows", pa.int64()), ("audit", pa.string())]))
#: What is known of a block besides its derivations.
FIGURES = ["rows", "blank", "duplicate", "truncated", "illegal", "turns", "first_turn", "last_turn"]
PLACES = ["part", "seq"]


class _Blocks:
    """The blocks of one task, whose rows come in order."""

    def __init__(self, part: int):
        self.part, self.out, self.seq, self.symbols, self.conv, self.begun = part, [], 0, [], None, False
        self.first_of_task = True

    def start(self, conv) -> None:
        self.conv, self.begun, self.seq = conv, True, 0
        self.fresh()

    def fresh(self) -> None:
        self.symbols, self.turns, self.first_turn, self.last_turn = [], 0, None, None

    def row(self, conv, turn, symbol: str, again: str, copies: int) -> None:
        if not self.begun or conv != self.conv:
            if self.begun:
                self.close(ended=True)
                self.first_of_task = False
            self.start(conv)
        for k in range(copies):
            if len(self.symbols) >= BLOCK:
                self.close(ended=False)
            if turn is not None and turn != self.last_turn:
                self.turns, self.last_turn = self.turns + 1, turn
                self.first_turn = turn if self.first_turn is None else self.first_turn
            self.symbols.append(again if k else symbol)

    def close(self, ended: bool) -> None:
        """``ended``: the next row of the task belongs to another conversation."""
        symbols = "".join(self.symbols)
        known = [SYMBOLS[s] for s in symbols]
        faults = [f for _, f in known]
        illegal = sum(a + b not in LEGAL for (a, _), (b, _) in zip(known, known[1:]))
        complete = ended and self.seq == 0 and not self.first_of_task
        cost, audit = whole(symbols) if complete else (None, None)
        steps = [STEPS[s] for s in symbols]
        self.out.append({
            "conv": self.conv, "part": self.part, "seq": self.seq, "rows": len(symbols),
            "blank": faults.count("b"), "duplicate": faults.count("d"), "truncated": faults.count("t"), "illegal": illegal,
            "turns": self.turns, "first_turn": self.first_turn, "last_turn": self.last_turn,
            "first_role": known[0][0], "last_role": known[-1][0], "cost": cost, "audit": audit,
            "derived": None if complete else table_of(steps, INSERTIONS, len(steps)),
        })
        self.seq += 1
        self.fresh()


def _columns(conv: T.DataType) -> T.StructType:
    longs = [T.StructField(name, T.LongType()) for name in (*PLACES, *FIGURES)]
    texts = [T.StructField(name, T.StringType()) for name in ("first_role", "last_role")]
    return T.StructType([
        T.StructField("conv", conv), *longs, *texts, T.StructField("cost", T.LongType()), T.StructField("audit", T.StringType()),
        T.StructField("derived", TABLE),
    ])


def _arrow_schema(conv: pa.DataType) -> pa.Schema:
    longs = [(name, pa.int64()) for name in (*PLACES, *FIGURES)]
    return pa.schema([
        ("conv", conv), *longs, ("first_role", pa.string()), ("last_role", pa.string()), ("cost", pa.int64()), ("audit", pa.string()),
        ("derived", ARROW_TABLE),
    ])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    state = _Blocks(TaskContext.get().partitionId())
    schema = None
    for batch in batches:
        schema = _arrow_schema(batch.schema.field(0).type)
        for row in zip(*(column.to_pylist() for column in batch.columns)):
            state.row(*row)
        yield pa.RecordBatch.from_pylist(state.out, schema=schema)
        state.out = []
    if state.begun:
        state.close(ended=False)
        yield pa.RecordBatch.from_pylist(state.out, schema=schema)


def joined(blocks: list[dict]) -> dict:
    """One block out of consecutive ones: figures added up, derivations by a deduction over the blocks."""
    first = blocks[0]
    if len(blocks) == 1:
        return first
    out = {**first, **{name: sum(b[name] for b in blocks) for name in ("rows", "blank", "duplicate", "truncated", "illegal", "turns")}}
    for a, b in zip(blocks, blocks[1:]):
        out["illegal"] += a["last_role"] + b["first_role"] not in LEGAL
    turn = None
    for b in blocks:
        out["turns"] -= turn is not None and turn == b["first_turn"]
        turn = turn if b["last_turn"] is None else b["last_turn"]
    out["first_turn"] = next((b["first_turn"] for b in blocks if b["first_turn"] is not None), None)
    out["last_turn"], out["last_role"] = turn, blocks[-1]["last_role"]
    out["derived"] = table_of([edges_of(b["derived"]) for b in blocks], {}, out["rows"])
    return out


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        schema, rows = _arrow_schema(batch.schema.field(0).type), []
        for conv, blocks, part, seq in zip(*(column.to_pylist() for column in batch.columns)):
            blocks.sort(key=lambda b: (b["part"], b["seq"]))
            rows.append({"conv": conv, **joined(blocks), "part": part, "seq": seq})
        yield pa.RecordBatch.from_pylist(rows, schema=schema)


def _grouped(blocks: DataFrame, part: Column, seq: Column) -> DataFrame:
    """At most ``FAN`` consecutive blocks of a conversation joined into one, which stands at the given place."""
    held = [c for c in blocks.columns if c != "conv"]
    gathered = blocks.groupBy("conv", part.alias("_part"), seq.alias("_seq")).agg(F.collect_list(F.struct(*held)).alias("blocks"))
    return gathered.select("conv", "blocks", "_part", "_seq").mapInArrow(_merge, blocks.schema)


def _tree(blocks: DataFrame) -> DataFrame:
    """One block per conversation: blocks are joined first within the tasks, then over them."""
    # Two numbers come to the driver: the longest run of blocks in a task, and the last task.
    longest = blocks.agg(F.max("seq"), F.max("part")).first()
    seqs, parts = (longest[0] or 0) + 1, (longest[1] or 0) + 1
    zero = F.lit(0).cast("long")
    while seqs > 1:
        blocks = _grouped(blocks, F.col("part"), F.floor(F.col("seq") / FAN).cast("long"))
        seqs = -(-seqs // FAN)
    while parts > 1:
        blocks = _grouped(blocks, F.floor(F.col("part") / FAN).cast("long"), zero)
        parts = -(-parts // FAN)
    return blocks


def _named(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    filled = [F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(name) for c, name in ((role, "role"), (text, "text"))]
    return rows.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), *filled).withColumn("digest", F.unhex(F.md5("text")))


def _symbols(rows: DataFrame) -> DataFrame:
    """One row per (conv, turn, role, digest): the symbol of the first such row, that of further ones, and how many there are."""
    key = ["conv", "turn", "role", "digest"]
    blank, ended = ~F.col("text").rlike(BLANK), F.col("text").rlike(ENDED)
    fault = F.when(blank, 2).when(ended, 0).otherwise(1)
    distinct = durable(rows.groupBy(*key).agg(F.max(fault).alias("fault"), F.count(F.lit(1)).alias("copies")))
    # Null turns stand first, also in the smallest struct of a turn.
    same = ["conv", "role", "digest"]
    again = distinct.groupBy(*same).agg(F.min(F.struct("turn"))["turn"].alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    match = F.lit(True)
    for c in same:
        match = match & F.col(f"r.{c}").eqNullSafe(F.col(f"a.{c}"))
    seen = F.col("a.n").isNotNull() & ~F.col("r.turn").eqNullSafe(F.col("a.first"))
    known = distinct.alias("r").join(again.alias("a"), match, "left").select("r.*", seen.alias("seen"))
    initial = F.instr(F.lit(ROLES[:3]), F.substring("role", 1, 1))
    place = F.when((initial == 0) | (F.col("role") == ""), len(ROLES) - 1).otherwise(initial - 1)
    symbol = lambda fault: F.char(F.lit(65) + 4 * place + fault)
    # A blank row is blank however often it stands.
    repeated = F.when(F.col("fault") == 2, 2).otherwise(3)
    first = F.when(F.col("seen"), repeated).otherwise(F.col("fault"))
    return known.select(*key, symbol(first).alias("symbol"), symbol(repeated).alias("again"), "copies")


def audited(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: conv, gaps, blank, duplicate, truncated, illegal, cost, audit."""
    symbols = _symbols(_named(rows, conv, turn, role, text))
    key = ["conv", "turn", "role", "digest"]
    ranged = symbols.repartitionByRange(*key).sortWithinPartitions(*key).select("conv", "turn", "symbol", "again", "copies")
    blocks = durable(ranged.mapInArrow(_blocks, _columns(symbols.schema["conv"].dataType)))
    derived = F.filter("derived", lambda e: (e["before"] == START) & e["after"].isin(*ACCEPTED))
    best = F.array_min(F.transform(derived, lambda e: F.struct(e["cost"].alias("cost"), e["audit"].alias("audit"))))
    solved = _tree(blocks).withColumn("_best", best)
    gaps = F.coalesce(F.col("last_turn") - F.col("first_turn") + 1 - F.col("turns"), F.lit(0).cast("long"))
    return solved.select(
        "conv", gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal",
        F.coalesce("cost", F.col("_best.cost")).alias("cost"), F.coalesce("audit", F.col("_best.audit")).alias("audit"),
    )


REPORT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _beside(rows: DataFrame, audits: DataFrame, ids: DataFrame | None) -> DataFrame:
    """Audits, then the rows of every conversation in order, each conversation in one task; ``ids`` adds conversations without rows."""
    longs = [F.lit(None).cast("long").alias(c) for c in REPORT]
    blank = [F.lit(None).cast("long").alias("turn"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"), F.lit(None).cast("binary").alias("digest")]
    columns = ["conv", "kind", "turn", "role", "digest", "text", *REPORT, "audit"]
    parts = [
        audits.select("*", F.lit(1).alias("kind"), *blank).select(*columns),
        rows.select("*", F.lit(2).alias("kind"), *longs, F.lit(None).cast("string").alias("audit")).select(*columns),
    ]
    if ids is not None:
        parts.append(ids.distinct().select("conv", F.lit(0).alias("kind"), *blank, *longs, F.lit(None).cast("string").alias("audit")).select(*columns))
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out.repartition("conv").sortWithinPartitions("conv", "kind", "turn", "role", "digest").drop("digest")


class _Edits:
    """The repaired rows of one conversation, made row by row from its audit."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, START

    def inserted(self) -> Iterator[tuple[str, str, str, None]]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            role, self.state = WANTED[self.state]
            self.at += 1
            yield "I", role, "", None

    def row(self, turn, role: str, text: str) -> Iterator[tuple]:
        """(edit, role, text, turn) of the rows inserted before this one, and of this one unless it is deleted."""
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "R":
            role, self.state = WANTED[self.state]
        elif edit == "K":
            self.state = LEADS[self.state, role[:1]]
        if edit != "D":
            yield edit, role, text, turn


def _walk(batches: Iterator[pa.RecordBatch], begin, repaired, end):
    """Calls ``begin`` with the report of a conversation, ``repaired`` with each repaired row, ``end`` after its last one."""
    edits, current, begun = None, None, False
    for batch in batches:
        for conv, kind, turn, role, text, *report in zip(*(column.to_pylist() for column in batch.columns)):
            if not begun or conv != current:
                if begun:
                    for row in edits.inserted():
                        repaired(row)
                    end()
                current, begun, edits = conv, True, _Edits("")
                begin(conv)
            if kind == 1:
                edits = _Edits(report[-1])
                begin(conv, report)
            elif kind == 2:
                for row in edits.row(turn, role, text):
                    repaired(row)
        yield
    if begun:
        for row in edits.inserted():
            repaired(row)
        end()
        yield


def digests(rows: DataFrame, ids: DataFrame | None = None, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The report of every conversation and the sha256 of its repaired rows, ``role:text`` joined by newlines.

    ``ids`` may name conversations that have no rows left: zeros, an empty audit, the hash of nothing.
    """
    named = _named(rows, conv, turn, role, text)
    kind = named.schema["conv"].dataType
    known = None if ids is None else ids.select(F.col(conv).alias("conv"))

    def hashed(batches):
        out, now = [], {}

        def begin(conv, report=None):
            now.update(conv=conv, sha=hashlib.sha256(), empty=True, report=report or [0] * len(REPORT) + [""])

        def repaired(row):
            if not now["empty"]:
                now["sha"].update(b"\n")
            now["sha"].update(f"{row[1]}:{row[2]}".encode())
            now["empty"] = False

        def end():
            out.append({conv: now["conv"], **dict(zip([*REPORT, "audit"], now["report"])), "repaired_sha256": now["sha"].hexdigest()})

        for _ in _walk(batches, begin, repaired, end):
            yield pa.RecordBatch.from_pylist(out, schema=schema)
            out.clear()

    from pyspark.sql.pandas.types import to_arrow_type

    longs = [(name, pa.int64()) for name in REPORT]
    schema = pa.schema([(conv, to_arrow_type(kind)), *longs, ("audit", pa.string()), ("repaired_sha256", pa.string())])
    columns = f"`{conv}` {kind.simpleString()}, " + ", ".join(f"{name} long" for name in REPORT) + ", audit string, repaired_sha256 string"
    return _beside(named, audited(rows, conv, turn, role, text), known).mapInArrow(hashed, columns)


def repaired(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The rows of the repaired conversations: conversation, place from 0, role, text, edit (K, R or I), and the turn a row came from."""
    named = _named(rows, conv, turn, role, text)
    kind = named.schema["conv"].dataType

    def mended(batches):
        out, now = [], {}

        def begin(conv, report=None):
            now.update(conv=conv, place=0)

        def row(made):
            out.append({conv: now["conv"], "place": now["place"], "role": made[1], "text": made[2], "edit": made[0], "from_turn": made[3]})
            now["place"] += 1

        for _ in _walk(batches, begin, row, lambda: None):
            yield pa.RecordBatch.from_pylist(out, schema=schema)
            out.clear()

    from pyspark.sql.pandas.types import to_arrow_type

    schema = pa.schema([(conv, to_arrow_type(kind)), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("edit", pa.string()), ("from_turn", pa.int64())])
    return _beside(named, audited(rows, conv, turn, role, text), None).mapInArrow(mended, f"`{conv}` {kind.simpleString()}, place long, role string, text string, edit string, from_turn long")


def damaged(conversations: DataFrame) -> DataFrame:
    """``conversations`` (conv_id, turn, role, text) with damage by crc32(``conv_id:turn``) modulo 20, nulls as one space.

    0 drops a row, 1 empties its text, 2 removes its ends of sentences, 3 repeats it, 4 makes it a user's; the others stay.
    """
    filled = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(filled("conv_id"), F.lit(":"), filled("turn"))) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(filled("text"), "[.!?]", "")).otherwise(filled("text"))
    role = F.when(kind == 4, "user").otherwise(filled("role"))
    copies = F.array_repeat(F.lit(0), F.when(kind == 3, 2).otherwise(1))
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("kind"), F.explode(copies).alias("copy"))
    return rows.filter("kind <> 0").select("conv_id", "turn", "role", "text")
