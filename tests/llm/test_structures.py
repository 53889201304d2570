"""Repair of conversations, fill-in-middle and shards against plain versions."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import middle, repair, sharding

CONVERSATIONS = "conv_id long, turn long, role string, text string"


# --- repair ---------------------------------------------------------------------------------------------------------


def plain_audit(symbols):
    """The cheapest edits by trying every state after every row, with up to two rows inserted anywhere."""
    best = {0: (0, "")}

    def with_inserts(at):
        out = dict(at)
        for _ in range(3):
            for q, (cost, audit) in list(out.items()):
                r = 3 if q == 2 else 2
                out[r] = min(out.get(r, (10**9, "")), (cost + 3, audit + "I"))
        return out

    for symbol in symbols:
        role, fault = repair.SYMBOLS[symbol]
        later = {}

        def offer(r, cost, audit):
            later[r] = min(later.get(r, (10**9, "")), (cost, audit))

        for q, (cost, audit) in with_inserts(best).items():
            offer(q, cost + 4, audit + "D")
            if fault in "bd":
                continue
            more = 3 * (fault == "t")
            goes = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}[q]
            if role in goes:
                offer(goes[role], cost + more, audit + "K")
            for r in set(goes.values()) - {1}:
                offer(r, cost + 3 + more, audit + "R")
        best = later
    ended = with_inserts(best)
    return min(ended[q] for q in (0, 3) if q in ended)


def test_agenda_equals_all_edits():
    alphabet = list(repair.SYMBOLS)
    for n in range(3):
        for symbols in itertools.product(alphabet, repeat=n):
            assert repair.whole("".join(symbols)) == plain_audit(symbols), symbols
    rng = random.Random(3)
    for _ in range(600):
        symbols = [rng.choice(alphabet) for _ in range(rng.randint(3, 30))]
        assert repair.whole("".join(symbols)) == plain_audit(symbols)


def test_agenda_keeps_the_order_where_a_letter_alone_would_not():
    """System row first: keeping it or making it a user's cost the same in the end, and the least audit begins with R."""
    for symbols in ("AAA", "AEI", "AAI", "BAE", "AABEI"):
        assert repair.whole(symbols) == plain_audit(symbols)


def test_joined_blocks_equal_the_whole():
    rng, alphabet = random.Random(4), list(repair.SYMBOLS)
    for _ in range(150):
        symbols = [rng.choice(alphabet) for _ in range(rng.randint(2, 24))]
        cuts = sorted({0, len(symbols), *rng.sample(range(len(symbols)), min(3, len(symbols)))})
        blocks = []
        for a, b in zip(cuts, cuts[1:]):
            part = symbols[a:b]
            table = repair.table_of([repair.STEPS[s] for s in part], repair.INSERTIONS, len(part))
            blocks.append({"rows": len(part), "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "turns": 0, "first_turn": None, "last_turn": None,
                           "first_role": "s", "last_role": "u", "derived": table})
        got = repair.joined(blocks)["derived"]
        assert min((e["cost"], e["audit"]) for e in got if e["before"] == 0 and e["after"] in (0, 3)) == plain_audit(symbols)


def plain_report(rows):
    """The report of one conversation's rows, by the contract."""
    white = " \t\n\v\f\r"
    rows = sorted(
        ((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows),
        key=lambda row: (row[0] is not None, row[0] or 0, row[1], hashlib.md5(row[2].encode()).hexdigest()),
    )
    seen, symbols, faults, initials = set(), [], [], []
    for _, role, text in rows:
        core = text.strip(white)
        fault = "b" if not core else "d" if (role, text) in seen else "t" if core[-1] not in ".!?" else "-"
        seen.add((role, text))
        initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
        faults.append(fault), initials.append(initial)
        symbols.append(next(s for s, known in repair.SYMBOLS.items() if known == (initial, fault)))
    cost, audit = plain_audit(symbols)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    lines, state, left = [], 0, iter(rows)
    for letter in audit:
        role, text = ("", "") if letter == "I" else next(left)[1:]
        if letter == "D":
            continue
        if letter != "K":
            role = "assistant" if state == 2 else "user"
        state = {"s": 1, "u": 2, "a": 3}[role[0]]
        lines.append(f"{role}:{text}")
    digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return (gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, digest), lines


def odd_conversations():
    rng = random.Random(7)
    texts = ["Yes.", "No!", "Why?", "open", "", " \t", None, "a. ", "Long " * 5000 + ".", "é.", "tail.\n\n"]
    roles = ["user", "assistant", "system", "tool", None, "", "User"]
    rows = [(c, rng.choice([None, 0, 1, 2, 3, 5, 8]), rng.choice(roles[:3] * 4 + roles), rng.choice(texts)) for c in range(60) for _ in range(rng.randint(1, 12))]
    rows += [(None, 1, "user", "x."), (None, 2, "assistant", "y.")]
    rows += [(99, t, ("user", "assistant")[t % 2], f"row {t}.") for t in range(90)]  # one that holds many rows
    rows += [(98, 4, "user", "again.")] * 70
    rows += [(97, None, None, None)]
    return rows


@pytest.mark.parametrize("block, fan", [(512, 64), (4, 2)])
def test_reports_and_repaired_rows(spark, monkeypatch, block, fan):
    monkeypatch.setattr(repair, "BLOCK", block)
    monkeypatch.setattr(repair, "FAN", fan)
    rows = odd_conversations()
    table = spark.createDataFrame([(*r, 1, "z") for r in rows], CONVERSATIONS + ", Cost int, digest string").repartition(5)
    ids = spark.createDataFrame([(c,) for c in {r[0] for r in rows} | {1234}], "conv_id long")
    got = {r[0]: tuple(r[1:]) for r in repair.digests(table, ids).collect()}
    assert len(got) == 65
    mended = {}
    for r in sorted(repair.repaired(table).collect(), key=lambda r: r.place):
        mended.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    for conv in {r[0] for r in rows}:
        report, lines = plain_report([r[1:] for r in rows if r[0] == conv])
        assert got[conv] == report, conv
        assert mended.get(conv, []) == lines
        assert re.fullmatch("(s?(ua)+)?", "".join(line[0] for line in lines))
    assert got[1234] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert repair.digests(table.limit(0)).count() == 0 and repair.repaired(table.limit(0)).count() == 0


def test_blocks_of_a_task_do_not_depend_on_the_memo():
    assert repair.whole("E" * 40) == plain_audit("E" * 40)


def test_damage(spark):
    rows = [(c, t, "assistant", "One. Two!") for c in range(40) for t in range(5)] + [(None, None, None, None), (3, None, None, "a.")]
    got = sorted(map(tuple, repair.damaged(spark.createDataFrame(rows, CONVERSATIONS)).collect()), key=str)
    expected = []
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        expected += [(c, t, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    assert got == sorted(expected, key=str)


# --- fill in middle ---------------------------------------------------------------------------------------------------

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain_middle(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(units)
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(units[i:j]) for i, j in ((0, a), (a, b), (b, n)))
    if h[3] % 100 < 80:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_middles(spark):
    rng = random.Random(1)
    letters = list("ab<>PSM \t\n\v\f\r\x1c\xa0é漢🙂|.*$")
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 30))) for _ in range(400)]
    texts += [None, "", " ", " \n ", "<P>", "a<M>b c", "one", "word  " * 40000, " " * 50000, "<S", "x<P y<P z>"]
    rows = [(i, t, "kept") for i, t in enumerate(texts)] + [(None, "no id here at all", "kept"), (3, texts[3], "kept"), (3, texts[3], "kept")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    out = middle.transformed(docs).withColumn("back", middle.restored(F.col("output"), F.col("form"))).collect()
    assert sorted((str(r.doc_id), tuple(r)[3:8]) for r in out) == sorted((str(i), plain_middle(i, t)) for i, t, _ in rows)
    assert all(r.back == (r.text or "") and r.lang == "kept" for r in out)
    assert {r.form for r in out} == {"plain", "psm", "spm"}
    assert middle.transformed(docs.limit(0)).count() == 0
    with pytest.raises(ValueError, match="form"):
        middle.transformed(docs.withColumnRenamed("lang", "FORM"))


# --- shards -------------------------------------------------------------------------------------------------------------


def plain_cuts(sizes, shards):
    """Ends of shards over ordered sizes: the smallest capacity that fits, by trying, cut after the first shard, again for the rest."""

    def needed(part, capacity):
        n, held = 1, 0
        for size in part:
            if size > capacity:
                return len(part) + shards
            if held + size > capacity:
                n, held = n + 1, 0
            held += size
        return n

    out, at = [], 0
    for left in range(shards, 0, -1):
        rest = sizes[at:]
        if rest:
            capacity = -(-sum(rest) // left)
            while needed(rest, capacity) > left:
                capacity += 1
            held = 0
            while at < len(sizes) and held + sizes[at] <= capacity:
                held, at = held + sizes[at], at + 1
        out.append(at)
    return out


def test_search_equals_trying_every_capacity():
    rng = random.Random(2)
    for _ in range(60):
        sizes = [rng.randint(1, 40) for _ in range(rng.randint(1, 60))]
        shards = rng.randint(1, 9)
        n = np.arange(len(sizes))
        ranges = sharding.Ranges(n, 0 * n, 1 + 0 * n, np.array(sizes))
        ends = np.cumsum([0, *sizes])
        assert ranges.cuts(shards) == [ends[i] for i in plain_cuts(sizes, shards)]
        assert not ranges.noted


def test_no_partition_has_a_smaller_largest_shard():
    rng = random.Random(8)
    for _ in range(30):
        sizes = [rng.randint(1, 30) for _ in range(8)]
        n = np.arange(8)
        cuts = sharding.Ranges(n, 0 * n, 1 + 0 * n, np.array(sizes)).cuts(3)
        ends = np.cumsum([0, *sizes])
        largest = min(max(ends[i], ends[j] - ends[i], ends[8] - ends[j]) for i in range(9) for j in range(i, 9))
        assert max(np.diff([0, *cuts])) == largest


def test_groups_with_shards_of_their_own():
    assert sharding.own_shards([(1, 60), (2, 30), (3, 5)], 100, 4) == [1, 2]
    assert sharding.own_shards([(1, 25), (2, 25)], 100, 4) == []
    assert sharding.own_shards([(1, 99)], 100, 1) == []
    assert sharding.own_shards([], 0, 4) == []


@pytest.mark.parametrize("first, split", [(16, 6), (2, 3)])
def test_shards(spark, monkeypatch, first, split):
    monkeypatch.setattr(sharding, "FIRST", first)
    monkeypatch.setattr(sharding, "SPLIT", split)
    rng = random.Random(5)
    texts = [None, "", "é" * 300, "copy me " * 20] + ["".join(rng.choice("abc d") for _ in range(rng.randint(0, 400))) for _ in range(250)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(1000 + i, "copy me " * 20) for i in range(300)] + [(None, "x"), (None, "x"), (5, "repeated"), (5, "repeated"), (7, "other")]
    docs = spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, text string, bytes string").repartition(4)
    out = sharding.sharded(docs, shards=7).collect()
    assert len(out) == len(rows) and all(r.bytes == "z" for r in out)
    data = lambda t: (t or "").encode()
    sizes, keys = {}, {}
    for _, t in rows:
        key = int(hashlib.md5(data(t)).hexdigest()[:15], 16)
        sizes[key] = sizes.get(key, 0) + len(data(t)) + 16
        keys[t] = key
    largest = sorted(((k, s) for k, s in sizes.items()), key=lambda x: (-x[1], x[0]))[:7]
    own = sharding.own_shards(largest, sum(sizes.values()), 7)
    assert len(own) == 1  # the copies
    rest = sorted(k for k in sizes if k not in own)
    ends = plain_cuts([sizes[k] for k in rest], 7 - len(own))
    expected = {k: i for i, k in enumerate(own)} | {k: len(own) + sum(e <= i for e in ends[:-1]) for i, k in enumerate(rest)}
    for r in out:
        assert r.shard == expected[keys[r.text]] and r.size == len(data(r.text)) + 16 and r.text_crc32 == zlib.crc32(data(r.text))
        assert (r.law, r.grown_shard) == ("bytes", None)
    for shard in range(7):
        inside = sorted((r for r in out if r.shard == shard), key=lambda r: r.slot)
        assert [r.slot for r in inside] == list(range(len(inside)))
        order = [(keys[r.text], r.doc_id is not None, r.doc_id or 0) for r in inside]
        assert order == sorted(order)


def test_shards_of_few_rows_and_files(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a"), (2, "b" * 50), (3, "a")], "doc_id long, text string")
    got = {r.doc_id: r for r in sharding.sharded(docs, shards=40, keep=False).collect()}
    assert got[1].shard == got[3].shard != got[2].shard and max(r.shard for r in got.values()) < 40
    assert sharding.sharded(docs.limit(0)).count() == 0
    path = str(tmp_path / "shards")
    sharding.write_shards(docs, path, shards=2)
    back = spark.read.parquet(path)
    assert sorted((r.doc_id, r.shard) for r in back.collect()) == sorted((r.doc_id, r.shard) for r in sharding.sharded(docs, 2).collect())
    with pytest.raises(ValueError, match="slot"):
        sharding.sharded(docs.withColumn("Slot", F.lit(1)))
