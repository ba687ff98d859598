"""Conversation repair: the cheapest edits that give a legal order of roles, by block tables.

A legal conversation is empty or an optional system turn and then user and assistant turns in pairs. Rows may be kept
(0), given the role user or assistant (1), deleted (2); empty user or assistant turns may be inserted (5). Blank rows and
rows whose role and text were seen before must go; a cut-off row that stays costs 5 more.

Four states tell how far a legal order has come, so the cost of repairing the rest of a conversation is a vector of four
numbers. After its smallest entry is taken out only a few vectors exist. ``blocks`` holds, for every string of up to
``BLOCK`` row symbols and every such vector to its right, the vector to its left, the cost taken out and where each state
ends: a conversation is processed from its end by one lookup per block. Edits are then read off block by block from the
start: each block is expanded from its right border, which gives the vector at each of its rows, and the first edit in
the order D, I, K, R that keeps the cost is taken. No audit is the beginning of another of equal cost, so this is the least.

Rows are dealt by ranges of (conversation, turn, role, hash of the text) and pinned, so a conversation may lie in many
partitions. Of a partition, only the first and last conversation can; their tables (one number per vector and state)
are composed on the driver, two rows per partition. Equal rows are counted before they are dealt.

Defined cases: a null role or text is one space; null turns come first; rows of one turn are ordered by role, then by
the hash of the text; a null conv_id is a conversation; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from greenlane.llm.common import SPACES, table
from greenlane.session import ensure_checkpoint_dir

#: Rows per block of the tables: 9 symbols give 9 ** BLOCK blocks of the full length.
BLOCK = 4
#: Text of a conversation that may go on in another partition is handed on in chunks of about this many bytes.
CHUNK_BYTES = 1 << 20
KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 1, 2, 5, 5
ROLES = "sua"
#: Symbols of rows: 2 * role (s, u, a, other) + cut off; FORCED rows must be deleted.
FORCED, SYMBOLS = 8, 9
#: State by (state, role): 0 start, 1 after system, 2 after user, 3 after assistant.
MOVES = {(0, 0): 1, (0, 1): 2, (1, 1): 2, (2, 2): 3, (3, 1): 2}
AFTER_LAST = (0, 2 * INSERT, INSERT, 0)
FAR = 1 << 20


def choices(symbol: int, state: int, right: tuple[int, ...]) -> Iterator[tuple[str, int, int, bool]]:
    """(letter, cost of it and of the rest, state, row used) of the edits at one row but insertion, in ASCII order."""
    yield "D", DELETE + right[state], state, True
    if symbol != FORCED:
        role, cut = symbol >> 1, CUT_OFF * (symbol & 1)
        if (to := MOVES.get((state, role))) is not None:
            yield "K", KEEP + cut + right[to], to, True
        for new in (1, 2):
            if (to := MOVES.get((state, new))) is not None:
                yield "R", REROLE + cut + right[to], to, True


def before(symbol: int, right: tuple[int, ...]) -> tuple[int, ...]:
    """Costs by state before a row of this symbol, from those after it."""
    out = [min(cost for _, cost, _, _ in choices(symbol, s, right)) for s in range(4)]
    for _ in range(2):  # two insertions lead from any state to any that insertions reach
        out = [min([out[s], *(INSERT + out[MOVES[s, r]] for r in (1, 2) if (s, r) in MOVES)]) for s in range(4)]
    return tuple(out)


def at_row(symbol: int, state: int, right: tuple[int, ...]) -> tuple[str, int]:
    """Least letters for one row, insertions before it included, and the state after it."""
    here, letters = before(symbol, right), ""
    while True:
        best = min(((letter, to) for letter, cost, to, _ in choices(symbol, state, right) if cost == here[state]), default=("Z", 0))
        ways = [MOVES[state, r] for r in (1, 2) if (state, r) in MOVES and INSERT + here[MOVES[state, r]] == here[state]]
        if not ways or best[0] < "I":
            return letters + best[0], best[1]
        letters, state = letters + "I", ways[0]


class Blocks(NamedTuple):
    """Normalised vectors, and by block length (code, vector): vector to the left, cost taken out; (.., state): state at the end."""

    vectors: list[tuple[int, ...]]
    left: list[np.ndarray]
    cost: list[np.ndarray]
    end: list[np.ndarray]
    rows: dict


@functools.cache
def blocks(size: int = BLOCK) -> Blocks:
    """Tables for all blocks of up to ``size`` symbols; vector 0 is that after the last row."""
    vectors, todo = [AFTER_LAST], [AFTER_LAST]
    while todo:
        right = todo.pop()
        for symbol in range(SYMBOLS):
            vector = before(symbol, right)
            vector = tuple(c - min(vector) for c in vector)
            if vector not in vectors:
                vectors.append(vector)
                todo.append(vector)
    n, number = len(vectors), {v: k for k, v in enumerate(vectors)}
    left, cost, end = np.zeros((SYMBOLS, n), np.int32), np.zeros((SYMBOLS, n), np.int64), np.zeros((SYMBOLS, n, 4), np.int8)
    rows = {}
    for symbol in range(SYMBOLS):
        for k, right in enumerate(vectors):
            vector = before(symbol, right)
            cost[symbol, k] = min(vector)
            left[symbol, k] = number[tuple(c - min(vector) for c in vector)]
            for s in range(4):
                rows[symbol, k, s] = at_row(symbol, s, right)
                end[symbol, k, s] = rows[symbol, k, s][1]
    lefts, costs, ends = [np.arange(n, dtype=np.int32)[None], left], [np.zeros((1, n), np.int64), cost], [np.broadcast_to(np.arange(4, dtype=np.int8), (1, n, 4)), end]
    for _ in range(size - 1):
        inner = lefts[-1]  # (code of the rest, vector right of the block) -> vector between first row and rest
        lefts.append(left[:, inner].reshape(-1, n))
        costs.append((cost[:, inner] + costs[-1][None]).reshape(-1, n))
        first = end[:, inner]  # (first symbol, rest, vector, state)
        rest, vec = np.indices(inner.shape)
        ends.append(ends[-1][rest[None, ..., None], vec[None, ..., None], first].reshape(-1, n, 4))
    return Blocks(vectors, lefts, costs, ends, rows)


def cut_up(symbols: bytes) -> list[tuple[int, int]]:
    """(length, code) of the blocks of a row string, the short one first."""
    out, at = [], 0
    while at < len(symbols):
        size = (len(symbols) - at) % BLOCK or BLOCK
        code = 0
        for symbol in symbols[at: at + size]:
            code = code * SYMBOLS + symbol
        out.append((size, code))
        at += size
    return out


def composed(symbols: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Vector to the left, and (.., state) state at the end, by the vector to the right of the whole string."""
    t = blocks()
    vector = np.arange(len(t.vectors), dtype=np.int32)
    state = np.broadcast_to(np.arange(4, dtype=np.int8), (len(vector), 4))
    every = vector[:, None]
    for size, code in reversed(cut_up(symbols)):
        state = state[every, t.end[size][code][vector]]
        vector = t.left[size][code][vector]
    return vector, state


@functools.lru_cache(1 << 16)
def expanded(size: int, code: int, right: int, state: int) -> tuple[tuple[str, ...], int]:
    """Letters of each row of a block, and the state after it."""
    t, symbols = blocks(), []
    for _ in range(size):
        code, symbol = divmod(code, SYMBOLS)
        symbols.append(symbol)
    rights = []
    for symbol in symbols:  # from the right border
        rights.append(right)
        right = int(t.left[1][symbol, right])
    letters = []
    for symbol, vector in zip(reversed(symbols), reversed(rights), strict=True):
        word, state = t.rows[symbol, vector, state]
        letters.append(word)
    return tuple(letters), state


def traced(symbols: bytes, right: int = 0, state: int = 0) -> tuple[list[str], int]:
    """Letters of each row (insertions before it included), and the state after the last."""
    t, parts, rights = blocks(), cut_up(symbols), []
    for size, code in reversed(parts):
        rights.append(right)
        right = int(t.left[size][code, right])
    out: list[str] = []
    for (size, code), vector in zip(parts, reversed(rights), strict=True):
        letters, state = expanded(size, code, vector, state)
        out += letters
    return out, state


# --- rows with their faults --------------------------------------------------------------------


def has_words(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACES)) != ""


def marked(rows: DataFrame, times: Column | None = None) -> DataFrame:
    """conv_id, turn, role, text, text_hash, copies, forced, symbol: one row per distinct row, ``copies`` times there.

    ``forced`` is blank, duplicate or null and says why the row must go; of a row that need not, only the first copy stays.
    ``times`` counts a row more than once.
    """
    times = F.lit(1) if times is None else times
    value = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" ")).alias(name)
    counted = rows.select("conv_id", "turn", value("role"), value("text"), times.cast("long").alias("n")).groupBy("conv_id", "turn", "role", "text").agg(
        F.sum("n").alias("copies")).withColumn("text_hash", F.unhex(F.sha2("text", 256)))
    first = counted.groupBy(F.col("conv_id").alias("f_conv"), F.col("role").alias("f_role"), F.col("text_hash").alias("f_hash")).agg(
        F.min(F.struct(F.col("turn").isNotNull().alias("known"), "turn")).alias("f")).select("f_conv", "f_role", "f_hash", F.col("f.turn").alias("f_turn"))
    same = F.col("conv_id").eqNullSafe(F.col("f_conv")) & F.col("turn").eqNullSafe(F.col("f_turn")) & (F.col("role") == F.col("f_role")) & (F.col("text_hash") == F.col("f_hash"))
    forced = F.when(~has_words(F.col("text")), "blank").when(F.col("f_role").isNull(), "duplicate")
    cut = (~F.right(F.rtrim(F.translate("text", SPACES, " " * len(SPACES))), F.lit(1)).isin(".", "!", "?")).cast("int")
    initial = F.substring("role", 1, 1)
    role = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    return counted.join(first, same, "left").withColumn("forced", forced).select(
        "conv_id", "turn", "role", "text", "text_hash", "copies", "forced", F.when(F.col("forced").isNotNull(), FORCED).otherwise(2 * role + cut).cast("int").alias("symbol"))


def in_order(rows: DataFrame) -> DataFrame:
    """Marked rows by ranges of their order, pinned by a checkpoint."""
    ensure_checkpoint_dir(rows.sparkSession)
    key = ["conv_id", "turn", "role", "text_hash"]
    return rows.repartitionByRange(*key).sortWithinPartitions(*key).checkpoint()


# --- partitions --------------------------------------------------------------------------------


def conversations_of(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple[object, list[tuple]]]:
    """(conv_id, rows of the columns) of each conversation of a sorted partition."""
    current, rows, any_ = None, [], False
    for batch in batches:
        ids = batch.column("conv_id").to_pylist()
        for conv, row in zip(ids, zip(*(batch.column(c).to_pylist() for c in columns), strict=True), strict=True):
            if any_ and conv != current:
                yield current, rows
                rows = []
            current, any_ = conv, True
            rows.append(row)
    if any_:
        yield current, rows


def borders(ordered: DataFrame) -> dict[int, tuple[int, int, bool, bool]]:
    """By partition: the vector to its right, the state at its start, whether its last conversation goes on, whether its first began before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, kept = TaskContext.get().partitionId(), []
        for k, (conv, rows) in enumerate(conversations_of(batches, ["symbol"])):
            kept = [*kept[:1], (k, conv, bytes(r[0] for r in rows))]
        for k, conv, symbols in kept:
            vector, state = composed(symbols)
            yield pa.RecordBatch.from_pylist([{"part": part, "k": k, "conv": None if conv is None else str(conv), "vector": vector.astype("<i4").tobytes(), "state": state.tobytes()}], schema=schema)

    schema = pa.schema([("part", pa.int32()), ("k", pa.int32()), ("conv", pa.string()), ("vector", pa.binary()), ("state", pa.binary())])
    found = ordered.select("conv_id", "symbol").mapInArrow(run, "part int, k int, conv string, vector binary, state binary")
    ends = sorted(found.collect(), key=lambda r: (r.part, r.k))
    goes_on = [a.part != b.part and a.conv == b.conv for a, b in zip(ends, ends[1:], strict=False)] + [False]
    right = [0] * len(ends)
    for i in reversed(range(len(ends) - 1)):
        if goes_on[i]:
            right[i] = int(np.frombuffer(ends[i + 1].vector, "<i4")[right[i + 1]])
    start, out = 0, {}
    for i, row in enumerate(ends):
        began = i > 0 and goes_on[i - 1]
        state = start if began else 0
        old = out.get(row.part, (0, state, False, began))
        out[row.part] = (right[i], old[1], goes_on[i], old[3])
        start = int(np.frombuffer(row.state, np.int8).reshape(-1, 4)[right[i], state])
    return {p: b for p, b in out.items() if b[2] or b[3]}


EDIT_SCHEMA = "conv_id {}, turn {}, edit string, times long, fault string, new_role string, role string, text string"


def edits(marked_rows: DataFrame) -> DataFrame:
    """conv_id, turn, edit, times, fault, new_role, role, text: the edits of each conversation in their order.

    ``role`` and ``text`` are those of the row, ``new_role`` that of the repaired one (null if deleted); ``times`` counts equal
    deletions in a row; insertions have neither turn nor role and an empty text. Rows lie in order within and across partitions.
    """
    ordered = in_order(marked_rows)
    at = borders(ordered)
    columns = ["turn", "role", "text", "copies", "forced", "symbol"]
    types = {f.name: f.dataType.simpleString() for f in ordered.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        def done(conv, rows, right, state, goes_on) -> list[tuple]:
            letters, last = traced(bytes(r[5] for r in rows), right, state)
            out = []
            insert = lambda s: (conv, None, "I", 1, None, "assistant" if s == 2 else "user", None, "")
            for (turn, role, text, copies, forced, symbol), word in zip(rows, letters, strict=True):
                for _ in word[:-1]:
                    out.append(insert(state))
                    state = 3 if state == 2 else 2
                edit = word[-1]
                if edit == "D":
                    new = None
                elif edit == "K":
                    new, state = role, MOVES[state, symbol >> 1]
                else:
                    new, state = ("assistant", 3) if state == 2 else ("user", 2)
                same = copies if forced else 1
                out.append((conv, turn, edit, same, forced or ("truncated" if symbol & 1 else None), new, role, text))
                if copies > same:
                    out.append((conv, turn, "D", copies - same, "duplicate", None, role, text))
            while not goes_on and state in (1, 2):
                out.append(insert(state))
                state += 1
            return out

        right, state, goes_on, _ = at.get(TaskContext.get().partitionId(), (0, 0, False, False))
        waiting, ready, weight = None, [], 0
        for conv, rows in conversations_of(batches, columns):
            if waiting:
                ready += done(*waiting, 0, state, False)
                weight += sum(len(r[2]) + 64 for r in waiting[1])
                state = 0
                if weight > CHUNK_BYTES:
                    yield batch_of(ready)
                    ready, weight = [], 0
            waiting = (conv, rows)
        if waiting:
            ready += done(*waiting, right, state, goes_on)
        if ready:
            yield batch_of(ready)

    arrow = ordered.select("conv_id", "turn").limit(0).toArrow().schema
    schema = pa.schema([("conv_id", arrow.field(0).type), ("turn", arrow.field(1).type), ("edit", pa.string()), ("times", pa.int64()), ("fault", pa.string()),
                        ("new_role", pa.string()), ("role", pa.string()), ("text", pa.string())])
    batch_of = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
    return ordered.mapInArrow(run, EDIT_SCHEMA.format(types["conv_id"], types["turn"]))


def repaired(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text of the repaired conversations, in order (inserted turns have a null turn)."""
    return edits(marked(conversations)).filter("edit != 'D'").select("conv_id", "turn", F.col("new_role").alias("role"), "text")


# --- the query ---------------------------------------------------------------------------------


def damaged(conversations: DataFrame) -> tuple[DataFrame, Column]:
    """Rows damaged by crc32(conv_id:turn) modulo 20 (0 dropped, 1 emptied, 2 without ``[.!?]``, 3 twice, 4 as user), and how often each counts."""
    known = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", known("role").alias("role"), known("text").alias("text"), kind.alias("kind")).filter("kind != 0")
    return rows.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"), "kind"), F.when(F.col("kind") == 3, 2).otherwise(1)


PIECES = ("part int, seq int, conv_id {}, blank long, duplicate long, truncated long, illegal long, first_initial string, last_initial string, turns long, "
          "first_turn {}, last_turn {}, cost long, audit string, sha string, body binary")


def pieces(edit_rows: DataFrame) -> DataFrame:
    """One row (seq 0) per conversation and partition with its counts, cost, audit; further rows carry text of the first and last one."""
    types = {f.name: f.dataType.simpleString() for f in edit_rows.schema}
    arrow = edit_rows.select("conv_id", "turn").limit(0).toArrow().schema
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "{}": arrow.field(1).type}
    schema = pa.schema([(f.split()[0], arrow.field(0).type if f.split()[0] == "conv_id" else kinds[f.split()[1]]) for f in PIECES.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        batch_of = lambda rows: pa.RecordBatch.from_pylist(rows, schema=schema)

        def chunk(seq, conv, body):
            return batch_of([{"part": part, "seq": seq, "conv_id": conv, "body": bytes(body)}])

        ready, k, piece, open_ = [], 0, None, False
        for batch in batches:
            for conv, turn, edit, times, fault, new, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if piece is None or conv != piece["conv_id"]:
                    if piece is not None:
                        if k == 1:
                            yield chunk(seq, piece["conv_id"], body)
                        else:
                            sha.update(body)
                            piece["sha"] = sha.hexdigest()
                        ready.append({**piece, "audit": "".join(audit)})
                        if len(ready) >= 1024:
                            yield batch_of(ready)
                            ready = []
                    k, seq, sha, body, audit, open_ = k + 1, 1, hashlib.sha256(), bytearray(), [], False
                    piece = {"part": part, "seq": 0, "conv_id": conv, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "turns": 0, "cost": 0}
                    first_k = k
                audit.append(edit * times)
                piece["cost"] += times * {"K": KEEP, "R": REROLE, "D": DELETE, "I": INSERT}[edit] + (CUT_OFF if fault == "truncated" and edit != "D" else 0)
                if fault:
                    piece[fault] += times
                if role is not None:
                    initial, last = role[:1], piece.get("last_initial")
                    piece["illegal"] += times - 1 + (last is not None and last + initial not in ("su", "ua", "au"))
                    piece.setdefault("first_initial", initial)
                    piece["last_initial"] = initial
                    if turn is not None and turn != piece.get("last_turn"):
                        piece["turns"] += 1
                        piece.setdefault("first_turn", turn)
                        piece["last_turn"] = turn
                if new is not None:
                    body += ("\n" if open_ else "").encode() + f"{new}:{text}".encode()
                    open_ = True
                    if len(body) >= CHUNK_BYTES and first_k == 1:
                        yield chunk(seq, conv, body)
                        seq, body = seq + 1, bytearray()
        if piece is not None:
            yield chunk(seq, piece["conv_id"], body)
            ready.append({**piece, "audit": "".join(audit)})
            yield batch_of(ready)

    return edit_rows.mapInArrow(run, PIECES.format(types["conv_id"], types["turn"], types["turn"]))


def streamed_sha(chunks: DataFrame) -> DataFrame:
    """conv_id, sha: SHA-256 of the chunks of each conversation in order, joined over partitions by a newline where both have text."""
    kind = chunks.schema["conv_id"].dataType.simpleString()
    arrow = chunks.select("conv_id").limit(0).toArrow().schema.field(0).type
    schema = pa.schema([("conv_id", arrow), ("sha", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, part, sha, some, seen, out = None, None, None, False, False, []
        for batch in batches:
            for conv, p, body in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "part", "body")), strict=True):
                if not seen or conv != current:
                    if seen:
                        out.append({"conv_id": current, "sha": sha.hexdigest()})
                    current, sha, some, part, seen = conv, hashlib.sha256(), False, p, True
                if body and some and p != part:
                    sha.update(b"\n")
                sha.update(body)
                some, part = some or bool(body), p if body else part
        if seen:
            out.append({"conv_id": current, "sha": sha.hexdigest()})
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    dealt = chunks.select("conv_id", "part", "seq", "body").repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq")
    return dealt.mapInArrow(run, f"conv_id {kind}, sha string")


def digests(edit_rows: DataFrame) -> DataFrame:
    """Counts, gaps, cost, audit and hash per conversation that has rows. One hash is one stream: a conversation's repaired text passes one task in chunks."""
    found = pieces(edit_rows).checkpoint()
    heads = found.filter("seq = 0")
    shas = streamed_sha(found.filter("seq > 0")).select(F.col("conv_id").alias("s_conv"), F.col("sha").alias("s_sha"))
    parts = F.array_sort(F.collect_list(F.struct("part", "first_initial", "last_initial", "first_turn", "last_turn", "audit")))
    rows = heads.groupBy("conv_id").agg(*[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "turns", "cost")],
                                        F.min("first_turn").alias("lo"), F.max("last_turn").alias("hi"), F.max("sha").alias("sha"), parts.alias("p"))
    seams = F.zip_with(F.slice("p", 1, F.greatest(F.size("p") - 1, F.lit(0))), F.slice("p", 2, F.size("p")), lambda a, b: F.struct(
        (~F.concat(a["last_initial"], b["first_initial"]).isin("su", "ua", "au")).cast("long").alias("bad"), (a["last_turn"] == b["first_turn"]).cast("long").alias("same")))
    total = lambda name: F.aggregate(F.transform("seams", lambda x: F.coalesce(x[name], F.lit(0).cast("long"))), F.lit(0).cast("long"), lambda a, b: a + b)
    rows = rows.withColumn("seams", seams).join(shas, F.col("conv_id").eqNullSafe(F.col("s_conv")), "left")
    return rows.select(
        "conv_id", F.coalesce(F.col("hi") - F.col("lo") + 1 - (F.col("turns") - total("same")), F.lit(0)).cast("long").alias("gaps"), "blank", "duplicate", "truncated",
        (F.col("illegal") + total("bad")).alias("illegal"), "cost", F.array_join(F.transform("p", lambda x: x["audit"]), "").alias("audit"), F.coalesce("s_sha", "sha").alias("repaired_sha256"))


def op11_conversation_repair(spark, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    rows, times = damaged(conversations)
    done = digests(edits(marked(rows, times))).withColumnRenamed("conv_id", "d_conv")
    every = conversations.select("conv_id").distinct().join(done, F.col("conv_id").eqNullSafe(F.col("d_conv")), "left")
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return every.select("conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))


#: The same rules by costs of single rows: ``b`` holds the vectors from the last row on, ``w`` takes one letter per step.
_CRC = """xor(list_reduce(list_concat([4294967295], list_transform(string_split(k, ''), lambda c: cast(ord(c) as bigint))),
    lambda a, c: list_reduce([xor(a, c), 1, 2, 3, 4, 5, 6, 7, 8], lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"""
_TO = "case when {s} = 0 and {r} = 's' then 1 when {s} in (0, 1, 3) and {r} = 'u' then 2 when {s} = 2 and {r} = 'a' then 3 end"


def _raw(s: int) -> str:
    keep = {0: "when 's' then n[2] when 'u' then n[3]", 1: "when 'u' then n[3]", 2: "when 'a' then n[4]", 3: "when 'u' then n[3]"}[s]
    return f"least(2 + n[{s + 1}], case when not must then 1 + 5 * cut + n[{4 if s == 2 else 3}] end, case when not must then 5 * cut + case r {keep} end end)"


ORACLE_SQL = f"""
with recursive
k as (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text, coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ') as k from conversations),
h as (select *, {_CRC} % 20 as kind from k),
d as (select conv_id, turn, case when kind = 4 then 'user' else role end as role,
    case kind when 1 then '' when 2 then translate(text, '.!?', '') else text end as text, unnest(case kind when 3 then [1, 2] else [1] end) as copy from h where kind <> 0),
o as (select *, row_number() over (partition by conv_id order by turn nulls first, role, sha256(text), copy) as i from d),
f as (select *, left(role, 1) as r, not regexp_matches(text, '[^\x20\x09-\x0D]') as blank, row_number() over (partition by conv_id, role, text order by i) > 1 as again,
    cast(not regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') as int) as cut, left(lag(role) over (partition by conv_id order by i), 1) || left(role, 1) as pair from o),
m as (select *, blank or again as must, count(*) over (partition by conv_id) as total from f),
b as (select conv_id, max(total) + 1 as i, [0, 10, 5, 0] as n from m group by conv_id
    union all
    select conv_id, i, [least(x[1], 5 + x[3], 10 + x[4]), least(x[2], 5 + x[3], 10 + x[4]), least(x[3], 5 + x[4]), least(x[4], 5 + x[3])]
    from (select m.conv_id, m.i, [{', '.join(_raw(s) for s in range(4))}] as x from b join m on m.conv_id is not distinct from b.conv_id and m.i = b.i - 1)),
w as (select conv_id, cast(1 as bigint) as i, 0 as s, '' as audit, cast([] as varchar[]) as lines, 0 as cost, false as done from (select distinct conv_id from m)
    union all
    select conv_id, case when e in ('D', 'K', 'R') then i + 1 else i end, coalesce(to_, s), audit || coalesce(e, ''),
        case e when 'K' then list_append(lines, role || ':' || text) when 'R' then list_append(lines, case to_ when 3 then 'assistant:' else 'user:' end || text)
            when 'I' then list_append(lines, case to_ when 3 then 'assistant:' else 'user:' end) else lines end,
        cost + case e when 'D' then 2 when 'K' then 5 * cut when 'R' then 1 + 5 * cut when 'I' then 5 else 0 end, e is null
    from (select *, case when e in ('I', 'R') then case when s = 2 then 3 else 2 end when e = 'K' then {_TO.format(s='s', r='r')} end as to_
        from (select w.*, m.role, m.text, m.r, m.cut,
            case when m.i is not null and 2 + a.n[s + 1] = here.n[s + 1] then 'D'
                when here.n[s + 1] = 5 + here.n[case when s = 2 then 4 else 3 end] then 'I'
                when not m.must and 5 * m.cut + a.n[1 + ({_TO.format(s='s', r='m.r')})] = here.n[s + 1] then 'K'
                when m.i is not null then 'R' end as e
            from w join b here on here.conv_id is not distinct from w.conv_id and here.i = w.i
            left join m on m.conv_id is not distinct from w.conv_id and m.i = w.i
            left join b a on a.conv_id is not distinct from w.conv_id and a.i = w.i + 1
            where not done))),
g as (select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (blank) as blank, count(*) filter (again and not blank) as duplicate,
    count(*) filter (cut = 1 and not must) as truncated, count(*) filter (pair not in ('su', 'ua', 'au')) as illegal from m group by conv_id)
select c.conv_id, cast(coalesce(gaps, 0) as bigint) as gaps, cast(coalesce(blank, 0) as bigint) as blank, cast(coalesce(duplicate, 0) as bigint) as duplicate,
    cast(coalesce(truncated, 0) as bigint) as truncated, cast(coalesce(illegal, 0) as bigint) as illegal, cast(coalesce(cost, 0) as bigint) as cost, coalesce(audit, '') as audit,
    sha256(coalesce(array_to_string(lines, chr(10)), '')) as repaired_sha256
from (select distinct conv_id from conversations) c left join g on g.conv_id is not distinct from c.conv_id left join w on w.conv_id is not distinct from c.conv_id and w.done
"""
