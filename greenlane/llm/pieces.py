"""SentencePiece encoding by forward-filtering backward-sampling, and lossless decoding.

A text is cut into units at places that no piece crosses: before the spaces that lead a word, and around other white
space except before carriage returns. That no piece does is checked when a vocabulary is loaded (``may_cross``); one
that has such a piece is refused. The lattice of a unit has a node per character boundary and an arc per piece of
the vocabulary that fits; a character that is no piece gets one arc of its UTF-8 byte pieces, weighed as rarer than the
last piece, and so does a literal U+2581, which the vocabulary uses for the space. Forward filtering sums the weights of
all paths into each node; backward sampling draws from the end one incoming arc at a time, so a
segmentation comes with its exact probability. The weight of a piece is ``(2 + r) ** -SHARPNESS``,
``r`` the negative of its score: the scores of a merge vocabulary are ranks, and weights by rank
follow Zipf's law.

The draws are hashes of (seed, row key, unit's place, step), so a row's segmentation depends on nothing
else: not on batches, partitions or retries. All units of a batch are drawn at once, one arc a step.
Lattices of frequent units are kept per worker, at most ``KEPT_UNITS``.

Defined cases: a null text has null ids and no pieces; an empty text has no pieces; repeated rows give
the same segmentation; a null key counts as the text 'None'; other columns are ignored.
"""

from __future__ import annotations

import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from greenlane.llm.common import map_batches, table

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SHARPNESS, SEED = 1.0, 20260101
SPACE = "▁"
UNIT = re.compile(r" *[^\s]+\r*| *\r+| +|\s")
KEPT_UNITS, LONG_UNIT, MADE_AT_ONCE = 40_000, 48, 8192
HASH_BASE, SLOT_BASE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
SEEN = 1 << 21
PACKED = (np.int32, np.float64, np.int32, np.int32)
#: Arcs ordered by their end, packed: arcs per node 1.., running sums into a node, starts, pieces. A
#: piece below zero, -1 - c, is the byte fallback of code point c.
Lattice = tuple[bytes, bytes, bytes, bytes]


def may_cross(a: str, b: str) -> bool:
    """Whether ``UNIT`` never cuts between these neighbours, whatever stands around them."""
    return b == "\r" and (a in " \r" or not a.isspace()) or not b.isspace() and (a == " " or not a.isspace()) or a == b == " "


class HashTable:
    """Places of 64-bit keys by linear probing, looked up for whole arrays."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(4, int(len(keys) * 8).bit_length())
        self.keys, self.place = np.zeros(2**self.bits, np.uint64), np.full(2**self.bits, -1, np.int64)
        slot, left = self._slot(keys), np.arange(len(keys))
        self.probes = 0
        while len(left):  # of the keys that want a free slot, the first gets it
            slots, first = np.unique(slot[left], return_index=True)
            free = self.place[slots] < 0
            taken = left[first[free]]
            self.keys[slots[free]], self.place[slots[free]] = keys[taken], taken
            left = np.setdiff1d(left, taken)
            slot[left] = (slot[left] + 1) % 2**self.bits
            self.probes += 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * SLOT_BASE) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, -1 where it is not in the table."""
        slot = self._slot(keys)
        out = np.where(self.keys[slot] == keys, self.place[slot], -1)
        missed = np.flatnonzero((out < 0) & (self.place[slot] >= 0))
        for _ in range(self.probes):
            if not len(missed):
                break
            slot[missed] = (slot[missed] + 1) % 2**self.bits
            now = slot[missed]
            out[missed] = np.where(self.keys[now] == keys[missed], self.place[now], -1)
            missed = missed[(out[missed] < 0) & (self.place[now] >= 0)]
        return out


class Vocabulary:
    """Pieces of a SentencePiece model with their weights."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = [b""] * model.get_piece_size()
        self.byte_id = [-1] * 256
        self.single: set[str] = set()
        self.found: dict[str, tuple[int, float]] = {}
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[1:-1], 16)
                self.byte_id[value], self.bytes[i] = i, bytes([value])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                text = piece.replace(SPACE, " ")
                self.bytes[i] = text.encode()
                self.found[text] = (i, (2 + max(0.0, -model.get_score(i))) ** -SHARPNESS)
                if len(text) == 1:
                    self.single.add(text)
        if wrong := [t for t in self.found if not all(map(may_cross, t, t[1:]))]:
            raise ValueError(f"pieces that cross the cuts between units: {wrong[:5]}")
        #: weight of a character by its bytes
        self.rare = (2 + model.get_piece_size()) ** -SHARPNESS
        self.longest = max(map(len, self.found))
        self.byte_ids = np.array(self.byte_id)
        #: by length: hashes of the pieces' prefixes, the piece that a prefix is (else -1), its weight
        self.prefixes = []
        for length in range(1, self.longest + 1):
            texts = sorted({p[:length] for p in self.found if len(p) >= length})
            codes = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.uint64).reshape(-1, length)
            hashed = np.zeros(len(texts), np.uint64)
            for column in codes.T:
                hashed = hashed * HASH_BASE + column
            got = [self.found.get(t, (-1, 0.0)) for t in texts]
            self.prefixes.append((HashTable(hashed), np.array([g[0] for g in got]), np.array([g[1] for g in got])))

    def lattice(self, unit: str) -> Lattice:
        """The lattice of one unit of any length.

        Node sums are scaled up when they get small: only their ratios among the arcs of a node are used.
        """
        find, reach = self.found.get, self.longest
        node, counts, sums, starts, pieces = [1.0], [], [], [], []
        for end in range(1, len(unit) + 1):
            total, before = 0.0, len(sums)
            for start in range(end - reach if end > reach else 0, end):
                piece = find(unit[start:end])
                if piece is None and start == end - 1:
                    piece = -1 - ord(unit[start]), self.rare
                if piece is not None:
                    total += node[start] * piece[1]
                    sums.append(total)
                    starts.append(start)
                    pieces.append(piece[0])
            node.append(total)
            counts.append(len(sums) - before)
            if total < 1e-150:  # later sums use the last ``reach`` nodes only
                node[-reach - 1:] = [x * 1e150 for x in node[-reach - 1:]]
        return tuple(np.array(x, t).tobytes() for x, t in zip((counts, sums, starts, pieces), PACKED, strict=True))

    def lattices(self, units: list[str]) -> tuple[np.ndarray, ...]:
        """The lattices of many units of at most LONG_UNIT characters, forward-filtered side by side and laid end to end.

        Returned: counts, sums, starts, pieces as in a Lattice, and each unit's first arc.
        """
        size = np.array([len(u) for u in units], np.int64)
        code = np.frombuffer("".join(units).encode("utf-32-le"), np.uint32).astype(np.uint64)
        owner = np.repeat(np.arange(len(units)), size)
        at = np.arange(len(code)) - np.repeat(np.cumsum(size) - size, size)
        room = size[owner] - at
        live, hashed = np.arange(len(code)), np.zeros(len(code), np.uint64)
        arcs = []
        for length, (table, ids, weights) in enumerate(self.prefixes, 1):
            fits = room[live] >= length
            live = live[fits]
            hashed = hashed[fits] * HASH_BASE + code[live + length - 1]
            place = table.find(hashed)
            known = place >= 0
            piece = known & (ids[place] >= 0)
            arcs.append((live[piece], np.full(piece.sum(), length), ids[place[piece]], weights[place[piece]]))
            if length == 1:
                arcs.append((live[~piece], np.ones((~piece).sum(), np.int64), -1 - code[live[~piece]].astype(np.int64), np.full((~piece).sum(), self.rare)))
            live, hashed = live[known], hashed[known]
        place, length, piece, weight = (np.concatenate([a[k] for a in arcs]) for k in range(4))
        # by unit, end, start; then, kept in that order, end by end
        order = np.argsort((place + length) * 64 - length, kind="stable")  # merges the runs of the lengths
        place, length, piece, weight = (x[order] for x in (place, length, piece, weight))
        start, unit = at[place], owner[place]
        end = start + length
        by_end = np.argsort(end.astype(np.uint8), kind="stable")
        first = np.searchsorted(end[by_end], np.arange(1, LONG_UNIT + 2))
        node_at = np.cumsum(size + 1) - size - 1
        origin = node_at[unit]
        source, into_node = origin + start, origin + end
        node, sums = np.zeros(len(code) + len(units)), np.empty(len(order))
        node[node_at] = 1.0
        for a, b in zip(first, first[1:], strict=False):
            if a < b:
                now = by_end[a:b]
                into = into_node[now]
                heads = np.flatnonzero(np.diff(into, prepend=-1))
                run = node[source[now]] * weight[now]
                lengths = np.diff(heads, append=len(now))
                rank = np.arange(len(now)) - np.repeat(heads, lengths)
                for r in range(1, int(lengths.max())):  # added in order, so the sums don't depend on the batch
                    later = np.flatnonzero(rank == r)
                    run[later] += run[later - 1]
                node[into[heads]] = run[heads + lengths - 1]
                sums[now] = run
        counts = np.delete(np.bincount(into_node, minlength=len(node)), node_at)
        return counts.astype(np.int32), sums, start.astype(np.int32), piece.astype(np.int32), np.searchsorted(unit, np.arange(len(units) + 1))


@lru_cache(2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


#: By vocabulary: lattices of units, and a mark for the hashes of units that were made once before.
_kept: dict[str, tuple[dict[str, Lattice], bytearray]] = {}


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def sample(texts: list[str | None], keys: list, path: str = MODEL, seed: int = SEED) -> list[np.ndarray | None]:
    """Piece ids of each text, drawn from its lattice."""
    vocab, (kept, seen) = vocabulary(path), _kept.setdefault(path, ({}, bytearray(SEEN)))
    units, n_units = [], np.empty(len(texts), np.int64)
    for k, t in enumerate(texts):
        before = len(units)
        units += UNIT.findall(t) if t else ()
        n_units[k] = len(units) - before
    total = len(units)
    if not total:
        return [None if t is None else np.empty(0, np.int32) for t in texts]

    # distinct units of the batch, their lattices laid end to end
    coded = pa.array(units, pa.large_string()).dictionary_encode()
    kind, place = coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_pylist()
    found = [kept.get(u) for u in place]
    known = [k for k, x in enumerate(found) if x is not None]
    short = [k for k, x in enumerate(found) if x is None and len(place[k]) <= LONG_UNIT]
    long = [k for k, x in enumerate(found) if x is None and len(place[k]) > LONG_UNIT]
    parts = [found[k] for k in known] + [vocab.lattice(place[k]) for k in long]
    blocks = [tuple(np.frombuffer(b"".join([p[k] for p in parts]), t) for k, t in enumerate(PACKED))]
    for a in range(0, len(short), MADE_AT_ONCE):
        units_now = [place[k] for k in short[a:a + MADE_AT_ONCE]]
        *block, arc_at = vocab.lattices(units_now)
        blocks.append(tuple(block))
        node = 0
        for unit, b, c in zip(units_now, arc_at.tolist(), arc_at[1:].tolist(), strict=False):
            if len(kept) < KEPT_UNITS:  # a unit is kept when it is made a second time
                mark = hash(unit) % SEEN
                if seen[mark]:
                    kept[unit] = (block[0][node:node + len(unit)].tobytes(), *(x[b:c].tobytes() for x in block[1:]))
                seen[mark] = 1
            node += len(unit)
    counts, sums, starts, pieces = (np.concatenate([x[k] for x in blocks]) for k in range(4))
    order = np.array(known + long + short, np.int64)
    moved = np.empty(len(order), np.int64)
    moved[order] = np.arange(len(order))
    kind = moved[kind]
    nodes = np.array([len(u) for u in place], np.int64)[order]
    node_at = np.concatenate([[0], np.cumsum(nodes)])  # place of a unit's node 1
    first = np.concatenate([[0], np.cumsum(counts)])  # first arc into each node
    shares = sums / np.repeat(sums[first[1:] - 1], counts)

    # backward sampling: every unit still open draws one arc into its present node
    row_seed = np.array([xxhash.xxh64_intdigest(str(k), seed=seed) for k in keys], np.uint64)
    unit_no = np.arange(total, dtype=np.int64) - np.repeat(np.cumsum(n_units) - n_units, n_units)
    stream = _mix(np.repeat(row_seed, n_units) + (unit_no.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
    base = node_at[kind]
    open_, here = np.arange(total), nodes[kind].copy()
    drawn, by_unit, step = [], [], 0
    n_pieces = np.zeros(total, np.int64)
    while len(open_):
        u = (_mix(stream[open_] + np.uint64((step + 1) * 0xD1342543DE82EF95 & (2**64 - 1))) >> np.uint64(11)).astype(np.float64) / 2**53
        arc = first[base[open_] + here - 1]
        late = np.flatnonzero(shares[arc] <= u)
        while len(late):
            arc[late] += 1
            late = late[shares[arc[late]] <= u[late]]
        drawn.append(pieces[arc])
        by_unit.append(open_)
        n_pieces[open_] += 1
        here = starts[arc].astype(np.int64)
        left = here > 0
        open_, here = open_[left], here[left]
        step += 1

    # pieces came last first
    ends = np.cumsum(n_pieces)
    flat = np.empty(int(ends[-1]), np.int64)
    for step, (unit, piece) in enumerate(zip(by_unit, drawn, strict=True)):
        flat[ends[unit] - 1 - step] = piece
    row_ends = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(n_units)])]
    below = np.flatnonzero((flat < 0) & (flat >= -128))
    flat[below] = vocab.byte_ids[-1 - flat[below]]
    out: list[np.ndarray | None] = []
    for t, a, b in zip(texts, row_ends.tolist(), row_ends[1:].tolist(), strict=False):
        ids = flat[a:b]
        if len(ids) and ids.min() < 0:  # code points of several bytes
            ids = np.array([x for i in ids.tolist() for x in ([i] if i >= 0 else [vocab.byte_id[c] for c in chr(-1 - i).encode()])], np.int32)
        out.append(None if t is None else ids.astype(np.int32))
    return out


def decode(ids: np.ndarray | list[int] | None, path: str = MODEL) -> str | None:
    """The text of piece ids."""
    if ids is None:
        return None
    return b"".join(map(vocabulary(path).bytes.__getitem__, ids if isinstance(ids, list) else ids.tolist())).decode()


SCHEMA = "doc_id long, ids array<int>, n_pieces long, lossless boolean"


def encoded(docs: DataFrame, path: str = MODEL, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, sampled piece ids, their number, and whether decoding them gives the text back."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(1).to_pylist()
        ids = sample(texts, batch.column(0).to_pylist(), path, seed)
        same = [decode(i, path) == t for i, t in zip(ids, texts, strict=True)]
        sizes = np.array([0 if i is None else len(i) for i in ids])
        ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32), mask=np.array([i is None for i in ids] + [False]))
        flat = np.concatenate([np.empty(0, np.int32), *(i for i in ids if i is not None)])
        return pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(ends, pa.array(flat, pa.int32())), pa.array(sizes, pa.int64()), pa.array(same)],
                                          names=["doc_id", "ids", "n_pieces", "lossless"])

    df = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    return map_batches(df, run, SCHEMA, rows=2048, bytes_=3 << 18)


def decoded(rows: DataFrame, path: str = MODEL, ids_col: str = "ids") -> DataFrame:
    """The rows with a column ``text`` decoded from their piece ids, in place of any of that name."""
    keep = [c for c in rows.columns if c != "text"]
    at = keep.index(ids_col)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keep).schema) + ", text string"

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        text = pa.array([decode(i, path) for i in batch.column(at).to_pylist()], pa.string())
        return pa.RecordBatch.from_arrays([*batch.columns, text], names=[*keep, "text"])

    return map_batches(rows.select(*keep), run, schema)


def op3_sentencepiece(spark, sf_dir: str) -> DataFrame:
    return encoded(table(spark, sf_dir, "documents"))
