"""Token ids in binary shards: one wavelet matrix per file.

Texts are encoded with a tokenizer of the ``tokenizers`` library, each followed by an end id, in ascending order of doc_id,
and written as shard files. A file holds a header, the documents' ids and lengths, and the bit planes of the shard's wavelet
matrix in chunks, each compressed by itself, with the number of ones before each chunk. So a reader can look up a token,
count an id or list its places (``Shard``) by unpacking only the chunks that it touches, or unpack all planes back into the ids.

Files are written by Spark's text writer, one record per file (the closing line feed is beyond the declared length), and
read as binary files, so any file system that Spark writes to will do. Rows are dealt by ranges of (doc_id, hash of the
text, row), so neither one doc_id nor copies of one row fall to one task. A shard ends with the document that fills
it; positions over all shards come from the totals of the partitions that wrote them.

Encoding: where the pre-tokenizer is the byte-level one without a prefix space or normalizer, no token crosses the place before a
single space, or around a single line feed, between characters that are no white space, nor that between two ASCII characters
of different kinds (letters, digits, marks), except from an apostrophe to a letter. So a text is cut there, but at no pair of
characters that an added token contains, and each distinct unit encoded once. A unit of a space at most and Latin letters is one
word of the pre-tokenizer and goes to the tokenizer's model directly. Other tokenizers get whole texts. The strings of special tokens in a text become their ids.

Defined cases: null texts are empty and yield the end id alone; a null doc_id comes first; rows of one doc_id are ordered by the
hash of their texts; an empty table writes no shard and reads as no rows; other columns are ignored; doc_ids are integers.
"""

from __future__ import annotations

import functools
import itertools
import json
import os
import re
import struct
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from greenlane.llm.common import shared_path, slices, table, written
from greenlane.llm.wavelet import Plane, WaveletMatrix
from greenlane.operators.joins import lookup_join

MAGIC, VERSION = b"GLTB", 1
#: A shard is closed by the document that brings it to so many ids.
SHARD_TOKENS = 1 << 21
#: Words of 64 bits per compressed chunk of a plane.
CHUNK_WORDS = 1 << 12
CHUNK_BITS = 64 * CHUNK_WORDS
#: Distinct units kept encoded in a worker, twice: those since the last turn, and those before.
UNITS_KEPT = 400_000
#: New units per call of the tokenizer.
AT_ONCE = 1024
#: Texts are encoded in batches of up to so many rows and, unless of one row, bytes.
BATCH_ROWS, BATCH_BYTES = 8192, 8 << 20
LEVEL = 1
HEAD = struct.Struct("<4sHHQ")  # magic, version, unused, bytes of the JSON that follows


# --- encoding ----------------------------------------------------------------------------------


class Encoder:
    """Texts to ids by one tokenizer file, distinct units once."""

    def __init__(self, content: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core; threads would only spin
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_buffer(content)
        spec = json.loads(content)
        first, added = spec.get("pre_tokenizer") or {}, spec.get("added_tokens", [])
        special = any(re.search(r"\s", t["content"]) or t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in added)
        self.cuts = first.get("type") == "ByteLevel" and not first.get("add_prefix_space") and first.get("use_regex", True) and not spec.get("normalizer") and not special
        self.pairs = cut_pairs([t["content"] for t in added])
        #: no added token hides in a unit of letters
        self.direct = self.cuts and not any(t["content"].isalpha() for t in added) and not spec.get("truncation") and not spec.get("padding")
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def fresh(self, units: list[str]) -> list[bytes]:
        """The ids of each unit, little-endian; those of letters by the model alone, the rest as the words of one call, where each id names its word."""
        if self.direct:
            words, tokens = list(filter(_WORD, units)), self.tokenizer.model.tokenize
            mapped = _BYTE_LEVEL[np.frombuffer("\n".join(words).encode(), np.uint8)].tobytes().decode("utf-32-le").split("\n") if words else []
            pieces = list(map(tokens, mapped))
            flat, ends = array("I", [t.id for p in pieces for t in p]).tobytes(), itertools.accumulate(map(len, pieces), initial=0)
            found = {u: flat[4 * a: 4 * b] for u, (a, b) in zip(words, itertools.pairwise(ends), strict=True)}
            rest = [u for u in units if u not in found]
            if rest:
                found |= zip(rest, self.whole(rest), strict=True)
            return list(map(found.__getitem__, units))
        return self.whole(units)

    def whole(self, units: list[str]) -> list[bytes]:
        """The ids of each unit by pre-tokenizer and model."""
        if self.cuts:
            one = self.tokenizer.encode(units, is_pretokenized=True, add_special_tokens=False)
            words = np.array(one.word_ids, float)  # a missing word is nan
            if len(words) and not np.isnan(words).any():
                ends = 4 * np.concatenate([[0], np.cumsum(np.bincount(words.astype(np.int64), minlength=len(units)))])
                flat = np.array(one.ids, "<u4").tobytes()
                return [flat[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(units, add_special_tokens=False)]

    def encoded(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in order, and where each text's begin (and the last ends)."""
        units, starts = cut_units(texts.cast(pa.large_binary()), self.cuts, self.pairs)
        units = units.dictionary_encode()
        distinct = unit_bytes(units.dictionary)
        found = list(map(self.known.get, distinct))
        for k in [k for k, ids in enumerate(found) if ids is None]:
            if (ids := self.older.get(distinct[k])) is not None:
                self.known[distinct[k]] = found[k] = ids
        new = [k for k, ids in enumerate(found) if ids is None]
        for at in range(0, len(new), AT_ONCE):
            part = new[at: at + AT_ONCE]
            for k, ids in zip(part, self.fresh([distinct[k].decode() for k in part]), strict=True):
                self.known[distinct[k]] = found[k] = ids
        if len(self.known) > UNITS_KEPT:  # what is looked up again moves over, the rest is forgotten at the next turn
            self.older, self.known = self.known, {}
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        flat, begins = np.frombuffer(b"".join(found), "<u4"), np.concatenate([[0], np.cumsum(sizes)])
        which = units.indices.to_numpy()
        ends = np.concatenate([[0], np.cumsum(sizes[which])])
        at = np.repeat(begins[which] - ends[:-1], sizes[which]) + np.arange(ends[-1])
        return flat[at], ends[starts]


_WHITE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
#: First bytes of the characters among which the other kinds of white space are.
_MAYBE_WHITE = np.isin(np.arange(256), [0xC2, 0xE1, 0xE2, 0xE3])
#: ASCII letters, digits and marks; white space, control characters and others are 0.
_KIND = np.array([0 if b < 33 or b > 126 else 1 if chr(b).isalpha() else 2 if chr(b).isdigit() else 3 for b in range(256)])
#: A space at most and Latin letters.
_WORD = re.compile("[ ]?[A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+").fullmatch
#: The byte-level characters of bytes; a line feed stays and separates words.
_SHOWN = np.isin(np.arange(256), [*range(33, 127), *range(161, 173), *range(174, 256)])
_BYTE_LEVEL = np.where(_SHOWN, np.arange(256), 255 + np.cumsum(~_SHOWN)).astype("<u4")
_BYTE_LEVEL[10] = 10


def cut_pairs(added: list[str]) -> np.ndarray:
    """Whether a text may be cut between two bytes, at 256 * first + second: of different kinds, and neighbours in no added token."""
    pairs = (_KIND[:, None] != _KIND) & (_KIND[:, None] > 0) & (_KIND > 0)
    pairs[ord("'"), _KIND == 1] = False  # the pre-tokenizer keeps endings such as 's
    for token in map(str.encode, added):
        pairs[list(token[:-1]), list(token[1:])] = False
    return pairs.ravel()


PAIRS = cut_pairs([])


def cut_units(texts: pa.Array, cuts: bool, pairs: np.ndarray = PAIRS) -> tuple[pa.Array, np.ndarray]:
    """The units of all texts, and the number of the first unit of each text (and the end).

    Cut before a space and around a line feed with no white space next to it, and between the bytes of ``pairs``.
    """
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset: texts.offset + len(texts) + 1]
    size, buffer = int(offsets[-1] - offsets[0]), texts.buffers()[2]
    data = np.frombuffer(buffer, np.uint8)[offsets[0]: offsets[-1]] if size else np.zeros(0, np.uint8)
    ends = offsets - offsets[0]
    first = np.zeros(size + 1, bool)
    if cuts and size:
        padded = np.concatenate([np.full(3, 32, np.uint8), data, np.full(1, 32, np.uint8)])  # data[i] is padded[i + 3]
        at = np.flatnonzero((data == 32) | (data == 10))
        before, after = padded[at + 2], padded[at + 4]
        wide = _MAYBE_WHITE[padded[at + 1]] | (padded[at + 1] >> 6 == 2) & _MAYBE_WHITE[padded[at]]
        edge = np.zeros(size + 1, bool)
        edge[ends] = True
        at = at[~(_WHITE[before] | (before >= 128) & wide | _WHITE[after] | _MAYBE_WHITE[after] | edge[at] | edge[at + 1])]
        first[at] = True
        first[at[data[at] == 10] + 1] = True
        first[1:-1] |= pairs[data[:-1].astype(np.uint16) << 8 | data[1:]]
    first[ends] = True
    places = np.flatnonzero(first)
    units = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(places) - 1, [None, pa.py_buffer(places), pa.py_buffer(data)]) if size else pa.array([], pa.large_binary())
    return units, np.searchsorted(places, ends)


def unit_bytes(units: pa.LargeBinaryArray) -> list[bytes]:
    """The units as bytes, cut from one copy: Arrow makes a scalar of each on the way to a list."""
    if not len(units):
        return []
    offsets = np.frombuffer(units.buffers()[1], np.int64)[units.offset: units.offset + len(units) + 1].tolist()
    data = units.buffers()[2].to_pybytes()
    return [data[a:b] for a, b in itertools.pairwise(offsets)]


@functools.lru_cache(2)
def encoder(content: bytes) -> Encoder:
    return Encoder(content)


# --- one file ----------------------------------------------------------------------------------


def packed(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray, part: int, seq: int, before: int) -> bytes:
    """A shard file: header, sections (document table, then the chunks of each plane), in the order of the header's sizes."""
    squeeze = zstandard.ZstdCompressor(level=LEVEL).compress
    matrix = WaveletMatrix.of(ids)
    docs = pa.table({"doc_id": pa.array(doc_ids, pa.int64()), "n": pa.array(lengths, pa.int64())})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, docs.schema) as writer:
        writer.write_table(docs)
    sections, planes = [squeeze(sink.getvalue().to_pybytes())], []
    for plane in matrix.planes:
        words, sizes, ones = plane.words[:-1], [], []
        for at in range(0, len(words), CHUNK_WORDS):
            sections.append(squeeze(words[at: at + CHUNK_WORDS].tobytes()))
            sizes.append(len(sections[-1]))
            ones.append(int(plane.before[at]))
        planes.append({"sizes": sizes, "before": ones, "ones": plane.ones})
    head = json.dumps({"part": part, "seq": seq, "before": before, "docs": len(doc_ids), "tokens": len(ids), "doc_table": len(sections[0]), "planes": planes}).encode()
    return b"".join([HEAD.pack(MAGIC, VERSION, 0, len(head)), head, *sections])


class StoredPlane(Plane):
    """A plane whose chunks are unpacked when they are touched."""

    def __init__(self, data: memoryview, start: int, spec: dict, size: int):
        self.size, self.ones, self.data = size, spec["ones"], data
        self.starts = start + np.concatenate([[0], np.cumsum(spec["sizes"], dtype=np.int64)])
        self.chunk_before = np.array(spec["before"], np.int64)
        self.loaded: dict[int, Plane] = {}

    def chunk(self, k: int) -> Plane:
        if k not in self.loaded:
            raw = zstandard.ZstdDecompressor().decompress(self.data[self.starts[k]: self.starts[k + 1]])
            self.loaded[k] = Plane(np.frombuffer(raw, "<u8"), min(CHUNK_BITS, self.size - k * CHUNK_BITS))
        return self.loaded[k]

    def bits(self) -> np.ndarray:
        return np.concatenate([self.chunk(k).bits() for k in range(len(self.chunk_before))] or [np.zeros(0, np.uint8)])

    def by_chunk(self, chunks: np.ndarray, read: Callable[[int, np.ndarray], np.ndarray]) -> np.ndarray:
        out = np.zeros(len(chunks), np.int64)
        for k in np.unique(chunks):
            mine = np.flatnonzero(chunks == k)
            out[mine] = read(int(k), mine)
        return out

    def get(self, at: np.ndarray) -> np.ndarray:
        return self.by_chunk(at // CHUNK_BITS, lambda k, m: self.chunk(k).get(at[m] % CHUNK_BITS))

    def rank(self, at: np.ndarray) -> np.ndarray:
        if not len(self.chunk_before):
            return np.zeros(len(at), np.int64)
        chunks = np.minimum(at // CHUNK_BITS, len(self.chunk_before) - 1)  # the end of the plane is the end of its last chunk
        return self.by_chunk(chunks, lambda k, m: self.chunk_before[k] + self.chunk(k).rank(at[m] - k * CHUNK_BITS))

    def select(self, bit: int, k: np.ndarray) -> np.ndarray:
        count = self.chunk_before if bit else np.arange(len(self.chunk_before)) * CHUNK_BITS - self.chunk_before
        chunks = np.searchsorted(count, k, side="right") - 1
        return self.by_chunk(chunks, lambda c, m: c * CHUNK_BITS + self.chunk(c).select(bit, k[m] - count[c]))


class Shard:
    """A shard file opened for look-ups; chunks are unpacked as they are needed."""

    def __init__(self, content: bytes):
        data = memoryview(content)
        magic, version, _, size = HEAD.unpack_from(data)
        if magic != MAGIC or version != VERSION:
            raise ValueError("not a token shard of this version")
        self.head = json.loads(bytes(data[HEAD.size: HEAD.size + size]))
        at = HEAD.size + size
        docs = pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(data[at: at + self.head["doc_table"]])).read_all()
        at += self.head["doc_table"]
        self.doc_ids, self.lengths = docs.column("doc_id").to_pylist(), docs.column("n").to_numpy()
        self.starts = np.concatenate([[0], np.cumsum(self.lengths, dtype=np.int64)])
        planes = []
        for spec in self.head["planes"]:
            planes.append(StoredPlane(data, at, spec, self.head["tokens"]))
            at += sum(spec["sizes"])
        if at > len(data):
            raise ValueError("the shard ends early")
        self.matrix = WaveletMatrix(planes, self.head["tokens"])

    def ids(self) -> np.ndarray:
        """All ids, in order."""
        return self.matrix.values()

    def token(self, places: list[int]) -> list[int]:
        return self.matrix.access(np.array(places, np.int64)).tolist()

    def count(self, ids: list[int]) -> list[int]:
        return self.matrix.count(np.array(ids, np.int64)).tolist()

    def places(self, token: int) -> np.ndarray:
        return self.matrix.occurrences(token)


# --- Spark -------------------------------------------------------------------------------------


def write_shards(docs: DataFrame, path: str, tokenizer: str, end_id: int, shard_tokens: int = SHARD_TOKENS) -> None:
    """Encode ``docs`` with the tokenizer file and write shard files to ``path``; the file is read on the driver and sent along."""
    with open(tokenizer, "rb") as f:
        content = docs.sparkSession.sparkContext.broadcast(f.read())
    end = np.array([end_id], "<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, part = encoder(content.value).encoded, TaskContext.get().partitionId()
        seq, before, doc_ids, lengths, ids, full = 0, 0, [], [], [], 0

        def closed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([packed(doc_ids, lengths, np.concatenate(ids), part, seq, before)], pa.binary())], names=["value"])

        for batch in batches:
            for rows in slices(batch, BATCH_ROWS, BATCH_BYTES):
                found, cuts = encode(rows.column("text"))
                for doc_id, a, b in zip(rows.column("doc_id").to_pylist(), cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                    doc_ids.append(doc_id)
                    lengths.append(b - a + 1)
                    ids += [found[a:b], end]
                    full += lengths[-1]
                    if full >= shard_tokens:
                        yield closed()
                        seq, before, doc_ids, lengths, ids, full = seq + 1, before + full, [], [], [], 0
        if doc_ids:
            yield closed()

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"))
    order = [F.col("doc_id"), F.xxhash64("text").alias("tie"), F.monotonically_increasing_id().alias("row")]
    dealt = rows.select("text", *order).repartitionByRange("doc_id", "tie", "row").sortWithinPartitions("doc_id", "tie", "text").select("doc_id", "text")
    shards = dealt.mapInArrow(run, "value binary").select(F.col("value").cast("string").alias("value"))
    shards.write.option("maxRecordsPerFile", 1).option("compression", "none").text(path)


def shard_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).filter("length > 0").select("content")


def each_shard(spark: SparkSession, path: str, read: Callable[[Shard], pa.RecordBatch], schema: str) -> DataFrame:
    """The rows that ``read`` gives for each shard file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                yield read(Shard(content.as_py()))

    return shard_files(spark, path).mapInArrow(run, schema)


def with_starts(rows: DataFrame, totals: DataFrame) -> DataFrame:
    """Rows of ``each_shard`` (part, local, ..) with ``start``: ``local`` after all ids of the partitions before ``part``.

    ``totals`` has the ids of each writing partition, as many rows as these.
    """
    from pyspark.sql import Window

    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = written(totals.select("part", F.coalesce(F.sum("tokens").over(ahead), F.lit(0)).alias("base")), "token-parts")
    return lookup_join(rows, bases, "part").withColumn("start", F.col("local") + F.col("base")).drop("part", "local", "base")


def read_totals(spark: SparkSession, path: str) -> DataFrame:
    """(part, tokens): ids written by each partition."""
    def read(shard: Shard) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"part": pa.array([shard.head["part"]], pa.int32()), "tokens": pa.array([shard.head["tokens"]], pa.int64())})

    return each_shard(spark, path, read, "part int, tokens long").groupBy("part").agg(F.sum("tokens").alias("tokens"))


def read_documents(spark: SparkSession, path: str, ids: bool = True) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 and, unless left out, the ids of each document."""
    def read(shard: Shard) -> pa.RecordBatch:
        all_, n, head = shard.ids().astype("<u4", copy=False), len(shard.doc_ids), shard.head
        cuts = list(zip(shard.starts[:-1], shard.starts[1:], strict=True))
        columns = {"part": pa.array([head["part"]] * n, pa.int32()), "local": pa.array(head["before"] + shard.starts[:-1], pa.int64()), "doc_id": pa.array(shard.doc_ids, pa.int64()),
                   "n_tokens": pa.array(shard.lengths, pa.int64()), "ids_crc32": pa.array([zlib.crc32(all_[a:b]) for a, b in cuts], pa.int64())}
        if ids:
            columns["ids"] = pa.ListArray.from_arrays(pa.array(shard.starts, pa.int32()), pa.array(all_.astype(np.int64)))
        return pa.RecordBatch.from_pydict(columns)

    schema = "part int, local long, doc_id long, n_tokens long, ids_crc32 long" + (", ids array<bigint>" if ids else "")
    rows = each_shard(spark, path, read, schema)
    rows = rows if ids else written(rows, "token-rows")
    totals = read_totals(spark, path) if ids else rows.groupBy("part").agg(F.sum("n_tokens").alias("tokens"))
    return with_starts(rows, totals).select("doc_id", "start", "n_tokens", "ids_crc32", *(["ids"] if ids else []))


def count_ids(spark: SparkSession, path: str, ids: list[int]) -> DataFrame:
    """(id, n): how often each id occurs, by ranks in each shard."""
    def read(shard: Shard) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"id": pa.array(ids, pa.int64()), "n": pa.array(shard.count(ids), pa.int64())})

    return each_shard(spark, path, read, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def find_id(spark: SparkSession, path: str, token: int) -> DataFrame:
    """(doc_id, start): every place of an id over all shards, by selects in each shard."""
    def read(shard: Shard) -> pa.RecordBatch:
        at = shard.places(token)
        of = np.searchsorted(shard.starts, at, side="right") - 1
        return pa.RecordBatch.from_pydict({"part": pa.array([shard.head["part"]] * len(at), pa.int32()), "local": pa.array(shard.head["before"] + at, pa.int64()),
                                           "doc_id": pa.array([shard.doc_ids[d] for d in of], pa.int64())})

    return with_starts(each_shard(spark, path, read, "part int, local long, doc_id long"), read_totals(spark, path)).select("doc_id", "start")


TOKENIZER, END_ID = "byte_bpe_50k.json", 2


def op13_token_shards(spark, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path(TOKENIZER)
    path = shared_path(spark, "token-shards")
    write_shards(table(spark, sf_dir, "documents"), path, str(tokenizer), END_ID)
    return read_documents(spark, path, ids=False)
