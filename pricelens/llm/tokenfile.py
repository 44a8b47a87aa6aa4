"""Token-id files: a shared zstandard dictionary, one compressed frame a document, an offset index in every file.

A file holds, little-endian throughout:

    header   magic, SHA-256 of the dictionary, bytes of one id
    frames   one zstandard frame for each document: its ids
    index    ids of the documents (int64), whether they are null (uint8), numbers of tokens (uint64), frame offsets (uint64, one more)
    footer   place of the index, documents, tokens, magic

so one document is read by its index entry and its own frame alone.
"""

from __future__ import annotations

import codecs
import hashlib
import re
import string
import struct
import sys
import uuid
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import zstandard
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricelens.llm.common import materialize, partitions
from pricelens.llm.sampling import few
from pricelens.session import shared_path

MAGIC = b"TOKIDS01"
HEADER = struct.Struct("<8s32sI")
FOOTER = struct.Struct("<QQQ8s")
CACHE_PIECES = 400_000  # pieces and pre-tokens a Python worker remembers, and as many older ones; a string that is both has the same ids as either
BLOCK_BYTES = 16_000_000  # of text that are encoded together, one text at least
LATIN_END = chr(0x250)
#: A piece is a run of these with the word after it: the tokenizer file never merges across its left end.
BLANK = re.compile(r"[ \t\n\r]")
#: Pre-tokens and byte alphabet of the tokenizer file, fixed values.
PRETOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
MARKS = string.punctuation
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
#: Blanks other than BLANK, before which a boundary is not certain.
OTHER_BLANKS = "[" + "".join(map(chr, (0x0B, 0x0C, *range(0x1C, 0x20), 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))) + "]"


class Encoder:
    """Token ids of whole texts by a byte-level tokenizer file, remembered by piece and pre-token.

    A piece's pre-tokens are merged by the file's model. Pieces with other than Latin letters, texts with other blanks than
    space, tab and line ends, and texts with the string of an added token go through the whole tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.code, self.dtype = ("H", np.dtype("<u2")) if self.whole.get_vocab_size() <= 1 << 16 else ("I", np.dtype("<u4"))
        self.added = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.unsure = re.compile("|".join([OTHER_BLANKS, *map(re.escape, self.added)]))
        self.by_piece = not any(BLANK.search(a) for a in self.added)  # else such a token may lie across pieces
        rest = iter(range(256, 512))
        self.letters = "".join(chr(b if b in PRINTABLE else next(rest)) for b in range(256))
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}  # what was known before; what is met again comes back

    def pack(self, ids: list[int]) -> bytes:
        return np.array(ids, dtype=self.dtype).tobytes()

    def encode(self, text: str | None) -> bytes:
        """The ids of one text, packed as ``dtype``."""
        return self.encode_column(pa.array([text], pa.string()))[0]

    def encode_column(self, texts: pa.Array) -> list[bytes]:
        """The ids of every text of an Arrow column, packed as ``dtype``; null is the empty text. Each distinct piece is looked up once."""
        texts = texts.cast(pa.large_string()).fill_null("")
        if not self.by_piece:
            return [self._whole(t) for t in texts.to_pylist()]
        at = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
        if not len(texts) or at[0] == at[-1]:
            return [b""] * len(texts)
        data = np.frombuffer(texts.buffers()[2], dtype=np.uint8)[at[0]:at[-1]]
        at = at - at[0]
        blank = (data == 32) | (data == 10) | (data == 9) | (data == 13)
        begins = blank.copy()
        begins[1:] &= ~blank[:-1]
        begins[at[:-1][at[:-1] < len(data)]] = True
        starts = np.flatnonzero(begins)
        ends = np.append(starts, len(data)).astype(np.int64)
        words = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(data)]).dictionary_encode()
        which, found = words.indices, self._ids(words.dictionary.to_numpy(zero_copy_only=False).tolist())
        ids = pa.array(found, pa.large_binary()).take(which)
        joined, places = ids.buffers()[2], np.frombuffer(ids.buffers()[1], dtype=np.int64)[ids.offset:ids.offset + len(ids) + 1]
        joined = joined.to_pybytes() if joined else b""
        cuts = places[np.searchsorted(starts, at)].tolist()
        out = [joined[a:b] for a, b in zip(cuts, cuts[1:])]
        if None in found:
            unsure = starts[np.array([x is None for x in found])[which.to_numpy()]]
            for i in np.unique(np.searchsorted(at[:-1], unsure, "right") - 1).tolist():
                out[i] = self._whole(texts[i].as_py())
        return out

    def _ids(self, words: list[str]) -> list[bytes | None]:
        """The ids of distinct pieces; None where they depend on more of the text."""
        if len(self.known) > CACHE_PIECES:
            self.older, self.known = self.known, {}
        known, older = self.known, self.older
        sure = not self.unsure.search("".join(words))
        out = list(map(known.get, words))
        for i, ids in enumerate(out):
            if ids is None:
                p = words[i]
                if (ids := known.get(p) or older.get(p)) is not None:
                    known[p] = out[i] = ids
                elif sure or not self.unsure.search(p):
                    out[i] = self._piece(p)
        return out

    def _piece(self, piece: str) -> bytes:
        if not piece.isascii() and max(piece) >= LATIN_END:
            out = self.known[piece] = self._whole(piece)
            return out
        word = piece.rstrip(MARKS)
        if word[:1] == " " and word[1:].isalpha():
            tail = piece[len(word):]
            if not tail:
                return self._pretoken(piece)
            parts = [word, tail]
        else:
            parts = PRETOKEN.findall(piece)
        out = b"".join([self.known.get(p) or self.older.get(p) or self._pretoken(p) for p in parts])
        self.known[piece] = out
        return out

    def _pretoken(self, p: str) -> bytes:
        letters = codecs.charmap_decode(p.encode(), "strict", self.letters)[0]
        got = array(self.code, [t.id for t in self.model.tokenize(letters)])
        if sys.byteorder == "big":
            got.byteswap()
        out = self.known[p] = got.tobytes()
        return out

    def _whole(self, text: str) -> bytes:
        return self.pack(self.whole.encode(text, add_special_tokens=False).ids)


@cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


def blocks(batches: Iterator[pa.RecordBatch], text: int = 1) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``BLOCK_BYTES`` of the column ``text``."""
    for b in batches:
        size = np.cumsum(pc.fill_null(pc.binary_length(b.column(text)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        cuts = np.flatnonzero(np.diff(size // BLOCK_BYTES)) + 1
        for i, j in zip([0, *cuts.tolist()], [*cuts.tolist(), b.num_rows]):
            if i < j:
                yield b.slice(i, j - i)


def open_uri(uri: str) -> tuple[arrow_fs.FileSystem, str]:
    """File system and path of a file in the shared folder, as the executors see it."""
    return arrow_fs.FileSystem.from_uri(uri)


def train_dictionary(samples: list[bytes], size: int) -> bytes:
    """Dictionary of about ``size`` bytes; the samples' own last bytes where they are too few to train on."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[-size:]


def compressor(dictionary: bytes, level: int) -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=level, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)


class ShardWriter:
    """One file in the making; only the index is held in memory."""

    def __init__(self, uri: str, dictionary: bytes, id_bytes: int):
        self.uri = uri
        fs, path = open_uri(uri)
        self.out = fs.open_output_stream(path)
        self.out.write(HEADER.pack(MAGIC, hashlib.sha256(dictionary).digest(), id_bytes))
        self.ids: list[int | None] = []
        self.tokens: list[int] = []
        self.offsets = [HEADER.size]

    def add(self, doc_id: int | None, n: int, frame: bytes) -> None:
        self.out.write(frame)
        self.ids.append(doc_id)
        self.tokens.append(n)
        self.offsets.append(self.offsets[-1] + len(frame))

    def close(self) -> None:
        at = self.offsets[-1]
        for values, kind in (([i or 0 for i in self.ids], "<i8"), ([i is None for i in self.ids], "u1"), (self.tokens, "<u8"), (self.offsets, "<u8")):
            self.out.write(np.array(values, dtype=kind).tobytes())
        self.out.write(FOOTER.pack(at, len(self.ids), sum(self.tokens), MAGIC))
        self.out.close()


class Shard:
    """A file opened for reading: whole, or one document by its index entry."""

    def __init__(self, uri: str, dictionary: bytes):
        fs, path = open_uri(uri)
        self.file = fs.open_input_file(path)
        size = self.file.size()
        magic, digest, id_bytes = HEADER.unpack(self.file.read_at(HEADER.size, 0))
        at, n, self.total, end = FOOTER.unpack(self.file.read_at(FOOTER.size, size - FOOTER.size))
        if magic != MAGIC or end != MAGIC:
            raise ValueError(f"{uri} is not a whole token-id file")
        if digest != hashlib.sha256(dictionary).digest():
            raise ValueError(f"{uri} was written with another dictionary")
        self.dtype = np.dtype(f"<u{id_bytes}")
        index = self.file.read_at(size - FOOTER.size - at, at)
        self.doc_ids = np.frombuffer(index, "<i8", n)
        self.null = np.frombuffer(index, "u1", n, 8 * n).astype(bool)
        self.tokens = np.frombuffer(index, "<u8", n, 9 * n).astype(np.int64)
        self.offsets = np.frombuffer(index, "<u8", n + 1, 17 * n).astype(np.int64)
        self.starts = np.cumsum(self.tokens) - self.tokens
        self.decompressor = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)

    def _ids(self, k: int, frame: bytes) -> np.ndarray:
        ids = np.frombuffer(self.decompressor.decompress(frame), dtype=self.dtype)
        if len(ids) != self.tokens[k]:
            raise ValueError("a frame has another number of tokens than its index entry")
        return ids

    def document(self, k: int) -> np.ndarray:
        """Ids of the ``k``-th document, reading its frame only."""
        return self._ids(k, self.file.read_at(int(self.offsets[k + 1] - self.offsets[k]), int(self.offsets[k])))

    def find(self, doc_id: int) -> list[int]:
        """Places of the documents with this id, by binary search (null ids come first)."""
        nulls = int(self.null.sum())
        low, high = (nulls + int(np.searchsorted(self.doc_ids[nulls:], doc_id, side)) for side in ("left", "right"))
        return list(range(low, high))

    def documents(self, block: int = 4_000_000) -> Iterator[tuple[int, np.ndarray]]:
        """(place, ids) of all documents in order, reading about ``block`` bytes at a time."""
        k, n = 0, len(self.tokens)
        while k < n:
            end = max(k + 1, int(np.searchsorted(self.offsets, self.offsets[k] + block, "right")) - 1)
            at = int(self.offsets[k])
            data = self.file.read_at(int(self.offsets[end]) - at, at)
            for i in range(k, end):
                yield i, self._ids(i, data[self.offsets[i] - at:self.offsets[i + 1] - at])
            k = end


def write_tokens(docs: DataFrame, tokenizer_path: str, end_id: int = 2, dictionary_bytes: int = 32_768, sample_docs: int = 1_000, sample_chars: int = 16_384,
                 shard_bytes: int = 64_000_000, level: int = 3, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, bytes]:
    """Write the ids of every whole text, and ``end_id`` after each, to token-id files in ascending order of the ids.

    Returns the list of files ``(path, part, shard, documents, tokens)`` and the dictionary that they share, which is also
    stored beside them under its hash. The dictionary is trained on the serialized ids of at most ``sample_docs`` texts of at
    most ``sample_chars`` characters, chosen by a hash: a bound that only the sizes of files depend on.

    Documents are range-partitioned and sorted by id; each task encodes and compresses its texts one by one, and begins
    a new file after ``shard_bytes``. Files have names of their own, and only those of committed tasks come into the list, which Spark
    writes: what a lost or repeated task left behind is not read. Null and empty texts are the end id alone. Null ids
    come first; rows that repeat an id are documents of their own, in the order of a hash of their texts. Very long texts are one
    frame. An empty table gives an empty list. Other columns are not looked at.
    """
    spark = docs.sparkSession
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    root = shared_path(spark, f"llm-tokens-{uuid.uuid4().hex}")
    end = encoder(tokenizer_path).pack([end_id])
    fs, path = open_uri(root)
    fs.create_dir(path, recursive=True)

    def serialized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path)
        for b in blocks(batches):
            yield pa.RecordBatch.from_arrays([pa.array([ids + end for ids in enc.encode_column(b.column(1))], pa.binary())], names=["ids"])

    sample = few(src.where(F.length("text") <= sample_chars), sample_docs, ["doc_id", "text"])
    samples = sorted(bytes(r["ids"]) for r in sample.mapInArrow(serialized, "ids binary").collect())
    dictionary = train_dictionary(samples, dictionary_bytes)
    with fs.open_output_stream(f"{path}/dictionary-{hashlib.sha256(dictionary).hexdigest()}") as out:
        out.write(dictionary)
    shared = spark.sparkContext.broadcast(dictionary)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, zstd = encoder(tokenizer_path), compressor(shared.value, level)
        part, attempt, shard, w = TaskContext.get().partitionId(), uuid.uuid4().hex, 0, None

        def listed(w: ShardWriter) -> pa.RecordBatch:
            w.close()
            return pa.RecordBatch.from_pylist([{"path": w.uri, "part": part, "shard": shard, "documents": len(w.ids), "tokens": sum(w.tokens)}], schema=schema)

        schema = pa.schema([("path", pa.string()), ("part", pa.int32()), ("shard", pa.int32()), ("documents", pa.int64()), ("tokens", pa.int64())])
        for b in blocks(batches):
            for doc_id, ids in zip(b.column(0).to_pylist(), enc.encode_column(b.column(1))):
                ids += end
                w = w or ShardWriter(f"{root}/part-{part:06d}-{shard:05d}-{attempt}.tok", shared.value, enc.dtype.itemsize)
                w.add(doc_id, len(ids) // enc.dtype.itemsize, zstd.compress(ids))
                if w.offsets[-1] >= shard_bytes:
                    yield listed(w)
                    shard, w = shard + 1, None
        if w:
            yield listed(w)

    order = ["doc_id", F.xxhash64("text")]
    ranged = src.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
    return materialize(ranged.mapInArrow(write, "path string, part int, shard int, documents long, tokens long"), "token-files"), dictionary


def read_tokens(files: DataFrame, dictionary: bytes, id_bytes: int = 4) -> DataFrame:
    """``(doc_id, start, ids)`` of every document in the listed files: the number of ids before it and its own ids.

    ``ids`` are packed little-endian unsigned integers of ``id_bytes`` each. Files are opened by the tasks and checked against the
    dictionary's hash. What meets in one task to number the files is one row for each task that wrote them.
    """
    spark = files.sparkSession
    shared = spark.sparkContext.broadcast(dictionary)
    earlier = (Window.unboundedPreceding, -1)
    parts = files.groupBy("part").agg(F.sum("tokens").alias("n"))
    parts = parts.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(*earlier)), F.lit(0)).alias("before"))
    inside = F.coalesce(F.sum("tokens").over(Window.partitionBy("part").orderBy("shard").rowsBetween(*earlier)), F.lit(0))
    placed = files.withColumn("inside", inside).join(parts, "part").select("path", (F.col("before") + F.col("inside")).alias("before"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, before in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                shard, rows, size = Shard(path, shared.value), [], 0
                for k, ids in shard.documents():
                    rows.append((None if shard.null[k] else int(shard.doc_ids[k]), before + int(shard.starts[k]), ids.astype(f"<u{id_bytes}").tobytes()))
                    size += len(rows[-1][2])
                    if size >= 8_000_000:
                        yield batch(rows)
                        rows, size = [], 0
                if rows:
                    yield batch(rows)

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.binary()))], names=["doc_id", "start", "ids"])

    return placed.repartition(partitions(spark), "path").mapInArrow(read, "doc_id long, start long, ids binary")
