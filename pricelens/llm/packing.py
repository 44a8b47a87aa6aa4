"""Best-fit packing: patterns by non-negative least squares, then best fit for what is left."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
import unicodedata
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricelens.llm.common import materialize

CACHE_WORDS = 400_000  # words and pre-tokens a Python worker remembers
#: Pre-tokens and byte alphabet of the tokenizer file, fixed values.
PRETOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]


class Encoder:
    """Token ids of whole texts as packed little-endian unsigned 32-bit ids, remembered by word.

    Blanks end a token, so a text's ids are those of its words in order. A word's pre-tokens are merged by the file's
    model; words that are not plain Latin letters, or texts with the strings of special tokens, go through the whole
    tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        rest = iter(range(256, 512))
        self.letters = {b: chr(b if b in PRINTABLE else next(rest)) for b in range(256)}
        self.words: dict[str, bytes] = {}
        self.pretokens: dict[str, bytes] = {}

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if "<|" in text:
            return self._whole(text)
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        words, known = text.lower().split(" "), self.words
        try:
            return b"".join([known[w] for w in words])
        except KeyError:
            pass
        if len(known) > CACHE_WORDS:
            known.clear()
        for w in set(words).difference(known):
            known[w] = self._word(w)
        return b"".join([known[w] for w in words])

    def _word(self, word: str) -> bytes:
        if word.isalpha() and max(word) < "ɐ":
            return self._pretoken(word)
        if max(word, default=" ") < "ɐ" and "\x85" not in word and "\xa0" not in word:
            return b"".join([self._pretoken(p) for p in PRETOKEN.findall(word)])
        return self._whole(word)

    def _pretoken(self, p: str) -> bytes:
        got = self.pretokens.get(p)
        if got is None:
            if len(self.pretokens) > CACHE_WORDS:
                self.pretokens.clear()
            letters = self.letters
            got = np.array([t.id for t in self.model.tokenize("".join([letters[b] for b in p.encode()]))], dtype="<u4").tobytes()
            self.pretokens[p] = got
        return got

    def _whole(self, text: str) -> bytes:
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


@cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


def pieces(docs: DataFrame, tokenizer_path: str, size: int = 4096, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text",
           keep: tuple[str, ...] = ()) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32)``: every text's ids and the end id, cut where longer than ``size``; then the columns ``keep`` of its row."""
    end = np.array([end_id], dtype="<u4").tobytes()
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path)
        for b in batches:
            out, rows = [], []
            for row, (doc, t) in enumerate(zip(b.column(0).to_pylist(), b.column(1))):
                ids = enc.encode(t.as_py()) + end
                for k, at in enumerate(range(0, len(ids), 4 * size)):
                    part = ids[at:at + 4 * size]
                    out.append((doc, k, at // 4, len(part) // 4, zlib.crc32(part)))
                    rows.append(row)
            cols = zip(*out) if out else ([] for _ in names)
            cols = [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))]
            yield pa.RecordBatch.from_arrays([*cols, *(c.take(pa.array(rows, pa.int64())) for c in b.columns[2:])], names=[*names, *keep])

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *keep)
    return src.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long" + kept_schema(docs, keep))


def kept_schema(docs: DataFrame, keep: tuple[str, ...]) -> str:
    return "".join(f", `{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)


def patterns(units: int, most: int, present: np.ndarray) -> np.ndarray:
    """Rows of class counts: all ways to add up to ``units`` with at most ``most`` classes that are ``present``."""
    found: list[tuple[int, ...]] = []

    def extend(left: int, top: int, parts: tuple[int, ...]) -> None:
        if left == 0:
            found.append(parts)
        elif len(parts) < most:
            for c in range(min(left, top), max(1, -(-left // (most - len(parts)))) - 1, -1):
                if present[c]:
                    extend(left - c, c, (*parts, c))

    extend(units, units, ())
    out = np.zeros((len(found), units + 1))
    for i, p in enumerate(found):
        np.add.at(out[i], list(p), 1)
    return out


def nnls(a: np.ndarray, b: np.ndarray, rounds: int) -> np.ndarray:
    """min |a x - b| with x >= 0 by the active-set method: the column that helps most enters, columns that would turn negative leave."""
    n = a.shape[1]
    x, inside, target = np.zeros(n), np.zeros(n, dtype=bool), a.T @ b
    for _ in range(rounds if n else 0):
        gain = target - a.T @ (a @ x)
        gain[inside] = -np.inf
        if gain.max() <= 1e-9 * max(1.0, np.abs(target).max()):
            break
        inside[int(gain.argmax())] = True
        while inside.any():
            at = np.flatnonzero(inside)
            own = a[:, at]
            z = np.linalg.solve(own.T @ own + 1e-8 * np.eye(len(at)), target[at])
            down = z <= 1e-9
            if not down.any():
                x[:] = 0
                x[at] = z
                break
            step = np.min(x[at][down] / np.maximum(x[at][down] - z[down], 1e-300))
            x[at] += step * (z - x[at])
            gone = at[down & (x[at] <= 1e-9)]
            x[gone], inside[gone] = 0, False
            if not len(gone):
                break
    return x


Group = tuple[tuple[tuple[int, int], ...], int]  # ((length, copies), ...) in a sequence, number of such sequences


def pack_histogram(histogram: np.ndarray, size: int, grain: int = 32, most: int = 3) -> list[Group]:
    """Groups of equal sequences that hold each piece counted in ``histogram`` (by length, 0..size) once.

    Lengths are put in classes of about ``grain`` tokens, and the patterns of at most ``most`` classes that fill a sequence
    are fitted to the classes' histogram by non-negative least squares. Repeat counts are rounded. Each pattern is then
    carried out with real lengths that fill a sequence to the last token, as often as it should and as there are pieces.
    What is left is packed by best fit, the longest first, many equal pieces at a step. The work depends on the
    sequence size only, not on the number of pieces.
    """
    left = histogram.astype(np.int64).copy()
    units = size // grain
    classes = (np.arange(size + 1) + grain // 2) // grain
    by_class = np.bincount(classes[1:], weights=left[1:], minlength=units + 1)[:units + 1]
    rows = patterns(units, most, by_class > 0)
    repeat = nnls(rows.T.copy(), by_class, 3 * units) if len(rows) else np.zeros(0)
    groups: list[Group] = []
    for i in np.argsort(-repeat, kind="stable"):
        n = round(repeat[i])
        if n <= 0:
            break
        parts = [int(c) for c in np.flatnonzero(rows[i]) for _ in range(int(rows[i][c]))]
        groups += _full(left, [np.flatnonzero(classes == c).tolist() for c in parts[:-1]], n, size)
    return _best_fit(left, size, groups)


def _full(left: np.ndarray, lengths: list[list[int]], n: int, size: int) -> list[Group]:
    """Up to ``n`` sequences filled by one length of each list and a last one that takes just the rest."""
    out: list[Group] = []

    def choose(k: int, parts: tuple[int, ...], rest: int) -> None:
        nonlocal n
        if n <= 0 or rest <= 0 or (parts and not left[parts[-1]]):
            return
        if k < len(lengths):
            for x in lengths[k]:
                if left[x]:
                    choose(k + 1, (*parts, x), rest - x)
            return
        copies: dict[int, int] = {}
        for x in (*parts, rest):
            copies[x] = copies.get(x, 0) + 1
        times = min(n, *(int(left[x]) // c for x, c in copies.items()))
        if times > 0:
            for x, c in copies.items():
                left[x] -= c * times
            n -= times
            out.append((tuple(copies.items()), times))

    choose(0, (), size)
    return out


def _best_fit(left: np.ndarray, size: int, groups: list[Group]) -> list[Group]:
    room: dict[int, list[list]] = {}
    count = np.zeros(size + 1, dtype=np.int64)

    def put(parts: tuple, n: int, space: int) -> None:
        room.setdefault(space, []).append([parts, n])
        count[space] += n

    for parts, n in groups:
        put(parts, n, size - sum(x * k for x, k in parts))
    for x in range(size, 0, -1):
        c = int(left[x])
        while c:
            fits = count[x:].nonzero()[0][:1]
            if not len(fits):
                copies = size // x
                if c >= copies:
                    put(((x, copies),), c // copies, size - copies * x)
                    c %= copies
                if c:
                    put(((x, c),), 1, size - c * x)
                break
            space = x + int(fits[0])
            entry = room[space][-1]
            copies = min(space // x, c)
            n = min(entry[1], c // copies)
            entry[1] -= n
            count[space] -= n
            parts = entry[0]
            if not entry[1]:
                room[space].pop()
            put((*parts, (x, copies)), n, space - copies * x)
            c -= n * copies
    return [(parts, n) for entries in room.values() for parts, n in entries]


def slots(groups: list[Group]) -> dict[str, np.ndarray]:
    """Places by length and rank: the ``first`` ... pieces of a length, ``copies`` to a sequence, from sequence ``base`` at ``offset``."""
    taken: dict[int, int] = {}
    out, base = [], 0
    for parts, n in groups:
        offset = 0
        for x, copies in parts:
            out.append((x, taken.get(x, 0), copies, base, offset))
            taken[x] = taken.get(x, 0) + copies * n
            offset += x * copies
        base += n
    a = np.array(sorted(out), dtype=np.int64).reshape(-1, 5)
    return dict(zip(("length", "first", "copies", "base", "offset"), a.T))


def pack(docs: DataFrame, tokenizer_path: str, size: int = 4096, grain: int = 32, most: int = 3, end_id: int = 1, group_rows: int = 100_000,
         id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Pack all texts into as few sequences of at most ``size`` tokens as can be.

    Returns one row per piece: ``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)``, then the columns ``keep`` of its row. Null and empty texts
    are one piece of the end id. Texts are tokenized once and their pieces written; only the histogram of lengths - ``size``
    numbers - comes to the driver, which packs it into groups of equal sequences. Each piece finds its place by its
    rank among the pieces of its length. Ranks are counted in groups of about ``group_rows`` (a length with more is split by a hash), so
    a length that a third of all pieces have is not numbered in one task. The places sent out are bounded by the
    sequence size as well. Rows that repeat an id are pieces of their own; null ids are kept.
    """
    rows = materialize(pieces(docs, tokenizer_path, size, end_id, id_col=id_col, text_col=text_col, keep=keep), "pack-pieces")
    histogram = np.zeros(size + 1, dtype=np.int64)
    for r in rows.groupBy("length").agg(F.count("*").alias("n")).collect():
        histogram[r["length"]] = r["n"]
    where = docs.sparkSession.sparkContext.broadcast(slots(pack_histogram(histogram, size, grain, most)))

    # one row for each length that occurs: at most ``size`` rows are sent out
    salts = docs.sparkSession.createDataFrame([(int(x), math.ceil(int(histogram[x]) / group_rows)) for x in histogram.nonzero()[0]], "length long, salts long")
    salted = rows.join(F.broadcast(salts), "length").withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "start", "ids_crc32"), F.col("salts")))
    sizes = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))  # one row a group: about pieces / group_rows + size
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("skip"))
    order = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = salted.withColumn("rank", F.row_number().over(order) - 1).join(sizes, ["length", "salt"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("rank") + F.col("skip")).alias("rank"), *keep)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = where.value
        edge = np.searchsorted(s["length"], np.arange(size + 2))
        for b in batches:
            length, rank = (b.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (3, 5))
            at = np.zeros(len(rank), dtype=np.int64)
            for x in np.unique(length):
                mine = length == x
                at[mine] = edge[x] + np.searchsorted(s["first"][edge[x]:edge[x + 1]], rank[mine], side="right") - 1
            k = rank - s["first"][at] if len(at) else rank
            copies = s["copies"][at] if len(at) else k
            sequence, offset = (s["base"][at] + k // copies, s["offset"][at] + k % copies * length) if len(at) else (k, k)
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(sequence), pa.array(offset), *b.columns[6:]],
                                             names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", *keep])

    return ranked.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long" + kept_schema(docs, keep))
