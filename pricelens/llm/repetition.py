"""Quality rules by repetition coverage."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.llm.common import covered, mix, text_bytes, window_hash, word_hashes
from pricelens.llm.sampling import map_texts

#: Largest share of a text's word characters inside word n-grams that occurred before, by n.
NGRAM_LIMITS = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
#: Largest share of lines that repeat an earlier one, and of word characters in them.
LINE_LIMIT, LINE_CHAR_LIMIT = 0.30, 0.20
SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", dtype=np.uint8))
BLANK = np.isin(np.arange(256), np.frombuffer(b" \t\n\x0b\x0c\r", dtype=np.uint8))


def repeated(hashes: np.ndarray, first: bool = True) -> np.ndarray:
    """Places of the values that occur more than once, the first occurrence included or not."""
    order = np.argsort(hashes, kind="stable")
    again = np.concatenate([[False], hashes[order][1:] == hashes[order][:-1]])[:len(hashes)]
    return order[again | np.append(again[1:], False)[:len(hashes)]] if first else order[again]


def points(b: np.ndarray) -> np.ndarray:
    """1 where a byte begins a code point that is not blank."""
    return ((b & 0xC0) != 0x80) & ~BLANK[b]


def measure(text: bytes | None, limits: dict[int, float]) -> dict:
    """Counts and coverage of one whole text."""
    text = text or b""
    raw = np.frombuffer(text, dtype=np.uint8)
    words = text.split()
    n = len(words)
    word_chars = int(points(raw).sum())
    lines, dup_lines, dup_line_chars, seen = 0, 0, 0, set()
    for line in text.split(b"\n"):
        if line.strip(b" \t\x0b\x0c\r"):
            lines += 1
            if line in seen:
                dup_lines += 1
                dup_line_chars += int(points(np.frombuffer(line, dtype=np.uint8)).sum())
            seen.add(line)
    h = word_hashes(words)[:, 0]
    size = np.fromiter((len(w) if w.isascii() else len(w.decode("utf-8", "replace")) for w in words), dtype=np.int64, count=n)

    def cover(k: int, first: bool = False) -> np.ndarray:
        at = repeated(mix(window_hash(h, k)), first)
        return covered(at, k, n) if len(at) else np.zeros(n, dtype=bool)

    shares = {k: (float(size[cover(k)].sum()) / word_chars if word_chars else 0.0) for k in limits}
    return {"n_words": n, "word_chars": word_chars, "n_symbols": int(SYMBOLS[raw].sum()), "n_dup_lines": dup_lines,
            "n_repeat_words": int(cover(3, first=True).sum()), "line_share": dup_lines / lines if lines else 0.0,
            "line_char_share": dup_line_chars / word_chars if word_chars else 0.0, "ngram_shares": shares}


def quality_rules(docs: DataFrame, limits: dict[int, float] | None = None, line_limit: float = LINE_LIMIT, line_char_limit: float = LINE_CHAR_LIMIT,
                  min_words: int = 50, max_repeat_percent: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Repetition figures and verdict of every whole text, one row per row of ``docs``.

    Rolling hashes of the word n-grams of every length in ``limits`` mark the words inside n-grams that
    occurred earlier in the text; the share of the text's word characters that they cover must
    not pass the limit of their length. Neither must the share of lines that repeat an earlier line, nor the share of
    characters in those. A text of fewer than ``min_words`` words, or of which more than ``max_repeat_percent`` per cent
    of the words lie in repeated 3-word windows, fails before (``base_failed``).

    Returns ``(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, line_share,
    line_char_share, worst_ngram_share)``. Null and empty texts have no words and fail the base.
    A very long text is measured whole, by arrays as long as it has words and bytes. Rows that repeat, and null ids, are
    judged each for itself; an empty table gives an empty table. Other columns are not looked at.
    """
    limits = dict(NGRAM_LIMITS if limits is None else limits)

    def run(b: pa.RecordBatch) -> list:
        m = [measure(t.as_py(), limits) for t in b.column(1)]
        base = [x["n_words"] < min_words or 100 * x["n_repeat_words"] > max_repeat_percent * x["n_words"] for x in m]
        bad = [x["line_share"] > line_limit or x["line_char_share"] > line_char_limit or any(x["ngram_shares"][k] > v for k, v in limits.items()) for x in m]
        longs = [pa.array([x[k] for x in m], pa.int64()) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
        shares = [[x["line_share"] for x in m], [x["line_char_share"] for x in m], [max(x["ngram_shares"].values(), default=0.0) for x in m]]
        return [b.column(0), *longs, pa.array(base, pa.bool_()), pa.array([not (f or g) for f, g in zip(base, bad)], pa.bool_()), *(pa.array(s, pa.float64()) for s in shares)]

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_bytes(text_col).alias("text"))
    return map_texts(src, run, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
                               "base_failed boolean, kept boolean, line_share double, line_char_share double, worst_ngram_share double")
