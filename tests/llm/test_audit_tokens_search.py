"""Filter audit, token-id files and ranked search against plain Python versions."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from pricelens.llm import audit, search, tokenfile
from pricelens.llm.queries import LLM_QUERIES, tokenizer
from tests.conftest import SF_SMALL

COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]


# ── filter audit ─────────────────────────────────────────────────────────
def plain_audit(docs: list[tuple], labels: list[tuple]) -> dict:
    """docs (id, text, part), labels (id, quality, toxic): every order carried out one document at a time."""
    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, t in labels if i is not None and t == 1}
    firsts: dict[str, int | None] = {}
    for i, text, _ in docs:
        t = text or ""
        if t not in firsts or (i is not None and (firsts[t] is None or i < firsts[t])):
            firsts[t] = i
    out: dict = {}
    for i, text, part in docs:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {c for c, bad in {"A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words), "C": 100 * sum("A" <= c <= "Z" for c in t) > 5 * len(t),
                                  "D": any(c in "#$%&*|" for c in t), "E": i != firsts[t]}.items() if bad}
        for order in permutations("ABCDE"):
            removed = False
            for step, c in enumerate(order, 1):
                row = out.setdefault((part or "", "".join(order), step), dict.fromkeys(COUNTS, 0))
                here = c in fails and not removed
                row["removed"] += here
                row["redundant"] += c in fails and removed
                row["unique_fails"] += fails == {c}
                row["good_lost"] += here and i in good
                row["toxic_lost"] += here and i in toxic
                removed = removed or here
                row["kept"] += not removed
    totals: Counter = Counter()
    for (part, order, step), row in out.items():
        totals[part, order[step - 1]] += row["removed"]
    return {k: (*(row[c] for c in COUNTS), totals[k[0], k[1][k[2] - 1]]) for k, row in out.items()}


def test_audit_is_every_order_carried_out(spark, odd):
    base = " ".join(f"word{i}" for i in range(60))
    extra = [(20, base, "x"), (21, base, "y"), (22, base, None), (None, base, "x"), (23, base + " # sign", "x"), (24, "LOUD " * 70, "y"), (20, base, "x"), (25, "", "z")]
    docs = odd.select("doc_id", "text", "source").union(spark.createDataFrame(extra, "doc_id long, text string, source string"))
    labels = [(20, 1, 0), (20, 0, 1), (21, 1, None), (24, 0, 1), (None, 1, 1), (99, 1, 1), (5, None, 1)]
    got = audit.audit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    want = plain_audit([tuple(r) for r in docs.collect()], labels)
    assert len(got) == len(want) == 600 * len({p for p, _, _ in want})
    assert {(r["part"], r["filter_order"], r["step"]): (*(r[c] for c in COUNTS), r["shapley"]) for r in got} == want


def test_audit_of_other_filters_and_of_nothing(spark, odd, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit.audit(empty, labels).count() == 0
    short = {"S": audit.F.size("words") < 5}
    got = audit.audit(odd, labels, short, copies="T").collect()
    assert {(r["part"], r["filter_order"], r["step"]) for r in got} == {(p, o, s) for p in ("src", "") for o in ("ST", "TS") for s in (1, 2)}
    rows = {(r["filter_order"], r["step"]): r for r in got if r["part"] == "src"}
    assert rows["ST", 2]["kept"] == rows["TS", 2]["kept"] and rows["ST", 1]["removed"] + rows["ST", 1]["kept"] == 14


# ── token-id files ───────────────────────────────────────────────────────
@pytest.fixture(scope="module")
def whole():
    return Tokenizer.from_file(tokenizer("byte_bpe_50k.json"))


def plain_tokens(whole, docs: list[tuple]) -> list[tuple]:
    """(id, start, ids) in ascending order of the ids, nulls first; equal ids in any order."""
    out, start = [], 0
    for i, t in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0)):
        ids = whole.encode(t or "", add_special_tokens=False).ids + [2]
        out.append((i, start, ids))
        start += len(ids)
    return out


def test_token_files_read_back_what_the_tokenizer_says(spark, whole):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(LLM_QUERIES["op12_token_files"](spark, SF_SMALL).collect())
    want = [(i, s, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())) for i, s, ids in plain_tokens(whole, docs)]
    assert [(r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in got] == want


def test_token_files_of_odd_rows(spark, odd, whole):
    files, dictionary = tokenfile.write_tokens(odd, tokenizer("byte_bpe_50k.json"), shard_bytes=200)
    rows = tokenfile.read_tokens(files, dictionary).collect()
    docs = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    want = plain_tokens(whole, docs)
    assert sorted((str(r["doc_id"]), np.frombuffer(r["ids"], "<u4").tolist()) for r in rows) == sorted((str(i), ids) for i, _, ids in want)
    at = 0
    for r in sorted(rows, key=lambda r: r["start"]):  # gapless, in ascending order of the ids
        assert r["start"] == at
        at += len(r["ids"]) // 4
    ids = [r["doc_id"] for r in sorted(rows, key=lambda r: r["start"])]
    assert ids == [i for i, _, _ in want]
    assert files.count() > 1 and {r["tokens"] for r in files.select("tokens").collect()}


def test_one_document_is_read_by_its_index_entry(spark, whole):
    docs = spark.createDataFrame([(i, f"document number {i} of many") for i in range(300)], "doc_id long, text string").coalesce(1)
    files, dictionary = tokenfile.write_tokens(docs, tokenizer("byte_bpe_50k.json"), dictionary_bytes=1024)
    assert dictionary
    found = 0
    for r in files.collect():
        shard = tokenfile.Shard(r["path"], dictionary)
        for k in shard.find(123):
            found += 1
            assert shard.document(k).tolist() == whole.encode("document number 123 of many").ids + [2]
        assert shard.find(1000) == []
        with pytest.raises(ValueError, match="another dictionary"):
            tokenfile.Shard(r["path"], dictionary + b"x")
    assert found == 1


def test_token_files_of_nothing(spark, empty):
    files, dictionary = tokenfile.write_tokens(empty, tokenizer("byte_bpe_50k.json"))
    assert dictionary == b"" and files.count() == 0 and tokenfile.read_tokens(files, dictionary).count() == 0


def test_encoder_is_the_tokenizer(whole):
    enc, rng = tokenfile.Encoder(tokenizer("byte_bpe_50k.json")), np.random.default_rng(5)
    parts = [" ", "  ", "\n", "\t", "\r\n", "word", "Ab", "'s", "'", "1", "é", "ß", "日", "!", "#-", "\xa0", "<|endoftext|>", "\U0001F600", "\x0b", "\x1c", chr(0x301), chr(0x3000), "²"]
    for _ in range(3000):
        text = "".join(rng.choice(parts, rng.integers(0, 14)))
        assert np.frombuffer(enc.encode(text), enc.dtype).tolist() == whole.encode(text, add_special_tokens=False).ids


def test_columns_are_encoded_text_by_text(whole):
    rng = np.random.default_rng(6)
    parts = [" ", "\n", "\t", "word", "Ab,", "'s", "1", "\u00e9", "\u65e5", "\xa0", "<|endoftext|>", "\x0b", "\u3000"]
    texts = [None, "", "<|endoftext|>", "\xa0", " "] + ["".join(rng.choice(parts, rng.integers(0, 9))) for _ in range(400)] + ["", None]
    want = [whole.encode(t or "", add_special_tokens=False).ids for t in texts]
    enc = tokenfile.Encoder(tokenizer("byte_bpe_50k.json"))
    column = pa.array(["cut off", *texts, "cut off"]).slice(1, len(texts))
    for kind in (pa.string(), pa.large_string()):
        assert [np.frombuffer(ids, enc.dtype).tolist() for ids in enc.encode_column(column.cast(kind))] == want
    assert enc.encode_column(pa.array([], pa.string())) == [] and enc.encode_column(pa.array([None, ""])) == [b"", b""]


def test_frequent_pieces_are_merged_once(monkeypatch):
    """Words of every text stay known while others come and go."""
    monkeypatch.setattr(tokenfile, "CACHE_PIECES", 100)
    enc, merged = tokenfile.Encoder(tokenizer("byte_bpe_50k.json")), Counter()
    plain = enc._pretoken
    enc._pretoken = lambda p: merged.update([p]) or plain(p)
    for i in range(60):
        enc.encode_column(pa.array([f"the same words and x{'abcdefghij'[i % 10]}{'klmnop'[i // 10]}{j:c}y" for j in range(97, 117)]))
    assert {merged[w] for w in ("the", " same", " words", " and")} == {1} and len(enc.known) + len(enc.older) < 300


def test_blocks_keep_the_rows(monkeypatch):
    monkeypatch.setattr(tokenfile, "BLOCK_BYTES", 10)
    texts = [None, "", "x" * 35, "abc", None, "defg", "hijklm", "n", "o" * 10]
    b = pa.RecordBatch.from_arrays([pa.array(range(9)), pa.array(texts)], names=["doc_id", "text"])
    got = list(tokenfile.blocks([b, b.slice(0, 0)]))
    assert [t for x in got for t in x.column(1).to_pylist()] == texts and 2 < len(got) < 9


# ── ranked search ────────────────────────────────────────────────────────
def plain_terms(text: str | None) -> list[str]:
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def plain_search(docs: list[tuple], items: list[tuple], k: int = 20) -> list[tuple]:
    counts = [(i, Counter(plain_terms(t))) for i, t in docs]
    counts = [(i, c, c.total()) for i, c in counts if c]
    total, df = sum(n for _, _, n in counts), Counter(t for _, c, _ in counts for t in c)
    out = []
    for item, text in sorted(set(items), key=str):
        scored = []
        for i, c, n in counts:
            m = 75 + 25 * n * len(counts) // total
            s = sum(math.floor(1000 * math.log((2 * len(counts) + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 12 * m)) for t in plain_terms(text) if c[t])
            if s > 0:
                scored.append((-s, i is None, i or 0))
        out += [(item, r, None if null else i, -s) for r, (s, null, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


ITEMS = [(1, "w1 w2 w3 w3 W3"), (2, "w1 w2 w9, shared-line"), (2, "another text of id 2: w7"), (3, None), (4, "..."), (5, "absent"), (6, "Ünïcödé FAÇADE w10"),
         (1, "w1 w2 w3 w3 W3"), (None, "w1 w2"), (7, "shared line one w1 w2 w3"), (8, " ".join(f"w{i}" for i in range(120)))]


def test_search_is_the_plain_search(spark, odd):
    more = [(100 + i % 40, f"w{i % 5} w{i % 3} shared w9 {'w2 ' * (i % 4)}") for i in range(60)]
    docs = odd.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id long, text string")).repartition(5)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    want = plain_search([tuple(r) for r in docs.collect()], ITEMS)
    for block in (512, 3):
        got = search.search(docs, items, block=block, batch=7).collect()
        assert sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in got), key=str) == want
    few = search.search(docs, items, k=3).collect()
    assert sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in few), key=str) == [w for w in want if w[1] <= 3]


def test_search_without_documents_or_items(spark, odd, empty):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert search.search(empty, items).count() == 0
    assert search.search(odd, items.limit(0)).count() == 0
    assert search.search(odd, items.where("item_id in (3, 4)")).count() == 0


def test_shared_sets_add_up_to_the_queries():
    rng = np.random.default_rng(3)
    queries = [set(rng.choice(30, rng.integers(1, 12), replace=False).tolist()) for _ in range(60)]
    pairs, rests = search.mine(queries)

    def leaves(s) -> list:
        return [x for p in pairs[s[1]] for x in leaves(p)] if isinstance(s, tuple) else [s]

    for q, rest in zip(queries, rests):
        got = [x for s in rest for x in leaves(s)]
        assert len(got) == len(set(got)) and set(got) == q
    used = Counter(s for r in rests for s in r) + Counter(s for p in pairs for s in p)
    assert all(used[("pair", i)] for i in range(len(pairs)))


def test_sharing_saves_additions(spark):
    items = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()
    plan = search.Plan.of([(r["item_id"], search.terms(r["text"].encode())) for r in items])
    shared, plain = plan.additions()
    assert plan.levels and shared < plain
