"""The thin queries against SQL or plain Python versions on the small tables."""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pytest

import corpus_pipeline
from pricelens.llm import decontaminate, language
from pricelens.llm.queries import LLM_ORACLE, LLM_QUERIES, tokenizer
from pricelens.llm.simhash import fingerprint
from tests.conftest import SF_MID, SF_SMALL, canon_rows
from tests.llm.conftest import odd_rows


@pytest.mark.parametrize("name", sorted(LLM_ORACLE))
def test_query_matches_sql(spark, con, name):
    df = LLM_QUERIES[name](spark, SF_SMALL)
    rel = con.sql(LLM_ORACLE[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert canon_rows(df.columns, [tuple(r) for r in df.collect()]) == canon_rows(rel.columns, rel.fetchall())


def plain_components(fps: dict[int, int], bits: int = 2) -> dict[int, int]:
    """Smallest id reachable, by comparing all pairs."""
    ids = sorted(fps)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, i in enumerate(ids):
        for j in ids[k + 1:]:
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: find(i) for i in ids}


def test_simhash_is_all_pairs(spark, con):
    docs = dict(con.sql("SELECT doc_id, text FROM documents").fetchall())
    want = plain_components({d: fingerprint(t.encode()) for d, t in docs.items()})
    got = {r["doc_id"]: r for r in LLM_QUERIES["op3_simhash_dedup"](spark, SF_SMALL).collect()}
    assert {d: r["component_id"] for d, r in got.items()} == want
    assert all(r["fingerprint"] == f"{fingerprint(docs[d].encode()):016x}" for d, r in got.items())


def plain_leaks(docs: dict[int, str], items: dict[int, str]) -> set[tuple[int, int]]:
    """(document, item) pairs within the edits, each item slid over every whole text."""
    out = set()
    split = {d: decontaminate.words_of(t.encode()) for d, t in docs.items()}
    for i, t in items.items():
        w = decontaminate.words_of(t.encode())
        masks: dict[bytes, int] = {}
        for k, x in enumerate(w):
            masks[x] = masks.get(x, 0) | 1 << k
        most = int(0.2 * len(w) + 1e-9)
        out |= {(d, i) for d, x in split.items() if len(set(x) & set(w)) >= len(set(w)) - most and decontaminate.edits_inside(masks, len(w), x) <= most}
    return out


def test_leaks_are_exact(spark, con):
    docs, items = (dict(con.sql(q).fetchall()) for q in ("SELECT doc_id, text FROM documents", "SELECT item_id, text FROM benchmark"))
    got = LLM_QUERIES["op5_decontaminate"](spark, SF_SMALL).collect()
    want = plain_leaks(docs, items)
    assert want and {(r["doc_id"], r["item_id"]) for r in got} == want
    for r in got:
        words = docs[r["doc_id"]].lower().split()[r["begin_word"]:r["end_word"]]
        if r["edits"] == 0:
            assert words == items[r["item_id"]].lower().split()


def check_packed(rows: pd.DataFrame, docs: dict[int, str], size: int = 4096) -> None:
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer("word_bpe_49k.json"))
    assert set(rows.doc_id) == set(docs)
    for d, g in rows.sort_values("piece").groupby("doc_id"):
        ids = np.array(tok.encode(docs[d], add_special_tokens=False).ids + [1], dtype="<u4")
        assert g.piece.tolist() == list(range(-(-len(ids) // size)))
        assert g.start.tolist() == list(range(0, len(ids), size)) and g.length.sum() == len(ids)
        assert [zlib.crc32(ids[s:s + n].tobytes()) for s, n in zip(g.start, g.length)] == g.ids_crc32.tolist()
    for _, g in rows.sort_values("offset").groupby("sequence_id"):
        assert g.offset.tolist() == [0, *g.length.cumsum().tolist()[:-1]] and g.length.sum() <= size
    assert rows.sequence_id.nunique() <= 1.01 * rows.length.sum() / size + 1


def test_packing_is_whole_and_tight(spark, con):
    check_packed(LLM_QUERIES["op6_packing"](spark, SF_SMALL).toPandas(), dict(con.sql("SELECT doc_id, text FROM documents").fetchall()))


def auc(y: np.ndarray, score: np.ndarray) -> float:
    rank = pd.Series(score).rank().to_numpy()
    n = y.sum()
    return (rank[y == 1].sum() - n * (n + 1) / 2) / (n * (len(y) - n))


def test_language_held_out(spark):
    got = LLM_QUERIES["op2_language_id"](spark, SF_MID).toPandas().merge(spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "lang").toPandas())
    assert len(got) == 1000 and got.score.between(0, 1).all()
    assert (got.held_out == [zlib.crc32(str(d).encode()) % 4 == 2 for d in got.doc_id]).all()
    held = got[got.held_out]
    assert (held.lang_pred == held.lang).mean() > 0.98


def test_quality_held_out(spark):
    labels = spark.read.parquet(f"{SF_MID}/labels.parquet").toPandas()
    got = LLM_QUERIES["op7_quality"](spark, SF_MID).toPandas()
    assert len(got) == 1000 and got.score.between(0, 1).all() and ((got.score >= 0.7) == (got.predicted == 1)).all()
    held = got[got.held_out].merge(labels, on="doc_id")
    assert auc(held.quality.to_numpy(), held.score.to_numpy()) > 0.95


def test_toxicity_query_columns(spark):
    got = LLM_QUERIES["op9_toxicity"](spark, SF_MID).toPandas()
    assert len(got) == 1000 and got.score.between(0, 1).all() and ((got.score >= 0.7) == (got.predicted == 1)).all()
    assert (got.held_out == [zlib.crc32(str(d).encode()) % 3 == 1 for d in got.doc_id]).all()


def test_toxicity_held_out(spark):
    labels = spark.read.parquet(f"{SF_MID}/labels.parquet").select("doc_id", "toxic").toPandas()
    got = LLM_QUERIES["op9_toxicity"](spark, SF_MID).toPandas()
    held = got[got.held_out].merge(labels, on="doc_id")
    assert 0 < held.toxic.sum() < len(held)
    assert auc(held.toxic.to_numpy(), held.score.to_numpy()) > 0.85


def test_pipeline_on_odd_and_empty_tables(spark, odd, empty, tmp_path):
    for name, docs in (("odd", odd), ("empty", empty)):
        docs.write.parquet(str(tmp_path / name / "documents.parquet"))
        spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").write.parquet(str(tmp_path / name / "benchmark.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path / "odd")).toPandas()
    ids = [r[0] for r in odd_rows() if any(c.isalpha() for c in r[1] or "")]
    assert len(got) and set(got.doc_id.dropna().astype(int)) <= set(ids)
    for _, g in got.sort_values("offset").groupby("sequence_id"):
        assert g.offset.tolist() == [0, *g.length.cumsum().tolist()[:-1]] and g.length.sum() <= 4096
    assert (got[got.piece == 0].doc_id == 7).sum() <= 2  # two rows of one id and text are one document; the third has another text
    assert got[got.doc_id == 4].length.sum() > 4096  # the very long text, whole
    assert corpus_pipeline.run(spark, str(tmp_path / "empty")).count() == 0


def test_pipeline_is_its_stages_in_plain_python(spark, con):
    docs = con.sql("SELECT * FROM documents").df()
    model = language.train(spark.read.parquet(f"{SF_SMALL}/documents.parquet"))
    marks = [set(np.flatnonzero(x).tolist()) for x in model.landmarks]

    def near(text: str) -> float:
        own = set(np.flatnonzero(language.presence(text)).tolist())
        return max(len(own & m) / (len(own) * len(m)) ** 0.5 for m in marks)

    docs = docs[[any(c.isalpha() for c in t or "") and near(t) >= language.LEAST_KERNEL for t in docs.text]]
    con.register("kept_docs", docs)
    cut = con.sql(LLM_ORACLE["op1_line_dedup"].replace("documents", "kept_docs")).df()
    texts = dict(zip(cut.doc_id.tolist(), cut.kept_text))
    roots = plain_components({d: fingerprint(t.encode()) for d, t in texts.items()})
    texts = {d: t for d, t in texts.items() if roots[d] == d}
    leaked = {d for d, _ in plain_leaks(texts, dict(con.sql("SELECT item_id, text FROM benchmark").fetchall()))}
    check_packed(corpus_pipeline.run(spark, SF_SMALL).toPandas(), {d: t for d, t in texts.items() if d not in leaked})


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF_SMALL).schema.names == docs.columns


