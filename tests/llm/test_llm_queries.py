"""The registered corpus queries on the given tables: against SQL, or against a brute-force version."""

from __future__ import annotations

import os
from pathlib import Path

import brute
import numpy as np
import pytest
from compare import connect, differences

import corpus_pipeline
from panelcast.llm import packing
from panelcast.llm.queries import ORACLES, QUERIES, WORD_BPE, vocabulary

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.fixture(scope="module")
def documents(duck):
    return duck.execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall()


def rows_of(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_one_query_for_each_operator():
    assert sorted(n.split("_")[0] for n in QUERIES if n.startswith("op")) == sorted(f"op{i}" for i in range(1, 14))
    assert "pipeline" in QUERIES and corpus_pipeline.ORACLE_SQL is None


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, name):
    assert differences(QUERIES[name](spark, SF_DIR), ORACLES[name], duck) == []


def test_packing(spark, documents):
    from tokenizers import Tokenizer

    got = QUERIES["op2_best_fit_packing"](spark, SF_DIR)
    want = brute.pieces(documents, Tokenizer.from_file(vocabulary(WORD_BPE)))
    assert rows_of(got, "doc_id", "piece", "start", "length", "ids_crc32") == sorted(want)
    assert got.select("sequence_id").distinct().count() <= packing.lower_bound(np.array([w[3] for w in want]), 4096) + 1


def test_simhash(spark, documents):
    got = QUERIES["op4_simhash"](spark, SF_DIR)
    assert rows_of(got, "doc_id", "fingerprint", "component_id") == sorted(brute.simhash_rows(documents))


def test_quality(spark, duck):
    got = {r.doc_id: r for r in QUERIES["op5_quality_classifier"](spark, SF_DIR).collect()}
    labels = duck.execute("SELECT doc_id, quality FROM labels").fetchall()
    out = [(got[d].predicted, q) for d, q in labels if got[d].held_out]
    assert len(got) == duck.execute("SELECT count(*) FROM documents").fetchone()[0]
    assert np.mean([p == q for p, q in out]) >= 0.9


def test_sentencepiece(spark, documents):
    import hashlib

    import sentencepiece
    from panelcast.llm.queries import PIECE_BPE

    library = sentencepiece.SentencePieceProcessor(model_file=vocabulary(PIECE_BPE))
    want = []
    for d, t in documents:
        ids = library.encode(t or "")
        want.append((d, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), brute.sha(library.decode(ids))))
    assert rows_of(QUERIES["op6_sentencepiece"](spark, SF_DIR), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(want)


def test_embeddings(spark, duck):
    rows = [(i, v) for i, v in duck.execute("SELECT vec_id, embedding FROM embeddings").fetchall()]
    got = rows_of(QUERIES["op8_embedding_dedup"](spark, SF_DIR), "vec_id", "n_links", "component_id", "kept")
    want = sorted(brute.vectors(rows))
    assert sum(w[1] for w in want) * 0.9 <= sum(g[1] for g in got) <= sum(w[1] for w in want)
    assert sum(g == w for g, w in zip(got, want)) >= 0.9 * len(want)


def test_secrets(spark, documents):
    from panelcast.llm.secrets import written

    got = {r.doc_id: r for r in QUERIES["op10_secret_scans"](spark, SF_DIR).collect()}
    for d, t in documents:
        want = brute.secret_spans(t)
        assert got[d].base_sha256 == brute.sha(written(want))
        assert (got[d].n_assign, got[d].n_access, got[d].n_hex) == tuple(sum(k == x for _, k, _ in want) for x in range(3))


def test_prefix_trie(spark, duck):
    turns = duck.execute("SELECT conv_id, turn, role, text FROM conversations").fetchall()
    got = QUERIES["op11_prefix_trie"](spark, SF_DIR)
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted(map(tuple, got.select(*names).collect()), key=str) == sorted(brute.trie_rows(brute.rebuilt_turns(turns)), key=str)


def test_token_files(spark, documents):
    from tokenizers import Tokenizer

    from panelcast.llm.queries import BYTE_BPE

    got = QUERIES["op12_token_files"](spark, SF_DIR)
    assert rows_of(got, "doc_id", "start", "n_tokens", "ids_crc32") == sorted(brute.token_rows(documents, Tokenizer.from_file(vocabulary(BYTE_BPE))))


def test_role_repair(spark, duck):
    turns = duck.execute("SELECT conv_id, turn, role, text FROM conversations").fetchall()
    got = QUERIES["op13_role_repair"](spark, SF_DIR)
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert rows_of(got, *names) == sorted(brute.role_repairs(turns))


def test_pipeline(spark, duck, documents):
    """Stage by stage against plain versions, then the packed pieces as a whole."""
    from tokenizers import Tokenizer

    from panelcast.llm import quality, secrets
    from panelcast.llm.common import table

    docs = table(spark, SF_DIR, "documents")
    model = quality.train(docs, table(spark, SF_DIR, "labels"))
    hasher = quality.Hasher()
    left = [(d, t) for d, t in documents if model.score(t or "", hasher) >= quality.THRESHOLD]
    last = {brute.lower(t or ""): d for d, t in left}
    left = [(d, t) for d, t in left if last[brute.lower(t or "")] == d]
    first = {d: c for d, _, c in brute.simhash_rows(left)}
    left = [(d, t) for d, t in left if first[d] == d]
    novelty = secrets.Novelty()
    left = [(d, secrets.redacted(t, secrets.find_spans(t, novelty)) if t else t) for d, t in left]
    want = brute.pieces(left, Tokenizer.from_file(vocabulary(WORD_BPE)))
    got = QUERIES["pipeline"](spark, SF_DIR)
    assert rows_of(got, "doc_id", "piece", "start", "length", "ids_crc32") == sorted(want)


def test_stages_keep_the_columns(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF_DIR)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        assert docs.count() > 0


def test_stages_take_empty_tables(spark, tmp_path):
    spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0).write.parquet(str(tmp_path / "e"))
    empty = spark.read.parquet(str(tmp_path / "e"))
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF_DIR).count() == 0


def test_stages_take_awkward_rows(spark, tmp_path):
    """NULLs in every column, empty and very long texts, repeated rows, extra columns with clashing names."""
    long = "word " * 60_000 + "end"
    rows = [(None, None), (None, None), (1, ""), (1, ""), (2, long), (3, "A few plain words."), (4, "a FEW plain words."), (5, "password=hunter2hunter2 here"), (6, " \n\t ")]
    names = "doc_id long, text string, lang string, source string, n_chars long, _row string, bits string, node string"
    data = [(d, t, None if d in (None, 3) else "en", None, None if t is None else len(t), "r", "b", None) for d, t in rows]
    spark.createDataFrame(data, names).repartition(2).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    stages = dict(corpus_pipeline.STAGES)
    for name, stage in list(stages.items())[:-1]:
        out = stage(spark, docs, SF_DIR)
        assert out.columns == docs.columns
        kept = sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str)
        if name == "exact_dedup":
            assert kept == sorted([(1, ""), (2, long), (4, "a FEW plain words."), (5, "password=hunter2hunter2 here"), (6, " \n\t ")], key=str)
        elif name == "simhash_near_dedup":  # rows without words have the fingerprint zero in common
            assert kept == sorted([(1, ""), (2, long), (3, "A few plain words."), (5, "password=hunter2hunter2 here")], key=str)
        elif name == "secret_scans":
            assert kept == sorted([(d, "[secret] here" if d == 5 else t) for d, t in rows], key=str)
    packed = stages["best_fit_packing"](spark, docs, SF_DIR).collect()
    assert sorted((r["doc_id"], r["piece"]) for r in packed if r["doc_id"] is not None) == sorted((d, k) for d, t in rows if d for k in range(15 if t == long else 1))
