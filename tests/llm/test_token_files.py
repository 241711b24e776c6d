"""Token files: round trip against the library, documents in parts, what metadata spares the reader."""

from __future__ import annotations

import random
import time
import zlib

import brute
import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from panelcast.llm import packing, token_files as tf
from panelcast.llm.queries import BYTE_BPE, PIECE_BPE, WORD_BPE, vocabulary

NAMES = ["doc_id", "start", "n_tokens", "ids_crc32"]
TEXTS = ["", None, "Hello there,  world!\n\n\tnext", "<|endoftext|> as text <|endoftext|>", "née Ünïcode 你好 🎉🎉 ١٢٣", "'ll I've don't 'S", "a" * 3_000, " " * 50 + "x" + "\n" * 40, "\x00\x01    end ", "12345 6789.0, 1e-5"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary(BYTE_BPE))


@pytest.fixture(scope="module")
def fast():
    return tf.ByteTokenizer(vocabulary(BYTE_BPE))


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from("aetoin \n\t'sSrR<|>dt019.,")), max_size=60))
def test_ids_equal_the_library(library, fast, text):
    assert fast(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_long_runs(library, fast):
    for text in ("ab" * 40_000, " " * 60_000 + "x", "\n" * 30_000, "x y　" * 20_000):
        assert fast(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_other_vocabularies_use_the_library():
    other = tf.ByteTokenizer(vocabulary(WORD_BPE))
    assert other.fast is None and other("Some Words").tolist() == other.library.encode("Some Words", add_special_tokens=False).ids
    with pytest.raises(Exception):
        tf.ByteTokenizer(vocabulary(PIECE_BPE))


def test_joined_checksums():
    rng = random.Random(1)
    for _ in range(50):
        a, b = rng.randbytes(rng.randrange(70)), rng.randbytes(rng.randrange(70))
        assert tf.joined_crc(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


def written(spark, tmp_path, rows, schema="doc_id long, text string", **more):
    path = str(tmp_path / "tokens")
    tf.write_tokens(spark.createDataFrame(rows, schema).repartition(3), path, vocabulary(BYTE_BPE), **more)
    return tf.read_tokens(spark, path)


def got(tokens):
    return sorted((tuple(r) for r in tf.documents(tokens).select(*NAMES).collect()), key=lambda r: r[1])


def test_round_trip(spark, tmp_path, library):
    rows = [(k * 37 % 101, TEXTS[k % len(TEXTS)]) for k in range(60)] + [(None, "no id")]
    tokens = written(spark, tmp_path, rows)
    assert got(tokens) == brute.token_rows(rows, library)
    ids = {r.doc_id: r.ids for r in tokens.collect()}
    assert all(ids[d] == library.encode(t or "", add_special_tokens=False).ids + [2] for d, t in rows)


def test_documents_in_parts(spark, tmp_path, library):
    rows = [(k, (TEXTS[k % len(TEXTS)] or "") * (k % 4)) for k in range(40)]
    tokens = written(spark, tmp_path, rows, part_ids=7)
    assert tokens.where("parts > 1").count() > 50 and tokens.selectExpr("max(n)").first()[0] <= 7
    assert got(tokens) == brute.token_rows(rows, library)


def test_edges(spark, tmp_path):
    """Empty table; repeated rows each have an entry; columns named like the operator's own."""
    schema = "doc_id long, text string, ids string, file int, place int, n double"
    assert got(written(spark, tmp_path / "a", [], schema)) == []
    rows = [(5, "twin", "x", 1, 1, 0.0)] * 3 + [(5, None, None, None, None, None), (None, None, None, None, None, None)]
    out = got(written(spark, tmp_path / "b", rows, schema))
    assert [r[0] for r in out] == [None, 5, 5, 5, 5] and sorted(r[2] for r in out)[:2] == [1, 1]
    assert [r[1] for r in out] == np.cumsum([0, *(r[2] for r in out)])[:-1].tolist()


def test_metadata_spares_row_groups(spark, tmp_path):
    rows = [(2 * k, f"word {k}") for k in range(12_000)]
    path = str(tmp_path / "tokens")
    tf.write_tokens(spark.createDataFrame(rows, "doc_id long, text string"), path, vocabulary(BYTE_BPE))

    def rows_read(wanted):
        df = tf.read_tokens(spark, path).where(wanted).select("ids")
        found = df.collect()
        plan, read = df._jdf.queryExecution().executedPlan().toString(), 0
        assert "PushedFilters: [IsNotNull(doc_id)" in plan or "PushedFilters: [In" in plan
        todo = [df._jdf.queryExecution().executedPlan()]
        while todo:
            node = todo.pop()
            if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
                node = node.executedPlan()
            if node.children().size() == 0:
                read += node.metrics().apply("numOutputRows").value()
            todo += [node.children().apply(i) for i in range(node.children().size())]
        return len(found), read

    assert rows_read("doc_id = 7000")[0] == 1 and rows_read("doc_id = 7000")[1] <= 2 * tf.INDEX_ROWS
    # An odd id lies between others: only a Bloom filter can tell that it isn't there.
    assert max(rows_read(f"doc_id = {k}")[1] for k in (1, 777, 7_001, 15_003)) == 0
    assert rows_read("doc_id >= 23000")[1] <= 2 * tf.INDEX_ROWS


def test_no_search_for_special_tokens_at_each_character(library, fast):
    """Encoding takes about as long as tiktoken does without special tokens; a name that none may have is plain text."""
    text = "the cat sat on the mat and the dog ran to it " * 8_000

    def least(f):
        times = []
        for _ in range(5):
            began = time.process_time()
            f(text)
            times.append(time.process_time() - began)
        return min(times)

    for merges in (fast.fast, fast.runs, packing.WordTokenizer(vocabulary(WORD_BPE)).merges):
        assert least(lambda t: merges.encode_to_numpy(t, disallowed_special=())) < 1.5 * least(merges.encode_ordinary)
    (name,) = packing.UNUSED_SPECIAL
    for text in (name, f"a {name} b  {name}"):
        assert fast(text).tolist() == library.encode(text, add_special_tokens=False).ids
