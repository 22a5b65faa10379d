"""Token files: exact round trips, and ids equal to the tokenizer's own."""

import functools

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from specmerge.llm.token_blocks import Segment, encode_segment, pack, read_blocks, unpack, write_blocks
from specmerge.llm.tokens import ChunkEncoder, encoder

ODD = ["a <|endoftext|> b", "x<|startoftext|>y<|endoftext|>", "<|ENDOFTEXT|> a", "", " ", "a ", " a", "a\nb", "a \nb", "\n\n", "a\tb  c", "\x01", "a \x01 b", "<|endoftext|> a", "it's", "a\x1cb", "日本語 テスト", "Σ ΣΑΣ."]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
@settings(max_examples=60, deadline=None)
@given(texts=st.lists(st.one_of(st.text(alphabet="ab \n\tÉ'.1\x01", max_size=30), st.sampled_from(ODD)), max_size=6))
def test_ids_are_the_tokenizers(name, texts):
    ids, sizes = encoder(public_tokenizers.path(name)).encode(texts)
    assert [ids[e - n : e].tolist() for e, n in zip(np.cumsum(sizes).tolist(), sizes.tolist())] == [plain(name).encode(t, add_special_tokens=False).ids for t in texts]


@functools.cache
def plain(name):
    return Tokenizer.from_file(public_tokenizers.path(name))


def test_special_strings():
    assert encoder(public_tokenizers.path("byte_bpe_50k.json")).encode(["a <|endoftext|> b"])[0].tolist() == [64, 220, 50256, 275]
    assert encoder(public_tokenizers.path("word_bpe_49k.json")).encode(["A  <|endoftext|> b"])[0].tolist() == [320, 49407, 321]


def test_table_of_chunks_stays_bounded():
    coder = ChunkEncoder(public_tokenizers.path("byte_bpe_50k.json"), max_entries=10, step_chars=50)
    for k in range(20):
        coder.encode([f"w{k} x{k} y{k}"] * 3)
    assert len(coder.table) <= 20


@pytest.mark.parametrize("width", range(1, 33))
def test_pack(width):
    rows = np.random.default_rng(width).integers(0, 1 << width, (3, 256))
    assert (unpack(pack(rows, width), width) == rows).all()


@given(st.lists(st.integers(0, 2**32 - 1), max_size=700), st.integers(0, 700), st.integers(0, 700))
@settings(max_examples=60, deadline=None)
def test_segment_round_trip(ids, a, b):
    ids = np.array(ids, np.uint32)
    segment = Segment(encode_segment([4, None], np.array([len(ids), 0]), ids))
    assert segment.read().tolist() == ids.tolist()
    assert segment.read(a, b).tolist() == ids[a:b].tolist()
    assert segment.doc_ids == [4, None]


def test_dataset(spark, tmp_path):
    rows = [(3, "b c"), (1, None), (2, "a\nb  c"), (None, "z"), (3, "b c"), (-5, "")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, data string").repartition(3)
    path = public_tokenizers.path("byte_bpe_50k.json")
    write_blocks(df, f"{tmp_path}/t", path, segment_ids=4)
    out = sorted(read_blocks(spark, f"{tmp_path}/t").collect(), key=lambda r: r.start)
    assert [r.doc_id for r in out] == [None, -5, 1, 2, 3, 3]
    at = 0
    texts = {None: "z", -5: "", 1: "", 2: "a\nb  c", 3: "b c"}
    for r in out:
        want = [*plain("byte_bpe_50k.json").encode(texts[r.doc_id], add_special_tokens=False).ids, 2]
        assert (r.start, r.n_tokens, r.ids) == (at, len(want), want)
        at += len(want)
    write_blocks(df.limit(0), f"{tmp_path}/e", path)
    assert read_blocks(spark, f"{tmp_path}/e").count() == 0


def test_hot_id_is_dealt_to_many_tasks(spark, tmp_path):
    """An id with most of the rows: its rows lie in several parts, and the order holds."""
    df = spark.range(400).select(F.when(F.col("id") % 4 > 0, 7).otherwise(F.col("id")).alias("doc_id"), F.concat(F.lit("a "), F.col("id").cast("string")).alias("text"))
    write_blocks(df, f"{tmp_path}/t", public_tokenizers.path("byte_bpe_50k.json"), segment_ids=50)
    out = sorted(read_blocks(spark, f"{tmp_path}/t").collect(), key=lambda r: r.start)
    assert [r.doc_id for r in out] == sorted(r.doc_id for r in df.collect())
    assert all(a.start + a.n_tokens == b.start for a, b in zip(out, out[1:], strict=False))
    assert spark.read.parquet(f"{tmp_path}/t").select("part").distinct().count() == 4
    assert sorted(tuple(r.ids) for r in out) == sorted((*plain("byte_bpe_50k.json").encode(r.text, add_special_tokens=False).ids, 2) for r in df.collect())
