"""Token id files: exact round trips, the library's ids, and the order of documents."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from herdloom.llm import token_files
from herdloom.llm.bpe import split_words
from herdloom.llm.catalog import op13_token_files
from tests.llm.conftest import SF

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    held = Tokenizer.from_file(PATH)
    held.no_truncation()
    held.no_padding()
    return held


def plain_rows(library, rows):
    """(doc_id, start, n_tokens, crc32) in order of the ids; NULL first."""
    out, start = [], 0
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def by_start(df):
    rows = df.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("crc")).collect()
    return sorted(map(tuple, rows), key=lambda r: r[1])


def test_query_equals_the_library(spark, small, library):
    got = sorted(map(tuple, op13_token_files(spark, SF).collect()), key=lambda r: r[1])
    assert got == plain_rows(library, [(r.doc_id, r.text) for r in small.collect()])


def test_edge_rows(spark, edge, library, tmp_path):
    """Nulls, repeated rows, very long texts and clashing names, in blocks of a few documents."""
    rows = [(r.doc_id, r.text) for r in edge.collect()]
    token_files.write_ids(edge.repartition(3), PATH, str(tmp_path))
    got, expected = by_start(token_files.read_ids(spark, str(tmp_path))), plain_rows(library, rows)
    assert got == expected


def test_empty_table(spark, none, tmp_path):
    token_files.write_ids(none, PATH, str(tmp_path))
    assert token_files.read_ids(spark, str(tmp_path)).collect() == []


def test_rows_of_one_id_all_stay(spark, docs, library, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_IDS", 64)
    rows = [(5, "b text"), (5, "a text"), (5, "a text")] * 20 + [(4, None), (6, "<|endoftext|> and more"), (-3, "first")]
    token_files.write_ids(docs(*rows).repartition(4), PATH, str(tmp_path), end=None)
    got = by_start(token_files.read_ids(spark, str(tmp_path)))
    assert [r[0] for r in got] == [-3, 4, *[5] * 60, 6]
    assert all(a[1] + a[2] == b[1] for a, b in zip(got, got[1:])) and got[0][1] == 0
    known = {(d, zlib.crc32(np.array(library.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes())) for d, t in rows}
    assert {(r[0], r[3]) for r in got} == known


def test_frequent_ids_take_one_byte(spark, small, tmp_path):
    """The first 256 ranks take a byte each, and the order of ranks is that of counts."""
    token_files.write_ids(small, PATH, str(tmp_path))
    ids = np.concatenate([np.frombuffer(r.ids, "<u4") for r in token_files.read_ids(spark, str(tmp_path)).collect()])
    ranked = [r.id for r in spark.read.parquet(f"{tmp_path}/ranks").orderBy("place").collect()]
    counts = np.bincount(ids)
    assert ranked == sorted(np.flatnonzero(counts).tolist(), key=lambda i: (-counts[i], i))
    held = spark.read.parquet(f"{tmp_path}/blocks").agg(F.sum(F.octet_length("data")), F.sum("n_tokens")).first()
    assert held[0] == len(ids) + int(counts[ranked[256:]].sum()) and held[1] == len(ids)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, (1 << 32) - 1)), max_size=70))
def test_code_round_trip(values):
    numbers = np.array(values, np.uint32)
    control, data = token_files.code(numbers)
    assert len(control) == -(-len(values) // 4) and len(data) == sum(max(1, -(-v.bit_length() // 8)) for v in values)
    assert token_files.decode(control, data, len(values)).tolist() == values


PIECES = [*" \t\n'’.!1a\xa0\x85\x1c\u3000²ßé日İ٣😀\u0301\x00", "  ", "'s", "'ll", "'ve", "'d", "'l", "word", "<|endoftext|>"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=12).map("".join), min_size=1, max_size=6))
def test_words_of_texts_side_by_side(texts):
    """Cut where the pattern cuts each text, whatever the kinds of characters and wherever texts meet."""
    ends = np.cumsum([len(t) for t in texts])
    codes = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4")
    if len(codes):
        starts = np.flatnonzero(token_files.word_starts(codes, np.append(0, ends[:-1])))
        whole = "".join(texts)
        got = [whole[a:b] for a, b in zip(starts, [*starts[1:], len(whole)])]
        assert got == [w for t in texts for w in split_words(t)]
    encoder = token_files.worker_encoder(PATH)
    expected = [encoder.library.encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(p, encoder.kind).tolist() for p in encoder.encode(texts)] == expected


def test_a_word_is_looked_up_once_for_texts_side_by_side(monkeypatch):
    """Not once for each time it occurs: that takes most of the time."""
    asked = []

    class Counting(token_files.Words):
        def __getitem__(self, word):
            asked.append(word)
            return super().__getitem__(word)

    monkeypatch.setattr(token_files, "Words", Counting)
    encoder = token_files.Encoder(PATH)
    encoder.encode(["one and one and one again, one and"] * 50)
    assert len(asked) <= 12 and len(set(asked)) == len(asked)


def test_words_are_encoded_as_in_their_texts(library, monkeypatch):
    """Also where words at hand are thrown away in between, and with other kinds of vocabulary."""
    monkeypatch.setattr(token_files, "KEPT_WORDS", 40)
    texts = ["It's  a\n\n test <|endoftext|>it’s　ok 12３ x", "", "\x00\x1c é ﬁ 日本語", " lead", "trail  ", "a" * 3_000]
    texts += [f"w{i} w{i % 7} again" for i in range(90)]
    encoder = token_files.Encoder(PATH)
    assert encoder.by_word
    for low in range(0, len(texts), 9):
        part = texts[low : low + 9]
        for text, packed in zip(part, encoder.encode(part)):
            assert np.frombuffer(packed, encoder.kind).tolist() == library.encode(text, add_special_tokens=False).ids
    encoder.by_word = False
    assert [np.frombuffer(p, encoder.kind).tolist() for p in encoder.encode(texts)] == [
        library.encode(t, add_special_tokens=False).ids for t in texts
    ]
