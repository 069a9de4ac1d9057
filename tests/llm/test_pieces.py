"""SentencePiece codec against the library."""

import hashlib
import itertools
import random

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import sentencepiece

from sillage.llm import piece_codec, queries

SMALL = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("piece_bpe_32k.model")
EDGE = ["", " ", "  a  b ", "a▁b", "\x00\n\t x", "<s> hi </s>", "<0x41>", "ﬁ １２　x\xa0y", "🙂👍🏽", "﻿a​b", " " * 5000, "a" * 5000,
        "the " * 5000, "é" * 3000, "▁" * 33, "\r\n"]


@pytest.fixture(scope="module")
def codec():
    with open(PATH, "rb") as f:
        return piece_codec.Codec(f.read())


def test_codec_equals_the_library(codec):
    rnd = random.Random(1)
    parts = ["▁", " ", "  ", "a", "the ", "é", "́", "🙂", "中", "\x00", "\n", "</s>", "<0x41>", "of", "​", " " * 17, "█", "ing"]
    for text in EDGE + ["".join(rnd.choices(parts, k=rnd.randint(0, 14))) for _ in range(3000)]:
        ids = codec.encode([text])[0].tolist()
        assert ids == codec.library.encode(text, add_eos=True), text
        assert codec.decode(ids) == codec.library.decode(ids), text


def test_decode_of_any_ids(codec):
    rnd = random.Random(2)
    for _ in range(3000):
        ids = [rnd.choice([0, 1, 2, rnd.randint(3, 258), 259, 264, rnd.randrange(32000)]) for _ in range(rnd.randint(0, 9))]
        assert codec.decode(ids) == codec.library.decode(ids), ids


def test_agendas_side_by_side_equal_the_heap(codec):
    """Arrays and heap give the same for words, and for texts that aren't cut at all."""
    with open(f"{SMALL}/documents.parquet", "rb") as f:
        texts = [t or "" for t in pq.read_table(f).column("text").to_pylist()]
    words = [codec.library.normalize(w) for t in [*texts, *EDGE] for w in t.split(" ")[:200] if w and len(w) < 99]
    assert codec.agendas(words) == [codec._heap(w) for w in words]
    for text in [*EDGE, "Several words, and  some more."]:
        assert np.frombuffer(codec._heap(codec.library.normalize(text)), np.int32).tolist() == codec.library.encode(text)


def test_small_table_and_many_texts(codec, monkeypatch):
    monkeypatch.setattr(piece_codec, "KEPT", 3)
    for _ in range(3):
        ids, ends = codec.encode(EDGE)
        assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:])] == codec.library.encode(EDGE, add_eos=True)
    assert codec.encode([])[0].tolist() == []


def test_chunks_that_share_a_digest():
    """With all powers 1, chunks of the same characters in another order have one digest."""
    with open(PATH, "rb") as f:
        codec = piece_codec.Codec(f.read())
    codec.powers = codec.inverse = np.ones_like(codec.powers)
    texts = ["tea eat ate", "eat, tea", "ate eta", " ".join(map("".join, itertools.permutations("stone")))]
    for _ in range(2):
        ids, ends = codec.encode(texts)
        assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:])] == codec.library.encode(texts, add_eos=True)


def test_digests_beyond_a_period(codec, monkeypatch):
    monkeypatch.setattr(piece_codec, "PERIOD", 7)
    for name in ("powers", "inverse"):
        monkeypatch.setattr(codec, name, getattr(codec, name)[:7])
    texts = ["some words and some words and some words", "words and more"] * 3
    ids, ends = codec.encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:])] == codec.library.encode(texts, add_eos=True)


def test_rows_in_use_outlast_others(monkeypatch):
    """The table stays bounded; a chunk of every batch is encoded once."""
    with open(PATH, "rb") as f:
        own = piece_codec.Codec(f.read())
    monkeypatch.setattr(piece_codec, "KEPT", 20)
    done, agendas = [], own.agendas
    monkeypatch.setattr(own, "agendas", lambda chunks: done.extend(chunks) or agendas(chunks))
    for k in range(60):
        text = f"always here {k} {k + 1000} x{k}y"
        assert own.encode([text])[0].tolist() == own.library.encode(text, add_eos=True)
        assert len(own.rows) <= 60 and len(own.rows) == len(own.used) == len(own.kept_ends) - 1 == len(own.char_ends) - 1
    assert sum("always" in c for c in done) == 1


def test_decode_of_whole_batches(codec):
    ids, ends = codec.encode(EDGE)
    assert codec.decode_all(ids, ends).to_pylist() == codec.library.decode(codec.library.encode(EDGE))
    ids, ends = codec.encode(["", ""])
    assert codec.decode_all(ids, ends).to_pylist() == ["", ""]
    none = np.zeros(0, np.int32)
    assert codec.decode_all(none, np.zeros(3, np.int64)).to_pylist() == ["", ""] and codec.decode_all(none, np.zeros(1, np.int64)).to_pylist() == []
    cut = np.array([codec.bytes[0xE4], codec.bytes[0xB8], *codec.library.encode("ab c")], np.int32)  # two of a character's three bytes
    ends = np.array([0, 2, len(cut)])
    assert codec.decode_all(cut, ends).to_pylist() == [codec.library.decode(cut[a:b].tolist()) for a, b in zip(ends, ends[1:])]


def test_round_trip_of_a_table(spark):
    rows = [(i, t, "x", "y") for i, t in enumerate([None, *EDGE, "twice", "twice"])]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string, n string")
    df = df.unionByName(df.where("doc_id is not null and doc_id < 3"))
    out = piece_codec.round_trip(df, PATH)
    assert out.columns == ["doc_id", "text", "n", "ids", "decoded", "agrees"]
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    got = out.collect()
    assert len(got) == len(rows) + 3 and all(r["agrees"] for r in got)
    assert all(r["ids"] == library.encode(r["text"] or "", add_eos=True) for r in got)
    assert piece_codec.round_trip(df.limit(0), PATH).count() == 0
    plain = piece_codec.round_trip(df.where("doc_id = 3"), PATH, end=False).first()
    assert plain["ids"] == library.encode(plain["text"])


def test_query(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = queries.QUERIES["op13_sentencepiece"](spark, SMALL).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode(texts[r["doc_id"]], add_eos=True)
        assert r["n_tokens"] == len(ids) and r["agrees"]
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()
