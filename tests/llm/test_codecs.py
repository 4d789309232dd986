"""Token shards, SentencePiece pieces and the shared memo."""

from __future__ import annotations

import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

import __spark_entry__ as entry
from tests.llm.conftest import CLASHES, awkward, prose
from tests.llm.test_text_models import thue_morse
from tidemark.llm import files, pieces, token_store
from tidemark.llm.memo import SpanMemo

FOLDER = "/root/testdata/sf0.01"
WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    "", " ", "  Hello   world\n\tfoo", "\x00a\x00 b", "日本語 テスト 🙂🙂 ﬁ", "a" * 3000, "    " * 40 + "x", "\n\n a \n",
    "ab" * 900 + " " + "é" * 300, "▁ literal ▁▁mark", "<0x0A> <s> </s> <unk> <|endoftext|>", "It's don't WE'RE İstanbul ΣΑΣ ß",
    "e\u0301 E\u0301 x² ½ 12.5% “q” café, naïve!! Ñandú... a\x1cb\u00a0c\u2003d\r\n", "हिन्दी русский язык",
]


def random_texts(n: int) -> list[str]:
    rnd = random.Random(11)
    letters = "abcdethison  ▁\n.,'éßñ日🙂0123=_-/T"
    return ["".join(rnd.choices(letters, k=rnd.randint(1, 150))) for _ in range(n)]


def test_memo_gives_what_the_encoder_gives():
    calls = []

    def encode(spans):
        calls.append(len(spans))
        return [np.frombuffer(s, np.uint8).astype("<u2").tobytes() for s in spans]

    memo = SpanMemo(encode, np.dtype("<u2"), 8)
    rnd = random.Random(2)
    for _ in range(30):
        words = [bytes(rnd.choices(b"abc", k=rnd.randint(1, 3))) for _ in range(40)]
        data = np.frombuffer(b" ".join(words) + b" ", np.uint8)
        end = np.flatnonzero(data == 32)
        begin = np.concatenate(([0], end[:-1] + 1))
        ids, before = memo(data, begin, end)
        assert [bytes(ids[a:b].astype(np.uint8)) for a, b in zip(before[:-1], before[1:], strict=True)] == words
    assert memo.count <= 8 and max(calls) > 0


def test_ids_equal_those_of_the_library():
    texts = ODD + random_texts(300) + [r[1] for r in awkward()[:14]]
    plain = Tokenizer.from_file(WORDS)
    want = [plain.encode(t or "", add_special_tokens=False).ids + [1] for t in texts]
    for by_word in (True, False):
        got = token_store.Encoder(WORDS, by_word).batch(pa.array(texts), 1)
        assert [np.frombuffer(g, "<u2").tolist() for g in got] == want


def stored(spark, documents, shard_bytes):
    manifest = token_store.write_tokens(documents, files.new_folder(spark, "tokens"), WORDS, 1, shard_bytes=shard_bytes)
    ids = token_store.read_tokens(manifest, "ids array<int>", lambda x: (x.tolist(),))
    return manifest, ids.orderBy("start").collect()


@pytest.mark.parametrize("shard_bytes", [1 << 30, 20_000])
def test_shards_hold_all_documents_in_order(spark, clashing, shard_bytes):
    manifest, rows = stored(spark, clashing, shard_bytes)
    plain = Tokenizer.from_file(WORDS)
    want = {(i, tuple(plain.encode(t or "", add_special_tokens=False).ids + [1])) for i, t, *_ in awkward()}
    assert len(rows) == len(awkward()) and {(r["doc_id"], tuple(r["ids"])) for r in rows} == want
    keys = [(r["doc_id"] is not None, r["doc_id"] or 0) for r in rows]
    assert keys == sorted(keys)
    assert [r["start"] for r in rows] == np.cumsum([0] + [len(r["ids"]) for r in rows])[:-1].tolist()
    assert (manifest.count() > 1) == (shard_bytes < 1 << 30)
    shard = token_store.Shard(manifest.orderBy("shard").first()["path"])
    assert [shard.document(i).tolist() for i in reversed(range(len(shard)))] == [r["ids"] for r in rows[: len(shard)]][::-1]


def test_a_short_document_takes_little(spark):
    rows = [(i, " ".join(prose(i % 5, 30).split()[: 5 + i % 20])) for i in range(400)]
    manifest, _ = stored(spark, spark.createDataFrame(rows, "doc_id bigint, text string"), 1 << 30)
    found = manifest.first()
    assert found["documents"] == 400 and found["dictionary"] and found["bytes"] < 400 * 21 + 64 + 2 * found["tokens"]


def test_shards_of_an_empty_table(spark, none):
    manifest, rows = stored(spark, none, 1 << 20)
    assert rows == [] and manifest.count() == 0


def test_damaged_shards_raise(spark, documents, tmp_path):
    manifest, _ = stored(spark, documents, 1 << 30)
    uri = manifest.first()["path"]
    data = files.read_bytes(uri)
    files.write_bytes(str(tmp_path), "cut.tok", data[:-1])
    with pytest.raises(ValueError):
        token_store.Shard(f"{tmp_path}/cut.tok")


def test_failed_writes_leave_no_file(tmp_path):
    with pytest.raises(RuntimeError), files.replacing(str(tmp_path), "x.bin") as out:
        out.write(b"half")
        raise RuntimeError
    assert list(tmp_path.iterdir()) == []


def test_token_query_against_the_library(spark):
    plain, at = Tokenizer.from_file(WORDS), 0
    got = entry.queries()["op1_token_store"](spark, FOLDER).orderBy("doc_id").collect()
    texts = spark.read.parquet(f"{FOLDER}/documents.parquet").orderBy("doc_id").collect()
    for row, own in zip(texts, got, strict=True):
        ids = plain.encode(row["text"], add_special_tokens=False).ids + [1]
        assert tuple(own) == (row["doc_id"], at, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))
        at += len(ids)


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=PIECES)


def test_pieces_equal_those_of_the_library(library):
    texts = ODD + random_texts(400) + [r[1] or "" for r in awkward()]
    codec = pieces.Codec(PIECES)
    got = codec.encode(pa.array(texts))
    assert [g.tolist() for g in got] == library.encode(texts)
    assert [pieces.Decoder(PIECES).decode(g) for g in got] == [t.replace("▁", " ") for t in texts]


def test_long_words_relax_like_short_ones(library, monkeypatch):
    texts = random_texts(150) + ["the" * 70, "aaab" * 60]
    monkeypatch.setattr(pieces, "LONG_WORD", 3)
    alone = [g.tolist() for g in pieces.Codec(PIECES).encode(pa.array(texts))]
    monkeypatch.setattr(pieces, "LONG_WORD", 1 << 20)
    together = [g.tolist() for g in pieces.Codec(PIECES).encode(pa.array(texts))]
    assert alone == together == library.encode(texts)


def test_small_memos_and_chunks_change_nothing(library, monkeypatch):
    monkeypatch.setattr(pieces, "MEMO_WORDS", 4)
    monkeypatch.setattr(pieces, "CHUNK_BYTES", 40)
    texts = random_texts(60)
    codec = pieces.Codec(PIECES)
    for _ in range(2):
        assert [g.tolist() for g in codec.encode(pa.array(texts))] == library.encode(texts)


def test_suffix_array_and_matches_against_brute_force():
    v = pieces.Vocabulary(PIECES)
    words = [w.encode() for w in " the theatre|ing|banana bananas| |日本|\x00|  x".split("|")]
    data = np.frombuffer(b"\xff" + b"\xff".join(words) + b"\xff", np.uint8)
    starts = np.flatnonzero(((data & 0xC0) != 0x80) & (data != 0xFF))
    raw = data.tobytes() + b"\xff" * 64
    order = pieces.suffix_array(pieces._eights(data), starts, v.levels)
    assert order.tolist() == sorted(starts.tolist(), key=lambda i: (raw[i : i + 8 * v.levels], i))
    shown = [v.shown[i] for i in v.ids]
    want = sorted((i, i + len(p), k) for k, p in enumerate(shown) for i in starts.tolist() if raw.startswith(p, i))
    got = sorted(zip(*(x.tolist() for x in pieces.match(v, data)), strict=True))
    assert got == want


def test_encoding_and_decoding_tables(spark, documents, clashing, none, library):
    rows = pieces.encode_documents(clashing, PIECES).collect()
    assert len(rows) == clashing.count()
    for r in rows:
        ids = library.encode(r["text"] or "")
        assert r["ids"] == ids and r["n_ids"] == len(ids) and r["score"] == "own score"
        assert r["ids_crc32"] == zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))
    encoded = pieces.encode_documents(documents, PIECES, drop_text=True)
    assert "text" not in encoded.columns
    back = pieces.decode_documents(encoded.withColumn("ids", F.when(F.col("doc_id") != 3, F.col("ids"))), PIECES)
    texts = {r["doc_id"]: r["text"] for r in back.where("doc_id is not null").collect()}
    own = {i: (t or "").replace("▁", " ") for i, t, *_ in awkward() if i is not None}
    assert texts == own | {3: ""}
    assert pieces.encode_documents(none, PIECES).count() == 0
    assert pieces.decode_documents(pieces.encode_documents(none, PIECES), PIECES).count() == 0


def test_piece_query_round_trips(spark, library):
    got = {r["doc_id"]: r for r in entry.queries()["op9_sentencepiece"](spark, FOLDER).collect()}
    texts = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    assert len(got) == len(texts)
    assert all(got[t["doc_id"]]["ids"] == library.encode(t["text"]) and got[t["doc_id"]]["round_trips"] for t in texts)


@pytest.mark.parametrize("letters", [2**8, 2**10, 2**12, 2**14])
def test_words_that_simple_hashes_confuse(spark, letters):
    """Thue-Morse words are one word to a polynomial hash modulo a power of two."""
    texts = [f"{w} and {w}" for w in thue_morse(letters)] + [" ".join(thue_morse(letters))]
    plain = Tokenizer.from_file(WORDS)
    encoder = token_store.Encoder(WORDS, True)
    got = [np.frombuffer(b, encoder.dtype).tolist() for b in encoder.batch(pa.array(texts), 1)]
    assert got == [plain.encode(t, add_special_tokens=False).ids + [1] for t in texts]
    codec, decoder, library = pieces.Codec(PIECES), pieces.Decoder(PIECES), SentencePieceProcessor(model_file=PIECES)
    ids = codec.encode(pa.array(texts))
    assert [i.tolist() for i in ids] == [library.encode(t) for t in texts]
    assert [decoder.decode(i) for i in ids] == texts
