"""Token ids in binary shard files, each document compressed alone with a shared dictionary.

One zstandard dictionary is trained on the serialised id arrays of a bounded sample of documents
(DICTIONARY_SAMPLE documents, chosen by hash; the bound does not depend on the table) and stored
beside the shards under its SHA-256. A shard holds consecutive documents::

    magic 8 bytes | dictionary SHA-256, 32 bytes (zeros: none) | bytes of an id (2 or 4) | 7 zeros
    frame of every document: its ids, little-endian, as one zstandard frame
    index: doc_id int64[n] | has doc_id uint8[n] | n_tokens uint32[n] | end of frame uint64[n]
    start of the index uint64 | n uint64 | magic

A reader finds any document by its place in the index and decompresses that one frame. The manifest
(a table) has one row a shard: path, documents, tokens, bytes, and the first token's position.

Defined cases: a null text is encoded as an empty one, so it holds the end id only; documents with
equal or null doc_id are kept, null first, in an order set by a hash of their text; an
empty table gives one empty shard; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
import struct
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tidemark.llm import files
from tidemark.llm.batches import field, map_batches
from tidemark.llm.bytescan import Words, slices
from tidemark.llm.memo import SpanMemo
from tidemark.plans.materialize import materialize

MAGIC = b"TIDTOK01"
SHARD_BYTES = 32 << 20  # text bytes of a shard
DICTIONARY_SAMPLE = 2000
DICTIONARY_BYTES = 64 << 10
SAMPLE_CHARS = 20_000_000
MEMO_WORDS, MEMO_STEMS = 1_000_000, 300_000
LEVEL = 3
_HEADER, _FOOTER = struct.Struct("<8s32sB7x"), struct.Struct("<QQ8s")
_STEM = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([.,;:!?|#*$%&]*)")


class Encoder:
    """Encodes texts to serialised ids, remembering the ids of words and of word stems.

    With `by_word` the tokenizer must be one that never lets a token reach over white space, folds case, and
    parts letters from punctuation: then a text's ids are those of its words one by one, and a word
    of Latin letters with closing punctuation has the ids of its stem in lower case and of the
    punctuation. Without it texts are encoded whole. Memos hold MEMO_WORDS words and MEMO_STEMS
    stems at most; later ones are encoded anew.
    """

    def __init__(self, path: str, by_word: bool = True):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.dtype = np.dtype(f"<u{self.width}")
        self.by_word, self.stems = by_word, {"": b""}
        self.memo = SpanMemo(self._new_words, self.dtype, MEMO_WORDS)

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.dtype).tobytes() for e in found]

    def _new_words(self, words: list[bytes]) -> list[bytes]:
        cut = []
        for word in words:
            word = word.decode()
            found = _STEM.fullmatch(word)
            cut.append((found[1].lower(), found[2]) if found else (word, ""))
        stems = self.stems
        new = list({part for parts in cut for part in parts}.difference(stems))
        stems.update(zip(new, self._encode(new), strict=True))
        out = [stems[stem] + stems[tail] for stem, tail in cut]
        if len(stems) > MEMO_STEMS:
            for part in new:
                del stems[part]
        return out

    def batch(self, texts: pa.Array, end_id: int) -> list[bytes]:
        end = np.array([end_id], self.dtype).tobytes()
        if not self.by_word:
            return [ids + end for ids in self._encode([t or "" for t in texts.to_pylist()])]
        out = []
        for part in slices(texts):
            words = Words(part)
            ids, before = self.memo(part.data, words.begin, words.end)
            raw, cut = ids.tobytes(), before * self.width
            edges = zip(cut[words.first].tolist(), cut[words.last].tolist(), strict=True)
            out += [raw[lo:hi] + end for lo, hi in edges]
        return out


@lru_cache(2)
def encoder(path: str, by_word: bool) -> Encoder:
    return Encoder(path, by_word)


def _sample(documents: DataFrame, path: str, end_id: int, by_word: bool) -> list[bytes]:
    """Serialised ids of at most DICTIONARY_SAMPLE documents and SAMPLE_CHARS characters."""
    limit = SAMPLE_CHARS // DICTIONARY_SAMPLE
    hashed = documents.select(F.xxhash64("doc_id", "text").alias("h"), "text").where(F.length("text").between(1, limit))
    rows = hashed.agg(F.count(F.lit(1))).first()[0]
    every = max(1, rows // (2 * DICTIONARY_SAMPLE))
    few = hashed.where(F.pmod("h", F.lit(every)) == 0).orderBy("h", "text").limit(DICTIONARY_SAMPLE)

    def work(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(encoder(path, by_word).batch(field(b, "text"), end_id), pa.binary())], ["ids"])

    return [bytes(r[0]) for r in map_batches(few.select("text"), "ids binary", work).collect()]


def train_dictionary(samples: list[bytes]) -> bytes:
    """A dictionary for the samples; their own bytes where they are too few to train on."""
    if not samples:
        return b""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:DICTIONARY_BYTES]


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if data else None


def write_tokens(documents: DataFrame, folder: str, tokenizer: str, end_id: int, by_word: bool = True, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Encode documents (doc_id, text) with `tokenizer` (a file of the tokenizers library) into shards
    of ascending doc_id below `folder`, and return the stored manifest."""
    documents = documents.select("doc_id", "text")
    data = train_dictionary(_sample(documents, tokenizer, end_id, by_word))
    digest = hashlib.sha256(data).digest() if data else bytes(32)
    if data:
        files.write_bytes(folder, f"dictionary-{digest.hex()}.zstd", data)
    ranged, shards = files.sorted_shards(documents, "doc_id", F.col("text"), F.octet_length("text"), shard_bytes)

    def work(batches):
        codec = encoder(tokenizer, by_word)
        compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(data), write_content_size=True)
        writer, shard = None, None
        for b in batches:
            if not b.num_rows:
                continue
            if writer is None:
                shard = field(b, "_shard")[0].as_py()
                name = f"shard-{shard:06d}.tok"
                writer = _Writer(folder, name, digest, codec.width)
            ids = codec.batch(field(b, "text"), end_id)
            frames, doc_ids, copies = [compressor.compress(x) for x in ids], field(b, "doc_id"), np.array(field(b, "_copies"))
            if (copies > 1).any():
                for i, n in enumerate(copies.tolist()):
                    for lo in range(0, n, 1000):  # equal documents, a part at a time
                        k = min(1000, n - lo)
                        writer.add(pa.array([doc_ids[i].as_py()] * k, pa.int64()), [ids[i]] * k, [frames[i]] * k)
            else:
                writer.add(doc_ids, ids, frames)
        if writer:
            yield writer.close(shard)

    schema = "shard int, path string, documents bigint, tokens bigint, bytes bigint"
    manifest = materialize(map_batches(ranged.select("doc_id", "text", "_shard", "_copies"), schema, work))
    # One row a shard of SHARD_BYTES, so this window is a millionth of the input and less.
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    manifest = manifest.withColumn("first_token", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)))
    return materialize(manifest.withColumns({"dictionary": F.lit(digest.hex() if data else ""), "shards": F.lit(shards)}))


class _Writer:
    def __init__(self, folder: str, name: str, digest: bytes, width: int):
        self.context, self.uri, self.width = files.replacing(folder, name), f"{folder}/{name}", width
        self.out, self.at = self.context.__enter__(), _HEADER.size
        self.out.write(_HEADER.pack(MAGIC, digest, width))
        self.ids, self.known, self.counts, self.ends = [], [], [], []

    def add(self, doc_ids: pa.Array, ids: list[bytes], frames: list[bytes]) -> None:
        self.known.append(np.array(doc_ids.is_valid(), np.uint8))
        self.ids.append(np.array(doc_ids.fill_null(0), np.int64))
        self.counts.append(np.array([len(x) // self.width for x in ids], np.uint32))
        self.ends.append(self.at + np.cumsum([len(f) for f in frames], dtype=np.uint64))
        self.out.write(b"".join(frames))
        self.at = int(self.ends[-1][-1])

    def close(self, shard: int) -> pa.RecordBatch:
        index = [np.concatenate(x) for x in (self.ids, self.known, self.counts, self.ends)]
        for part in index:
            self.out.write(part.astype(part.dtype.newbyteorder("<")).tobytes())
        n = len(index[0])
        self.out.write(_FOOTER.pack(self.at, n, MAGIC))
        self.context.__exit__(None, None, None)
        total = self.at + 21 * n + _FOOTER.size
        row = [shard, self.uri, n, int(index[2].sum(dtype=np.int64)), total]
        return pa.RecordBatch.from_arrays(
            [pa.array([v], t) for v, t in zip(row, (pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()), strict=True)],
            ["shard", "path", "documents", "tokens", "bytes"],
        )


class Shard:
    """Reads one shard file; `document(i)` touches the frame of that document only."""

    def __init__(self, uri: str):
        self.file = files.open_file(uri)
        size = self.file.size()
        magic, digest, self.width = _HEADER.unpack(self._at(0, _HEADER.size))
        start, n, tail = _FOOTER.unpack(self._at(size - _FOOTER.size, _FOOTER.size))
        if magic != MAGIC or tail != MAGIC:
            raise ValueError(f"{uri} is no complete token shard")
        index = self._at(start, 21 * n)
        cut = [0, 8 * n, 9 * n, 13 * n, 21 * n]
        self.doc_ids, self.known, self.counts, self.ends = (
            np.frombuffer(index[a:b], t) for a, b, t in zip(cut, cut[1:], ("<i8", "u1", "<u4", "<u8"), strict=False)
        )
        data = b""
        if digest != bytes(32):
            data = files.read_bytes(f"{uri.rpartition('/')[0]}/dictionary-{digest.hex()}.zstd")
            if hashlib.sha256(data).digest() != digest:
                raise ValueError(f"the dictionary of {uri} is not the one it was written with")
        self.decompressor = zstandard.ZstdDecompressor(dict_data=_dictionary(data))

    def _at(self, start: int, size: int) -> bytes:
        self.file.seek(start)
        return self.file.read(size)

    def document(self, i: int) -> np.ndarray:
        start = int(self.ends[i - 1]) if i else _HEADER.size
        frame = self._at(start, int(self.ends[i]) - start)
        return np.frombuffer(self.decompressor.decompress(frame), f"<u{self.width}")

    def __len__(self) -> int:
        return len(self.doc_ids)


def read_tokens(manifest: DataFrame, schema: str, columns) -> DataFrame:
    """Run `columns(ids) -> tuple` on every stored document; returns doc_id, start and those columns.

    `schema` names the columns of the tuple. One task reads one shard, a document at a time.
    """
    kinds = to_arrow_schema(StructType.fromDDL(schema))
    # An empty table has a manifest without rows, and still one partition to read it in.
    shards = manifest.agg(F.max("shards")).first()[0] or 1

    def work(batches):
        for b in batches:
            for uri, first in zip(field(b, "path").to_pylist(), field(b, "first_token").to_pylist(), strict=True):
                shard = Shard(uri)
                starts = first + np.concatenate(([0], np.cumsum(shard.counts, dtype=np.int64)))[:-1]
                for lo in range(0, len(shard), 1000):
                    hi = min(lo + 1000, len(shard))
                    rows = [columns(shard.document(i)) for i in range(lo, hi)]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(shard.doc_ids[lo:hi], mask=shard.known[lo:hi] == 0),
                            pa.array(starts[lo:hi]),
                            *[pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds.types, strict=True)],
                        ],
                        ["doc_id", "start", *kinds.names],
                    )

    each = manifest.repartitionById(shards, F.col("shard"))
    return map_batches(each.select("path", "first_token"), f"doc_id bigint, start bigint, {schema}", work)
