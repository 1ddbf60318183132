"""Byte-level BPE through a sentencepiece model written straight from the vocabulary.

A vocabulary file lists byte strings with their ranks. Each becomes a piece of a sentencepiece BPE
model: its bytes mapped one to one to printable characters, its score the negative rank, its id the
rank, with identity normalisation. No tokenizer is trained. A text is cut into pre-tokens by the
given pattern and each pre-token is encoded by itself. Decoding reads the pieces of the ids from the model and
maps their characters back to bytes.

A pre-token that is itself in the vocabulary is that one token, as in the tokenizer whose ranks
these are; sentencepiece merges the others, always taking the pair of lowest rank, leftmost first.

The model is a few MB of a fixed vocabulary and is broadcast. Pre-tokens already encoded are kept in
a dictionary of bounded size, which changes the time and not the result.

Defined results: a null text is encoded as empty (no ids, the digests of the empty string). Rows are
independent of each other: repeated rows repeat, an empty table gives an empty result, other columns
are not read.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEPT_BYTES = 32 << 20  # of pre-tokens kept per task, about
SLICE = 50_000  # pre-tokens encoded at a time


def byte_characters() -> list[str]:
    """A printable character for each byte value, none of them white space or special to sentencepiece."""
    return [chr(0x4E00 + b) for b in range(256)]


def read_ranks(path: str) -> list[bytes]:
    """Byte strings in rank order of a file with one ``base64 rank`` pair a line; ranks must be 0..n-1."""
    with open(path, "rb") as f:
        pairs = sorted((int(rank), base64.b64decode(token)) for token, rank in (x.split() for x in f if x.strip()))
    if [rank for rank, _ in pairs] != list(range(len(pairs))):
        raise ValueError("ranks must be 0..n-1, each once")
    return [token for _, token in pairs]


def _varint(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _number(field: int, n: int) -> bytes:
    return _varint(field << 3) + _varint(n)


def _block(field: int, body: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(body)) + body


def model_bytes(tokens: list[bytes]) -> bytes:
    """The vocabulary as a serialised sentencepiece model.

    Field numbers are those of sentencepiece's public model description. Id n, one past the last
    rank, is the mandatory unknown piece; every byte has a piece, so it is never produced.
    """
    char = byte_characters()
    if {bytes([b]) for b in range(256)} - set(tokens):
        raise ValueError("the vocabulary must hold every single byte")
    out = []
    for rank, token in enumerate(tokens):
        piece = "".join(char[b] for b in token).encode()
        out.append(_block(1, _block(1, piece) + _varint(2 << 3 | 5) + struct.pack("<f", -float(rank)) + _number(3, 1)))
    out.append(_block(1, _block(1, b"<unk>") + _varint(2 << 3 | 5) + struct.pack("<f", 0.0) + _number(3, 2)))
    bpe, absent = 2, -1
    trainer = (_number(3, bpe) + _number(4, len(tokens) + 1) + _number(40, len(tokens))
               + _number(41, absent) + _number(42, absent) + _number(43, absent))
    identity = _block(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0)
    return b"".join(out) + _block(2, trainer) + _block(3, identity)


class Codec:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, tokens: list[bytes], pattern: str, model: bytes | None = None) -> None:
        import regex
        import sentencepiece

        self._whole = {token: rank for rank, token in enumerate(tokens)}
        self._find = regex.compile(pattern).findall
        self._sp = sentencepiece.SentencePieceProcessor(model_proto=model or model_bytes(tokens))
        chars = byte_characters()
        self._table = str.maketrans(dict(zip(map(chr, range(256)), chars)))
        back = str.maketrans(dict(zip(chars, map(chr, range(256)))))
        pieces = self._sp.id_to_piece(list(range(len(tokens))))
        self._bytes = [piece.translate(back).encode("latin-1") for piece in pieces]
        self._known: dict[str, bytes] = {}
        self._held = 0

    def _learn(self, words: list[str]) -> None:
        merge = []
        for word in words:
            raw = word.encode()
            self._held += len(raw) + 100
            rank = self._whole.get(raw)
            if rank is None:
                merge.append((word, raw.decode("latin-1").translate(self._table)))
            else:
                self._known[word] = struct.pack("<I", rank)
        if merge:
            for (word, _), ids in zip(merge, self._sp.encode([m for _, m in merge], out_type=int, num_threads=1)):
                self._known[word] = struct.pack(f"<{len(ids)}I", *ids)

    def _ids(self, words: list[str]) -> bytes:
        unknown = set(words).difference(self._known)
        if unknown and self._held > KEPT_BYTES:
            self._known, self._held, unknown = {}, 0, set(words)
        if unknown:
            self._learn(list(unknown))
        return b"".join([self._known[w] for w in words])

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        words = self._find(text)
        return b"".join(self._ids(words[at:at + SLICE]) for at in range(0, len(words), SLICE))

    def decode(self, ids: bytes) -> bytes:
        """The bytes of a text from its ids: each id's piece in the model, its characters mapped back."""
        raw = self._bytes
        return b"".join([raw[i] for i in np.frombuffer(ids, "<u4").tolist()])


def tokenize(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
             keep_ids: bool = True) -> DataFrame:
    """Per row: id, n_tokens, ids_sha256, decoded_sha256 and, if kept, the ids themselves."""
    tokens = read_ranks(vocabulary)
    shared = docs.sparkSession.sparkContext.broadcast((tokens, model_bytes(tokens)))
    kind = dict(docs.dtypes)[id_col]
    schema = f"{id_col} {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + (
        ", ids array<int>" if keep_ids else "")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(shared.value[0], pattern, shared.value[1])
        for batch in batches:
            n, ids_sha, text_sha, kept = [], [], [], []
            for text in batch.column(1):
                ids = codec.encode(text.as_py() or "")
                n.append(len(ids) // 4)
                ids_sha.append(hashlib.sha256(ids).hexdigest())
                text_sha.append(hashlib.sha256(codec.decode(ids)).hexdigest())
                if keep_ids:
                    kept.append(np.frombuffer(ids, "<u4").astype(np.int32))
            out = [batch.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()),
                   pa.array(text_sha, pa.string())]
            names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"]
            if keep_ids:
                out.append(pa.array(kept, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(out, names)

    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(run, schema)
