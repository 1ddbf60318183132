import hashlib

import numpy as np
import public_tokenizers
import tiktoken

from salesflow.llm import bytebpe

from .data import crowded, documents, frame, sorted_rows

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
TOKENS = bytebpe.read_ranks(PATH)
REFERENCE = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks={t: i for i, t in enumerate(TOKENS)}, special_tokens={})


def brute(rows):
    out = []
    for i, t in rows:
        ids = REFERENCE.encode_ordinary(t or "")
        out.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                    hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=str)


ODD = [(1, "▁a ▁▁ <unk> <s>"), (2, "日本語 😀😀 \x00\x01 á <|endoftext|>"), (3, "a" * 5000), (4, " \n\n  x\t\t"), (5, " " * 3000),
       (6, "ab" * 4000), (7, "it's we'LL 12345 ½ ٣")]


def test_whole_result_and_round_trip(spark):
    rows = documents() + ODD
    assert sorted_rows(bytebpe.tokenize(frame(spark, rows), PATH, PATTERN, keep_ids=False)) == brute(rows)


def test_ids_extra_columns_and_empty_table(spark):
    df = crowded(frame(spark, ODD))
    for r in bytebpe.tokenize(df, PATH, PATTERN).collect():
        assert r.ids == REFERENCE.encode_ordinary(dict(ODD)[r.doc_id])
    assert bytebpe.tokenize(df.limit(0), PATH, PATTERN).collect() == []


def test_forgetting_known_words_changes_nothing(monkeypatch):
    monkeypatch.setattr(bytebpe, "KEPT_BYTES", 300)
    monkeypatch.setattr(bytebpe, "SLICE", 3)
    codec = bytebpe.Codec(TOKENS, PATTERN)
    for _, t in documents()[:40] + ODD[:4]:
        ids = codec.encode(t or "")
        assert np.frombuffer(ids, "<u4").tolist() == REFERENCE.encode_ordinary(t or "")
        assert codec.decode(ids) == (t or "").encode()


def test_decoding_reads_the_pieces_of_the_model():
    swapped = list(TOKENS)
    a, b = TOKENS.index(b"a"), TOKENS.index(b"\xff")
    swapped[a], swapped[b] = swapped[b], swapped[a]
    codec = bytebpe.Codec(TOKENS, PATTERN, bytebpe.model_bytes(swapped))
    assert codec.decode(np.array([a, b], "<u4").tobytes()) == b"\xffa"
    every = np.arange(len(TOKENS), dtype="<u4").tobytes()
    assert bytebpe.Codec(TOKENS, PATTERN).decode(every) == b"".join(TOKENS)
