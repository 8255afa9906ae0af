"""Bit-packed token files: exact round trips against the tokenizer's library."""
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from feedloom.llm import queries as Q
from feedloom.llm import token_files as T

PATH = public_tokenizers.path("word_bpe_49k.json")


def brute(rows):
    """rows: (doc_id, text) in file order."""
    tok, start, out = Tokenizer.from_file(PATH), 0, []
    for did, text in rows:
        ids = tok.encode(text or "", add_special_tokens=False).ids + [1]
        out.append((did, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("bits", [1, 3, 8, 11, 16, 17, 31, 32])
def test_pack_and_unpack(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 1001, dtype=np.uint64).astype("<u4")
    data = T.pack(ids, bits)
    assert len(data) == -(-1001 * bits // 8) and (T.unpack(data, 1001, bits) == ids).all()


def test_bits_of_a_vocabulary():
    assert [T.id_bits(n) for n in (1, 2, 3, 256, 257, 49408, 65536, 65537)] == [1, 1, 2, 8, 9, 16, 16, 17]


def test_encoder_is_the_library():
    rnd, tok = random.Random(4), Tokenizer.from_file(PATH)
    enc = T.Encoder(PATH)
    assert enc.by_words and not T.Encoder(public_tokenizers.path("byte_bpe_50k.json")).by_words
    alphabet = "abcXYZ 019.,'\n\t\r\x0b\x0c\x1c\x85\xa0 　ßΣσéé世界ก🙂̸Å " + "   "
    texts = ["".join(rnd.choices(alphabet, k=rnd.randrange(60))) for _ in range(3000)]
    texts += ["", " ", "<|endoftext|>", "a<|startoftext|>b <|endoftext|> c", "it's we'RE ' s", "x" * 3000, "ΑΣ ΑΣ. ΑΣΑ"]
    alphabet = [chr(c) for c in range(256)] * 2 + list("abc's't12.  ")
    texts += ["".join(rnd.choices(alphabet, k=rnd.randrange(90))) for _ in range(3000)]
    assert enc.latin
    ids, sizes = enc.encode(texts)
    for t, n, e in zip(texts, sizes, np.cumsum(sizes)):
        assert ids[e - n:e].tolist() == tok.encode(t, add_special_tokens=False).ids, repr(t)
    assert [len(x) for x in enc.encode([])] == [0, 0]
    chunk, T.CHUNK = T.CHUNK, 50  # long texts are cut at white space
    remember, T.REMEMBER = T.REMEMBER, 5
    try:
        for t in (" ".join(texts[:200]), "\n".join(texts[200:400]), "x" * 500):
            assert enc.encode([t])[0].tolist() == tok.encode(t, add_special_tokens=False).ids
    finally:
        T.CHUNK, T.REMEMBER = chunk, remember


def test_round_trip_with_odd_rows(spark, tmp_path):
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choices("abcdefgh", k=rnd.randrange(1, 9)))
    rows = [(i, " ".join(word() for _ in range(rnd.randrange(80)))) for i in rnd.sample(range(-500, 5000), 200)]
    rows += [(9000, None), (9001, ""), (9002, "long " * 30000), (None, "no id"), (None, None)]
    df = spark.createDataFrame([(*r, 7, 8) for r in rows], "doc_id long, text string, shard int, did int").repartition(5)
    out = str(tmp_path / "shards")
    T.write_shards(df, PATH, out, shard_bytes=20000, block=64)
    got = sorted(T.read_documents(spark, out).collect(), key=lambda r: r.start)
    assert [r.did for r in got[:2]] == [None, None] and len({r.shard for r in got}) > 3
    texts = {"no id": "no id", "": None}
    nulls = [next(k for k, t in texts.items() if brute([(None, t)])[0][2:] == (r.n_tokens, r.ids_crc32)) for r in got[:2]]
    assert sorted(nulls) == ["", "no id"]
    want = brute([(None, t) for t in nulls] + sorted(r for r in rows if r[0] is not None))
    assert [(r.did, r.start, r.n_tokens, r.ids_crc32) for r in got] == want
    tok = Tokenizer.from_file(PATH)
    text = dict(rows)
    for path in (tmp_path / "shards").glob("part-*"):  # the files themselves, at random
        shard = T.Shard(np.memmap(path, dtype=np.uint8, mode="r"))
        assert shard.bits == 16 and shard.block == 64
        whole = shard.ids(0, shard.n_ids)
        for k in range(shard.n_docs):
            if not shard.null_ids[k]:
                assert shard.document(k).tolist() == tok.encode(text[int(shard.doc_ids[k])] or "", add_special_tokens=False).ids + [1]
            a = rnd.randrange(shard.n_ids)
            assert (shard.ids(a, a + 100) == whole[a:a + 100]).all()


def test_repeated_rows_of_one_id_are_dealt_over_shards(spark):
    rows = [(5, "same text again")] * 300 + [(4, "b"), (6, "a")]
    got = sorted(T.round_trip(spark.createDataFrame(rows, "doc_id long, text string"), PATH, shard_bytes=1000).collect(), key=lambda r: r.start)
    assert [(r.did, r.start, r.n_tokens, r.ids_crc32) for r in got] == brute(sorted(rows))
    assert max(sum(r.shard == s for r in got) for s in {r.shard for r in got}) < 200


def test_empty_table(spark):
    assert T.round_trip(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0


def test_a_broken_file_is_not_read():
    with pytest.raises(ValueError):
        T.Shard(b"x" * 200)


def test_query(spark):
    got = sorted(Q.queries()["op13_token_files"](spark, "/root/testdata/sf0.001").collect(), key=lambda r: r.start)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    assert [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got] == brute(sorted((r.doc_id, r.text) for r in docs))
