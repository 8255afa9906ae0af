"""Token counts against the tokenizer's own."""
import random

import public_tokenizers
from tokenizers import Tokenizer

from feedloom.llm import queries as Q
from feedloom.llm import token_counts as T

PATH = public_tokenizers.path("byte_bpe_50k.json")


def expect(texts):
    tok = Tokenizer.from_file(PATH)
    return [len(tok.encode(t or "", add_special_tokens=False).ids) for t in texts]


def test_pretokens_of_every_character():
    tok = Tokenizer.from_file(PATH)
    count = T.counting(PATH)
    chars = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    odd = [c for c in chars if count.recent.match(c)]
    plain = [c for c in chars if not count.recent.match(c)]
    assert len(odd) < 40_000
    for i in range(0, len(plain), 4000):
        text = "".join(f"a{c} {c}1{c}\n" for c in plain[i:i + 4000])
        assert T._FIND.findall(text) == [text[a:b] for _, (a, b) in tok.pre_tokenizer.pre_tokenize_str(text)]
    latin = "".join(f"a{c} {c}1{c}{c}b  {c}'s'll\n" for c in map(chr, range(256)))
    assert T._FIND_LATIN.findall(latin) == T._FIND.findall(latin) == [latin[a:b] for _, (a, b) in tok.pre_tokenizer.pre_tokenize_str(latin)]
    assert count.pretokens("a<|endoftext|>b")[1] == 1


def texts_of(rnd):
    pool = ["hello", "The", "don't", "été", "日本語", "🙂🙂", " ", "​", "  ", "\n\n", "\t", "1234567", "x" * 300, "<|endoftext|>",
            "<|endof", "text|>", "\x1c", "\x85", "__", "...", "ñ́", "אב", "\0"]
    return [None, "", " ", "\n"] + ["".join(rnd.choice(pool) + rnd.choice(["", " ", " "]) for _ in range(rnd.randrange(1, 80))) for _ in range(300)]


def test_counts(spark, monkeypatch):
    texts = texts_of(random.Random(8))
    texts += [texts[9]] * 5 + ["word " * 40_000]
    ids = [None if i % 50 == 7 else i // 2 for i in range(len(texts))]
    df = spark.createDataFrame(list(zip(ids, texts, ["z"] * len(texts))), "doc_id long, text string, pretoken string").repartition(3)
    got = sorted((r.did is None, r.did, r.n_bytes, r.n_tokens) for r in T.token_counts(df, PATH).collect())
    assert got == sorted((d is None, d, len((t or "").encode()), n) for d, t, n in zip(ids, texts, expect(texts)))


def test_frequencies_beyond_the_packed_size(spark, monkeypatch):
    monkeypatch.setattr(T, "_MOST", 3)
    import pyarrow as pa
    b = pa.record_batch([pa.array([5]), pa.array(["zzqj zzqj zzqj zzqj zzqj zzqj zzqj zzqj"]), pa.array([17])], names=["did", "text", "uid"])
    rows = [r for x in T._frequency_stage(PATH)([b]) for r in x.to_pylist() if r["pretoken"] == " zzqj"]
    assert sum(x >> T.SLICE_BITS for r in rows for x in r["packed"]) == 7 and all(r["base"] == 17 for r in rows)


def test_empty_table(spark):
    assert T.token_counts(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0


def test_query(spark):
    got = Q.queries()["op1_token_counts"](spark, "/root/testdata/sf0.001").orderBy("doc_id").collect()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").collect()
    want = expect([d.text for d in docs])
    assert [tuple(r) for r in got] == [(d.doc_id, len(d.text.encode()), n, n > 512) for d, n in zip(docs, want)]
