"""Token counts from pre-token frequencies, without token ids per document.

A byte-level BPE tokenizer merges within pre-tokens only, so a text's count is
the sum over its pre-tokens of the pieces each one makes.  Documents turn into
pre-token frequencies, pieces are counted once per distinct pre-token, and a
join brings the two together:

* Pre-tokens that are vocabulary entries (at most the vocabulary's size, a
  fixed bound) are joined map-side.  These are the frequent ones.
* The others are shuffled once by pre-token, sorted, counted and joined in one
  pass.  A row is one pre-token of one slice of documents with its frequencies
  in all of them, so even a frequent pre-token has few rows.
"""
from __future__ import annotations

import bisect
import itertools
import json
import os
import re
import unicodedata
from collections import defaultdict

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import arrow_map, corpus, slices

#: Documents of a slice; place and frequency are packed in one int.
SLICE_BITS = 12
_MOST = (1 << (31 - SLICE_BITS)) - 1
#: Documents whose frequencies of one pre-token meet in one task; beyond, a pre-token is counted once per so many.
GROUP_DOCS = 1 << 24

#: Pre-token pattern of byte-level BPE, with the white space of the tokenizer's library.
_PATTERN = r"'(?:[stmd]|re|ve|ll)| ?{L}+| ?{N}+| ?{O}+|{S}+(?!{T})|{S}+"
_FIND = regex.compile(_PATTERN.format(L=r"\p{L}", N=r"\p{N}", O=r"[^\p{White_Space}\p{L}\p{N}]", S=r"\p{White_Space}", T=r"\P{White_Space}"))
#: The same for texts of Latin-1 characters only, in the faster standard library.
LATIN_LETTERS, LATIN_NUMBERS, LATIN_SPACE = _L, _N, _S = r"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", r"0-9\xb2\xb3\xb9\xbc-\xbe", r"\t-\r \x85\xa0"
_FIND_LATIN = re.compile(_PATTERN.format(L=f"[{_L}]", N=f"[{_N}]", O=f"[^{_S}{_L}{_N}]", S=f"[{_S}]", T=f"[^{_S}]"))
#: What the libraries may class differently, for their Unicode versions differ: texts with such
#: characters are split by the tokenizer's own pre-tokenizer.
_RECENT: list = []
_LOADED: dict[str, "Counting"] = {}


def recent() -> re.Pattern:
    """Characters that ``regex`` takes for letters, numbers or white space and ``unicodedata`` does not, or the reverse."""
    if not _RECENT:
        every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
        odd = set()
        for name, category in (("L", "L"), ("N", "N")):
            odd |= set(regex.findall(rf"\p{{{name}}}", every)) ^ {c for c in every if unicodedata.category(c)[0] == category}
        codes = sorted(map(ord, odd))
        starts = [c for c in codes if c - 1 not in set(codes[max(0, bisect.bisect_left(codes, c) - 1):bisect.bisect_left(codes, c)])]
        ranges = zip(starts, [codes[bisect.bisect_left(codes, s) - 1] for s in starts[1:]] + codes[-1:])
        _RECENT.append(re.compile("[" + "".join(f"{re.escape(chr(a))}-{re.escape(chr(b))}" for a, b in ranges) + "]" if odd else r"(?!)"))
    return _RECENT[0]


class Counting:
    """A tokenizer file with what counting needs."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec["pre_tokenizer"] or {}
        if spec["model"]["type"] != "BPE" or pre.get("type") != "ByteLevel" or not pre.get("use_regex", True) or pre.get("add_prefix_space") \
                or spec["normalizer"] or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("a byte-level BPE file with plain added tokens is needed")
        self.tokenizer = Tokenizer.from_file(path)
        added = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.recent = recent()
        self.added = regex.compile("|".join(map(regex.escape, added))) if added else None
        known = [t for t in self.tokenizer.decode_batch([[i] for i in spec["model"]["vocab"].values()], skip_special_tokens=False)
                 if "\ufffd" not in t and _FIND.fullmatch(t) and not (self.added and self.added.search(t))]
        self.known = dict(zip(known, self.pieces(known)))

    def pieces(self, tokens: list[str]) -> list[int]:
        return [len(e.ids) for e in self.tokenizer.encode_batch_fast(tokens, add_special_tokens=False)]

    def split(self, text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            if self.recent.search(text):
                return [text[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]
            return _FIND.findall(text)
        return _FIND_LATIN.findall(text)

    def pretokens(self, text: str) -> tuple[list[str], int]:
        """Pre-tokens in order, and the number of added tokens in the text."""
        parts = self.added.split(text) if self.added else [text]
        if len(parts) == 1:
            return self.split(text), 0
        return [w for p in parts for w in self.split(p)], len(parts) - 1


def counting(path: str) -> Counting:
    if path not in _LOADED:
        _LOADED[path] = Counting(path)
    return _LOADED[path]


def _frequency_stage(path: str):
    schema = pa.schema([("pretoken", pa.string()), ("base", pa.int64()), ("packed", pa.list_(pa.int32())),
                        ("docs", pa.list_(pa.struct([("did", pa.int64()), ("n_bytes", pa.int64()), ("n", pa.int64())])))])

    def run(batches):
        count = counting(path)
        for b in slices(batches, 1 << SLICE_BITS):
            number: dict[str, int] = defaultdict(itertools.count().__next__)  # of each pre-token of the slice
            ids, sizes, extra, n_bytes = [], [], [], []
            for text in b.column("text").to_pylist():
                words, n = count.pretokens(text)
                ids.append(np.fromiter(map(number.__getitem__, words), dtype=np.int64, count=len(words)))
                sizes.append(len(words)), extra.append(n), n_bytes.append(len(text.encode("utf-8", "surrogatepass")))
            words = list(number)
            each = np.fromiter((count.known.get(w, 0) for w in words), dtype=np.int64, count=len(words))
            doc = np.repeat(np.arange(len(sizes)), sizes)
            flat = np.concatenate(ids)
            n = np.array(extra) + np.bincount(doc, weights=each[flat], minlength=len(sizes)).astype(np.int64)
            open_ = each[flat] == 0
            pair, freq = np.unique(flat[open_] << SLICE_BITS | doc[open_], return_counts=True)
            while len(pair) and freq.max() > _MOST:  # a frequency beyond the packed size becomes several
                over = freq > _MOST
                pair, freq = np.r_[pair, pair[over]], np.r_[np.where(over, freq - _MOST, freq), np.full(over.sum(), _MOST)]
                order = np.argsort(pair, kind="stable")
                pair, freq = pair[order], freq[order]
            word = pair >> SLICE_BITS
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]]) if len(word) else np.zeros(0, dtype=np.int64)
            packed = (freq << SLICE_BITS | pair & ((1 << SLICE_BITS) - 1)).astype(np.int32)
            base = b.column("uid")[0].as_py()
            rows = pa.ListArray.from_arrays(pa.array(np.r_[starts, len(word)].astype(np.int32)), pa.array(packed))
            names = pa.array([words[i] for i in word[starts].tolist()], pa.string())
            yield pa.record_batch([names, pa.array(np.full(len(starts), base)), rows, pa.nulls(len(starts), schema.field("docs").type)], schema=schema)
            docs = pa.StructArray.from_arrays([b.column("did"), pa.array(n_bytes, pa.int64()), pa.array(n)], names=["did", "n_bytes", "n"])
            yield pa.record_batch([pa.array([""]), pa.array([base]), pa.array([None], schema.field("packed").type),
                                   pa.ListArray.from_arrays(pa.array([0, len(docs)], pa.int32()), docs)], schema=schema)

    return run


def _piece_stage(path: str):
    """Rows sorted by pre-token get its ``pieces``; each pre-token is counted once."""
    def run(batches):
        count = counting(path)
        last, pieces = None, 0
        for b in slices(batches, 20_000):
            words = b.column("pretoken").to_pylist()
            fresh = list(dict.fromkeys(w for w in words if w is not None and w != last))
            known = dict(zip(fresh, count.pieces(fresh)))
            if last is not None:
                known[last] = pieces
            if words[-1] is not None:
                last, pieces = words[-1], known[words[-1]]
            yield pa.record_batch([b.column("base"), b.column("packed"), b.column("docs"),
                                   pa.array([None if w is None else known[w] for w in words], pa.int64())], names=["base", "packed", "docs", "pieces"])

    return run


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``did``, ``n_bytes`` (UTF-8) and ``n_tokens``.

    ``path`` is a byte-level BPE ``.json`` file on every machine.  Whole texts
    are counted; begin and end tokens are not added, strings of added tokens
    inside a text count as that token, as the library does by default.  Null
    texts count as empty (0 tokens); null ids and repeated rows keep a row
    each; an empty table gives no rows.
    """
    counting(path)  # a wrong file fails here
    rows = corpus(docs, id_col, text_col).withColumn("uid", F.monotonically_increasing_id())
    docs_type = "array<struct<did: bigint, n_bytes: bigint, n: bigint>>"
    freq = arrow_map(rows, _frequency_stage(path), f"pretoken string, base long, packed array<int>, docs {docs_type}")
    # one task joins a pre-token to the frequencies of at most GROUP_DOCS documents; a slice's own row goes anywhere
    groups = max(1, -(-rows.count() // GROUP_DOCS))
    salt = F.when(F.col("packed").isNotNull(), F.pmod(F.xxhash64("base"), F.lit(groups))).otherwise(F.col("base"))
    dealt = freq.withColumn("pretoken", F.when(F.col("packed").isNotNull(), F.col("pretoken"))) \
        .repartition("pretoken", salt).sortWithinPartitions("pretoken")
    met = arrow_map(dealt, _piece_stage(path), f"base long, packed array<int>, docs {docs_type}, pieces long")
    mask = (1 << SLICE_BITS) - 1
    rest = met.select("base", "pieces", "docs", F.explode_outer("packed").alias("x"))
    each = rest.select("docs", F.col("base"), (F.col("base") + F.col("x").bitwiseAND(mask)).alias("uid"),
                       (F.shiftright("x", SLICE_BITS) * F.col("pieces")).alias("n"))
    one = F.array(F.struct(F.lit(None).cast("long").alias("did"), F.lit(None).cast("long").alias("n_bytes"), F.col("n")))
    summed = each.select("uid", "base", F.posexplode(F.coalesce("docs", one)).alias("at", "d")) \
        .select(F.coalesce("uid", F.col("base") + F.col("at")).alias("uid"), "d.*") \
        .groupBy("uid").agg(F.max("did").alias("did"), F.max("n_bytes").alias("n_bytes"), F.sum("n").alias("n_tokens"))
    return summed.select("did", "n_bytes", "n_tokens")
