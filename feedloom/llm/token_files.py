"""Token ids of documents in bit-packed binary files.

Every id takes the fewest bits that hold the vocabulary.  A file ("shard")
holds consecutive documents and is a row of sections, all numbers little-endian:

* header: ``FLTOKEN1``, then four u32: shard number, bits an id, ids a block,
  vocabulary size;
* blocks: ``ids a block`` ids each (the last one fewer), id ``i`` of a block in
  its bits ``i * bits`` and on, lowest bit first, filled up to a whole byte;
* document index: i64 ids of the documents, one u8 each (1: the id is null),
  u64 ordinals of their first ids and one more for the end;
* block table: u64 places of the blocks in the file and one more;
* footer of FOOTER bytes: five u64 (documents, ids, blocks, places of the
  document index and of the block table), then ``FLTOKEN1``.

A byte ``0x0A`` follows every section, so that Spark's own text writer can put
the files into any store that Spark writes to, with its commit of whole tasks.
``Shard`` reads any range of ids by unpacking the blocks that hold it.
"""
from __future__ import annotations

import itertools
import json
import os
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm.common import arrow_map, corpus, scratch_path, slices, stored
from feedloom.llm.token_counts import LATIN_LETTERS, LATIN_NUMBERS, LATIN_SPACE

#: Ids of a block, and text bytes that a shard is meant for.
BLOCK, SHARD_BYTES = 8192, 32 << 20
#: Words whose ids a task remembers before it forgets them all; characters split at a time.
REMEMBER, CHUNK = 1 << 18, 1 << 20

MAGIC = b"FLTOKEN1"
_HEADER, _FOOTER = "<8s4I", "<5Q8s"
FOOTER = struct.calcsize(_FOOTER)
_SPACE = re.compile("[ \t\n\r]")
_LOADED: dict[str, "Encoder"] = {}


def id_bits(vocabulary: int) -> int:
    """Bits of the largest id of a vocabulary."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids side by side, ``bits`` each, lowest bit first."""
    ids = np.ascontiguousarray(ids, dtype="<u4")
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    each = np.unpackbits(ids.view(np.uint8).reshape(-1, 4), axis=1, count=bits, bitorder="little")
    return np.packbits(each, bitorder="little").tobytes()


def unpack(data, n: int, bits: int) -> np.ndarray:
    """The ``n`` ids that ``pack`` put there."""
    if bits in (8, 16, 32):
        return np.frombuffer(data, dtype=f"<u{bits // 8}", count=n).astype("<u4")
    each = np.unpackbits(np.frombuffer(data, dtype=np.uint8), count=n * bits, bitorder="little").reshape(n, bits)
    whole = np.zeros((n, 32), dtype=np.uint8)
    whole[:, :bits] = each
    return np.packbits(whole, axis=1, bitorder="little").view("<u4").ravel()


class Shard:
    """A shard's bytes (or a memory map of its file), read at random."""

    def __init__(self, data):
        self.data = memoryview(data)
        magic, self.number, self.bits, self.block, self.vocabulary = struct.unpack_from(_HEADER, self.data, 0)
        self.n_docs, self.n_ids, n_blocks, index, table, end = struct.unpack_from(_FOOTER, self.data, len(self.data) - FOOTER - 1)
        if magic != MAGIC or end != MAGIC:
            raise ValueError("not a whole shard of token ids")
        read = lambda kind, n, at: np.frombuffer(self.data, dtype=kind, count=n, offset=at)
        self.doc_ids = read("<i8", self.n_docs, index)
        self.null_ids = read("<u1", self.n_docs, index + 8 * self.n_docs).astype(bool)
        self.starts = read("<u8", self.n_docs + 1, index + 9 * self.n_docs).astype(np.int64)
        self.places = read("<u8", n_blocks + 1, table).astype(np.int64)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` of the shard; only their blocks are read."""
        start, stop = max(0, start), min(stop, self.n_ids)
        if start >= stop:
            return np.zeros(0, dtype="<u4")
        first, last = start // self.block, (stop - 1) // self.block
        got = [unpack(self.data[self.places[b]:self.places[b + 1] - 1], min(self.block, self.n_ids - b * self.block), self.bits)
               for b in range(first, last + 1)]
        return np.concatenate(got)[start - first * self.block:stop - first * self.block]

    def document(self, k: int) -> np.ndarray:
        """Ids of the shard's ``k``-th document."""
        return self.ids(int(self.starts[k]), int(self.starts[k + 1]))


class Numbers(dict):
    """Words numbered as they come; ``new`` holds those since it was last emptied."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        self.new.append(word)
        return n


class Encoder:
    """Ids of whole texts as the tokenizer's library gives them.

    Where the tokenizer drops white space before it looks for words, a text's
    ids are those of its parts between white space; each distinct part goes
    through the library once and is remembered for a while.  Texts of Latin-1
    characters are cut into the tokenizer's own words, which repeat more."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation(), self.tokenizer.no_padding()
        self.vocabulary = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.by_words = _drops_space(spec)
        self.added = [t["content"] for t in spec["added_tokens"]]
        self.lower = '"Lowercase"' in json.dumps(spec["normalizer"])
        self.latin = self._latin_words(spec) if self.by_words else None
        self._forget()

    def _latin_words(self, spec: dict) -> re.Pattern | None:
        """The tokenizer's pattern for the standard library, if the two agree on all Latin-1 characters."""
        pre = spec["pre_tokenizer"]
        pattern = (pre.get("pretokenizers") or [pre])[0]["pattern"]["Regex"]
        for general, known in ((r"\p{L}", LATIN_LETTERS), (r"\p{N}", LATIN_NUMBERS), (r"\s", LATIN_SPACE)):
            pattern = pattern.replace(general, known)
        if r"\p" in pattern:
            return None
        every = [chr(c) for c in range(256)]
        probe = "".join(f"a{c}1{c}!{c}{d}'{c}s " for c, d in zip(every, every[1:] + every[:1]))
        probe = probe.lower() if self.lower else probe
        found = [m.span() for m in re.finditer(pattern, probe)]
        return re.compile(pattern) if found == [at for _, at in self.tokenizer.pre_tokenizer.pre_tokenize_str(probe)] else None

    def _forget(self) -> None:
        self.number = Numbers()
        self.size, self.place, self.flat = (np.zeros(1, dtype=np.int64) for _ in range(3))
        self.known = self.used = 0

    def _learn(self) -> None:
        """Ids of the words numbered since the last call."""
        new, self.number.new = self.number.new, []
        if not new:
            return
        found = [e.ids for e in self.tokenizer.encode_batch_fast(new, add_special_tokens=False)]
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        ids = np.fromiter(itertools.chain.from_iterable(found), dtype=np.int64, count=int(sizes.sum()))
        self.size, self.place = _room(self.size, self.known + len(new)), _room(self.place, self.known + len(new))
        self.flat = _room(self.flat, self.used + len(ids))
        at = slice(self.known, self.known + len(new))
        self.size[at], self.place[at] = sizes, self.used + np.cumsum(sizes) - sizes
        self.flat[self.used:self.used + len(ids)] = ids
        self.known, self.used = self.known + len(new), self.used + len(ids)

    def _words(self, text: str) -> list[str]:
        if self.latin and (text.isascii() or _is_latin(text)) and not any(a in text for a in self.added):
            return self.latin.findall(text.lower() if self.lower else text)
        return text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")

    def _codes(self, text: str) -> np.ndarray:
        words = self._words(text)
        return np.fromiter(map(self.number.__getitem__, words), dtype=np.int32, count=len(words))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and how many each has."""
        if not self.by_words:
            found = [self.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
            sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
            return np.fromiter(itertools.chain.from_iterable(found), dtype=np.int64, count=int(sizes.sum())), sizes
        if len(self.number) > REMEMBER:
            self._forget()
        parts, words = [], np.zeros(len(texts), dtype=np.int64)
        for i, text in enumerate(texts):
            a = 0
            while len(text) - a > CHUNK and (m := _SPACE.search(text, a + CHUNK)):
                parts.append(self._codes(text[a:m.start()]))
                words[i] += len(parts[-1])
                a = m.end()
            parts.append(self._codes(text[a:] if a else text))
            words[i] += len(parts[-1])
        self._learn()
        codes = np.concatenate(parts) if parts else np.zeros(0, dtype=np.int32)
        sizes = self.size[codes]
        ends = np.cumsum(sizes)
        ids = self.flat[np.repeat(self.place[codes] - ends + sizes, sizes) + np.arange(int(sizes.sum()))]
        return ids, np.diff(np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(words)])])


def _is_latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def _room(array: np.ndarray, n: int) -> np.ndarray:
    if n <= len(array):
        return array
    out = np.zeros(max(n, 2 * len(array)), dtype=array.dtype)
    out[:len(array)] = array
    return out


def _drops_space(spec: dict) -> bool:
    """Whether words never hold or need white space: the first pre-tokenizer keeps
    the matches of a pattern that matches none, and nothing before it looks across."""
    pre = spec.get("pre_tokenizer") or {}
    split = (pre.get("pretokenizers") or [pre])[0]
    harmless = {"NFC", "Lowercase", "Replace", None}
    normal = spec.get("normalizer") or {}
    if split.get("type") != "Split" or split.get("behavior") != "Removed" or not split.get("invert") or "Regex" not in split.get("pattern", {}) \
            or any(t["lstrip"] or t["rstrip"] or _SPACE.search(t["content"]) for t in spec["added_tokens"]) \
            or spec.get("post_processor") or any(p.get("add_prefix_space") for p in pre.get("pretokenizers", ())):
        return False
    for n in normal.get("normalizers", [normal]):
        if n.get("type") not in harmless or (n.get("type") == "Replace" and (n["pattern"].get("Regex"), n["content"]) != (r"\s+", " ")):
            return False
    pattern = regex.compile(split["pattern"]["Regex"])
    return not any(_SPACE.search(m.group()) for t in ("a b", "1 2", ". ,", "' s", "a\nb\t.\r1", " ") for m in pattern.finditer(t))


def encoder(path: str) -> Encoder:
    if path not in _LOADED:
        _LOADED[path] = Encoder(path)
    return _LOADED[path]


def _write_stage(path: str, end_id: int, block: int):
    def run(batches):
        enc = encoder(path)
        bits = id_bits(max(enc.vocabulary, end_id + 1))
        places, waiting, n_waiting, at, n_ids = [], [], 0, 0, 0
        doc_ids, nulls, starts = [], [], [0]

        def sections(parts):
            nonlocal at
            at += sum(len(p) + 1 for p in parts)
            return pa.record_batch([pa.array(parts, pa.binary())], names=["section"])

        yield sections([struct.pack(_HEADER, MAGIC, TaskContext.get().partitionId(), bits, block, enc.vocabulary)])

        def blocks(last):
            nonlocal waiting, n_waiting
            whole = np.concatenate(waiting) if waiting else np.zeros(0, dtype=np.int64)
            cut = len(whole) if last else len(whole) // block * block
            parts, place = [], at
            for a in range(0, cut, block):
                parts.append(pack(whole[a:min(a + block, cut)], bits))
                places.append(place)
                place += len(parts[-1]) + 1
            waiting, n_waiting = [whole[cut:]], len(whole) - cut
            return sections(parts)

        for b in slices(batches):
            ids, sizes = enc.encode(b.column("text").to_pylist())
            waiting.append(np.insert(ids, np.cumsum(sizes), end_id))
            n_waiting += len(waiting[-1])
            starts += (n_ids + np.cumsum(sizes + 1)).tolist()
            n_ids = starts[-1]
            doc_ids += b.column("did").fill_null(0).to_pylist()
            nulls += b.column("did").is_null().to_pylist()
            if n_waiting > 64 * block:
                yield blocks(last=False)
        yield blocks(last=True)
        places.append(at)
        index = at
        yield sections([np.array(doc_ids, "<i8").tobytes() + np.array(nulls, "<u1").tobytes() + np.array(starts, "<u8").tobytes()])
        table = at
        yield sections([np.array(places, "<u8").tobytes()])
        yield sections([struct.pack(_FOOTER, len(doc_ids), n_ids, len(places) - 1, index, table, MAGIC)])

    return run


def write_shards(docs: DataFrame, tokenizer: str, out: str, end_id: int = 1, shard_bytes: int = SHARD_BYTES, block: int = BLOCK,
                 id_col: str = "doc_id", text_col: str = "text") -> None:
    """Documents' ids, each document's closed by ``end_id``, as shards in the folder ``out``.

    Shards follow each other, and documents inside them, by ascending id; null
    ids come first, rows of one id follow a hash of their text.  Null texts are
    empty; repeated rows are documents of their own.  An empty table gives
    shards without documents.  Many rows of one id are dealt over shards.
    """
    rows = corpus(docs, id_col, text_col).withColumn("th", F.xxhash64("text"))
    total = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    order = [F.col("did").asc_nulls_first(), F.col("th")]
    dealt = rows.withColumn("row", F.monotonically_increasing_id()) \
        .repartitionByRange(max(1, -(-total // shard_bytes)), *order, "row").sortWithinPartitions(*order, "row")
    packed = arrow_map(dealt.select("did", "text"), _write_stage(tokenizer, end_id, block), "section binary")
    packed.select(F.col("section").cast("string").alias("value")).write.option("lineSep", "\n").text(out)


def _read_stage():
    schema = pa.schema([("shard", pa.int32()), ("place", pa.int64()), ("did", pa.int64()), ("local", pa.int64()), ("n_tokens", pa.int64()),
                        ("ids_crc32", pa.int64())])

    def run(batches):
        for b in slices(batches, 1):
            shard = Shard(b.column("content")[0].as_buffer())
            e = 0
            while e < shard.n_docs:  # some whole documents, whose blocks are unpacked together
                a, e = e, max(e + 1, int(np.searchsorted(shard.starts, shard.starts[e] + (1 << 20), side="right")) - 1)
                starts = shard.starts[a:e + 1]
                ids, at = shard.ids(int(starts[0]), int(starts[-1])), (starts - starts[0]).tolist()
                crc = [zlib.crc32(ids[i:j]) for i, j in zip(at, at[1:])]
                yield pa.record_batch([
                    pa.array(np.full(e - a, shard.number, dtype=np.int32)), pa.array(np.arange(a, e)), pa.array(shard.doc_ids[a:e], mask=shard.null_ids[a:e]),
                    pa.array(starts[:-1]), pa.array(np.diff(starts)), pa.array(crc, pa.int64())], schema=schema)

    return run


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of the shards in ``path``: ``did``, ``start`` (ids of
    all documents before it), ``n_tokens``, ``ids_crc32`` (of its ids as
    little-endian u32), ``shard`` and ``place`` in it.  All come from the files."""
    files = spark.read.format("binaryFile").load(path).select("content")
    docs = stored(arrow_map(files, _read_stage(), "shard int, place long, did long, local long, n_tokens long, ids_crc32 long"))
    sizes = docs.groupBy("shard").agg(F.sum("n_tokens").alias("n"))  # one row a shard
    before = sizes.selectExpr("shard", "sum(n) over (order by shard) - n as before")
    return docs.join(before, "shard").select("did", (F.col("before") + F.col("local")).alias("start"), "n_tokens", "ids_crc32", "shard", "place")


def round_trip(docs: DataFrame, tokenizer: str, **how) -> DataFrame:
    """``write_shards`` into the cluster's shared folder, then ``read_documents``."""
    out = scratch_path(docs.sparkSession)
    write_shards(docs, tokenizer, out, **how)
    return read_documents(docs.sparkSession, out)
