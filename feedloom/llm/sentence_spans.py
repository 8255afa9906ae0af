"""Removal of sentences in repeated spans of consecutive sentences.

A text is cut into sentences.  A run is SPAN consecutive sentences or more
with SPAN_WORDS words or more.  The shortest run from every sentence on and
the shortest run up to every sentence are hashed; equal runs hash alike
wherever they start.  Each sentence of a longer run is in one of these inside
it, so a repeated run is covered to both its ends.

The runs are written once, then sorted over all tasks by hash and place, so
that even a very frequent run spans many tasks.  A task passes on the rows that
are not the first of their hash; whether its own first row is one is told from
the ends of the tasks, two rows each.  Only the rows passed on meet the texts.
"""
from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import arrow_map, corpus, identified, slices, stored

#: Fewest sentences and words of a span.
SPAN, SPAN_WORDS = 3, 15
#: A sentence above so many words is also cut behind every word whose CRC is
#: divisible by CUT, so that text without full stops has places to meet.
LONG, CUT = 24, 8

_END = re.compile(r"[.!?…]['\")\]»”’]*\s+|[。！？]|\n+")
_WORD = re.compile(r"\S+")
# Thai, Lao, Tibetan, Burmese, Khmer, kana, Han: two characters count as one more word
_UNSPACED = "\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_CHAR = re.compile(f"[{_UNSPACED}]")
_UNIT = re.compile(f"[{_UNSPACED}]|[^\\s{_UNSPACED}]+")


def n_words(text: str) -> int:
    """Words between white space, and characters of scripts without spaces by twos."""
    return len(text.split()) + (0 if text.isascii() else len(_CHAR.findall(text)) // 2)


def _cut_here(text: str, start: int, end: int) -> bool:
    """Whether a long sentence is cut behind this word, or behind this character of a script without spaces."""
    single = _CHAR.match(text, start)
    word = text[max(0, start - 1):end] if single else text[start:end]
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) % (2 * CUT if single else CUT) == 0


def sentences(text: str) -> list[tuple[int, int]]:
    """``(start, end)`` of the sentences; they tile the text, white space
    behind a sentence belongs to it.  Boundaries depend on nearby text only."""
    out, a = [], 0
    for b in [*(m.end() for m in _END.finditer(text)), len(text)]:
        if b <= a:
            continue
        # a sentence of so few characters cannot have too many words
        if b - a > 2 * LONG and n_words(text[a:b]) > LONG:
            units = [m.span() for m in (_WORD if text.isascii() else _UNIT).finditer(text, a, b)]
            inner = [s for (w, e), (s, _) in zip(units, units[1:]) if _cut_here(text, w, e)]
            edges = [a, *inner, b]
            out += list(zip(edges, edges[1:]))
        else:
            out.append((a, b))
        a = b
    return out


def spans(text: str, parts: list[tuple[int, int]], span: int = SPAN, span_words: int = SPAN_WORDS) -> list[tuple[int, int, bytes]]:
    """``(start, end, hash)``, places in the text, of every shortest run from and up
    to a sentence, each once.  Case and white space do not count, nor do
    sentences without a word."""
    at, ends, total, norm, size, words = [], [], [0], [], 0, 0  # of the sentences with words
    for i, (a, b) in enumerate(parts):
        tokens = text[a:b].lower().split()
        if tokens:
            data = " ".join(tokens).encode("utf-8", "surrogatepass")
            at.append(i), norm.append(data)
            size += len(data) + 1
            words += n_words(text[a:b])
            ends.append(size), total.append(words)
    whole = b" ".join(norm)
    runs, j = [], 0
    for i in range(len(at)):  # both bounds move on only
        j = max(j, i + span)
        while j <= len(at) and total[j] - total[i] < span_words:
            j += 1
        if j > len(at):
            break
        runs.append((i, j))
    known, i = set(runs), 0
    for j in range(span, len(at) + 1):
        while i < j - span and total[j] - total[i + 1] >= span_words:
            i += 1
        if total[j] - total[i] >= span_words and (i, j) not in known:
            runs.append((i, j))
    digest = xxhash.xxh3_128_digest
    return [(parts[at[i]][0], parts[at[j - 1]][1], digest(whole[ends[i - 1] if i else 0:ends[j - 1] - 1])) for i, j in runs]


def _span_stage(span: int, span_words: int):
    def run(batches):
        for b in slices(batches):
            rows, first, last, digest = [], [], [], []
            for k, text in enumerate(b.column("text").to_pylist()):
                for a, e, h in spans(text, sentences(text), span, span_words):
                    rows.append(k), first.append(a), last.append(e), digest.append(h)
            key = np.frombuffer(b"".join(digest), dtype="<i8").reshape(-1, 2)
            at = pa.array(rows, pa.int64())
            yield pa.record_batch([b.column("uid").take(at), b.column("th").take(at), pa.array(key[:, 0]), pa.array(key[:, 1]),
                                   pa.array(first, pa.int32()), pa.array(last, pa.int32())], names=["uid", "th", "k1", "k2", "a", "e"])

    return run


def _late_stage():
    """Of rows sorted by hash and place, those that are not at the place of their hash's first row.

    ``end`` is 0 for them, 1 for the task's first row, which may be one, and 2
    for a row with the task's last hash and the place of that hash's first row in the task."""
    def run(batches):
        names = ["uid", "th", "a", "e"]
        last = None  # hash, then place of its first row
        for b in batches:
            if not b.num_rows:
                continue
            key, (uid, th, a, e) = np.stack([b.column(c).to_numpy() for c in ("k1", "k2")], axis=1), (b.column(c).to_numpy() for c in names)
            new = np.ones(len(a), dtype=bool)
            new[1:] = (key[1:] != key[:-1]).any(axis=1)
            opens = last is None
            if not opens and tuple(key[0]) == last[0]:
                new[0] = False
            start = np.maximum.accumulate(np.where(new, np.arange(len(a)), -1))  # -1: the hash began in an earlier batch
            held = last[1] if last else (0, 0, 0, 0)
            firsts = [np.where(start < 0, held[i], c[start]) for i, c in enumerate((uid, th, a, e))]
            late = (uid != firsts[0]) | (th != firsts[1]) | (a != firsts[2])
            last = (tuple(key[-1]), tuple(int(f[-1]) for f in firsts))
            at = np.flatnonzero(late)
            end = np.zeros(len(at), dtype=np.int8)
            if opens:
                at, end = np.concatenate([[0], at]), np.concatenate([[1], end]).astype(np.int8)
            yield pa.record_batch([*(pa.array(c[at]) for c in (uid, th, a, e)), pa.array(end), *(pa.array(key[at, i], mask=end == 0) for i in (0, 1))],
                                  names=[*names, "end", "k1", "k2"])
        if last:
            values = [*last[1], 2, *last[0]]
            yield pa.record_batch([pa.array([v], t) for v, t in zip(values, (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int8(), pa.int64(), pa.int64()))],
                                  names=[*names, "end", "k1", "k2"])

    return run


def late_spans(rows: DataFrame, span: int = SPAN, span_words: int = SPAN_WORDS) -> DataFrame:
    """``(uid, th, a, e)``: the places of all runs of ``identified`` rows that came before."""
    found = stored(arrow_map(rows.select("uid", "th", "text"), _span_stage(span, span_words), "uid long, th long, k1 long, k2 long, a int, e int"))
    order = ["k1", "k2", "uid", "th", "a"]
    late = stored(arrow_map(found.repartitionByRange(*order).sortWithinPartitions(*order), _late_stage(),
                            "uid long, th long, a int, e int, end byte, k1 long, k2 long"))
    place = F.struct("uid", "th", "a")
    first = late.filter("end > 0").groupBy("k1", "k2").agg(F.min(place).alias("first"))  # of hashes at the tasks' ends
    at_start = late.filter("end = 1").join(first, ["k1", "k2"]).filter(place > F.col("first"))
    return late.filter("end = 0").select("uid", "th", "a", "e").unionByName(at_start.select("uid", "th", "a", "e"))


def _cut_stage():
    schema = pa.schema([("did", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_text", pa.string()),
                        ("kept_sha256", pa.string())])

    def run(batches):
        for b in slices(batches):
            out = []
            for did, text, found in zip(*(b.column(c).to_pylist() for c in ("did", "text", "found"))):
                kept, at, n = [], 0, 0
                for f in sorted(found or (), key=lambda f: f["a"]):
                    if f["a"] > at or not n:  # behind a gap
                        n += 1
                        kept.append(text[at:f["a"]])
                    at = max(at, f["e"])
                left = "".join(kept) + text[at:]
                size, raw = len(text.encode("utf-8", "surrogatepass")), left.encode("utf-8", "surrogatepass")
                out.append((did, size, size - len(raw), n, left, hashlib.sha256(raw).hexdigest()))
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return run


def remove_repeated_spans(docs: DataFrame, span: int = SPAN, span_words: int = SPAN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document without the sentences of spans that came before.

    One row per input row: ``did``, ``n_bytes``, ``n_removed`` (bytes),
    ``n_spans`` (maximal removed runs), ``kept_text``, ``kept_sha256``.  A
    span's first occurrence is the one with the smallest id (rows without an id
    come first, by a hash of the text), then by a hash of the text, then by
    place in it.  Rows equal in id and text are one document for this and are
    cut alike.  Null texts count as empty; texts with fewer than ``span``
    sentences or ``span_words`` words stay whole; an empty table gives no rows.
    """
    rows = identified(corpus(docs, id_col, text_col))
    found = late_spans(rows, span, span_words).groupBy("uid", "th").agg(F.collect_set(F.struct("a", "e")).alias("found"))
    return arrow_map(rows.join(found, ["uid", "th"], "left").select("did", "text", "found"), _cut_stage(),
                     "did long, n_bytes long, n_removed long, n_spans long, kept_text string, kept_sha256 string")
