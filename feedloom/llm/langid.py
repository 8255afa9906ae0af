"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public byte
vocabulary.  A word's probability is the sum over all of its segmentations
into pieces, computed by a forward algorithm; a text's is the product over its
words.  The piece probabilities are fitted by expectation-maximisation over
word counts, with the same forward sums and their backward counterpart.  All
sums run vectorised over the distinct words of about one length; pieces of any
length in the vocabulary count, and words of any length are summed whole.

The background is the same sum under the prior, every piece equally likely:
a text that no learned language explains better is in none of them.
"""
from __future__ import annotations

import base64
from collections import Counter

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import arrow_map, keep, slices

#: Distinct labelled texts per language that the fit reads at most, in expectation (chosen by a hash of the text).
FIT_ROWS_PER_LANG = 4000
ROUNDS = 3
#: Sums over words of more bytes than this are rescaled every RESCALE bytes.
PLAIN, RESCALE = 48, 16
#: Pseudo count of every piece in every language.
PRIOR = 0.1
#: Distinct words a task remembers before it starts afresh.
CACHE_WORDS = 400_000
#: Share of the evidence that counts, for a score that is not always 0 or 1.
TEMPER = 0.2

WORD = regex.compile(r"\p{L}+")
UNDETERMINED = "und"

_K1 = np.uint64(0x9E3779B97F4A7C15)
_VOCAB: dict[str, "Vocabulary"] = {}


class Vocabulary:
    """The pieces as a tree of bytes, its edges in an open-addressed table keyed by node and byte."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            tokens = [base64.b64decode(line.split()[0]) for line in f if line.strip()]
        self.pieces = sorted(set(tokens) | {bytes([i]) for i in range(256)})
        self.longest = max(map(len, self.pieces))
        edges: dict[int, int] = {}
        ends = {}
        for i, piece in enumerate(self.pieces):
            node = 0
            for byte in piece:
                node = edges.setdefault(node << 8 | byte, len(edges) + 1)
            ends[node] = i
        self.piece = np.full(len(edges) + 1, -1, dtype=np.int64)
        self.piece[list(ends)] = list(ends.values())
        keys = self.mixed(np.fromiter(edges, dtype=np.uint64, count=len(edges)))
        order = np.argsort(keys)
        self.keys, self.nodes = keys[order], np.fromiter(edges.values(), dtype=np.int64, count=len(edges))[order]
        bits = 20
        self.shift = np.uint64(64 - bits)
        self.first = np.searchsorted(self.keys, np.arange((1 << bits) + 1, dtype=np.uint64) << self.shift)
        self.first[-1] = len(keys)

    @staticmethod
    def mixed(keys: np.ndarray) -> np.ndarray:
        return (keys + np.uint64(1)) * _K1  # odd factor: no two keys meet

    def step(self, nodes: np.ndarray, data: np.ndarray) -> np.ndarray:
        """The node behind each node's edge for a byte; -1 where there is none."""
        keys = self.mixed(nodes.astype(np.uint64) << np.uint64(8) | data)
        slot = (keys >> self.shift).astype(np.int64)
        at, end = self.first[slot], self.first[slot + 1]
        out = np.full(len(keys), -1, dtype=np.int64)
        live = np.flatnonzero(at < end)
        while len(live):
            hit = self.keys[at[live]] == keys[live]
            out[live[hit]] = self.nodes[at[live[hit]]]
            at[live] += 1
            live = live[~hit & (at[live] < end[live])]
        return out


def vocabulary(path: str) -> Vocabulary:
    if path not in _VOCAB:
        _VOCAB[path] = Vocabulary(path)
    return _VOCAB[path]


def as_bytes(word: str) -> bytes:
    """A lower-cased word with its leading space."""
    return b" " + word.encode("utf-8", "surrogatepass")


def classes(words: list[bytes]):
    """Words of about one length: their numbers, longest first, lengths, and bytes in a zero-filled matrix."""
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    kind = np.ceil(np.log2(np.maximum(sizes, 8) / 8)).astype(np.int64)
    for k in np.unique(kind):
        idx = np.flatnonzero(kind == k)
        idx = idx[np.argsort(-sizes[idx], kind="stable")]
        width = int(sizes[idx[0]])
        raw = np.frombuffer(b"".join(words[i].ljust(width, b"\0") for i in idx), dtype=np.uint8).reshape(-1, width)
        yield idx, sizes[idx], raw


def lattice(sizes: np.ndarray, raw: np.ndarray, vocab: Vocabulary):
    """For every place: the pieces that start there, as ``(length, rows, piece numbers)`` by length."""
    width = raw.shape[1]
    reach = np.searchsorted(-sizes, -np.arange(width + 1), side="right")  # rows with at least so many bytes
    for start in range(width):
        rows, node, out = np.arange(reach[start + 1]), np.zeros(reach[start + 1], dtype=np.int64), []
        for end in range(start + 1, width + 1):
            if len(rows) and rows[-1] >= reach[end]:
                inside = np.searchsorted(rows, reach[end])
                rows, node = rows[:inside], node[:inside]
            node = vocab.step(node, raw[rows, end - 1])
            alive = node >= 0
            rows, node = rows[alive], node[alive]
            if not len(rows):
                break
            piece = vocab.piece[node]
            hit = piece >= 0
            if hit.any():
                out.append((end - start, rows[hit], piece[hit]))
        yield start, out


def forward(sizes: np.ndarray, width: int, steps, probs: np.ndarray, keep_all: bool = False):
    """Forward sums.  Each row's log sum at its end, and with ``keep_all`` the sums of
    all places with the logs of what they were divided by."""
    n, k = len(sizes), probs.shape[1]
    alpha, scale, total = {0: np.ones((n, k))}, np.zeros((n, k)), np.zeros((n, k))
    scales = {}
    for start, out in steps:
        if width > PLAIN and start and start % RESCALE == 0:
            live = sizes > start
            by = np.where(live[:, None], alpha[start], 1.0)
            for place in alpha:
                if place >= start:
                    alpha[place] /= by
            scale = scale + np.log(by)
        scales[start] = scale
        for size, rows, ids in out:
            to = alpha.setdefault(start + size, np.zeros((n, k)))
            to[rows] += alpha[start][rows] * probs[ids]
        done = np.flatnonzero(sizes == start + 1)
        if len(done):
            total[done] = np.log(alpha[start + 1][done]) + scale[done]
        if not keep_all:
            del alpha[start], scales[start]
    return total, alpha, scales


def log_words(words: list[bytes], vocab: Vocabulary, probs: np.ndarray) -> np.ndarray:
    """Log probability of every word under every language."""
    out = np.zeros((len(words), probs.shape[1]))
    for idx, sizes, raw in classes(words):
        out[idx] = forward(sizes, raw.shape[1], lattice(sizes, raw, vocab), probs)[0]
    return out


def expected(words: list[bytes], counts: np.ndarray, vocab: Vocabulary, probs: np.ndarray) -> np.ndarray:
    """Expected piece counts (pieces x languages) of words counted per language."""
    out = np.zeros_like(probs)
    for idx, sizes, raw in classes(words):
        width = raw.shape[1]
        steps = list(lattice(sizes, raw, vocab))
        total, alpha, scales = forward(sizes, width, steps, probs, keep_all=True)
        # backward sums, divided so that with the forward sums they make shares of the word
        beta = {place: np.zeros((len(idx), probs.shape[1])) for place in range(width + 1)}
        for place in np.unique(sizes):
            rows = np.flatnonzero(sizes == place)
            beta[place][rows] = counts[idx[rows]] * np.exp(scales[place - 1][rows] - total[rows])
        for start, found in reversed(steps):
            for size, rows, ids in found:
                step = probs[ids] * beta[start + size][rows]
                beta[start][rows] += step
                for lang in range(probs.shape[1]):
                    out[:, lang] += np.bincount(ids, weights=alpha[start][rows, lang] * step[:, lang], minlength=len(probs))
            if width > PLAIN and start and start % RESCALE == 0:  # places before this one were not divided by what it was
                beta[start] *= np.exp(scales[start - 1] - scales[start])
                for place in range(start + 1, width + 1):
                    if place in beta and place < start + vocab.longest:
                        beta[place] *= np.exp(scales[start - 1] - scales[start])
    return out


def normalised(counts: np.ndarray) -> np.ndarray:
    p = counts + PRIOR
    return p / p.sum(axis=0)


def _count_stage(lang_no: dict[str, int]):
    """Word counts by language, summed within each slice before the shuffle."""
    def run(batches):
        for b in slices(batches, 2048):
            total: Counter = Counter()
            for text, lang in zip(b.column("text").to_pylist(), b.column("lang").to_pylist()):
                no = lang_no[lang]
                total.update((no, w) for w in WORD.findall(text.lower()))
            yield pa.record_batch([pa.array([k[0] for k in total], pa.int32()), pa.array([k[1] for k in total], pa.string()),
                                   pa.array(list(total.values()), pa.int64())], names=["lang_no", "word", "n"])

    return run


def _expect_stage(path: str, probs: np.ndarray):
    def run(batches):
        vocab = vocabulary(path)
        total = np.zeros_like(probs)
        for b in slices(batches, 20_000):
            index: dict[bytes, int] = {}
            cells: Counter = Counter()
            for no, word, n in zip(*(b.column(c).to_pylist() for c in ("lang_no", "word", "n"))):
                cells[index.setdefault(as_bytes(word), len(index)), no] += n
            counts = np.zeros((len(index), probs.shape[1]))
            for (i, no), n in cells.items():
                counts[i, no] += n
            total += expected(list(index), counts, vocab, probs)
        at, no = np.nonzero(total)
        yield pa.record_batch([pa.array(at.astype(np.int32)), pa.array(no.astype(np.int32)), pa.array(total[at, no])],
                              names=["piece", "lang_no", "e"])

    return run


def fit(labelled: DataFrame, path: str, text_col: str = "text", lang_col: str = "lang", rounds: int = ROUNDS,
        rows_per_lang: int = FIT_ROWS_PER_LANG) -> tuple[list[str], np.ndarray]:
    """Languages and piece probabilities from rows with a non-null language.

    The fit reads a bounded sample of the distinct texts: each is kept with
    probability ``rows_per_lang`` over its language's number of them, decided by
    a hash; copies count once.  The driver receives one number per piece and
    language."""
    rows = labelled.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.col(lang_col).alias("lang")).filter("lang is not null") \
        .withColumn("h", F.xxhash64("text"))
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).collect()}
    langs = sorted(sizes)
    vocab = vocabulary(path)
    probs = normalised(np.zeros((len(vocab.pieces), max(1, len(langs)))))
    if not langs:
        return langs, probs
    share = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for k in langs for x in (k, min(1.0, rows_per_lang / max(1, sizes[k])))]), F.col("lang")), F.lit(0.0))
    sample = rows.filter((F.pmod("h", F.lit(1_000_000)) < share * 1_000_000)).groupBy("h", "lang").agg(F.min("text").alias("text"))
    words = arrow_map(sample, _count_stage({k: i for i, k in enumerate(langs)}), "lang_no int, word string, n long")
    words = keep(words.groupBy("lang_no", "word").agg(F.sum("n").alias("n")))
    for _ in range(rounds):
        sums = arrow_map(words, _expect_stage(path, probs), "piece int, lang_no int, e double") \
            .groupBy("piece", "lang_no").agg(F.sum("e").alias("e")).toPandas()  # vocabulary x languages at most
        counts = np.zeros_like(probs)
        counts[sums["piece"].to_numpy(), sums["lang_no"].to_numpy()] = sums["e"].to_numpy()
        probs = normalised(counts)
    return langs, probs


def _score_stage(path: str, langs: list[str], probs: np.ndarray, temper: float):
    def run(batches):
        vocab = vocabulary(path)
        every = np.column_stack([probs, np.full(len(probs), 1 / len(probs))])  # the background last
        known: dict[str, int] = {}
        logs, sizes = np.zeros((0, every.shape[1])), np.zeros(0)
        for b in slices(batches):
            if len(known) > CACHE_WORDS:
                known, logs, sizes = {}, np.zeros((0, every.shape[1])), np.zeros(0)
            texts = [WORD.findall(t.lower()) for t in b.column("text").to_pylist()]
            fresh = list({w for ws in texts for w in ws if w not in known})
            if fresh and langs:
                data = [as_bytes(w) for w in fresh]
                known.update(zip(fresh, range(len(logs), len(logs) + len(fresh))))
                logs = np.concatenate([logs, log_words(data, vocab, every)])
                sizes = np.concatenate([sizes, list(map(len, data))])
            best, scores, per_byte, margin = [], [], [], []
            for ws in texts:
                if not ws or not langs:
                    best.append(UNDETERMINED), scores.append(0.0), per_byte.append(None), margin.append(None)
                    continue
                at = np.fromiter(map(known.__getitem__, ws), dtype=np.int64, count=len(ws))
                sums = logs[at].sum(axis=0)
                s, size = sums[:-1], float(sizes[at].sum())
                e = np.exp((s - s.max()) * temper)
                k = int(np.argmax(e))
                best.append(langs[k]), scores.append(float(e[k] / e.sum())), per_byte.append(float(s[k] / size))
                margin.append(float((s[k] - sums[-1]) / size))
            yield pa.record_batch([b.column("did"), pa.array(best, pa.string()), pa.array(scores, pa.float64()), pa.array(per_byte, pa.float64()),
                                   pa.array(margin, pa.float64()), b.column("row")], names=["did", "lang_pred", "score", "per_byte", "margin", "row"])

    return run


def identify(docs: DataFrame, langs: list[str], probs: np.ndarray, path: str, id_col: str = "doc_id", text_col: str = "text",
             carry: tuple[str, ...] = (), temper: float = TEMPER) -> DataFrame:
    """One row per document: ``did``, ``lang_pred``, ``score`` (the tempered
    posterior, all languages equally likely beforehand), ``per_byte`` (log
    probability per byte of words in the predicted language; null if ``und``),
    ``margin`` (by how much that is above the background's) and ``row``, a
    struct of the ``carry`` columns.

    The prediction reads nothing but the whole text.  Null texts and texts
    without a letter are ``und`` with score 0; so is everything when no
    language was learned.  Ties go to the first language in order.  Null ids
    and repeated rows keep a row each.  An empty table gives no rows.
    """
    extra = F.struct(*[F.col(c) for c in carry]) if carry else F.struct(F.lit(0).alias("none"))
    base = docs.select(F.col(id_col).cast("long").alias("did"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), extra.alias("row"))
    kind = base.schema["row"].dataType.simpleString()
    return arrow_map(base, _score_stage(path, langs, probs, temper), f"did long, lang_pred string, score double, per_byte double, margin double, row {kind}")


def written_in_learned(found: DataFrame) -> DataFrame:
    """Rows of ``identify`` whose text is in a learned language: it has letters,
    and the predicted language explains its words better than the background,
    for which every piece of the vocabulary is equally likely."""
    return found.filter((F.col("lang_pred") != UNDETERMINED) & (F.col("margin") > 0))
