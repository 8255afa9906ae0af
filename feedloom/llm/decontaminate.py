"""Benchmark decontamination through the CGK embedding.

A random walk reads a string: at step ``t`` it notes the byte under its
pointer and then, by a coin that depends on ``t`` and on that byte, moves on
or stays.  Strings at a small edit distance give note sequences at a small
Hamming distance, so a few sampled notes make a locality-sensitive key.  The
walk starts at every word and at hash-chosen bytes of every item and of every
document; an equal key aligns an item-sized window of the document with the
item, and the exact edit distance between the two decides.  The chosen bytes
depend on the text at them alone, so an exact copy shares at least one start
with its item whatever stands around it and whatever its script.  Each of
``functions`` independent walks over each start of the item is one
repetition, so an item has many chances.  Items too short for a walk are
found verbatim, all at once.

Items are a stated query set: they go to the tasks in blocks of at most
``ITEM_BLOCK`` bytes, one pass a block, whatever their number.
"""
from __future__ import annotations

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import arrow_map, slices, stored

#: Largest edit distance as a share of the item's bytes.
MAX_EDIT = 0.1
#: Steps of a walk and sampled notes per key; items with few or no starts of a whole walk also use the short one.
STEPS, NOTES = 48, 9
SHORT_STEPS = 16
#: Of so many neighbouring bytes the one with the least hash of the GRAM bytes from it is a start; an
#: item of SHORT_STEPS + NEAR - 1 bytes or more has at least one whose short walk lies inside it.
NEAR, GRAM = 9, 8
#: Items below so many bytes use the short walk beside the long one.
FEW_STARTS = 2 * STEPS
#: Independent walks.
FUNCTIONS = 2
#: Items below so many bytes have too few starts for a walk and are matched verbatim.
MIN_ITEM = 24
#: Bytes of items in the tasks at a time; an item takes some 4 KB there.
ITEM_BLOCK = 2 << 20
#: Document bytes per block and walk starts handled at a time.
TEXT_BLOCK, START_BLOCK = 1 << 20, 1 << 18

_FOLD = bytes.maketrans(bytes(range(65, 91)) + b"\t\n\v\f\r", bytes(range(97, 123)) + b"     ")
_BITS = 20
#: Bytes per gram of the lossless count filter before the exact distance, and bits of its table.
QGRAM, QBITS = 6, 12
_MUL = np.uint64(0x9E3779B97F4A7C15)


def fold(text: str | None) -> bytes:
    """UTF-8 bytes with A-Z lower-cased and ASCII white space as spaces; offsets stay."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD)


def grams(raw: np.ndarray) -> np.ndarray:
    """Hashed QGRAM-byte grams of a block, one for each byte."""
    pad = np.concatenate([raw, np.zeros(8, dtype=np.uint8)])
    g = np.ndarray((len(raw),), dtype="<u8", buffer=pad.data, strides=(1,)) << np.uint64(64 - 8 * QGRAM)
    return ((g * _MUL) >> np.uint64(64 - QBITS)).astype(np.uint16)


def word_starts(raw: np.ndarray) -> np.ndarray:
    inside = (raw != 32) & (raw != 0)
    return np.flatnonzero(inside & ~np.r_[False, inside[:-1]])


def chosen_starts(raw: np.ndarray) -> np.ndarray:
    """Bytes that have the least hash in some window of NEAR bytes with all
    their grams in the block; equal strings choose equal bytes inside them."""
    n = len(raw) - GRAM + 1
    if n < NEAR:
        return np.zeros(0, dtype=np.int64)
    h = ((np.ndarray((n,), dtype="<u8", buffer=np.ascontiguousarray(raw).data, strides=(1,)) * _MUL) >> np.uint64(32)).astype(np.uint32)
    least = _slide(h, np.minimum)  # by window
    edge = np.zeros(NEAR - 1, dtype=np.uint32)
    most = _slide(np.concatenate([edge, least, edge]), np.maximum)  # of the windows around a byte; none is above its own hash
    return np.flatnonzero((most == h) & (raw[:n] != 0))


def _slide(x: np.ndarray, fn) -> np.ndarray:
    """``fn`` over every NEAR values in a row."""
    size = 1
    while size < NEAR:
        step = min(size, NEAR - size)
        x, size = fn(x[:-step], x[step:]), size + step
    return x


def all_starts(raw: np.ndarray) -> np.ndarray:
    at = np.zeros(len(raw), dtype=bool)
    at[word_starts(raw)] = True
    at[chosen_starts(raw)] = True
    return np.flatnonzero(at)


class Walk:
    """One random walk: coins per step and byte, and the sampled steps."""

    def __init__(self, seed: int, steps: int):
        rng = np.random.default_rng([48, seed, steps])
        self.steps = steps
        self.coins = rng.integers(0, 2, (steps, 256), dtype=np.int64)
        early = [0, 3, 6, 9]  # early notes let most walks end soon
        self.notes = set(early) | set(rng.choice(np.arange(10, steps), NOTES - len(early), replace=False).tolist())

    def run(self, raw: np.ndarray, at: np.ndarray, levels: list[np.ndarray] | None = None):
        """Keys of the walks from ``at``; with ``levels`` (a table of the
        keys' top bits after each note) walks that can no longer match end.
        Returns indices into ``at``, keys and, without levels, all partial keys."""
        who, key, partial, level = np.arange(len(at)), np.zeros(len(at), dtype=np.uint64), [], 0
        ptr = at
        for t in range(self.steps):
            c = raw[ptr]
            if t in self.notes:
                key = (key ^ (c.astype(np.uint64) + np.uint64(1))) * _MUL
                key ^= key >> np.uint64(29)
                if levels is None:
                    partial.append(key)
                else:
                    ok = np.flatnonzero(levels[level][(key >> np.uint64(64 - _BITS)).astype(np.int64)])
                    who, key, ptr, c = who[ok], key[ok], ptr[ok], c[ok]
                    if not len(who):
                        break
                level += 1
            ptr = ptr + self.coins[t][c]
        return who, key, partial


class Items:
    """Keys of all item windows, and the exact comparison."""

    def __init__(self, items: list[tuple[int, str]], functions: int, max_edit: float):
        self.max_edit = max_edit
        folded = [(i, fold(t).strip()) for i, t in items]
        self.items = [(i, x) for i, x in folded if len(x) >= MIN_ITEM]
        self.short: dict[str, list[int]] = {}
        for i, x in folded:
            if 0 < len(x) < MIN_ITEM:
                self.short.setdefault(x.decode("latin-1"), []).append(i)
        self.automaton = ahocorasick.Automaton()
        for x in self.short:
            self.automaton.add_word(x, x)
        if self.short:
            self.automaton.make_automaton()
        self.walks = []
        self.tables = np.zeros((len(self.items), 1 << QBITS), dtype=bool)
        for k, (_, x) in enumerate(self.items):
            self.tables[k, grams(np.frombuffer(x, dtype=np.uint8))[:len(x) - QGRAM + 1]] = True
        for steps in (STEPS, SHORT_STEPS):
            mine = [k for k, (_, x) in enumerate(self.items) if (len(x) >= STEPS if steps == STEPS else len(x) < FEW_STARTS)]
            if not mine:
                continue
            block, owner, offset, at, base = [], [], [], [], 0
            for k in mine:
                x = self.items[k][1]
                o = all_starts(np.frombuffer(x, dtype=np.uint8))
                o = o[(o + steps <= len(x)) | (o == 0)]
                owner.append(np.full(len(o), k)), offset.append(o), at.append(o + base)
                block.append(x + bytes(steps))
                base += len(x) + steps
            raw = np.frombuffer(b"".join(block), dtype=np.uint8)
            owner, offset, at = np.concatenate(owner), np.concatenate(offset), np.concatenate(at)
            for f in range(functions):
                walk = Walk(f, steps)
                _, key, partial = walk.run(raw, at)
                levels = []
                for p in partial:
                    table = np.zeros(1 << _BITS, dtype=bool)
                    table[(p >> np.uint64(64 - _BITS)).astype(np.int64)] = True
                    levels.append(table)
                order = np.argsort(key, kind="stable")
                self.walks.append((walk, levels, key[order], owner[order], offset[order]))

    def candidates(self, raw: np.ndarray, starts: np.ndarray):
        """Aligned ``(item number, window start)`` pairs from all walks."""
        out = []
        for walk, levels, keys, owner, offset in self.walks:
            for i in range(0, len(starts), START_BLOCK):
                at = starts[i:i + START_BLOCK]
                who, key, _ = walk.run(raw, at, levels)
                lo, hi = np.searchsorted(keys, key, "left"), np.searchsorted(keys, key, "right")
                n = hi - lo
                rep = np.repeat(np.arange(len(who)), n)
                j = lo[rep] + np.arange(len(rep)) - np.repeat(np.cumsum(n) - n, n)
                out.append(np.stack([owner[j], at[who[rep]] - offset[j]], axis=1))
        pairs = np.concatenate(out) if out else np.zeros((0, 2), dtype=np.int64)
        return self.plausible(raw, np.unique(pairs, axis=0)) if len(pairs) else pairs

    def verbatim(self, data: bytes) -> list[dict]:
        """The first place of each short item that stands in ``data`` and does not begin or end inside an ASCII word."""
        found: dict[str, int] = {}
        if self.short:
            text = data.decode("latin-1")
            inside = lambda i: 0 < i < len(text) and text[i - 1].isascii() and text[i - 1].isalnum() and text[i].isascii() and text[i].isalnum()
            for last, x in self.automaton.iter(text):
                start = last + 1 - len(x)
                if x not in found and not inside(start) and not inside(last + 1):
                    found[x] = start
        return [{"item_id": i, "distance": 0, "start": a, "end": a + len(x)} for x, a in sorted(found.items()) for i in self.short[x]]

    def limit(self, k: int) -> int:
        return int(self.max_edit * len(self.items[k][1]))

    def plausible(self, raw: np.ndarray, pairs: np.ndarray) -> np.ndarray:
        """Pairs whose windows hold enough grams of the item.  Each edit spoils
        at most QGRAM of them, so no pair within the limit is lost."""
        g, keep = grams(raw), np.zeros(len(pairs), dtype=bool)
        first = np.flatnonzero(np.r_[True, pairs[1:, 0] != pairs[:-1, 0]])
        for i, j in zip(first, np.r_[first[1:], len(pairs)]):
            k = int(pairs[i, 0])
            size, slack = len(self.items[k][1]), 2 * (self.limit(k) + 1)
            need = size - QGRAM + 1 - QGRAM * self.limit(k)
            reach = np.arange(-slack, size + slack)
            step = max(1, 4_000_000 // len(reach))
            for a in range(i, j, step):
                at = np.clip(pairs[a:min(j, a + step), 1, None] + reach, 0, len(raw) - 1)
                keep[a:min(j, a + step)] = self.tables[k][g[at]].sum(axis=1) >= need
        return pairs[keep]


def edit_search(pattern: bytes, text: bytes, limit: int) -> tuple[int, int] | None:
    """Smallest edit distance of ``pattern`` to a substring of ``text`` and
    the first end where it is reached, if at most ``limit`` (bit-parallel)."""
    m = len(pattern)
    mask, high = (1 << m) - 1, 1 << (m - 1)
    eq: dict[int, int] = {}
    for i, c in enumerate(pattern):
        eq[c] = eq.get(c, 0) | 1 << i
    pv, mv, score, best = mask, 0, m, (m, 0)
    for j, c in enumerate(text):
        e = eq.get(c, 0)
        xv = e | mv
        xh = (((e & pv) + pv) ^ pv) | e
        ph, mh = mv | ~(xh | pv) & mask, pv & xh
        if ph & high:
            score += 1
        elif mh & high:
            score -= 1
        ph, mh = ph << 1 & mask, mh << 1 & mask
        pv, mv = mh | ~(xv | ph) & mask, ph & xv
        if score < best[0]:
            best = (score, j + 1)
    return best if best[0] <= limit else None


def _hits(items: Items, data: bytes, pairs: np.ndarray) -> list[dict]:
    """Best verified match of each item in one document."""
    best: dict[int, tuple] = {}
    ranges: list[list[int]] = []
    for k, start in pairs.tolist():  # sorted by item and start
        x = items.items[k][1]
        slack = items.limit(k) + 1
        lo, hi = max(0, start - 2 * slack), start + len(x) + 2 * slack
        if ranges and ranges[-1][0] == k and lo <= ranges[-1][1] + slack:
            ranges[-1][2] = max(hi, ranges[-1][2])
            ranges[-1][1] = lo
        else:
            ranges.append([k, lo, hi, lo])
    for k, _, hi, lo in ranges:
        item_id, x = items.items[k]
        window = data[lo:hi]
        at = window.find(x)
        if at >= 0:
            found = (0, lo + at, lo + at + len(x))
        else:
            hit = edit_search(x, window, items.limit(k))
            if hit is None:
                continue
            back = edit_search(x[::-1], window[:hit[1]][::-1], hit[0])
            found = (hit[0], lo + hit[1] - back[1], lo + hit[1])
        if k not in best or found < best[k]:
            best[k] = found
    return [{"item_id": items.items[k][0], "distance": d, "start": s, "end": e} for k, (d, s, e) in sorted(best.items())]


_HITS = "array<struct<item_id: bigint, distance: int, start: bigint, end: bigint>>"
_HITS_ARROW = pa.list_(pa.struct([("item_id", pa.int64()), ("distance", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]))


def _scan_stage(listed: list[tuple[int, str]], functions: int, max_edit: float):
    def run(batches):
        items = Items(listed, functions, max_edit)
        for b in slices(batches):
            folded = [fold(t) for t in b.column("text").to_pylist()]
            hits: list[list] = [[] for _ in folded]
            i = 0
            while i < len(folded):
                j, size = i, 0
                while j < len(folded) and (size < TEXT_BLOCK or j == i):
                    size += len(folded[j]) + STEPS
                    j += 1
                sizes = np.array([len(x) + STEPS for x in folded[i:j]])
                begin = np.cumsum(sizes) - sizes
                raw = np.frombuffer(b"".join(x + bytes(STEPS) for x in folded[i:j]), dtype=np.uint8)
                starts = all_starts(raw)
                # a text of its own beside the block is not needed: pairs carry block positions
                pairs = items.candidates(raw, starts) if items.walks else np.zeros((0, 2), dtype=np.int64)
                if len(pairs):
                    doc = np.clip(np.searchsorted(begin, pairs[:, 1], side="right") - 1, 0, None)
                    order = np.lexsort((pairs[:, 1], pairs[:, 0], doc))
                    doc, pairs = doc[order], pairs[order]
                    for d in np.unique(doc):
                        mine = pairs[doc == d] - [0, begin[d]]
                        hits[i + d] = _hits(items, folded[i + d], mine)
                i = j
            hits = [h + items.verbatim(x) for h, x in zip(hits, folded)]
            yield pa.record_batch([b.column("row"), b.column("text"), pa.array(hits, _HITS_ARROW)], names=["row", "text", "hits"])

    return run


def item_blocks(items: DataFrame, id_col: str = "item_id", text_col: str = "text"):
    """The items in blocks of about ITEM_BLOCK bytes, each with whether another follows; one block is read at a time."""
    rows = items.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t")).filter("t is not null").distinct()
    total = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = max(1, -(-total // ITEM_BLOCK))
    for k in range(n):
        yield [(r.i, r.t) for r in rows.filter(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == k).orderBy("i", "t").collect()], k + 1 < n


def scan(docs: DataFrame, items: DataFrame, text_col: str = "text", max_edit: float = MAX_EDIT, functions: int = FUNCTIONS) -> DataFrame:
    """Each document row as a struct ``row``, with ``hits``: the items found in its whole text.

    A hit has ``item_id``, the edit ``distance`` (bytes, after folding A-Z and
    white space), and the byte span ``start``..``end`` of the best match.
    Null and empty texts have no hits, nor have null and blank items.  Items
    under MIN_ITEM bytes are hits where they stand verbatim and not as a part
    of a longer word or number.  Repeated items with one text are reported under each id;
    repeated documents each keep their row.  An empty table gives no rows.
    """
    kept = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), F.coalesce(docs[text_col], F.lit("")).alias("text"),
                       F.lit(None).cast(_HITS).alias("old"))
    kind = kept.schema["row"].dataType.simpleString()
    for listed, more in item_blocks(items):
        found = arrow_map(kept.select(F.struct("row", "old").alias("row"), "text"), _scan_stage(listed, functions, max_edit),
                          f"row struct<row: {kind}, old: {_HITS}>, text string, hits {_HITS}")
        kept = found.select("row.row", "text", F.concat(F.coalesce("row.old", F.array().cast(_HITS)), "hits").alias("old"))
        kept = stored(kept) if more else kept
    return kept.select("row", F.coalesce("old", F.array().cast(_HITS)).alias("hits"))
