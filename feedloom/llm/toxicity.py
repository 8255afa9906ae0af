"""Toxicity classifier regularised by counterfactual sentences.

A logistic model over the presence of words and word beginnings.  Every
training text that names an identity group is paired with its counterfactual,
the same text with the identity terms swapped, and the fit penalises the
squared difference of the two scores.  So a group's name cannot become
evidence by itself, and neutral mentions keep a low score.
"""
from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import arrow_map, slices, stored

#: Labelled rows the fit reads at most (chosen by a hash of the id).
FIT_ROWS = 12_000
#: Features of the model, and the fewest training texts that must have one.
FEATURES, LEAST_TEXTS = 2000, 3
#: Smallest G2 statistic of a feature (chi-square, one degree of freedom, p < 0.0001).
LEAST_G2 = 15.1
#: Ridge and counterfactual penalties, gradient steps.
RIDGE, COUNTERFACTUAL, STEPS = 1e-4, 1.0, 400

#: Identity terms that stand for each other.
SWAPS = {"women": "men", "woman": "man", "girls": "boys", "girl": "boy", "mothers": "fathers", "mother": "father", "wife": "husband",
         "muslims": "christians", "muslim": "christian", "jews": "buddhists", "jew": "buddhist", "jewish": "hindu",
         "black": "white", "blacks": "whites", "asian": "european", "asians": "europeans", "african": "american", "africans": "americans",
         "gay": "straight", "lesbian": "heterosexual", "transgender": "cisgender", "queer": "hetero", "immigrants": "citizens",
         "immigrant": "citizen", "refugees": "residents", "refugee": "resident", "old": "young", "disabled": "healthy", "deaf": "hearing", "blind": "sighted",
         "frauen": "männer", "frau": "mann", "juden": "buddhisten", "ausländer": "inländer", "femmes": "hommes", "femme": "homme",
         "juifs": "bouddhistes", "musulmans": "chrétiens", "mujeres": "hombres", "mujer": "hombre", "judíos": "budistas", "musulmanes": "cristianos"}
SWAPPED = SWAPS | {b: a for a, b in SWAPS.items()}

_WORD = regex.compile(r"\p{L}+")
_BEGINNINGS = (3, 4, 5, 6, 7)


def words_of(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def features_of(word: str) -> list[str]:
    """The word itself and its beginnings, marked by a trailing ``*``."""
    return [word, *(word[:n] + "*" for n in _BEGINNINGS if len(word) > n)]


def swapped(words: set[str]) -> set[str]:
    """Words of the counterfactual text: each identity term gives way to its counterpart."""
    return {SWAPPED.get(w, w) for w in words}


@dataclass
class Model:
    """Weights by feature, and the intercept."""
    index: dict[str, int]
    weights: np.ndarray
    bias: float

    def ids(self, words: set[str]) -> list[int]:
        return sorted({self.index[f] for w in words for f in features_of(w) if f in self.index})

    def score(self, words: set[str]) -> float:
        return float(_sigmoid(self.bias + self.weights[self.ids(words)].sum()))


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def train(rows: list[list[int]], twins: list[list[int]], labels: np.ndarray, n: int, counterfactual: float = COUNTERFACTUAL,
          ridge: float = RIDGE, steps: int = STEPS) -> tuple[np.ndarray, float]:
    """Weights and intercept: logistic loss, ridge, and the mean squared
    difference of the scores' logits between rows and their twins (Adam)."""
    def flat(lists):
        return (np.repeat(np.arange(len(lists)), [len(x) for x in lists]),
                np.fromiter((i for x in lists for i in x), dtype=np.int64, count=sum(map(len, lists))))

    (r, c), (tr, tc) = flat(rows), flat(twins)
    w, b, m, v = np.zeros(n), 0.0, np.zeros(n + 1), np.zeros(n + 1)
    total = max(1, len(rows))
    for t in range(1, steps + 1):
        z = np.bincount(r, weights=w[c], minlength=len(rows)) + b
        err = (_sigmoid(z) - labels) / total
        gap = 2 * counterfactual * (z - b - np.bincount(tr, weights=w[tc], minlength=len(rows))) / total
        g = np.bincount(c, weights=err[r] + gap[r], minlength=n) - np.bincount(tc, weights=gap[tr], minlength=n) + 2 * ridge * w
        g = np.r_[g, err.sum()]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = 0.1 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        w, b = w - step[:n], b - step[n]
    return w, float(b)


def _presence_stage():
    def run(batches):
        for b in slices(batches):
            seen, toxic = Counter(), Counter()
            for text, label in zip(b.column("text").to_pylist(), b.column("label").to_pylist()):
                f = {f for w in words_of(text) for f in features_of(w)}
                seen.update(f)
                if label:
                    toxic.update(f)
            yield pa.record_batch([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64()),
                                   pa.array([toxic[f] for f in seen], pa.int64())], names=["feature", "n", "pos"])

    return run


def _row_stage(index: dict[str, int]):
    def run(batches):
        model = Model(index, np.zeros(len(index)), 0.0)
        for b in slices(batches):
            sets = [words_of(t) for t in b.column("text").to_pylist()]
            yield pa.record_batch([b.column("label"), pa.array([model.ids(s) for s in sets], pa.list_(pa.int32())),
                                   pa.array([model.ids(swapped(s)) for s in sets], pa.list_(pa.int32()))], names=["label", "ids", "twin"])

    return run


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        fit_rows: int = FIT_ROWS, counterfactual: float = COUNTERFACTUAL) -> Model:
    """Model from the documents that ``labels`` marks.

    Labels that are null do not count; contradicting labels of one id count
    as toxic.  At most ``fit_rows`` labelled ids are read, the first by hash;
    that list and the chosen features (at most FEATURES) are the only things
    broadcast, the rows' feature numbers the only ones collected."""
    chosen = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()) \
        .groupBy(F.col(id_col).cast("long").alias("lid")).agg(F.max(F.when(F.col(label_col) > 0, 1).otherwise(0)).alias("label")) \
        .orderBy(F.xxhash64("lid"), "lid").limit(fit_rows)
    texts = docs.select(F.col(id_col).cast("long").alias("did"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    sample = stored(texts.join(F.broadcast(chosen), texts["did"] == chosen["lid"])  # at most fit_rows pairs of numbers
                    .select("did", "label", "text").dropDuplicates(["did"]))
    size = sample.agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("pos")).first()
    n, pos = size["n"], size["pos"] or 0
    if not n:
        return Model({}, np.zeros(0), 0.0)
    counts = arrow_map(sample, _presence_stage(), "feature string, n long, pos long").groupBy("feature") \
        .agg(F.sum("n").alias("n"), F.sum("pos").alias("pos")).filter(F.col("n") >= LEAST_TEXTS)

    def term(observed, expected):
        return F.when(observed > 0, observed * F.log(observed / expected)).otherwise(0.0)

    a, c, rate = F.col("pos").cast("double"), (F.col("n") - F.col("pos")).cast("double"), pos / n
    g2 = 2 * (term(a, F.col("n") * rate) + term(c, F.col("n") * (1 - rate))
              + term(pos - a, (n - F.col("n")) * rate) + term((n - pos) - c, (n - F.col("n")) * (1 - rate)))
    best = counts.select("feature", g2.alias("g2")).filter(F.col("g2") >= LEAST_G2).orderBy(F.desc("g2"), "feature").limit(FEATURES).collect()
    index = {r.feature: i for i, r in enumerate(best)}
    rows = arrow_map(sample.select("label", "text"), _row_stage(index), "label int, ids array<int>, twin array<int>").collect()
    w, b = train([r.ids for r in rows], [r.twin for r in rows], np.array([r.label for r in rows], dtype=float), len(index), counterfactual)
    return Model(index, w, b)


def _score_stage(model: Model):
    def run(batches):
        known: dict[str, list[int]] = {}
        for b in slices(batches):
            if len(known) > 500_000:
                known = {}
            scores = []
            for text in b.column("text").to_pylist():
                ids: set[int] = set()
                for w in set(_WORD.findall(text.lower())):
                    hit = known.get(w)
                    if hit is None:
                        hit = known[w] = [model.index[f] for f in features_of(w) if f in model.index]
                    if hit:
                        ids.update(hit)
                scores.append(float(_sigmoid(model.bias + model.weights[sorted(ids)].sum())))
            yield pa.record_batch([b.column("did"), pa.array(scores, pa.float64())], names=["did", "score"])

    return run


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(did, score)`` per document, from its whole text alone.  Null texts
    count as empty and get the intercept's score; null ids and repeated rows
    keep a row each; an empty table gives no rows."""
    texts = docs.select(F.col(id_col).cast("long").alias("did"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return arrow_map(texts, _score_stage(model), "did long, score double")
