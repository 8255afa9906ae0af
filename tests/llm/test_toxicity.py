"""Toxicity: held-out accuracy, counterfactual effect, edge cases."""
import random
import zlib

import numpy as np

from feedloom.llm import queries as Q
from feedloom.llm import toxicity as T


def test_swap_is_an_involution():
    assert len(T.SWAPS) == len(set(T.SWAPS.values())) and not set(T.SWAPS) & set(T.SWAPS.values())
    assert T.swapped({"muslim", "house"}) == {"christian", "house"} and T.swapped(T.swapped({"women", "gay"})) == {"women", "gay"}


def test_counterfactual_penalty_spares_neutral_mentions(spark):
    rnd = random.Random(5)
    filler = [f"word{i}" for i in range(60)]
    rows, labels = [], []
    for i in range(600):
        words = [rnd.choice(filler) for _ in range(12)]
        toxic = i % 3 == 0
        if toxic and rnd.random() < .8:
            words.append("idiot")
        if rnd.random() < (.8 if toxic else .05):  # the group is mostly named in toxic texts
            words.append("muslim")
        rows.append((i, " ".join(words), 1)), labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, label int")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    plain, fair = T.fit(docs, marks, counterfactual=0.0), T.fit(docs, marks)
    neutral = {"the", "muslim", "family", "word1"}
    assert plain.score(neutral) > 0.6 > 0.4 > fair.score(neutral)
    assert abs(fair.score(neutral) - fair.score(T.swapped(neutral))) < 0.1
    assert fair.score({"idiot", "word2"}) > 0.7


def test_edge_cases(spark):
    docs = spark.createDataFrame([(1, None, 5), (2, "", 5), (2, "", 5), (None, "idiot " * 50_000, 5)], "doc_id long, text string, score int")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = T.fit(docs, none)
    assert sorted(r.score for r in T.score(docs, model).collect()) == [0.5] * 4
    marks = spark.createDataFrame([(1, None), (None, 1), (2, 1), (2, 0), (99, 1)], "doc_id long, toxic int")
    got = T.score(docs, T.fit(docs, marks)).collect()
    assert len(got) == 4 and all(0 <= r.score <= 1 for r in got)
    assert T.score(docs.limit(0), model).count() == 0


def test_gradient_fit_separates():
    w, b = T.train([[0], [0], [1], []], [[0], [0], [1], []], np.array([1.0, 1, 0, 0]), 2)
    assert b + w[0] > 1 > 0 > b + w[1] and b < 0


def test_query_held_out(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in Q.queries()["op4_toxicity"](spark, sf).collect()}
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 3 == 1) and r.predicted == int(r.score >= 0.7) for d, r in got.items())
    marks = [(got[r.doc_id], r.toxic) for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if got[r.doc_id].held_out]
    pos, neg = [g.score for g, t in marks if t], [g.score for g, t in marks if not t]
    auc = np.mean([(p > n) + (p == n) / 2 for p in pos for n in neg])
    assert auc > 0.75 and np.mean([n >= 0.7 for n in neg]) < 0.02, (auc, len(pos))
