"""Language ID: forward and backward sums against enumeration, held-out accuracy, edge cases."""
import zlib

import numpy as np
import public_tokenizers

from feedloom.llm import langid as L
from feedloom.llm import queries as Q

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def segmentations(word, pieces):
    if not word:
        yield []
    for n in range(1, len(word) + 1):
        if word[:n] in pieces:
            for rest in segmentations(word[n:], pieces):
                yield [word[:n], *rest]


def test_vocabulary_lookup():
    v = L.vocabulary(PATH)
    at = {p: i for i, p in enumerate(v.pieces)}
    assert v.longest > 30
    for word in [*v.pieces[::997], max(v.pieces, key=len), b"zzqqj", b"\xff\xfe\xfd", b"a\0b"]:
        sizes, raw = np.array([len(word)]), np.frombuffer(word, dtype=np.uint8).reshape(1, -1)
        got = {(start, start + n): ids[0] for start, out in L.lattice(sizes, raw, v) for n, _, ids in out}
        assert got == {(i, j): at[word[i:j]] for i in range(len(word)) for j in range(i + 1, len(word) + 1) if word[i:j] in at}


def plain_sums(word, at, probs):
    """Forward sums in exact fractions of Python floats' logs: one language."""
    from fractions import Fraction
    p = [Fraction(x) for x in probs]
    a = [Fraction(1)] + [Fraction(0)] * len(word)
    for i in range(len(word)):
        for j in range(i + 1, len(word) + 1):
            if word[i:j] in at:
                a[j] += a[i] * p[at[word[i:j]]]
    return a


def test_long_words_are_summed_whole():
    import math
    v = L.vocabulary(PATH)
    at = {p: i for i, p in enumerate(v.pieces)}
    probs = L.normalised(np.random.default_rng(5).random((len(v.pieces), 2)))
    words = [b" " + b"thingandeberuber" * 13, " 世界你好".encode() * 30, b" " + b"internationalization" * 3, b" a", b" " + b"x" * 48, b" " + b"q" * 63]
    got = L.log_words(words, v, probs)
    counts = np.arange(1.0, 13.0).reshape(6, 2)
    exp = L.expected(words, counts, v, probs)
    want = np.zeros_like(exp)
    for i, w in enumerate(words):
        for k in range(2):
            a = plain_sums(w, at, probs[:, k])
            back = plain_sums(w[::-1], {p[::-1]: n for p, n in at.items()}, probs[:, k])[::-1]
            log = math.log(a[-1].numerator) - math.log(a[-1].denominator)
            assert abs(got[i, k] - log) < 1e-8 * abs(log)
            for s in range(len(w)):
                for e in range(s + 1, len(w) + 1):
                    if w[s:e] in at:
                        want[at[w[s:e]], k] += counts[i, k] * float(a[s] * back[e] / a[-1]) * probs[at[w[s:e]], k]
    assert np.allclose(exp, want)


def test_sums_over_all_segmentations():
    v = L.vocabulary(PATH)
    at = {p: i for i, p in enumerate(v.pieces)}
    probs = np.random.default_rng(3).random((len(v.pieces), 2))
    probs /= probs.sum(axis=0)
    words = [b" the", b" une", "über".encode(), b" a", b"x", b" ing", b" anda"]
    counts = np.arange(14.0).reshape(7, 2)
    want, exp = np.zeros((7, 2)), np.zeros_like(probs)
    for i, w in enumerate(words):
        segs = [([at[p] for p in s]) for s in segmentations(w, at)]
        for k in range(2):
            ps = [np.prod(probs[s, k]) for s in segs]
            want[i, k] = np.log(sum(ps))
            for s, p in zip(segs, ps):
                for j in s:
                    exp[j, k] += counts[i, k] * p / sum(ps)
    assert np.allclose(L.log_words(words, v, probs), want)
    assert np.allclose(L.expected(words, counts, v, probs), exp)


def test_edge_cases(spark):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("the house and the garden", "en"), ("das haus und der garten", "de")] * 20)]
    rows += [(100, None, "en"), (101, "", None), (102, "12 %% 34", None), (103, "THE Garden and", None), (None, "der garten", "de"),
             (105, "x" * 5000, None), (105, "das und " * 20000, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "1 as did", "'x' as row")
    langs, probs = L.fit(df, PATH)
    assert langs == ["de", "en"]
    got = {}
    for r in L.identify(df, langs, probs, PATH, carry=("row",)).collect():
        got.setdefault(r.did, []).append((r.lang_pred, r.score, r.row.row))
    assert [got[i][0][:2] for i in (100, 101, 102)] == [("und", 0.0)] * 3
    assert got[103][0][0] == "en" and got[None][0][0] == "de"
    assert len(got[105]) == 2 and ("de", 1.0, "x") in got[105]
    assert all(0 <= s <= 1 for x in got.values() for _, s, _ in x)
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    langs, probs = L.fit(none, PATH)
    assert langs == [] and L.identify(none, langs, probs, PATH).count() == 0
    assert {r.lang_pred for r in L.identify(df, langs, probs, PATH).collect()} == {"und"}


OTHERS = {
    "ru": "Сегодня утром мы вышли из дома и пошли через старый парк к реке, где рыбаки уже давно сидели на берегу.",
    "el": "Σήμερα το πρωί βγήκαμε από το σπίτι και περπατήσαμε μέσα από το παλιό πάρκο μέχρι το ποτάμι.",
    "ar": "خرجنا هذا الصباح من البيت ومشينا عبر الحديقة القديمة إلى النهر حيث كان الصيادون يجلسون منذ وقت طويل.",
    "ko": "오늘 아침 우리는 집을 나와 오래된 공원을 지나 강까지 걸어갔고 낚시꾼들은 이미 오래전부터 앉아 있었다.",
    "pl": "Dziś rano wyszliśmy z domu i poszliśmy przez stary park nad rzekę, gdzie wędkarze siedzieli już od dawna na brzegu.",
    "it": "Questa mattina siamo usciti di casa e abbiamo attraversato il vecchio parco fino al fiume, dove i pescatori sedevano già da tempo.",
    "fi": "Tänä aamuna lähdimme kotoa ja kävelimme vanhan puiston läpi joelle, jossa kalastajat olivat istuneet jo pitkään rannalla.",
    "tr": "Bu sabah evden çıktık ve eski parkın içinden nehre kadar yürüdük, balıkçılar çoktandır kıyıda oturuyordu.",
    "hi": "आज सुबह हम घर से निकले और पुराने पार्क से होकर नदी तक गए जहाँ मछुआरे बहुत देर से किनारे पर बैठे थे।",
    "zh": "今天早上我们走出家门穿过老公园来到河边渔夫们早已坐在岸上",
    "ja": "今朝私たちは家を出て古い公園を通り川まで歩いた。漁師たちはもうずっと前から岸に座っていた。",
}


def test_texts_in_no_learned_language_go(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    langs, probs = L.fit(docs, PATH)
    others = spark.createDataFrame([(i, t, None) for i, t in enumerate(OTHERS.values())] + [(50, "xqzjv wkkqp zzvrx qjxwv " * 5, None)], docs.schema)
    assert L.written_in_learned(L.identify(others, langs, probs, PATH)).count() == 0
    written = docs.filter("text rlike '[A-Za-z]'")
    assert L.written_in_learned(L.identify(written, langs, probs, PATH)).count() >= .99 * written.count()


def test_copies_count_once_in_the_fit(spark):
    texts = [(f"the house number {chr(97 + i % 26)}{chr(97 + i // 26)}", "en") for i in range(300)] + [("la casa", "es")] * 700 + [("una casa vieja", "es")]
    df = spark.createDataFrame(texts, "text string, lang string")
    once = L.fit(df.dropDuplicates(), PATH)
    assert L.fit(df, PATH)[0] == once[0] and np.allclose(L.fit(df, PATH)[1], once[1])


def test_ties_go_to_the_first_language(spark):
    df = spark.createDataFrame([("same words", "b"), ("same words", "a")], "text string, lang string").selectExpr("1L as doc_id", "*")
    langs, probs = L.fit(df, PATH)
    assert [r.lang_pred for r in L.identify(df, langs, probs, PATH).collect()] == ["a", "a"]


def test_query_held_out_accuracy(spark):
    got = Q.queries()["op5_language_id"](spark, "/root/testdata/sf0.01").collect()
    docs = {d.doc_id: d for d in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    assert len(got) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    held = [r for r in got if r.held_out]
    right = sum(r.lang_pred == docs[r.doc_id].lang for r in held) / len(held)
    assert right >= 0.97, right
