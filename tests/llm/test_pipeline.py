"""Pipeline: each stage against a brute-force version, and the whole run."""
import itertools

import corpus_pipeline as P
from pyspark.sql import functions as F

from feedloom.llm import decontaminate as D
from feedloom.llm import simhash_vp as S

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(9001, "12345 ## !!", None, "src1", 11), (9002, None, "en", None, 0), (9003, "漢字仮名交じり文の例です。" * 5, None, "src2", 65),
                                   (None, "and the inan of this", None, "src1", 20)], docs.schema)
    docs = docs.unionByName(extra).unionByName(docs.filter("doc_id = 3"))
    docs.write.parquet(f"{tmp_path}/0")
    docs = spark.read.parquet(f"{tmp_path}/0")

    def stage(k):
        nonlocal docs
        before = docs.collect()
        docs = P.STAGES[k][1](spark, docs, SF)
        docs.write.parquet(f"{tmp_path}/{k + 1}")
        docs = spark.read.parquet(f"{tmp_path}/{k + 1}")
        assert docs.columns[:5] == COLUMNS
        return before, docs.collect()

    before, after = stage(0)
    assert {r.doc_id for r in before} - {r.doc_id for r in after} == {9001, 9002, 9003} and len(before) - len(after) == 3
    assert all(r.lang for r in after)

    before, after = stage(1)
    fps = [S.simhash(r.text) for r in before]
    comp = list(range(len(before)))
    for a, b in itertools.combinations(range(len(before)), 2):
        if (fps[a] ^ fps[b]).bit_count() <= 3 and comp[a] != comp[b]:
            comp = [comp[a] if c == comp[b] else c for c in comp]
    want = {min((before[i].doc_id is None, before[i].doc_id or 0) for i in range(len(before)) if comp[i] == c) for c in set(comp)}
    assert {(r.doc_id is None, r.doc_id or 0) for r in after} == want and len(after) == len(set(comp))

    before, after = stage(2)
    from test_suffix_dedup import slow
    want = dict(zip([r.doc_id for r in before], slow([r.text for r in before], 200)))
    assert len(after) == len(before)
    for r in after:
        n_bytes, removed, _, _ = want[r.doc_id]
        assert r.n_chars == len(r.text) and 0 <= n_bytes - removed - len(r.text.encode()) <= 6

    before, after = stage(3)
    items = [(r.item_id, D.fold(r.text).strip()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaks = {r.doc_id for r in before if any(D.edit_search(x, D.fold(r.text), int(len(x) * D.MAX_EDIT)) for _, x in items)}
    assert leaks and {r.doc_id for r in before} - {r.doc_id for r in after} == leaks

    before, after = stage(4)
    assert sorted(str(r[:5]) for r in after) == sorted(str(tuple(r)) for r in before)
    assert len({(r.slot, r.pos) for r in after}) == len(after)


def test_empty_table_and_clashing_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumns(
        {c: F.lit(c) for c in ("lang_pred", "row", "did", "score", "kept_text", "hits", "block", "slot", "pos", "th", "fp", "margin")})
    none = docs.limit(0)
    for k, (name, stage) in enumerate(P.STAGES):
        few = stage(spark, docs.limit(60), SF)
        assert few.columns == docs.columns if k < 4 else sorted(few.columns) == sorted(docs.columns), name
        rows = few.collect()
        assert rows and all(r["row"] == "row" and r["lang_pred"] == "lang_pred" for r in rows), name
        empty = stage(spark, none, SF)
        assert empty.count() == 0 and sorted(empty.columns) == sorted(docs.columns), name


def test_run(spark):
    out = P.run(spark, SF)
    assert out.columns == [*COLUMNS, "block", "slot", "pos"] and out.count() > 50
    assert len(P.STAGES) == 5
