"""Prompts, request bodies, timeouts, error classes and conform."""
import json

from pyspark.sql import functions as F

from feedloom.functions import fixed
from feedloom.operators import extract as X

ITEM = ("quality-test-1", "", "https://example.com/jobs/quality-test-1", "src", "Backend Engineer",
        "Ruolo ambiguo senza dettagli completi.", ["https://example.com/jobs/quality-test-1", " ", "https://b"], [])


def _items(spark, excerpt=""):
    df = spark.createDataFrame([ITEM], "id string, guid string, url string, source_label string, title string, "
                                       "description string, links array<string>, image_urls array<string>")
    return df.withColumn("excerpt", F.lit(excerpt))


def _conform(spark, content):
    resp = spark.createDataFrame([("quality-test-1", content)], "item_id string, content string")
    return X.conform(resp, _items(spark), "2024-01-01 00:00:00").collect()[0]


def test_conform_quality_golden(spark):
    content = """{
        "job_category":"Programmazione", "role":"Backend Engineer", "company":"ACME", "seniority":"n/a",
        "location":"Remote EU", "remote_type":"remote", "tech_stack":["Go","Kubernetes"],
        "tags":["#Go","Kubernetes","Remote EU","go"], "contract_type":"full-time", "salary":"competitive",
        "language":"it", "summary_it":"Ruolo backend remoto con stack Go/Kubernetes.", "confidence":0.81}"""
    r = _conform(spark, content)
    assert r.error == ""
    assert r.seniority == "" and r.salary == "competitive"
    assert (r.job_post_quality_score, r.job_post_quality_rank) == (60, "C")
    assert r.job_post_missing_fields == ["seniority", "salary"]
    assert r.tags == ["go", "kubernetes", "remoteeu"]
    assert r.original_links == ["https://example.com/jobs/quality-test-1", "https://b"]
    assert abs(r.confidence - 0.81) < 1e-9 and r.language == "it"


def test_conform_all_missing(spark):
    content = """{"job_category":"Programmazione","role":"Software Engineer","company":"ACME","seniority":"n/a",
        "location":"non indicato","remote_type":"","tech_stack":["n/a"],"contract_type":"unknown","salary":"tbd",
        "language":"it","summary_it":"Annuncio sintetico.","confidence":0.55}"""
    r = _conform(spark, content)
    assert (r.seniority, r.location, r.contract_type, r.tech_stack) == ("", "", "", [])
    assert (r.job_post_quality_score, r.job_post_quality_rank, len(r.job_post_missing_fields)) == (0, "D", 5)


def test_confidence_text(spark):
    base = '{"role":"r","company":"c","summary_it":"s","confidence":%s}'
    got = [_conform(spark, base % v) for v in ['"1.0"', '"alta"', '"85%"', '"1,5"', '2', '"bogus"', '""', 'null']]
    assert [g.confidence for g in got[:5]] == [1.0, 0.85, 0.85, 0.015, 2.0]
    assert [g.error for g in got[5:7]] == ["json_type", "json_type"]
    assert got[7].confidence == 0.0


def test_conform_errors(spark):
    assert _conform(spark, '{"role":42,"company":"c","summary_it":"s"}').error == "json_type"
    assert _conform(spark, '{"role":"r","summary_it":"s"}').error == "missing_required"
    assert _conform(spark, '{"role":"r","company":"c","summ').error == "truncated"
    assert _conform(spark, "").error == "truncated"
    assert _conform(spark, "not json at all").error == "json_parse"
    assert _conform(spark, '```json\n{"role":"r","company":"c","summary_it":"s"}\n```').error == ""


def test_timeouts(spark):
    df = spark.createDataFrame([("a" * 2100,), ("b" * 8000,)], ["prompt"])
    a = X.request_timeout(df.limit(1), 1024, base_s=90, max_s=600, per1k_s=25, per256_s=20).collect()[0]
    assert a.timeout_s == 245
    b = X.request_timeout(df.filter(F.length("prompt") == 8000), 2048, base_s=90, max_s=180).collect()[0]
    assert b.timeout_s == 180


def test_prompt_excerpt_not_clamped_and_default(spark):
    marker = "MARKER-END"
    p = X.build_prompts(_items(spark, "x" * 3000 + marker)).collect()[0].prompt
    assert marker in p and "Titolo: Backend Engineer" in p
    p2 = X.build_prompts(_items(spark, "")).collect()[0].prompt
    assert "Contenuto pagina sorgente (estratto): N/D" in p2
    c = X.build_prompts(_items(spark, "x" * 3000 + marker), compact=True).collect()[0].prompt
    assert marker not in c and c.startswith("Restituisci SOLO 1 riga JSON")


def test_prompt_templates(spark):
    ok = X.build_prompts(_items(spark, "pagina"), template="T={{.Title}} P={{ .SourcePageText }}").collect()[0]
    assert ok.prompt == "T=Backend Engineer P=pagina"
    bad = X.build_prompts(_items(spark), template="{{.Nope}}").collect()[0]
    assert bad.prompt.startswith("Analizza il seguente annuncio")


def test_request_body(spark):
    p = spark.createDataFrame([("a & b <c>",)], ["prompt"])
    strict = json.loads(X.request_body(p, "m", 512, strict=True).collect()[0].body)
    assert strict["messages"][1] == {"content": "a & b <c>", "role": "user"}
    assert strict["messages"][0]["content"] == fixed.SYSTEM_MESSAGE
    assert strict["json_schema"]["required"] == fixed.RESPONSE_KEYS
    assert strict["response_format"]["type"] == "json_schema" and strict["temperature"] == 0.1
    raw = X.request_body(p, "m", 512).collect()[0].body
    assert "\\u0026" in raw and list(json.loads(raw)) == sorted(json.loads(raw))
    nothink = json.loads(X.request_body(p, "m", 512, disable_thinking=True).collect()[0].body)
    assert nothink["chat_template_kwargs"] == {"enable_thinking": False} and nothink["reasoning_format"] == "none"
    think = json.loads(X.request_body(p, "m", 512, thinking=True).collect()[0].body)
    assert think["enable_thinking"] is True


def test_error_classes(spark):
    df = spark.createDataFrame([("a", "context deadline exceeded", None, 1, ["stop", " stop", "length", ""]),
                                ("b", "dial: connection refused", None, 1, []), ("c", "x", 500, 1, []),
                                ("d", "", None, 0, []), ("e", "", None, 1, []), ("f", "weird", None, 1, [])],
                               "item_id string, message string, status_code int, n_choices int, "
                               "finish_reasons array<string>")
    got = {r.item_id: (r.error_type, r.finish_reasons) for r in X.classify_errors(df).collect()}
    assert got["a"] == ("timeout", "stop,length")
    assert [got[k][0] for k in "bcdef"] == ["connection_refused", "http_error", "response_decode_error", "",
                                          "llm_request_failed"]


def test_complete_with_batch_fn(spark):
    p = spark.createDataFrame([("1", "p1"), ("2", "p2")], "item_id string, prompt string")

    def fn(b):
        import pandas as pd
        return pd.DataFrame({"item_id": b["item_id"], "content": "{}", "finish_reason": "stop",
                             "prompt_tokens": b["prompt"].str.len(), "completion_tokens": 1, "error": ""})
    assert sorted(r.item_id for r in X.complete(p, fn).collect()) == ["1", "2"]


def test_fallback_requests(spark):
    calls = spark.createDataFrame([("quality-test-1", "", None, 400, '{"error":"Failed to initialize samplers"}')],
                                  "item_id string, content string, finish_reason string, status_code int, body string")
    items = _items(spark).withColumnRenamed("id", "item_id")
    out = X.fallback_requests(calls, items, "m", 512).collect()
    assert [r.reason for r in out] == ["sampler_fallback"]
    body = json.loads(out[0].body)
    assert "json_schema" not in body and body["chat_template_kwargs"] == {"enable_thinking": False}
    trunc = spark.createDataFrame([("quality-test-1", '{"role":"x', None, None, None)],
                                  "item_id string, content string, finish_reason string, status_code int, body string")
    t = X.fallback_requests(trunc, items, "m", 700).collect()
    assert t[0].reason == "compact_retry" and json.loads(t[0].body)["max_tokens"] == 1024
    calls = spark.createDataFrame([("a", '{"role":"x"}', "length", 200, None), ("b", '{"role":"x', "stop", 200, None),
                                   ("c", '{"role":"x', None, 500, None), ("d", "no json", "stop", 200, None)],
                                  "item_id string, content string, finish_reason string, status_code int, body string")
    many = items.limit(1).drop("item_id").crossJoin(calls.select("item_id"))
    again = X.fallback_requests(calls, many, "m", 300, strict=True).collect()
    assert [r.item_id for r in again] == ["b"]  # neither a finish reason nor a failed status asks for a retry
    assert json.loads(again[0].body)["max_tokens"] == 600 and "json_schema" in json.loads(again[0].body)
