"""The template compiler: golden renderings, scopes, trimming, and what it refuses."""
import pytest

from feedloom.operators import publish as P
from feedloom.operators.template import TemplateError, column_name, compile_template

FIELDS = P.LAYOUT_FIELDS
ROW = {"role": "Go_Dev", "company": "ACME", "title": "T*", "tags": ["a b", "", "c#"], "tech_stack": [], "original_links": ["l0", "l1"], "job_post_quality_score": 70,
       "source_url": "https://x", "source_label": None, "original_images": None}

CASES = [
    ("plain", "plain"), ("", ""), ("{{.Role}}/{{md .Role}}", "Go_Dev/Go\\_Dev"), ("{{.SourceLabel}}|{{.JobPostQualityScore}}", "|70"),
    ("{{if .Role}}y{{else}}n{{end}}{{if .TechStack}}y{{end}}{{if .SourceLabel}}y{{else if .Tags}}tags{{else}}n{{end}}", "ytags"),
    ("{{range .Tags}}<{{.}}>{{end}}{{range .TechStack}}x{{else}}none{{end}}{{range .OriginalImages}}x{{end}}", "<a b><><c#>none"),
    ("{{range $i, $v := .OriginalLinks}}{{if $i}}, {{end}}{{$i}}={{$v}}{{end}}", "0=l0, 1=l1"),
    ("{{range $v := .Tags}}{{$t := tgtag $v}}{{if $t}} #{{$t}}{{end}}{{end}}", " #ab #c"),
    ("a  {{- if .Role -}}  b  {{- end -}}  c", "abc"), ("a {{/* x }} y */}} b", "a  b"), ("{{ index .OriginalLinks 1 }}{{index .OriginalLinks 9}}", "l1"),
    ('{{$x := "q\\"}}"}}{{$x}}{{`r`}}{{3}}{{true}}', 'q"}}r3true'), ("{{.Role | md | len}} {{len .Tags}} {{len \"é\"}}", "7 3 2"),
    ('{{if and .Role (not .TechStack)}}1{{end}}{{if or .SourceLabel .TechStack}}2{{end}}', "1"),
    ('{{if and .Role (not .TechStack | not)}}1{{else}}0{{end}}', "0"),
    ('{{or .SourceLabel .Company}} {{and .Role .Company}} {{if eq .Company "ACME"}}e{{end}}{{if ne 1 .JobPostQualityScore}}n{{end}}', "ACME ACME en"),
    ("{{$x := .Role}}{{if .Company}}{{$x := .Company}}{{$x}}{{end}}{{$x}}", "ACMEGo_Dev"),
    ("{ {{ .Company }} }", "{ ACME }"),
]


@pytest.fixture(scope="module")
def row(spark):
    schema = ", ".join(f"{n} {t}" for n, t in FIELDS.items())
    return spark.createDataFrame([tuple(ROW.get(n) for n in FIELDS)], schema)


@pytest.mark.parametrize("source,want", CASES)
def test_golden(row, source, want):
    assert row.select(compile_template(source, FIELDS).alias("m")).first().m == want


@pytest.mark.parametrize("source", ["{{.Nope}}", "{{nope .Role}}", "{{if .Role}}", "{{end}}", "{{else}}", "{{.Role", "{{}}", "{{md}}", "{{md .Tags}}", "{{.Tags}}",
                                    "{{$x}}", "{{range .Role}}{{end}}", "{{range $a, $b, $c := .Tags}}{{end}}", "{{.Role .Title}}", "{{(md .Role}}", "{{md .Role)}}", "{{index .Tags}}",
                                    "{{eq .Role 1}}", "{{range .Tags}}{{.Role}}{{end}}", "{{if .Role}}{{else}}{{else}}{{end}}", "{{.}}", "{{\"open}}", "{{a := 1}}",
                                    '{{and .Tags .Tags}}', "{{if .Role}}{{end .Role}}", "{{range .Tags}}{{else if .Role}}{{end}}"])
def test_bad_templates_raise_before_any_job(spark, source):
    with pytest.raises(TemplateError):
        P.user_layout(source)


def test_names():
    assert [column_name(n) for n in ("SourceURL", "SummaryIT", "TechStack", "Role", "JobPostQualityRank")] == [
        "source_url", "summary_it", "tech_stack", "role", "job_post_quality_rank"]


def test_user_layout_in_render(row):
    assert P.render_messages(row, P.user_layout("{{.Company}}!")).first().message == "ACME!"
    with pytest.raises(ValueError):
        P.render_messages(row, "unknown")
