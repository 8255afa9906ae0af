"""Fixed values.

Everything in this module must equal the behaviour being matched for right
results: word lists, label maps, domains.  They are stated plainly and in
their natural order; code elsewhere only looks them up.
"""

# --- fixed values: record/state domains ------------------------------------
SCHEMA_VERSION = "v1"
ITEM_STATUSES = ["NEW", "ANALYZED", "DISPATCHED", "FAILED"]
QUEUE_STATES = ["QUEUED", "LEASED", "DONE"]
DERIVED_QUEUE_STATES = [
    "not_enqueued_raw",
    "queued_raw",
    "inflight_raw",
    "processed_raw",
    "not_enqueued_analyzed",
    "queued_analyzed",
    "dispatched",
    "failed",
    "unknown",
]
BOARD_LANES = ["raw_backlog", "raw_inflight", "analyzed_backlog",
               "analyzed_inflight", "failed", "anomalies"]
BOARD_LANE_TITLES = {
    "raw_backlog": "Raw Backlog",
    "raw_inflight": "Raw Inflight",
    "analyzed_backlog": "Analyzed Backlog",
    "analyzed_inflight": "Analyzed Inflight",
    "failed": "Failed",
    "anomalies": "Anomalies",
}

# --- fixed values: job categories ------------------------------------------
DEFAULT_CATEGORY = "Altri ruoli"
ALLOWED_CATEGORIES = [
    "Programmazione",
    "Devops & Sysadmin",
    "Customer Support",
    "Marketing",
    "Design",
    "Business",
    "Copywriting",
    "Jobs",
    "Altri ruoli",
]
CATEGORY_ALIASES = {
    "programmazione": "Programmazione",
    "devops & sysadmin": "Devops & Sysadmin",
    "devops and sysadmin": "Devops & Sysadmin",
    "devops/sysadmin": "Devops & Sysadmin",
    "customer support": "Customer Support",
    "marketing": "Marketing",
    "design": "Design",
    "business": "Business",
    "copywriting": "Copywriting",
    "jobs": "Jobs",
    "altri ruoli": "Altri ruoli",
    "altri ruoli.": "Altri ruoli",
    "other roles": "Altri ruoli",
}

# --- fixed values: placeholder words treated as "unknown" (case-insensitive)
PLACEHOLDERS = [
    "unknown", "n/a", "na", "none", "null", "-", "--",
    "not specified", "not available", "unspecified", "tbd",
    "non specificato", "non disponibile", "non indicato", "da definire", "nessuno",
]

# --- fixed values: vague salary tokens (substring match, lower case) ------
VAGUE_SALARY_TOKENS = [
    "competitive", "commisurata", "negoziabile", "market rate", "depends", "depending",
    "to be defined", "da definire", "tbd",
]

# --- fixed values: confidence labels -> number ------------------------------
CONFIDENCE_LABELS = {
    "molto alta": 0.95, "very high": 0.95,
    "alta": 0.85, "alto": 0.85, "high": 0.85,
    "media": 0.6, "medio": 0.6, "moderata": 0.6, "medium": 0.6, "moderate": 0.6,
    "bassa": 0.3, "basso": 0.3, "low": 0.3,
    "molto bassa": 0.1, "very low": 0.1,
}

# --- fixed values: required keys of the extraction response ----------------
RESPONSE_KEYS = [
    "job_category", "role", "company", "seniority", "location", "remote_type",
    "tech_stack", "tags", "contract_type", "salary", "language", "summary_it",
    "confidence",
]

# --- fixed values: numeric character references 0x80-0x9F (HTML spec) ------
# The HTML standard maps these C1 code points to Windows-1252 characters.
C1_REPLACEMENTS = {
    0x80: "€", 0x82: "‚", 0x83: "ƒ", 0x84: "„", 0x85: "…",
    0x86: "†", 0x87: "‡", 0x88: "ˆ", 0x89: "‰", 0x8A: "Š",
    0x8B: "‹", 0x8C: "Œ", 0x8E: "Ž", 0x91: "‘", 0x92: "’",
    0x93: "“", 0x94: "”", 0x95: "•", 0x96: "–", 0x97: "—",
    0x98: "˜", 0x99: "™", 0x9A: "š", 0x9B: "›", 0x9C: "œ",
    0x9E: "ž", 0x9F: "Ÿ",
}

# --- fixed values: extraction prompts (Python format fields in braces) ------
SYSTEM_MESSAGE = "Sei un analizzatore annunci lavoro. Rispondi solo JSON valido."
PROMPT_FULL = """Analizza il seguente annuncio lavoro e restituisci SOLO JSON valido con i campi:
job_category, role, company, seniority, location, remote_type, tech_stack (array), tags (array), contract_type, salary, language, summary_it, confidence.
Lingua output: italiano.
Regola anti-allucinazioni (obbligatoria): usa solo informazioni esplicitamente presenti in titolo/descrizione/link forniti.
NON inferire da conoscenza esterna e NON inventare valori mancanti.
Se un campo non è chiaramente presente usa stringa vuota (o array vuoto).
Campi da valorizzare con massima priorita' (se presenti): seniority, location, contract_type, salary, tech_stack.
Mantieni tech_stack breve: massimo 8 tecnologie reali, senza inventare valori.
tags: array di 3-6 tag distintivi, minuscoli, senza #, max 24 caratteri per tag (es: go, kubernetes, remote, fintech, full-time).
summary_it: una sola frase, massimo 220 caratteri.
confidence: numero tra 0 e 1 (0 = molto incerto, 1 = molto sicuro).
Per job_category usa SOLO una di queste categorie esatte:
{categories}
Se non è classificabile, usa esattamente: Altri ruoli.

Titolo: {title}
URL: {url}
Descrizione: {description}
Contenuto pagina sorgente (estratto): {excerpt}
Link estratti: {links}
Immagini estratte: {images}"""
PROMPT_COMPACT = """Restituisci SOLO 1 riga JSON valida (nessun markdown, nessun testo extra) con questi campi:
job_category,role,company,seniority,location,remote_type,tech_stack,tags,contract_type,salary,language,summary_it,confidence
Vincoli:
- job_category deve essere una di: {categories}
- usa SOLO informazioni esplicitamente presenti nel testo fornito
- non inventare: se non chiaro/menzionato usa stringa vuota o array vuoto
- tech_stack massimo 8 elementi
- tags: 3-6 valori lowercase, senza #, max 24 caratteri ciascuno
- summary_it massimo 220 caratteri
- confidence deve essere un numero tra 0 e 1

Titolo: {title}
URL: {url}
Descrizione: {description}
Contenuto pagina sorgente (estratto): {excerpt}"""
# Template variables a user prompt template may use ({{.Name}} syntax).
TEMPLATE_VARIABLES = ["AllowedCategories", "Title", "URL", "Description", "SourcePageText",
                      "LinksCSV", "ImagesCSV"]
EXCERPT_MISSING = "N/D"

# --- fixed values: model-call error classes, checked in this order ---------
ERROR_CLASSES = [
    ("timeout", ["deadline exceeded", "timeout"]),
    ("connection_refused", ["connection refused"]),
    ("dns_error", ["no such host"]),
    ("tls_error", ["tls"]),
]
DEFAULT_ERROR_CLASS = "llm_request_failed"
SAMPLER_INIT_ERROR = "failed to initialize samplers"
MISSING_REQUIRED = "missing required analyzed fields"

# --- fixed values: message layouts -------------------------------------------
# The line above the default layout is deployment branding: a parameter of
# render_default; this neutral value is only its default.
DEFAULT_LAYOUT_HEADER = "*JOB-FEED*"
# The two layouts whole, in the template language of operators/template.py.
DEFAULT_LAYOUT = """{{md .SourceLabel}}

{{if .OriginalLinks}}{{index .OriginalLinks 0}}{{else}}{{.SourceURL}}{{end}}

*Categoria:* {{md .JobCategory}}
*{{md .Role}}* @ *{{md .Company}}*
{{md .SummaryIT}}

- Seniority: {{md .Seniority}}
- Location: {{md .Location}} ({{md .RemoteType}})
- Contratto: {{md .ContractType}}
- Salary: {{md .Salary}}
- Stack: {{range $i, $v := .TechStack}}{{if $i}}, {{end}}{{md $v}}{{end}}
{{if .Tags}}- Tags: {{range $i, $t := .Tags}}{{if $i}} {{end}}#{{md $t}}{{end}}
{{end}}

{{if .OriginalLinks}}
*Link Originali*
{{range .OriginalLinks}}- {{.}}
{{end}}{{end}}

{{if .OriginalImages}}
*Immagini*
{{range .OriginalImages}}- {{.}}
{{end}}{{end}}

[Annuncio originale]({{.SourceURL}})
"""
CHAT_LAYOUT = """┏━━━━━━━━━━━━━━━━━━━━━━
┃ 🚀 *{{ if .Role }}{{ md .Role }}{{ else }}{{ md .Title }}{{ end }}*
┃ 🏢 {{ md .Company }}
┃ 🏠 {{ md .Location }}
┃ 💰 {{ md .Salary }}
┗━━━━━━━━━━━━━━━━━━━━━━

{{- if .TechStack }}

🧩 *Stack:*{{- range $v := .TechStack }}{{- $tag := tgtag $v }}{{- if $tag }} #{{ $tag }}{{- end }}{{- end }}
{{- end }}

{{- if .SummaryIT }}

📝 *Sintesi:*  
{{ md .SummaryIT }}
{{- end }}

├ 📈 {{ md .Seniority }}
├ 🏷 {{ md .ContractType }}
├ 🌍 {{ md .Language }}
└ ⭐ {{ .JobPostQualityRank }} ({{ .JobPostQualityScore }}/100)

{{- if .Tags }}
🏷 {{- range $t := .Tags }}{{- $tag := tgtag $t }}{{- if $tag }} #{{ $tag }}{{- end }}{{- end }}
{{- end }}

🔗 [candidati]({{ .SourceURL }})
"""
FILE_SEPARATOR = "\n\n---\n\n"
PARSE_ENTITIES_ERROR = "can't parse entities"

# --- fixed values: feed health reasons ---------------------------------------
FEED_DISABLED, FEED_BROKEN = "feed disabilitato", "feed in errore (cooldown attivo)"

# --- fixed values: synthetic posting generator pools ------------------------
SYNTH_COMPANIES = ["Acme Cloud", "Nimbus Labs", "Northstar Data", "Pixel Orbit", "Atlas Metrics"]
SYNTH_ROLES = ["Senior Go Backend Engineer", "Staff Platform Engineer", "DevOps Engineer (Kubernetes)",
               "Full-Stack Engineer (Go/React)", "Site Reliability Engineer"]
SYNTH_REGIONS = ["Worldwide", "EMEA", "US/Canada", "Europe", "LATAM"]
SYNTH_STACK = ["Go", "PostgreSQL", "Docker", "Kubernetes", "RabbitMQ", "Redis", "Terraform", "AWS", "GCP"]
SYNTH_CATEGORY = "Programming"
SYNTH_CONTRACT = "Full-Time"
SYNTH_JOBS_PATH = "/jobs/"
SYNTH_DESCRIPTION = ("{company} is looking for a {role} to scale distributed systems used by remote teams "
                     "across {region}. You will own backend services, CI/CD reliability, and production "
                     "observability.")

# --- fixed values: named zones of RFC-822 dates -----------------------------
ZONE_OFFSETS = {"GMT": "+0000", "UTC": "+0000", "UT": "+0000", "Z": "+0000", "EST": "-0500", "EDT": "-0400", "CST": "-0600",
                "CDT": "-0500", "MST": "-0700", "MDT": "-0600", "PST": "-0800", "PDT": "-0700"}
