"""Rule data for term cleaning.

Rules are plain data: lists of regex patterns, ordered (pattern, replacement) pairs,
and alias dictionaries. Operators turn them into column expressions (few rules) or
broadcast tables (rule files of unknown length).
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES — must equal the production rule set for identical results.
# Removal patterns (case-insensitive search; an item matching any is dropped).
REMOVE_PATTERNS: list[str] = [
    r"\bskills\b",
    r"\banalyst\b",
    r"\bdocumentation\b",
    r"\bprototyping tools\b",
    r"\banalytical tools\b",
    r"\bdata modeling\b",
    r"\btheories\b",
    r"\bdeep learning\b",
    r"\bproduct owner\b",
    r"\bprocessing\b",
    r"\bmachine learning models\b",
    r"\banalytics\b",
    r"\bnone\b",
    r"\bengineer\b",
    r"\banalysis\b",
    r"\bstatistical\b",
    r"\bengineering\b",
    r"\bvisualization\b",
]

# Mapping rules in priority order (first case-insensitive search hit replaces the item).
MAP_RULES: list[tuple[str, str]] = [
    (r"\b(aws|amazon)\b", "aws"),
    (r"\b(ai|artificial intelligence|contextual ai)\b", "ai"),
    (r"\b(google|gcp)\b", "google"),
    (r"\b(power bi|powerbi)\b", "powerbi"),
    (r"\b(excel)\b", "excel"),
    (r"\b(microsoft word|ms word|ms office)\b", "microsoft office"),
]

# Stop-lists as data: substring ("partial") and whole-term ("exact") removal.
STOP_PARTIAL: list[str] = [
    "skills", "analyst", "documentation", "applications", "collaborate with",
    "lead data mining and collection", "data profiling", "proprietary", "security",
    "ability to", "regulatory", "translate business", "exploration", "p.h.d", "ph.d",
    "phd", "best practices", "bachelor", "bachelors", "degree", "lifecycle",
    "security clearance", "collaborating",
]
STOP_EXACT: list[str] = [
    "prototyping tools", "analytical tools", "data modeling", "reserving theories",
    "verizon", "deep learning", "sql queries", "product owner", "data processing",
    "machine learning models", "analytics", "none", "devops engineer", "machine learning",
    "machine learning engineer", "data analysis", "statistical tools", "data engineering",
]

# Canonical term -> aliases.
ALIASES: dict[str, list[str]] = {
    "aws": ["amazon", "aws"],
    "azure": ["azure"],
    "llm": ["llm", "llms"],
    "ai": ["ai", "artificial intelligence", "contextual ai"],
    "python": ["python"],
    "powerbi": ["ms power bi", "ms powerbi", "power bi", "powerbi", "microsoft power bi",
                "microsoft powerbi"],
    "sas": ["sas"],
    "gcp": ["gcp", "google cloud"],
    "excel": ["microsoft excel", "excel", "ms excel"],
    "microsoft": ["ms office", "microsoft word", "ms word", "microsoft office"],
    "nlp": ["nlp", "natural language processing"],
    "edm": ["edm"],
    "adobe": ["adobe"],
    "labelbox": ["labelbox"],
    "nosql": ["nosql"],
    "mysql": ["mysql"],
    "postgresql": ["postgresql"],
    "sql": ["sql"],
    "google": ["google suite", "google docs"],
    "oracle": ["oracle"],
}

# Pay annualisation: hours per year for any non-yearly pay type.
HOURS_PER_YEAR = 2080.0

# Request budget of the term extractor.
MAX_REQUESTS_PER_MINUTE = 500
MAX_TOKENS_PER_MINUTE = 59999
MAX_ATTEMPTS = 5
COMPLETION_TOKENS = 3000
TOKENS_PER_MESSAGE = 4
TOKENS_REPLY_PRIMER = 2

# Search paging: 10 results per page; above 1000 hits only 50 offsets are planned.
PAGE_SIZE = 10
HIT_THRESHOLD = 1000
CAPPED_HITS = 50
# ---------------------------------------------------------------------------


def alias_pairs(aliases: dict[str, list[str]] = ALIASES) -> list[tuple[str, str]]:
    """(alias, canonical) pairs; the first canonical listing an alias wins."""
    out: dict[str, str] = {}
    for canonical, names in aliases.items():
        for name in names:
            out.setdefault(name.lower(), canonical)
    return list(out.items())

