"""Named defaults.

The scoring formulas are decisions of this library (they follow published
papers); the remaining values are part of the contract the library keeps.
"""

# Contract limits and defaults.
TITLE_CHARS = 250
TITLE_FROM_TEXT_CHARS = 100
DESCRIPTION_FROM_TEXT_CHARS = 200
DEFAULT_K = 4
HYBRID_DEFAULT_K = 5
TUNED_DEFAULT_ROWS = 10
MIN_POOL = 10
RAG_DOCS = 3
RAG_WORDS = 1500
EMBED_BATCH = 50
INGEST_BATCH = 50
INGEST_TIMEOUT_SECONDS = 180
COMMIT_WITHIN_SECONDS = 10
MODES = ("union", "keywords_required", "meaning_required", "intersection")
LEXICAL_WEIGHTS = {"title": 100.0, "description": 20.0, "text": 1.0}
HYBRID_WEIGHTS = {"title": 100.0, "text": 1.0}
FIRST_CLASS_TEXT_FIELDS = ("author", "category", "content_type", "og_image")
UNFLATTENED_KEYS = ("rtf", "uri", "url")
RESERVED_META_NAMES = ("lc_json", "ext_id")

# Decisions: analysis and scoring.
TOKEN_SEPARATOR = r"[^\p{L}\p{N}]+"
BM25_K1 = 1.2
BM25_B = 0.75
SCORE_DIGITS = 6
FRESHNESS_DAYS = 30.0
DEFAULT_BASE_URI = "https://corpus.example.org"


def pool_size(k: int, pool: int | None = None) -> int:
    """Candidates kept per query and leg before fusion."""
    return max(k, MIN_POOL) if pool is None else pool
