"""All queries of this subpackage."""

from glimmerdex.llm import archive, bpe, decontaminate, forest, licenses, phrases, pii, prefix_hash, quality, secrets, simhash, token_file, variants  # noqa: F401
from glimmerdex.llm.registry import CHECKS, QUERIES  # noqa: F401
