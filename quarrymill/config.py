"""Settings of the flows, with defaults and overrides from the environment. Credentials are never kept here."""

from __future__ import annotations

import os
from dataclasses import dataclass, fields


@dataclass(frozen=True)
class Settings:
    """Retrieval: results a question. Models: temperature, most characters of a page or a person's page, tries. Index:
    batch of embeddings, context in tokens. Samples: rows of a file, pool ratio. Chunks: most and least characters."""

    top_k: int = 5
    temperature: float = 0.1
    page_chars: int = 2000
    person_chars: int = 3000
    qa_chars: int = 2800
    tries: int = 3
    embedding_batch: int = 128
    context_tokens: int = 30_000
    sample_size: int = 100
    top_ratio: float = 2.0
    chunk_chars: int = 800
    chunk_least: int = 30
    crawl_depth: int = 4
    crawl_pages: int = 2000

    @classmethod
    def from_env(cls, prefix: str = "QUARRYMILL_") -> Settings:
        """Defaults, but for those that the environment sets, such as QUARRYMILL_TOP_K."""
        found = {}
        for f in fields(cls):
            value = os.environ.get(prefix + f.name.upper())
            if value is not None:
                found[f.name] = type(f.default)(value)
        return cls(**found)
