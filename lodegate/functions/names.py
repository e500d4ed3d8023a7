"""Unicode part of name keys; plain Python so workers need no Spark objects."""

from __future__ import annotations

import unicodedata
from collections.abc import Collection


def entity_key_text(name: str, legal_forms: Collection[str]) -> str:
    base = [c for c in unicodedata.normalize("NFKD", name).casefold() if unicodedata.combining(c) == 0]
    spaced = "".join(" and " if c == "&" else c if c.isalnum() else " " for c in base)
    words = spaced.split()
    end = len(words)
    while end and words[end - 1] in legal_forms:
        end -= 1
    return "".join(words[:end])
