"""Token vocabularies on the executors, loaded once per Python worker."""

from __future__ import annotations

import base64
import json
import os
from functools import lru_cache


@lru_cache(maxsize=2)
def encoding(path: str, pattern: str, added: tuple[tuple[str, int], ...] = ()):
    """Byte-level BPE from a file of ranks, with added tokens; ``encode_ordinary`` takes the
    strings of these for ordinary text."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens=dict(added)
    )


def added_tokens(vocabulary: str) -> tuple[tuple[str, int], ...]:
    """The added tokens of the tokenizers file next to the ranks, none if there is no file."""
    path = f"{os.path.splitext(vocabulary)[0]}.json"
    if not os.path.exists(path):
        return ()
    with open(path, encoding="utf-8") as file:
        return tuple((t["content"], t["id"]) for t in json.load(file)["added_tokens"])


def default_vocabulary(vocabulary: str | None, pattern: str | None) -> tuple[str, str]:
    if vocabulary is None or pattern is None:
        import public_tokenizers

        vocabulary = vocabulary or public_tokenizers.path("byte_bpe_50k.tiktoken")
        pattern = pattern or public_tokenizers.PATTERN
    return vocabulary, pattern
