"""Public tokenizers from vocabulary files, which are read where they lie and never copied."""

from __future__ import annotations

import base64
from functools import lru_cache

#: Folder of the vocabulary files; every function takes another one as a parameter.
TOKENIZERS = "/opt/tokenizers"
# The pattern that splits a text into words before the merges.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(maxsize=4)
def encoding(name: str = "byte_bpe_50k", folder: str = TOKENIZERS):
    """The rank file ``name`` as an encoder, loaded once in each worker."""
    import tiktoken

    with open(f"{folder}/{name}.tiktoken", "rb") as file:
        ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, file)}
    return tiktoken.Encoding(name, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
