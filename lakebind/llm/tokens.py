"""Public tokenizers by the path of their vocabulary file."""

from __future__ import annotations

import base64
import functools

import numpy as np
import tiktoken

#: Where the vocabulary of ``byte_bpe_50k`` lies on every machine.
BYTE_BPE_50K = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The published splitting pattern of the byte-level vocabularies (a fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@functools.lru_cache(maxsize=4)
def byte_bpe(path: str) -> tiktoken.Encoding:
    """The byte-level BPE of the ranks at ``path``, loaded once in each process; it has no special tokens."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
    return tiktoken.Encoding("byte-bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def encode(coder: tiktoken.Encoding, text: str) -> np.ndarray:
    return np.array(coder.encode_ordinary(text), dtype=np.int32)
