"""Byte-level BPE ids of whole texts inside tasks, and packing and counting on top of them.

The vocabulary file's path is a parameter. The same vocabulary exists as a merge list of a
``tokenizers`` JSON file and as ranks; ids are equal, and the rank form encodes about three times
faster, so it does the work. Only a text that contains a special token's string goes through the
JSON tokenizer itself, which gives it that token's id.
"""

from __future__ import annotations

import base64
import functools

import numpy as np

SPECIAL = "<|endoftext|>"


@functools.lru_cache(maxsize=2)
def encoder(json_path: str, ranks_path: str):
    """(encode(text) -> ids, byte length of each id), loaded once per Python worker."""
    import public_tokenizers
    import tiktoken

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    fast = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    lengths = np.zeros(max(ranks.values()) + 2, np.int64)
    for token, rank in ranks.items():
        lengths[rank] = len(token)
    lengths[-1] = len(SPECIAL)
    slow: list = []

    def encode(text: str) -> np.ndarray:
        if SPECIAL in text:
            if not slow:
                from tokenizers import Tokenizer

                slow.append(Tokenizer.from_file(json_path))
            return np.asarray(slow[0].encode(text, add_special_tokens=False).ids, np.uint32)
        return fast.encode_to_numpy(text).astype(np.uint32, copy=False)

    return encode, lengths


def default_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
