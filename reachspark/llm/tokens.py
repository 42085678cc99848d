"""Ids of the public byte-level BPE of 50k entries, as the tokenizers library gives them.

Its ranks are also read by a faster library. Texts of code points below U+0250 take that way, where both split words
alike; texts with others, or with the special token's string, go through the tokenizers library itself."""

from __future__ import annotations

import base64
import re

import numpy as np

_loaded: dict[tuple[str, str], object] = {}
_OTHER = re.compile("[^\t\n\r -~¡-ɏ]|<\\|endoftext\\|>")


def paths(folder: str | None = None) -> tuple[str, str]:
    """Vocabulary files (tokenizers, ranks); folder: where they are, by default the installed public ones."""
    if folder:
        return f"{folder}/byte_bpe_50k.json", f"{folder}/byte_bpe_50k.tiktoken"
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


class Encoder:
    def __init__(self, folder: str | None = None):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import public_tokenizers
        import tiktoken

        self.whole, ranks = paths(folder)
        self._slow = None
        with open(ranks, "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})

    @property
    def slow(self):
        if self._slow is None:
            from tokenizers import Tokenizer

            self._slow = Tokenizer.from_file(self.whole)
        return self._slow

    def ids(self, text: str) -> np.ndarray:
        if _OTHER.search(text):
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)
        return np.array(self.fast.encode_ordinary(text), np.uint32)


def encoder(folder: str | None = None) -> Encoder:
    """One per worker process."""
    key = paths(folder)
    if key not in _loaded:
        _loaded[key] = Encoder(folder)
    return _loaded[key]
