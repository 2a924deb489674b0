"""Token ids of whole texts by a byte-level BPE file of the `tokenizers` library.

The ids are those that `tokenizers` gives by the file's defaults: a text that spells a control
token has that token's id there. Where a text spells none and has no very long run without
(or of) white space, they are computed by `tiktoken` from the ranks of the same file, which
merges in the same order several times faster; tests hold both to the same ids.
"""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache

import numpy as np

# A fixed value: the file's way to split text, in possessive form.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
_LONG = re.compile(r"\S{400}|\s{400}")


def _octets() -> dict[str, int]:
    """The character by which byte-level files write each byte: itself where it is
    printable, else the next free one from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


class Tokenizer:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import tiktoken
        import tokenizers

        self.full = tokenizers.Tokenizer.from_file(path)
        octets = _octets()
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        self.control = control = [t["content"] for t in content["added_tokens"]]
        ranks = {
            bytes(octets[c] for c in token): rank
            for token, rank in content["model"]["vocab"].items() if token not in control
        }
        self.quick = tiktoken.Encoding(
            "ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}
        )

    def ids(self, text: str) -> np.ndarray:
        """The ids of a text as little-endian unsigned 32-bit numbers."""
        spelled = any(token in text for token in self.control)  # they have ids of their own
        if spelled or _LONG.search(text):  # merging by rank takes time in the square of a run
            return np.array(self.full.encode(text, add_special_tokens=False).ids, "<u4")
        return self.quick.encode_to_numpy(text).astype("<u4", copy=False)


@lru_cache(maxsize=2)
def tokenizer(path: str) -> Tokenizer:
    """One per Python worker and file."""
    return Tokenizer(path)
