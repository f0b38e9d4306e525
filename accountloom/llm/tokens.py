"""Token ids of whole texts from a public byte-pair vocabulary.

The vocabulary comes in two files with the same tokens and ids: one for `tokenizers`,
which defines the ids, and one of ranks for `tiktoken`, which finds the same ids
several times faster. The tests hold the two against each other. Texts with a run of
blanks too long for the faster library's pattern, or with a special token, which only the
other recognises, go to the other.
"""

from __future__ import annotations

import base64
import json
import re

import numpy as np
import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
LONG_BLANKS = re.compile(r"\s{5000}")


class Encoder:
    """encode gives ids as little-endian unsigned 32-bit integers.

    A special token of the vocabulary that stands in a text has its own id, as the defining
    library reads it unless told otherwise; none is added.
    """

    def __init__(self, vocabulary: str = VOCABULARY, ranks: str = RANKS):
        self._vocabulary, self._slow = vocabulary, None
        with open(vocabulary, "rb") as file:
            self._special = [x["content"] for x in json.load(file)["added_tokens"]]
        with open(ranks, "rb") as lines:
            found = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self._fast = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=found, special_tokens={}
        )

    def defining(self, text: str) -> np.ndarray:
        """The ids by the library that defines them."""
        if self._slow is None:
            self._slow = Tokenizer.from_file(self._vocabulary)
        return np.array(self._slow.encode(text, add_special_tokens=False).ids, "<u4")

    def encode(self, text: str) -> bytes:
        if any(x in text for x in self._special) or len(text) >= 5000 and LONG_BLANKS.search(text):
            return self.defining(text).tobytes()
        return self._fast.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False).tobytes()
