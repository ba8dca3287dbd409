"""Token ids of whole texts by a byte-level BPE file, through a byte-pair encoder in native code.

The encoder is built from the file's vocabulary: in such files an id is also the rank of the merge
that makes it. Texts with a very long run of white space, on which the encoder's pattern fails, go to
the tokenizer itself; both give the same ids.
"""

from __future__ import annotations

import os
import re

import numpy as np
import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

from chatloom.llm.word_pieces import byte_letters

TOKENIZER_FILE = "byte_bpe_50k.json"

# White space in a row that goes to the tokenizer.
LONG_RUN = 20_000
_LONG_RUN = re.compile(rf"\s{{{LONG_RUN}}}")

_ENCODERS: dict[tuple[str, bool], ByteEncoder] = {}


class ByteEncoder:
    """Ids of texts; ``special`` says whether strings of special tokens become those tokens."""

    def __init__(self, path: str, special: bool) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = not special
        added = {
            token.content: place
            for place, token in self._tokenizer.get_added_tokens_decoder().items()
        }
        letters = byte_letters()
        vocabulary = self._tokenizer.get_vocab(with_added_tokens=False)
        ranks = {
            bytes(letters[letter] for letter in token): place
            for token, place in vocabulary.items()
            if token not in added
        }
        self.size = 1 + max(*ranks.values(), *added.values())
        self.token_bytes = {place: data for data, place in ranks.items()}
        self._special = "all" if special else set()
        self._fast = tiktoken.Encoding(
            os.path.basename(path),
            pat_str=public_tokenizers.PATTERN,
            mergeable_ranks=ranks,
            special_tokens=added,
        )

    def ids(self, text: str) -> np.ndarray:
        """The ids of a text as uint32."""
        if len(text) >= LONG_RUN and _LONG_RUN.search(text):
            encoded = self._tokenizer.encode(text, add_special_tokens=False)
            return np.asarray(encoded.ids, dtype=np.uint32)
        return self._fast.encode_to_numpy(
            text, allowed_special=self._special, disallowed_special=()
        )


def encoder(name: str = TOKENIZER_FILE, special: bool = True) -> ByteEncoder:
    """The worker's encoder for a vocabulary file, by name or path."""
    path = name if os.path.isabs(name) else public_tokenizers.path(name)
    if (path, special) not in _ENCODERS:
        _ENCODERS[path, special] = ByteEncoder(path, special)
    return _ENCODERS[path, special]
