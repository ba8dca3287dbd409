"""Token ids of whole texts by a lower-casing word BPE, without a cache.

Meant for tokenizers that drop white space and end each word's last token in a word mark, as the
lower-case word BPE does. Numpy finds the ends of the words in a call's characters and writes a mark
behind each; with the mark as one more byte, a plain byte-pair encoder merges like the tokenizer:
first the last byte of a word with its mark, then by the tokenizer's own list. Texts with characters
that this cannot be shown to treat alike go to the tokenizer itself. Nothing is kept between calls.
"""

from __future__ import annotations

import json
import os
import unicodedata
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from tokenizers import Tokenizer

TOKENIZER_FILE = "word_bpe_49k.json"

WORD_END = "</w>"
MARK = "\0"

# Any character but ASCII text and white space, Latin letters that lower-case one to one, and common
# punctuation; and the strings that may be special tokens. Such texts go to the tokenizer.
UNUSUAL = (
    r"[^\t-\r -~\x{A0}-\x{12F}\x{132}-\x{177}\x{2010}-\x{2027}\x{2030}-\x{205E}\x{20AC}\x{2122}]|<\|"
)
# What the tokenizer's pattern tells apart in the usual characters, and the endings that it cuts off.
SPACE, LETTER, DIGIT, OTHER = range(4)
SHORT_ENDINGS, LONG_ENDINGS = "stmd", ("re", "ve", "ll")  # fixed values

# Bytes of text that are encoded at a time.
_CALL_BYTES = 1 << 20

_ENCODERS: dict[str, WordEncoder] = {}


def byte_letters() -> dict[str, int]:
    """The letters in which byte-level vocabularies write bytes: printable Latin-1 characters stand
    for themselves, the others for the code points from 256 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in set(plain)]
    return {chr(byte): byte for byte in plain} | {
        chr(256 + place): byte for place, byte in enumerate(others)
    }


def character_kinds() -> np.ndarray:
    kinds = np.full(0x2200, OTHER, dtype=np.uint8)
    for place in range(len(kinds)):
        character = chr(place)
        if character in "\t\n\x0b\x0c\r \x85\xa0":
            kinds[place] = SPACE
        elif unicodedata.category(character)[0] in "LN":
            kinds[place] = LETTER if unicodedata.category(character)[0] == "L" else DIGIT
    return kinds


_KINDS = character_kinds()


def marked_words(text: str) -> tuple[str, np.ndarray]:
    """The words of lower-case text of usual characters, without white space, a mark behind each;
    and how many words end up to each character.

    A word is a run of letters, one digit, or a run of others; an apostrophe that begins a run of
    others and one of the endings after it are a word, too.
    """
    codes = np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
    kinds = np.concatenate([[SPACE], _KINDS[codes], [SPACE, SPACE, SPACE]]).astype(np.uint8)
    here = kinds[1:-3]
    ends = (here != SPACE) & ((here != kinds[2:-2]) | (here == DIGIT))
    quotes = np.flatnonzero((codes == ord("'")) & (kinds[:-4] != OTHER))
    after = np.concatenate([codes, np.zeros(2, dtype=codes.dtype)])
    first, second = after[quotes + 1], after[quotes + 2]
    short = np.isin(first, [ord(letter) for letter in SHORT_ENDINGS])
    long = np.zeros(len(quotes), dtype=bool)
    for one, two in LONG_ENDINGS:
        long |= (first == ord(one)) & (second == ord(two))
    ends[quotes[short | long]] = False
    ends[quotes[short] + 1] = True
    ends[quotes[long] + 1] = False
    ends[quotes[long] + 2] = True
    kept = here != SPACE
    wide = np.int32 if len(codes) < 1 << 30 else np.int64
    so_far = np.cumsum(ends, dtype=wide)
    places = np.cumsum(kept, dtype=wide) + so_far - ends - 1
    marked = np.zeros(int(kept.sum() + ends.sum()), dtype="<u4")
    marked[places[kept]] = codes[kept]
    return marked.tobytes().decode("utf-32-le"), so_far


class WordEncoder:
    """The ids of texts by one tokenizer file, without special tokens, as uint16."""

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self._tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        if max(model["vocab"].values()) >= 1 << 16:
            raise ValueError("this encoder holds ids of 16 bits")
        letters = byte_letters()
        order = [*letters, *(letter + WORD_END for letter in letters)]
        for merge in model["merges"]:
            order.append("".join(merge) if isinstance(merge, list) else merge.replace(" ", ""))
        ranks: dict[bytes, int] = {}
        ids = []
        for token in dict.fromkeys(order):
            ends = token.endswith(WORD_END)
            data = bytes(letters[letter] for letter in token.removesuffix(WORD_END))
            ranks[data + MARK.encode() * ends] = len(ids)
            ids.append(model["vocab"][token])
        self._ids = np.array(ids, dtype="<u2")
        self._ends = np.array([data.endswith(MARK.encode()) for data in ranks])
        self._words = tiktoken.Encoding(
            "marked-words", pat_str=r"[^\x00]+\x00", mergeable_ranks=ranks, special_tokens={}
        )

    def _by_tokenizer(self, texts: list[str]) -> list[np.ndarray]:
        encoded = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.asarray(one.ids, dtype="<u2") for one in encoded]

    def _usual(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all of the texts, and where each text ends; no text is unusual."""
        lowered = pc.utf8_lower(texts)
        # A line break ends words in every case, so texts are joined by it and told apart again.
        marked, so_far = marked_words("\n".join([*lowered.to_pylist(), ""]))
        sizes = pc.utf8_length(lowered).to_numpy(zero_copy_only=False)
        text_words = so_far[np.cumsum(sizes + 1, dtype=np.int64) - 1]
        # Each different word is merged once a call.
        words = pc.split_pattern(pa.array([marked], pa.large_string()), MARK).flatten()
        encoded = words.slice(0, len(words) - 1).dictionary_encode()
        different = MARK.join([*encoded.dictionary.to_pylist(), ""])
        found = self._words.encode_to_numpy(different, disallowed_special=())
        after = np.flatnonzero(self._ends[found]) + 1
        first = np.concatenate([[0], after[:-1]])[: len(after)]
        codes = encoded.indices.to_numpy(zero_copy_only=False)
        lengths = (after - first)[codes]
        stops = np.cumsum(lengths)
        # Places in a call are far below 2**31.
        shift = np.repeat((first[codes] - (stops - lengths)).astype(np.int32), lengths)
        shift += np.arange(len(shift), dtype=np.int32)
        return self._ids[found[shift]], np.concatenate([[0], stops])[text_words]

    def ids(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The ids of texts, some megabytes at a time, in order: (ids of all, ends of each).

        A null text has no ids.
        """
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        texts = pc.fill_null(texts, "")
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
        start = 0
        while start < len(texts):
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + _CALL_BYTES, "right")))
            call = texts.slice(start, stop - start)
            unusual = pc.match_substring_regex(call, UNUSUAL)
            odd = np.flatnonzero(unusual.to_numpy(zero_copy_only=False))
            if not len(odd):
                yield self._usual(call)
            else:
                found, text_ends = self._usual(call.filter(pc.invert(unusual)))
                others = self._by_tokenizer(call.take(pa.array(odd)).to_pylist())
                parts: list[np.ndarray] = [None] * len(call)  # type: ignore[list-item]
                usual = np.setdiff1d(np.arange(len(call)), odd, assume_unique=True)
                for place, part in zip(usual, np.split(found, text_ends)[:-1], strict=True):
                    parts[place] = part
                for place, part in zip(odd, others, strict=True):
                    parts[place] = part
                yield np.concatenate(parts), np.cumsum([len(part) for part in parts])
            start = stop


def encoder(name: str = TOKENIZER_FILE) -> WordEncoder:
    """The worker's encoder for a vocabulary file, by name or path."""
    path = name if os.path.isabs(name) else public_tokenizers.path(name)
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]
