"""Token ids of byte-level BPE, exactly those of the ``tokenizers`` library without special tokens
added, for whole Arrow columns.

A blank between two characters that are not white space always begins a token, so such texts can be
encoded word by word. Most words repeat: each worker keeps the ids of ``CACHE_WORDS`` words. New ones
are encoded together, and the result is cut before tokens that begin with a blank. Texts with other
white space beside a blank, and texts with a special token's name in them, go to the library as they are.
"""

import json
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from tokenizers import Tokenizer

CACHE_WORDS = 400_000
#: Fixed value: how the byte-level pre-tokenizer of the vocabulary file splits text.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _byte_of_character() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and the others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class _Words:
    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            content = json.load(f)
        self.special = [t["content"] for t in content["added_tokens"]]
        byte = _byte_of_character()
        ranks = {bytes(byte[c] for c in token): i for token, i in content["model"]["vocab"].items()
                 if token not in self.special}
        self.fast = tiktoken.Encoding("words", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.blank = np.zeros(max(ranks.values()) + 1, bool)
        for token, i in ranks.items():
            self.blank[i] = token.startswith(b" ")
        self.known: dict[str, bytes] = {}

    def learn(self, words: list[str]) -> None:
        if len(self.known) + len(words) > CACHE_WORDS:
            self.known.clear()
        ids = np.array(self.fast.encode_ordinary(" " + " ".join(words)), np.uint32)
        starts = (np.flatnonzero(self.blank[ids]) * 4).tolist()
        data = ids.tobytes()
        for word, a, b in zip(words, starts, [*starts[1:], len(data)]):
            self.known[word] = data[a:b]

    def encode(self, text: str) -> bytes:
        """The ids as 32-bit numbers in a row."""
        if any(name in text for name in self.special):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32).tobytes()
        first, *words = text.split(" ")
        if first == first.rstrip() and (first or not words):
            for _ in range(2):  # learning may have emptied the store of earlier words of this text
                fresh = set(words).difference(self.known)
                if not all(word and word == word.strip() for word in fresh):
                    break  # white space beside a blank
                if fresh:
                    self.learn(list(fresh))
            if not fresh:
                start = np.array(self.fast.encode_ordinary(first), np.uint32).tobytes()
                return start + b"".join(map(self.known.__getitem__, words))
        return np.array(self.fast.encode_ordinary(text), np.uint32).tobytes()


@lru_cache(maxsize=2)
def _words(path: str) -> _Words:
    return _Words(path)


def vocabulary_size(path: str) -> int:
    """Ids are below it."""
    return Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True)


def encoder(path: str) -> Callable[[pa.Array], Iterator[np.ndarray]]:
    """A function from an Arrow column of texts (null: empty) to the ids of each."""
    words = _words(path)
    return lambda texts: (np.frombuffer(words.encode(t or ""), np.uint32) for t in texts.to_pylist())
