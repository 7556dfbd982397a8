"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

No piece joins a character to a following blank mark, so a text falls into words, each with its
leading blanks, that are encoded one by one; each worker keeps the ids of ``CACHE_WORDS`` words. New
words are encoded together on flat symbol arrays. In every round, each word finds the smallest rank
among its pairs and merges the pairs of this rank, leftmost first and never overlapping, in all words
at once; the arrays are then compacted, and words without a pair left drop out.

Equal pairs of a word may merge in one round as long as a merge cannot create a pair of no larger
rank. The few pieces for which the vocabulary allows that are merged one at a time.

The result is that of the sentencepiece library for BPE models with byte fallback, identity
normalisation, a leading dummy blank and no user-defined or unused pieces; other models are refused.

Edge cases. Null text counts as empty and has no ids, and decodes to the empty text. Blank runs,
characters outside the vocabulary (written as bytes) and very long words are handled alike.
"""

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from sentencepiece import sentencepiece_model_pb2

from runlens.llm.batches import bounded

CACHE_WORDS = 300_000
GROUP_CHARACTERS = 1_000_000  # texts whose new words are encoded together
BLANK = "▁"
_NONE = np.iinfo(np.int32).max
_NORMAL, _UNKNOWN, _CONTROL, _BYTE = 1, 2, 3, 6
_RUNS = re.compile(r" *[^ ]+| +")


class PieceModel:
    def __init__(self, path: str):
        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        pieces, norm = proto.pieces, proto.normalizer_spec
        normal = {p.piece: (i, p.score) for i, p in enumerate(pieces) if p.type == _NORMAL}
        if (proto.trainer_spec.model_type != 2 or not proto.trainer_spec.byte_fallback
                or norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.add_dummy_prefix
                or any(p.type not in (_NORMAL, _UNKNOWN, _CONTROL, _BYTE) for p in pieces)
                or any(BLANK in p.lstrip(BLANK) for p in normal)):
            raise ValueError(f"{path}: not a plain BPE model with byte fallback")
        self.size = len(pieces)
        self.known: dict[str, bytes] = {}
        self.byte_id = {int(p.piece[3:5], 16): i for i, p in enumerate(pieces) if p.type == _BYTE}
        self.shown = [
            b"" if p.type == _CONTROL
            else proto.trainer_spec.unk_surface.encode() if p.type == _UNKNOWN
            else bytes([int(p.piece[3:5], 16)]) if p.type == _BYTE
            else p.piece.replace(BLANK, " ").encode()
            for p in pieces
        ]
        self.begins_blank = np.array([p.type == _NORMAL and p.piece[0] == BLANK for p in pieces])
        self.is_control = np.array([p.type == _CONTROL for p in pieces])
        self.character = {ord(p): i for p, (i, _) in normal.items() if len(p) == 1}
        order = {s: k for k, s in enumerate(sorted({s for _, s in normal.values()}, reverse=True))}
        rank = np.full(self.size, -1, np.int32)
        for i, score in normal.values():
            rank[i] = order[score]

        def symbol(part: str) -> int | None:
            """A vocabulary piece, or a single character outside the vocabulary."""
            if part in normal:
                return normal[part][0]
            return self.size + ord(part) if len(part) == 1 else None

        self.span = self.size + 0x110000
        keys, merged = [], []
        for piece, (i, _) in normal.items():
            for at in range(1, len(piece)):
                left, right = symbol(piece[:at]), symbol(piece[at:])
                if left is not None and right is not None:
                    keys.append(left * self.span + right)
                    merged.append(i)
        by_key = np.argsort(np.array(keys, np.int64))
        self.pair_keys = np.array(keys, np.int64)[by_key]
        self.pair_into = np.array(merged, np.int32)[by_key]
        self.pair_rank = rank[self.pair_into]
        #: pieces that can be part of a merge of no larger rank than their own
        self.eager = np.zeros(self.size, bool)
        for part in (self.pair_keys // self.span, self.pair_keys % self.span):
            inside = part < self.size
            early = self.pair_rank[inside] <= rank[part[inside]]
            long = np.array([len(pieces[p].piece) > 1 for p in part[inside]])
            self.eager[part[inside][early & long]] = True

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, merged piece) of pairs of symbols; rank ``_NONE`` where they do not merge."""
        keys = left * self.span + right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        hit = self.pair_keys[at] == keys
        return np.where(hit, self.pair_rank[at], _NONE).astype(np.int32), self.pair_into[at]

    def merge(self, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge rounds over flat symbols, ``word`` numbering their words in ascending order. Returns
        the final symbols and their words, in order within each word."""
        done: list[tuple[np.ndarray, np.ndarray]] = []
        rank = np.full(len(symbols), _NONE, np.int32)  # of the pair that starts here
        into = np.zeros(len(symbols), np.int32)
        fresh = np.flatnonzero(word[:-1] == word[1:])
        rank[fresh], into[fresh] = self._pairs(symbols[fresh], symbols[fresh + 1])
        while len(symbols):
            starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            lengths = np.diff(np.append(starts, len(word)))
            least = np.minimum.reduceat(rank, starts)
            if (least == _NONE).any():
                over = np.repeat(least == _NONE, lengths)
                done.append((symbols[over], word[over]))
                symbols, word, rank, into = symbols[~over], word[~over], rank[~over], into[~over]
                least, lengths = least[least != _NONE], lengths[least != _NONE]
                if not len(symbols):
                    break
            at = np.flatnonzero(rank == np.repeat(least, lengths))
            number = np.arange(len(at))
            gap = np.concatenate([[True], at[1:] != at[:-1] + 1])
            pick = (number - np.maximum.accumulate(np.where(gap, number, 0))) % 2 == 0
            first = np.concatenate([[True], word[at[1:]] != word[at[:-1]]])
            heads = np.flatnonzero(first)
            single = np.logical_or.reduceat(self.eager[into[at]], heads)
            pick = np.where(np.repeat(single, np.diff(np.append(heads, len(at)))), first, pick)
            chosen = at[pick]
            symbols[chosen] = into[chosen]
            stay = np.ones(len(symbols), bool)
            stay[chosen + 1] = False
            changed = np.zeros(len(symbols), bool)
            changed[chosen] = True
            symbols, word, rank, into = symbols[stay], word[stay], rank[stay], into[stay]
            changed = changed[stay]
            changed[:-1] |= changed[1:]  # the pair before a merged symbol is new as well
            fresh = np.flatnonzero(changed)
            inner = fresh[fresh < len(symbols) - 1]
            inner = inner[word[inner] == word[inner + 1]]
            rank[fresh] = _NONE
            rank[inner], into[inner] = self._pairs(symbols[inner], symbols[inner + 1])
        if not done:
            return symbols, word
        symbols, word = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(word, kind="stable")
        return symbols[order], word[order]

    def learn(self, words: list[str]) -> None:
        """Store the ids of words, given without their first blank."""
        marked = [BLANK + w.replace(" ", BLANK) for w in words]
        points = np.frombuffer("".join(marked).encode("utf-32-le"), np.uint32).astype(np.int64)
        lengths = np.fromiter(map(len, marked), np.int64, len(marked))
        seen, place = np.unique(points, return_inverse=True)
        symbol = np.array([self.character.get(p, self.size + p) for p in seen.tolist()], np.int64)
        symbols, word = self.merge(symbol[place], np.repeat(np.arange(len(marked)), lengths))
        ends = np.searchsorted(word, np.arange(len(marked) + 1))
        outside = symbols >= self.size
        odd = set(word[outside].tolist())
        flat = symbols.astype(np.int32)
        for k, (w, a, b) in enumerate(zip(words, ends[:-1].tolist(), ends[1:].tolist())):
            self.known[w] = self._with_bytes(symbols[a:b]) if k in odd else flat[a:b].tobytes()

    def _with_bytes(self, symbols: np.ndarray) -> bytes:
        ids: list[int] = []
        for s in symbols.tolist():
            ids += [s] if s < self.size else [self.byte_id[b] for b in chr(s - self.size).encode()]
        return np.array(ids, np.int32).tobytes()

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of every text."""
        group: list[list[str]] = []
        size = 0
        for text in texts:
            text = text.replace(BLANK, " ")
            if not text:
                words = []
            elif text[0] == " " or "  " in text:
                words = [run[1:] for run in _RUNS.findall(" " + text)]
            else:
                words = text.split(" ")
            group.append(words)
            size += len(text)
            if size > GROUP_CHARACTERS:
                yield from self._encode_group(group)
                group, size = [], 0
        yield from self._encode_group(group)

    def _encode_group(self, group: list[list[str]]) -> Iterator[np.ndarray]:
        needed = set().union(*group)
        fresh = needed.difference(self.known)
        if len(self.known) + len(fresh) > CACHE_WORDS:
            self.known.clear()
            fresh = needed
        if fresh:
            self.learn(list(fresh))
        for words in group:
            yield np.frombuffer(b"".join(map(self.known.__getitem__, words)), np.int32)

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids. The first visible piece loses its leading blank."""
        parts = list(map(self.shown.__getitem__, ids.tolist()))
        for k, i in enumerate(ids.tolist()):
            if not self.is_control[i]:
                if self.begins_blank[i]:
                    parts[k] = parts[k][1:]
                break
        data = b"".join(parts)
        try:
            return data.decode()
        except UnicodeDecodeError:
            return data.decode(errors="surrogateescape").translate(_BROKEN)


#: Every byte that belongs to no character is shown as the replacement character.
_BROKEN = dict.fromkeys(range(0xDC80, 0xDD00), "�")


@lru_cache(maxsize=2)
def model(path: str) -> PieceModel:
    return PieceModel(path)


def encode_column(texts: pa.Array, path: str) -> pa.Array:
    """Texts (null: empty) -> lists of ids."""
    parts = list(model(path).encode([t or "" for t in texts.to_pylist()]))
    offsets = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    flat = np.concatenate(parts) if parts else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def decode_column(ids: pa.Array, path: str) -> pa.Array:
    """Lists of ids -> texts."""
    flat, offsets, decode = ids.values.to_numpy(), ids.offsets.to_numpy(), model(path).decode
    return pa.array([decode(flat[a:b]) for a, b in zip(offsets[:-1], offsets[1:])], pa.string())


def round_trip(docs, path: str):
    """(doc_id, ids, decoded): every text's ids and the text these ids decode to."""

    def both(batches):
        for batch in bounded(batches):
            ids = encode_column(batch.column("text"), path)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), ids, decode_column(ids, path)], names=["doc_id", "ids", "decoded"])

    key = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(both, f"doc_id {key}, ids array<int>, decoded string")
