"""Token ids of texts by two kinds of vocabulary, and the bytes that each token stands for.

Every text is taken with a blank before it. Strings of special tokens inside a text are plain text.
"""

import re
from itertools import chain

import numpy as np
import pyarrow as pa

from tillmart.llm.blocks import text_buffers
from tillmart.llm.token_ids import _AS_LETTER, MOST_UNITS, Encoder

_SPACE = "▁"


def taken(strings: pa.Array, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the chosen strings one after the other, and where each ends."""
    out = strings.take(pa.array(at))
    ends = np.frombuffer(out.buffers()[1], np.int64, len(out) + 1) if len(out) else np.zeros(1, np.int64)
    data = out.buffers()[2] if ends[-1] else b""
    return np.frombuffer(data, np.uint8, int(ends[-1])), ends[1:]


class _Spelled:
    """A vocabulary whose tokens' bytes are known. ``pieces``: of each id."""

    def _know(self, pieces: list[bytes]):
        self.pieces = pa.array(pieces, pa.large_binary())
        self.sizes = np.array([len(p) for p in pieces], np.int64)

    def encode_checked(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """ids, where each text's begin (one more at the end), and whether its tokens' bytes are the text's."""
        ids, before = self.encode(texts)
        bounds, data = text_buffers(texts)
        raw, (own, ends) = np.frombuffer(data, np.uint8), taken(self.pieces, ids)
        same = np.ones(len(texts), bool)
        if not np.array_equal(raw, own):
            ends = np.concatenate([[0], ends])[before]
            for i in range(len(texts)):
                same[i] = np.array_equal(raw[bounds[i]:bounds[i + 1]], own[ends[i]:ends[i + 1]])
        return ids, before, same


class PlainEncoder(_Spelled, Encoder):
    """A byte-level BPE of the tokenizers library whose special tokens are never taken from a text."""

    def __init__(self, path: str, most_units: int = MOST_UNITS):
        super().__init__(path, most_units)
        self.tokenizer.encode_special_tokens = True
        added = {i: t for i, t in self.tokenizer.get_added_tokens_decoder().items() if t.content}
        plain = [t for t in added.values() if not t.special]
        names = sorted((t.content.encode() for t in plain), key=len, reverse=True)
        self.added = re.compile(b"|".join(map(re.escape, names))) if names else None
        self.added_text = [name.decode() for name in names]
        self.alone = not any(t.lstrip or t.rstrip or t.single_word for t in plain)
        byte = {letter: b for b, letter in enumerate(_AS_LETTER)}
        tokens = [self.tokenizer.id_to_token(i) or "" for i in range(self.tokenizer.get_vocab_size())]
        self._know([
            added[i].content.encode() if i in added else bytes(map(byte.__getitem__, token)) for i, token in enumerate(tokens)
        ])


class PieceEncoder(_Spelled):
    """A BPE of the sentencepiece library that puts a blank before a text.

    ``cuts``: no piece goes on with a blank after another character, so no merge crosses the place
    before a blank that follows one, and a text's parts that begin there have the text's ids.
    """

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.tokenizer = SentencePieceProcessor(model_file=path)
        ids = range(self.tokenizer.vocab_size())
        names = [self.tokenizer.id_to_piece(i) for i in ids]
        as_byte = [self.tokenizer.is_byte(i) for i in ids]
        self.cuts = not any(re.search(f"[^{_SPACE}]{_SPACE}", n) for n, b in zip(names, as_byte) if not b)
        self._know([
            bytes([int(n[3:5], 16)]) if b else n.replace(_SPACE, " ").encode() for n, b in zip(names, as_byte)
        ])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The library adds the blank that each text begins with."""
        found = self.tokenizer.encode([text[1:] for text in texts.to_pylist()], num_threads=1)
        before = np.concatenate([[0], np.cumsum([len(ids) for ids in found], dtype=np.int64)])
        return np.fromiter(chain.from_iterable(found), np.uint32, int(before[-1])), before

    def forget(self):
        """Nothing is remembered."""


_encoders = {}


def plain_encoder(kind, path: str):
    """One per worker and vocabulary, kept from task to task."""
    if path not in _encoders:
        _encoders[path] = kind(path)
    return _encoders[path]
