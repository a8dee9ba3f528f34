"""Token ids of whole texts by a byte-level BPE of the tokenizers library.

The vocabulary's pre-tokenizer always begins anew at a single blank or line feed between two
other characters, after such a line feed, and at a sign after a letter. So a text is a sequence
of units that begin there, and its ids are those of its units. A token added to the vocabulary,
such as <|endoftext|>, is a unit wherever a text holds it, and the text begins anew after it.
Arrow finds the distinct units of a block of texts; the library encodes those that the worker
hasn't met lately.
"""

import re
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tillmart.llm.blocks import text_buffers

MOST_UNITS = 250_000
BLOCK_BYTES = 4 * 1024 * 1024

BLANK, LETTER, SIGN = 1, 2, 3
_KIND = np.zeros(256, np.uint8)
_KIND[33:127] = SIGN
_KIND[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = BLANK
_KIND[48:58] = 0
_KIND[[*range(65, 91), *range(97, 123)]] = LETTER


def _letters_for_bytes() -> list[str]:
    """Byte-level vocabularies write each byte as a letter: itself if it can be seen, else one from 256 on."""
    seen = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in seen]
    return [chr(b) if b in seen else chr(256 + hidden.index(b)) for b in range(256)]


_AS_LETTER = _letters_for_bytes()
# Blanks outside ASCII: texts with them aren't cut.
_OTHER_BLANKS = "[\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"


def gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of the ranges start .. start + length, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


class Encoder:
    """Encodes blocks of texts. ``path``: a vocabulary file of the tokenizers library."""

    def __init__(self, path: str, most_units: int = MOST_UNITS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.most_units = most_units
        added = [t for t in self.tokenizer.get_added_tokens_decoder().values() if t.content]
        # The library takes the leftmost, of several there the longest; one that also takes what stands around it has its text left whole.
        names = sorted((t.content.encode() for t in added), key=len, reverse=True)
        self.added = re.compile(b"|".join(map(re.escape, names))) if names else None
        self.added_text = [name.decode() for name in names]
        self.alone = not any(t.lstrip or t.rstrip or t.single_word for t in added)
        self.forget()

    def forget(self):
        """Leave the units behind; the end of a task is a good time."""
        self.rows, self.pool, self.filled = {}, np.zeros(1 << 16, np.uint32), 0
        self.starts, self.lengths = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)

    def _add(self, units: list[str], ids: list[int], lengths: list[int]):
        row, n = len(self.rows), len(units)
        for name, size in (("starts", row + n), ("lengths", row + n), ("pool", self.filled + len(ids))):
            array = getattr(self, name)
            if size > len(array):
                setattr(self, name, np.concatenate([array, np.zeros(max(size, 2 * len(array)) - len(array), array.dtype)]))
        self.pool[self.filled:self.filled + len(ids)] = ids
        self.starts[row:row + n] = self.filled + np.cumsum(lengths) - lengths
        self.lengths[row:row + n] = lengths
        self.filled += len(ids)
        self.rows.update(zip(units, range(row, row + n)))

    def _learn(self, units: list[str]):
        """A word with or without a blank before it is one pre-token and goes straight to the model."""
        tokenize, rest, ids, known, lengths = self.tokenizer.model.tokenize, [], [], [], []
        for unit in units:
            blank = unit[0] == " "
            word = unit[1:] if blank else unit
            plain = word.isalpha() and not any(name in unit for name in self.added_text)
            if plain and (word.isascii() or max(word) < "\u0250"):
                word = word if word.isascii() else "".join(map(_AS_LETTER.__getitem__, word.encode()))
                found = tokenize(_AS_LETTER[32] + word if blank else word)
                known.append(unit)
                lengths.append(len(found))
                ids += [token.id for token in found]
            else:
                rest.append(unit)
        if known:
            self._add(known, ids, lengths)
        for i in range(0, len(rest), 1000):
            part = rest[i:i + 1000]
            found = [x.ids for x in self.tokenizer.encode_batch_fast(part, add_special_tokens=False)]
            self._add(part, [i for ids in found for i in ids], [len(ids) for ids in found])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and where each text's begin (one more at the end)."""
        bounds, data = text_buffers(texts)
        raw = np.frombuffer(data, np.uint8)
        if not len(raw):
            return np.zeros(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
        cut = self._cuts(raw, bounds, texts)
        offsets = np.append(np.flatnonzero(cut), len(raw))
        units = pa.Array.from_buffers(
            pa.large_string(), len(offsets) - 1, [None, pa.py_buffer(offsets), data]
        ).dictionary_encode()
        names = units.dictionary.to_pylist()
        found = np.fromiter(map(self.rows.get, names, repeat(-1)), np.int64, len(names))
        new = [names[i] for i in np.flatnonzero(found < 0)]
        if len(self.rows) + len(new) > self.most_units:
            self.forget()
            new = names
        if new:
            self._learn(new)
            found = np.fromiter(map(self.rows.__getitem__, names), np.int64, len(names))
        rows = found[units.indices.to_numpy()]
        lengths = self.lengths[rows]
        ids = self.pool[gather(self.starts[rows], lengths)]
        before = np.concatenate([[0], np.cumsum(lengths)])
        return ids, before[np.searchsorted(offsets, bounds)]

    def _added(self, raw: np.ndarray, bounds: np.ndarray, texts: pa.Array) -> list[tuple[int, int, list]]:
        """(begin, end, spans) of each text with added tokens: where it and they are."""
        if self.added is None:
            return []
        held = np.zeros(len(texts), bool)
        for name in self.added_text:
            held |= pc.fill_null(pc.match_substring(texts, name), False).to_numpy(zero_copy_only=False)
        out = []
        for i in np.flatnonzero(held):
            a, b = int(bounds[i]), int(bounds[i + 1])
            out.append((a, b, [(a + m.start(), a + m.end()) for m in self.added.finditer(raw[a:b].tobytes())]))
        return out

    def _cuts(self, raw: np.ndarray, bounds: np.ndarray, texts: pa.Array) -> np.ndarray:
        """Where units begin."""
        kind = _KIND[raw]
        # The second byte of a letter that Latin-1 has.
        accent = np.zeros(len(raw), bool)
        accent[1:] = (raw[:-1] == 0xC3) & (raw[1:] != 0x97) & (raw[1:] != 0xB7)
        blank, letter = kind == BLANK, (kind == LETTER) | accent
        cut = np.zeros(len(raw), bool)
        lone = np.zeros(len(raw), bool)
        lone[1:-1] = blank[1:-1] & ~blank[:-2] & ~blank[2:]
        added = self._added(raw, bounds, texts)
        edges = [x for _, _, spans in added for span in spans for x in span] if self.alone else []
        fence = np.union1d(bounds, np.array(edges, bounds.dtype))
        fence = fence[(fence > 0) & (fence < len(raw))]
        lone[fence] = lone[fence - 1] = False
        feed = raw == 10
        cut |= lone & (feed | (raw == 32))
        cut[1:] |= (lone & feed)[:-1]
        cut[1:] |= letter[:-1] & (kind[1:] == SIGN)
        odd = pc.fill_null(pc.match_substring_regex(texts.cast(pa.large_string()), _OTHER_BLANKS), False)
        for i in np.flatnonzero(odd.to_numpy(zero_copy_only=False)):
            cut[bounds[i]:bounds[i + 1]] = False
        for a, b, spans in added:
            for begin, end in spans if self.alone else [(a, b)]:
                cut[begin:end] = False
        cut[fence] = True
        cut[0] = True
        return cut


_encoders = {}


def encoder(path: str) -> Encoder:
    """One per worker and vocabulary, kept from task to task."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def crc_of(ids: np.ndarray) -> int:
    """Unsigned crc32 of ids as little-endian unsigned 32-bit integers."""
    import zlib

    return zlib.crc32(np.ascontiguousarray(ids, "<u4"))
