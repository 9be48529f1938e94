"""Token ids of whole texts by the public byte-level BPE tokenizer, with a memo of their parts.

The tokenizer cuts a text into pieces and encodes each piece by itself, so a text can be cut wherever no piece can
reach over the cut: before a space behind a character that is no white space, around a single line feed, and
between letters and the signs behind them. Its ids are the ids of these parts in a row. Parts repeat: a batch is
cut and its distinct parts are found in Arrow and numpy, each worker keeps the parts it has seen (two generations
of bounded size) and asks the library only for new ones.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa

TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
GENERATION = 500_000  # parts in a generation of the memo; two generations take about 170 MB
LONG_PART = 48
GROUP_BYTES = 4 << 20  # of text cut together; some 20 times as much memory

SPACE = re.compile(r"\s")
LETTERS = re.compile(r" ?[A-Za-zÀ-ÖØ-öø-ÿ]+")


def _table(*codes: int) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(codes)] = True
    return table


WHITE = _table(*range(0x09, 0x0E), *range(0x1C, 0x21))
LETTER = _table(*range(0x41, 0x5B), *range(0x61, 0x7B))
# An apostrophe can begin a piece with letters.
SIGN = _table(*range(0x21, 0x27), *range(0x28, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x5F), *range(0x7B, 0x7F))
# First, middle and last bytes of white space beyond ASCII: a character made of such bytes may be white space.
LEAD, MIDDLE, LAST = (
    _table(0xC2, 0xE1, 0xE2, 0xE3),
    _table(0x80, 0x81, 0x9A, 0xA0),
    _table(*range(0x80, 0x8B), 0x8E, 0x9F, 0xA0, 0xA8, 0xA9, 0xAF),
)


def _byte_alphabet() -> dict[int, str]:
    """The character that stands for each byte in the tokenizer's vocabulary.

    Fixed values: printable bytes stand for themselves, the others get the characters from 256 on.
    """
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) if b in printable else chr(256 + others.index(b)) for b in range(256)}


def cuts(data: np.ndarray) -> np.ndarray:
    """Marks the bytes of UTF-8 text before which it may be cut."""
    near = np.zeros(len(data) + 4, dtype=np.uint8)  # byte i of the data is byte i + 3 here
    near[3:-1] = data
    white = WHITE[near]
    marked = np.zeros(len(data) + 1, dtype=bool)

    def behind_black(at: np.ndarray) -> np.ndarray:
        """Those that follow a character which is surely no white space."""
        at = at[~white[at + 2]]
        last, middle, lead = near[at + 2], near[at + 1], near[at]
        return at[~(LAST[last] & ((middle == 0xC2) | MIDDLE[middle] & LEAD[lead]))]

    marked[behind_black(np.flatnonzero(data == 0x20))] = True
    feeds = behind_black(np.flatnonzero(data == 0x0A))
    feeds = feeds[~(white | LEAD[near])[feeds + 4]]
    marked[feeds] = marked[feeds + 1] = True
    signs = np.flatnonzero(SIGN[data])
    last, lead = near[signs + 2], near[signs + 1]
    marked[signs[LETTER[last] | (lead == 0xC3) & (last >= 0x80) & (last != 0x97) & (last != 0xB7)]] = True
    return marked[:-1]


class Encoder:
    """Encodes texts to little-endian unsigned 32-bit ids."""

    def __init__(self, path: str | None = None) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path or public_tokenizers.path(TOKENIZER))
        self.model = self.library.model
        self.special = [t.content.encode() for t in self.library.get_added_tokens_decoder().values()]
        self.line_feed = self.library.encode("\n", add_special_tokens=False).ids[0]
        self.vocabulary = self.library.get_vocab_size()
        self.spelled = {**_byte_alphabet(), 0x0A: "\n"}
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def _whole(self, texts: list[str]) -> list[bytes]:
        encoded = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in encoded]

    def _joined(self, parts: list[str]) -> list[bytes]:
        """Ids of parts without white space but for a space in front.

        They go in one text, a line feed between them: it is a token of its own there, so it shows where a part
        ends. One long text costs the library half of many short ones.
        """
        if not parts:
            return []
        ids = np.frombuffer(self._whole(["\n".join(parts)])[0], dtype="<u4")
        ends = np.flatnonzero(ids == self.line_feed)
        if len(ends) != len(parts) - 1:
            return self._whole(parts)
        raw, bounds = ids.tobytes(), [-1, *ends.tolist(), len(ids)]
        return [raw[4 * a + 4 : 4 * b] for a, b in zip(bounds, bounds[1:])]

    def _words(self, words: list[bytes]) -> list[bytes]:
        """Ids of letters, with or without a space in front: one piece, which the library's model takes as it is."""
        spelled = b"\n".join(words).decode("latin-1").translate(self.spelled).split("\n")
        return [array("I", [t.id for t in tokens]).tobytes() for tokens in map(self.model.tokenize, spelled)]

    def _learn(self, new: list[bytes]) -> dict[bytes, bytes]:
        """Ids of parts that the memo does not hold."""
        words, plain, others = [], [], []
        for part, text in zip(new, map(bytes.decode, new)):
            if LETTERS.fullmatch(text):
                words.append(part)
            elif len(text) > 1 and not SPACE.search(text, 1) and not any(s in part for s in self.special):
                plain.append(part)
            else:
                others.append(part)
        ids = dict(zip(words, self._words(words))) if words else {}
        ids.update(zip(plain, self._joined([p.decode() for p in plain])))
        if others:
            ids.update(zip(others, self._whole([p.decode() for p in others])))
        return ids

    def _ids(self, parts: list[bytes]) -> list[bytes]:
        """Ids of distinct parts; all but long ones are in the younger generation afterwards."""
        ids = list(map(self.young.get, parts))
        missing = [i for i, found in enumerate(ids) if found is None]
        again = [(i, self.old.get(parts[i])) for i in missing]
        learnt = self._learn([parts[i] for i, found in again if found is None])
        for i, found in again:
            part = parts[i]
            ids[i] = learnt[part] if found is None else found
            if len(part) <= LONG_PART:
                self.young[part] = ids[i]
        if len(self.young) > GENERATION:  # parts in use come back from the older generation
            self.old, self.young = self.young, {}
        return ids

    def _group(self, data: np.ndarray, bounds: np.ndarray) -> Iterator[bytes]:
        """Ids of the texts between the bounds of the data."""
        if not len(data):
            yield from [b""] * (len(bounds) - 1)
            return
        marked, raw = cuts(data), data.tobytes()
        for special in self.special:  # such texts go to the library whole
            at = raw.find(special)
            while at >= 0:
                text = np.searchsorted(bounds, at, side="right")
                marked[bounds[text - 1] : bounds[text]] = False
                at = raw.find(special, int(bounds[text]))
        marked[bounds[:-1][bounds[:-1] < len(data)]] = True
        starts = np.flatnonzero(marked)
        offsets = np.append(starts, len(data))
        parts = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(raw)])
        coded = parts.dictionary_encode()
        ids, which = self._ids(coded.dictionary.to_numpy(zero_copy_only=False).tolist()), coded.indices.to_numpy()
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        firsts = np.cumsum(sizes) - sizes
        each = sizes[which]
        ends = np.cumsum(each)
        places = np.repeat(firsts[which] - (ends - each), each) + np.arange(ends[-1])
        out = np.frombuffer(b"".join(ids), "<u4")[places].tobytes()
        until = 4 * np.concatenate([[0], ends])[np.searchsorted(starts, bounds)]
        yield from (out[a:b] for a, b in zip(until.tolist(), until[1:].tolist()))

    def encode(self, texts: list[str | None] | pa.Array) -> Iterator[bytes]:
        """Ids of each text in order, as bytes; a null text is empty."""
        column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        column = column.cast(pa.large_string()).fill_null("")
        if not len(column):
            return
        _, offsets, data = column.buffers()
        bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
        data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
        at = 0
        while at < len(column):
            to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + GROUP_BYTES, side="right")) - 1)
            yield from self._group(data[bounds[at] : bounds[to]], bounds[at : to + 1] - bounds[at])
            at = to


_ENCODERS: dict[str | None, Encoder] = {}


def encoder(path: str | None = None) -> Encoder:
    """One encoder for each tokenizer file and worker process."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
