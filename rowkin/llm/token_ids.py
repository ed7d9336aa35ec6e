"""Token ids of whole texts by a public tokenizer file (a parameter, read where it lies).

Where the vocabulary drops white space, lower-cases and marks word ends, a text's
ids are those of its space-separated parts in order. Parts repeat far more
often than texts, so each worker keeps a bounded table from the hash of a part
to its ids, and a block of texts is encoded by gathering from that table. Whether a
file is of this kind is probed when it is loaded; texts of any other one are
encoded whole.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa

from rowkin.llm.common import BYTE_VALUES, KEPT, LOWER_VALUES, SlotTable, prefix_sums, span_hash, text_blocks

#: Slots of a worker's table (16 bytes each) and ids that it holds at most (4 bytes each).
SLOT_BITS, POOL_IDS = 21, 10_000_000

BREAK = np.zeros(256, bool)
BREAK[[0x20, 0x0A]] = True
LETTER = np.zeros(256, bool)
LETTER[[*range(65, 91), *range(97, 123)]] = True
STOP = np.zeros(256, bool)
STOP[[0x2C, 0x2E]] = True
#: Bytes of parts whose case matters: special tokens, and letters that may join a combining mark.
CASED = np.zeros(256, bool)
CASED[0x3C] = True
CASED[0xC4:] = True


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _parts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans between spaces and line ends; a last stop or comma after a letter is a part of its own."""
    n = len(data)
    inside = ~BREAK[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before, after = edge[:-1].copy(), edge[1:].copy()
    before[1:] |= ~inside[:-1]
    after[:-1] |= ~inside[1:]
    tail = STOP[data] & after & ~before
    tail[1:] &= LETTER[data[:-1]]
    before |= tail
    after[:-1] |= tail[1:]
    start = np.flatnonzero(inside & before)
    return start, np.flatnonzero(inside & after) + 1, np.searchsorted(start, offsets)


#: Texts on which the table of parts and the tokenizer itself must agree.
PROBES = ("The cat, sat. It's 3.14 o'clock", "A  B\n\nc", "don't I'M x.y,z. (Word) word", "\u00c9t\u00e9 \u65e5\u672c\u8a9e 42nd", "..., a. b, tailing. ", "UPPER lower MiXed.", "")


def _joined(texts: tuple[str, ...]) -> tuple[np.ndarray, np.ndarray]:
    raw = [x.encode() for x in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])


class BlockEncoder:
    """Encodes blocks of texts; its table starts anew when its ids fill the pool."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self._forget()
        self.parts = bool(self.ends.any()) and self._agrees()
        self._forget()

    def _agrees(self) -> bool:
        data, offsets = _joined(PROBES)
        try:
            ids, first = self._by_parts(data, offsets)
        except RuntimeError:
            return False
        return all(ids[a:b].tolist() == self.tokenizer.encode(x, add_special_tokens=False).ids for x, a, b in zip(PROBES, first[:-1].tolist(), first[1:].tolist(), strict=True))

    def _forget(self) -> None:
        self.table = SlotTable(SLOT_BITS)  # first id * 2**20 + number of ids
        self.pool = np.zeros(1 << 20, "<u4")
        self.used = 0

    def _append(self, ids: np.ndarray) -> int:
        at = self.used
        if at + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(max(len(self.pool), len(ids)), "<u4")])
        self.pool[at : at + len(ids)] = ids
        self.used += len(ids)
        return at

    def _ids(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the parts in a row and each part's number of ids.

        Letters-only parts are one piece each, whose last id ends a word: many are encoded as one text.
        """
        simple = np.fromiter((x.isalpha() and max(x) < "\u0100" for x in parts), bool, len(parts))
        words = [x for x, s in zip(parts, simple, strict=True) if s]
        texts = [" ".join(words[i : i + 64]) for i in range(0, len(words), 64)] + [x for x, s in zip(parts, simple, strict=True) if not s]
        lists = [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        n_texts = -(-len(words) // 64)
        joined = np.fromiter(chain.from_iterable(lists[:n_texts]), "<u4")
        others = lists[n_texts:]
        stops = np.flatnonzero(self.ends[joined]) + 1
        if len(stops) != len(words):
            raise RuntimeError("a letters-only part was not one piece")
        sizes = np.zeros(len(parts), np.int64)
        sizes[simple] = np.diff(stops, prepend=0)
        sizes[~simple] = np.fromiter(map(len, others), np.int64, len(others))
        out = np.zeros(int(sizes.sum()), "<u4")
        mask = np.repeat(simple, sizes)
        out[mask] = joined
        out[~mask] = np.fromiter(chain.from_iterable(others), "<u4")
        return out, sizes

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a block and each text's first one (one entry more than texts)."""
        if not len(data):
            return np.zeros(0, "<u4"), np.zeros(len(offsets), np.int64)
        return self._by_parts(data, offsets) if self.parts else self._whole(data, offsets)

    def _whole(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        raw = data.tobytes()
        lists = [x.ids for x in self.tokenizer.encode_batch_fast([raw[a:b].decode() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)], add_special_tokens=False)]
        return np.fromiter(chain.from_iterable(lists), "<u4"), np.concatenate([[0], np.cumsum([len(x) for x in lists])])

    def _by_parts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if self.used > POOL_IDS:
            self._forget()
        start, end, first = _parts(data, offsets)
        hashes = span_hash(prefix_sums(data, LOWER_VALUES), start, end)
        cased = np.zeros(len(data) + 1, np.int32)
        np.cumsum(CASED[data], out=cased[1:])
        cased = cased[end] > cased[start]
        if cased.any():
            hashes[cased] = ~span_hash(prefix_sums(data, BYTE_VALUES), start[cased], end[cased])
        place, new = self.table.find(hashes)
        size = place & ((1 << 20) - 1)
        if len(new):
            known, where, back = np.unique(hashes[new], return_index=True, return_inverse=True)
            where = new[where]
            raw = data.tobytes()
            parts = [raw[a:b].decode() for a, b in zip(start[where].tolist(), end[where].tolist(), strict=True)]
            ids, sizes = self._ids(parts)
            begin = (self._append(ids) + np.cumsum(sizes) - sizes) << 20
            short = sizes < 1 << 20
            self.table.store(known[short], (begin + sizes)[short])
            place[new], size[new] = begin[back], sizes[back]
        begin = place >> 20
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.pool[np.repeat(begin - ends + size, size) + np.arange(total)]
        return ids, np.concatenate([[0], ends])[first]


def largest_id(path: str) -> int:
    from tokenizers import Tokenizer

    return max(Tokenizer.from_file(path).get_vocab(with_added_tokens=True).values())


_encoders: dict[str, BlockEncoder] = {}
KEPT["tokens"] = _encoders.clear


def encoder(path: str) -> BlockEncoder:
    """One table a worker process, kept from task to task."""
    if path not in _encoders:
        _encoders[path] = BlockEncoder(path)
    return _encoders[path]


def encoded(batches: Iterator[pa.RecordBatch], path: str, text: int = 1) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, ids, each row's first id) of whole texts."""
    coder = encoder(path)
    for batch in batches:
        for lo, hi, data, offsets in text_blocks(batch.column(text)):
            yield batch.slice(lo, hi - lo), *coder.encode(data, offsets)
