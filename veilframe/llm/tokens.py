"""Token ids of many texts, by a tokenizer whose pieces never cross white space.

Each distinct part of a word is tokenised once; texts are put together from their parts' ids. Words are cut at ASCII white space only, which the tokenizer drops. The tokenizer must
close each part of a word with a token that ends in </w>.
"""

from __future__ import annotations

import numpy as np

from veilframe.llm.words import Texts, Words

#: Words that are remembered; beyond, the memory is begun anew.
REMEMBERED = 600_000
#: Words that are given to the tokenizer at once.
TOGETHER = 8_000


class WordTokenizer:
    def __init__(self, path: str, end_id: int) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        #: Whether a token ends a part of a word: the tokenizer cuts words where letters, single digits and other characters meet.
        self.closing = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.closing[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith("</w>")]] = True
        self.end_id = end_id
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.place = np.zeros(0, np.int64)
        self.first = np.array([0], np.int64)  # word 0 is the end of a document
        self.size = np.array([1], np.int64)
        self.ids = np.array([self.end_id], np.uint32)

    def _alone(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words one after another, and how many each has."""
        ids = [self.tokenizer.encode(w, add_special_tokens=False).ids for w in words]
        return np.array([x for own in ids for x in own], np.uint32), np.array([len(x) for x in ids], np.int64)

    def _together(self, parts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """The same for parts of plain words, in one call: each ends where a token closes it."""
        spaced = np.full(len(parts.data) + len(parts), 32, np.uint8)
        spaced[np.arange(len(parts.data)) + np.repeat(np.arange(len(parts)), np.diff(parts.offsets))] = parts.data
        ids = np.array(self.tokenizer.encode(spaced.tobytes().decode(), add_special_tokens=False).ids, np.uint32)
        return ids, np.diff(np.concatenate([[0], np.flatnonzero(self.closing[ids]) + 1]))

    @staticmethod
    def _split(texts: Texts, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and end of the parts of all words, and whether each is of a plain word. A word that is not is one part.

        Plain words hold printable ASCII but the apostrophe, and letters from U+00C0 to U+00FF. The
        tokenizer cuts those where letters, single digits and other characters meet.
        """
        data = texts.data
        before = np.concatenate([np.zeros(1, np.uint8), data[:-1]])
        letter = (data >= 128) & (data < 192) & (before == 0xC3) & (data != 0x97) & (data != 0xB7)
        fine = ((data > 32) & (data < 127) & (data != 39) & ~((data == 124) & (before == 60))) | (data == 0xC3) | letter
        odd = np.concatenate([[0], np.cumsum(~fine)])
        plain = odd[words.start] == odd[words.end]
        small = data | 32
        kind = np.where((data >= 48) & (data <= 57), np.uint8(2), np.where((small >= 97) & (small <= 122) | (data >= 128), np.uint8(1), np.uint8(3)))
        begins = np.ones(len(data), bool)
        begins[1:] = (kind[1:] == 2) | (kind[1:] != kind[:-1])
        inside = np.zeros(len(data) + 1, np.int8)  # words may touch only where a text ends
        inside[words.start[plain]] += 1
        inside[words.end[plain]] -= 1
        begins &= np.cumsum(inside[:-1], dtype=np.int8) > 0
        begins[words.start] = True
        start = np.flatnonzero(begins)
        of = np.searchsorted(words.start, start, "right") - 1
        return start, np.minimum(np.concatenate([start[1:], [len(data)]]), words.end[of]) if len(start) else start, plain[of]

    def _learn(self, texts: Texts, keys: np.ndarray, start: np.ndarray, end: np.ndarray, plain: np.ndarray) -> None:
        data, parts = texts.data.tobytes(), []
        parts.append(self._alone([data[a:b].decode("utf-8", "replace") for a, b in zip(start[~plain].tolist(), end[~plain].tolist(), strict=True)]))
        start, end = start[plain], end[plain]
        for k in range(0, len(start), TOGETHER):
            a, b = start[k : k + TOGETHER], end[k : k + TOGETHER]
            at = np.concatenate([[0], np.cumsum(b - a)])
            parts.append(self._together(Texts(texts.data[np.repeat(a - at[:-1], b - a) + np.arange(at[-1])], at)))
        size = np.concatenate([x[1] for x in parts])
        place = np.arange(len(size)) + len(self.size)
        self.first = np.concatenate([self.first, len(self.ids) + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        self.ids = np.concatenate([self.ids, *(x[0] for x in parts)])
        keys = np.concatenate([keys[~plain], keys[plain]])
        order = np.argsort(keys)
        where = np.searchsorted(self.keys, keys[order])
        self.keys, self.place = np.insert(self.keys, where, keys[order]), np.insert(self.place, where, place[order])

    def encode(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each with the end id, and where each text's begin."""
        words = Words(texts)
        start, end, plain = self._split(texts, words)
        begin = np.searchsorted(start, texts.offsets)
        keys, at, back = np.unique(words.span_hash(start, end), return_index=True, return_inverse=True)
        if len(self.keys) > REMEMBERED:
            self._forget()
        found = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        inside = found < len(self.keys)
        known[inside] = self.keys[found[inside]] == keys[inside]
        if not known.all():
            new = at[~known]
            self._learn(texts, keys[~known], start[new], end[new], plain[new])
            found = np.searchsorted(self.keys, keys)
        place = np.insert(self.place[found][back], begin[1:], 0)
        size = self.size[place]
        ends = np.cumsum(size)
        ids = self.ids[np.repeat(self.first[place] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)]
        last = begin[1:] + np.arange(len(texts))  # each text's end mark
        return ids, np.concatenate([[0], ends[last]])
