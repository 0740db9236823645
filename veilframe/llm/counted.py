"""Two Kneser-Ney models counted over every labelled row, and the sums that score texts by them, as shuffled tables.

The models are those of toxicity.KneserNey.fit() over the same texts, held as weights: a text's log-ratio is that of
its words' spelling, which a small table tells, plus a weight for each word and for each pair that the models have.
Pairs and words are dealt over blocks by hash; tasks exchange sorted arrays, pickled, in place of rows. What the
driver and every executor get is bounded: byte n-grams, the HOT_KEYS commonest weights, and a filter of FILTER_BITS bits
that tells most keys without a weight. Weights of other keys are looked up in their block, to which tasks send the keys.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilframe.llm.shared import materialise, passing, small_batches
from veilframe.llm.toxicity import _BEGIN, BASE, DISCOUNT, EVIDENCE, ORDER, KneserNey, Spelling, _before, _find, _fit_spelling, _pair, _sums
from veilframe.llm.words import Texts, Words, groups, lean, lean_table, mix

#: Labelled rows for each block of the tables, and blocks at least.
BLOCK_ROWS = 2_500
LEAST_BLOCKS = 16
#: Bytes of text that a task works on at once, and after which it hands on what it has counted: a worker's memory is small.
GROUP, COUNT_BYTES = 1 << 19, 2 << 20
#: Weights that every task gets; the others are looked up where they lie.
HOT_KEYS = 1 << 19
#: Bits for each key in the filter, and in all; with fewer bits more keys are looked up in vain.
BITS, FILTER_BITS = 12, 1 << 27
#: Sums are whole multiples of 1 / SCALE, so that they don't follow the order in which they are made.
SCALE = float(1 << 32)
COUNTED = "kind string, block int, blob binary"
SUMS = "text_hash long, n long, s0 long, s1 long, s2 long, s3 long"
_U = np.uint64
_WORD_KEY, _PROBE = _U(0x5851F42D4C957F2D), _U(0x14057B7EF767814F)


def _packed(rows: list[tuple[str, int, tuple]]) -> pa.RecordBatch:
    kinds, blocks, blobs = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), pa.array(blocks, pa.int32()), pa.array([pickle.dumps(x, 5) for x in blobs], pa.binary())], ["kind", "block", "blob"])


def _unpacked(table: pa.Table, kind: str) -> Iterator[tuple]:
    """The blobs of one kind, in an order that doesn't follow that of the rows."""
    found = sorted(b for k, b in zip(table.column("kind").to_pylist(), table.column("blob").to_pylist(), strict=True) if k == kind)
    return map(pickle.loads, found)


def _joined(blobs: Iterator[tuple], like: tuple) -> list[np.ndarray]:
    """The arrays of all blobs, each behind that of the one before; like tells the kinds of none."""
    columns = list(zip(*blobs, strict=True))
    return [np.concatenate(c) for c in columns] if columns else [np.zeros(0, t) for t in like]


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, Texts]]:
    """Groups of texts, and the numbers that come along in the first column."""
    for b in batches:
        numbers = b.column(0).to_numpy(zero_copy_only=False)
        for first, last, texts in groups(b.column(1), GROUP):
            yield numbers[first:last], texts


def _indexed(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values, and the place of each among them in few bytes."""
    own, of = np.unique(values, return_inverse=True)
    return own, of.astype(np.uint16 if len(own) <= 1 << 16 else np.uint32)


def _slices(block: np.ndarray, blocks: int) -> Iterator[tuple[int, np.ndarray]]:
    """The places of each block's rows, in their order."""
    order = np.argsort(block, kind="stable")
    at = np.searchsorted(block[order], np.arange(blocks + 1))
    for b in range(blocks):
        yield b, order[at[b] : at[b + 1]]


def _cut_bytes(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    first = np.cumsum(size) - size
    return data[np.arange(size.sum()) - np.repeat(first, size) + np.repeat(start, size)]


def _codes(s: Spelling) -> np.ndarray:
    """The longest n-gram that ends at each byte, as its bytes, the last lowest, and its length; of use behind the begin mark."""
    code = np.minimum(s.inner + 1, ORDER).astype(_U) << _U(8 * ORDER)
    for k in range(ORDER):
        at = np.flatnonzero(s.inner >= k)
        code[at] |= s.data[at - k] << _U(8 * k)
    return code


class _Grams:
    """The distinct n-grams of _codes(), each as the last byte of a Spelling with one word for it."""

    def __init__(self, codes: np.ndarray) -> None:
        self.bytes = [(codes >> _U(8 * k)) & _U(255) for k in range(ORDER)]
        length = (codes >> _U(8 * ORDER)).astype(np.int64)
        self.inner = np.where((length == ORDER) & (self.bytes[-1] != _BEGIN), ORDER, length - 1)
        self.word, self.size, self._hash = np.arange(len(codes)), np.ones(len(codes)), {}

    def _of(self, places: range) -> np.ndarray:
        h = np.zeros(len(self.word), _U)
        for k in places:
            h = h * _U(BASE) + self.bytes[k] + _U(3)
        return h

    def grams(self, n: int) -> np.ndarray:
        return self._of(range(n - 1, -1, -1))

    def history(self, n: int) -> np.ndarray:
        return self._of(range(n - 1, 0, -1))


@dataclass
class Spelt:
    """The byte models: what scoring looks up, the log-likelihoods of the distinct n-grams in both classes, and the totals of the word models."""

    grams: list
    ratio: list
    histories: list
    back: list
    codes: np.ndarray
    likely: np.ndarray
    total: np.ndarray
    left: np.ndarray
    first: float
    keys: int

    @property
    def unknown(self) -> float:
        return float(np.log(self.left[1]) - np.log(self.left[0]))

    def of(self, s: Spelling) -> np.ndarray:
        """Log-likelihoods of words that were counted, in either class."""
        own = s.inner >= 1
        each = self.likely[:, _find(self.codes, _codes(s)[own])]
        return np.stack([np.bincount(s.word[own], x, minlength=len(s.size)) for x in each])


def _count(blocks: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """label, text: the pairs, words and n-grams of a task's texts and how often either class has them, by the block of the earlier word, the word and the n-gram."""

    def cut(words: list[tuple], tokens: list[tuple]) -> Iterator[pa.RecordBatch]:
        types, size, data, *count = _distinct(words)
        words.clear()
        end = np.cumsum(size)
        s = Spelling(Texts(data, np.array([0])), end - size, end)
        own = s.inner >= 1
        codes, code_count, _ = _sums(_codes(s)[own], np.stack(count)[:, s.word[own]])
        del s, own
        x, y, toxic = _joined(iter(tokens), (_U, _U, np.uint8))
        tokens.clear()
        order = np.lexsort((y, x))
        x, y = x[order], y[order]
        first = np.flatnonzero(np.concatenate([[True], (x[1:] != x[:-1]) | (y[1:] != y[:-1])]))
        one = np.add.reduceat(toxic[order], first, dtype=np.int64)
        seen = np.diff(np.concatenate([first, [len(order)]]))
        x, y = x[first], y[first]
        del order, first, toxic
        for (b, p), (_, t), (_, g) in zip(_slices(x % _U(blocks), blocks), _slices(types % _U(blocks), blocks), _slices(codes % _U(blocks), blocks), strict=True):
            pairs = (*_indexed(x[p]), *_indexed(y[p]), (seen - one)[p].astype(np.uint32), one[p].astype(np.uint32))
            words_ = (types[t], size[t].astype(np.uint32), _cut_bytes(data, (end - size)[t], size[t]), *(c[t].astype(np.uint32) for c in count))
            yield _packed([("pairs", b, pairs), ("words", b, words_), ("grams", b, (codes[g], *code_count[:, g].astype(np.uint32)))])

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: list[tuple] = []
        tokens: list[tuple] = []
        held = 0
        for label, texts in _groups(batches):
            w = Words(texts)
            if not len(w.hash):
                continue
            toxic = np.repeat(label, np.diff(w.at)).astype(np.uint8)
            types, at, of = np.unique(w.hash, return_index=True, return_inverse=True)
            one = np.bincount(of, toxic, minlength=len(types)).astype(np.uint32)
            size = w.end[at] - w.start[at]
            words.append((types, size.astype(np.uint32), _cut_bytes(texts.data, w.start[at], size), np.bincount(of, minlength=len(types)).astype(np.uint32) - one, one))
            tokens.append((_before(w), w.hash, toxic))
            held += len(texts.data)
            if held >= COUNT_BYTES:
                yield from cut(words, tokens)
                held = 0
        if words:
            yield from cut(words, tokens)

    return run


def _distinct(words: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words of some tables of them: hashes, sizes, bytes and the counts of both classes."""
    hashes, sizes, data, *count = _joined(iter(words), (_U, np.uint32, np.uint8, np.uint32, np.uint32))
    sizes = sizes.astype(np.int64)
    types, at, of = np.unique(hashes, return_index=True, return_inverse=True)
    starts = np.cumsum(sizes) - sizes
    summed = np.stack([np.bincount(of, c, minlength=len(types)) for c in count])
    return types, sizes[at], _cut_bytes(data, starts[at], sizes[at]), *summed


def _add_up(blocks: int) -> Callable[[pa.Table], pa.Table]:
    """A block's counts of all tasks, and what the words' blocks need of its pairs."""

    @lean_table
    def run(table: pa.Table) -> pa.Table:
        b = table.column("block")[0].as_py()
        out = []
        codes, *count = _joined(_unpacked(table, "grams"), (_U, np.uint32, np.uint32))
        codes, count, _ = _sums(codes, np.stack(count))
        out.append(("grams", b, (codes, *count)))
        types, sizes, data, *count = _distinct(list(_unpacked(table, "words")))
        out.append(("words", b, (types, sizes.astype(np.uint32), data, *(c.astype(np.uint32) for c in count))))
        whole = ((first[of], second[at], *seen) for first, of, second, at, *seen in _unpacked(table, "pairs"))
        before, word, *seen = _joined(whole, (_U, _U, np.uint32, np.uint32))
        order = np.lexsort((word, before))
        before, word = before[order], word[order]
        first = np.flatnonzero(np.concatenate([[True], (before[1:] != before[:-1]) | (word[1:] != word[:-1])])) if len(order) else np.zeros(0, np.int64)
        seen = np.stack([np.add.reduceat(c[order].astype(np.int64), first) if len(first) else np.zeros(0, np.int64) for c in seen])
        before, word = before[first], word[first]
        firsts, of_first = np.unique(before, return_inverse=True)
        told = np.stack([np.bincount(of_first, x, minlength=len(firsts)) for x in seen])
        often = np.flatnonzero(seen.sum(0) > 1)
        share = np.maximum(seen[:, often] - DISCOUNT, 0) / np.maximum(told[:, of_first[often]], 1)
        rest = 1 - np.stack([np.bincount(of_first[often], x, minlength=len(firsts)) for x in share])
        back = (np.log(rest[1]) - np.log(rest[0])).astype(np.float32)
        out.append(("before", b, (firsts, back)))
        begin = float(back[0]) if len(firsts) and firsts[0] == 0 else 0.0
        out.append(("totals", b, (np.array([(x > 0).sum() for x in seen]), np.array([(c > 0).sum() for c in count]), begin, len(types) + len(often))))
        followed, of_word = np.unique(word, return_inverse=True)
        follows = np.stack([np.bincount(of_word, x > 0, minlength=len(followed)) for x in seen]).astype(np.uint32)
        for to, w in _slices(followed % _U(blocks), blocks):
            if len(w):
                out.append(("follows", to, (followed[w], *follows[:, w])))
        for to, p in _slices(word[often] % _U(blocks), blocks):
            if len(p):
                own, of = np.unique(of_first[often[p]], return_inverse=True)
                out.append(("often", to, (firsts[own], told[:, own].astype(np.uint32), rest[:, own], of.astype(np.uint32), word[often[p]], seen[:, often[p]].astype(np.uint32))))
        return pa.Table.from_batches([_packed(out)])

    return run


@lean
def _spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The byte models of the n-grams of all blocks, whose number follows the alphabets, not the texts."""
    table = pa.Table.from_batches(list(batches), pa.schema([("kind", pa.string()), ("block", pa.int32()), ("blob", pa.binary())]))
    codes, *count = _joined(_unpacked(table, "grams"), (_U, float, float))
    codes, count, _ = _sums(codes, np.stack(count))
    grams, ratio, histories, back, likely = _fit_spelling(_Grams(codes), count, DISCOUNT)
    totals = list(_unpacked(table, "totals"))
    total = np.maximum(sum((t[0] for t in totals), np.zeros(2, np.int64)), 1)
    left = 1 - (sum((t[0] for t in totals), np.zeros(2, np.int64)) - DISCOUNT * sum((t[1] for t in totals), np.zeros(2, np.int64))) / total
    yield _packed([("model", 0, (grams, ratio, histories, back, codes, likely, total, left, sum(t[2] for t in totals), sum(t[3] for t in totals)))])


def _probes(key: np.ndarray, block: np.ndarray, bits: int) -> list[np.ndarray]:
    """The bits of the filter, of bits for each block, that a key sets."""
    h = mix(key ^ _PROBE)
    return [(block.astype(_U) * _U(bits) + x % _U(bits)).astype(np.int64) for x in (h >> _U(32), h & _U(0xFFFFFFFF))]


def _weigh(held, bits: int) -> Callable[[pa.Table], pa.Table]:
    """A block's weights by key, with what a text's last word takes back; its part of the filter; and how many keys are how common."""

    @lean_table
    def run(table: pa.Table) -> pa.Table:
        b, spelt = table.column("block")[0].as_py(), Spelt(*held.value)
        types, sizes, data, *count = _distinct(list(_unpacked(table, "words")))
        end = np.cumsum(sizes)
        likely = spelt.of(Spelling(Texts(data, np.array([0])), end - sizes, end))
        word, *follows = _joined(_unpacked(table, "follows"), (_U, np.uint32, np.uint32))
        at = _find(types, word)
        follows = np.stack([np.bincount(at, x, minlength=len(types)) for x in follows])
        p = np.maximum(follows - DISCOUNT, 0) / spelt.total[:, None] + spelt.left[:, None] * np.exp(likely)
        tell = lambda x: np.log(x[1]) - np.log(x[0])
        firsts, back = _joined(_unpacked(table, "before"), (_U, np.float32))
        at = _find(firsts, types)
        back = np.where(at >= 0, back[at], 0) if len(firsts) else np.zeros(len(types))
        keys, value, last, often = [mix(types ^ _WORD_KEY)], [tell(p) - (likely[1] - likely[0]) - spelt.unknown + back], [-back], [sum(count)]
        for before, told, rest, of, word, seen in _unpacked(table, "often"):
            whole = np.maximum(seen.astype(float) - DISCOUNT, 0) / np.maximum(told[:, of], 1)
            p_word = p[:, _find(types, word)]
            keys.append(_pair(before[of], word))
            value.append(tell(whole + rest[:, of] * p_word) - tell(p_word) - tell(rest[:, of]))
            last.append(np.zeros(len(word)))
            often.append(seen.sum(0))
        keys, value, last, often = (np.concatenate(x) for x in (keys, value, last, often))
        order = np.argsort(keys)
        keys, often = keys[order], np.minimum(often[order], 0xFFFF).astype(np.uint16)
        there = np.zeros(bits, bool)
        for at in _probes(keys, np.zeros(len(keys), np.int64), bits):
            there[at] = True
        common, n = np.unique(often, return_counts=True)
        weights = (keys, value[order].astype(np.float32), last[order].astype(np.float32), often)
        return pa.Table.from_batches([_packed([("weights", b, weights), ("filter", b, (np.packbits(there, bitorder="little"),)), ("common", b, (common, n))])])

    return run


def _commonest(least: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block, blob in zip(b.column(1).to_pylist(), b.column(2), strict=True):
                keys, value, last, often = pickle.loads(blob.as_py())
                own = often >= least
                yield _packed([("hot", block, (keys[own], value[own], last[own]))])

    return run


def _ask(held, blocks: int, bits: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """text_hash, text: sums of the texts as far as common weights go, and the keys that blocks are to look up."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (grams, ratio, histories, back, unknown, begin), hot, values, lasts, there = held.value
        none = np.zeros(0, np.uint64)
        language = KneserNey(grams, ratio, histories, back, none, np.zeros(0, np.float32), np.zeros(0, np.float32), 0.0, none, none, none, none)
        known: dict = {}

        def filtered(key: np.ndarray, block: np.ndarray) -> np.ndarray:
            found = np.ones(len(key), bool)
            for at in _probes(key, block, bits):
                found &= (there[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
            return found

        for k, (hashes, texts) in enumerate(_groups(batches)):
            w = Words(texts)
            spelt = language.token_ratios(w, texts, known)[1]
            n = np.diff(w.at)
            doc = np.repeat(np.arange(len(n)), n)
            types, of = np.unique(w.hash, return_inverse=True)
            pair, at, of_pair = np.unique(_pair(_before(w), w.hash), return_index=True, return_inverse=True)
            key = np.concatenate([mix(types ^ _WORD_KEY), pair])
            block = (np.concatenate([types, w.hash[at]]) % _U(blocks)).astype(np.int64)
            place = _find(hot, key)
            value = np.where(place >= 0, values[place], 0) if len(hot) else np.zeros(len(key))
            asked = place < 0
            asked[asked] = filtered(key[asked], block[asked])
            ends = w.at[1:][n > 0] - 1
            whole = spelt + unknown + value[of] + value[len(types) + of_pair]
            took = np.zeros(len(n))
            took[n > 0] = begin + (np.where(place[of[ends]] >= 0, lasts[place[of[ends]]], 0) if len(hot) else 0)
            sums = []
            for each in (whole, spelt, *[np.maximum(spelt - least, 0) for least in EVIDENCE]):
                total = np.concatenate([[0], np.cumsum(each)])
                sums.append(total[w.at[1:]] - total[w.at[:-1]])
            sums[0] += took
            rows = [("sums", k % blocks, (hashes, n, *(np.rint(x * SCALE).astype(np.int64) for x in sums)))]
            # every occurrence of what is asked: the key's place among those asked, and the text
            slot = np.cumsum(asked) - 1
            which = np.concatenate([of, len(types) + of_pair])
            text = np.concatenate([doc, doc])[asked[which]].astype(np.uint16 if len(n) <= 1 << 16 else np.uint32)
            which = slot[which[asked[which]]]
            order = np.argsort(which, kind="stable")
            text, runs = text[order], np.bincount(which, minlength=int(asked.sum()))
            upto = np.concatenate([[0], np.cumsum(runs)])
            key, block = key[asked], block[asked]
            last = ends[asked[of[ends]]]
            last_key, last_text, last_block = key[slot[of[last]]], doc[last].astype(text.dtype), block[slot[of[last]]]
            for (b, own), (_, z) in zip(_slices(block, blocks), _slices(last_block, blocks), strict=True):
                if len(own):
                    places = np.repeat(upto[own] - (np.cumsum(runs[own]) - runs[own]), runs[own]) + np.arange(runs[own].sum())
                    rows.append(("asked", b, (hashes, key[own], runs[own].astype(np.uint32), text[places], last_key[z], last_text[z])))
            yield _packed(rows)

    return run


@lean_table
def _answer(table: pa.Table) -> pa.Table:
    """The sums that came along, and those of the weights that were asked for, by text."""
    weights = list(_unpacked(table, "weights"))
    keys, value, last, _ = weights[0] if weights else (np.zeros(0, _U), *[np.zeros(0, np.float32)] * 3)
    value, last = (np.rint(x.astype(float) * SCALE).astype(np.int64) for x in (value, last))
    hashes, sums = [], []
    for h, *own in _unpacked(table, "sums"):
        hashes.append(h)
        sums.append(np.stack(own))
    for h, key, runs, text, last_key, last_text in _unpacked(table, "asked"):
        total = np.zeros((5, len(h)), np.int64)
        at = _find(keys, key)
        found = np.where(at >= 0, value[at], 0) if len(keys) else np.zeros(len(key), np.int64)
        np.add.at(total[1], text, np.repeat(found, runs))
        at = _find(keys, last_key)
        np.add.at(total[1], last_text, np.where(at >= 0, last[at], 0) if len(keys) else np.zeros(len(last_key), np.int64))
        told = np.unique(np.concatenate([text, last_text]))
        hashes.append(h[told])
        sums.append(total[:, told])
    hashes = np.concatenate(hashes) if hashes else np.zeros(0, np.int64)
    sums = np.concatenate(sums, axis=1) if sums else np.zeros((5, 0), np.int64)
    each, of = np.unique(hashes, return_inverse=True)
    out = np.zeros((5, len(each)), np.int64)
    for c in range(5):
        np.add.at(out[c], of, sums[c])
    return pa.table([pa.array(x, pa.int64()) for x in (each, *out)], names=["text_hash", "n", "s0", "s1", "s2", "s3"])


def _collected(df: DataFrame) -> list[tuple[int, tuple]]:
    return sorted(((r.block, pickle.loads(r.blob)) for r in df.collect()), key=lambda x: x[0])


def text_sums(texts: DataFrame, counted: DataFrame, rows: int) -> DataFrame:
    """text_hash, n and x0 to x3 of each text of texts (text_hash, text): its words, and the means of KneserNey.ratios().

    The models are of all rows of counted (label 0 or 1, text), of which there are about so many. Equal texts,
    which have one text_hash, give one row. The result is a table of materialise(). To be used within passing().
    """
    spark = texts.sparkSession
    small_batches(spark)
    blocks = max(LEAST_BLOCKS, -(-rows // BLOCK_ROWS))
    with passing() as keep:
        counts = counted.select(F.col("label").cast("long"), "text").mapInArrow(_count(blocks), COUNTED)
        counts = materialise(counts.groupBy("block").applyInArrow(_add_up(blocks), COUNTED), "counts")
        model = _collected(counts.filter("kind IN ('grams', 'totals')").repartition(1).mapInArrow(_spell, COUNTED))[0][1]
        spelt = Spelt(*model)
        bits = max(64, min(BITS * spelt.keys, FILTER_BITS) // blocks) // 8 * 8
        held = spark.sparkContext.broadcast(model)
        made = keep(counts.filter("kind NOT IN ('grams', 'totals')").groupBy("block").applyInArrow(_weigh(held, bits), COUNTED), "weights")
        held.destroy()
    common: dict[int, int] = {}
    for _, (value, n) in _collected(made.filter("kind = 'common'")):
        for v, k in zip(value.tolist(), n.tolist(), strict=True):
            common[v] = common.get(v, 0) + k
    least, room = 1 << 16, HOT_KEYS
    for v in sorted(common, reverse=True):
        room -= common[v]
        if room < 0:
            break
        least = v
    weights = made.filter("kind = 'weights'")
    hot = _joined((x for _, x in _collected(weights.mapInArrow(_commonest(least), COUNTED))), (_U, np.float32, np.float32))
    order = np.argsort(hot[0])
    there = np.zeros(blocks * bits // 8, np.uint8)
    for b, (part,) in _collected(made.filter("kind = 'filter'")):
        there[b * bits // 8 : (b + 1) * bits // 8] = part
    held = spark.sparkContext.broadcast(((*model[:4], spelt.unknown, spelt.first), *(x[order] for x in hot), there))
    asked = texts.select("text_hash", "text").mapInArrow(_ask(held, blocks, bits), COUNTED)
    sums = asked.unionByName(weights).groupBy("block").applyInArrow(_answer, SUMS)
    sums = sums.groupBy("text_hash").agg(*[F.sum(c).alias(c) for c in ("n", "s0", "s1", "s2", "s3")])
    sums = materialise(sums.select("text_hash", "n", *[(F.col(f"s{i}") / SCALE / F.greatest("n", F.lit(1))).alias(f"x{i}") for i in range(4)]), "sums")
    held.destroy()
    return sums
