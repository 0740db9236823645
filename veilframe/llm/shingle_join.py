"""N-gram Jaccard join as a blocked sparse matrix product.

Documents with the same set of shingles are one row of the incidence matrix. Columns are ordered
with the frequent ones last. A pair that reaches the similarity must meet in the first
n - ceil(t n) + 1 columns of both rows, so candidates come from those columns alone; each column is
counted once per row, a column with one row falls away, and columns with the same rows are a bundle.

First each row is compared with the least row of its bundles, the hub, with which it shares the
most columns, and with the others drawn there, which joins most groups of copies in linear time.
Only spanning links are asked for, so rows of one component need no further comparison. What else
may link is found by blocks: rows are dealt into blocks of bounded size, and a bundle counts once
for each of its blocks, with the set of their rows as bits. Pairs of blocks that share bundles are
multiplied: the overlaps of their prefixes are accumulated, pairs of rows below the bound that their
sizes set are discarded, first by these and then by signatures of whole rows, and rows with a pair left
are multiplied with their whole sets. No pair of documents leaves a block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from veilframe.llm.components import connected_components
from veilframe.llm.shared import documents, join_hot, materialise, passing, small_batches
from veilframe.llm.words import Words, groups, lean, mix

WORDS = 5
#: Similarity: at least OVER of UNDER parts of the union.
OVER, UNDER = 75, 100
#: A column in at least this share of the rows is frequent; there are at most mean row size / share of them.
FREQUENT = 0.0025
#: Prefix entries that one block of columns has in the mean, and the least number of blocks.
BLOCK_ENTRIES, LEAST_BLOCKS = 500_000, 64
#: Rows of a block at most, one for each bit of BIT_WORDS longs; half as many in the mean.
BLOCK_ROWS, BIT_WORDS = 256, 4
#: Candidate rows up to which their ids (16 bytes each) are broadcast to fetch their texts; beyond, texts are shuffled.
BROADCAST_ROWS = 500_000
#: Bits of a row's signature.
SIGNATURE = 4096
#: Rows whose size differs by less than this factor are dealt to the same blocks.
SIZE_CLASS = 1.15
_U = np.uint64


def _sets(column: pa.Array, words: int) -> Iterator[list[np.ndarray]]:
    """For each group of texts, the sorted distinct shingle hashes of every text."""
    for _, _, texts in groups(column):
        grams, at = Words(texts).ngrams(words, short=True)
        of = np.repeat(np.arange(len(texts)), np.diff(at))
        order = np.lexsort((grams, of))
        grams, of = grams[order], of[order]
        keep = np.ones(len(grams), bool)
        keep[1:] = (grams[1:] != grams[:-1]) | (of[1:] != of[:-1])
        grams, of = grams[keep], of[keep]
        yield np.split(grams, np.searchsorted(of, np.arange(1, len(texts))))


def _fingerprints(s: np.ndarray) -> tuple[int, int]:
    """Two independent 64-bit hashes of a set."""
    n = _U(len(s))
    sums = np.array([mix(s ^ _U(0x2545F4914F6CDD1D)).sum(dtype=_U) + n, mix(s + _U(0x632BE59BD9B4E019)).sum(dtype=_U) ^ n], _U)
    return tuple(mix(sums).view(np.int64).tolist())


def _row_key(s: np.ndarray, clashes: frozenset[int], bits: int) -> int:
    """What names a set: its first hash, or the second one where different sets share the first. bits are those of the first that are used."""
    first, second = _fingerprints(s)
    first = first >> (64 - bits)
    return second if first in clashes else first


def _prefix(n: int) -> int:
    return n - -(-OVER * n // UNDER) + 1


@lean
def _measure(batches: Iterator[pa.RecordBatch], words: int, bits: int) -> Iterator[pa.RecordBatch]:
    """A row per document (kind 0: doc_id, n, both fingerprints), and at the end the columns that are frequent here (kind 1: column, rows)."""
    names = ["kind", "a", "n", "fp", "fp2"]
    keys, counts, done, held, waiting = np.zeros(0, _U), np.zeros(0, np.int64), set(), 0, []

    def batch(kind: int, a: list | pa.Array, n: list | np.ndarray, prints: list | None = None) -> pa.RecordBatch:
        size = len(n)
        prints = prints if prints is not None else [(None, None)] * size
        return pa.RecordBatch.from_arrays([pa.array(np.full(size, kind, np.int32)), pa.array(a, pa.int64()), pa.array(n, pa.int64()), *[pa.array([x[i] for x in prints], pa.int64()) for i in (0, 1)]], names)

    def fold() -> None:
        """Lossy counting: what is rarer than half the share so far is forgotten."""
        nonlocal keys, counts, held, waiting
        both, of = np.unique(np.concatenate([keys, *waiting]), return_inverse=True)
        counts = np.bincount(of, np.concatenate([counts, np.ones(len(of) - len(counts))]), minlength=len(both)).astype(np.int64)
        keep = counts > len(done) * FREQUENT / 2
        keys, counts, held, waiting = both[keep], counts[keep], 0, []

    for b in batches:
        size, prints = [], []
        for sets in _sets(b.column(1), words):
            for s in sets:
                first, second = _fingerprints(s) if len(s) else (None, None)
                size.append(len(s))
                prints.append((first if first is None else first >> (64 - bits), second))
                if second is not None and second not in done:
                    done.add(second)
                    waiting.append(s)
                    held += len(s)
            if held > 1 << 20:
                fold()
        yield batch(0, b.column(0).cast(pa.int64()), size, prints)
    fold()
    keep = counts >= max(2, len(done) * FREQUENT / 2)
    yield batch(1, pa.array(keys[keep].view(np.int64)), counts[keep])


_ENTRY = np.dtype([("h", "<u8"), ("fp", "<i8"), ("n", "<u4"), ("q", "u1")])


@lean
def _entries(batches: Iterator[pa.RecordBatch], key: Callable[[np.ndarray], int], words: int, frequent: np.ndarray, blocks: int) -> Iterator[pa.RecordBatch]:
    """Prefix entries (column, row, row size, place in the row by 256ths) as bytes, by block of columns; frequent columns go to blocks of their own by row."""
    done: set[int] = set()
    waiting: list[np.ndarray] = []
    held = 0

    def flush() -> pa.RecordBatch:
        nonlocal held
        e = np.concatenate(waiting) if waiting else np.zeros(0, _ENTRY)
        waiting.clear()
        held = 0
        often = frequent[np.minimum(np.searchsorted(frequent, e["h"]), len(frequent) - 1)] == e["h"] if len(frequent) else np.zeros(len(e), bool)
        block = np.where(often, blocks + (mix(e["fp"].view(_U)) % _U(blocks)).astype(np.int64), (mix(e["h"]) % _U(blocks)).astype(np.int64))
        order = np.argsort(block, kind="stable")
        e, block = e[order], block[order]
        own, first = np.unique(block, return_index=True)
        return pa.RecordBatch.from_arrays([pa.array(own.astype(np.int32)), pa.array([x.tobytes() for x in np.split(e, first[1:])] if len(own) else [], pa.binary())], ["block", "entries"])

    for b in batches:
        for sets in _sets(b.column(0), words):
            for s in sets:
                if not len(s) or (fp := key(s)) in done:
                    continue
                done.add(fp)
                if len(frequent):
                    often = frequent[np.minimum(np.searchsorted(frequent, s), len(frequent) - 1)] == s
                    if often.any():
                        s = np.concatenate([s[~often], s[often]])
                k = _prefix(len(s))
                e = np.empty(k, _ENTRY)
                e["h"], e["fp"], e["n"], e["q"] = s[:k], fp, len(s), np.arange(k) * 256 // len(s)
                waiting.append(e)
                held += k
            if held > 1 << 21:
                yield flush()
    yield flush()


_BUNDLED = "h long, bundle long, fp long, n long, q int, shared long"


def _columns(table: pa.Table, blocks: int) -> pa.Table:
    """The entries of a block of columns, as _BUNDLED.

    In a block of rare columns all rows of a column are here, so those with one row fall away and those with the
    same rows become one, named by hashes of these. Frequent columns are spread over blocks and stay columns.
    """
    e = np.frombuffer(b"".join(table.column("entries").to_pylist()), _ENTRY)
    e = e[np.lexsort((e["fp"], e["h"]))]
    new = np.ones(len(e), bool)
    new[1:] = (e["h"][1:] != e["h"][:-1]) | (e["fp"][1:] != e["fp"][:-1])
    e = e[new]
    h, fp, n, q, shared = e["h"].copy(), e["fp"].copy(), e["n"].astype(np.int64), e["q"].astype(np.int32), np.ones(len(e), np.int64)
    often = not len(e) or table.column("block")[0].as_py() >= blocks
    if not often:
        same = h[1:] == h[:-1]
        keep = np.concatenate([[False], same]) | np.concatenate([same, [False]])
        h, fp, n, q, shared = h[keep], fp[keep], n[keep], q[keep], shared[keep]
    bundle = np.zeros(len(h), np.int64)
    if not often and len(h):
        first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        rows = np.diff(np.concatenate([first, [len(h)]]))
        own = fp.view(_U)
        sums = [np.bitwise_xor.reduceat(mix(own ^ _U(salt)), first) for salt in (0x9FB21C651E98DF25, 0x3C79AC492BA7B653)]
        bundle = np.repeat(mix(sums[0] + mix(sums[1] + rows.astype(_U))), rows).view(np.int64)
        order = np.lexsort((fp, bundle))
        bundle, fp, n, q = bundle[order], fp[order], n[order], q[order]
        first = np.flatnonzero(np.concatenate([[True], (bundle[1:] != bundle[:-1]) | (fp[1:] != fp[:-1])]))
        shared = np.diff(np.concatenate([first, [len(bundle)]])).astype(np.int64)
        q = np.minimum.reduceat(q, first)
        bundle, fp, n, h = bundle[first], fp[first], n[first], np.zeros(len(first), _U)
    made = [h.view(np.int64), bundle, fp, n, q, shared]
    return pa.table({x.split()[0]: pa.array(v if len(v) else [], k) for x, v, k in zip(_BUNDLED.split(", "), made, (pa.int64(),) * 4 + (pa.int32(), pa.int64()), strict=True)})


def _rest(n: Column, q: Column) -> Column:
    """No fewer than the columns of a row from this place on."""
    return n - F.floor(n * q / 256)


def _compatible(n: Column, m: Column) -> Column:
    return F.least(n, m) * UNDER >= F.greatest(n, m) * OVER


def _needed(n: Column, m: Column) -> Column:
    """Overlap that sizes n and m must reach."""
    return F.ceil((n + m) * OVER / (OVER + UNDER))


def _may_link(lo: Column, hi: Column, lo_: Column, hi_: Column, shared: Column) -> Column:
    """Whether sizes lo to hi and lo_ to hi_ hold two that may link if no more than shared columns of their prefixes are common.

    Beyond its prefix a row of n columns has fewer than OVER n / UNDER, and an overlap is needed that grows
    with both sizes; so the larger row at its largest and the smaller one at its smallest decide.
    """

    def larger(most: Column, least: Column) -> Column:
        n = F.least(most.cast("double"), least * (UNDER / OVER))
        return (most >= least) & (shared + n * (OVER / UNDER) + 1e-6 >= (n + least) * (OVER / (OVER + UNDER)))

    return larger(hi, lo_) | larger(hi_, lo)


_LINKS = ["a", "b"]


def _pairs_wanted(size: np.ndarray, side: np.ndarray, component: np.ndarray) -> np.ndarray:
    """Pairs of a cell's rows to be compared: of sides 0 and 1, or both of side 2; of different components and sizes that can link."""
    across = (side[:, None] == 0) & (side[None] == 1)
    wanted = across | across.T | (side[:, None] == 2) & (side[None] == 2)
    wanted &= np.minimum(size[:, None], size[None]) * UNDER >= np.maximum(size[:, None], size[None]) * OVER
    return wanted & (component[:, None] != component[None])


def _by_cell(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple]]]:
    """Rows (cell, ...) sorted by cell, each cell's at once."""
    cell, rows = None, []
    for b in batches:
        for x, *row in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if x != cell:
                if rows:
                    yield cell, rows
                cell, rows = x, []
            rows.append(row)
    if rows:
        yield cell, rows


@lean
def _accumulated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of each cell that have a partner which the bound lets pass, as (cell, fp, side, component).

    A cell is two blocks, or one twice. It has a row for each document (fp, side, component, n, position) and one for
    each bundle that both blocks hold (shared, and as bits the positions that have it in either).
    """
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64()]
    names, out = ["cell", "fp", "side", "component"], []

    def batch() -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], k) for i, k in enumerate(kinds)], names)
        out.clear()
        return made

    for cell, rows in _by_cell(batches):
        members, bundles = [r for r in rows if r[0] is not None], [r for r in rows if r[0] is None]
        if len(members) < 2 or not bundles:
            continue
        fps, side, component, n, position = (np.array(x) for x in zip(*[r[:5] for r in members], strict=True))
        wanted = _pairs_wanted(n, side, component)
        if not wanted.any():
            continue
        shared = np.array([r[5] for r in bundles], float)
        bits = [np.unpackbits(np.array([r[6 + i] for r in bundles], np.int64).view(np.uint8).reshape(len(bundles), -1), axis=1, bitorder="little") for i in (0, 1)]
        held = np.where((side == 1)[:, None], bits[1].T[position], bits[0].T[position]).astype(float)
        overlap = (held * shared) @ held.T
        larger = np.maximum(n[:, None], n[None])
        needed = -(-(n[:, None] + n[None]) * OVER // (OVER + UNDER))
        wanted &= (overlap > 0) & (overlap - (-OVER * larger // UNDER) - 1 >= needed)
        out += [(cell, int(fps[i]), int(side[i]), int(component[i])) for i in np.flatnonzero(wanted.any(1))]
        if len(out) > 10_000:
            yield batch()
    yield batch()


def _signature(s: np.ndarray) -> bytes:
    """Bits at SIGNATURE places, set where a member hashes to."""
    bits = np.zeros(SIGNATURE, np.uint8)
    bits[(s % _U(SIGNATURE)).astype(np.int64)] = 1
    return np.packbits(bits).tobytes()


@lean
def _screened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (cell, fp, side, component, n, signature) those with a partner in their cell that signatures don't rule out.

    Each bit that only one of two rows has is a member that only it has, so the overlap is no more than the rest.
    """
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64()]
    for cell, rows in _by_cell(batches):
        rows = list({r[0]: r for r in rows}.values())
        fps, side, component, n, signature = zip(*rows, strict=True)
        size = np.array(n)
        wanted = _pairs_wanted(size, np.array(side), np.array(component))
        bits = np.unpackbits(np.frombuffer(b"".join(signature), np.uint8).reshape(len(rows), -1), axis=1).astype(np.float32)
        own, common = bits.sum(1), bits @ bits.T
        most = np.minimum((size - own)[:, None] + common, (size - own)[None] + common)
        wanted &= most * UNDER >= (size[:, None] + size[None] - most) * OVER
        at = np.flatnonzero(wanted.any(1)).tolist()
        columns = [[cell] * len(at), *[[x[i] for i in at] for x in (fps, side, component)]]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["cell", "fp", "side", "component"])


@lean
def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (cell, fp, side, component, set): for each component that has a link here, the least one of its group within the cell."""
    out: list[tuple[int, int]] = []

    def batch() -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in (0, 1)], _LINKS)
        out.clear()
        return made

    for _, rows in _by_cell(batches):
        # a row whose id occurs several times may have come several times
        _, side, component, sets = zip(*{r[0]: r for r in rows}.values(), strict=True)
        sets = [np.frombuffer(raw, _U) for raw in sets]
        size, component = np.array([len(s) for s in sets]), np.array(component)
        wanted = _pairs_wanted(size, np.array(side), component)
        if not wanted.any():
            continue
        overlap = _product(sets)
        r, c = np.nonzero(wanted & (overlap * UNDER >= (size[:, None] + size[None] - overlap) * OVER))
        own, at = np.unique(component, return_inverse=True)
        r, c = at[r], at[c]
        label = own.copy()
        while True:
            new = label.copy()
            np.minimum.at(new, r, label[c])
            np.minimum.at(new, c, label[r])
            if (new == label).all():
                break
            label = new
        out.extend((int(own[i]), int(label[i])) for i in np.union1d(r, c))
        if len(out) > 10_000:
            yield batch()
    yield batch()


def _product(sets: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """Overlaps of all pairs of sets: the incidence matrix times its transpose, some columns at a time."""
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    column = np.concatenate(sets)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    new = np.ones(len(column), bool)
    new[1:] = column[1:] != column[:-1]
    place = np.cumsum(new) - 1
    often = np.bincount(place)[place] > 1
    row, place = row[often], place[often]
    place = np.unique(place, return_inverse=True)[1]
    total = np.zeros((len(sets), len(sets)))
    columns = int(place[-1]) + 1 if len(place) else 0
    for first in range(0, columns, width):
        a, b = np.searchsorted(place, (first, first + width))
        block = np.zeros((len(sets), min(width, columns - first)), np.float32)
        block[row[a:b], place[a:b] - first] = 1
        total += block @ block.T
    return total.astype(np.int64)


class ShingleJoin:
    """The steps of one join over a table of documents (doc_id, text). bits are those that tell sets apart at first, fewer in tests."""

    def __init__(self, docs: DataFrame, words: int = WORDS, bits: int = 64) -> None:
        small_batches(docs.sparkSession)
        self.docs, self.words = docs.select("doc_id", "text"), words
        measured = materialise(self.docs.mapInArrow(lambda it: _measure(it, words, bits), "kind int, a long, n long, fp long, fp2 long"), "measured")
        rows = measured.filter("kind = 0").select(F.col("a").alias("doc_id"), "n", "fp", "fp2")
        sets = rows.filter("fp IS NOT NULL AND doc_id IS NOT NULL")
        # different sets share a first hash about N squared / 2**65 times among N sets
        clashing = sets.groupBy("fp").agg((F.min("fp2") != F.max("fp2")).alias("clash")).filter("clash").select("fp")
        clashes = self.clashes = frozenset(r.fp for r in clashing.collect())
        self.key = lambda s: _row_key(s, clashes, bits)
        named = F.when(F.col("fp").isin(*clashes), F.col("fp2")).otherwise(F.col("fp")) if clashes else F.col("fp")
        self.rows = rows.select("doc_id", "n", named.alias("fp"), "fp2")
        self.kinds = materialise(self.rows.filter("fp IS NOT NULL AND doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("doc_id"), F.min("n").alias("n"), F.count("*").alias("times")), "kinds")
        sums = self.kinds.agg(F.count("*").alias("rows"), F.sum(F.col("n") / UNDER * (UNDER - OVER) + 1).alias("entries"), F.sum("times").alias("documents")).first()
        self.count, self.entries, self.documents = sums["rows"], sums["entries"] or 0, sums["documents"] or 0
        often = measured.filter("kind = 1").groupBy("a").agg(F.sum("n").alias("n")).filter(F.col("n") >= max(2, FREQUENT * self.count))
        # at most mean row size / FREQUENT columns, whatever the number of rows
        self.frequent = np.sort(np.array([r.a for r in often.select("a").collect()], np.int64).view(_U))

    def columns(self) -> DataFrame:
        """Prefix columns that several rows share, as _BUNDLED: bundle is 0 for frequent ones, h for others."""
        blocks = max(LEAST_BLOCKS, int(self.entries // BLOCK_ENTRIES))
        words, frequent, key = self.words, self.frequent, self.key
        entries = self.docs.filter("doc_id IS NOT NULL").select("text").mapInArrow(lambda it: _entries(it, key, words, frequent, blocks), "block int, entries binary")
        return materialise(entries.groupBy("block").applyInArrow(lambda t: _columns(t, blocks), _BUNDLED), "columns")

    def bundles(self) -> DataFrame:
        """(bundle, fp, n, q, shared): prefix columns that hold exactly the same rows, as one; q is the first one's place."""
        columns = self.columns()
        often = columns.filter("bundle = 0")
        rows = [F.bit_xor(F.xxhash64("fp", F.lit(i))) for i in (0, 1)]
        of = often.groupBy("h").agg(F.xxhash64(*rows, F.count("*")).alias("bundle"))
        named = often.drop("bundle").join(F.broadcast(of), "h")  # no more of them than frequent columns
        whole = columns.filter("bundle <> 0").select("bundle", "fp", "n", "q", "shared").unionByName(named.select("bundle", "fp", "n", "q", "shared"))
        return materialise(whole.groupBy("bundle", "fp", "n").agg(F.min("q").alias("q"), F.sum("shared").alias("shared")), "bundles")

    def fetch(self, fps: DataFrame) -> DataFrame:
        """(fp, s, n, signature): the set of each row named in fps and its size, as a table. Each text is hashed once."""
        asked = materialise(fps.join(self.kinds, "fp").select("fp", "doc_id"), "asked")
        texts = self.docs.join(F.broadcast(asked) if asked.count() <= BROADCAST_ROWS else asked, "doc_id").select("fp", "text")
        words, key = self.words, self.key

        @lean
        def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                fps, first = b.column(0).to_pylist(), 0
                for sets in _sets(b.column(1), words):
                    # of rows that repeat an id, those whose text is meant
                    own = [i for i, s in enumerate(sets) if len(s) and key(s) == fps[first + i]]
                    made = [pa.array([sets[i].tobytes() for i in own], pa.binary()), pa.array([len(sets[i]) for i in own], pa.int64()), pa.array([_signature(sets[i]) for i in own], pa.binary())]
                    yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array([first + i for i in own], pa.int64())), *made], ["fp", "s", "n", "signature"])
                    first += len(sets)

        return materialise(texts.mapInArrow(hashed, "fp long, s binary, n long, signature binary"), "sets")

    def dealt(self, rows: DataFrame, *columns: str) -> DataFrame:
        """The rows of each cell together, in order."""
        n = max(16, int(self.entries // BLOCK_ENTRIES))
        return rows.select("cell", *columns).repartition(n, "cell").sortWithinPartitions("cell")

    def in_cells(self, members: DataFrame, sets: DataFrame, *columns: str) -> DataFrame:
        """Members (cell, fp, side, component) of cells, a table, with columns of their sets."""
        members = F.broadcast(members) if members.count() <= BROADCAST_ROWS else members
        return self.dealt(sets.select("fp", *columns).join(members, "fp"), "fp", "side", "component", *columns)

    def screened(self, members: DataFrame, sets: DataFrame) -> DataFrame:
        kept = self.in_cells(members, sets, "n", "signature").mapInArrow(_screened, "cell long, fp long, side int, component long")
        return materialise(kept, "screened")

    def multiplied(self, members: DataFrame, sets: DataFrame) -> DataFrame:
        """Links between components of the members of cells."""
        return self.in_cells(members, sets, "s").mapInArrow(_cells, "a long, b long")

    def drawn(self, bundles: DataFrame) -> DataFrame:
        """(fp, other): each row with the hub with which it shares the most columns. The least row of a bundle is its hub."""
        place = F.xxhash64("fp")
        least = bundles.groupBy("bundle").agg(F.min(F.struct(place.alias("place"), F.col("fp").alias("other"), F.col("n").alias("m"), F.col("q").alias("r"))).alias("hub"), F.count("*").alias("rows"))
        least = least.select("bundle", "hub.other", "hub.m", "hub.r", "rows")
        n, m = F.col("n"), F.col("m")
        met = join_hot(bundles, least, "bundle", "rows", self.entries).filter((F.col("fp") != F.col("other")) & _compatible(n, m))
        met = met.filter(F.least(_rest(n, F.col("q")), _rest(m, F.col("r"))) >= _needed(n, m))
        best = met.groupBy("fp", "other").agg(F.sum("shared").alias("shared")).groupBy("fp").agg(F.max_by("other", F.struct("shared", "other")).alias("other"))
        return materialise(best, "drawn")

    def placed(self, mixed: DataFrame, component: DataFrame) -> DataFrame:
        """(fp, n, component, great, block, position): rows dealt into blocks.

        A row's home is the largest bundle it has, so that rows which share much meet in few blocks. Components
        of a block's size and more, named by great, have blocks of their own.
        """
        great = component.groupBy("component").agg(F.count("*").alias("members")).filter(F.col("members") >= BLOCK_ROWS)
        named = join_hot(component, great.withColumn("great", F.col("component")), "component", "members", self.count, "left").select("fp", "component", "great")
        rows = mixed.groupBy("fp").agg(F.max_by("bundle", F.struct("rows", "bundle")).alias("home"), F.first("n").alias("n"))
        rows = rows.join(named, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
        group = F.xxhash64("home", F.coalesce("great", F.lit(0)), F.floor(F.log("n") / float(np.log(SIZE_CLASS))))
        rows = materialise(rows.select("fp", "n", "component", "great", group.alias("group")), "homes")
        sized = rows.groupBy("group").agg(F.count("*").alias("rows"))
        part = F.pmod(F.xxhash64("fp", F.lit(2)), F.ceil(F.col("rows") * 2 / BLOCK_ROWS))
        rows = join_hot(rows, sized, "group", "rows", self.count).withColumn("part", part)
        at = F.row_number().over(Window.partitionBy("group", "part").orderBy("fp")) - 1
        rows = rows.withColumn("at", at)
        block = F.xxhash64("group", "part", F.floor(F.col("at") / BLOCK_ROWS))
        return materialise(rows.select("fp", "n", "component", "great", block.alias("block"), F.pmod("at", F.lit(BLOCK_ROWS)).alias("position")), "placed")

    def meetings(self, mixed: DataFrame, placed: DataFrame) -> DataFrame:
        """What _accumulated() reads, for each two blocks whose sizes and places let rows of theirs link."""
        words = range(BIT_WORDS)
        bits = [F.bit_or(F.when(F.floor(F.col("position") / 64) == i, F.expr("shiftleft(1L, position % 64)")).otherwise(F.lit(0).cast("long"))).alias(f"b{i}") for i in words]
        bounds = [F.min("n").alias("lo"), F.max("n").alias("hi"), F.min("q").alias("q"), F.min("component").alias("c"), F.max("component").alias("d")]
        held = mixed.select("bundle", "fp", "q", "shared").join(placed, "fp")
        held = held.groupBy("bundle", "block", "great").agg(F.first("shared").alias("shared"), *bounds, *bits)
        held = materialise(held.select("bundle", "block", "great", "shared", "lo", "hi", "q", "c", "d", F.array(*[f"b{i}" for i in words]).alias("bits")), "incidence")
        other = held.select("bundle", *[F.col(x).alias(f"{x}_") for x in held.columns if x not in ("bundle", "shared")])
        rest = lambda x: F.col(f"hi{x}") - F.floor(F.col(f"hi{x}") * F.col(f"q{x}") / 256)
        alone = (F.col("c") == F.col("d")) & (F.col("c_") == F.col("d_")) & (F.col("c") == F.col("c_"))
        early = F.least(rest(""), rest("_")) >= _needed(F.col("lo"), F.col("lo_"))
        sizes = (F.col("hi") * UNDER >= F.col("lo_") * OVER) & (F.col("hi_") * UNDER >= F.col("lo") * OVER)
        may = ~alone & sizes
        # Blocks of one great component are never compared with each other, and not even met in a join:
        # any block meets those of no great component, and great ones meet where a bundle has several components of them.
        small = held.join(other.filter("great_ IS NULL"), "bundle").filter(may & (F.col("great").isNotNull() | (F.col("block") <= F.col("block_"))))
        several = held.filter("great IS NOT NULL").groupBy("bundle").agg(F.min("great").alias("x"), F.max("great").alias("y")).filter("x <> y").select("bundle")
        both = held.filter("great IS NOT NULL").join(several, "bundle", "left_semi").join(other.filter("great_ IS NOT NULL"), "bundle").filter(may & (F.col("great") < F.col("great_")))
        columns = ["block", "block_", "shared", "lo", "hi", "lo_", "hi_", "bits", "bits_", early.alias("early")]
        met = materialise(small.select(*columns).unionByName(both.select(*columns)), "met")
        # the first column that two rows share must come early in both; what they share is counted over all
        cells = met.groupBy("block", "block_").agg(F.bool_or("early").alias("early"), F.sum("shared").alias("shared"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.min("lo_").alias("lo_"), F.max("hi_").alias("hi_"))
        cells = cells.filter("early").filter(_may_link(F.col("lo"), F.col("hi"), F.col("lo_"), F.col("hi_"), F.col("shared"))).select("block", "block_")
        cells = materialise(cells.withColumn("cell", F.xxhash64("block", "block_")), "cells2")
        found = met.join(F.broadcast(cells) if cells.count() <= BROADCAST_ROWS else cells, ["block", "block_"])
        found = materialise(found.select("cell", "block", "block_", "shared", "bits", "bits_"), "found")
        position = F.filter(F.sequence(F.lit(0), F.lit(BLOCK_ROWS - 1)), lambda p: F.getbit(F.element_at(F.col("bits"), F.floor(p / 64).cast("int") + 1), p % 64) == 1)

        def members(x: str, side: int, where: str) -> DataFrame:
            own = found.filter(where).groupBy("cell", F.col(f"block{x}").alias("block")).agg(*[F.bit_or(F.col(f"bits{x}")[i]).alias(f"b{i}") for i in words])
            own = own.select("cell", "block", F.array(*[f"b{i}" for i in words]).alias("bits"))
            return own.select("cell", "block", F.explode(position).alias("position")).withColumn("side", F.lit(side))

        rows = members("", 0, "block <> block_").unionByName(members("_", 1, "block <> block_")).unionByName(members("", 2, "block = block_"))
        rows = rows.join(placed, ["block", "position"]).select("cell", "fp", "side", "component", "n", "position")
        bundles = found.select("cell", "shared", "bits", "bits_")
        return self.dealt(rows.unionByName(bundles, allowMissingColumns=True), "fp", "side", "component", "n", "position", "shared", "bits", "bits_")

    def components(self) -> DataFrame:
        """(fp, component, members) of every row that links: the least row reachable, and how many rows it has."""
        bundles = self.bundles()
        best = self.drawn(bundles)
        sized = best.groupBy("other").agg(F.count("*").alias("rows"))
        part = F.pmod(F.xxhash64("fp", F.lit(1)), F.ceil(F.col("rows") / (BLOCK_ROWS - 1)))
        own = join_hot(best, sized, "other", "rows", self.count).select("fp", "other", part.alias("part"))
        hubs = sized.select(F.col("other").alias("fp"), "other", F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("rows") / (BLOCK_ROWS - 1)) - 1)).alias("part"))
        cells = own.unionByName(hubs).select(F.xxhash64("other", "part").alias("cell"), "fp", F.lit(2).alias("side"), F.col("fp").alias("component"))
        cells = materialise(cells, "cells")
        sets = self.fetch(cells.select("fp").distinct())
        first = connected_components(self.multiplied(cells, sets)).withColumnRenamed("node", "fp")

        # bundles whose rows are not all in one component yet
        named = bundles.join(first, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
        open_ = named.groupBy("bundle").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("rows")).filter("x <> y").select("bundle", "rows")
        mixed = materialise(join_hot(bundles, open_, "bundle", "rows", self.entries), "mixed")
        placed = self.placed(mixed, first)
        passed = materialise(self.meetings(mixed, placed).mapInArrow(_accumulated, "cell long, fp long, side int, component long"), "passed")
        missing = passed.select("fp").distinct().join(sets, "fp", "left_anti")
        sets = sets.unionByName(self.fetch(missing))
        second = connected_components(self.multiplied(self.screened(passed, sets), sets))

        # the second links are between components, and name those by their least rows
        second = second.select(F.col("node").alias("component"), F.col("component").alias("least"))
        rows = first.unionByName(second.select(F.col("component").alias("fp"), "component")).distinct()
        sizes = rows.groupBy("component").agg(F.count("*").alias("rows"))
        rows = join_hot(rows, sizes.join(second, "component", "left"), "component", "rows", self.count)
        return rows.select("fp", F.coalesce("least", "component").alias("component"))


def fingerprints(rows: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, place and fp2, the second hash of the set (null where it is empty), of rows (doc_id, place, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            prints = [_fingerprints(s)[1] if len(s) else None for sets in _sets(b.column(2), words) for s in sets]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(prints, pa.int64())], ["doc_id", "place", "fp2"])

    small_batches(rows.sparkSession)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", "place", "text").mapInArrow(run, f"doc_id {kind}, place long, fp2 long")


def link_rows(docs: DataFrame, *, words: int = WORDS, bits: int = 64) -> DataFrame:
    """join_shingles() with fp2, a hash of the row's set, and component, which its rows share; both null without shingles."""
    with passing() as keep:
        join = ShingleJoin(docs, words, bits)
        components = join.components()
        named = materialise(join.kinds.join(components, "fp", "left").withColumn("component", F.coalesce("component", "fp")), "named")
        least = named.groupBy("component").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("sets"))
        of_set = join_hot(named, least, "component", "sets", join.count).select("fp", "times", "component", "component_id")
        of_set = materialise(of_set, "components")
        linked = join_hot(join.rows, of_set, "fp", "times", join.documents, "left")
        return keep(linked.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"), "fp2", "component"), "linked")


def join_shingles(docs: DataFrame, *, words: int = WORDS) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of docs (doc_id, text).

    A text's words are lower-cased (A to Z) and split at ASCII white space; its set is its distinct
    runs of `words` words, or all its words as one run if it has fewer. Two rows link if the sets share at
    least OVER / UNDER of their union; component_id is the least doc_id reachable by links. Null texts and
    texts without words have no shingles and link with nothing; equal texts link; a null doc_id
    links with nothing and has a null component. Rows that repeat an id are compared each with its
    own text, and each has the component of its own. Other columns are not looked at; an empty table gives an
    empty result.
    """
    return link_rows(docs, words=words).select("doc_id", "n_shingles", "component_id")


def op2_shingle_join(spark, sf_dir):
    """join_shingles() of documents: a row for each row of them."""
    return join_shingles(documents(spark, sf_dir))
