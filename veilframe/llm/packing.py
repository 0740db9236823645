"""Packing documents into training windows by bounded-space online best fit.

Each partition keeps a fixed number of open windows. Whole windows of a long document go out at
once; what remains of it goes to the open window that it fills best. When none has room, the
fullest is emitted and a new one opened. The windows left open are merged at the end.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilframe.llm.shared import documents, materialise, small_batches
from veilframe.llm.tokens import WordTokenizer
from veilframe.llm.words import groups, lean

WINDOW = 2048
OPEN_WINDOWS = 32
END_ID = 1
#: Texts are tokenised in groups of about this many bytes, which bounds a worker's memory.
GROUP = 1 << 18
#: Partitions whose leftover windows are merged together.
MERGE = 16
PIECE = "row long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class BestFit:
    """Open windows by free room. Emits (sequence number, pieces) of windows that are done."""

    def __init__(self, size: int, most: int) -> None:
        self.size, self.most, self.count = size, most, 0
        self.free: list[tuple[int, int]] = []  # (room, number), ascending
        self.held: dict[int, list] = {}

    def number(self) -> int:
        self.count += 1
        return self.count - 1

    def place(self, length: int, piece: tuple) -> Iterator[tuple[int, list]]:
        k = bisect.bisect_left(self.free, (length, -1))
        if k < len(self.free):
            room, n = self.free.pop(k)
        else:
            if len(self.free) >= self.most:
                yield self._emit(0)
            room, n = self.size, self.number()
            self.held[n] = []
        self.held[n].append((self.size - room, piece))
        bisect.insort(self.free, (room - length, n))
        while self.free and self.free[0][0] == 0:
            yield self._emit(0)

    def _emit(self, k: int) -> tuple[int, list]:
        n = self.free.pop(k)[1]
        return n, self.held.pop(n)

    def rest(self) -> Iterator[tuple[int, list]]:
        while self.free:
            yield self._emit(0)


@lean
def _pack(batches: Iterator[pa.RecordBatch], path: str, window: int, most: int) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId()
    fit, tokenizer, row = BestFit(window, most), WordTokenizer(path, END_ID), part << 40
    names = ["row", "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "open"]
    out: list[tuple] = []

    def done(n: int, pieces: list, is_open: bool = False) -> None:
        out.extend((*piece, part << 32 | n, offset, is_open) for offset, piece in pieces)

    def batch() -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) or [()] * len(names)
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, pa.bool_() if k == "open" else pa.int64()) for k, c in zip(names, columns, strict=True)], names)

    for b in batches:
        doc_ids = b.column(0).to_pylist()
        for first, last, texts in groups(b.column(1), GROUP):
            ids, at = tokenizer.encode(texts)
            raw, at = memoryview(ids.astype("<u4").tobytes()), at.tolist()
            for i in range(last - first):
                lo, total = at[i], at[i + 1] - at[i]
                for start in range(0, total, window):
                    length = min(window, total - start)
                    crc = zlib.crc32(raw[4 * (lo + start) : 4 * (lo + start + length)])
                    piece = (row, doc_ids[first + i], start, length, crc, total)
                    if length == window:
                        done(fit.number(), [(0, piece)])
                    else:
                        for x in fit.place(length, piece):
                            done(*x)
                row += 1
            if len(out) > 20_000:
                yield batch()
    for n, pieces in fit.rest():
        done(n, pieces, True)
    yield batch()


def _merge(pdf, window: int):
    """Best fit of leftover pieces, longest first, with all windows open."""
    fit = BestFit(window, len(pdf) + 1)
    pdf = pdf.sort_values(["length", "row", "start"], ascending=[False, True, True], ignore_index=True)
    base = 1 << 62 | int(pdf["merge"].iloc[0]) << 32
    sequence, offset = np.zeros(len(pdf), np.int64), np.zeros(len(pdf), np.int64)
    for i, length in enumerate(pdf["length"].tolist()):
        for n, pieces in fit.place(length, (i,)):
            for at, (k,) in pieces:
                sequence[k], offset[k] = base | n, at
    for n, pieces in fit.rest():
        for at, (k,) in pieces:
            sequence[k], offset[k] = base | n, at
    return pdf.assign(sequence_id=sequence, offset=offset)[[x.split()[0] for x in PIECE.split(", ")]]


def pack_documents(docs: DataFrame, tokenizer_path: str, *, window: int = WINDOW, open_windows: int = OPEN_WINDOWS) -> DataFrame:
    """One row per piece of a document: where it lies in the document and in which sequence.

    docs has doc_id and text; other columns are not looked at. A document's ids are its text's
    tokens and END_ID, so null or empty text gives one piece of one id. Documents longer than a
    window are cut at multiples of it; nothing else is cut. row numbers the input rows, so that
    repeated rows stay apart. Sequences hold at most window ids, without gaps. The tokenizer file is
    opened by executors at tokenizer_path and must lie there on each of them. What MERGE partitions leave open is merged
    at the end, so about one window in MERGE * OPEN_WINDOWS that they filled is left part empty. An empty table gives
    an empty result.
    """
    small_batches(docs.sparkSession)
    schema = PIECE + ", open boolean"
    pieces = materialise(docs.select("doc_id", "text").mapInArrow(lambda it: _pack(it, tokenizer_path, window, open_windows), schema), "pieces")
    left = pieces.filter("open").drop("open").withColumn("merge", F.expr(f"(sequence_id >> 32) div {MERGE}"))
    merged = left.groupBy("merge").applyInPandas(lambda pdf: _merge(pdf, window), PIECE)
    return pieces.filter("not open").drop("open").unionByName(merged)


def op8_pack_windows(spark, sf_dir):
    """pack_documents() of documents with the public tokenizer of 49,000 word pieces: a row for each piece."""
    import public_tokenizers

    return pack_documents(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json")).drop("row")
