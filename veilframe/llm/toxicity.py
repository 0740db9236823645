"""Toxicity by two class-conditional Kneser-Ney models.

Each class predicts a word from the one before it, backs off to how many different words it follows,
and from there to how it is spelt: byte n-grams within words up to ORDER, of which those up to SHARED
are counted over both classes together. An expression too rare for a class of its own, such as a
new inflection, is therefore judged by the longest part that was seen, and in the end by shared
counts, on which the classes agree. The score is the difference of the two log-likelihoods per
word, as it is and beyond what rare words show by chance, calibrated to a probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilframe.llm.labelled import as_texts, calibrate, known_labels
from veilframe.llm.shared import documents, held_out, materialise, passing, shuffles_freed
from veilframe.llm.words import BASE, Texts, Words, lean, mix

SEED = 5
#: Ids or scores up to which a list of them is broadcast; beyond, both sides are shuffled.
BROADCAST_IDS = 200_000
DISCOUNT = 0.75
ORDER = 5
SHARED = 2
#: Word scores that a task remembers.
REMEMBERED = 1_000_000
#: The ratio as it is, and what exceeds these: rare ordinary words seldom do, so long texts don't drown a few plain expressions.
EVIDENCE = (2.0, 4.0)
_BEGIN, _END = 1, 2


class Spelling:
    """Bytes of some words, lower-cased, between a begin and an end mark; n-grams end at each byte after the begin mark."""

    def __init__(self, texts: Texts, start: np.ndarray, end: np.ndarray) -> None:
        size = end - start + 2
        first = np.concatenate([[0], np.cumsum(size)])
        inner = (np.arange(first[-1]) - np.repeat(first[:-1], size)).astype(np.int32)  # place in the word; the begin mark is at 0
        data = np.concatenate([texts.data, np.zeros(1, np.uint8)])[np.minimum(np.repeat(start, size) + inner - 1, len(texts.data))]
        data = data + ((data >= 65) & (data <= 90)).astype(np.uint8) * np.uint8(32)
        data[first[:-1]], data[first[1:] - 1] = _BEGIN, _END
        self.data, self.inner, self.word, self.size = data.astype(np.uint64), inner, np.repeat(np.arange(len(start), dtype=np.int32), size), size
        self._hash = {0: np.zeros(len(data), np.uint64)}

    def grams(self, n: int) -> np.ndarray:
        """Hash of the n bytes that end at each place; of use only where inner >= n - 1."""
        if n not in self._hash:
            before = np.concatenate([np.zeros(1, np.uint64), self.grams(n - 1)[:-1]])
            self._hash[n] = before * np.uint64(BASE) + self.data + np.uint64(3)
        return self._hash[n]

    def history(self, n: int) -> np.ndarray:
        """Hash of the n - 1 bytes before each place."""
        return np.concatenate([np.zeros(1, np.uint64), self.grams(n - 1)[:-1]])


def _sums(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, the sum of each class's weights by key, and each row's key."""
    unique, of = np.unique(keys, return_inverse=True)
    return unique, np.stack([np.bincount(of, w, minlength=len(unique)) for w in weights]), of


def _find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Place of each wanted key, or -1."""
    if not len(keys):
        return np.full(len(wanted), -1)
    at = np.searchsorted(keys, wanted)
    at[at == len(keys)] = 0
    return np.where(keys[at] == wanted, at, -1)


def _fit_spelling(s: Spelling, count: np.ndarray, discount: float) -> tuple[list, list, list, list, np.ndarray]:
    """Byte models of two classes from distinct words, each counted count[class, word] times.

    Gives for each order above SHARED its n-grams with their log-ratios and its histories with the log-ratios of their
    backoff weights, and each word's log-likelihood in either class.
    """
    count = count.astype(np.float32)[:, s.word]
    below_keys, below = np.zeros(0, np.uint64), np.zeros((2, 0))
    grams, ratio, histories, back = [], [], [], []
    likely = np.zeros((2, len(s.size)))
    for n in range(1, ORDER + 1):
        own = s.inner >= max(1, n - 1)
        keys, raw, of = _sums(s.grams(n)[own], count[:, own])
        _, at = np.unique(s.grams(n)[own], return_index=True)
        place = np.flatnonzero(own)[at]
        if n < ORDER:  # how many different bytes come before it; at a word's begin nothing does, and its own count holds
            longer = s.inner >= n
            pairs, seen, _ = _sums(s.grams(n + 1)[longer], count[:, longer])
            _, at = np.unique(s.grams(n + 1)[longer], return_index=True)
            ends = s.grams(n)[np.flatnonzero(longer)[at]]
            where = np.searchsorted(keys, ends)
            varied = np.stack([np.bincount(where, x > 0, minlength=len(keys)) for x in seen])
            raw = np.where(s.inner[place] == n - 1, raw, varied)
            del pairs, seen, at, ends, where, varied, longer
        if n <= SHARED:
            raw = np.repeat(raw.sum(0, keepdims=True), 2, axis=0)
        told, of_told, told_of = _sums(s.history(n)[place], raw)
        types_after = np.stack([np.bincount(told_of, x > 0, minlength=len(told)) for x in raw])
        weight = np.where(of_told > 0, discount * types_after / np.maximum(of_told, 1), 1.0)
        lower = np.full((2, len(keys)), 1 / 256)
        if n > 1:
            lower = below[:, np.searchsorted(below_keys, s.grams(n - 1)[place])]
        p = np.maximum(raw - discount, 0) / np.maximum(of_told[:, told_of], 1) + weight[:, told_of] * lower
        below_keys, below = keys, p
        s._hash.pop(n - 1, None)
        if n > SHARED:
            grams.append(keys)
            ratio.append((np.log(p[1]) - np.log(p[0])).astype(np.float32))
            histories.append(told)
            back.append((np.log(weight[1]) - np.log(weight[0])).astype(np.float32))
        # a byte is judged with the longest history that it has
        last = np.minimum(s.inner[own] + 1, ORDER) == n
        for c in (0, 1):
            likely[c] += np.bincount(s.word[own][last], np.log(p[c])[of[last]], minlength=len(s.size))
    return grams, ratio, histories, back, likely


def _pair(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix(first * np.uint64(BASE) + second)


def _before(w: Words) -> np.ndarray:
    """The hash of the word before each, 0 at a text's begin."""
    before = np.concatenate([np.zeros(1, np.uint64), w.hash[:-1]])[: len(w.hash)]
    before[w.at[:-1][np.diff(w.at) > 0]] = 0
    return before


@dataclass
class KneserNey:
    """Log-ratios, class 1 against class 0, of two Kneser-Ney models.

    A word is predicted from the one before it, then from how many words it follows, then from its bytes. Pairs that
    occur once are left to the shorter history. Absent n-grams, words and pairs fall back with the log-ratio of the backoff weights.
    fit() holds all texts at once; counted.text_sums() makes the same models of whole tables.
    """

    grams: list[np.ndarray]
    ratio: list[np.ndarray]
    histories: list[np.ndarray]
    back: list[np.ndarray]
    words: np.ndarray
    spelt: np.ndarray
    word_back: np.ndarray
    unknown: float
    pairs: np.ndarray
    pair_ratio: np.ndarray
    firsts: np.ndarray
    first_back: np.ndarray

    @classmethod
    def fit(cls, texts: list[str], y: np.ndarray, discount: float = DISCOUNT) -> KneserNey:
        known, blobs, sizes, hashes = np.zeros(0, np.uint64), [], [], []
        tokens, before, label = [], [], []
        for first, last, group in as_texts(texts):
            w = Words(group)
            tokens.append(w.hash)
            before.append(_before(w))
            label.append(np.repeat(y[first:last].astype(bool), np.diff(w.at)))
            types, at = np.unique(w.hash, return_index=True)
            new = _find(known, types) < 0
            types, at = types[new], at[new]
            size = w.end[at] - w.start[at]
            starts = np.concatenate([[0], np.cumsum(size)[:-1]]) if len(size) else size
            blobs.append(group.data[np.arange(size.sum()) - np.repeat(starts, size) + np.repeat(w.start[at], size)])
            sizes.append(size)
            hashes.append(types)
            known = np.union1d(known, types)
        none = np.zeros(0, np.uint64)
        tokens, before, label = (np.concatenate(x) if x else e for x, e in ((tokens, none), (before, none), (label, np.zeros(0, bool))))
        order = np.argsort(np.concatenate(hashes) if hashes else none)
        size = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
        end = np.cumsum(size)
        spelling = Spelling(Texts(np.concatenate(blobs) if blobs else np.zeros(0, np.uint8), np.array([0])), (end - size)[order], end[order])
        # what is as long as the sampled texts goes as soon as it can: a worker's memory is small
        words, of_word = np.unique(tokens, return_inverse=True)
        of_word = of_word.astype(np.int32)
        tokens = _pair(before, tokens)
        order = np.argsort(tokens, kind="stable")
        first = np.flatnonzero(np.concatenate([[True], tokens[order][1:] != tokens[order][:-1]])) if len(order) else np.zeros(0, np.int64)
        pairs, word_of, before_of = tokens[order[first]], of_word[order[first]], before[order[first]]
        del tokens, before
        toxic = label[order].astype(np.int32)
        one = np.add.reduceat(toxic, first) if len(first) else toxic
        seen = np.stack([np.diff(np.concatenate([first, [len(order)]])) - one, one]).astype(np.float32)
        del order, toxic, first, one
        count = np.stack([np.bincount(of_word[label == c], minlength=len(words)) for c in (False, True)])
        del of_word, label
        grams, ratio, histories, back, spelt = _fit_spelling(spelling, count, discount)
        del spelling
        follows = np.stack([np.bincount(word_of, x > 0, minlength=len(words)) for x in seen])
        total = np.maximum(follows.sum(1, keepdims=True), 1)
        kept = np.maximum(follows - discount, 0) / total
        left = 1 - kept.sum(1, keepdims=True)
        p = kept + left * np.exp(spelt)

        firsts, of_first = np.unique(before_of, return_inverse=True)
        told = np.stack([np.bincount(of_first, x, minlength=len(firsts)) for x in seen])
        often = np.flatnonzero(seen.sum(0) > 1)
        pairs, of_first, word_of, seen = pairs[often], of_first[often], word_of[often], seen[:, often]
        share = np.maximum(seen - discount, 0) / np.maximum(told[:, of_first], 1)
        rest = 1 - np.stack([np.bincount(of_first, x, minlength=len(firsts)) for x in share])
        of_pairs = share + rest[:, of_first] * p[:, word_of]
        tell = lambda x: (np.log(x[1]) - np.log(x[0])).astype(np.float32)
        unknown = float(np.log(left[1, 0]) - np.log(left[0, 0])) if len(words) else 0.0
        spelt_ratio = (spelt[1] - spelt[0]).astype(np.float32)
        return cls(grams, ratio, histories, back, words, spelt_ratio, tell(p) - spelt_ratio, unknown, pairs, tell(of_pairs), firsts, tell(rest))

    def spelt_ratios(self, s: Spelling) -> np.ndarray:
        """Log-likelihood ratio of each word's bytes."""
        total = np.zeros(len(s.data))
        open_ = s.inner > 0
        for n in range(ORDER, SHARED, -1):
            k = n - SHARED - 1
            at = np.flatnonzero(open_ & (s.inner >= n - 1))
            found = _find(self.grams[k], s.grams(n)[at])
            hit = found >= 0
            total[at[hit]] += self.ratio[k][found[hit]]
            open_[at[hit]] = False
            rest = at[~hit]
            told = _find(self.histories[k], s.history(n)[rest])
            total[rest[told >= 0]] += self.back[k][told[told >= 0]]
        return np.bincount(s.word, total, minlength=len(s.size))

    def token_ratios(self, w: Words, texts: Texts, known: dict | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Log-likelihood ratio of each word where it stands, and by its spelling alone. known remembers words between calls."""
        keys, at, back = np.unique(w.hash, return_index=True, return_inverse=True)
        known = {} if known is None else known
        old, value = known.get("keys", self.words), known.get("value", self.spelt)
        place = _find(old, keys)
        new = np.flatnonzero(place < 0)
        spelt = np.empty(len(keys))
        spelt[place >= 0] = value[place[place >= 0]]
        spelt[new] = self.spelt_ratios(Spelling(texts, w.start[at[new]], w.end[at[new]]))
        if len(old) > REMEMBERED + len(self.words):
            known["keys"], known["value"] = self.words, self.spelt
        else:
            where = np.searchsorted(old, keys[new])
            known["keys"], known["value"] = np.insert(old, where, keys[new]), np.insert(value, where, spelt[new])
        if not len(self.words):
            return spelt[back], spelt[back]
        word, before = _find(self.words, keys), _before(w)
        alone = (spelt + np.where(word >= 0, self.word_back[word], self.unknown))[back]
        pair, first = _find(self.pairs, _pair(before, w.hash)), _find(self.firsts, before)
        alone = alone + np.where(first >= 0, self.first_back[first], 0)
        return np.where(pair >= 0, self.pair_ratio[pair], alone) if len(self.pairs) else alone, spelt[back]

    def ratios(self, texts: Texts, known: dict | None = None) -> np.ndarray:
        """Means over a text's words: of the log-likelihood ratio, of its part that spelling makes, and of what of that exceeds each EVIDENCE; 0 without words."""
        w = Words(texts)
        whole, spelt = self.token_ratios(w, texts, known)
        columns = []
        for each in (whole, spelt, *[np.maximum(spelt - least, 0) for least in EVIDENCE]):
            total = np.concatenate([[0], np.cumsum(each)])
            columns.append((total[w.at[1:]] - total[w.at[:-1]]) / np.maximum(np.diff(w.at), 1))
        return np.column_stack(columns)


def text_hash() -> Column:
    """What scores are kept by: equal texts score alike, null as empty ones."""
    return F.xxhash64(F.lit(SEED), F.coalesce("text", F.lit("")))


def _labelled(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame | None, int]:
    """label, aside and text of every labelled document outside the held-out fold, each id with its least text, and their number; None if a class lacks rows to count or to calibrate by."""
    known = known_labels(labels, "toxic").withColumn("aside", F.pmod(F.xxhash64(F.lit(SEED), "doc_id"), F.lit(4)) == 3)
    known = materialise(known, "labels")
    known = F.broadcast(known) if known.count() <= BROADCAST_IDS else known
    each = docs.select("doc_id").join(known, "doc_id").groupBy("doc_id", "label", "aside").count()
    found = each.groupBy("label", "aside").agg(F.count("*").alias("n"), F.count_if(F.col("count") > 1).alias("again")).collect()
    if len(found) < 4:
        return None, 0
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(known, "doc_id")
    if any(r.again for r in found):
        again = each.filter("count > 1").select("doc_id")
        least = rows.join(again, "doc_id", "left_semi").groupBy("doc_id", "label", "aside").agg(F.min("text").alias("text"))
        rows = rows.join(again, "doc_id", "left_anti").unionByName(least)
    return rows.select("label", "aside", "text"), sum(r.n for r in found)


@lean
def _calibrated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The line of all rows of x0 to x3 and label."""
    parts = [np.column_stack([c.to_numpy(zero_copy_only=False) for c in b.columns]) for b in batches if len(b)]
    if parts:
        rows = np.concatenate(parts)
        rows = rows[np.lexsort(rows.T)]
        line = calibrate(rows[:, :-1], rows[:, -1], np.ones(len(rows)))
        yield pa.RecordBatch.from_arrays([pa.array([line.tolist()], pa.list_(pa.float64()))], ["line"])


def score_texts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """text_hash() and score, in 0 to 1, of every distinct text of docs; see score_toxicity()."""
    from veilframe.llm.counted import text_sums  # which is built on this module

    texts = docs.select(text_hash().alias("text_hash"), "text")
    with passing() as keep, shuffles_freed(docs.sparkSession):
        rows, n = _labelled(docs, labels)
        if rows is None:
            return texts.select("text_hash", F.lit(0.0).alias("score")).distinct()
        sums = text_sums(texts, rows.filter(~F.col("aside")), n)
        asides = rows.filter("aside").select(text_hash().alias("text_hash"), F.col("label").cast("double").alias("label"))
        columns = [f"x{i}" for i in range(2 + len(EVIDENCE))]
        line = asides.join(sums, "text_hash").select(*columns, "label").repartition(1).mapInArrow(_calibrated, "line array<double>").collect()[0].line
        x = sum((F.col(c) * F.lit(w) for c, w in zip(columns, line[:-1], strict=True)), F.lit(line[-1]))
        scores = sums.select("text_hash", (1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), x))))).alias("score"))
        return keep(scores, "scores")


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out and score in 0 to 1 of every row of docs; higher is likelier toxic.

    docs has doc_id and text, labels has doc_id and toxic. Only the text is scored: by the difference of its
    log-likelihoods in both classes per word, and, so that long texts don't drown a few plain expressions, by the means of what
    single words exceed each EVIDENCE by; a logistic line weighs them. Every labelled document outside the held-out fold
    (crc32 of the id mod 5 = 0) is learnt from: the models count three of four, by a hash of the id, and the line is fitted
    to the others. Null labels and null ids are left out; of repeated label rows the largest label counts, of repeated documents
    the least text. Null and empty texts score as texts without evidence; repeated rows score alike; unless both classes are among
    the texts counted and among the others, every score is 0. Other columns are not looked at. An empty table gives an empty result.
    """
    scores = score_texts(docs, labels)
    scores = F.broadcast(scores) if scores.count() <= BROADCAST_IDS else scores
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), text_hash().alias("text_hash"))
    return rows.join(scores, "text_hash").select("doc_id", "held_out", "score")


def op4_toxicity(spark, sf_dir):
    """score_toxicity() of documents by labels, toxic from a score of 0.5."""
    scored = score_toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))
