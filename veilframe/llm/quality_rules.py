"""Quality rules under weak supervision.

Each rule looks at one statistic of a document and votes good, votes bad or abstains.
Expectation-maximisation over the counts of vote patterns estimates how often each rule is right,
and the posterior probability of a pattern decides for all documents that show it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilframe.llm.shared import documents, materialise, small_batches
from veilframe.llm.words import Texts, Words, groups, lean

REPEAT_WINDOW = 8
MIN_WORDS = 20
STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_ended_lines", "n_capitals", "n_letters", "n_exclamations", "n_distinct_words"]
#: Rule: statistic as SQL, at or below which it votes good (None: it never does), and above which it votes bad;
#: between them it abstains. A statistic that is null, as a share of nothing, is an abstention.
RULES = {
    "few words": ("-n_words", -50, -20),
    "unfinished lines": ("1 - n_ended_lines / nullif(n_lines, 0)", 0.50, 0.85),
    "few different words": ("-n_distinct_words / nullif(n_words, 0)", -0.25, -0.10),
    "long words": ("word_chars / nullif(n_words, 0)", None, 14.0),
    "short words": ("-word_chars / nullif(n_words, 0)", None, -2.0),
    "symbols": ("n_symbols / nullif(n_words, 0)", None, 0.10),
    "repeated lines": ("n_dup_lines / nullif(n_lines, 0)", None, 0.30),
    "repeated words": ("n_repeat_words / nullif(n_words, 0)", None, 0.30),
    "capitals": ("n_capitals / nullif(n_letters, 0)", None, 0.50),
    "exclamations": ("n_exclamations / nullif(n_words, 0)", None, 0.20),
}
#: An alarm is taken to go off on at most this share of the good documents.
MISFIRE = 0.01
#: First guesses of the share of bad and of good documents on which a rule votes bad, and votes good.
GUESS = {1: (0.3, 0.005), 2: (0.7, 0.9)}
GUESS_WEIGHT = 10.0
_SYMBOLS = np.isin(np.arange(256), [ord(c) for c in "#*$%&|<>"])
_ENDS = np.isin(np.arange(256), [ord(c) for c in ".!?\"')"])


def text_statistics(texts: Texts) -> dict[str, np.ndarray]:
    """STATS of each text. Lines are those with a word; a line repeats if an earlier one is equal."""
    w, data, n = Words(texts, lower=False), texts.data, len(texts)
    per_text = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags)])[texts.offsets])
    of_word = np.repeat(np.arange(n), np.diff(w.at))
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    small = data | 32
    letters = (small >= 97) & (small <= 122)

    newline = np.flatnonzero(data == 10)
    begin = np.union1d(texts.offsets[:-1], newline + 1)
    begin = begin[begin < len(data)]
    end = np.concatenate([begin[1:], [len(data)]])[: len(begin)]
    end = end - (data[np.maximum(end - 1, 0)] == 10)
    first, last = np.searchsorted(w.start, begin), np.searchsorted(w.start, end)
    begin, end, last = begin[last > first], end[last > first], last[last > first]
    of_line = np.searchsorted(texts.offsets, begin, "right") - 1
    lines = np.bincount(of_line, minlength=n)
    key = of_line.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    different = np.bincount(of_line[np.unique(w.span_hash(begin, end) ^ key, return_index=True)[1]], minlength=n)
    ended = np.bincount(of_line, _ENDS[data[w.end[last - 1] - 1]], minlength=n)

    grams, at = w.ngrams(REPEAT_WINDOW)
    of_gram = np.repeat(np.arange(n), np.diff(at))
    _, same, count = np.unique(grams ^ (of_gram.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)), return_inverse=True, return_counts=True)
    place = np.arange(len(grams)) - at[of_gram] + w.at[of_gram]
    place = place[count[same] > 1]
    cover = np.bincount(place, minlength=len(w.hash) + 1) - np.bincount(place + REPEAT_WINDOW, minlength=len(w.hash) + 1)
    distinct = np.unique(w.hash ^ (of_word.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)), return_index=True)[1]
    return {
        "n_words": np.diff(w.at),
        "word_chars": np.bincount(of_word, points[w.end] - points[w.start], minlength=n),
        "n_symbols": per_text(_SYMBOLS[data]),
        "n_dup_lines": lines - different,
        "n_repeat_words": np.bincount(of_word, np.cumsum(cover)[: len(w.hash)] > 0, minlength=n),
        "n_lines": lines,
        "n_ended_lines": ended,
        "n_capitals": per_text(letters & (data < 97)),
        "n_letters": per_text(letters),
        "n_exclamations": per_text(data == 33),
        "n_distinct_words": np.bincount(of_word[distinct], minlength=n),
    }


def votes(statistic: str, good: float | None, bad: float):
    """2 for good, 1 for bad, 0 for an abstention."""
    first = "" if good is None else f"WHEN {statistic} <= {good} THEN 2 "
    return F.expr(f"CASE {first}WHEN {statistic} > {bad} THEN 1 ELSE 0 END")


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 300) -> tuple[np.ndarray, dict[int, np.ndarray], float]:
    """Posterior of good for each vote pattern, each rule's vote rates on bad and good documents, and the share of good ones.

    A rule's accuracy is its pair of rates: a vote, and an abstention, weighs as the ratio in which
    good and bad documents draw it. The first posterior is low where a rule votes bad. Rates
    are pulled towards GUESS as by GUESS_WEIGHT documents, so a rule that never votes, or a small
    table, gives no certainty. The maximisation is bound in two ways: an alarm's rate on good documents is MISFIRE at
    most, or else the rarer class would take the part of the good one, and a rule that never votes good has no rate for it.
    """
    votes_good = (patterns == 2).any(axis=0)
    post = np.where((patterns == 1).any(axis=1), 0.05, 0.95)
    rate, share = {}, 0.8
    for _ in range(rounds):
        mass = np.stack([counts * (1 - post), counts * post])
        for vote, guess in GUESS.items():
            rate[vote] = (mass @ (patterns == vote) + GUESS_WEIGHT * np.array(guess)[:, None]) / (mass.sum(1, keepdims=True) + GUESS_WEIGHT)
        rate[1][1] = np.minimum(rate[1][1], MISFIRE)
        rate[2][:, ~votes_good] = 1e-6
        share = float((mass[1].sum() + 8) / (counts.sum() + 10))
        odds = np.full(len(counts), np.log(share) - np.log(1 - share))
        rate[0] = np.maximum(1 - rate[1] - rate[2], 1e-6)
        for vote, (bad, good) in rate.items():
            odds = odds + (patterns == vote) @ (np.log(good) - np.log(bad))
        new = 1 / (1 + np.exp(-np.clip(odds, -50, 50)))
        done, post = np.abs(new - post).max(initial=0) < 1e-9, new
        if done:
            break
    return post, rate, share


def apply_rules(docs: DataFrame, *, rules: dict = RULES, threshold: float = 0.5) -> DataFrame:
    """Statistics, base_failed, posterior and kept of every row of docs (doc_id, text).

    base_failed: fewer than MIN_WORDS words, or more than 30 % of them in repeated windows. The
    rules' rates are estimated over the others, and those are kept if the posterior reaches threshold. Null and empty texts have no words and fail;
    repeated rows count and are judged each; other columns are not looked at; an empty table
    gives an empty result. Vote patterns (at most 3 to the number of rules) are all that reaches
    the driver.
    """

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts = [text_statistics(t) for _, _, t in groups(b.column(1))]
            columns = [pa.array(np.concatenate([p[k] for p in parts]) if parts else [], pa.int64(), safe=False) if parts else pa.array([], pa.int64()) for k in STATS]
            yield pa.RecordBatch.from_arrays([b.column(0), *columns], ["doc_id", *STATS])

    small_batches(docs.sparkSession)
    given = docs.select("doc_id", "text")
    schema = f"doc_id {given.schema['doc_id'].dataType.simpleString()}, " + ", ".join(f"{k} long" for k in STATS)
    code = sum((votes(*rule).cast("long") * 3**i for i, rule in enumerate(rules.values())), F.lit(0).cast("long"))
    measured = materialise(given.mapInArrow(run, schema).withColumn("pattern", code), "statistics")
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)
    seen = measured.groupBy("pattern").agg(F.count_if(~failed).alias("count")).collect()
    pattern = np.array([r["pattern"] for r in seen], np.int64)
    cast = np.stack([pattern // 3**i % 3 for i in range(len(rules))], axis=1)
    post, _, _ = estimate(cast, np.array([r["count"] for r in seen], float))
    table = docs.sparkSession.createDataFrame([(int(p), float(q)) for p, q in zip(pattern, post, strict=True)], "pattern long, posterior double")
    judged = measured.join(F.broadcast(table), "pattern").drop("pattern").withColumn("base_failed", failed)
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= threshold))


def op6_quality_rules(spark, sf_dir):
    """apply_rules() of documents: the verdict on each row, with the posterior that led to it."""
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "posterior"]
    return apply_rules(documents(spark, sf_dir)).select(*columns)
