"""Secret scans: known shapes by pattern, and unknown ones by a battery of randomness tests.

Patterns find assignments, access keys and long hexadecimal runs. The method then looks at the
other long tokens. Each is given the smallest encoding whose alphabet holds it, and five
statistics that are near standard normal for random tokens of its length: the chi-squared uniformity
of its symbols, the number of runs of symbols above and below the alphabet's middle, the
serial correlation of neighbouring symbols, the shares of digits, capitals, small letters and marks,
and how often these change. The null hypothesis is an ordinary token: natural language and
identifiers miss the targets by an amount that grows with length. How far is first set by NATURAL,
then fitted to the tokens of that encoding and length in the table, less the part that random tokens
explain; the p-value is the greater one of both. Benjamini-Hochberg holds the share of false
discoveries down within each class of encoding and length. The main path is DataFrame expressions.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilframe.llm.shared import documents, materialise

KEYWORD = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: Kind: pattern, the group that is measured, and its least length. A pattern takes as much as it can, and what is too short is dropped.
#: A run of 32 or more begins where no run goes on, so only there is it looked for.
BASE = {"assign": (KEYWORD, 2, 8), "access": (r"AKIA[A-Z0-9]+", 0, 16), "hex": (r"(?<![0-9a-f])[0-9a-f]{32,}", 0, 32)}
CANDIDATE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}"
#: Encodings, the smallest first: characters in order of their values, and how far natural tokens are from random, per symbol:
#: the excess of chi-squared, and what the classes of symbols add.
ENCODINGS = {
    "hex": ("0123456789abcdef", 0.60, 1.0),
    "HEX": ("0123456789ABCDEF", 0.60, 1.0),
    "base32": ("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 0.95, 0.0),
    "base62": ("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", 2.0, 0.35),
    "base64": ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", 2.0, 0.35),
    "base64url": ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_", 2.0, 0.35),
    "mixed": ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_", 2.0, 0.35),
}
CLASSES = ("[0-9]", "[A-Z]", "[a-z]", "[+/_-]")
FALSE_DISCOVERIES = 0.01
#: Natural tokens: the standard deviation of the logarithm of a departure's root, and as how many tokens it counts in the fit.
NATURAL, PRIOR = 0.22, 20
#: Random tokens of 20 to 100 characters: quantiles of the root of the departure.
RANDOM = ((0.05, 0.0), (0.6, 0.01), (1.2, 0.1), (1.6, 0.25), (2.1, 0.5), (2.65, 0.75), (3.3, 0.9), (3.75, 0.95), (4.7, 0.99), (5.6, 0.999), (8.0, 1.0))
#: Logarithms of roots are counted in cells of this width, lengths in this many classes for each power of two.
CELL, CELLS, FINE = 0.02, 500, 8
_INNER = 256


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of value, with value computed once however often body mentions it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _prefix_sums(lengths: Column) -> Column:
    """Running totals of an array of lengths, each before its own, in two levels so that long arrays stay cheap."""
    total = lambda a: F.aggregate(a, F.lit(0), lambda s, x: s + x)
    running = lambda a, start: F.aggregate(a, F.struct(F.array().cast("array<int>").alias("out"), start.alias("at")), lambda s, x: F.struct(F.array_append(s.out, s.at).alias("out"), (s.at + x).alias("at"))).getField("out")
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / _INNER).cast("int")), lambda b: F.slice(lengths, b * _INNER + 1, _INNER))
    return let(blocks, lambda b: F.flatten(F.zip_with(b, running(F.transform(b, total), F.lit(0)), running)))


def find_all(text: Column, pattern: str, group: int = 0) -> Column:
    """Leftmost non-overlapping matches: array of (start, end, part, the size of the group) in code points, end exclusive.

    What lies between matches is found by split(), which cuts at the same places.
    """
    p = F.lit(pattern)
    sizes = lambda g: F.transform(F.regexp_extract_all(text, p, F.lit(g)), F.char_length)
    gaps = F.transform(F.split(text, pattern, -1), F.char_length)
    steps = F.zip_with(sizes(0), sizes(group) if group else F.array().cast("array<int>"), lambda s, part: F.struct(s.alias("size"), (part if group else s).alias("part")))
    steps = F.zip_with(steps, gaps, lambda s, gap: F.struct(gap.alias("gap"), s["size"].alias("size"), s["part"].alias("part")))
    steps = F.filter(steps, lambda s: s["size"].isNotNull())  # after the last match there is one more gap
    placed = let(steps, lambda x: F.zip_with(x, _prefix_sums(F.transform(x, lambda s: s["gap"] + s["size"])), lambda s, at: F.struct((at + s["gap"]).alias("start"), (at + s["gap"] + s["size"]).alias("end"), s["part"].alias("part"))))
    return F.when(F.rlike(text, p), placed).otherwise(F.array().cast("array<struct<start:int,end:int,part:int>>"))


def _battery(token: Column, alphabet: str) -> Column:
    """How far a token departs from random: the sum of the squares of its statistics."""
    k, n = float(len(alphabet)), F.char_length(token).cast("double")
    values = F.transform(F.split(token, ""), lambda c: F.instr(F.lit(alphabet), c).cast("double") - 1)
    values = F.filter(values, lambda v: v >= 0)
    squares = F.aggregate(F.array(*[F.lit(c) for c in alphabet]), F.lit(0.0), lambda s, c: s + F.pow(n - F.char_length(F.replace(token, c)), F.lit(2.0)))
    chi = squares * k / n - n
    z_chi = (chi - (k - 1)) / F.sqrt(2 * (k - 1) * (n - 1) / n)
    shares = [sum(re.fullmatch(c, x) is not None for x in alphabet) / k for c in CLASSES]
    counts = [(F.regexp_count(token, F.lit(c)).cast("double"), q) for c, q in zip(CLASSES, shares, strict=True) if q]
    classes = sum((F.pow(c - n * q, F.lit(2.0)) / (n * q) for c, q in counts), F.lit(0.0))
    same, thrice = sum(q**2 for q in shares), sum(q**3 for q in shares)
    changes = F.regexp_count(token, F.lit("|".join(f"{c}+" for c in CLASSES))).cast("double") - 1
    z_changes = (changes - (n - 1) * (1 - same)) / F.sqrt((n - 1) * (same * (1 - same)) + (n - 2) * (2 * (thrice - same**2)))
    middle = (k - 1) / 2
    folding = F.aggregate(
        values,
        F.struct(*[F.lit(0.0).alias(x) for x in ("runs", "high", "s", "s2", "lag")], F.lit(-1.0).alias("last"), F.lit(-1.0).alias("first")),
        lambda a, v: F.struct(
            (a.runs + F.when((a["last"] < 0) | ((a["last"] > middle) != (v > middle)), 1.0).otherwise(0.0)).alias("runs"),
            (a.high + F.when(v > middle, 1.0).otherwise(0.0)).alias("high"),
            (a.s + v).alias("s"), (a.s2 + v * v).alias("s2"), (a.lag + F.when(a["last"] < 0, 0.0).otherwise(a["last"] * v)).alias("lag"),
            v.alias("last"), F.when(a["first"] < 0, v).otherwise(a["first"]).alias("first"),
        ),
    )

    def judge(folded: Column) -> Column:
        high, low = folded.high, n - folded.high
        pairs = 2 * high * low
        mean = pairs / n + 1
        spread = pairs * (pairs - n) / (n * n * (n - 1))
        z_runs = F.when(spread > 0, (folded.runs - mean) / F.sqrt(spread)).otherwise(F.sqrt(n))
        around = folded.s2 / n - F.pow(folded.s / n, F.lit(2.0))
        serial = (folded.lag + folded["last"] * folded["first"]) / n - F.pow(folded.s / n, F.lit(2.0))
        z_serial = F.when(around > 0, (serial / around + 1 / (n - 1)) * F.sqrt(n)).otherwise(F.sqrt(n))
        return F.pow(F.greatest(z_chi, F.lit(0.0)), F.lit(2.0)) + F.pow(z_runs, F.lit(2.0)) + F.pow(z_serial, F.lit(2.0)) + classes + F.pow(z_changes, F.lit(2.0))

    return let(folding, judge)


def _candidates(text: Column, found: Column, taken: Column) -> Column:
    """Of found tokens, those outside base spans: (start, end, encoding, length class, cell of the departure).

    A token that is one case of letters only, or digits only, is a word or a number and is no candidate.
    """
    free = F.filter(found, lambda c: ~F.exists(taken, lambda t: (t.start < c.end) & (c.start < t.end)))
    with_token = F.transform(free, lambda c: F.struct(c.start.alias("start"), c.end.alias("end"), F.rtrim(F.substring(text, c.start + 1, c.end - c.start), F.lit("=")).alias("token")))
    mixed = F.filter(with_token, lambda c: ~F.rlike(c.token, F.lit(r"^([A-Z]?[a-z/_-]*|[A-Z/_-]*|[0-9/_-]*)$")))

    def judged(c):
        fits = lambda a: F.translate(c.token, a, "") == ""
        code, score = None, None
        for i, (alphabet, *_) in enumerate(ENCODINGS.values()):
            here, departure = fits(alphabet), _battery(c.token, alphabet)
            code = F.when(here, i) if code is None else code.when(here, i)
            score = F.when(here, departure) if score is None else score.when(here, departure)
        length = F.floor(F.log2(F.char_length(c.token)) * FINE + 1e-9).cast("int")
        cell = F.floor(F.log(F.greatest(score, F.lit(0.01))) / (2 * CELL))
        return F.struct(c.start.alias("start"), c.end.alias("end"), code.alias("encoding"), length.alias("length"), F.least(cell, F.lit(CELLS)).cast("int").alias("cell"))

    none = F.array().cast("array<struct<start:int,end:int,encoding:int,length:int,cell:int>>")
    return F.when(F.size(found) > 0, F.transform(mixed, judged)).otherwise(none)


def _natural(encoding: int, length: int) -> float:
    """Logarithm of the root of a natural token's departure, for the shortest of its length class."""
    alphabet, excess, classes = list(ENCODINGS.values())[encoding]
    n = math.ceil(2 ** (length / FINE) - 1e-9)
    return math.log(3 + n * classes + (n * excess) ** 2 / (2 * (len(alphabet) - 1))) / 2


def _lower(z: np.ndarray) -> np.ndarray:
    return np.array([math.erfc(-x / math.sqrt(2)) / 2 for x in z])


def _p_values(natural: np.ndarray, cells: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The p-value of each cell of a class: how likely an ordinary token comes as near to random.

    Ordinary tokens are normal around natural, or around what expectation-maximisation finds for the
    tokens of the table when it mixes a normal with random tokens, whichever says the token is likelier.
    """
    high = (cells + 1) * CELL
    x = high - CELL / 2 - natural
    roots, shares = np.log([r for r, _ in RANDOM]), [q for _, q in RANDOM]
    random = np.maximum(np.interp(high, roots, shares) - np.interp(high - CELL, roots, shares), 1e-9)
    mean, spread, part = 0.0, NATURAL, 0.5
    for _ in range(200):
        ordinary = (1 - part) * CELL * np.exp(-(((x - mean) / spread) ** 2) / 2) / (spread * math.sqrt(2 * math.pi))
        own = counts * ordinary / np.maximum(ordinary + part * random, 1e-300)
        mean = (own @ x) / (own.sum() + PRIOR)
        spread = math.sqrt((own @ (x - mean) ** 2 + PRIOR * (NATURAL**2 + mean**2)) / (own.sum() + PRIOR))
        part = (counts.sum() - own.sum() + 1) / (counts.sum() + 2)
    return np.maximum(_lower((high - natural) / NATURAL), _lower((high - natural - mean) / spread))


def _thresholds(scanned: DataFrame, rate: float) -> dict[tuple[int, int], int]:
    """Greatest cell that is a discovery, for each encoding and length class.

    Benjamini-Hochberg over counts, for each encoding and power of two: the classes and cells are few
    whatever the data, so the counts go to the driver.
    """
    found: dict[tuple[int, int], list] = {}
    rows = scanned.select(F.explode("candidates").alias("c")).groupBy("c.encoding", "c.length", "c.cell").count()
    for r in rows.collect():
        found.setdefault((r.encoding, r.length // FINE), []).append((r.length, r.cell, r["count"]))
    greatest: dict[tuple[int, int], int] = {}
    for (encoding, _), cells in found.items():
        length, cell, count = np.array(sorted(cells)).T
        p = _p_values(np.array([_natural(encoding, n) for n in length.tolist()]), cell, count)
        order = np.argsort(p, kind="stable")
        # tokens of equal p-values are discovered together
        below = np.cumsum(count[order])[np.searchsorted(p[order], p[order], side="right") - 1]
        good = p[order] * count.sum() <= rate * below
        if good.any():
            for n, c, x in zip(length.tolist(), cell.tolist(), p.tolist(), strict=True):
                if x <= p[order][good].max():
                    greatest[encoding, n] = max(c, greatest.get((encoding, n), c))
    return greatest


def scan(docs: DataFrame, *, keep: tuple[str, ...] = (), false_discoveries: float = FALSE_DISCOVERIES) -> DataFrame:
    """doc_id, the columns named in keep, and spans: array of (kind, start, end) of each row's secrets.

    Kinds are those of BASE and random, the tokens that the battery adds; none of these overlaps a
    base span. Spans count code points, end exclusive, ordered by start, then kind as listed.
    A token of the battery has 20 or more characters of CANDIDATE's and is neither digits and marks only nor, but for a first
    capital, letters of one case and marks only: shorter ones show too little, and the others are numbers and words.
    Null and empty texts have no spans. Repeated rows are scanned each; an empty table gives an empty result. The number of tokens in a
    class, over the whole table, sets how small a p-value must be, so a result depends on all rows.
    """
    scanned = materialise(_scanned(docs, ()), "scanned")
    greatest = _thresholds(scanned, false_discoveries)
    passes = lambda c: F.lit(False)
    if greatest:
        table = F.create_map(*[F.lit(x) for (e, n), cell in greatest.items() for x in (e * 1000 + n, cell)])
        passes = lambda c: F.coalesce(c.cell <= F.try_element_at(table, c.encoding * 1000 + c.length), F.lit(False))
    labelled = [_ranked(F.col(f"_{kind}"), i) for i, kind in enumerate(BASE)]
    random = _ranked(F.filter("candidates", passes), len(BASE))
    kinds = F.array(*[F.lit(k) for k in (*BASE, "random")])
    spans = F.transform(F.array_sort(F.concat(*labelled, random)), lambda s: F.struct(F.get(kinds, s["rank"]).alias("kind"), s.start.alias("start"), s.end.alias("end")))
    # columns that are carried, such as texts, are not written: with known thresholds the scan is repeated
    return (_scanned(docs, keep) if keep else scanned).select("doc_id", *keep, spans.alias("spans"))


def _scanned(docs: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """Base spans by kind and candidates of every row."""
    text = F.coalesce("text", F.lit(""))
    base = docs.select("doc_id", *keep, text.alias("_text"), *[_long_enough(find_all(text, p, g), least).alias(f"_{kind}") for kind, (p, g, least) in BASE.items()], find_all(text, CANDIDATE).alias("_found"))
    taken = F.concat(*[F.col(f"_{k}") for k in BASE])
    return base.withColumn("candidates", _candidates(F.col("_text"), F.col("_found"), taken)).drop("_text", "_found")


def _long_enough(found: Column, least: int) -> Column:
    return F.transform(F.filter(found, lambda s: s.part >= least), lambda s: F.struct(s.start.alias("start"), s.end.alias("end")))


def _ranked(spans: Column, rank: int) -> Column:
    return F.transform(spans, lambda s: F.struct(s.start.alias("start"), F.lit(rank).alias("rank"), s.end.alias("end")))


def redact(text: Column, spans: Column, mask: str = "[SECRET]") -> Column:
    """The text with each span, or each chain of overlapping spans, replaced by mask."""
    state = F.struct(F.array().cast("array<string>").alias("out"), F.lit(0).alias("at"))
    folded = F.aggregate(spans, state, lambda a, s: F.when(s.start >= a["at"], F.struct(F.concat(a.out, F.array(F.substring(text, a["at"] + 1, s.start - a["at"]), F.lit(mask))).alias("out"), s.end.alias("at"))).otherwise(F.struct(a.out.alias("out"), F.greatest(a["at"], s.end).alias("at"))))  # noqa: E501
    whole = F.array_join(F.concat(folded.out, F.array(F.substring(text, folded["at"] + 1, F.char_length(text)))), "")
    return F.when(F.size(spans) > 0, whole).otherwise(text)


def digest(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")


def op1_secret_scan(spark, sf_dir):
    """scan() of documents, with the numbers of base spans by kind and their digest. Null and empty texts have none and the digest of nothing."""
    found = scan(documents(spark, sf_dir))
    of = lambda kind: F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long")
    return found.select(
        "doc_id", *[of(k).alias(f"n_{k}") for k in BASE], F.sha2(digest(F.filter("spans", lambda s: s.kind != "random")), 256).alias("base_sha256"), digest(F.col("spans")).alias("spans")
    )
