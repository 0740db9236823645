"""Mixing sources to target weights by min-cost flow over membership patterns.

Documents are aggregated by the set of sources they belong to. A flow network routes each
pattern's words to its sources' quotas; a pattern's second pass costs more than its first, so
repetition happens only where a quota needs it. The flow gives each pattern a length on the line
of its documents in seeded order, and documents are taken along that line.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from veilframe.llm.shared import documents, join_hot, materialise, n_words

WEIGHTS = (3, 1, 2)
SHARE = Fraction(3, 2)
REPEATS = 2
MAX_PATTERNS = 20_000
DOCS_PER_CELL = 1_000
MAX_CELLS = 1 << 20


def quotas(sizes: Sequence[int], weights: Sequence[int], total: Fraction, cap: int = REPEATS) -> list[Fraction]:
    """Split total by weight; what exceeds cap times a size is shared anew among the others."""
    given: list[Fraction | None] = [None] * len(sizes)
    while True:
        free = [i for i, x in enumerate(given) if x is None]
        left = total - sum((x for x in given if x is not None), Fraction(0))
        weight = sum(weights[i] for i in free)
        share = {i: left * weights[i] / weight for i in free}
        above = [i for i in free if share[i] > cap * sizes[i]]
        if not above:
            return [share[i] if x is None else x for i, x in enumerate(given)]
        for i in above:
            given[i] = Fraction(cap * sizes[i])


class FlowNetwork:
    """Min-cost flow by the primal-dual method: blocking flows over the arcs of reduced cost zero."""

    def __init__(self, n: int) -> None:
        self.out: list[list[int]] = [[] for _ in range(n)]
        self.to: list[int] = []
        self.room: list[int] = []
        self.cost: list[int] = []

    def arc(self, a: int, b: int, room: int, cost: int = 0) -> int:
        for x, y, r, c in ((a, b, room, cost), (b, a, 0, -cost)):
            self.out[x].append(len(self.to))
            self.to.append(y)
            self.room.append(r)
            self.cost.append(c)
        return len(self.to) - 2

    def _distances(self, s: int) -> list[float]:
        dist, queued, queue = [float("inf")] * len(self.out), [False] * len(self.out), deque([s])
        dist[s] = 0
        while queue:
            a = queue.popleft()
            queued[a] = False
            for e in self.out[a]:
                b = self.to[e]
                if self.room[e] and dist[a] + self.cost[e] < dist[b]:
                    dist[b] = dist[a] + self.cost[e]
                    if not queued[b]:
                        queued[b] = True
                        queue.append(b)
        return dist

    def run(self, s: int, t: int) -> int:
        flow = 0
        while (dist := self._distances(s))[t] < float("inf"):
            tight = lambda e, a: self.room[e] and dist[a] + self.cost[e] == dist[self.to[e]]
            while True:
                level = [-1] * len(self.out)
                level[s], queue = 0, deque([s])
                while queue:
                    a = queue.popleft()
                    for e in self.out[a]:
                        if level[self.to[e]] < 0 and tight(e, a):
                            level[self.to[e]] = level[a] + 1
                            queue.append(self.to[e])
                if level[t] < 0:
                    break
                at, path = [0] * len(self.out), []
                while True:
                    a = self.to[path[-1]] if path else s
                    if a == t:
                        step = min(self.room[e] for e in path)
                        for e in path:
                            self.room[e] -= step
                            self.room[e ^ 1] += step
                        flow += step
                        path = path[: next(i for i, e in enumerate(path) if not self.room[e])]
                        continue
                    while at[a] < len(self.out[a]):
                        e = self.out[a][at[a]]
                        if level[self.to[e]] == level[a] + 1 and tight(e, a):
                            path.append(e)
                            break
                        at[a] += 1
                    else:
                        if not path:
                            break
                        at[self.to[path.pop() ^ 1]] += 1
        return flow


def route(patterns: Sequence[tuple[tuple, int]], wanted: dict, repeats: int = REPEATS) -> list[dict]:
    """For each (member sources, words) pattern, the words that go to each of its sources."""
    sources = {x: j for j, x in enumerate(wanted)}
    s, t, first = 0, 1 + len(patterns) + len(sources), 1 + len(patterns)
    net, arcs = FlowNetwork(t + 1), []
    for i, (members, words) in enumerate(patterns):
        for r in range(repeats):
            net.arc(s, 1 + i, words, r)
        arcs.append({x: net.arc(1 + i, first + sources[x], repeats * words) for x in members})
    for x, j in sources.items():
        net.arc(first + j, t, int(wanted[x]))
    net.run(s, t)
    return [{x: net.room[e ^ 1] for x, e in own.items()} for own in arcs]


def mix_sources(
    docs: DataFrame, *, members: str | None = None, weights: Sequence[int] = WEIGHTS, share: Fraction = SHARE,
    repeats: int = REPEATS, seed: int = 17, keep: str | None = None,
) -> DataFrame:
    """Choose documents so that each source's words meet its target.

    docs has doc_id, text and either source or, named by members, an array of source names for
    documents that belong to several. Returns every input row's doc_id, its members, size (words),
    copies (0 to repeats), taken (copies * size) and allocation, the source each copy counts for.
    Null text has size 0 and is never taken; a null source is a source of its own, the last in
    order; a null or empty members array belongs to no source and is not taken. Repeated rows are
    separate documents that lie one behind another, so a target may take some of them; which does not
    show unless their other columns differ. Of other columns only the one named keep is passed on; for that docs is
    read twice, and of equal rows the right number is taken if both give the same order, as tables do. An
    empty table gives an empty result. mix_with_targets() adds the targets.

    Up to MAX_PATTERNS distinct membership patterns are routed on the driver. Beyond, documents with one
    source each need no flow, as a source's only pattern gives what it asks for: any number of sources is
    worked on as a table. Only more than MAX_PATTERNS patterns of overlapping sources raise an error.
    """
    return _mixed(docs, members, weights, share, repeats, seed, keep)[0]


def mix_with_targets(docs: DataFrame, **options) -> DataFrame:
    """mix_sources() with source_size and target of each document's first source."""
    o = {"members": None, "weights": WEIGHTS, "share": SHARE, "repeats": REPEATS, "seed": 17} | options
    mixed, table = _mixed(docs, o["members"], o["weights"], o["share"], o["repeats"], o["seed"])
    own = mixed.withColumn("source", F.try_element_at("members", F.lit(1)))
    return table(own)


def _sized(docs, members, seed, keep=()):
    of = F.array(F.col("source").cast("string")) if members is None else F.array_sort(F.array_distinct(F.coalesce(F.col(members), F.array().cast("array<string>"))))
    row = F.monotonically_increasing_id().alias("row")
    return docs.select("doc_id", of.alias("members"), n_words(F.col("text")).alias("size"), F.xxhash64(F.lit(seed), "doc_id", F.length("text")).alias("place"), row, *keep)


def _cell():
    """Where on the line of its pattern a document lies: cells are its stretches."""
    return F.pmod(F.shiftrightunsigned("place", 3), F.col("cells").cast("long")).alias("cell")


def _key(row):
    """A document's place on the line of its pattern; row tells equal ones apart."""
    return F.struct(_cell(), F.col("place").alias("place"), F.col("doc_id").alias("doc_id"), F.col("size").alias("size"), row.alias("row"))


def _mixed(docs, members, weights, share, repeats, seed, keep=None):
    """The documents with their allocation, and what adds source_size and target to rows with a source."""
    spark = docs.sparkSession
    sized = materialise(_sized(docs, members, seed), "sizes")
    found = materialise(sized.groupBy("members").agg(F.sum("size").alias("words"), F.count("*").alias("docs")), "patterns")
    total, rows = found.agg(F.sum("words"), F.sum("docs")).first()
    if found.count() <= MAX_PATTERNS:
        plan, ends, targets = _routed(spark, found.collect(), weights, share, repeats)
    elif members is None:
        plan, ends, targets = _one_source_each(found, weights, share * total, repeats)
    else:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns of overlapping sources")
    few = members is not None or found.count() <= MAX_PATTERNS  # then plan and ends have few rows

    def with_plan(x: DataFrame, y: DataFrame) -> DataFrame:
        return x.join(F.broadcast(y), "members") if few else join_hot(x, y, "members", "docs", rows)

    # Equal documents of one partition are one part of the line: it has their words, and knows their rows in order.
    line = with_plan(sized, plan).filter("size > 0").withColumn("cell", _cell())
    line = line.groupBy("pattern", "words", "cell", "place", "doc_id", "size", F.shiftright("row", 33).alias("part")).agg(F.array_sort(F.collect_list("row")).alias("rows"))
    line = materialise(line, "line")
    length = F.col("size") * F.size("rows")
    starts = line.groupBy("pattern", "cell").agg(F.sum(length).alias("cell_words"))
    starts = starts.select("pattern", "cell", (F.sum("cell_words").over(Window.partitionBy("pattern").orderBy("cell")) - F.col("cell_words")).alias("cell_start"))
    within = Window.partitionBy("pattern", "cell").orderBy("place", "doc_id", "size", "part").rowsBetween(Window.unboundedPreceding, 0)
    line = line.join(starts, ["pattern", "cell"]).withColumn("at", F.col("cell_start") + F.sum(length).over(within) - length)
    # A copy counts for the part of the routed length on which the middle of its words lies. Parts lie one
    # after another, so the last key of each part says for every document, wherever it is read, what it gives.
    spots = line.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    spots = spots.join(F.broadcast(ends) if few else ends, "pattern")

    def before(end: str):
        """How many of the equal documents have their middle before an end of a part."""
        beyond = F.col(end) * 2 - F.col("words") * 2 * F.col("copy") - F.col("at") * 2 - F.col("size")
        return F.least(F.greatest(F.expr("0L"), F.ceil(beyond / (F.col("size") * 2))), F.size("rows").cast("long")).cast("int")

    spots = spots.withColumn("n", before("hi")).filter(F.col("n") > before("lo"))
    key = F.struct("cell", "place", "doc_id", "size", F.get("rows", F.col("n") - 1).alias("row"))
    last = spots.groupBy("pattern", "copy", "share", "source").agg(F.max(key).alias("last"))
    bounds = last.groupBy("pattern").agg(F.array_sort(F.collect_list(F.struct("copy", "share", "source", "last"))).alias("bounds"))
    plan = materialise(plan.join(F.broadcast(bounds) if few else bounds, "pattern", "left"), "bounds")
    out = with_plan(_sized(docs, members, seed, (keep,)) if keep else sized, plan).withColumn("key", _key(F.col("row")))

    def gives(copy: int):
        mine = F.filter("bounds", lambda b: (b["copy"] == copy) & (F.col("key") <= b["last"]))
        return F.when(F.col("size") > 0, F.transform(F.slice(mine, 1, 1), lambda b: F.struct((b["copy"] + 1).alias("copy"), b["source"].alias("source"))))

    none = F.array().cast("array<struct<copy:int,source:string>>")
    out = out.withColumn("allocation", F.concat(*[F.coalesce(gives(r), none) for r in range(repeats)])).withColumn("copies", F.size("allocation"))
    out = out.select("doc_id", "members", "size", "copies", (F.col("copies") * F.col("size")).alias("taken"), "allocation", *([keep] if keep else []))

    def with_targets(own: DataFrame) -> DataFrame:
        if few:  # one row for each source
            return own.join(F.broadcast(targets), own.source.eqNullSafe(targets.source), "left").drop(targets.source)
        return join_hot(own, targets, "members", "docs", rows).drop("docs")

    return out, with_targets


def _routed(spark, found, weights, share, repeats) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Targets and routed words of some patterns (members, words, docs), found on the driver.

    Gives the patterns (pattern, members, words, docs, cells), the parts of their lines (pattern, share,
    source, lo, hi), and the targets (source, source_size, target).
    """
    found.sort(key=lambda r: [(x is None, x or "") for x in r.members])
    sizes: dict = {}
    for r in found:
        for x in r.members:
            sizes[x] = sizes.get(x, 0) + r.words
    order = sorted(sizes, key=lambda x: (x is None, x or ""))
    wanted = dict(zip(order, quotas([sizes[x] for x in order], [weights[i % len(weights)] for i in range(len(order))], share * sum(r.words for r in found), repeats), strict=True)) if order else {}
    routed = route([(tuple(r.members), r.words) for r in found], wanted, repeats)
    table, parts = [], []
    for i, (r, to) in enumerate(zip(found, routed, strict=True)):
        table.append((i, list(r.members), r.words, r.docs, min(MAX_CELLS, 1 + r.docs // DOCS_PER_CELL)))
        at = 0
        for k, x in enumerate(r.members):
            parts.append((i, k, x, at, at := at + to[x]))
    plan = spark.createDataFrame(table, "pattern long, members array<string>, words long, docs long, cells int")
    ends = spark.createDataFrame(parts, "pattern long, share int, source string, lo long, hi long")
    return plan, ends, spark.createDataFrame([(x, sizes[x], float(wanted[x])) for x in sizes], "source string, source_size long, target double")


def _one_source_each(found: DataFrame, weights, total: Fraction, repeats: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """_routed() for any number of patterns of one source each, as tables; targets has members and docs instead of source.

    A source is capped if its size is below a limit that depends on its weight alone, so quotas() comes
    down to a few sums for each round.
    """
    source = F.get("members", F.lit(0))
    parts = max(1, found.count() // MAX_PATTERNS)
    ordered = found.repartitionByRange(parts, source.isNull(), source).sortWithinPartitions(source.isNull(), source)
    ordered = materialise(ordered.withColumn("row", F.monotonically_increasing_id()), "ordered")
    part, counts = F.shiftright("row", 33), {}
    for r in ordered.groupBy(part.alias("part")).count().collect():
        counts[r.part] = r["count"]
    first = {p: sum(n for q, n in counts.items() if q < p) for p in counts}  # one for each partition
    index = F.try_element_at(F.create_map(*[F.lit(x) for pair in first.items() for x in pair]), part) + F.expr("row & ((1L << 33) - 1)")
    ordered = ordered.withColumn("pattern", index.cast("long"))
    ordered = ordered.withColumn("weight", F.get(F.array(*[F.lit(w) for w in weights]), (F.col("pattern") % len(weights)).cast("int")))
    limits = dict.fromkeys(set(weights), -1)
    while True:
        capped = F.col("words") <= F.coalesce(*[F.when(F.col("weight") == w, F.lit(x)) for w, x in limits.items()])
        sums = ordered.agg(F.sum(F.when(capped, F.col("words"))).alias("words"), F.sum(F.when(~capped, F.col("weight"))).alias("weight")).first()
        left, weight = total - repeats * (sums.words or 0), sums.weight or 0
        above = {w: max(x, -(-left * w // (weight * repeats)) - 1) if weight else x for w, x in limits.items()}
        if above == limits:
            break
        limits = above
    each = {w: left * w / weight if weight else Fraction(0) for w in limits}
    of_weight = lambda given: F.coalesce(*[F.when(F.col("weight") == w, F.lit(given(x))) for w, x in each.items()])
    wanted = F.when(capped, F.col("words") * repeats)
    out = ordered.select(
        "pattern", "members", "words", "docs", F.least(F.lit(MAX_CELLS).cast("long"), 1 + F.floor(F.col("docs") / DOCS_PER_CELL)).cast("int").alias("cells"), source.alias("source"),
        wanted.otherwise(of_weight(int)).alias("hi"), wanted.cast("double").alias("cap"), of_weight(float).alias("free"),
    )
    out = materialise(out, "routed")
    ends = out.select("pattern", F.lit(0).alias("share"), "source", F.lit(0).cast("long").alias("lo"), "hi")
    targets = out.select("members", "docs", F.col("words").alias("source_size"), F.coalesce("cap", "free").alias("target"))
    return out.select("pattern", "members", "words", "docs", "cells"), ends, targets


def op5_mix_sources(spark, sf_dir):
    """mix_with_targets() of documents, each of which has one source. Rows of a null source share one; documents without words are not taken."""
    return mix_with_targets(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")
