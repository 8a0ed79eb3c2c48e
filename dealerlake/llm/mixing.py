"""Mixing overlapping sources to target weights: a minimum-cost flow over membership patterns, then seeded documents."""

from __future__ import annotations

import heapq
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dealerlake.llm.store import saved

#: No document is taken more often.
REPEATS = 3
#: Hash ranges in which a pattern's documents are counted before single documents are looked at.
RANGES = 65_536


def targets(sizes: Mapping[str | None, int], weights: Mapping[str | None, float], total: float, repeats: int = REPEATS) -> dict[str | None, float]:
    """``total`` shared by weight; a target stops at ``repeats`` times its source's size and the excess is shared again.

    Sources that weigh nothing get nothing, also where the others can't take all.
    """
    out, open_, left = dict.fromkeys(weights, 0.0), {s: w for s, w in weights.items() if w > 0}, float(total)
    while open_:
        level = left / sum(open_.values())
        full = [s for s, w in open_.items() if w * level >= repeats * sizes[s]]
        if not full:
            return out | {s: w * level for s, w in open_.items()}
        for s in full:
            out[s] = float(repeats * sizes[s])
            left = max(0.0, left - out[s])
            del open_[s]
    return out


def flow(patterns: Mapping[tuple, int], quotas: Mapping[str | None, int], repeats: int = REPEATS) -> dict[tuple[tuple, str | None], int]:
    """Words each pattern gives to each of its sources.

    A minimum-cost flow: pattern -> source -> quota. A pattern's k-th full use costs k - 1 a word, so
    its cost is convex and fresh words are used before repeated ones. Quotas are met as far as
    ``repeats`` uses allow. Successive shortest paths with potentials; the graph has patterns and
    sources for nodes, no documents.
    """
    names = list(quotas)
    node = {("source", s): i + 1 for i, s in enumerate(names)}
    graph: list[list[list]] = [[] for _ in range(2 + len(names) + len(patterns))]
    sink = len(graph) - 1

    def arc(a: int, b: int, capacity: int, cost: int) -> list:
        forth = [b, capacity, cost, len(graph[b])]
        graph[a].append(forth)
        graph[b].append([a, 0, -cost, len(graph[a]) - 1])
        return forth

    routes = {}
    for i, (pattern, size) in enumerate(patterns.items()):
        here = 1 + len(names) + i
        for k in range(repeats):
            arc(0, here, size, k)
        for s in pattern:
            routes[pattern, s] = arc(here, node["source", s], repeats * size, 0)
    for s in names:
        arc(node["source", s], sink, quotas[s], 0)
    start = {key: a[1] for key, a in routes.items()}
    potential = [0] * len(graph)
    while True:
        far = [None] * len(graph)
        far[0], back, heap = 0, [None] * len(graph), [(0, 0)]
        while heap:
            d, at = heapq.heappop(heap)
            if d > far[at]:
                continue
            for a in graph[at]:
                if a[1] > 0:
                    to, reach = a[0], d + a[2] + potential[at] - potential[a[0]]
                    if far[to] is None or reach < far[to]:
                        far[to], back[to] = reach, (at, a)
                        heapq.heappush(heap, (reach, to))
        if far[sink] is None:
            break
        for i, d in enumerate(far):
            # Unreached nodes stay behind the sink, so that reduced costs remain positive.
            potential[i] += far[sink] if d is None else min(d, far[sink])
        push, at = None, sink
        while at:
            before, a = back[at]
            push, at = a[1] if push is None else min(push, a[1]), before
        at = sink
        while at:
            before, a = back[at]
            a[1] -= push
            graph[at][a[3]][1] += push
            at = before
    return {key: start[key] - a[1] for key, a in routes.items()}


def words(text: Column) -> Column:
    """Number of words; null texts have none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _sized(rows: DataFrame, tag: Column, seed: int) -> DataFrame:
    """What the choice needs of rows (doc_id, text, sources), written: the tag that tells equal rows apart is the same for all that follows."""
    null_source = F.array(F.lit(None).cast("string"))
    sources = F.col("sources").cast("array<string>")
    doc_id = F.col("doc_id").cast("long")
    drawn = rows.select(
        doc_id.alias("doc_id"),
        F.when(F.size(sources) > 0, F.array_sort(F.array_distinct(sources))).otherwise(null_source).alias("sources"),
        words(F.col("text")).alias("size"),
        tag.alias("tag"),
    ).withColumn("draw", F.xxhash64(F.lit(seed), "doc_id", "sources"))
    return saved(drawn.withColumn("range", F.shiftrightunsigned("draw", 48).cast("int")))


def _place() -> Column:
    """Where a document stands in its pattern's order, by a seeded hash; it begins with the hash's range."""
    return F.struct("range", "draw", "size", "tag")


_PLACES = "struct<range: int, draw: long, size: long, tag: long>"


def _filled(open_: DataFrame, state: DataFrame) -> list:
    """Per pattern of ``state`` (sources, gap) the documents of ``open_`` that fill its gap in their order, up to the first that does not fit.

    Returns (sources, last, filled) of patterns that could take some: the place of the last one taken, and their words. The
    place is found from sums per hash range, so a pattern with most of all rows is never ordered in one task.
    """
    fitting = open_.join(state, "sources").where("size <= gap")
    ranges = fitting.groupBy("sources", "range").agg(F.sum("size").alias("words"), F.max(_place()).alias("last"), F.first("gap").alias("gap"))
    ranges = saved(ranges.withColumn("upto", F.sum("words").over(Window.partitionBy("sources").orderBy("range"))))
    # Ranges that fit as a whole, and the one after them, the only one in which documents are put in order: one in RANGES of a pattern's rows.
    whole = ranges.where("upto <= gap").groupBy("sources").agg(F.max("last").alias("last"), F.max("upto").alias("filled"))
    edge = ranges.where("upto > gap AND upto - words < gap").select("sources", "range", (F.col("upto") - F.col("words")).alias("ahead"))
    order = Window.partitionBy("sources").orderBy("draw", "size", "tag").rowsBetween(Window.unboundedPreceding, 0)
    at_edge = fitting.join(edge, ["sources", "range"]).withColumn("upto", F.col("ahead") + F.sum("size").over(order)).where("upto <= gap")
    found = whole.union(at_edge.groupBy("sources").agg(F.max(_place()).alias("last"), F.max("upto").alias("filled")))
    return found.groupBy("sources").agg(F.max("last").alias("last"), F.max("filled").alias("filled")).collect()


def mix(docs: DataFrame, weights=None, total: float = 1.0, repeats: int = REPEATS, seed: int = 0) -> tuple[DataFrame, dict, dict]:
    """Chooses how often documents (doc_id, text, sources) go into a mix; ``sources`` is an array of the sources a document is in.

    Returns a table (doc_id, sources, size, copies, cut, taken), the sources' sizes and their targets. ``copies`` is how
    often the whole document is taken, ``cut`` the words of one more, partial use, and ``taken`` = copies * size +
    cut. At most one document per pattern has a cut. A document's size counts in each of its sources.

    ``weights`` maps a source to its weight, or is a function of the sorted sources; without it all weigh
    the same. They share ``total`` times all words; see ``targets``. Documents are summed by
    their set of sources, ``flow`` routes words to quotas, and then each pattern's documents are taken: as
    many full uses as fit, and for the rest documents in the order of a seeded hash, past those that do not fit, until what is missing is a
    thousandth of what the pattern gives or no document is that small. The shortest document left is cut for it. Each pass over the order ends at a
    document that does not fit; there are a few. Only patterns and sources reach the driver.

    Null and empty texts have size 0 and are not taken. A null or empty array is the null source.
    Rows that repeat an id count each; equal rows are told apart by nothing and are taken alike or in
    any order of the same sizes. An empty table gives an empty one.
    """
    chosen, sizes, goal = _mixed(_sized(docs, F.monotonically_increasing_id(), seed), weights, total, repeats)
    return chosen.drop("tag"), sizes, goal


def _mixed(sized: DataFrame, weights, total: float, repeats: int) -> tuple[DataFrame, dict, dict]:
    """See ``mix``; rows keep their tags."""
    spark = sized.sparkSession
    found = {tuple(r["sources"]): r["size"] for r in sized.groupBy("sources").agg(F.sum("size").alias("size")).collect()}
    sizes: dict[str | None, int] = {}
    for pattern, size in found.items():
        for s in pattern:
            sizes[s] = sizes.get(s, 0) + size
    names = sorted(sizes, key=lambda s: (s is None, s))
    weigh = weights(names) if callable(weights) else weights or dict.fromkeys(names, 1)
    goal = targets(sizes, {s: weigh.get(s, 0) for s in names}, total * sum(found.values()), repeats) if any(found.values()) else dict.fromkeys(names, 0.0)
    quotas, carry = {}, 0.0
    for s in names:  # whole words, with the parts of words handed on
        quotas[s] = int(goal[s] + carry + 1e-6)
        quotas[s] = min(quotas[s], repeats * sizes[s])
        carry += goal[s] - quotas[s]
    given: dict[tuple, int] = {}
    for (pattern, _), amount in flow(found, quotas, repeats).items():
        given[pattern] = given.get(pattern, 0) + amount

    some = sized.where("size > 0")
    gaps = {p: given[p] % size for p, size in found.items() if size}
    # Per pattern the passes over its order: the longest document that fitted, and the last that was taken.
    passes: dict[tuple, list] = {p: [] for p in gaps}
    open_ = {p for p, gap in gaps.items() if gap}
    while open_:
        state = spark.createDataFrame([(list(p), gaps[p], passes[p][-1][1] if passes[p] else None) for p in open_], f"sources array<string>, gap long, after {_PLACES}")
        left = some.join(state.select("sources", "after"), "sources").where(F.col("after").isNull() | (_place() > F.col("after"))).drop("after")
        step = {tuple(r["sources"]): r for r in _filled(left, state.drop("after"))}
        for p in list(open_):
            if p in step:
                passes[p].append((gaps[p], tuple(step[p]["last"])))
                gaps[p] -= step[p]["filled"]
            if p not in step or gaps[p] * 1000 <= given[p]:
                open_.discard(p)
    rows = [(list(p), given[p] // size, gaps[p], passes[p]) for p, size in found.items() if size]
    plan = spark.createDataFrame(rows, f"sources array<string>, uses long, gap long, passes array<struct<fits: long, last: {_PLACES}>>")
    more = F.exists("passes", lambda x: (F.col("size") <= x["fits"]) & (_place() <= x["last"]))
    chosen = some.join(plan, "sources").withColumn("more", more).drop("passes")
    # A document that is taken once more anyway is not cut too, nor one that the gap would hold whole.
    cuts = chosen.where("gap > 0 AND NOT more AND size > gap").groupBy("sources").agg(F.min(F.struct("size", "draw", "tag")).alias("doc"), F.first("gap").alias("gap"))
    cut = spark.createDataFrame([(r["doc"]["tag"], r["gap"]) for r in cuts.collect()], "tag long, cut long")
    result = (
        chosen.join(cut, "tag", "left")
        .select("tag", "doc_id", "sources", "size", (F.col("uses") + F.col("more").cast("long")).alias("copies"), F.coalesce("cut", F.lit(0)).cast("long").alias("cut"))
        .union(sized.where("size = 0").select("tag", "doc_id", "sources", "size", F.lit(0).cast("long"), F.lit(0).cast("long")))
    )
    return result.withColumn("taken", F.col("copies") * F.col("size") + F.col("cut")), sizes, goal


def mixed_rows(docs: DataFrame, weights=None, total: float = 1.0, repeats: int = REPEATS, seed: int = 0) -> DataFrame:
    """Each row of ``docs`` (doc_id, text, source, ...) as often as ``mix`` takes the whole document, all columns as they are.

    A cut counts as a whole use if it is half of the document or more, and as none otherwise. Rows are told apart by a tag that is written with them, so
    rows that repeat an id are each taken as often as ``mix`` says.
    """
    rows = saved(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.monotonically_increasing_id().alias("tag")))
    parts = rows.select("row.doc_id", "row.text", F.array(F.col("row.source").cast("string")).alias("sources"), "tag")
    chosen, _, _ = _mixed(_sized(parts, F.col("tag"), seed), weights, total, repeats)
    copies = chosen.select("tag", (F.col("copies") + (2 * F.col("cut") >= F.col("size")).cast("long") * (F.col("cut") > 0).cast("long")).alias("copies"))
    taken = rows.join(copies.where("copies > 0"), "tag")
    return taken.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("time")).select("row.*")
