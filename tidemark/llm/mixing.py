"""Records of several sources mixed to target shares of the total size.

Documents are aggregated by the set of sources they may serve; tokens are routed from these patterns to the sources' quotas by
a min-cost flow in which the k-th use of a document costs more than the one before, so repetition is spread as thinly as the
quotas allow. A source that cannot fill its quota at its repeat cap stays at the cap, and the others keep theirs. Documents are then chosen in a seeded order; running sums are taken over hash buckets, so no task sorts a source.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F

#: Buckets of the seeded order within a pattern; a bucket's documents are summed by one task.
BUCKETS = 16_384


@dataclass
class _Edge:
    to: int
    room: int
    cost: int
    back: int


class FlowNetwork:
    """Min-cost flow by successive shortest paths; capacities are whole tokens, the network has one node per pattern and source."""

    def __init__(self, nodes: int) -> None:
        self.edges: list[list[_Edge]] = [[] for _ in range(nodes)]

    def connect(self, a: int, b: int, room: int, cost: int) -> _Edge:
        forward, backward = _Edge(b, room, cost, len(self.edges[b])), _Edge(a, 0, -cost, len(self.edges[a]))
        self.edges[a].append(forward)
        self.edges[b].append(backward)
        return forward

    def run(self, source: int, sink: int) -> tuple[int, int]:
        """Greatest flow and its least cost, where only edges out of the source cost anything.

        A path's cost is then that of its first edge, so shortest paths come cost by cost: at each cost the cheaper edges and those
        of this cost carry a greatest flow by blocking flows in the graph of levels.
        """
        flow = cost = 0
        first = self.edges[source]
        for price in sorted({e.cost for e in first}):
            usable = [e for e in first if e.cost <= price]
            while True:
                level, queue = {source: 0}, [source]
                while queue and sink not in level:
                    following = []
                    for node in queue:
                        for e in usable if node == source else self.edges[node]:
                            if e.room > 0 and e.to not in level:
                                level[e.to] = level[node] + 1
                                following.append(e.to)
                    queue = following
                if sink not in level:
                    break
                for start in usable:
                    if start.room > 0 and level.get(start.to) == 1:
                        sent = self._push(start.to, sink, start.room, level)
                        start.room -= sent
                        self.edges[start.to][start.back].room += sent
                        flow, cost = flow + sent, cost + sent * start.cost
        return flow, cost

    def _push(self, node: int, sink: int, most: int, level: dict[int, int]) -> int:
        """Send up to ``most`` from a node to the sink along rising levels; a node that is spent leaves the levels."""
        if node == sink:
            return most
        sent = 0
        for e in self.edges[node]:
            if e.room > 0 and level.get(e.to) == level[node] + 1:
                part = self._push(e.to, sink, min(most - sent, e.room), level)
                e.room -= part
                self.edges[e.to][e.back].room += part
                sent += part
                if sent == most:
                    return sent
        del level[node]
        return sent

    def reached(self, source: int) -> set[int]:
        """Nodes that more flow could still get to."""
        seen, queue = {source}, [source]
        while queue:
            for edge in self.edges[queue.pop()]:
                if edge.room > 0 and edge.to not in seen:
                    seen.add(edge.to)
                    queue.append(edge.to)
        return seen


def _send(patterns: dict[tuple[str, ...], int], quota: dict[str, int], repeats: dict[str, int]) -> tuple[dict[tuple[str, ...], dict[str, int]], set[str]]:
    """Tokens of each pattern for each source in the greatest flow up to the quotas, and the sources that can get no more; these are none if all are filled."""
    names, keys = sorted(quota), sorted(patterns)
    place = {s: j for j, s in enumerate(names)}
    net = FlowNetwork(2 + len(keys) + len(names))
    sent = {}
    for i, key in enumerate(keys):
        for use in range(min(repeats[s] for s in key)):  # the k-th use costs k
            net.connect(0, 2 + i, patterns[key], use)
        for s in key:
            room = patterns[key] * repeats[s]
            sent[key, s] = (net.connect(2 + i, 2 + len(keys) + place[s], room, 0), room)
    for j, s in enumerate(names):
        net.connect(2 + len(keys) + j, 1, quota[s], 0)
    flow, _ = net.run(0, 1)
    routes = {key: {s: sent[key, s][1] - sent[key, s][0].room for s in key} for key in keys}
    if flow == sum(quota.values()):
        return routes, set()
    reached = net.reached(0)
    return routes, {s for j, s in enumerate(names) if 2 + len(keys) + j not in reached}


def route(patterns: dict[tuple[str, ...], int], shares: dict[str, float], repeats: dict[str, int], total: int) -> dict[tuple[str, ...], dict[str, int]] | None:
    """Tokens of each pattern for each source when the mix holds ``total`` tokens, or None if that many cannot be had."""
    routes, short = _send(patterns, {s: int(shares[s] * total) for s in shares}, repeats)
    return None if short else routes


def best_route(patterns: dict[tuple[str, ...], int], shares: dict[str, float], repeats: dict[str, int], wanted: int | None = None) -> tuple[int, dict[tuple[str, ...], dict[str, int]]]:
    """The largest total up to ``wanted`` (all tokens once, by default) that meets all shares, and its routes."""
    high = wanted if wanted is not None else sum(patterns.values())
    found = route(patterns, shares, repeats, high)
    if found is not None:
        return high, found
    low, best = 0, route(patterns, shares, repeats, 0)
    while high - low > max(1, high // 1_000_000):
        middle = (low + high) // 2
        attempt = route(patterns, shares, repeats, middle)
        low, high, best = (middle, high, attempt) if attempt is not None else (low, middle, best)
    return low, best


def fullest_route(patterns: dict[tuple[str, ...], int], shares: dict[str, float], repeats: dict[str, int], wanted: int | None = None) -> dict[tuple[str, ...], dict[str, int]]:
    """Routes of a mix of ``wanted`` tokens (all tokens once, by default) in which each source gets its quota or, failing that, what there is for it.

    All quotas are raised together; the sources that then can get no more, alone or between them, are held where they are and the
    others raised further. So this is a greatest flow, and sources that compete for the same documents come out short alike.
    """
    high = wanted if wanted is not None else sum(patterns.values())
    held: dict[str, int] = {}

    def attempt(total: int) -> tuple[dict[tuple[str, ...], dict[str, int]], set[str]]:
        return _send(patterns, {s: held.get(s, int(shares[s] * total)) for s in shares}, repeats)

    routes, short = attempt(high)
    while short:
        # the sources that are short get all there is for them, which tells the total they could fill; where others are short then, again
        low = high
        while True:
            free = short - held.keys()
            low = min(low - 1, int(sum(r.get(s, 0) for r in routes.values() for s in free) / sum(shares[s] for s in free))) if free else low
            routes, lacking = attempt(low)
            if not lacking - held.keys() or low <= 0:
                break
            short = lacking
        held |= {s: int(shares[s] * max(low, 0)) for s in short - held.keys()}
        routes, short = attempt(high)
        if not short - held.keys():
            break
    return routes


def mix(sizes: DataFrame, targets: DataFrame, seed: int = 42, wanted: int | None = None, buckets: int = BUCKETS) -> DataFrame:
    """``(doc_id, source, n_tokens, uses)``: how often each document is used for which source.

    ``sizes`` has ``doc_id``, ``n_tokens`` and ``sources`` (array of the sources a document may serve) and should be stored.
    Documents of no target source, and such without tokens, come out with 0 uses and a NULL source if nothing uses them; a
    document of several sources has a row for each source that uses it. Shares are taken relative to their sum; a source with
    no share or without repeats is no target. A source that has too little for its share of ``wanted`` tokens (all tokens once, by
    default) comes out short, each of its documents at the cap, while the others fill theirs. The same seed gives the same choice, however the input is partitioned.
    """
    rows = targets.filter("target_share > 0 AND max_repeats > 0 AND source IS NOT NULL").collect()  # a fixed small table
    whole = sum(r.target_share for r in rows)
    shares, repeats = {r.source: r.target_share / whole for r in rows}, {r.source: r.max_repeats for r in rows}
    wantable = F.array(*[F.lit(s) for s in sorted(shares)]) if shares else F.array().cast("array<string>")
    keyed = sizes.withColumn("members", F.array_sort(F.array_intersect(F.coalesce("sources", F.array().cast("array<string>")), wantable))).withColumn("pattern", F.when((F.size("members") > 0) & (F.col("n_tokens") > 0), F.concat_ws("\u0001", "members")))
    # one row per set of target sources: at most two to the power of their number, whatever the number of documents
    sums = keyed.filter("pattern IS NOT NULL").groupBy("pattern").agg(F.sum("n_tokens").alias("t")).collect()
    patterns = {tuple(r.pattern.split("\u0001")): r.t for r in sums}
    routes = fullest_route(patterns, shares, repeats, wanted) if shares else {}

    # along a line of (k-th use, place in the seeded order) every source has one interval of tokens
    spans = []
    for key, parts in routes.items():
        start = 0
        for s in sorted(parts):
            if parts[s]:
                spans.append(("\u0001".join(key), s, start, start + parts[s], patterns[key], min(repeats[m] for m in key)))
                start += parts[s]
    spark = sizes.sparkSession
    plan = spark.createDataFrame(spans, "pattern string, source string, span_start bigint, span_end bigint, pattern_tokens bigint, most int")
    per_pattern = plan.groupBy("pattern").agg(F.array_sort(F.collect_list(F.struct("span_start", "span_end", "source"))).alias("spans"), F.first("pattern_tokens").alias("pattern_tokens"), F.first("most").alias("most"))

    placed = keyed.filter("pattern IS NOT NULL").withColumn("place", F.xxhash64(F.lit(seed), "doc_id")).withColumn("bucket", F.pmod(F.shiftright("place", 32), F.lit(buckets)))
    bucket_sums = placed.groupBy("pattern", "bucket").agg(F.sum("n_tokens").alias("in_bucket"))
    earlier = Window.partitionBy("pattern").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = bucket_sums.withColumn("bucket_start", F.coalesce(F.sum("in_bucket").over(earlier), F.lit(0))).drop("in_bucket")
    in_bucket = Window.partitionBy("pattern", "bucket").orderBy("place", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    ran = placed.withColumn("before", F.coalesce(F.sum("n_tokens").over(in_bucket), F.lit(0))).join(starts, ["pattern", "bucket"])
    # a document lies in the span that holds its middle
    middle = F.col("bucket_start") + F.col("before") + F.col("n_tokens") / 2
    # one row per pattern; Spark broadcasts it by its size or not
    lined = ran.withColumn("middle", middle).join(per_pattern, "pattern", "left")
    hits = F.transform(F.coalesce("spans", F.array().cast("array<struct<span_start:bigint,span_end:bigint,source:string>>")), lambda s: F.struct(
        s["source"].alias("source"),
        F.size(F.filter(F.sequence(F.lit(0), F.coalesce("most", F.lit(1)) - 1), lambda k: (k * F.col("pattern_tokens") + F.col("middle") >= s["span_start"]) & (k * F.col("pattern_tokens") + F.col("middle") < s["span_end"]))).alias("uses"),
    ))
    used = lined.select("doc_id", "n_tokens", F.filter(hits, lambda h: h["uses"] > 0).alias("h")).select("doc_id", "n_tokens", F.inline_outer("h"))
    rest = keyed.filter("pattern IS NULL").select("doc_id", "n_tokens", F.lit(None).cast("string").alias("source"), F.lit(None).cast("int").alias("uses"))
    return used.unionByName(rest).select("doc_id", "source", "n_tokens", F.coalesce("uses", F.lit(0)).alias("uses"))


def wanted_tokens(sizes: DataFrame, targets: DataFrame) -> int:
    """Tokens of all documents that some target source may use, once: what ``mix`` makes its quotas of by default."""
    names = [r.source for r in targets.filter("target_share > 0 AND max_repeats > 0 AND source IS NOT NULL").collect()]
    wantable = F.array(*[F.lit(s) for s in names]) if names else F.array().cast("array<string>")
    return sizes.filter(F.arrays_overlap("sources", wantable)).agg(F.coalesce(F.sum("n_tokens"), F.lit(0))).first()[0]


def shares_reached(mixed: DataFrame, targets: DataFrame, wanted: int | None = None) -> DataFrame:
    """Per target source: documents and tokens used, its share of all tokens used, the target share and the most uses of a document.

    With ``wanted``, the tokens that the mix was to hold, also the source's quota of them and how many tokens are missing from it.
    As documents are used whole, a few tokens, less than a document, may be missing from a source that has enough.
    """
    per = mixed.filter("uses > 0").groupBy("source").agg(F.count(F.lit(1)).alias("documents"), F.sum(F.col("uses") * F.col("n_tokens")).alias("tokens"), F.max("uses").alias("most_uses"))
    joined = targets.select("source", "target_share", "max_repeats").join(per, "source", "left").fillna({"documents": 0, "tokens": 0, "most_uses": 0})
    one_row = Window.partitionBy()  # over one row per target source
    total = F.sum("tokens").over(one_row)
    out = joined.withColumn("share", F.round(F.when(total > 0, F.col("tokens") / total), 9))
    if wanted is None:
        return out
    is_target = F.col("source").isNotNull() & (F.col("target_share") > 0) & (F.col("max_repeats") > 0)
    whole = F.sum(F.when(is_target, F.col("target_share"))).over(one_row)
    quota = F.when(is_target, F.floor(F.col("target_share") / whole * wanted)).otherwise(0)
    return out.withColumn("quota_tokens", quota.cast("bigint")).withColumn("short_tokens", F.greatest(F.col("quota_tokens") - F.col("tokens"), F.lit(0)))
