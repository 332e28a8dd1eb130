"""Problem 4: a sample that follows target proportions of categories.

The records are counted by cell (persona x tone x first domain), and the
counts of the target's cells, as many rows as the target has, go to the
driver.  There a min-cost flow decides: supply flows through arcs that carry
the persona and tone margins and the availability of each cell, from the cells
through arcs that carry the margins of first domains, floors come first, and a
slack arc into every cell, dearer than any real supply, exposes what cannot be
met.  The fractions of the cell quotas are rounded at random,
keeping the total, and each cell's records are drawn by a seeded hash.

Defined results: values are trimmed and lower-cased; null, missing and blank
ones are 'unknown'; records without a conversation_id are never counted or
drawn; a conversation delivered with other tags counts as available in each of
its cells, but is drawn only in the cell of its least entry_id; empty
tables give an empty sample in which every positive target falls short.
"""

from __future__ import annotations

import heapq
import math
import random
from fractions import Fraction

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quern.llm.common import keep, prefix_by_hash
from quern.session import table

CELL = ["persona", "tone", "first_domain"]


class Network:
    """Min-cost flow by successive shortest paths, with potentials, for small networks."""

    def __init__(self) -> None:
        self.nodes: dict[object, int] = {}
        self.to: list[int] = []
        self.cap: list[int] = []
        self.cost: list[int] = []
        self.out: list[list[int]] = []

    def node(self, name: object) -> int:
        if name not in self.nodes:
            self.nodes[name] = len(self.nodes)
            self.out.append([])
        return self.nodes[name]

    def arc(self, a: object, b: object, cap: int, cost: int) -> int:
        """The number of a new arc; ``flow`` gives what it carries."""
        u, v, k = self.node(a), self.node(b), len(self.to)
        self.to += [v, u]
        self.cap += [max(cap, 0), 0]
        self.cost += [cost, -cost]
        self.out[u].append(k)
        self.out[v].append(k + 1)
        return k

    def flow(self, k: int) -> int:
        return self.cap[k + 1]

    def push(self, source: object, sink: object, amount: int) -> int:
        """Sends up to amount at least cost (all costs are 0 or more); what was sent."""
        s, t, n = self.node(source), self.node(sink), len(self.nodes)
        potential, sent = [0] * n, 0
        while sent < amount:
            dist, via = [math.inf] * n, [-1] * n
            dist[s] = 0
            heap = [(0, s)]
            while heap:
                d, u = heapq.heappop(heap)
                if d > dist[u]:
                    continue
                for k in self.out[u]:
                    v = self.to[k]
                    if self.cap[k] and (e := d + self.cost[k] + potential[u] - potential[v]) < dist[v]:
                        dist[v], via[v] = e, k
                        heapq.heappush(heap, (e, v))
            if dist[t] == math.inf:
                break
            potential = [p + (d if d < math.inf else 0) for p, d in zip(potential, dist)]
            path, v = [], t
            while v != s:
                path.append(via[v])
                v = self.to[via[v] ^ 1]
            step = min([amount - sent, *(self.cap[k] for k in path)])
            for k in path:
                self.cap[k] -= step
                self.cap[k ^ 1] += step
            sent += step
        return sent


def cell_columns(persona: Column, tone: Column, domain: Column) -> list[Column]:
    def clean(c: Column, name: str) -> Column:
        low = F.lower(F.trim(c))
        return F.when(F.coalesce(low, F.lit("")) == "", "unknown").otherwise(low).alias(name)

    return [clean(persona, "persona"), clean(tone, "tone"), clean(domain, "first_domain")]


def tagged(conversation: DataFrame) -> DataFrame:
    """(conversation_id, persona, tone, first_domain, entry_id, own): one row of each conversation in each of its cells; own marks the one in which it may be drawn."""
    rows = conversation.select(F.col("metadata.conversation_id").alias("conversation_id"), *cell_columns(F.col("tags.persona"), F.col("tags.tone"), F.get(F.col("tags.domain"), F.lit(0))), "entry_id")
    rows = rows.where("conversation_id is not null").groupBy("conversation_id", *CELL).agg(F.min("entry_id").alias("entry_id"))
    first = F.row_number().over(Window.partitionBy("conversation_id").orderBy(F.col("entry_id").asc_nulls_last(), *CELL))  # a row for each cell of one conversation
    return rows.withColumn("own", first == 1)


def solve(cells: list[dict], size: int, seed: int = 4) -> list[dict]:
    """The cells with need, slack and quota added.

    cells: dicts of persona, tone, first_domain, share (a Fraction), min_rows,
    have (conversations available in the cell) and, if some of them are to be
    drawn in another cell, own (those to be drawn in this one).  need is the
    larger of floor and share; slack is what no record can fill; the quotas
    add up to size where availability allows (to more where the floors alone
    exceed it).
    """
    inf = sum(c["have"] for c in cells) + size + sum(c["min_rows"] for c in cells) + 1
    needs = [max(c["min_rows"], math.ceil(c["share"] * size)) for c in cells]
    net, slack = Network(), []
    _carry(net, cells, needs, [c["have"] for c in cells], inf)
    for k, (c, need) in enumerate(zip(cells, needs)):
        slack.append(net.arc("source", ("cell", k), need, 1000))
        net.arc(("cell", k), ("domain", c["first_domain"]), need, 0)
    net.push("source", "sink", sum(needs))
    out = [c | {"need": n, "slack": net.flow(s)} for c, n, s in zip(cells, needs, slack)]

    quotas = rounded([c["share"] * size for c in cells], size, random.Random(seed))
    quotas = [max(q, c["min_rows"]) for q, c in zip(quotas, cells)]
    own = [c.get("own", c["have"]) for c in cells]
    net, arcs = Network(), []
    _carry(net, cells, quotas, own, inf)
    for k, (c, q) in enumerate(zip(cells, quotas)):
        domain = ("domain", c["first_domain"])
        arcs.append([net.arc(("cell", k), domain, c["min_rows"], 0), net.arc(("cell", k), domain, q - c["min_rows"], 20), net.arc(("cell", k), domain, inf, 200)])
    net.push("source", "sink", max(size if cells else 0, sum(min(c["min_rows"], n) for c, n in zip(cells, own))))
    return [c | {"quota": sum(net.flow(a) for a in each)} for c, each in zip(out, arcs)]


def _carry(net: Network, cells: list[dict], amounts: list[int], have: list[int], inf: int) -> None:
    """Arcs that carry the margins: up to a margin free of cost, beyond it dearer for a persona than for a first domain, and for that than for its tones."""
    personas: dict[object, int] = {}
    tones: dict[object, int] = {}
    domains: dict[object, int] = {}
    for c, n in zip(cells, amounts):
        personas[c["persona"]] = personas.get(c["persona"], 0) + n
        tones[c["persona"], c["tone"]] = tones.get((c["persona"], c["tone"]), 0) + n
        domains[c["first_domain"]] = domains.get(c["first_domain"], 0) + n
    for p, n in personas.items():
        net.arc("source", ("persona", p), n, 0)
        net.arc("source", ("persona", p), inf, 7)
    for (p, t), n in tones.items():
        net.arc(("persona", p), ("tone", p, t), n, 0)
        net.arc(("persona", p), ("tone", p, t), inf, 3)
    for k, c in enumerate(cells):
        net.arc(("tone", c["persona"], c["tone"]), ("cell", k), have[k], 0)
    for d, n in domains.items():
        net.arc(("domain", d), "sink", n, 0)
        net.arc(("domain", d), "sink", inf, 5)


def rounded(values: list[Fraction], total: int, rng: random.Random) -> list[int]:
    """Integers that are the values rounded up or down, each up with the chance of its fraction (systematic sampling), so the total stays."""
    order = list(range(len(values)))
    rng.shuffle(order)
    out, reach, tick = [0] * len(values), Fraction(0), Fraction(rng.random()).limit_denominator(1 << 30)
    for k in order:
        whole = math.floor(values[k])
        before, reach = reach, reach + (values[k] - whole)
        out[k] = whole + math.floor(reach + 1 - tick) - math.floor(before + 1 - tick)
    return out


def solved(conversation: DataFrame, targets: DataFrame, fraction: int = 4, seed: int = 4) -> tuple[DataFrame, list[dict], int]:
    """The tagged records, the solved cells, and the sample size floor(D / fraction)."""
    rows = keep(tagged(conversation))
    size = rows.agg(F.countDistinct("conversation_id").alias("n")).first()["n"] // fraction
    goal = targets.select(*cell_columns(F.col("persona"), F.col("tone"), F.col("first_domain")), F.coalesce("target_share", F.lit(0.0)).alias("share"), F.coalesce("min_rows", F.lit(0)).alias("min_rows"))
    goal = goal.groupBy(*CELL).agg(F.max("share").alias("share"), F.max("min_rows").alias("min_rows"))
    counts = rows.groupBy(*CELL).agg(F.count(F.lit(1)).alias("have"), F.count(F.when(F.col("own"), 1)).alias("own"))
    cells = [r.asDict() for r in goal.join(counts, CELL, "left").orderBy(*CELL).collect()]  # a row for each target
    for c in cells:
        c["share"], c["have"], c["own"] = Fraction(str(c["share"])), c["have"] or 0, c["own"] or 0
    return rows, solve(cells, size, seed), size


# ---------------------------------------------------------------- queries


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    """(persona, tone, first_domain) as TESTDATA.md states problem 4: the cells whose slack arc carries flow."""
    _, cells, _ = solved(table(spark, folder, "conversation"), table(spark, folder, "sample_targets"))
    return spark.createDataFrame([tuple(c[x] for x in CELL) for c in cells if c["slack"]], "persona string, tone string, first_domain string")


def p4_report(spark: SparkSession, folder: str) -> DataFrame:
    """(persona, tone, first_domain, target_share, min_rows, available, need, slack, quota, sample_size) of every target."""
    _, cells, size = solved(table(spark, folder, "conversation"), table(spark, folder, "sample_targets"))
    rows = [(*(c[x] for x in CELL), float(c["share"]), c["min_rows"], c["have"], c["need"], c["slack"], c["quota"], size) for c in cells]
    return spark.createDataFrame(rows, "persona string, tone string, first_domain string, target_share double, min_rows int, available long, need long, slack long, quota long, sample_size long")


def p4_sample(spark: SparkSession, folder: str) -> DataFrame:
    """(conversation_id, persona, tone, first_domain, entry_id): the drawn sample."""
    rows, cells, _ = solved(table(spark, folder, "conversation"), table(spark, folder, "sample_targets"))
    quotas = spark.createDataFrame([(*(c[x] for x in CELL), c["quota"]) for c in cells if c["quota"]], "persona string, tone string, first_domain string, quota long")
    one = rows.where("own").drop("own").withColumn("_one", F.lit(1).cast("long"))
    return prefix_by_hash(one, CELL, quotas, F.xxhash64(F.lit(4), "conversation_id"), "_one").select("conversation_id", *CELL, "entry_id")
