"""Problem 8: mixing sources to target weights, in tokens.

Weights go down a tree of domains, languages and sources; a leaf is one source
in one language, with the share of the source's tokens that are in it.  A
leaf can give at most max_repeats times its tokens.  What it lacks goes to its
siblings first, what they cannot take to the other languages of the domain,
then to other domains.  Of each leaf whole epochs are taken, and of the last
epoch the prefix, in an order seeded by the epoch, that fits the budget.

Defined results: null source or text counts towards the total T only; a source
without documents has 0 tokens and falls short of any positive share; null
language is 'und'.  A null share is 0, null max_repeats 1.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm.bpe import VOCABULARY, token_counts
from quern.llm.common import keep, prefix_by_hash
from quern.session import spread, table

@dataclass
class Node:
    name: tuple[str, ...]
    weight: Fraction = Fraction(0)
    room: Fraction = Fraction(0)
    children: dict[str, Node] = field(default_factory=dict)
    budget: Fraction = Fraction(0)
    unmet: Fraction = Fraction(0)  # what of its weight its room cannot take


def grow(leaves: list[tuple[tuple[str, str, str], Fraction, Fraction]]) -> Node:
    """The tree over leaves ((domain, language, source), weight, room), weights and rooms added up."""
    root = Node(())
    for path, weight, room in leaves:
        node = root
        node.weight, node.room = node.weight + weight, node.room + room
        for k, name in enumerate(path):
            node = node.children.setdefault(name, Node(path[: k + 1]))
            node.weight, node.room = node.weight + weight, node.room + room
    return root


def allot(node: Node, amount: Fraction) -> None:
    """Spread an amount over a node's children by weight, within their room; shortages go to siblings with room left."""
    node.budget = min(amount, node.room)
    open_ = [c for c in node.children.values() if c.room > 0]
    left = node.budget
    given = {c.name: Fraction(0) for c in open_}
    while open_ and left > 0:
        total = sum((c.weight for c in open_), Fraction(0))
        share = {c.name: (c.weight / total if total else Fraction(1, len(open_))) * left for c in open_}
        full = [c for c in open_ if given[c.name] + share[c.name] >= c.room]
        if not full:
            for c in open_:
                given[c.name] += share[c.name]
            break
        for c in full:
            left -= c.room - given[c.name]
            given[c.name] = c.room
        open_ = [c for c in open_ if c not in full]
    for c in node.children.values():
        allot(c, given.get(c.name, Fraction(0)))


def weigh(node: Node) -> Fraction:
    """Mark in every node what its leaves cannot take of their weights, and give the whole of it: the shortages that siblings and ancestors are to make up for."""
    node.unmet = sum((weigh(c) for c in node.children.values()), Fraction(0)) if node.children else max(Fraction(0), node.weight - node.room)
    return node.unmet


def leaves_of(node: Node) -> list[Node]:
    return [x for c in node.children.values() for x in leaves_of(c)] if node.children else [node]


def counted(documents: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """(doc_id, language, source, n_tokens) of documents; source trimmed and lower-cased."""
    rows = documents.select("doc_id", "text", F.coalesce(F.lower(F.trim("lang")), F.lit("und")).alias("language"), F.lower(F.trim("source")).alias("source"))
    return token_counts(rows, path=path)


def plan(counts: DataFrame, targets: DataFrame, domains: dict[str, str] | None = None) -> tuple[list[dict], list[dict], int]:
    """Budgets of the leaves, a report by source, and T.

    ``domains`` names the domain of a source; one it does not name is a domain
    of its own.  A source falls short if any of its leaves has unmet weight
    when the weights have come down the tree (its leaves have equal ratios of
    weight and room, so all have or none).

    Only sums by leaf reach the driver, and of them only those of the
    targets' sources (targets times languages, not documents).
    """
    domains = domains or {}
    sums = keep(counts.groupBy("source", "language").agg(F.sum("n_tokens").alias("tokens")), now=True)
    total = sums.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("t")).first()["t"]
    want: dict[str, tuple[Fraction, int]] = {}
    named = targets.where("source is not null").groupBy(F.lower(F.trim("source")).alias("source")).agg(F.max("target_share").alias("share"), F.max("max_repeats").alias("repeats"))
    for r in named.collect():
        want[r["source"]] = (Fraction(str(r["share"] or 0)), int(1 if r["repeats"] is None else r["repeats"]))
    have: dict[str, dict[str, int]] = {s: {} for s in want}
    for r in sums.join(named.select("source"), "source").where("tokens > 0").collect():
        have[r["source"]][r["language"]] = r["tokens"]
    leaves = []
    for source, (share, repeats) in want.items():
        own = have[source]
        size = sum(own.values())
        for language, tokens in (own or {"und": 0}).items():
            leaves.append(((domains.get(source, source), language, source), share * total * (Fraction(tokens, size) if size else 1), Fraction(repeats * tokens)))
    root = grow(leaves)
    weigh(root)
    unmet: dict[str, Fraction] = {}
    for leaf in leaves_of(root) if want else []:
        unmet[leaf.name[2]] = unmet.get(leaf.name[2], Fraction(0)) + leaf.unmet
    allot(root, Fraction(total) if sum((s for s, _ in want.values()), Fraction(0)) > 0 else Fraction(0))
    budgets = []
    for leaf in leaves_of(root) if want else []:
        domain, language, source = leaf.name
        tokens = have[source].get(language, 0)
        epochs, rest = divmod(int(leaf.budget), tokens) if tokens else (0, 0)
        budgets.append({"domain": domain, "language": language, "source": source, "tokens": tokens, "budget": int(leaf.budget), "epochs": epochs, "quota": rest})
    report = []
    for source, (share, repeats) in sorted(want.items()):
        tokens = sum(have[source].values())
        report.append({
            "source": source, "target_share": float(share), "max_repeats": repeats, "tokens": tokens,
            "budget": sum(b["budget"] for b in budgets if b["source"] == source), "short": unmet[source] > 0,
        })
    return budgets, report, total


BUDGET = "domain string, language string, source string, tokens long, budget long, epochs int, quota long"
REPORT = "source string, target_share double, max_repeats int, tokens long, budget long, short boolean"


def mix(counts: DataFrame, budgets: list[dict], seed: int = 8) -> DataFrame:
    """(doc_id, source, language, n_tokens, epoch): the mixture, each document once for each epoch that takes it.

    Documents without a token carry nothing and are left out.
    """
    spark = counts.sparkSession
    leaf = spark.createDataFrame([tuple(b.values()) for b in budgets], BUDGET)
    rows = counts.where("n_tokens > 0 and source is not null").select("doc_id", "language", "source", "n_tokens")
    whole = rows.join(leaf.where("epochs > 0").select("language", "source", "epochs"), ["language", "source"])
    whole = whole.withColumn("epoch", F.explode(F.sequence(F.lit(1), "epochs"))).drop("epochs")
    part = rows.join(leaf.where("quota > 0").select("language", "source", "epochs"), ["language", "source"]).withColumn("epoch", F.col("epochs") + 1).drop("epochs")
    key = F.xxhash64(F.lit(seed), "epoch", "doc_id")
    part = prefix_by_hash(part, ["language", "source"], leaf.where("quota > 0").select("language", "source", "quota"), key, "n_tokens")
    columns = ["doc_id", "source", "language", "n_tokens", "epoch"]
    return whole.select(columns).unionByName(part.select(columns))


# ---------------------------------------------------------------- queries


#: The tree of the queries over the test tables: a parameter of theirs, not of the operator.
QUERY_DOMAINS = {
    "literary_passages": "prose", "almanac_notes": "prose", "folk_sayings": "prose", "field_diaries": "prose",
    "letters": "prose", "post_threads": "dialogue", "assistant_replies": "dialogue",
    "bulletins": "reports", "radio_scripts": "reports",
}


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    """(source) as TESTDATA.md states problem 8: the sources with unmet weight in the tree."""
    _, report, _ = plan(counted(spread(table(spark, folder, "documents").select("doc_id", "text", "lang", "source"))), table(spark, folder, "mix_targets"), QUERY_DOMAINS)
    return spark.createDataFrame([(r["source"],) for r in report if r["short"]], "source string")


def p8_mix(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, source, language, n_tokens, epoch): the mixture."""
    counts = keep(counted(spread(table(spark, folder, "documents").select("doc_id", "text", "lang", "source"))))
    budgets, _, _ = plan(counts, table(spark, folder, "mix_targets"), QUERY_DOMAINS)
    return mix(counts, budgets)


def p8_report(spark: SparkSession, folder: str) -> DataFrame:
    """(source, target_share, max_repeats, tokens, budget, short, drawn, actual_share): what each source was to give and gave."""
    counts = keep(counted(spread(table(spark, folder, "documents").select("doc_id", "text", "lang", "source"))))
    budgets, report, _ = plan(counts, table(spark, folder, "mix_targets"), QUERY_DOMAINS)
    drawn = {r["source"]: r["n"] for r in mix(counts, budgets).groupBy("source").agg(F.sum("n_tokens").alias("n")).collect()}  # a row for each target
    whole = sum(drawn.values())
    rows = [(*r.values(), drawn.get(r["source"], 0), drawn.get(r["source"], 0) / whole if whole else 0.0) for r in report]
    return spark.createDataFrame(rows, REPORT + ", drawn long, actual_share double")
