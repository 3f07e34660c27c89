"""Mixing sources to target weights by hierarchical budgeting.

Documents hang on a tree of domains, languages and sources. A token budget flows down it by weight. A
node can take no more than its subtree supplies over ``max_epochs`` epochs; what it can't take goes to
its siblings, in proportion to their weights, and only what they can't take either is lost to their
parent, whose own siblings then get it: a parent's capacity is its subtree's, so its share is settled
before any of it reaches the children.

For siblings in the order of capacity per weight, those at the front are filled and the rest share what
is left. The first one whose share fits its capacity ends the front: a window over siblings, no loop.

A leaf then takes whole epochs of its documents and, from the next epoch, the longest prefix within the
rest of its budget. An epoch is an order of the documents by a seeded hash. The hash is cut into slots;
sums per leaf and slot find the slot in which the prefix ends, and only that slot's rows are ordered.
Hot leaves are so spread over all slots.

Null domain, language or source is a branch called ``-``. Null text has no tokens and is taken only
with whole epochs or where the prefix reaches it. Rows that repeat an id are separate documents whose
order among each other follows their tokens. Branches without weight get weight 1, weight 0 gets nothing.
An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfolio.llm.common import join_groups, without, written

SLOTS = 4096
_ORDER_BITS = 60


@dataclass(frozen=True)
class Mix:
    """Weights per node are whole numbers. ``budget`` in tokens, or ``budget_percent`` of the supply."""

    domains: dict[str, int] = field(default_factory=dict)
    langs: dict[tuple[str, str], int] = field(default_factory=dict)
    sources: dict[tuple[str, str, str], int] = field(default_factory=dict)
    budget: int | None = None
    budget_percent: int = 80
    max_epochs: int = 1
    seed: int = 7


PRODUCTION_MIX = Mix(
    domains={"web": 4, "books": 3, "news": 2, "forums": 1},
    langs={(d, "en"): 3 for d in ("web", "books", "news", "forums")},
    budget_percent=150,
    max_epochs=2,
)
"""Half as much again as there is, in two epochs at most: some leaves run short, others are cut."""


def n_words(text: str) -> Column:
    """Tokens as runs of other than white space."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit("[^ \\t-\\r]+")), F.lit(0)).cast("long")


def domain_of_source(source: str) -> Column:
    """The default domains: by the number in the source's name; other names are ``other``."""
    number = F.regexp_extract(F.coalesce(F.col(source), F.lit("")), "([0-9]+)$", 1)
    names = F.array(*[F.lit(x) for x in ("web", "books", "news", "forums")])
    last = F.substring(number, -2, 2).try_cast("int")
    return F.coalesce(F.get(names, F.pmod(last, F.lit(4))), F.lit("other"))


def _order(seed: int, epoch: Column, id: Column) -> Column:
    """The place of a document in an epoch: 60 bits of a hash that any SQL engine has."""
    named = F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(id.cast("string"), F.lit("-")))
    return F.conv(F.substring(F.md5(named), 1, _ORDER_BITS // 4), 16, 10).cast("long")


def _weights(nodes: DataFrame, keys: list[str], given: dict) -> DataFrame:
    spark = nodes.sparkSession
    rows = [(*(k if isinstance(k, tuple) else (k,)), int(w)) for k, w in given.items()]
    schema = ", ".join(f"{k} string" for k in keys) + ", weight long"
    table = spark.createDataFrame(rows, schema)
    return nodes.join(table, keys, "left").withColumn("weight", F.coalesce("weight", F.lit(1).cast("long")))


def share(nodes: DataFrame, parent: list[str], budget: Column) -> DataFrame:
    """Adds ``budget`` to siblings (key ``name``, ``weight``, ``capacity``): each gets its share of its
    parent's budget in whole tokens, capped by its capacity, the surplus going to its siblings."""
    live = F.col("weight") > 0
    nodes = nodes.withColumn("capacity", F.when(live, F.col("capacity")).otherwise(0)).withColumn("given", budget)
    per = F.when(live, F.col("capacity").cast("double") / F.col("weight")).otherwise(F.lit(-1.0))
    nodes = nodes.withColumn("per", per)
    order = Window.partitionBy(*parent).orderBy("per", "name")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    zero = F.lit(0).cast("long")
    nodes = nodes.select(
        "*",
        F.coalesce(F.sum("capacity").over(before), zero).alias("filled"),
        F.sum("weight").over(after).alias("weights"),
    )
    # a node is filled if its share of what those before it leave exceeds its capacity
    fair = F.when(F.col("weights") > 0, (F.col("given") - F.col("filled")) * F.col("weight") / F.col("weights")).otherwise(0.0)
    nodes = nodes.withColumn("full", ~live | (fair >= F.col("capacity")))
    front = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    nodes = nodes.withColumn("open", F.max(F.when(~F.col("full"), 1).otherwise(0)).over(front) == 1)
    whole = Window.partitionBy(*parent)
    left = F.col("given") - F.coalesce(F.sum(F.when(~F.col("open"), F.col("capacity"))).over(whole), zero)
    weights = F.sum(F.when(F.col("open"), F.col("weight"))).over(whole)
    portion = F.floor(left.cast("decimal(38,0)") * F.col("weight") / weights).cast("long")
    return nodes.withColumn("budget", F.when(F.col("open"), portion).otherwise(F.col("capacity"))).drop(
        "given", "per", "filled", "weights", "full", "open"
    )


def leaf_budgets(leaves: DataFrame, mix: Mix) -> DataFrame:
    """Budgets of leaves (domain, lang, source, tokens). The tree has a row per node, not per document."""
    capacity = F.col("tokens") * mix.max_epochs
    leaves = leaves.withColumn("capacity", capacity)
    sums = [F.sum(c).alias(c) for c in ("capacity", "tokens")]
    langs = leaves.groupBy("domain", "lang").agg(*sums)
    domains = _weights(langs.groupBy("domain").agg(*sums), ["domain"], mix.domains).withColumn("name", F.col("domain"))
    supply = F.sum("tokens").over(Window.partitionBy("root"))  # one row per domain in this window
    total = F.lit(mix.budget).cast("long") if mix.budget is not None else F.floor(supply * mix.budget_percent / 100).cast("long")
    domains = share(domains.withColumn("root", F.lit(0)), ["root"], total).select("domain", F.col("budget").alias("total"))
    langs = _weights(langs, ["domain", "lang"], mix.langs).join(domains, "domain").withColumn("name", F.col("lang"))
    langs = share(langs, ["domain"], F.col("total")).select("domain", "lang", F.col("budget").alias("total"))
    leaves = _weights(leaves, ["domain", "lang", "source"], mix.sources).join(langs, ["domain", "lang"])
    leaves = share(leaves.withColumn("name", F.col("source")), ["domain", "lang"], F.col("total"))
    return leaves.select("domain", "lang", "source", "tokens", "budget")


LEAF = ["domain", "lang", "source"]


def mix_documents(
    docs: DataFrame, mix: Mix = Mix(), id: str = "doc_id", text: str = "text", lang: str = "lang",
    source: str = "source", domain: Column | None = None, tokens: Column | None = None,
) -> DataFrame:
    """Per document: id, domain, lang, source, n_tokens and ``copies``, how often it goes into the mix."""
    named = lambda c: F.coalesce(c, F.lit("-"))
    rows = written(docs.select(
        F.col(id).alias("id"),
        named(domain_of_source(source) if domain is None else domain).alias("domain"),
        named(F.col(lang)).alias("lang"),
        named(F.col(source)).alias("source"),
        (n_words(text) if tokens is None else tokens).alias("n_tokens"),
    ), "mix-rows")
    leaves = rows.groupBy(*LEAF).agg(F.sum("n_tokens").alias("tokens"))
    budgets = leaf_budgets(leaves, mix).select(
        *LEAF,
        F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.greatest("tokens", F.lit(1)))).otherwise(0).cast("int").alias("epochs"),
        F.when(F.col("tokens") > 0, F.pmod("budget", F.greatest("tokens", F.lit(1)))).otherwise(0).alias("rest"),
    )
    budgets = written(budgets, "mix-budgets")
    placed = join_groups(rows, budgets, LEAF)
    place = _order(mix.seed, F.col("epochs"), F.col("id"))
    placed = placed.withColumn("place", place).withColumn(
        "slot", F.shiftright("place", _ORDER_BITS - SLOTS.bit_length() + 1).cast("int")
    )
    slots = placed.groupBy(*LEAF, "slot").agg(F.sum("n_tokens").alias("tokens"), F.max("rest").alias("rest"))
    along = Window.partitionBy(*LEAF).orderBy("slot")
    cut = slots.withColumn("upto", F.sum("tokens").over(along)).filter(F.col("upto") > F.col("rest"))
    cut = cut.groupBy(*LEAF).agg(F.min(F.struct("slot", (F.col("rest") - F.col("upto") + F.col("tokens")).alias("room"))).alias("cut"))
    cut = written(cut.select(*LEAF, F.col("cut.slot").alias("last"), F.col("cut.room").alias("room")), "mix-cuts")
    placed = join_groups(placed, cut, LEAF)
    taken = F.col("last").isNull() | (F.col("slot") < F.col("last"))
    inside = Window.partitionBy(*LEAF).orderBy("place", "id", "n_tokens")
    edge = placed.filter(F.col("slot") == F.col("last")).withColumn(
        "fits", F.sum("n_tokens").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)) <= F.col("room")
    )
    clear = placed.filter(F.col("last").isNull() | (F.col("slot") != F.col("last"))).withColumn("fits", taken)
    return clear.unionByName(edge).select(
        F.col("id").alias(id), *LEAF, "n_tokens", (F.col("epochs") + F.col("fits").cast("int")).alias("copies")
    )


def mixed(docs: DataFrame, mix: Mix = Mix(), id: str = "doc_id", **columns) -> DataFrame:
    """The documents that go into the mix, with their own columns; meant for one epoch and unique ids."""
    left_out = mix_documents(docs, mix, id, **columns).filter("copies = 0").select(id)
    return without(docs, id, left_out)
