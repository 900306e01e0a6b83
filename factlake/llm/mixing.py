"""Mixing sources to target weights by hierarchical budgeting.

The leaves are (domain, lang, source).  A budget of tokens goes down the tree in proportion to the weights of the
children.  A child that cannot use its share (tokens there times ``max_epochs``) takes what it can, and the
shortage goes to its siblings in proportion to their weights; only what a whole subtree cannot use goes on to the
siblings of its ancestor.  Budgets are whole tokens.

Each leaf then orders its documents per epoch by a seeded MD5 of (seed, epoch, ``doc_id``, text) and takes the
longest prefix of that order that fits the budget: whole epochs first, then a prefix of the next.  The prefix is found from
token sums over the first ``PREFIX`` hex digits of the order, so that only the documents of one such cell per leaf
are ordered row by row.

A token is a word unless ``tokens`` names a column.  Nulls of domain, language and source are a value of their own.  A
child of weight None gets its share of the tokens of all siblings, and those with a number divide the rest; a child that
is not named beside named ones gets weight 0: it is used only after every sibling with weight.  Documents without tokens
cost nothing and are taken with the prefix they lie in.
"""

from __future__ import annotations

from collections import defaultdict
from fractions import Fraction

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factlake.session import materialize

PREFIX = 3
LEVELS = ("domain", "lang", "source")


def n_words(text: str = "text"):
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def share_out(budget: int, capacity: dict, weight: dict) -> dict:
    """Whole-number budgets of siblings: in proportion to weight, never above capacity, shortages shared again."""
    out = dict.fromkeys(capacity, 0)
    left = min(budget, sum(capacity.values()))
    for some in ([c for c in capacity if weight.get(c, 0) > 0], [c for c in capacity if weight.get(c, 0) <= 0]):
        open_ = [c for c in some if capacity[c] > 0]
        while open_ and left > 0:
            total = sum(Fraction(weight.get(c, 0)) if weight.get(c, 0) > 0 else Fraction(1) for c in open_)
            part = {c: left * (Fraction(weight.get(c, 0)) if weight.get(c, 0) > 0 else Fraction(1)) / total for c in open_}
            full = [c for c in open_ if out[c] + part[c] >= capacity[c]]
            if full:
                for c in full:
                    left -= capacity[c] - out[c]
                    out[c] = capacity[c]
                open_ = [c for c in open_ if c not in full]
                continue
            whole = {c: int(part[c]) for c in open_}
            rest = left - sum(whole.values())
            # largest remainders get the tokens that are left; ties by name
            for c in sorted(open_, key=lambda c: (whole[c] - part[c], str(c)))[:rest]:
                whole[c] += 1
            for c in open_:
                out[c] += whole[c]
            left = 0
    return out


def _weigh(kin: dict, named: dict) -> dict:
    """Numbers for the weights of siblings; None stands for the share of the tokens of ``kin``."""
    total = sum(kin.values())
    shares = {c: Fraction(kin[c], total) if total else Fraction(0) for c, w in named.items() if w is None}
    given = {c: Fraction(w) for c, w in named.items() if w is not None and w > 0}
    rest = (1 - sum(shares.values())) / (sum(given.values()) or 1)
    return shares | {c: w * rest for c, w in given.items()} if shares else named


def leaf_budgets(tokens: dict[tuple, int], weights: dict[tuple, float | None], budget: int, max_epochs: int) -> dict[tuple, int]:
    """Budget of every leaf.  ``weights`` may name a node at any level by its path; an unnamed one weighs its tokens."""
    capacity: dict[tuple, int] = defaultdict(int)
    for leaf, n in tokens.items():
        for k in range(len(leaf) + 1):
            capacity[leaf[:k]] += n * max_epochs
    children: dict[tuple, set] = defaultdict(set)
    for node in capacity:
        if node:
            children[node[:-1]].add(node)
    out = {(): min(budget, capacity.get((), 0))}
    for depth in range(len(LEVELS)):
        for node in [n for n in out if len(n) == depth]:
            kin = {c: capacity[c] for c in sorted(children[node], key=str)}
            named = {c: weights[c] for c in kin if c in weights}
            out.update(share_out(out[node], kin, _weigh(kin, named) if named else {c: capacity[c] for c in kin}))
    return {leaf: out[leaf] for leaf in tokens}


LEAF = ("__domain", "__lang", "__source")
#: Columns that the mix adds to the rows.
ADDED = ("mix_epoch", "mix_domain", "mix_tokens")


def _order(seed: int, epoch):
    text = F.coalesce(F.md5(F.col("text").cast("string")), F.lit(""))
    return F.md5(F.concat_ws("|", F.lit(str(seed)), epoch.cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), text))


def _on_leaf(rows: DataFrame, plan: DataFrame, *more: str) -> DataFrame:
    """Join on the leaf, nulls included; ``plan`` has a row per leaf and epoch, so it is as small as the tree."""
    plan = plan.select(*(F.col(c).alias(f"p{c}") for c in (*LEAF, *more)), *(c for c in plan.columns if c not in (*LEAF, *more)))
    same = rows[LEAF[0]].eqNullSafe(plan[f"p{LEAF[0]}"])
    for c in (*LEAF[1:], *more):
        same = same & rows[c].eqNullSafe(plan[f"p{c}"])
    return rows.join(plan, same).drop(*(f"p{c}" for c in (*LEAF, *more)))


def mix(docs: DataFrame, weights: dict[tuple, float | None], budget: int | float, domain, max_epochs: int = 4, seed: int = 0, tokens=None, added: tuple[str, str, str] = ADDED) -> DataFrame:
    """Rows of ``docs`` with ``mix_epoch``, ``mix_domain`` and ``mix_tokens``; a row comes once for each epoch that takes it.

    ``added`` may give these columns other names; a column of ``docs`` with such a name gives way.  Further columns of any
    name are carried along.

    ``weights`` names nodes by path: ``(domain,)``, ``(domain, lang)``, ``(domain, lang, source)``.  Where no child of a node is
    named, its children weigh what they hold.  ``budget`` is a number of tokens, or as a float a share of all.  ``domain``
    and ``tokens`` are columns over ``docs``.  One row per leaf reaches the driver, as many as the weights speak of.
    """
    spark = docs.sparkSession
    n = tokens if tokens is not None else n_words()
    # all counting runs on a narrow table; the texts are read once more at the end and never shuffled
    own = [c for c in docs.columns if c.lower() not in {x.lower() for x in added}]
    # a row travels as one value, so that no name in it meets a name used here
    packed = docs.select(
        *(c.cast("string").alias(x) for c, x in zip((domain, F.col("lang"), F.col("source")), LEAF)),
        F.col("doc_id").alias("doc_id"), F.col("text").alias("text"), n.cast("long").alias("n"), F.struct(*(F.col(f"`{c}`") for c in own)).alias("row"),
    )
    narrow = materialize(packed.select(*LEAF, "doc_id", F.md5(F.col("text").cast("string")).alias("digest"), "n"))
    sums = narrow.groupBy(*LEAF).agg(F.sum("n").alias("n")).collect()
    leaves = {(r[0], r[1], r[2]): int(r[3] or 0) for r in sums}
    whole = int(budget * sum(leaves.values())) if isinstance(budget, float) else int(budget)
    budgets = leaf_budgets(leaves, weights, whole, max_epochs)
    rows = []
    for leaf, held in leaves.items():
        full, rest = divmod(budgets[leaf], held) if held else (0, 0)
        rows += [(*leaf, e, held, True) for e in range(full)]
        if rest:
            rows.append((*leaf, full, rest, False))
    plan = spark.createDataFrame(rows, "__domain string, __lang string, __source string, mix_epoch int, room long, whole boolean")
    text = F.coalesce("digest", F.lit(""))
    order = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("mix_epoch").cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), text))
    partial = _on_leaf(narrow, plan.where("NOT whole")).withColumn("order", order).withColumn("cell", F.substring("order", 1, PREFIX))
    partial = materialize(partial.select(*LEAF, "mix_epoch", "room", "order", "cell", "n"))

    group = [*LEAF, "mix_epoch"]
    before = Window.partitionBy(*group).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)  # at most 16 ** PREFIX rows
    cells = partial.groupBy(*group, "room", "cell").agg(F.sum("n").alias("in_cell"))
    cells = cells.withColumn("before", F.coalesce(F.sum("in_cell").over(before), F.lit(0)))
    edge = materialize(cells.where("before <= room AND before + in_cell > room").select(*group, F.col("cell").alias("edge"), "before"))
    here = _on_leaf(partial, edge, "mix_epoch").where("cell = edge")
    upto = Window.partitionBy(*group).orderBy("order").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    fits = here.withColumn("upto", F.sum("n").over(upto)).where("before + upto <= room").groupBy(*group).agg(F.max("order").alias("last"))
    # orders of the cells before the edge are smaller than the name of the edge, those inside are greater
    name = edge.groupBy(*group).agg(F.max("edge").alias("last"))
    ends = materialize(fits.union(name).groupBy(*group).agg(F.max("last").alias("last")))
    ends = ends.select(*(F.col(c).alias(f"e{c}") for c in group), "last")
    same = plan[LEAF[0]].eqNullSafe(ends[f"e{LEAF[0]}"])
    for c in group[1:]:
        same = same & plan[c].eqNullSafe(ends[f"e{c}"])
    plan = plan.join(ends, same, "left").select(*group, "whole", "last")
    chosen = _on_leaf(packed, plan).where(F.col("whole") | F.col("last").isNull() | (_order(seed, F.col("mix_epoch")) <= F.col("last")))
    return chosen.select(*(F.col(f"row.`{c}`").alias(c) for c in own), *(F.col(c).alias(x) for c, x in zip(("mix_epoch", LEAF[0], "n"), added)))
