"""Mixing sources to target weights by hierarchical budgeting.

The leaves of a tree (domain, language, source by default) are the groups of rows with
the same values. A total of tokens is shared out from the root: each node's budget goes
to its children by their weights. A child that has less than its share (its tokens times
``max_epochs``) gets what it has, and the shortage goes to its siblings by weight; only
what all siblings together cannot take goes back up to the parent's siblings.

A leaf's rows are read in epochs, each in its own order by a seeded hash. The leaf takes
whole epochs while its budget lasts and then the prefix of the next epoch whose tokens
fit. The prefix is found in two steps: rows fall into ranges of the hash, a leaf's ranges
are summed and accumulated, and only the range where the budget ends is put in order row
by row. The number of ranges follows the number of rows, so a leaf with a third of all
rows is read by as many tasks as its size asks for.

Defined results: a null group value is a value of its own. Null and empty texts have no
tokens; such rows come with every whole epoch and with a prefix that reaches them (a budget
of whole epochs has no prefix). Rows
that share an id are put in order by a digest of their text; rows that share that as well
are taken as they are met.
Repeated rows count as rows. With nothing to choose from the result is empty. A leaf
without a weight has weight 1; a weight of 0 takes nothing unless all siblings are 0.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

LEVELS = ("domain", "lang", "source")
MAX_EPOCHS = 2.0
SEED = 20240501
#: Rows of a leaf that fall into one range of the hash, on average.
RANGE_ROWS = 200
#: Leaves up to which their figures are broadcast; beyond it they are joined by shuffle.
BROADCAST_LEAVES = 100_000

Key = tuple[str | None, ...]


@dataclass
class _Node:
    key: Key
    capacity: float = 0.0
    budget: float = 0.0
    children: dict = field(default_factory=dict)


def share_out(total: float, wanted: Sequence[float], capacity: Sequence[float]) -> list[float]:
    """Share ``total`` by weight; what exceeds a capacity goes to the others by weight."""
    given = [0.0] * len(wanted)
    open_ = [i for i in range(len(wanted)) if capacity[i] > 0]
    left = total
    while open_ and left > 1e-9:
        weight = sum(wanted[i] for i in open_)
        share = {i: left * (wanted[i] / weight if weight > 0 else 1 / len(open_)) for i in open_}
        full = [i for i in open_ if given[i] + share[i] >= capacity[i]]
        if not full:
            for i in open_:
                given[i] += share[i]
            break
        for i in full:
            left -= capacity[i] - given[i]
            given[i] = capacity[i]
        open_ = [i for i in open_ if i not in full]
    return given


def budgets(
    tokens: Mapping[Key, int],
    total: float,
    weights: Mapping[Key, float] | None = None,
    max_epochs: float = MAX_EPOCHS,
) -> dict[Key, float]:
    """Token budget of each leaf. ``weights`` has weights of nodes, by their path."""
    weights = weights or {}
    root = _Node(())
    for key in sorted(tokens, key=lambda k: tuple((x is not None, x or "") for x in k)):
        root.capacity += tokens[key] * max_epochs
        node = root
        for depth in range(1, len(key) + 1):
            node = node.children.setdefault(key[:depth], _Node(key[:depth]))
            node.capacity += tokens[key] * max_epochs
    root.budget = min(total, root.capacity)
    out, waiting = {}, [root]
    while waiting:
        node = waiting.pop()
        if not node.children:
            out[node.key] = node.budget
            continue
        children = list(node.children.values())
        given = share_out(
            node.budget,
            [weights.get(c.key, 1.0) for c in children],
            [c.capacity for c in children],
        )
        for child, budget in zip(children, given, strict=True):
            child.budget = budget
        waiting += children
    return out


def word_count(text: Column) -> Column:
    """Words as tokens; no tokenizer is needed to set proportions."""
    return F.coalesce(
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)
    ).cast("long")


def mix_sources(
    docs: DataFrame,
    total: float,
    levels: Sequence[str | Column] = LEVELS,
    weights: Mapping[Key, float] | None = None,
    max_epochs: float = MAX_EPOCHS,
    seed: int = SEED,
    id_column: str = "doc_id",
    text_column: str = "text",
    total_is_share: bool = False,
    epoch_column: str = "_epoch",
) -> DataFrame:
    """Chosen rows with all their columns and ``_epoch``, once for each epoch they are in.

    ``total`` counts tokens, or with ``total_is_share`` the share of all tokens. Other
    columns may have any names but that of ``epoch_column``, for which another may be given.
    """
    if epoch_column in docs.columns:
        raise ValueError(f"there is a column {epoch_column} already; name epoch_column otherwise")
    paths = [F.col(f"`{x}`") if isinstance(x, str) else x for x in levels]
    names = [f"_mix{i}" for i in range(len(paths))]
    text, of_row = F.col(f"`{text_column}`"), F.col(f"`{id_column}`").cast("string")
    # The caller's columns travel in one, so that no name of theirs is met.
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_mix_row"),
        *(p.cast("string").alias(n) for n, p in zip(names, paths, strict=True)),
        word_count(text).alias("_mix_tokens"),
        F.coalesce(of_row, text).alias("_mix_of"),
        F.xxhash64(text).alias("_mix_tie"),
    )
    leaves = rows.groupBy(*names).agg(
        F.sum("_mix_tokens").alias("tokens"), F.count("*").alias("n")
    )
    # One row for each leaf of the tree; the tree itself is what the caller weights.
    found = {tuple(r[: len(names)]): (r["tokens"], r["n"]) for r in leaves.toLocalIterator()}
    have = sum(t for t, _ in found.values())
    given = budgets(
        {k: t for k, (t, _) in found.items()},
        total * have if total_is_share else total,
        weights,
        max_epochs,
    )
    plan = []
    for key, (tokens, n) in found.items():
        whole = int((given[key] + 1e-6) // tokens) if tokens else int(max_epochs)
        rest = int(given[key] + 1e-6) - whole * tokens if tokens else 0
        plan.append((*key, whole, rest, max(1, n // RANGE_ROWS)))
    schema = ", ".join(f"{n} string" for n in names)
    table = docs.sparkSession.createDataFrame(
        plan, f"{schema}, _mix_whole int, _mix_rest long, _mix_ranges long"
    )
    small = len(plan) <= BROADCAST_LEAVES

    def with_leaf(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
        """Add the columns that ``right`` has for each leaf."""
        right = right.withColumnsRenamed({n: f"{n}r" for n in names})
        on = F.lit(True)
        for n in names:
            on = on & F.col(n).eqNullSafe(F.col(f"{n}r"))
        joined = left.join(F.broadcast(right) if small else right, on, how)
        return joined.drop(*(f"{n}r" for n in names))

    # The next epoch's order: a hash of seed, epoch and row; its upper bits give the range.
    planned = with_leaf(rows, table, "inner").withColumn(
        "_mix_order", F.xxhash64(F.lit(seed), "_mix_whole", "_mix_of")
    )
    place = F.shiftrightunsigned("_mix_order", 33) * F.col("_mix_ranges")
    planned = planned.withColumn("_mix_range", F.shiftright(place, 31))
    ranges = planned.groupBy(*names, "_mix_rest", "_mix_range").agg(
        F.sum("_mix_tokens").alias("_mix_sum")
    )
    running = Window.partitionBy(*names).orderBy("_mix_range")
    upto = F.sum("_mix_sum").over(running)
    # The first range that does not fit is where the leaf's budget ends.
    ends = (
        ranges.withColumn("_mix_upto", upto)
        .filter("_mix_upto > _mix_rest")
        .groupBy(*names)
        .agg(
            F.min("_mix_range").alias("_mix_end"),
            F.min_by(F.col("_mix_rest") - F.col("_mix_upto") + F.col("_mix_sum"), "_mix_range")
            .alias("_mix_left"),
        )
    )
    placed = with_leaf(planned, ends, "left")
    at_end = F.coalesce(F.col("_mix_range") == F.col("_mix_end"), F.lit(False))
    edge = placed.filter(at_end)
    within = (
        Window.partitionBy(*names, "_mix_range")
        .orderBy("_mix_order", "_mix_tie")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    edge = edge.withColumn(
        "_mix_in", F.sum("_mix_tokens").over(within) <= F.col("_mix_left")
    )
    rest = placed.filter(~at_end).withColumn(
        "_mix_in", F.coalesce(F.col("_mix_range") < F.col("_mix_end"), F.lit(True))
    )
    prefix = F.col("_mix_in") & (F.col("_mix_rest") > 0)
    times = F.col("_mix_whole") + prefix.cast("int")
    chosen = rest.unionByName(edge).filter(times > 0)
    out = chosen.withColumn("_mix_epoch", F.explode(F.sequence(F.lit(0), times - 1)))
    return out.select("_mix_row.*", F.col("_mix_epoch").alias(epoch_column))
