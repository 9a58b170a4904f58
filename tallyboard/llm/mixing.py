"""Mixing sources to target weights: block quotas split over output shards, disjoint permuted blocks."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyboard.llm.common import attach_groups, stored, text_or_empty, word_count
from tallyboard.operators.lookup import attach

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST_TIMES = 2
#: Words of a shard, rows of a block.
SHARD_WORDS = 50_000_000
BLOCK_ROWS = 512
SEED = 20_240_501
#: Sources meet in so many groups; a task holds the quotas of all groups, or of the sources of one.
GROUPS = 256
#: A document above this share of what a source still needs is decided before the others.
LARGE = 1 / 16
#: A source's room is filled until it is below this share of its target, or nothing fits.
CLOSE = 1e-4
MOST_ROUNDS = 12

_NEVER = (1 << 63) - 1


# ---- Targets -----------------------------------------------------------------------


def with_weights(sources: DataFrame, weights: Sequence[float]) -> DataFrame:
    """Sources in order of their keys get the weights in turn. A source's number is its place among the ordered files' rows."""
    ordered = stored(
        sources.repartitionByRange("source_key").sortWithinPartitions("source_key").withColumn("place", F.monotonically_increasing_id()),
        "ordered",
    ).withColumn("part", F.shiftright("place", 33))
    parts = ordered.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each file
    numbered = ordered.join(parts.select("part", "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")), "part")
    number = F.col("before") + F.col("place") - F.col("first")
    chosen = F.get(F.array(*map(F.lit, weights)), (number % len(weights)).cast("int"))
    return numbered.withColumn("weight", chosen).drop("place", "part", "first", "before")


def with_targets(sources: DataFrame, share: float, most_times: float) -> DataFrame:
    """Sources with ``target``: ``share`` of all words by weight, none above ``most_times`` its size.

    What a full source cannot take is shared by weight among the others, until none is above: each round sums
    the limits of the full ones and the weights of the others, and can only add to the full ones.
    """
    limit = F.col("source_size") * F.lit(float(most_times))
    whole = sources.agg(F.sum("source_size").alias("words"), F.sum("weight").alias("weight")).first()
    wanted = min(share, most_times) * float(whole.words or 0)
    left, weight, full = wanted, float(whole.weight or 1), 0
    while True:
        part = F.lit(left) * F.col("weight") / F.lit(weight)
        found = sources.agg(
            F.count_if(part > limit).alias("full"),
            F.coalesce(F.sum(F.when(part > limit, limit)), F.lit(0.0)).alias("limits"),
            F.coalesce(F.sum(F.when(~(part > limit), F.col("weight"))), F.lit(0.0)).alias("weight"),
        ).first()
        if found.full == full or not found.weight:
            break
        left, weight, full = wanted - found.limits, found.weight, found.full
    return sources.withColumn("target", F.least(F.lit(left) * F.col("weight") / F.lit(weight), limit))


# ---- Which documents ---------------------------------------------------------------


@dataclass(frozen=True)
class _Rows:
    """Documents in permuted order within their sources: source_key, place, size (a row each); how many there are."""

    frame: DataFrame
    total: int

    def with_state(self, state: DataFrame) -> DataFrame:
        return attach_groups(self.frame, state, "source_key", "rows", self.total, "place")


def _crossing(rows: _Rows, state: DataFrame) -> DataFrame:
    """Where the running sum of a source exceeds its ``goal``: (source_key, cross, sum), the place of that row and the sum before it.

    Only rows after ``after`` and with sizes above ``least``, up to ``most`` count. Without such a row, cross is beyond all places. Sums
    of whole files come first; then only the rows of the file with the crossing are put in order, one file per source.
    """
    counted = "place > after AND size > least AND size <= most"
    marked = rows.with_state(state.select("source_key", "rows", "goal", "after", "least", "most")).where(counted)
    marked = marked.withColumn("part", F.shiftright("place", 33))
    upto = Window.partitionBy("source_key").orderBy("part")
    parts = marked.groupBy("source_key", "part", "goal").agg(F.sum("size").alias("words")).withColumn("upto", F.sum("words").over(upto))
    files = stored(
        parts.groupBy("source_key").agg(
            F.min(F.when(F.col("upto") > F.col("goal"), F.struct("part", (F.col("upto") - F.col("words")).alias("before")))).alias("at"),
            F.max("upto").alias("all"),
        ),
        "files",
    )
    at = files.where("at IS NOT NULL").select("source_key", F.col("at.part").alias("part"), F.col("at.before").alias("before"))
    inside = marked.join(at, ["source_key", "part"]).withColumn(
        "upto", F.col("before") + F.sum("size").over(Window.partitionBy("source_key", "part").orderBy("place"))
    )
    found = inside.groupBy("source_key").agg(
        F.min(F.when(F.col("upto") > F.col("goal"), F.col("place"))).alias("cross"),
        F.max(F.when(F.col("upto") <= F.col("goal"), F.col("upto"))).alias("below"),
        F.first("before").alias("before"),
    )
    return files.join(found, "source_key", "left").select(
        "source_key",
        F.coalesce("cross", F.lit(_NEVER)).alias("cross"),
        F.when(F.col("at").isNull(), F.col("all")).otherwise(F.coalesce("below", "before")).alias("sum"),
    )


def _taken_again(rows: _Rows, sources: DataFrame) -> DataFrame:
    """For each source the ``runs`` of documents (after, before, least, most) that the rest of its target takes once more.

    Large documents go first, as many in permuted order as their share of the words, or as the small ones cannot make
    up for. Then the small ones, up to the first that does not fit; then those after it that fit the room that is left, and so on, until
    the room is below a share of the target or nothing fits. Last, one document more, if that brings the sum nearer.
    """
    large = F.col("rest") * F.lit(LARGE)
    base = sources.select("source_key", "rows", "source_size", "target", "rest")
    sizes = rows.with_state(base.select("source_key", "rows", large.alias("large"))).groupBy("source_key").agg(
        F.coalesce(F.sum(F.when(F.col("size") > F.col("large"), F.col("size"))), F.lit(0)).alias("large_words")
    )
    small = F.col("source_size") - F.col("large_words")
    by_share = F.when(F.col("source_size") > 0, F.col("rest") * F.col("large_words") / F.col("source_size")).otherwise(0.0)
    first = stored(
        base.join(sizes, "source_key").withColumns(
            {
                "goal": F.greatest(by_share, F.col("rest") - small),
                "after": F.lit(-1).cast("long"),
                "least": F.floor(large).cast("long"),
                "most": F.lit(_NEVER),
            }
        ),
        "state",
    )
    crossed = _crossing(rows, first)
    state = first.join(crossed, "source_key", "left").withColumns(
        {"cross": F.coalesce("cross", F.lit(_NEVER)), "sum": F.coalesce("sum", F.lit(0))}
    )
    run = F.struct(
        F.lit(-1).cast("long").alias("after"), F.col("cross").alias("before"), F.col("least"), F.lit(_NEVER).alias("most")
    )
    state = stored(
        state.select(
            "source_key", "rows", "target", F.array(run).alias("runs"), (F.col("rest") - F.col("sum")).alias("room"),
            F.lit(-1).cast("long").alias("after"), F.lit(-1).cast("long").alias("least"), F.col("least").alias("most"),
        ),
        "state",
    )
    for _ in range(MOST_ROUNDS):
        open_ = state.where((F.col("room") >= 1) & (F.col("room") > F.col("target") * CLOSE) & (F.col("after") < _NEVER))
        if open_.isEmpty():
            break
        crossed = _crossing(rows, open_.withColumn("goal", F.col("room")))
        joined = state.join(crossed, "source_key", "left")
        run = F.struct("after", F.col("cross").alias("before"), "least", "most")
        room = F.col("room") - F.coalesce("sum", F.lit(0))
        went_on = F.col("cross").isNotNull()
        state = stored(
            joined.select(
                "source_key", "rows", "target",
                F.when(went_on, F.concat("runs", F.array(run))).otherwise(F.col("runs")).alias("runs"),
                room.alias("room"),
                F.when(went_on, F.col("cross")).otherwise(F.lit(_NEVER)).alias("after"),
                "least",
                F.least(F.col("most"), F.floor(room).cast("long")).alias("most"),
            ),
            "state",
        )
    nearest = (
        rows.with_state(state.where("room >= 1").select("source_key", "rows", "room", "runs"))
        .where(F.col("runs").isNotNull() & ~_in_runs() & (F.col("size") > 0) & (F.col("size") < 2 * F.col("room")))
        .groupBy("source_key")
        .agg(F.min(F.struct(F.abs(F.col("size") - F.col("room")).alias("off"), "place")).alias("one"))
    )
    one = F.struct(
        (F.col("one.place") - 1).alias("after"), (F.col("one.place") + 1).alias("before"),
        F.lit(-1).cast("long").alias("least"), F.lit(_NEVER).alias("most"),
    )
    done = state.join(nearest, "source_key", "left")
    return stored(
        done.select("source_key", F.when(F.col("one").isNull(), F.col("runs")).otherwise(F.concat("runs", F.array(one))).alias("runs")),
        "runs",
    )


def _in_runs():
    inside = lambda r: (
        (F.col("place") > r["after"]) & (F.col("place") < r["before"]) & (F.col("size") > r["least"]) & (F.col("size") <= r["most"])
    )
    return F.exists("runs", inside)


# ---- Shards ------------------------------------------------------------------------


def split_quotas(quotas: np.ndarray, totals: np.ndarray, seed: Sequence[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Exact quotas of every shard and source, as (shard, source, blocks) where there are any: a tree of multivariate hypergeometric draws.

    ``totals`` is how many blocks each shard gets; each node draws those of its left half from its quotas.
    """
    upto = np.concatenate(([0], np.cumsum(np.asarray(totals, np.int64))))
    quotas = np.asarray(quotas, np.int64)
    found, nodes = [], [(0, len(totals), np.flatnonzero(quotas), quotas[quotas > 0])]
    while nodes:
        first, end, which, here = nodes.pop()
        if not len(which):
            continue
        if end - first == 1:
            found.append((np.full(len(which), first), which, here))
            continue
        middle = (first + end) // 2
        left = draw(here, int(upto[middle] - upto[first]), np.random.default_rng([*seed, first, end]))
        right = here - left
        nodes += [(first, middle, which[left > 0], left[left > 0]), (middle, end, which[right > 0], right[right > 0])]
    if not found:
        return (np.empty(0, np.int64),) * 3
    return tuple(np.concatenate(column).astype(np.int64) for column in zip(*sorted(found, key=lambda f: f[0][0]), strict=True))


def draw(quotas: np.ndarray, count: int, rng: np.random.Generator) -> np.ndarray:
    """A multivariate hypergeometric draw; source by source, so that quotas of any size do."""
    if quotas.sum() < 1_000_000_000:
        return rng.multivariate_hypergeometric(quotas, count, method="marginals")
    # Beyond what the library draws from: in halves of the quotas, which give half each.
    half = quotas // 2
    first = min(count // 2, int(half.sum()))
    return draw(half, first, rng) + draw(quotas - half, count - first, rng)


def even(blocks: int, shards: int) -> np.ndarray:
    return np.diff(np.arange(shards + 1, dtype=np.int64) * blocks // shards)


def _shard_runs(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """(source_key, shard, first, n): which of a source's drawn blocks each shard gets, from (source_key, quota).

    Sources meet in GROUPS groups: one tree splits the quotas of the groups, one for each group those of its
    sources; both together are one draw.
    """
    grouped = stored(quotas.withColumn("group", F.pmod(F.xxhash64("source_key"), F.lit(GROUPS)).cast("int")), "quotas")

    def groups(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = list(frames)
        if held:
            all_ = pd.concat(held).sort_values("group").reset_index(drop=True)
            shard, which, blocks = split_quotas(all_["blocks"].to_numpy(), even(int(all_["blocks"].sum()), shards), [seed])
            parts = np.zeros((len(all_), shards), np.int64)
            parts[which, shard] = blocks
            yield pd.DataFrame({"of_group": all_["group"], "totals": list(parts)})

    totals = stored(
        grouped.groupBy("group").agg(F.sum("quota").alias("blocks")).coalesce(1)  # GROUPS rows at most
        .mapInPandas(groups, "of_group int, totals array<long>"),
        "totals",
    )

    def sources(keys: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        left = left.sort_values("source_key").reset_index(drop=True)
        shard, which, blocks = split_quotas(left["quota"].to_numpy(), right["totals"].iloc[0], [seed, int(keys[0]) + 1])
        # Shards come in order, so a source's earlier blocks are those of the rows before.
        runs = pd.DataFrame({"source_key": left["source_key"].to_numpy()[which], "shard": shard, "n": blocks})
        runs["first"] = runs.groupby("source_key")["n"].cumsum() - runs["n"]
        return runs[["source_key", "shard", "first", "n"]]

    both = grouped.groupBy("group").cogroup(totals.groupBy("of_group"))
    return both.applyInPandas(sources, "source_key string, shard int, first long, n long")


# ---- The mix -----------------------------------------------------------------------


@dataclass(frozen=True)
class Mix:
    """``documents``: place, doc_id, size, source_key, source_size, target; ``draws``: place, copy, shard, order, a row each time a document is drawn."""

    documents: DataFrame
    draws: DataFrame
    shards: int

    def counted(self) -> DataFrame:
        """``documents`` with ``copies``: how often the shards hold each."""
        drawn = self.draws.groupBy("place").agg(F.count(F.lit(1)).alias("copies"))
        joined = self.documents.join(drawn, "place", "left")
        return joined.withColumn("copies", F.coalesce("copies", F.lit(0)).cast("long"))


def mix(
    documents: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    source: str = "source",
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most_times: int = MOST_TIMES,
    shards: int | None = None,
    block_rows: int = BLOCK_ROWS,
    seed: int = SEED,
) -> Mix:
    """Which documents the mix takes, how often, and in which output shard and order.

    The size is the number of words. Sources in order of code points, null last, have the
    ``weights`` in turn; a source's target is its share of ``share`` of all words, none above ``most_times`` its size. A
    source's documents stand in a permuted order: all are taken as often as the target holds the whole source; for
    the rest see ``_taken_again``. No document is taken more than ``most_times``.

    The permuted order is cut into blocks of ``block_rows`` documents. A tree of multivariate hypergeometric draws says
    how many of a source's drawn blocks each shard gets (by default a shard for every SHARD_WORDS words); they are dealt in order, so
    shards hold disjoint blocks, and ``order`` shuffles within a shard. The same rows give the same mix.

    A null text has size 0; a null source is a source of its own; rows without an id, or with the id of another row, are documents of
    their own, told apart by ``place``, which follows the order. Rows repeated in full are any of them. Without words every target is
    0. No row: no result. Blocks are runs of the order, so no source, id or copied row makes one large.
    """
    sized = documents.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.coalesce(F.concat(F.lit("s"), F.col(source)), F.lit("t")).alias("source_key"),
        word_count(text_or_empty(text)).alias("size"),
        F.xxhash64(F.lit(seed), F.col(doc_id).cast("long"), text_or_empty(text)).alias("draw"),
    )
    order = ["source_key", "draw", "doc_id", "size"]
    light = stored(sized, "sized")
    placed = stored(
        light.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id()), "placed"
    )
    total = placed.count()
    sources = placed.groupBy("source_key").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    targets = with_targets(stored(with_weights(sources, weights), "sources"), share, most_times)
    whole = F.when(
        F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(most_times))
    ).otherwise(0).cast("long")
    rest = F.greatest(F.col("target") - F.col("whole") * F.col("source_size"), F.lit(0.0))
    planned = stored(targets.withColumn("whole", whole).withColumn("rest", rest), "planned")
    rows = _Rows(placed.select("source_key", "place", "size"), total)
    runs = _taken_again(rows, planned.where("rest >= 1"))

    # Places of a file follow on each other, so a document's number in its source needs no sorting.
    parts = placed.groupBy("source_key", F.shiftright("place", 33).alias("part")).agg(
        F.count(F.lit(1)).alias("n"), F.min("place").alias("first_place")
    )
    earlier = Window.partitionBy("source_key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("source_key", "part", "first_place", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    no_runs = F.array().cast("array<struct<after:long,before:long,least:long,most:long>>")
    plan = planned.join(runs, "source_key", "left").withColumn("runs", F.coalesce("runs", no_runs))
    plan = plan.select("source_key", "rows", "source_size", "target", "whole", "runs")
    with_plan = attach_groups(placed, plan, "source_key", "rows", total, "place").withColumn("part", F.shiftright("place", 33))
    numbered = attach(with_plan, offsets, ["source_key", "part"])
    number = F.col("before") + F.col("place") - F.col("first_place")
    decided = stored(
        numbered.withColumn("number", number).select(
            "place", "doc_id", "size", "source_key", "source_size", "target",
            "draw", F.expr(f"number div {block_rows}").alias("block"),
            (F.col("whole") + _in_runs().cast("long")).alias("times"),
        ),
        "decided",
    )
    # A block counts once for each time that any of its documents is drawn.
    copies = decided.where("times > 0").select("place", "doc_id", "draw", "source_key", "block", F.explode(F.sequence(F.lit(1).cast("long"), "times")).alias("copy"))
    blocks = stored(copies.select("source_key", "copy", "block").distinct(), "blocks")
    wanted = planned.agg(F.sum("target")).first()[0] or 0.0
    count = shards or max(1, round(wanted / SHARD_WORDS))
    dealt = _shard_runs(blocks.groupBy("source_key").agg(F.count(F.lit(1)).alias("quota")), count, seed)
    numbers = dealt.select("source_key", "shard", F.explode(F.sequence("first", F.col("first") + F.col("n") - 1)).alias("number"))
    by_source = Window.partitionBy("source_key").orderBy(F.xxhash64(F.lit(seed), "source_key", "copy", "block"), "copy", "block")
    located = stored(
        blocks.withColumn("number", F.row_number().over(by_source).cast("long") - 1)
        .join(numbers, ["source_key", "number"])
        .select("source_key", "copy", "block", "shard"),
        "located",
    )
    drawn = stored(
        copies.join(located, ["source_key", "copy", "block"]).select(
            "place", "copy", "shard", F.xxhash64(F.lit(seed), "draw", "doc_id", "copy").alias("order")
        ),
        "draws",
    )
    return Mix(decided.drop("draw", "block", "times"), drawn, count)
