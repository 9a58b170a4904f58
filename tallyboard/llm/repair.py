"""Conversation structure: faults of turns, and the cheapest repair by an auction over the lattice of edits.

A node of the lattice is (turns consumed, what stands last in the repaired conversation). Arcs are edits with
integer costs. The auction raises node prices, from the last turn to the first, until they are exact distances
to the end; arcs whose cost equals the fall in price are tight, and the first tight edit in letter
order is followed from the start.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyboard.llm.common import WHITE

# What stands last in the repaired conversation: nothing, a system turn, a user's, an assistant's.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
#: A conversation may end here: empty, or with an assistant's turn.
ENDS = (START, ASSISTANT)
#: What must come next, but for a system turn at the start.
FOLLOWS = (USER, USER, ASSISTANT, USER)
ROLES = {USER: "user", ASSISTANT: "assistant"}
INITIALS = {"s": SYSTEM, "u": USER, "a": ASSISTANT}

# A turn as a byte: the state that its role leads to (START for any other role) and its fault.
ROLE, TRUNCATED, BLANK, DUPLICATE = 3, 4, 8, 16
GOES = BLANK | DUPLICATE

#: Conversations up to this length are looked up among those repaired before.
SHORT = 64

COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
PLAN = "conv_id long, " + ", ".join(f"{name} long" for name in COUNTS) + ", audit string"
#: Turns sort by number, a missing one first, then by role and text.
ORDER = ("turn", "role", "text")

#: Results that are handed on at once.
ROWS_AT_ONCE = 5_000


@dataclass(frozen=True)
class Costs:
    """Integer costs of edits; an insertion must cost something, or a repair could go round for ever."""

    keep: int = 0
    rerole: int = 3
    delete: int = 4
    insert: int = 3
    truncated: int = 3  # besides, for a truncated turn that stays

    def __post_init__(self) -> None:
        if min(self.keep, self.rerole, self.delete, self.truncated) < 0 or self.insert <= 0:
            raise ValueError("costs must not be negative, and an insertion must cost something")


# ---- The auction -------------------------------------------------------------------


@lru_cache(maxsize=4096)
def arcs_before(code: int | None, costs: Costs) -> tuple:
    """Arcs out of the nodes before a turn, by state: (letter, cost, turns consumed, state after) in letter order.

    None stands for the end of the conversation, where only insertions are left.
    """
    out = []
    for state in range(STATES):
        arcs = [("I", costs.insert, 0, FOLLOWS[state])]
        if code is not None:
            arcs.append(("D", costs.delete, 1, state))
        if code is not None and not code & GOES:
            role, stays = code & ROLE, costs.truncated if code & TRUNCATED else 0
            if role == FOLLOWS[state] or (role, state) == (SYSTEM, START):
                arcs.append(("K", costs.keep + stays, 1, role))
            if role != FOLLOWS[state]:
                arcs.append(("R", costs.rerole + stays, 1, FOLLOWS[state]))
        out.append(tuple(sorted(arcs)))
    return tuple(out)


def layer_prices(arcs: tuple, ahead: list[int], final: bool = False) -> list[int]:
    """Distances to the end from the four nodes before a turn, given those after it: an auction from each node.

    Prices begin at the least price ahead, so no price exceeds the cost of an arc and the price behind it. A path
    starts at its origin. If the best arc of its last node costs more than the node's price, the price rises to
    that and the path loses the node; else the path goes on along the arc. It is done when it leaves the
    turn or meets a node that is done: all its arcs are tight then, so its prices are distances.
    """
    price, done = [min(ahead)] * STATES, [False] * STATES
    for origin in range(STATES):
        path = [origin]
        while not done[origin]:
            node = path[-1]
            best, to = (0, None) if final and node in ENDS else (float("inf"), None)
            for _, cost, step, after in arcs[node]:
                offer = cost + (ahead[after] if step else price[after])
                if offer < best:
                    best, to = offer, None if step else after
            if best > price[node]:  # contraction
                price[node] = best
                if len(path) > 1:
                    path.pop()
            elif to is None or done[to]:
                for node in path:
                    done[node] = True
            else:  # extension
                path.append(to)
    return price


def auction_prices(codes: bytes, costs: Costs = Costs()) -> np.ndarray:
    """Distances to the end from all nodes, (turns + 1) x STATES; work and memory grow with the number of turns."""
    prices = np.empty((len(codes) + 1, STATES), np.int64)
    ahead = layer_prices(arcs_before(None, costs), [0] * STATES, final=True)
    prices[-1] = ahead
    for at in range(len(codes) - 1, -1, -1):
        ahead = layer_prices(arcs_before(codes[at], costs), ahead)
        prices[at] = ahead
    return prices


def trace(codes: bytes, prices: np.ndarray, costs: Costs = Costs()) -> str:
    """The edits of the path of tight arcs that is least in letter order. The arcs of a node differ in their letters."""
    at, state, letters = 0, START, []
    while at < len(codes) or state not in ENDS:
        for letter, cost, step, after in arcs_before(codes[at] if at < len(codes) else None, costs)[state]:
            if prices[at, state] == cost + prices[at + step, after]:
                break
        letters.append(letter)
        at, state = at + step, after
    return "".join(letters)


def _repair(codes: bytes, costs: Costs) -> tuple[int, str]:
    prices = auction_prices(codes, costs)
    return int(prices[0, START]), trace(codes, prices, costs)


_remembered = lru_cache(maxsize=100_000)(_repair)


def cheapest_repair(codes: bytes, costs: Costs = Costs()) -> tuple[int, str]:
    """(cost, edits) of a conversation given by the bytes of its turns."""
    return _remembered(codes, costs) if len(codes) <= SHORT else _repair(codes, costs)


# ---- Faults ------------------------------------------------------------------------

_WHITE = "".join(f"\\x{ord(c):02x}" for c in WHITE)


def _code(role: Column, text: Column) -> Column:
    """A turn's role and faults, but for duplicates, which only the conversation shows."""
    initial = F.substring(role, 1, 1)
    goes = F.lit(START)
    for letter, state in INITIALS.items():
        goes = F.when(initial == letter, state).otherwise(goes)
    fault = F.when(~text.rlike(f"[^{_WHITE}]"), BLANK).when(~text.rlike(rf"[.!?][{_WHITE}]*\z"), TRUNCATED).otherwise(0)
    return (goes + fault).cast("int")


def _turns(turns: DataFrame, conversation: str, turn: str, role: str, text: str) -> DataFrame:
    return turns.select(
        F.col(conversation).cast("long").alias("conv_id"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text), F.lit(" ")).alias("text"),
    )


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv_id, turns, codes, digests) of each conversation in rows sorted by it."""
    open_, conv = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        ids = batch.column("conv_id")
        value, null = ids.fill_null(0).to_numpy(zero_copy_only=False), ids.is_null().to_numpy(zero_copy_only=False)
        cuts = (np.flatnonzero((value[1:] != value[:-1]) | (null[1:] != null[:-1])) + 1).tolist()
        for start, end in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            here = None if null[start] else int(value[start])
            if open_ and here != conv:
                yield conv, *_columns(open_)
                open_ = []
            conv = here
            open_.append(batch.slice(start, end - start))
    if open_:
        yield conv, *_columns(open_)


def _columns(parts: list[pa.RecordBatch]) -> tuple:
    whole = pa.Table.from_batches(parts)
    turns = whole.column("turn").drop_null().to_numpy()
    codes = whole.column("code").to_numpy().astype(np.uint8)
    return turns, codes, np.array(whole.column("digest").to_pylist(), "S32")


def plan_of(turns: np.ndarray, codes: np.ndarray, digests: np.ndarray, costs: Costs = Costs()) -> tuple:
    """The counts and the audit of one conversation, its turns in order; ``turns`` holds the numbers present."""
    blank = (codes & BLANK) > 0
    first = np.zeros(len(codes), bool)
    first[np.unique(digests, return_index=True)[1]] = True
    again = ~first & ~blank
    codes = np.where(again, (codes & ROLE) | DUPLICATE, codes).astype(np.uint8)
    gaps = int(turns[-1] - turns[0] + 1 - len(np.unique(turns))) if len(turns) else 0
    state = codes & ROLE
    legal = (state[1:] != SYSTEM) & (state[1:] == np.array(FOLLOWS)[state[:-1]]) & (state[:-1] != START)
    cost, audit = cheapest_repair(codes.tobytes(), costs)
    counts = blank.sum(), again.sum(), ((codes & TRUNCATED) > 0).sum(), (~legal).sum()
    return gaps, *map(int, counts), cost, audit


def repair_plans(
    turns: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    costs: Costs = Costs(),
) -> DataFrame:
    """One row per conversation: its faults and its cheapest repair.

    conv_id; gaps (numbers missing between the least and the largest turn); blank (no character but
    white space), duplicate (role and text of an earlier turn), truncated (last such character is none of ``.!?``),
    a turn counting for its first fault; illegal (neighbours, as they stand, that are not
    system-user, user-assistant or assistant-user); cost; audit: the edits in order.

    Edits: K keeps a turn, R gives it the other role, D deletes it, I inserts an empty turn. Blank and duplicate turns must go.
    Roles count by their first letter; the repaired ones are ``(s?(ua)+)?``. Of repairs of one cost, the least audit in letter order.

    A null role or text counts as one space; a null conversation id is a conversation of its own; turns without a
    number come first; of equal turns all but one are duplicates. No row: no result. Extra columns are ignored.

    Texts go no further than the sort, which spills. Of a conversation a task holds a byte, a digest and a number for each
    turn, and its prices: a fixed multiple of the audit, which is one value of the result.
    """
    rows = _turns(turns, conversation, turn, role, text)
    digest = F.unhex(F.sha2(F.concat(F.char_length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    coded = (
        rows.withColumns({"code": _code(F.col("role"), F.col("text")), "digest": digest})
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", *ORDER)
        .select("conv_id", "turn", "code", "digest")
    )

    def plans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for conv, *columns in _gathered(batches):
            held.append((conv, *plan_of(*columns, costs)))
            if len(held) >= ROWS_AT_ONCE:
                yield _plan_batch(held)
                held = []
        yield _plan_batch(held)

    return coded.mapInArrow(plans, PLAN)


def _plan_batch(rows: list[tuple]) -> pa.RecordBatch:
    names = ["conv_id", *COUNTS, "audit"]
    kinds = [pa.int64()] * (len(names) - 1) + [pa.string()]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


# ---- Repaired turns ----------------------------------------------------------------

REPAIRED = "conv_id long, place long, edit string, role string, text string"
HASHED = PLAN + ", turns long, sha256 string"


class _Replay:
    """Follows the audit of one conversation while its turns pass by."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, START

    def inserted(self) -> Iterator[tuple[str, str, str]]:
        """The turns inserted before the next one, or at the end."""
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            self.state = FOLLOWS[self.state]
            yield "I", ROLES[self.state], ""

    def turn(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.state = INITIALS[role[0]]
            yield edit, role, text
        elif edit == "R":
            self.state = FOLLOWS[self.state]
            yield edit, ROLES[self.state], text


def _replayed(turns: DataFrame, plans: DataFrame, names: tuple) -> DataFrame:
    """The plan of each conversation, then its turns, in order."""
    rows = _turns(turns, *names)
    with_plan = plans.select(
        "conv_id", F.lit(0).alias("part"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"),
        F.lit("").alias("text"), "audit", *COUNTS,
    )
    nothing = [F.lit(None).cast("string").alias("audit"), *[F.lit(None).cast("long").alias(name) for name in COUNTS]]
    with_text = rows.select("conv_id", F.lit(1).alias("part"), "turn", "role", "text", *nothing)
    both = with_plan.unionByName(with_text).repartition("conv_id")
    return both.sortWithinPartitions("conv_id", "part", *ORDER).select("conv_id", "audit", "role", "text", *COUNTS)


def repaired_turns(
    turns: DataFrame,
    plans: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """The repaired conversations, a row per turn: conv_id, place (from 0), edit (K, R or I), role, text.

    ``plans`` are those of ``repair_plans`` over the same turns. Texts stream through sorted; none is gathered.
    """

    def replay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, conv, place, out = None, None, 0, []

        def put(found) -> None:
            nonlocal place
            for edit, said_by, said in found:
                out.append((conv, place, edit, said_by, said))
                place += 1

        for batch in batches:
            columns = [batch.column(name).to_pylist() for name in ("conv_id", "audit", "role", "text")]
            for here, audit, said_by, said in zip(*columns, strict=True):
                if audit is None:
                    put(now.turn(said_by, said))
                else:
                    put(now.inserted() if now else ())
                    now, conv, place = _Replay(audit), here, 0
            yield _turn_batch(out)
            out.clear()
        put(now.inserted() if now else ())
        yield _turn_batch(out)

    return _replayed(turns, plans, (conversation, turn, role, text)).mapInArrow(replay, REPAIRED)


def _turn_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * 5
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
    names = ["conv_id", "place", "edit", "role", "text"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def repaired_digests(
    turns: DataFrame,
    plans: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """``plans`` with the number of repaired turns and the SHA-256 of their lines ``role:text``, joined by line feeds.

    A digest runs over its conversation in order, a batch of texts at a time; no turns: that of the empty string.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, plan, sha, count, out = None, (), None, 0, []

        def put(found) -> None:
            nonlocal count
            for _, said_by, said in found:
                sha.update(f"{chr(10) if count else ''}{said_by}:{said}".encode())
                count += 1

        def close() -> None:
            if now:
                put(now.inserted())
                out.append((*plan, count, sha.hexdigest()))

        for batch in batches:
            columns = [batch.column(name).to_pylist() for name in ("conv_id", *COUNTS, "audit", "role", "text")]
            for *values, said_by, said in zip(*columns, strict=True):
                if values[-1] is None:
                    put(now.turn(said_by, said))
                else:
                    close()
                    now, plan, sha, count = _Replay(values[-1]), tuple(values), hashlib.sha256(), 0
            yield _digest_batch(out)
            out.clear()
        close()
        yield _digest_batch(out)

    return _replayed(turns, plans, (conversation, turn, role, text)).mapInArrow(digest, HASHED)


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    plans = _plan_batch([row[:-2] for row in rows])
    more = [pa.array([row[-2] for row in rows], pa.int64()), pa.array([row[-1] for row in rows], pa.string())]
    return pa.RecordBatch.from_arrays([*plans.columns, *more], [*plans.schema.names, "turns", "sha256"])
