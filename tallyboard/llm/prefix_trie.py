"""The trie of conversations by their first turns: what a prefix cache shares.

Turns become numbers by a dictionary, conversations become sequences of them, sorted and cut into range shards.
A task builds the ternary search tree of its shard; nodes that a neighbouring shard may have too are
merged afterwards. All other nodes are final at once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyboard.llm.common import attach_groups, stored, text_or_empty, word_count
from tallyboard.operators.lookup import attach

#: Turns that a shard holds on average, at most.
SHARD_TURNS = 200_000
#: Conversation ids in one piece of text.
IDS_AT_ONCE = 50_000
ROOT_KEY = "0" * 32

NODE = "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"

_FINAL, _SHARED, _ENDS = range(3)
_LONGS = "kind", "depth", "words", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"
_TEXTS = "key", "parent_key", "ends"
_FOUND = ", ".join([*[f"{name} long" for name in _LONGS], *[f"{name} string" for name in _TEXTS]])


# ---- Turns as numbers --------------------------------------------------------------


def encode_turns(
    turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """A row per conversation: conv_id, ids and words (arrays: the numbers and the word counts of its turns, in order).

    Equal turns (role and text) have one number; numbers are in order of role, then text. Turns sort by ``turn``, a
    missing one first, then by number. A null role or text is empty; a repeated row is a repeated turn. Rows
    without a conversation id belong to none and are left out. No row: no result. Extra columns are ignored.

    A turn that very many conversations have meets its number by a broadcast of such turns alone. The numbers of one
    conversation, not its texts, meet in one task; they are one value of the result.
    """
    said = [F.coalesce(F.col(role), F.lit("")).alias("role"), text_or_empty(text).alias("text")]
    rows = turns.select(F.col(conversation).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"), *said)
    digest = F.sha2(F.concat(F.char_length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    rows = rows.where("conv_id IS NOT NULL").withColumn("digest", digest)
    distinct = rows.groupBy("digest", "role", "text").agg(F.count(F.lit(1)).alias("uses"))
    dictionary = stored(
        distinct.repartitionByRange("role", "text")
        .sortWithinPartitions("role", "text")
        .select("digest", F.monotonically_increasing_id().alias("id"), word_count(F.col("text")).alias("words"), "uses"),
        "dictionary",
    )
    total = dictionary.agg(F.sum("uses")).first()[0] or 0
    coded = attach_groups(rows.select("conv_id", "turn", "digest"), dictionary, "digest", "uses", total, "conv_id")
    whole = coded.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "id", "words"))).alias("turns"))
    return whole.select("conv_id", F.col("turns.id").alias("ids"), F.col("turns.words").alias("words"))


# ---- One shard ---------------------------------------------------------------------


class TernaryTree:
    """A ternary search tree: siblings are a binary tree by ``low`` and ``high``, ``same`` leads to the next turn. Node 0 is the root."""

    def __init__(self):
        self.id, self.words, self.low, self.same, self.high, self.end = [-1], [0], [-1], [-1], [-1], [-1]

    def _new(self, id_: int, words: int) -> int:
        for column, value in ((self.id, id_), (self.words, words), (self.low, -1), (self.same, -1), (self.high, -1), (self.end, -1)):
            column.append(value)
        return len(self.id) - 1

    def insert(self, ids: list[int], words: list[int], mark: int) -> list[int]:
        """Add a sequence, whose last node gets ``mark``; returns its nodes, the root first."""
        at, path = 0, [0]
        for id_, count in zip(ids, words, strict=True):
            side, owner = self.same, at
            at = side[owner]
            while at >= 0 and self.id[at] != id_:
                side, owner = (self.low if id_ < self.id[at] else self.high), at
                at = side[owner]
            if at < 0:
                at = side[owner] = self._new(id_, count)
            path.append(at)
        self.end[at] = mark
        return path

    def children(self, node: int) -> Iterator[int]:
        """In order of their numbers."""
        waiting, at = [], self.same[node]
        while waiting or at >= 0:
            while at >= 0:
                waiting.append(at)
                at = self.low[at]
            at = waiting.pop()
            yield at
            at = self.high[at]

    def preorder(self) -> tuple[list[int], list[int], list[int]]:
        """(nodes, parent of each node, depth of each node), parents before children."""
        order, parent, depth, waiting = [], [-1] * len(self.id), [0] * len(self.id), [0]
        while waiting:
            node = waiting.pop()
            order.append(node)
            for child in self.children(node):
                parent[child], depth[child] = node, depth[node] + 1
                waiting.append(child)
        return order, parent, depth


def medians(count: int) -> Iterator[int]:
    """0 to count-1, the middle one first, then the middles of both sides: sorted sequences inserted so make balanced siblings."""
    waiting = [(0, count)]
    while waiting:
        start, end = waiting.pop()
        if start < end:
            middle = (start + end) // 2
            yield middle
            waiting += [(middle + 1, end), (start, middle)]


def next_key(key: str, id_: int) -> str:
    """The name of a prefix in all shards: a chained 128-bit digest of its numbers."""
    return hashlib.blake2b(bytes.fromhex(key) + id_.to_bytes(8, "little"), digest_size=16).hexdigest()


def shard_nodes(sequences: list[tuple[list[int], list[int]]], members: list[list[int]]) -> Iterator[tuple]:
    """What a shard knows of its nodes, as rows of _LONGS and _TEXTS.

    ``sequences`` are the distinct ones in order, ``members`` the conversations of each, ascending. Nodes on the way to the
    first and to the last sequence may go on in a neighbouring shard: they are given in part, without what
    nodes of their kind below them add, and with the conversations that end there as text.
    """
    if not sequences:
        return
    tree, edge = TernaryTree(), set()
    for k in medians(len(sequences)):
        path = tree.insert(*sequences[k], k)
        if k in (0, len(sequences) - 1):
            edge.update(path)
    order, parent, depth = tree.preorder()
    size = len(tree.id)
    convs, least, children, leaves, saved = [0] * size, [None] * size, [0] * size, [0] * size, [0] * size
    key = {0: ROOT_KEY}
    for node in order[1:]:
        if node in edge or parent[node] in edge:
            key[node] = next_key(key[parent[node]], tree.id[node])
    for node in reversed(order):
        own = members[tree.end[node]] if tree.end[node] >= 0 else ()
        convs[node] += len(own)
        if own and (least[node] is None or own[0] < least[node]):
            least[node] = own[0]
        if node not in edge:
            leaves[node] += not children[node]
            saved[node] += (convs[node] - 1) * tree.words[node]
        up = parent[node]
        if up < 0:
            continue
        convs[up] += convs[node]
        if least[up] is None or least[node] < least[up]:
            least[up] = least[node]
        if node not in edge:
            children[up] += 1
            leaves[up] += leaves[node]
            saved[up] += saved[node]
    for node in order:
        up, own = parent[node], members[tree.end[node]] if tree.end[node] >= 0 else []
        counts = convs[node], children[node], leaves[node], saved[node]
        if node in edge:
            yield _SHARED, depth[node], tree.words[node], least[node], None, *counts, key[node], key.get(up), None
            for at in range(0, len(own), IDS_AT_ONCE):
                some = own[at : at + IDS_AT_ONCE]
                yield _ENDS, *[None] * 2, some[0], *[None] * 5, key[node], None, ",".join(map(str, some))
        else:
            digest = hashlib.sha256(",".join(map(str, own)).encode()).hexdigest()
            above = (None, key[up]) if up in edge else (least[up], None)
            yield _FINAL, depth[node], tree.words[node], least[node], above[0], *counts, None, above[1], digest


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sequences, members, last = [], [], None
    for batch in batches:
        convs, ids, words = (batch.column(name) for name in ("conv_id", "ids", "words"))
        convs, cuts = convs.to_pylist(), ids.offsets.to_numpy()
        ids, counts = ids.values.to_numpy(), words.values.to_numpy()
        assert (cuts == words.offsets.to_numpy()).all()
        for conv, start, end in zip(convs, cuts[:-1], cuts[1:], strict=True):
            bytes_ = ids[start:end].tobytes()
            if bytes_ != last:
                sequences.append((ids[start:end].tolist(), counts[start:end].tolist()))
                members.append([])
                last = bytes_
            members[-1].append(conv)
    held = []
    for row in shard_nodes(sequences, members):
        held.append(row)
        if len(held) >= 20_000:
            yield _batch(held)
            held = []
    yield _batch(held)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [*_LONGS, *_TEXTS]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
    kinds = [pa.int64()] * len(_LONGS) + [pa.string()] * len(_TEXTS)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


# ---- All shards --------------------------------------------------------------------


def subtree_sums(nodes: DataFrame, key: str, parent: str, amounts: list[str]) -> DataFrame:
    """(key, amounts summed over the subtree) of a forest, by doubling.

    After k rounds a row holds the sums of what is less than 2^k levels below, and the ancestor 2^k levels up; so a
    round adds to each ancestor what its descendants at that distance hold. Rounds grow with the logarithm of the depth.
    """
    now = stored(nodes.select(F.col(key).alias("key"), F.col(parent).alias("up"), *amounts), "sums")
    while not now.where("up IS NOT NULL").isEmpty():
        gained = now.where("up IS NOT NULL").groupBy(F.col("up").alias("above")).agg(*[F.sum(a).alias(f"more_{a}") for a in amounts])
        hops = now.select(F.col("key").alias("hop"), F.col("up").alias("further"))
        joined = now.join(gained, F.col("key") == F.col("above"), "left").join(hops, F.col("up") == F.col("hop"), "left")
        sums = [(F.col(a) + F.coalesce(f"more_{a}", F.lit(0))).alias(a) for a in amounts]
        now = stored(joined.select("key", F.col("further").alias("up"), *sums), "sums")
    return now.drop("up")


def _ends_digests(pieces: DataFrame) -> DataFrame:
    """(key, ends_sha256): a digest runs over the pieces of a node in order, one at a time."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, sha, out = None, None, []
        for batch in batches:
            for key, ends in zip(batch.column("key").to_pylist(), batch.column("ends").to_pylist(), strict=True):
                if key == last:
                    sha.update(b",")
                else:
                    out += [(last, sha.hexdigest())] if sha else []
                    last, sha = key, hashlib.sha256()
                sha.update(ends.encode())
        out += [(last, sha.hexdigest())] if sha else []
        keys, digests = zip(*out, strict=True) if out else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(digests, pa.string())], ["key", "ends_sha256"])

    sorted_ = pieces.select("key", "conv_id", "ends").repartition("key").sortWithinPartitions("key", "conv_id")
    return sorted_.select("key", "ends").mapInArrow(digest, "key string, ends_sha256 string")


def prefix_trie(sequences: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """A row per prefix that some conversation begins with, the empty one included, from ``encode_turns`` rows.

    conv_id (the smallest member), depth (turns of the prefix), parent_conv_id (that of the prefix without its last turn),
    n_convs (members), n_children, n_leaves (prefixes of the subtree that go no further), saved_tokens (summed over the subtree,
    each prefix's members but one times the words of its last turn: what need not be read again), ends_sha256 (over
    the ids, ascending and joined by commas, of the members without a further turn).

    A conversation without turns is a member of the empty prefix alone. Equal sequences share all their nodes; a conversation id
    that occurs twice is a member twice. Rows without an id are left out. No row: no result.

    Shards are ranges of (sequence, id), so that a sequence that a third of all conversations have spreads over many. A task
    holds its shard's numbers. Shared nodes, two paths a shard at most, meet by their keys.
    """
    rows = stored(sequences.select("conv_id", "ids", "words").where("conv_id IS NOT NULL"), "sequences")
    total = rows.agg(F.sum(F.size("ids") + 1)).first()[0] or 0
    shards = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // shard_turns))
    ranged = rows.repartitionByRange(shards, "ids", "conv_id").sortWithinPartitions("ids", "conv_id")
    found = stored(ranged.mapInArrow(_shards, _FOUND), "nodes")

    parts = found.where(F.col("kind") == _SHARED).groupBy("key", "parent_key", "depth", "words").agg(
        F.min("conv_id").alias("conv_id"), *[F.sum(name).alias(name) for name in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    )
    parts = stored(parts, "shared")
    below = parts.where("parent_key IS NOT NULL").groupBy(F.col("parent_key").alias("above")).agg(F.count(F.lit(1)).alias("more"))
    counted = parts.join(below, F.col("key") == F.col("above"), "left").withColumn(
        "n_children", F.col("n_children") + F.coalesce("more", F.lit(0))
    )
    own = counted.withColumns(
        {
            "n_leaves": F.col("n_leaves") + (F.col("n_children") == 0).cast("long"),
            "saved_tokens": F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("words"),
        }
    )
    shared = stored(own.select("key", "parent_key", "depth", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"), "shared")
    sums = subtree_sums(shared, "key", "parent_key", ["n_leaves", "saved_tokens"])
    ends = _ends_digests(found.where(F.col("kind") == _ENDS))
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    merged = (
        shared.drop("n_leaves", "saved_tokens")
        .join(sums, "key")
        .join(ends, "key", "left")
        .withColumn("ends_sha256", F.coalesce("ends_sha256", nothing))
    )
    # Children of shared nodes get their parent's id; few parents have very many of them.
    named = shared.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("above_id"))
    final = found.where(F.col("kind") == _FINAL).withColumnRenamed("ends", "ends_sha256")
    below_shared = final.where("parent_key IS NOT NULL")
    rest = [name for name in NODE if name != "parent_conv_id"]
    hung = [attach(some.select("parent_key", *rest), named, ["parent_key"]) for some in (below_shared, merged)]
    joined = hung[0].unionByName(hung[1]).withColumnRenamed("above_id", "parent_conv_id")
    return final.where("parent_key IS NULL").select(*NODE).unionByName(joined.select(*NODE))
