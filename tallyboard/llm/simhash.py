"""SimHash near-duplicates by generalised pigeonhole search."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyboard.llm.common import attach_groups, slices, stored
from tallyboard.llm.components import components

BITS = 64
SEED = 42
SHINGLE_WORDS = 4
MAX_BITS = 4
MAX_PARTS = 6
#: Distinct fingerprints of one signature that a task compares at once; larger buckets are cut into blocks.
BLOCK = 4096
#: Runs up to this length are compared in whole columns.
SHORT_RUN = 48
#: Estimated cost of a signature row against that of comparing a pair.
SIGNATURE_COST = 20.0
_HASH_CHUNK = 1 << 16


def fingerprint(text: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """The SimHash of a text in UTF-8: bit i is 1 if it is set in over half of its shingles' hashes."""
    words = text.lower().split()  # of bytes: ASCII letters and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(shingle_words, len(words))
    count = len(words) - width + 1
    ones = np.zeros(BITS, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, count, _HASH_CHUNK):
        to = min(at + _HASH_CHUNK, count)
        cuts = zip(starts[at:to].tolist(), ends[at + width - 1 : to + width - 1].tolist(), strict=True)
        hashes = np.array([digest(joined[a:b], SEED) for a, b in cuts], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > count, bitorder="little").view("<u8")[0])


def fingerprints(
    documents: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle_words: int = SHINGLE_WORDS
) -> DataFrame:
    """(doc_id, fp) of every document; the fingerprint's 64 bits as a long. No words: zero."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "body"):
            values = [fingerprint(body or b"", shingle_words) for body in batch.column("body").to_pylist()]
            signed = np.array(values, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(signed)], ["doc_id", "fp"])

    bodies = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("body"))
    return bodies.mapInArrow(score, "doc_id long, fp long")


# ---- Choosing partitions and thresholds ----------------------------------------


@dataclass(frozen=True)
class Part:
    """Bits looked at together, and how many of them may differ; -1 leaves the part out."""

    bits: tuple[int, ...]
    threshold: int

    @property
    def radius(self) -> int:
        """Both sides of a pair vary this many bits, so their variants meet."""
        return (self.threshold + 1) // 2


def bit_statistics(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints, and in how many of them bits i and j are both 1: summed in Spark, 64 x 64 numbers."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, n = np.zeros((BITS, BITS), np.int64), 0
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint8).reshape(-1, 8)
            bits = np.unpackbits(values, axis=1, bitorder="little").astype(np.float64)
            both += (bits.T @ bits).astype(np.int64)
            n += len(bits)
        cells = np.append(both.ravel(), n)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BITS * BITS + 1)), pa.array(cells)], ["cell", "n"])

    sums = fps.select("fp").mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    cells = np.zeros(BITS * BITS + 1, np.int64)
    for row in sums.collect():  # at most 4,097 rows
        cells[row.cell] = row.n
    return int(cells[-1]), cells[:-1].reshape(BITS, BITS)


def _disagreement(n: int, both: np.ndarray) -> np.ndarray:
    """Probability that two fingerprints differ in bit i and in bit j, from the joint counts."""
    p11 = both / max(n, 1)
    p1 = np.diag(p11)
    p10 = p1[:, None] - p11
    p01 = p1[None, :] - p11
    p00 = 1 - p11 - p10 - p01
    joint = 2 * (p11 * p00 + p10 * p01)
    np.fill_diagonal(joint, 2 * p1 * (1 - p1))
    return joint


def correlated_groups(both: np.ndarray, n: int, parts: int) -> list[tuple[int, ...]]:
    """The bits in ``parts`` groups of nearly one size, each grown by the bit most correlated with it."""
    p = both / max(n, 1)
    mean = np.diag(p)
    spread = np.sqrt(np.maximum(mean * (1 - mean), 1e-12))
    likeness = np.abs((p - np.outer(mean, mean)) / np.outer(spread, spread))
    left, groups = set(range(BITS)), []
    for k in range(parts):
        size = (BITS - sum(map(len, groups))) // (parts - k)
        group = [max(left, key=lambda b: (likeness[b, list(left)].sum(), -b))]
        left.remove(group[0])
        while len(group) < size:
            best = max(left, key=lambda b: (likeness[b, group].sum(), -b))
            group.append(best)
            left.remove(best)
        groups.append(tuple(sorted(group)))
    return groups


def _close_share(joint: np.ndarray, bits: tuple[int, ...], limit: int) -> list[float]:
    """Estimated share of pairs that differ in at most e of ``bits``, e = 0..limit.

    Exact for independent bits; correlation is allowed for by counting as many bits
    as would give the measured variance of the distance.
    """
    q = np.diag(joint)[list(bits)]
    chance = np.zeros(len(bits) + 1)
    chance[0] = 1
    for x in q:
        chance[1:] = chance[1:] * (1 - x) + chance[:-1] * x
        chance[0] *= 1 - x
    block = joint[np.ix_(bits, bits)]
    variance = block.sum() - q.sum() ** 2
    effective = min(1.0, max(0.05, float((q * (1 - q)).sum()) / max(float(variance), 1e-9)))
    return [float(min(1.0, x**effective)) for x in np.cumsum(chance)[: limit + 1]]


def choose_parts(n: int, both: np.ndarray, max_bits: int = MAX_BITS) -> list[Part]:
    """Partitions and thresholds with the least estimated cost.

    If the thresholds sum to max_bits - parts + 1, two fingerprints within max_bits
    agree within its threshold in at least one part: with one more bit of difference in each, the
    sum would exceed max_bits. The thresholds are found by dynamic programming over the
    parts; the cost counts signature rows and estimated candidate pairs. Whatever is chosen, no link is lost.
    """
    joint = _disagreement(n, both)
    best: tuple[float, list[Part]] | None = None
    for m in range(1, min(MAX_PARTS, max_bits + 1) + 1):
        groups = correlated_groups(both, n, m)
        need = max_bits - m + 1
        costs = []
        for bits in groups:
            share = _close_share(joint, bits, 2 * max_bits)
            row = {-1: 0.0}
            for e in range(max_bits + 1):
                variants = sum(math.comb(len(bits), r) for r in range((e + 1) // 2 + 1))
                met = share[min(2 * ((e + 1) // 2), len(share) - 1)]
                row[e] = SIGNATURE_COST * n * variants + n * n / 2 * met
            costs.append(row)
        reach: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
        for row in costs:
            step: dict[int, tuple[float, list[int]]] = {}
            for total, (cost, chosen) in reach.items():
                for e, more in row.items():
                    at = total + e
                    if at not in step or cost + more < step[at][0]:
                        step[at] = (cost + more, [*chosen, e])
            reach = step
        cost, chosen = reach[need]
        if best is None or cost < best[0]:
            best = (cost, [Part(b, e) for b, e in zip(groups, chosen, strict=True)])
    return best[1]


# ---- Probing and verifying ------------------------------------------------------


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _signatures(fps: DataFrame, parts: list[Part]) -> DataFrame:
    """(sig, fp): for each part, the part's bits with up to ``radius`` of them flipped."""
    flips = []
    for part in parts:
        if part.threshold < 0:
            continue
        mask = sum(1 << b for b in part.bits)
        for r in range(part.radius + 1):
            for chosen in combinations(part.bits, r):
                flips.append((_signed(mask), _signed(sum(1 << b for b in chosen))))
    probes = F.array(*[F.struct(F.lit(m).alias("mask"), F.lit(f).alias("flip")) for m, f in flips])
    return fps.select("fp", F.inline(probes)).select(
        F.col("fp").bitwiseXOR(F.col("flip")).bitwiseAND(F.col("mask")).alias("sig"), "fp"
    )


def _run_links(fps: np.ndarray, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links that tie together, within one bucket, all that belongs together: fewer than its members."""
    left = np.ones(len(fps), bool)
    for seed in range(len(fps)):
        if not left[seed]:
            continue
        left[seed] = False
        waiting = [seed]
        while waiting:
            at = waiting.pop()
            rest = np.flatnonzero(left)
            near = rest[np.bitwise_count(fps[rest] ^ fps[at]) <= max_bits]
            if len(near):
                left[near] = False
                waiting.extend(near.tolist())
                yield np.full(len(near), fps[at]), fps[near]


def bucket_links(sigs: np.ndarray, fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Verified links within the runs of equal ``sigs`` (sorted), as two arrays; ``fps`` unsigned, as bits are counted."""
    if not len(sigs):
        return fps, fps
    starts = np.flatnonzero(np.concatenate(([True], sigs[1:] != sigs[:-1])))
    lengths = np.diff(np.append(starts, len(sigs)))
    place = np.arange(len(sigs)) - np.repeat(starts, lengths)
    size = np.repeat(lengths, lengths)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    # Columns: every row of a short run against the row d places before it; the first match is enough
    # to tie a row to those before it, as long as all later matches are looked at by a search.
    hits = np.zeros(len(sigs), np.int32)
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    d = 1
    rows = np.flatnonzero((size <= SHORT_RUN) & (place >= 1))
    while len(rows):
        near = rows[np.bitwise_count(fps[rows] ^ fps[rows - d]) <= max_bits]
        if len(near):
            hits[near] += 1
            pairs.append((near, near - d))
        d += 1
        rows = rows[place[rows] >= d]
    if pairs:
        run = np.repeat(np.arange(len(starts)), lengths)
        many = np.bincount(run, hits, len(starts)) >= np.maximum(lengths, 3)
        for one, other in pairs:
            few = ~many[run[one]]
            found.append((fps[one[few]], fps[other[few]]))
        searched = np.flatnonzero(many | (lengths > SHORT_RUN))
    else:
        searched = np.flatnonzero(lengths > SHORT_RUN)
    for k in searched:
        found.extend(_run_links(fps[starts[k] : starts[k] + lengths[k]], max_bits))
    if not found:
        return fps[:0], fps[:0]
    return np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found])


def links(fps: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """Links (a, b) among distinct fingerprints: enough of them to connect whatever pairs within ``max_bits`` connect.

    Fingerprints that share a signature meet in one bucket and are compared there.
    A bucket with more than ``block`` members is cut into blocks, and each two blocks
    (or one with itself) make a bucket, so no task holds more than two blocks at once.
    """
    n, both = bit_statistics(fps)
    sigs = _signatures(fps, choose_parts(n, both, max_bits))
    large = stored(
        sigs.groupBy("sig").count().where(F.col("count") > block).select(F.col("sig").alias("big"), "count"), "large"
    )
    # At most one in ``block`` signature rows; Spark measures the stored table before it broadcasts it.
    cut = sigs.join(large, F.col("sig") == F.col("big"), "left").withColumn(
        "blocks", F.coalesce(F.ceil(F.col("count") / block), F.lit(1)).cast("int")
    )
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    spread = cut.withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    )
    bucket = F.when(F.col("blocks") == 1, F.col("sig")).otherwise(
        F.xxhash64("sig", F.least("own", "other"), F.greatest("own", "other"))
    )
    # Hash-dealt by bucket and sorted, buckets come one after another.
    dealt = spread.select(bucket.alias("sig"), "fp").repartition("sig").sortWithinPartitions("sig", "fp")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sig, fp = np.empty(0, np.int64), np.empty(0, np.int64)

        def done(upto: int) -> pa.RecordBatch:
            a, b = bucket_links(sig[:upto], fp[:upto].view(np.uint64), max_bits)
            ends = np.stack([np.maximum(a, b), np.minimum(a, b)], axis=1).view(np.int64)
            ends = np.unique(ends, axis=0) if len(ends) else ends.reshape(0, 2)
            return pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], ["a", "b"])

        for batch in batches:
            sig = np.concatenate([sig, batch.column(0).to_numpy()])
            fp = np.concatenate([fp, batch.column(1).to_numpy()])
            # The last bucket may go on in the next batch.
            upto = int(np.searchsorted(sig, sig[-1])) if len(sig) else 0
            if upto > 200_000:
                yield done(upto)
                sig, fp = sig[upto:], fp[upto:]
        yield done(len(sig))

    return dealt.mapInArrow(verify, "a long, b long").distinct()


def near_duplicates(
    documents: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    shingle_words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """One row per document: doc_id, fp (long), component_id (the smallest id that links reach), linked.

    Documents link whose fingerprints differ in at most ``max_bits`` bits. Equal
    fingerprints are one node of the graph, however many documents have them.

    A null or blank text has fingerprint zero and links like any other. Ids that are null
    are passed over when the smallest id is chosen; a component without any id has none. Repeated rows
    are repeated in the result. No row: no result.
    """
    prints = stored(fingerprints(documents, text, doc_id, shingle_words), "fingerprints")
    classes = stored(
        prints.groupBy("fp").agg(F.min("doc_id").alias("least_id"), F.count(F.lit(1)).alias("n")), "classes"
    )
    tied = stored(components(links(classes.select("fp"), max_bits)), "tied")
    rooted = classes.join(tied, classes.fp == tied.node, "left").select(
        "fp", "least_id", "n", F.coalesce("root", "fp").alias("root"), F.col("root").isNotNull().alias("tied")
    )
    whole = rooted.groupBy("root").agg(
        F.min("least_id").alias("component_id"), F.count(F.lit(1)).alias("members")
    )
    size = classes.agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("fps")).first()
    # A document whose fingerprint is its own and has no link is its own component.
    shared = attach_groups(
        rooted.where("n > 1 or tied").select("fp", "n", "root"), whole, "root", "members", size.fps or 0, "fp"
    ).select("fp", "n", "component_id")
    found = attach_groups(prints, shared, "fp", "n", size.rows or 0, "doc_id")
    alone = F.col("n").isNull()
    return found.select(
        "doc_id",
        "fp",
        F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        (~alone).alias("linked"),
    )
