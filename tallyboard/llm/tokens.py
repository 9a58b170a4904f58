"""Token ids in Parquet files, and exact length histograms."""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyboard.llm.common import slices, stored

#: Words whose ids a worker remembers in each of two generations, and the longest that it does.
KNOWN_WORDS = 250_000
KNOWN_BYTES = 48

#: Marks that may follow a word; a run of them is one piece of its own to the tokenizer.
MARKS = b".,;:!?*&%$#)\"-"

END_ID = 2

# What a tokenizer file says of texts that may be cut at white space and after words.
WORD_NORMALIZER = {
    "type": "Sequence",
    "normalizers": [
        {"type": "NFC"},
        {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
        {"type": "Lowercase"},
    ],
}
WORD_PIECES = {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}

# Letters up to here are letters to every version of Unicode, and lower case is one letter again, but for this one.
LAST_LETTER, DOTTED_I = "\u024f", "\u0130"


def _byte_letters() -> dict[int, int]:
    """Byte-level vocabularies write a printable byte as itself and the others, in order, as the letters from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [byte for byte in range(256) if byte not in printable]
    return {byte: 256 + n for n, byte in enumerate(others)}


_BYTE_LETTERS = _byte_letters()


class Encoder:
    """Ids of whole texts, as the library gives them.

    A file that lower-cases, collapses white space and then cuts at words, digits and runs of marks (``cuts_at_white_space``)
    lets texts be split at ASCII white space first: each different word of a batch is then encoded once, and
    not again as long as it is remembered. With any other file, whole texts go to the library.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            self.by_word = cuts_at_white_space(json.load(file))
        self.tokenizer = Tokenizer.from_file(path)
        self.young: dict[bytes, bytes] = {}  # ids as 32-bit numbers, one after another
        self.old: dict[bytes, bytes] = {}

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, ids): the ids of all texts, ``end_id`` after each, and where each text's begin. A null text is empty."""
        texts = texts.cast(pa.string()).fill_null("")
        if not self.by_word:
            rows = [np.array([*self._whole(text), end_id], np.int32) for text in texts.to_pylist()]
            return _offsets([len(row) for row in rows]), np.concatenate(rows) if rows else np.empty(0, np.int32)
        pieces, ends, ids = self._pieces(texts)
        # The end of a text is one more piece.
        pieces = np.insert(pieces, ends[1:], len(ids))
        ids.append(np.int32(end_id).tobytes())
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        pool, starts = np.frombuffer(b"".join(ids), np.int32), np.cumsum(sizes) - sizes
        taken = sizes[pieces]
        before = np.concatenate(([0], np.cumsum(taken)))
        places = np.repeat(starts[pieces] - before[:-1], taken)
        places += np.arange(before[-1])
        return before[ends + np.arange(len(ends))], pool[places]

    def lengths(self, texts: pa.Array) -> np.ndarray:
        """The number of ids of each text."""
        texts = texts.cast(pa.string()).fill_null("")
        if not self.by_word:
            return np.array([len(self._whole(text)) for text in texts.to_pylist()], np.int64)
        pieces, ends, ids = self._pieces(texts)
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        return np.diff(np.concatenate(([0], np.cumsum(sizes[pieces])))[ends])

    def _whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _pieces(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """(number of each piece, where texts begin and end among the pieces, ids of each different piece).

        A chunk between white space is two pieces: a word in lower case, and the marks after it, if there are any.
        """
        lists = pc.ascii_split_whitespace(texts)
        chunks = lists.values.dictionary_encode()
        words, marks = _words_and_marks(chunks.dictionary)
        places = chunks.indices.to_numpy()
        pieces = np.empty((len(places), 2), np.int64)
        pieces[:, 0] = words.indices.to_numpy()[places]
        kinds, kind = np.unique(marks, return_inverse=True)
        pieces[:, 1] = len(words.dictionary) + kind[places]
        some = words.dictionary.cast(pa.binary()).to_pylist()
        some += [number.to_bytes(8, "little").rstrip(b"\0") for number in kinds.tolist()]
        return pieces.ravel(), 2 * lists.offsets.to_numpy().astype(np.int64), self._known(some)

    def _known(self, words: list[bytes]) -> list[bytes]:
        if len(self.young) > KNOWN_WORDS:
            self.old, self.young = self.young, {}
        young = self.young
        return [young[word] if word in young else self._remembered(word) for word in words]

    def _remembered(self, word: bytes) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            text = word.decode()
            numbers = self._letters(text) if _plain(text) else self._whole(text)
            ids = array("i", numbers).tobytes()
        if len(word) <= KNOWN_BYTES:
            self.young[word] = ids
        return ids

    def _letters(self, text: str) -> list[int]:
        """A word of plain letters is one piece to the library too, so the model alone is asked."""
        piece = text.lower()
        if not piece.isascii():
            piece = piece.encode().decode("latin-1").translate(_BYTE_LETTERS)
        return [token.id for token in self.tokenizer.model.tokenize(piece)]


def cuts_at_white_space(file: dict) -> bool:
    """Whether a tokenizer file is of the kind that ``Encoder`` may give words to: normal form, pieces and model as stated."""
    steps = (file.get("pre_tokenizer") or {}).get("pretokenizers") or [{}, {}]
    model = file.get("model") or {}
    split, bytes_ = steps[0], steps[-1]
    return (
        file.get("normalizer") == WORD_NORMALIZER
        and len(steps) == 2
        and (split.get("type"), split.get("pattern"), split.get("behavior"), split.get("invert")) == ("Split", WORD_PIECES, "Removed", True)
        and (bytes_.get("type"), bytes_.get("add_prefix_space"), bytes_.get("use_regex")) == ("ByteLevel", False, False)
        and (model.get("type"), model.get("dropout")) == ("BPE", None)
        and not file.get("truncation")
        and not file.get("padding")
        and all(
            token["content"].startswith("<|") and not re.search(r"\s", token["content"])
            and not (token["lstrip"] or token["rstrip"] or token["normalized"])
            for token in file.get("added_tokens") or ()
        )
    )


def _plain(text: str) -> bool:
    return text.isalpha() and max(text) <= LAST_LETTER and DOTTED_I not in text


# Which characters may stand last in a word that is cut from its marks, by code point.
_CUTS = np.array([_plain(chr(point)) or (point < 128 and chr(point).isdigit()) for point in range(ord(LAST_LETTER) + 1)])


def _words_and_marks(chunks: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """Of each chunk its word in lower case, and the (at most seven) marks after it as the bytes of a number.

    Where cutting could change the ids, the word is the whole chunk: what stands before the marks must be a letter whose lower case
    is a letter, or a digit. A chunk that may hold a special token, whose case matters, stays as it is.
    """
    words = pc.ascii_rtrim(chunks, characters=MARKS.decode())
    special = pc.match_substring(chunks, "<|")
    ends = _string_ends(chunks)
    data = np.frombuffer(chunks.buffers()[2] or b"\0", np.uint8)
    sizes, left = (pc.binary_length(x).to_numpy(zero_copy_only=False).astype(np.int64) for x in (chunks, words))
    run = sizes - left
    may = (left > 0) & (run > 0) & (run < 8) & ~special.to_numpy(zero_copy_only=False)
    at = np.flatnonzero(may)
    last = ends[at] - run[at] - 1
    low, high = data[last].astype(np.int64), data[np.maximum(last - 1, 0)].astype(np.int64)
    point = np.where(low < 128, low, np.where((high >= 0xC2) & (high <= 0xC9), (high & 0x1F) << 6 | low & 0x3F, 0))
    cut = np.zeros(len(chunks), bool)
    cut[at] = _CUTS[point]
    marks = np.zeros(len(chunks), np.int64)
    for place in range(7):
        here = np.flatnonzero(cut & (run > place))
        marks[here] |= data[ends[here] - run[here] + place].astype(np.int64) << 8 * place
    lowered = pc.ascii_lower(pc.if_else(pa.array(cut), words, chunks))
    return pc.if_else(special, chunks, lowered).dictionary_encode(), marks


def _string_ends(strings: pa.Array) -> np.ndarray:
    first = strings.offset
    return np.frombuffer(strings.buffers()[1], np.int32)[first + 1 : first + 1 + len(strings)].astype(np.int64)


def _offsets(sizes: Sequence[int]) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)


_encoders: dict[str, Encoder] = {}


def encoder_of(path: str) -> Encoder:
    """The worker's own encoder, which remembers words from task to task."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


@dataclass(frozen=True)
class TokenFileFormat:
    """How the files are laid out."""

    row_group_bytes: int = 32 << 20
    page_bytes: int = 256 << 10
    page_rows: int = 2_000
    compression: str = "zstd"

    def options(self) -> dict[str, str]:
        return {
            "compression": self.compression,
            "parquet.block.size": str(self.row_group_bytes),
            "parquet.page.size": str(self.page_bytes),
            "parquet.page.row.count.limit": str(self.page_rows),
            # Ids by dictionary while it pays, else delta-coded; column and offset indexes come with every page.
            "parquet.enable.dictionary": "true",
            "parquet.writer.version": "v2",
        }


TOKEN_SCHEMA = "doc_id long, shard_start long, n_tokens long, ids array<int>, place long"


def write_tokens(
    documents: DataFrame,
    path: str,
    tokenizer: str,
    text: str = "text",
    doc_id: str = "doc_id",
    end_id: int = END_ID,
    order: Column | None = None,
    layout: TokenFileFormat = TokenFileFormat(),
) -> None:
    """Encode whole texts and write them to Parquet files under ``path``, ordered by id (or by ``order``).

    A row holds doc_id, the ids (with ``end_id`` at the end), their number, how many ids the file has
    before it, and its place (file number and row). The files are written in ranges of the
    order, so page indexes let a reader skip to some documents, and columns to metadata alone.

    A null text is empty: its row holds the end id only. Rows with one id are ordered by their
    text; repeated rows stay, side by side. Null ids come first. No row: files without rows.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, before = encoder_of(tokenizer), 0
        for batch in slices(batches, "body"):
            offsets, flat = encoder.encode(batch.column("body"), end_id)
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat))
            starts, sizes = pa.array(before + offsets[:-1]), pa.array(np.diff(offsets))
            before += int(offsets[-1])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), starts, sizes, lists], ["doc_id", "shard_start", "n_tokens", "ids"]
            )

    bodies = documents.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.col(text).cast("binary").alias("body"),
        (F.col(doc_id).cast("long") if order is None else order).alias("at"),
    ).withColumn("tie", F.xxhash64("body"))
    ranged = bodies.repartitionByRange("at", "doc_id", "tie").sortWithinPartitions("at", "doc_id", "tie", "body")
    rows = ranged.select("doc_id", "body").mapInArrow(
        encode, "doc_id long, shard_start long, n_tokens long, ids array<int>"
    )
    rows.withColumn("place", F.monotonically_increasing_id()).write.options(**layout.options()).parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The files of ``write_tokens``, with ``start``: the number of ids in all documents before."""
    rows = spark.read.schema(TOKEN_SCHEMA).parquet(path)
    files = rows.groupBy(F.shiftright("place", 33).alias("shard")).agg(F.sum("n_tokens").alias("shard_tokens"))
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = files.select("shard", F.coalesce(F.sum("shard_tokens").over(earlier), F.lit(0)).alias("offset"))
    # One row per file.
    return (
        rows.withColumn("shard", F.shiftright("place", 33))
        .join(F.broadcast(offsets), "shard")
        .select("doc_id", (F.col("offset") + F.col("shard_start")).alias("start"), "n_tokens", "ids")
    )


def id_checksums(tokens: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of ``read_tokens`` rows, from the ids as stored."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            flat, offsets = lists.values.to_numpy().astype("<u4"), lists.offsets.to_numpy()
            crc = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("start"), pa.array(np.diff(offsets).astype(np.int64)),
                 pa.array(crc, pa.int64())],
                ["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    return tokens.mapInArrow(sums, "doc_id long, start long, n_tokens long, ids_crc32 long")


# ---- Lengths ---------------------------------------------------------------------

#: Lengths whose suffix sums are made in one task.
LENGTH_BLOCK = 4096


def token_lengths(documents: DataFrame, tokenizer: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, n_tokens) of every document; a null text has none."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(tokenizer)
        for batch in slices(batches, "body"):
            sizes = encoder.lengths(batch.column("body"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64())], ["doc_id", "n_tokens"]
            )

    bodies = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("body"))
    return bodies.mapInArrow(count, "doc_id long, n_tokens long")


def length_histogram(lengths: DataFrame) -> DataFrame:
    """For every length that occurs, the figures of a context limit of that length.

    length, docs (of that length), docs_at_least, tokens_at_least, docs_up_to, tokens_up_to,
    quantile (share of documents up to that length), truncated_tokens (what remains of all
    documents cut to that length). Totals stand in the row of the shortest length (``_at_least``) and of the longest (``_up_to``).

    Documents are counted by length before anything is shuffled. Suffix sums are made in blocks of lengths, and
    over the blocks: a text has fewer than 2**31 tokens, so there are at most 2**19 blocks. Null lengths are left out.
    Equal lengths are one row; repeated rows count as often as they occur. No row: no result.
    """
    histogram = stored(
        lengths.where("n_tokens is not null").groupBy(F.col("n_tokens").alias("length")).agg(F.count(F.lit(1)).alias("docs")),
        "lengths",
    ).withColumn("block", F.expr(f"length div {LENGTH_BLOCK}")).withColumn("tokens", F.col("length") * F.col("docs"))
    blocks = histogram.groupBy("block").agg(F.sum("docs").alias("b_docs"), F.sum("tokens").alias("b_tokens"))
    longer = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sums = blocks.select(
        "block",
        *[F.coalesce(F.sum(f"b_{x}").over(longer), F.lit(0)).alias(f"later_{x}") for x in ("docs", "tokens")],
        *[F.sum(f"b_{x}").over(everything).alias(f"all_{x}") for x in ("docs", "tokens")],
    )
    within = Window.partitionBy("block").orderBy(F.desc("length"))
    joined = histogram.join(sums, "block")
    at_least = {x: F.sum(x).over(within) + F.col(f"later_{x}") for x in ("docs", "tokens")}
    return joined.select(
        "length",
        "docs",
        at_least["docs"].alias("docs_at_least"),
        at_least["tokens"].alias("tokens_at_least"),
        "tokens", "all_docs", "all_tokens",
    ).select(
        "length",
        "docs",
        "docs_at_least",
        "tokens_at_least",
        (F.col("all_docs") - F.col("docs_at_least") + F.col("docs")).alias("docs_up_to"),
        (F.col("all_tokens") - F.col("tokens_at_least") + F.col("tokens")).alias("tokens_up_to"),
        ((F.col("all_docs") - F.col("docs_at_least") + F.col("docs")) / F.col("all_docs")).alias("quantile"),
        (F.col("all_tokens") - F.col("tokens_at_least") + F.col("length") * F.col("docs_at_least")).alias("truncated_tokens"),
    )


def at_limits(histogram: DataFrame, limits: Sequence[int]) -> DataFrame:
    """(context_limit, docs_longer, truncated_tokens) for each of a stated list of limits.

    A limit between two lengths is answered like any other; beyond the longest, nothing is cut.
    """
    asked = sorted(set(limits))
    longer = [F.col("length") > limit for limit in asked]
    sums = histogram.agg(
        F.coalesce(F.sum(F.col("length") * F.col("docs")), F.lit(0)).alias("total"),
        *[F.coalesce(F.sum(F.when(far, F.col("docs"))), F.lit(0)).alias(f"docs_{k}") for k, far in enumerate(longer)],
        *[
            F.coalesce(F.sum(F.when(far, F.col("length") * F.col("docs"))), F.lit(0)).alias(f"tokens_{k}")
            for k, far in enumerate(longer)
        ],
    )
    rows = [
        F.struct(
            F.lit(limit).cast("long").alias("context_limit"),
            F.col(f"docs_{k}").alias("docs_longer"),
            (F.col("total") - F.col(f"tokens_{k}") + limit * F.col(f"docs_{k}")).alias("truncated_tokens"),
        )
        for k, limit in enumerate(asked)
    ]
    return sums.select(F.inline(F.array(*rows)))
