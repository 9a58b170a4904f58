"""The category cascade: app dictionary, URL dictionary, learned labels, default.

With a handful of URL patterns and everything inside the broadcast bounds the cascade
adds no shuffle to the messages. Otherwise the distinct (app, title, url) are written to the
shared folder, resolved there, and joined back once: two reads of the
messages, whatever the sizes. A message resolved by one stage is not looked at by the next.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from tallyboard.functions.keys import label_prompt, label_query, validated_label
from tallyboard.operators.lookup import (
    DEFAULT_BOUND,
    BroadcastBound,
    attach,
    bounded_rows,
    local_frame,
    within_bound,
)
from tallyboard.operators.patterns import (
    APP,
    URL,
    category_to_id,
    effective_patterns,
    pattern_dictionary,
)
from tallyboard.schemas import DEFAULT_CATEGORY, ZERO_ID
from tallyboard.session import stored

# A dictionary up to this size is fetched once and shipped with the plan.
DICTIONARY_BOUND = BroadcastBound(rows=200_000, text_bytes=16 << 20)
# Above this many URL patterns the single expression outgrows what the JIT compiles well.
EXPRESSION_PATTERNS = 16
# Longest piece of a pattern used as a join key.
LONGEST_GRAM = 4
# Slots in which pieces of URLs are counted.
SKETCH_SLOTS = 1 << 16

EXPRESSION, MATCHER, JOIN = "expression", "matcher", "join"

# All that the cascade looks at.
KEY = ["app", "title", "url"]

# How a message got its category.
BY_APP, BY_URL, BY_LABEL, BY_DEFAULT = "app", "url", "label", "none"


# ---- URL matching -----------------------------------------------------------
# Patterns match anywhere in the URL. The occurrence that ends first decides;
# of those ending together, the longest.


def url_category_expression(url: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The rule as one built-in expression over a handful of patterns."""
    ranked = sorted(rules, key=lambda rule: (-len(rule[0]), rule[0]))
    if not ranked:
        return F.lit(None).cast("string")
    count = len(ranked)
    # End position first, then rank: the longest pattern has rank 0. ``contains``
    # compares bytes and is much cheaper than ``instr``, which then runs on hits only.
    scores = [
        F.when(
            F.contains(url, F.lit(pattern)),
            (F.instr(url, pattern) + len(pattern)).cast("bigint") * count + rank,
        )
        for rank, (pattern, _) in enumerate(ranked)
    ]
    best = F.least(*scores) if count > 1 else scores[0]
    categories = F.array(*[F.lit(category) for _, category in ranked])
    return F.get(categories, (best % count).cast("int"))


def url_category_matcher(rules: Sequence[tuple[str, str]]):
    """The rule as an Arrow UDF: one multi-pattern matcher per task, one probe per distinct URL of a batch.

    Only on request (``url_match=MATCHER``): driver and executors need the ``pyahocorasick``
    package. The matcher reports occurrences by end position, the longest first, so the
    first one reported is the answer.
    """
    shipped = list(rules)

    def match(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import ahocorasick

        matcher = ahocorasick.Automaton()
        for pattern, category in shipped:
            matcher.add_word(pattern, category)
        matcher.make_automaton()
        for urls in batches:
            codes, distinct = pd.factorize(urls)
            found = [next((c for _, c in matcher.iter(url)), None) for url in distinct]
            found.append(None)  # code -1: no URL
            yield pd.Series([found[code] for code in codes], dtype=object)

    return F.pandas_udf(match, "string")


def _gram_length(pattern: Column) -> Column:
    size = F.char_length(pattern)
    return F.when(size >= LONGEST_GRAM, LONGEST_GRAM).when(size >= 2, 2).otherwise(1)


def gram_lengths(rules: DataFrame, rows: Sequence[Row] | None = None) -> list[int]:
    """The lengths of pieces that a dictionary uses, at most three."""
    if rows is not None:
        return sorted({LONGEST_GRAM if len(row.pattern) >= LONGEST_GRAM else 2 if len(row.pattern) >= 2 else 1 for row in rows})
    return sorted(row[0] for row in rules.select(_gram_length(F.col("pattern"))).distinct().collect())


def _pieces(urls: DataFrame, lengths: Sequence[int]) -> DataFrame:
    """(url, pos, gram): every piece of those lengths."""
    each = F.explode(F.array(*map(F.lit, lengths)).cast("array<int>"))
    return (
        urls.where(F.col("url") != "")
        .withColumn("whole", F.char_length("url"))
        .select("url", "whole", each.alias("gram_len"))
        .where(F.col("whole") >= F.col("gram_len"))
        .select("url", "gram_len", F.explode(F.sequence(F.lit(1), F.expr("whole - gram_len + 1"))).alias("pos"))
        .select("url", "pos", F.expr("substring(url, pos, gram_len)").alias("gram"))
    )


def _slot(gram: Column) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(SKETCH_SLOTS)).cast("int")


def anchors_of(rules: DataFrame, urls: DataFrame, lengths: Sequence[int]) -> DataFrame:
    """(pattern, at, gram, plen, category): each pattern with its piece that is rarest among the URLs.

    Pieces of the URLs are counted in SKETCH_SLOTS slots by a hash, so the counts are a table of bounded size; a slot that several
    pieces share makes them look commoner, never rarer.
    """
    sketch = _pieces(urls, lengths).groupBy(_slot(F.col("gram")).alias("slot")).agg(F.count(F.lit(1)).alias("met"))
    sized = rules.withColumns({"plen": F.char_length("pattern"), "gram_len": _gram_length(F.col("pattern"))})
    pieces = sized.select(
        "*", F.explode(F.sequence(F.lit(1), F.expr("plen - gram_len + 1"))).alias("at")
    ).withColumn("gram", F.expr("substring(pattern, at, gram_len)"))
    counted = pieces.withColumn("slot", _slot(F.col("gram"))).join(F.broadcast(sketch), "slot", "left")
    rarest = F.min(F.struct(F.coalesce("met", F.lit(0)).alias("met"), "at", "gram", "plen", "category")).alias("anchor")
    return counted.groupBy("pattern").agg(rarest).select("pattern", "anchor.at", "anchor.gram", "anchor.plen", "anchor.category")


def url_categories_by_join(urls: DataFrame, rules: DataFrame, rows: Sequence[Row] | None = None) -> DataFrame:
    """The rule as an equi-join: (url, category) for the distinct ``urls`` that match.

    Each pattern is keyed by one piece of 1, 2 or 4 characters, the one that the URLs have least; each URL
    offers its pieces of those lengths, and a hit is checked against the whole
    pattern. The work per URL depends on its length, not on the dictionary. ``rows`` are the rules where they have been fetched.
    """
    lengths = gram_lengths(rules, rows)
    if not lengths:
        return urls.select("url", F.lit(None).cast("string").alias("url_category")).limit(0)
    anchors = anchors_of(rules, urls, lengths)
    if rows is None:
        anchors = stored(anchors, "anchors")
    if rows is not None or within_bound(anchors):
        # No piece is shuffled: those that anchor nothing go at once.
        anchors = F.broadcast(anchors)
    whole = F.expr("pos >= at AND substring(url, pos - at + 1, plen) = pattern")
    matched = _pieces(urls, lengths).join(anchors, "gram").where(whole)
    best = matched.groupBy("url").agg(
        F.min(F.struct(F.expr("pos - at + plen").alias("end"), (-F.col("plen")).alias("len"), "category"))
        .alias("best")
    )
    return best.select("url", F.col("best.category").alias("url_category"))


def url_strategy(pattern_count: int | None) -> str:
    """One expression for a handful of patterns, else the join; None stands for a dictionary beyond the bound."""
    return EXPRESSION if pattern_count is not None and pattern_count <= EXPRESSION_PATTERNS else JOIN


class Rules(NamedTuple):
    """The effective dictionary, and its rows where they fit the bound."""

    frame: DataFrame
    rows: list[Row] | None

    def of(self, kind: str) -> Rules:
        frame = self.frame.where(F.col("kind") == kind).select("pattern", "category")
        rows = None if self.rows is None else [row for row in self.rows if row.kind == kind]
        return Rules(frame, rows)


def load_rules(category_patterns: DataFrame, bound: BroadcastBound | None = None) -> Rules:
    """Measure the dictionary and fetch it, once, if it is small enough."""
    effective = effective_patterns(pattern_dictionary(category_patterns))
    return Rules(effective, bounded_rows(effective, bound or DICTIONARY_BOUND))


class Dictionary(NamedTuple):
    """All that a batch needs of a category dictionary: its rules, and the ids of its categories, as rows where they fit the bound."""

    rules: Rules
    ids: DataFrame
    id_rows: list[Row] | None


def prepared(category_patterns: DataFrame, bound: BroadcastBound | None = None) -> Dictionary:
    """Measure and fetch a dictionary once, for any number of batches."""
    ids = category_to_id(category_patterns)
    return Dictionary(load_rules(category_patterns, bound), ids, bounded_rows(ids, bound or DICTIONARY_BOUND))


def with_url_category(
    messages: DataFrame, rules: Rules, strategy: str | None = None, probe: Column | None = None
) -> DataFrame:
    """Add ``url_category``. ``probe`` is the URL to look up, null to skip the row."""
    probe = F.col("url") if probe is None else probe
    found = rules.of(URL)
    strategy = strategy or url_strategy(None if found.rows is None else len(found.rows))
    if strategy == JOIN or found.rows is None:
        probed = messages.withColumn("url_probe", F.nullif(probe, F.lit("")))
        urls = probed.where(F.col("url_probe").isNotNull()).select(F.col("url_probe").alias("url")).distinct()
        frame = found.frame if found.rows is None else local_frame(found.frame, found.rows)
        matched = url_categories_by_join(stored(urls, "urls"), frame, found.rows).withColumnRenamed("url", "url_probe")
        return attach(probed, stored(matched, "matched"), ["url_probe"]).drop("url_probe")
    pairs = [(row.pattern, row.category) for row in found.rows]
    if strategy == EXPRESSION or not pairs:
        return messages.withColumn("url_category", url_category_expression(probe, pairs))
    return messages.withColumn("url_category", url_category_matcher(pairs)(probe))


def classify_url(messages: DataFrame, category_patterns: DataFrame, strategy: str | None = None) -> DataFrame:
    return with_url_category(messages, load_rules(category_patterns), strategy)


# ---- App matching -----------------------------------------------------------


def with_app_category(messages: DataFrame, rules: Rules) -> DataFrame:
    """Add ``app_category``: the lower-cased app equals a pattern as stored."""
    found = rules.of(APP)
    frame = found.frame if found.rows is None else local_frame(found.frame, found.rows)
    keyed = frame.select(F.col("pattern").alias("app_probe"), F.col("category").alias("app_category"))
    probed = messages.withColumn("app_probe", F.lower("app"))
    if found.rows is None:
        return probed.join(keyed, "app_probe", "left").drop("app_probe")
    return probed.join(F.broadcast(keyed), "app_probe", "left").drop("app_probe")


def classify_app(messages: DataFrame, category_patterns: DataFrame) -> DataFrame:
    return with_app_category(messages, load_rules(category_patterns))


# ---- Learned labels ---------------------------------------------------------


def settled_labels(learned_labels: DataFrame) -> DataFrame:
    """One validated label per query string; a query without an answer has no row.

    Of several answers the one in the latest batch folder counts, if the table has those.
    """
    answered = learned_labels.where(F.col("label").isNotNull())
    order = ["batch_id"] if "batch_id" in learned_labels.columns else []
    one = answered.groupBy("query").agg(F.max(F.struct(*order, "label")).alias("last"))
    return one.select("query", validated_label(F.col("last.label")).alias("label_category"))


def with_label_category(
    messages: DataFrame, learned_labels: DataFrame, probe: Column | None = None, bounded: bool | None = None
) -> DataFrame:
    """Add ``label_category`` by query string. ``probe`` null skips the row.

    ``bounded`` tells whether the label table fits a broadcast, where that has been measured.
    """
    query = label_query(F.col("app"), F.col("title"), F.col("url")) if probe is None else probe
    probed = messages.withColumn("query", query)
    # The stored table is no smaller than its settled form, and cheaper to measure.
    if within_bound(learned_labels) if bounded is None else bounded:
        keyed = F.broadcast(settled_labels(learned_labels))
    else:
        # Only answers to the queries at hand are settled.
        asked = probed.where(F.col("query").isNotNull()).select("query").distinct()
        keyed = settled_labels(learned_labels.join(asked, "query", "left_semi"))
    return probed.join(keyed, "query", "left").drop("query")


# ---- The cascade ------------------------------------------------------------


def classify(
    messages: DataFrame,
    category_patterns: DataFrame | Dictionary,
    learned_labels: DataFrame | None = None,
    url_match: str | None = None,
    bound: BroadcastBound | None = None,
) -> DataFrame:
    """Add ``category``, ``method`` and ``is_llm`` to messages with app, title and url.

    ``bound`` replaces the bounds of the dictionary and of the label table. A ``prepared`` dictionary is not measured again.
    """
    rules = category_patterns.rules if isinstance(category_patterns, Dictionary) else load_rules(category_patterns, bound)
    urls = rules.of(URL).rows
    url_match = url_match or url_strategy(None if urls is None else len(urls))
    few_labels = learned_labels is None or within_bound(learned_labels, bound or DEFAULT_BOUND)
    if rules.rows is not None and url_match != JOIN and few_labels:
        return _resolved(messages, rules, learned_labels, url_match, True)
    keys = stored(messages.select(*KEY).distinct(), "keys")
    resolved = stored(_resolved(keys, rules, learned_labels, url_match, few_labels), "resolved")
    same = [F.col(f"resolved.{name}").eqNullSafe(F.col(f"messages.{name}")) for name in KEY]
    joined = messages.alias("messages").join(resolved.alias("resolved"), same, "left")
    return joined.select("messages.*", *[f"resolved.{name}" for name in ("category", "method", "is_llm")])


def _resolved(
    messages: DataFrame, rules: Rules, learned_labels: DataFrame | None, url_match: str, few_labels: bool
) -> DataFrame:
    staged = with_app_category(messages, rules)
    unmatched = F.when(F.col("app_category").isNull(), F.col("url"))
    staged = with_url_category(staged, rules, url_match, probe=unmatched)
    if learned_labels is None:
        staged = staged.withColumn("label_category", F.lit(None).cast("string"))
    else:
        open_query = F.when(
            F.coalesce("app_category", "url_category").isNull(),
            label_query(F.col("app"), F.col("title"), F.col("url")),
        )
        staged = with_label_category(staged, learned_labels, open_query, few_labels)
    method = (
        F.when(F.col("app_category").isNotNull(), BY_APP)
        .when(F.col("url_category").isNotNull(), BY_URL)
        .when(F.col("label_category").isNotNull(), BY_LABEL)
        .otherwise(BY_DEFAULT)
    )
    category = F.coalesce("app_category", "url_category", "label_category", F.lit(DEFAULT_CATEGORY))
    return staged.select(
        *messages.columns,
        category.alias("category"),
        method.alias("method"),
        method.isin(BY_LABEL, BY_DEFAULT).alias("is_llm"),
    )


def attach_category_id(classified: DataFrame, category_patterns: DataFrame | Dictionary) -> DataFrame:
    """Add ``category_id``; a category without a document gets the zero id."""
    if isinstance(category_patterns, Dictionary):
        _, ids, rows = category_patterns
    else:
        ids = category_to_id(category_patterns)
        rows = bounded_rows(ids, DICTIONARY_BOUND)
    known = ids if rows is None else F.broadcast(local_frame(ids, rows))
    joined = classified.join(known, "category", "left")
    return joined.select(*classified.columns, F.coalesce("category_id", F.lit(ZERO_ID)).alias("category_id"))


def unresolved_keys(classified: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Each distinct key no stage resolved, with the text a labeller is shown; ``by`` names further columns of the key."""
    app = F.lower("app").alias("app")
    keys = classified.where(F.col("method") == BY_DEFAULT).select(*by, app, "title", "url").distinct()
    parts = F.col("app"), F.col("title"), F.col("url")
    return keys.select(*by, label_query(*parts).alias("query"), *parts, label_prompt(*parts).alias("prompt"))
