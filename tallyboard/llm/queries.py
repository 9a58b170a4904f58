"""The registered queries of this subpackage and, where SQL can say it, their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyboard.llm import (
    chat,
    decontaminate,
    exact,
    licences,
    mixing,
    prefix_trie,
    quality,
    repair,
    simhash,
    tokens,
    toxicity,
    warc,
)
from tallyboard.llm.common import stored, table
from tallyboard.session import configure, new_run_dir


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one whose texts imitate control strings, formatted and read back."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    trap = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    back = chat.parse_chats(chat.format_chats(rows.unionByName(trap)))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(lines, 256).alias("turns_sha256"),
        F.char_length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.licences(table(spark, sf_dir, "documents"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_duplicates(table(spark, sf_dir, "documents"))


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_token_output(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    path = new_run_dir(spark, "tokens")
    tokens.write_tokens(table(spark, sf_dir, "documents"), path, tokenizer or default_tokenizer())
    return tokens.id_checksums(tokens.read_tokens(spark, path))


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the shards of the mix hold of each document."""
    mixed = mixing.mix(table(spark, sf_dir, "documents")).counted()
    return mixed.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


def op8_token_counts(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    lengths = tokens.token_lengths(table(spark, sf_dir, "documents"), tokenizer or default_tokenizer())
    return tokens.length_histogram(lengths)


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def damaged(conversations: DataFrame) -> DataFrame:
    """Turns damaged by a hash of their place: dropped, emptied, without stops, repeated, or said by the user. Nulls are a space."""
    space = F.lit(" ")
    rows = conversations.select(
        "conv_id",
        "turn",
        F.coalesce("role", space).alias("role"),
        F.coalesce("text", space).alias("text"),
        F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space)).alias("place"),
    ).withColumn("damage", F.crc32(F.col("place").cast("binary")) % 20)
    hurt = F.when(F.col("damage") == 1, "").when(F.col("damage") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    times = F.when(F.col("damage") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    left = rows.where("damage <> 0").select(
        "conv_id", "turn", F.when(F.col("damage") == 4, "user").otherwise(F.col("role")).alias("role"), hurt.alias("text"), F.explode(times)
    )
    return left.drop("col")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged conversations, their faults and their cheapest repair; those that lost every turn too."""
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hurt = damaged(given)
    plans = repair.repair_plans(hurt)
    every = given.select(F.col("conv_id").alias("given_id")).distinct()
    whole = every.join(plans, F.col("given_id").eqNullSafe(F.col("conv_id")), "left").select(
        F.col("given_id").alias("conv_id"),
        *[F.coalesce(name, F.lit(0)).cast("long").alias(name) for name in repair.COUNTS],
        F.coalesce("audit", F.lit("")).alias("audit"),
    )
    done = repair.repaired_digests(hurt, stored(whole, "plans"))
    return done.select("conv_id", *repair.COUNTS, "audit", F.col("sha256").alias("repaired_sha256"))


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages to archives and back; ids and lengths as the archives tell them, digests of what was read."""
    path = new_run_dir(spark, "warc")
    warc.write_warc(table(spark, sf_dir, "pages"), path)
    found = warc.records(warc.read_warc(spark, path))
    named = lambda name: F.regexp_extract(name, "^urn:pages:(-?[0-9]+):", 1).try_cast("long")
    return found.select(
        named("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", named("refers_to").alias("refers_to")
    )


def rebuilt(sequences: DataFrame) -> DataFrame:
    """Sequences whose first turns are those of the conversation twenty ids back at most, as many as a hash of the id says."""
    from_head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4
    heads = sequences.where("conv_id % 20 = 0").select(
        F.col("conv_id").alias("head_id"), F.slice("ids", 1, 3).alias("head_ids"), F.slice("words", 1, 3).alias("head_words")
    )
    joined = sequences.withColumn("taken", from_head.cast("int")).join(
        heads, F.col("conv_id") - F.col("conv_id") % 20 == F.col("head_id"), "left"
    )

    def spliced(name: str):
        first = F.slice(F.coalesce(f"head_{name}", F.slice(name, 1, 0)), F.lit(1), F.col("taken"))
        return F.concat(first, F.slice(name, F.col("taken") + 1, F.size(name))).alias(name)

    return joined.select("conv_id", spliced("ids"), spliced("words"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all conversations, rebuilt to share their first turns."""
    sequences = prefix_trie.encode_turns(table(spark, sf_dir, "conversations"))
    return prefix_trie.prefix_trie(rebuilt(stored(sequences, "encoded")))


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


QUERIES = {
    "op1_chat_format": op1_chat_format,
    "op2_simhash_near_dedup": op2_simhash_near_dedup,
    "op3_license_scan": op3_license_scan,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_benchmark_decontamination": op5_benchmark_decontamination,
    "op6_token_output": op6_token_output,
    "op7_source_mixing": op7_source_mixing,
    "op8_token_counts": op8_token_counts,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_toxicity": op10_toxicity,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_warc": op12_warc,
    "op13_prefix_trie": op13_prefix_trie,
}


def all_queries() -> dict:
    return {name: _configured(query) for name, query in QUERIES.items()}


def _configured(query):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(configure(spark), sf_dir)

    run.__name__, run.__doc__ = query.__name__, query.__doc__
    return run


# Length of the escaped text: a backslash doubles, a control string gets one more character.
_GROWN = "length({0}) + (length({0}) - length(replace({0}, '\\', '')))" + "".join(
    f" + (length({{0}}) - length(replace({{0}}, '{mark}', ''))) // {len(mark)}"
    for mark in ("<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "</SYS>>")
)

_KNOWN = ", ".join(f"('{said}', '{name}')" for name, said in licences.SENTENCES.items())


def _licence_hits(ids: str) -> str:
    """The rules that an ordered list of identifiers meets, by number."""
    runs = enumerate((" ".join(r.sentences), r.licence) for r in licences.RULES)
    return "[" + ", ".join(f"CASE WHEN contains({ids}, ' {run} ') THEN {n} END" for n, (run, _) in runs) + "]"


_RULE_NAMES = ", ".join(f"({n}, '{rule.licence}')" for n, rule in enumerate(licences.RULES))


def _crc32(text: str) -> str:
    """CRC-32 of an ASCII text: each byte is taken in, then eight bits are shifted out."""
    steps = f"flatten(list_transform(string_split({text}, ''), lambda c: [ascii(c)::BIGINT] || list_transform(range(8), lambda b: -1::BIGINT)))"
    step = "CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {steps}), lambda a, x: {step}), 4294967295)"


_FOLLOWS = "CASE WHEN m.after = 'u' THEN 'a' ELSE 'u' END"
_ROLE = f"CASE WHEN {_FOLLOWS} = 'u' THEN 'user' ELSE 'assistant' END"

ORACLES = {
    # A forward search that keeps the least cost and edits for each state after each turn.
    "op11_conversation_repair": rf"""
        WITH RECURSIVE given AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS place
            FROM conversations),
        chosen AS (SELECT *, {_crc32('place')} % 20 AS damage FROM given),
        hurt AS (
            SELECT conv_id, turn, CASE damage WHEN 4 THEN 'user' ELSE role END AS role,
                CASE damage WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                unnest(CASE damage WHEN 3 THEN [1, 2] ELSE [1] END) AS nth
            FROM chosen WHERE damage <> 0),
        placed AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, nth) AS i,
                regexp_matches(text, '[^ 	-
]') AS says, regexp_matches(text, '[.!?][ 	-
]*$') AS stops
            FROM hurt),
        faults AS (
            SELECT *, NOT says AS blank, says AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
                lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) NOT IN ('su', 'ua', 'au') AS illegal
            FROM placed),
        t AS (SELECT *, blank OR again AS goes, NOT (blank OR again OR stops) AS cut FROM faults),
        counts AS (
            SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) AS n,
                count(*) FILTER (blank) AS blank, count(*) FILTER (again) AS duplicate, count(*) FILTER (cut) AS truncated,
                count(*) FILTER (illegal) AS illegal
            FROM t GROUP BY conv_id),
        moves(before, after, letters, said) AS (
            VALUES ('', '', '', []::VARCHAR[]), ('s', 's', '', []), ('u', 'u', '', []), ('a', 'a', '', []),
                ('', 'u', 'I', ['user:']), ('s', 'u', 'I', ['user:']), ('a', 'u', 'I', ['user:']), ('u', 'a', 'I', ['assistant:']),
                ('', 'a', 'II', ['user:', 'assistant:']), ('s', 'a', 'II', ['user:', 'assistant:'])),
        edits(edit) AS (VALUES ('D'), ('K'), ('R')),
        walk(conv_id, i, state, best) AS (
            SELECT DISTINCT conv_id, 0::BIGINT, '', {{'cost': 0::BIGINT, 'audit': '', 'said': []::VARCHAR[]}} FROM given
            UNION ALL
            SELECT conv_id, i, state, min(best) FROM (
                SELECT t.conv_id, t.i,
                    CASE edit WHEN 'D' THEN m.after WHEN 'K' THEN left(t.role, 1) ELSE {_FOLLOWS} END AS state,
                    {{'cost': w.best.cost + 3 * length(m.letters) + CASE edit WHEN 'D' THEN 4 WHEN 'K' THEN 0 ELSE 3 END
                        + CASE WHEN t.cut AND edit <> 'D' THEN 3 ELSE 0 END,
                      'audit': w.best.audit || m.letters || edit,
                      'said': w.best.said || m.said || CASE edit WHEN 'D' THEN [] WHEN 'K' THEN [t.role || ':' || t.text]
                        ELSE [{_ROLE} || ':' || t.text] END}} AS best
                FROM walk w JOIN t ON t.conv_id IS NOT DISTINCT FROM w.conv_id AND t.i = w.i + 1
                JOIN moves m ON m.before = w.state CROSS JOIN edits
                WHERE edit = 'D' OR NOT t.goes AND (edit = 'R' OR left(t.role, 1) = {_FOLLOWS}
                    OR left(t.role, 1) = 's' AND m.after = ''))
            GROUP BY conv_id, i, state),
        ended AS (
            SELECT w.conv_id, min({{'cost': w.best.cost + 3 * length(m.letters), 'audit': w.best.audit || m.letters,
                'said': w.best.said || m.said}}) AS best
            FROM walk w LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM w.conv_id
            JOIN moves m ON m.before = w.state AND m.after IN ('', 'a')
            WHERE w.i = coalesce(c.n, 0) GROUP BY w.conv_id)
        SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
            coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, best.cost AS cost, best.audit AS audit,
            sha256(array_to_string(best.said, chr(10))) AS repaired_sha256
        FROM ended e LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM e.conv_id""",
    "op12_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
        d AS (
            SELECT *, sha1(html) AS hex, max(page_id) OVER (PARTITION BY html) AS first_id,
                row_number() OVER (PARTITION BY html ORDER BY page_id DESC NULLS LAST) > 1 AS again
            FROM p)
        SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes,
            array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                1 + ((('0x' || substr(hex, (1 + 5 * (k // 4))::INT, 5))::BIGINT >> (15 - 5 * (k % 4))::INT) & 31), 1)), '') AS payload_digest,
            CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN again THEN first_id END AS refers_to
        FROM d""",
    "op13_prefix_trie": rf"""
        WITH t AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
        s AS (
            SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY turn NULLS FIRST, role, text) AS turns,
                {_crc32('conv_id::VARCHAR')} % 4 AS h
            FROM t GROUP BY conv_id),
        r AS (
            SELECT s.conv_id, coalesce(b.turns[1:s.h], []) || s.turns[s.h + 1:] AS turns
            FROM s LEFT JOIN s b ON b.conv_id = s.conv_id - s.conv_id % 20),
        p AS (
            SELECT conv_id, len(turns) AS n, unnest(range(len(turns) + 1)) AS depth, turns FROM r),
        k AS (
            SELECT conv_id, n, depth, turns[depth].text AS said,
                sha256(array_to_string(list_transform(turns[1:depth],
                    lambda x: length(x.role) || ':' || x.role || length(x.text) || ':' || x.text), '')) AS key,
                sha256(array_to_string(list_transform(turns[1:depth - 1],
                    lambda x: length(x.role) || ':' || x.role || length(x.text) || ':' || x.text), '')) AS above
            FROM p),
        nodes AS (
            SELECT key, depth, min(conv_id) AS conv_id, any_value(CASE WHEN depth > 0 THEN above END) AS above, count(*) AS n_convs,
                (count(*) - 1) * CASE WHEN depth > 0 THEN len(regexp_extract_all(any_value(said), '[^ 	-
]+')) ELSE 0 END AS saved,
                sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = depth), '')) AS ends_sha256
            FROM k GROUP BY key, depth),
        children AS (SELECT above, count(*) AS n FROM nodes GROUP BY above),
        below AS (SELECT DISTINCT a.key, a.depth, b.key AS under, b.depth AS under_depth FROM k a JOIN k b ON a.conv_id = b.conv_id AND b.depth >= a.depth),
        sums AS (
            SELECT below.key, below.depth, sum(n.saved)::BIGINT AS saved_tokens, count(*) FILTER (c.n IS NULL) AS n_leaves
            FROM below JOIN nodes n ON n.key = under AND n.depth = under_depth LEFT JOIN children c ON c.above = n.key
            GROUP BY below.key, below.depth)
        SELECT n.conv_id, n.depth::BIGINT AS depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children,
            s.n_leaves, s.saved_tokens, n.ends_sha256
        FROM nodes n JOIN sums s ON s.key = n.key LEFT JOIN children c ON c.above = n.key LEFT JOIN nodes u ON u.key = n.above""",
    # Sentence ends become bars, and the text between two bars is looked up.
    "op3_license_scan": rf"""
        WITH bare AS (
            SELECT row_number() OVER () AS nr, doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(
                regexp_replace(lower(replace(coalesce(text, ''), '|', ' ')), '\r\n?', chr(10), 'g'),
                '(?m)^[ \t]*(//+|#+|/\*+|\*+/?|--|;+|%+|<!--)|(\*+/|-->)[ \t]*$', '', 'g'),
                'https?://[^\s]+', chr(10) || chr(10), 'g'), '(identifier|\bv)[.:] ', '\1 ', 'g'),
                '(copyright[^\n]*?)\b(permission is hereby|permission to use|licensed under|redistribution and use|this program is|this library is|this source code)',
                '\1' || chr(10) || chr(10) || '\2', 'g') AS said
            FROM documents),
        barred AS (
            SELECT nr, doc_id, 1 AS reading, regexp_replace(said, '\n|[.!?;:](\s|$)', '|', 'g') AS line FROM bare
            UNION ALL
            SELECT nr, doc_id, 2, regexp_replace(said, '\n\s*\n|[.!?;:](\s|$)', '|', 'g') FROM bare),
        cut AS (
            SELECT nr, doc_id, reading, unnest(string_split(line, '|')) AS sentence, generate_subscripts(string_split(line, '|'), 1) AS place
            FROM barred),
        known(said, name) AS (VALUES {_KNOWN}),
        found AS (
            SELECT nr, doc_id, reading, string_agg(name, ' ' ORDER BY place) AS ids, count(*) AS n
            FROM cut JOIN known k
                ON regexp_replace(trim(regexp_replace(sentence, '[^a-z0-9]+', ' ', 'g')), '^[0-9][0-9]? ([a-z])', '\1') = k.said
            GROUP BY nr, doc_id, reading),
        rules(n, licence) AS (VALUES {_RULE_NAMES}),
        met AS (
            SELECT nr, string_agg(licence, ' ' ORDER BY first) AS licences FROM (
                SELECT nr, licence, min(rules.n) AS first
                FROM (SELECT nr, unnest({_licence_hits("' ' || ids || ' '")}) AS n FROM found) hits JOIN rules ON rules.n = hits.n
                GROUP BY nr, licence)
            GROUP BY nr)
        SELECT f.doc_id, f.ids AS sentence_ids, f.n AS n_sentences, coalesce(m.licences, '') AS licences
        FROM found f LEFT JOIN met m ON m.nr = f.nr
        QUALIFY row_number() OVER (PARTITION BY f.nr ORDER BY f.n DESC, reading) = 1""",
    "op1_chat_format": f"""
        WITH t AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
            UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
        s AS (
            SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS before FROM t)
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
            coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
            sum({_GROWN.format('text')} + CASE WHEN before IS DISTINCT FROM role
                THEN {len(chat.TURN + chat.TEXT + chat.END)} + {_GROWN.format('role')} ELSE {len(chat.NEXT)} END)::BIGINT AS formatted_chars
        FROM s GROUP BY conv_id""",
    "op4_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id, length(coalesce(text, '')) AS points,
                sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
            FROM documents)
        SELECT doc_id,
            first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY points DESC, doc_id) AS keep_id,
            count(*) OVER (PARTITION BY text_sha256) AS group_size,
            doc_id = first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY points DESC, doc_id) AS kept,
            text_sha256
        FROM d""",
}


def all_oracles() -> dict[str, str]:
    return dict(ORACLES)
