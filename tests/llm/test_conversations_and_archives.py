"""Conversation repair, archives and the prefix trie against brute force, on small tables with nulls, ties and repeats."""

import base64
import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tallyboard.llm import prefix_trie, repair, warc

TURNS = "conv_id long, turn long, role string, text string"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text)


# ---- conversation repair -----------------------------------------------------------


def all_repairs(codes, costs, most_inserts):
    """Every (cost, audit) of a short conversation, by trying all edits."""
    out = []

    def go(at, state, inserts, cost, audit):
        if at == len(codes) and state in repair.ENDS:
            out.append((cost, audit))
        if inserts < most_inserts:
            go(at, repair.FOLLOWS[state], inserts + 1, cost + costs.insert, audit + "I")
        if at == len(codes):
            return
        go(at + 1, state, inserts, cost + costs.delete, audit + "D")
        if codes[at] & repair.GOES:
            return
        stays = costs.truncated if codes[at] & repair.TRUNCATED else 0
        role = codes[at] & repair.ROLE
        if role == repair.FOLLOWS[state] or (role == repair.SYSTEM and state == repair.START):
            go(at + 1, role, inserts, cost + costs.keep + stays, audit + "K")
        go(at + 1, repair.FOLLOWS[state], inserts, cost + costs.rerole + stays, audit + "R")

    go(0, repair.START, 0, 0, "")
    return min(out)


@pytest.mark.parametrize("costs", [repair.Costs(), repair.Costs(1, 2, 5, 1, 0), repair.Costs(0, 0, 0, 1, 2)])
def test_the_auction_finds_the_cheapest_least_repair(costs):
    rng = random.Random(5)
    faults = [0, 0, 0, repair.TRUNCATED, repair.BLANK, repair.DUPLICATE]
    for _ in range(150):
        codes = bytes(rng.choice([0, 1, 2, 3, 2, 3]) | rng.choice(faults) for _ in range(rng.randrange(6)))
        assert repair.cheapest_repair(codes, costs) == all_repairs(codes, costs, 5)


def test_prices_contradict_no_arc_and_long_conversations_are_linear():
    rng = random.Random(6)
    codes = bytes(rng.choice([0, 1, 2, 3]) | rng.choice([0, 0, repair.TRUNCATED, repair.BLANK]) for _ in range(20_000))
    prices = repair.auction_prices(codes)
    for at in range(len(codes)):
        for state, arcs in enumerate(repair.arcs_before(codes[at], repair.Costs())):
            offers = [cost + prices[at + step, after] for _, cost, step, after in arcs]
            assert prices[at, state] == min(offers)
    cost, audit = repair.cheapest_repair(codes)
    assert cost == prices[0, repair.START] and len(audit) - audit.count("I") == len(codes)
    with pytest.raises(ValueError):
        repair.Costs(insert=0)


def repaired_brute(rows):
    """(counts, cost, audit, repaired turns) of one conversation, by a forward search."""
    rows = sorted(((t is not None, t or 0, r if r is not None else " ", x if x is not None else " ") for _, t, r, x in rows))
    seen, codes, blank, again, cut = set(), [], 0, 0, 0
    for _, _, role, text in rows:
        code = {"s": 1, "u": 2, "a": 3}.get(role[:1], 0)
        said = re.findall(r"[^\x20\x09-\x0D]", text)
        if not said:
            code, blank = code | repair.BLANK, blank + 1
        elif (role, text) in seen:
            code, again = code | repair.DUPLICATE, again + 1
        elif said[-1] not in ".!?":
            code, cut = code | repair.TRUNCATED, cut + 1
        seen.add((role, text))
        codes.append(code)
    initials = [role[:1] for _, _, role, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    numbers = [t for known, t, _, _ in rows if known]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    cost, audit = all_repairs(codes, repair.Costs(), 3)
    turns, state, at = [], repair.START, 0
    for letter in audit:
        if letter == "I":
            state = repair.FOLLOWS[state]
            turns.append((repair.ROLES[state], ""))
            continue
        _, _, role, text = rows[at]
        at += 1
        if letter == "K":
            state = repair.INITIALS[role[0]]
            turns.append((role, text))
        elif letter == "R":
            state = repair.FOLLOWS[state]
            turns.append((repair.ROLES[state], text))
    return (gaps, blank, again, cut, illegal, cost, audit), turns


def repair_rows():
    rng = random.Random(9)
    rows = []
    for conv in [None, *range(60)]:
        for _ in range(rng.randrange(7)):
            turn = rng.choice([None, *range(8)])
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", None, ""])
            rows.append((conv, turn, role, rng.choice(["Yes.", "No", "Why?\n", " \t", "", None, "x\u0085", "end.\u0085", "ok! \x0b"])))
            if rng.random() < 0.2:
                rows.append(rows[-1])
    return rows


def test_repairs_of_odd_conversations(spark):
    rows = repair_rows()
    frame = spark.createDataFrame(rows, TURNS).withColumn("code", F.lit("mine")).withColumn("audit", F.lit("mine"))
    plans = repair.repair_plans(frame)
    by_conv = {}
    for row in rows:
        by_conv.setdefault(row[0], []).append(row)
    want = {conv: repaired_brute(some) for conv, some in by_conv.items()}
    assert {r.conv_id: tuple(r[name] for name in (*repair.COUNTS, "audit")) for r in plans.collect()} == {c: w[0] for c, w in want.items()}
    turns = {}
    for r in sorted(repair.repaired_turns(frame, plans).collect(), key=lambda r: (str(r.conv_id), r.place)):
        turns.setdefault(r.conv_id, []).append((r.role, r.text))
    assert turns == {c: w[1] for c, w in want.items() if w[1]}
    digests = {r.conv_id: (r.turns, r.sha256) for r in repair.repaired_digests(frame, plans).collect()}
    line = lambda t: "\n".join(f"{role}:{text}" for role, text in t)
    assert digests == {c: (len(w[1]), hashlib.sha256(line(w[1]).encode()).hexdigest()) for c, w in want.items()}


def test_repairs_of_one_long_conversation_and_of_none(spark):
    rows = [(1, i, ("user", "assistant")[i % 2], f"turn {i}." + "x" * (60_000 * (i == 5)) + ".") for i in range(15_000)]
    plans = repair.repair_plans(spark.createDataFrame(rows, TURNS))
    assert plans.first().audit == "K" * 15_000
    assert repair.repaired_turns(spark.createDataFrame(rows, TURNS), plans).count() == 15_000
    none = spark.createDataFrame([], TURNS)
    assert repair.repair_plans(none).count() == 0 and repair.repaired_turns(none, repair.repair_plans(none)).count() == 0


# ---- archives ----------------------------------------------------------------------

PAGES = "page_id long, url string, html string"


def b32(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def page_rows():
    rows = [(i, f"http://a/{i}", f"<p>{i % 7}</p>" if i % 3 else f"<b>{i}</b>") for i in range(200)]
    rows += [(500, "http://nul", None), (501, None, ""), (502, "http://e/ö x\r\nWARC-Type: y", "é\x00\r\n\r\nWARC/1.1\r\n"), (None, "http://n", "<p>1</p>")]
    rows += [(600, "http://hot", "hot")] * 3 + [(601 + i, "http://hot", "hot") for i in range(150)] + [(750, "http://hot", "hot")] * 2
    return rows + [(900, "http://long", "long " * 50_000), (901, "http://long", "long " * 50_000), (None, None, "alone"), (None, None, "alone")]


@pytest.mark.parametrize("compressed,least", [(True, 0), (False, 0), (True, 5)])
def test_archives_round_trip(spark, tmp_path, compressed, least):
    rows = page_rows()
    frame = spark.createDataFrame(rows, PAGES).withColumn("sha1", F.lit("mine")).withColumn("n", F.lit(0)).repartition(5)
    path = str(tmp_path / "w")
    warc.write_warc(frame, path, least_bytes=least, compressed=compressed, records_per_file=50)
    found = warc.read_warc(spark, path)
    assert warc.gaps(found).count() == 0
    back = warc.records(found).collect()
    by_payload = {}
    for i, _, html in rows:
        by_payload.setdefault((html or "").encode(), []).append(i)
    want = []
    for payload, ids in by_payload.items():
        ids.sort(key=lambda i: (i is not None, i or 0), reverse=True)
        for k, i in enumerate(ids):
            again = k > 0 and len(payload) >= least
            want.append((i, len(payload), b32(payload), "revisit" if again else "response", ids[0] if again else None))
    number = lambda name: int(name.split(":")[2]) if name and name.split(":")[2] else None
    got = [(number(r.record_id), r.payload_bytes, r.payload_digest, r.record_type, number(r.refers_to)) for r in back]
    assert sorted(got, key=str) == sorted(want, key=str)
    if least == 0:  # rows repeated in full and all stored are not told apart
        names = [r.record_id for r in back]
        assert len(set(names)) == len(names)
        assert {r.refers_to for r in back if r.refers_to} <= {r.record_id for r in back if r.record_type == "response"}
    assert {bytes(r.payload) for r in back if r.payload is not None} == set(by_payload)
    assert all((r.payload is None) == (r.record_type == "revisit") for r in back)


def test_archives_of_nothing(spark, tmp_path):
    warc.write_warc(spark.createDataFrame([], PAGES), str(tmp_path / "w"))
    assert warc.read_warc(spark, str(tmp_path / "w")).count() == 0


def sample_records(compressed):
    rng = random.Random(1)
    payloads = [bytes(rng.randrange(256) for _ in range(rng.randrange(400))) for _ in range(30)]
    payloads += [b"WARC/1.1\r\nhi\r\n\r\n", b"", warc.MEMBER + b"no member"]
    plain = [warc.record_bytes("response", f"urn:pages:{i}:x", "http://a", b32(p), len(p), p, None, warc.DATE) for i, p in enumerate(payloads)]
    return payloads, [warc.gzip_member(r) for r in plain] if compressed else plain


@pytest.mark.parametrize("compressed", [True, False])
def test_salvage_recovers_all_that_was_not_hit(compressed):
    payloads, parts = sample_records(compressed)
    data, starts = b"".join(parts), [0]
    for part in parts:
        starts.append(starts[-1] + len(part))
    assert [found["payload"] for _, _, found in warc.salvage(data)] == payloads
    rng = random.Random(2)
    for _ in range(150):
        at, length, kind = rng.randrange(len(data)), rng.randrange(1, 600), rng.randrange(4)
        noise = bytes(rng.randrange(256) for _ in range(length))
        harmed = {0: data[:at] + noise + data[at + length :], 1: data[:at], 2: data[:at] + data[at + length :], 3: data[:at] + noise + data[at:]}[kind]
        end = {0: at + length, 1: len(data), 2: at + length, 3: at}[kind]
        whole = {str(k) for k in range(len(parts)) if starts[k + 1] <= at or starts[k] >= end}
        found = list(warc.salvage(harmed))
        read = {r["record_id"].split(":")[2] for _, _, r in found if isinstance(r, dict) and r["record_id"].count(":") == 3}
        assert whole <= read
        place = 0
        for start, stop, _ in found:  # every byte is in a record or in the log, but for padding
            assert start == place or not any(harmed[place:start])
            place = stop
        assert place == len(harmed) or not any(harmed[place:])


def test_salvage_names_its_reasons():
    payloads, parts = sample_records(True)
    one = warc.record_bytes("response", "urn:x", None, b32(b"abc"), 3, b"abc", None, warc.DATE)
    other = warc.gzip_member(one.replace(b"abc\r\n", b"abd\r\n"))
    data = b"garbage" + parts[0] + other + parts[1][:-9] + parts[2] + parts[3][:20]
    found = list(warc.salvage(data))
    assert [x if isinstance(x, str) else x["payload"] for _, _, x in found] == [
        "no record", payloads[0], "block digest", "gzip member", payloads[2], "cut off"]
    assert list(warc.salvage(b"")) == [] and list(warc.salvage(b"\0\0")) == []
    assert [x for _, _, x in warc.salvage(one.replace(b"Content-Length: ", b"Content-Length: 9"))] == ["cut off"]


def test_large_members_end_with_a_zero():
    big = random.Random(3).randbytes(17 << 20)
    member = warc.gzip_member(warc.record_bytes("response", "urn:x", None, b32(big), len(big), big, None, warc.DATE))
    found = list(warc.salvage(member + member))
    assert member[-1] == 0 and [x["payload_bytes"] for _, _, x in found] == [len(big)] * 2


def test_gap_log_of_a_damaged_file(spark, tmp_path):
    rows = [(i, f"http://a/{i}", f"<p>{i}</p>") for i in range(40)]
    path = tmp_path / "w"
    warc.write_warc(spark.createDataFrame(rows, PAGES).coalesce(1), str(path))
    data = bytearray(max(path.glob("part-*"), key=lambda f: f.stat().st_size).read_bytes())
    whole = sum(isinstance(x, dict) for _, _, x in warc.salvage(bytes(data)))
    data[len(data) // 2 : len(data) // 2 + 30] = bytes(range(100, 130))
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "x.warc.gz").write_bytes(data)
    found = warc.read_warc(spark, str(tmp_path / "d"), "*.warc.gz")
    gap = warc.gaps(found).collect()
    assert len(gap) == 1 and gap[0].start <= len(data) // 2 < gap[0].start + gap[0].length
    assert whole - 2 <= warc.records(found).count() < whole


# ---- prefix trie -------------------------------------------------------------------


def trie_brute(sequences):
    """From (conv_id, tuple of (role, text))."""
    nodes = {}
    for conv, turns in sequences:
        for depth in range(len(turns) + 1):
            nodes.setdefault(turns[:depth], []).append((conv, len(turns) == depth))
    out = []
    for prefix, members in nodes.items():
        below = [p for p in nodes if p[: len(prefix)] == prefix]
        parent = lambda p: any(q[:-1] == p and q for q in nodes)
        saved = sum((len(nodes[p]) - 1) * len(words(p[-1][1])) for p in below if p)
        ends = ",".join(map(str, sorted(c for c, last in members if last)))
        out.append((
            min(c for c, _ in members), len(prefix), min(c for c, _ in nodes[prefix[:-1]]) if prefix else None, len(members),
            sum(1 for q in nodes if q and q[:-1] == prefix), sum(not parent(p) for p in below), saved, hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def trie_rows(seed, convs=60):
    rng = random.Random(seed)
    said = ["a", "a b", "a b c ", "", None, "z\x0by", "ä ö"]
    rows = []
    for conv in range(-3, convs):
        if conv % 3 == 0:  # a third of all conversations are the same
            some = [("user", "hot hot"), ("assistant", "hot"), ("user", "a")]
        else:
            some = [(rng.choice(["user", "assistant", None]), rng.choice(said)) for _ in range(rng.randrange(1, 5))]
        rows += [(conv, None if i == 0 and conv % 5 == 0 else i, *turn) for i, turn in enumerate(some)]
    return rows


def sequences_of(rows):
    by_conv = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            by_conv.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    return [(conv, tuple((r, t) for _, _, r, t in sorted(some))) for conv, some in by_conv.items()]


def collected(frame):
    return sorted((tuple(r[name] for name in prefix_trie.NODE) for r in frame.collect()), key=str)


@pytest.mark.parametrize("seed,shard_turns", [(1, 200_000), (2, 12), (3, 5)])
def test_trie_equals_brute_force(spark, seed, shard_turns):
    rows = trie_rows(seed) + [(70, 0, "user", "same"), (70, 0, "user", "same"), (None, 0, "user", "lost"), (71, 0, "user", "long " * 9_000)]
    frame = spark.createDataFrame(rows, TURNS).withColumn("ids", F.lit("mine")).withColumn("uses", F.lit(1))
    encoded = prefix_trie.encode_turns(frame)
    assert collected(prefix_trie.prefix_trie(encoded, shard_turns)) == trie_brute(sequences_of(rows))


def test_trie_of_turnless_and_deep_conversations(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "IDS_AT_ONCE", 2)
    kind = "conv_id long, ids array<long>, words array<int>"
    deep = list(range(300))
    rows = [(i, [], []) for i in range(7)] + [(10 + i, deep, [2] * 300) for i in range(9)] + [(30, deep[:100], [2] * 100), (None, [1], [1])]
    got = collected(prefix_trie.prefix_trie(spark.createDataFrame(rows, kind), 400))
    texts = [(c, tuple(("", f"{x} x") for x in ids)) for c, ids, _ in rows if c is not None]
    assert got == trie_brute(texts)
    assert prefix_trie.prefix_trie(spark.createDataFrame([], kind)).count() == 0
    assert prefix_trie.encode_turns(spark.createDataFrame([], TURNS)).count() == 0


def test_median_insertion_balances_siblings():
    tree = prefix_trie.TernaryTree()
    for k in prefix_trie.medians(1000):
        tree.insert([k], [0], k)
    assert list(map(tree.id.__getitem__, tree.children(0))) == list(range(1000))

    def height(node):
        return 0 if node < 0 else 1 + max(height(tree.low[node]), height(tree.high[node]))

    assert height(tree.same[0]) == 10


def test_turn_numbers_keep_the_order_of_texts(spark):
    rows = [(i, 0, r, t) for i, (r, t) in enumerate([("b", "x"), ("a", "z"), ("a", ""), ("", "q"), ("a", "z")])]
    ids = {r.conv_id: r.ids[0] for r in prefix_trie.encode_turns(spark.createDataFrame(rows, TURNS)).collect()}
    assert ids[3] < ids[2] < ids[1] == ids[4] < ids[0]
