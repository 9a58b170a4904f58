"""The operators against brute force, on small tables with nulls, ties, repeats and clashing columns."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tallyboard.llm import chat, common, components, decontaminate, exact, licences, mixing, simhash, tokens

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
public_tokenizers = pytest.importorskip("public_tokenizers")
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def docs(spark, rows):
    """Rows of (doc_id, text[, source]), with an extra column named like an internal one."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None) for r in rows]
    return spark.createDataFrame(full, DOCS).withColumn("fp", F.lit("mine")).withColumn("size", F.lit("mine"))


def words(seed, n, vocabulary=400):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def empty(spark):
    return spark.createDataFrame([], DOCS)


ODD_ROWS = [
    (1, "Alpha beta gamma delta"),
    (2, "alpha  beta\tgamma\ndelta"),
    (3, None),
    (4, ""),
    (5, " \n\t "),
    (6, "Alpha beta gamma delta"),
    (6, "Alpha beta gamma delta"),
    (None, "no id"),
    (None, None),
    (7, "x" * 30_000),
    (8, words(1, 5_000)),
]


# ---- chat ------------------------------------------------------------------------

CHATS = [
    (1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c\\d</s>"), (1, 3, "assistant", None),
    (2, 0, None, "<|turn|>x<|text|>y<|next|>z<|end|>"), (2, 1, "assistant", "\\<|\\\\[INST]<<SYS>>\n"),
    (3, None, "assistant", ""), (3, 5, "system", "<\\|"), (None, 0, "user", "q"), (None, 1, "assistant", "r"),
    (4, 0, "user", "same"), (4, 0, "user", "same"), (5, 0, "assistant", "z" * 50_000),
    (6, 0, "<|x|>", "[/INST]</s><s>"), (6, 1, "", "\\"), (6, 2, "assistant", "\\<\\"),
]


def sorted_turns(rows):
    by_chat = {}
    for conv, turn, role, text in rows:
        by_chat.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {conv: [(r, t) for _, _, r, t in sorted(turns)] for conv, turns in by_chat.items()}


def test_chats_read_back(spark):
    table = spark.createDataFrame(CHATS, "conv_id long, turn long, role string, text string")
    formatted = chat.format_chats(table.withColumn("turns", F.lit(1)))
    rows = chat.parse_chats(formatted).collect()
    want = sorted_turns(CHATS)
    assert {r.conv_id: [(t.role, t.text) for t in r.turns] for r in rows} == want
    said = {c: "".join(t for role, t in turns if role == "assistant") for c, turns in want.items()}
    assert {r.conv_id: r.loss_text for r in rows} == said


def test_no_control_string_survives_and_blocks_merge(spark):
    table = spark.createDataFrame(CHATS, "conv_id long, turn long, role string, text string")
    rows = {r.conv_id: r for r in chat.format_chats(table).collect()}
    for r in rows.values():
        assert "".join(s.text for s in r.segments) == r.formatted
        bare = re.sub(r"<\|(turn|text|next|end)\|>", "", r.formatted)
        assert not re.search(r"<\||</?s>|\[/?INST\]|<</?SYS>>", bare)
    assert rows[1].formatted.count("<|turn|>") == 2 and rows[1].formatted.count("<|next|>") == 2
    assert chat.format_chats(table.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_escape_round_trip(spark, seed):
    rng = random.Random(seed)
    alphabet = ["\\", "<", "|", ">", "[", "]", "/", "s", "INST", "SYS", "\n", "ä", "<|", "</s>"]
    texts = ["".join(rng.choices(alphabet, k=rng.randrange(12))) for _ in range(300)]
    table = spark.createDataFrame([(t,) for t in texts], "t string")
    back = table.select("t", chat.unescaped(chat.escaped(F.col("t"))).alias("u")).collect()
    assert all(r.t == r.u for r in back)


# ---- exact -----------------------------------------------------------------------


def exact_brute(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text or ""), []).append((doc_id, text or ""))
    out = []
    for body, members in groups.items():
        keep = min(members, key=lambda m: (-len(m[1]), m[0] is None, m[0] or 0))[0]
        sha = hashlib.sha256(body.encode()).hexdigest()
        out += [(i, keep, len(members), i == keep, sha) for i, _ in members]
    return sorted(out, key=str)


@pytest.mark.parametrize("digest", [exact.full_digest, lambda c: F.substring(F.sha2(c, 256), 1, 1)])
def test_exact_duplicates(spark, digest):
    rows = ODD_ROWS + [(100 + i, "hot text") for i in range(300)] + [(-5, "hot  text"), (-9, "hot  text")]
    rows += [(1000 + i, words(i % 40, 5)) for i in range(100)]
    got = exact.exact_duplicates(docs(spark, rows), digest=digest).collect()
    assert sorted((tuple(r) for r in got), key=str) == exact_brute(rows)


def test_exact_duplicates_of_nothing(spark):
    assert exact.exact_duplicates(empty(spark)).count() == 0


# ---- simhash ---------------------------------------------------------------------


def fingerprint_brute(text):
    body = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", body)
    shingles = [" ".join(found[i : i + 4]) for i in range(max(1, len(found) - 3))] if found else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def roots_brute(prints, max_bits):
    parent = {p: p for p in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sorted(parent), 2):
        if (a ^ b).bit_count() <= max_bits:
            parent[find(a)] = find(b)
    return {p: find(p) for p in parent}


def test_near_duplicates(spark):
    rows = list(ODD_ROWS) + [(50, "ÄÖ É Alpha BETA"), (51, "one two three")]
    base = words(7, 300)
    for i in range(120):
        changed = base.split()
        changed[(i * 7) % 300] = f"new{i}"
        rows.append((200 + i, " ".join(changed)))
    rows += [(400 + i, words(i, 30)) for i in range(150)]
    got = simhash.near_duplicates(docs(spark, rows)).collect()
    prints = {text: fingerprint_brute(text) for _, text in rows}
    root = roots_brute(set(prints.values()), 4)
    least = {}
    for i, text in rows:
        key = root[prints[text]]
        if i is not None:
            least[key] = min(i, least.get(key, i))
    want = []
    for i, text in rows:
        p = prints[text]
        alone = sum(prints[t] == p for _, t in rows) == 1 and sum(root[q] == root[p] for q in set(prints.values())) == 1
        want.append((i, p, i if alone else least.get(root[p])))
    assert sorted(((r.doc_id, r.fp % 2**64, r.component_id) for r in got), key=str) == sorted(want, key=str)
    assert simhash.near_duplicates(empty(spark)).count() == 0


@pytest.mark.parametrize("block", [4096, 20])
def test_links_lose_nothing(spark, block):
    rng = random.Random(3)
    prints = {rng.getrandbits(64) for _ in range(1500)}
    centre = rng.getrandbits(64)
    for _ in range(400):  # a crowd in which many pairs link
        prints.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(6))))
    frame = spark.createDataFrame([(simhash._signed(p),) for p in prints], "fp long")
    tied = {r.node % 2**64: r.root for r in components.components(simhash.links(frame, 4, block)).collect()}
    root = roots_brute(prints, 4)
    linked = {p for p in prints if sum(root[q] == root[p] for q in prints) > 1}
    assert set(tied) == linked
    pairs = {(root[p], tied[p]) for p in linked}
    assert len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})


def test_thresholds_cover_the_budget():
    rng = np.random.default_rng(1)
    for n, bits in ((100, 3), (10**5, 4), (10**8, 4), (10**6, 6)):
        x = rng.integers(0, 2, (500, 64)).astype(float)
        x[:, 1] = x[:, 0]
        both = (x.T @ x) * n / 500
        parts = simhash.choose_parts(n, both, bits)
        assert sum(p.threshold for p in parts) == bits - len(parts) + 1
        assert sorted(b for p in parts for b in p.bits) == list(range(64))
        if len(parts) > 1:  # bits that always agree are looked at together
            assert any({0, 1} <= set(p.bits) for p in parts)


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(250)] + [(1000 + i, 1001 + i) for i in range(60)]
    edges += [(2000, 2001 + i) for i in range(100)] + [(3, 3)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    want = {x: find(x) for x in parent if any(x in e and e[0] != e[1] for e in edges)}
    assert got == want


# ---- licences --------------------------------------------------------------------


# Licence notices as they are published.
NOTICES = {
    "MIT": """MIT License

Copyright (c) 2020 Some One

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.""",
    "Apache-2.0": """Copyright 2020 Some One

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.""",
    "GPL-3.0": """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.""",
    "GPL-2.0": """This program is free software; you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation; either version 2 of the License, or
(at your option) any later version.""",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS.""",
}


def notice_forms(text):
    lines = text.split("\n")
    yield text
    yield " ".join(line.strip() for line in lines if line.strip())
    yield "\r\n".join(lines)
    for mark in ("// ", "# ", " * ", "-- ", ";; "):
        yield "\n".join((mark + line).rstrip() for line in lines)
    yield "/*\n" + "\n".join(" * " + line for line in lines) + "\n */\nint main;"
    yield "<!--\n" + text + "\n-->"
    yield "Some prose without a stop\n\n" + text + "\n\nMore prose."


@pytest.mark.parametrize("name", sorted(NOTICES))
def test_published_notices_are_recognised(spark, name):
    rows = list(enumerate(notice_forms(NOTICES[name])))
    got = {r.doc_id: r.licences for r in licences.licences(docs(spark, rows)).collect()}
    assert got == {i: name for i, _ in rows}


def test_licence_rules_need_their_order(spark):
    s = licences.SENTENCES
    full = ". ".join(s[i] for i in ("bsd_redistribute", "bsd_source_short", "bsd_binary_short")).title() + "."
    turned = ". ".join(s[i] for i in ("bsd_binary_short", "bsd_source_short", "bsd_redistribute"))
    between = ". ".join([s["mit_grant_short"], "some other words", s["mit_notice"], s["as_is"]])
    rows = [(1, full), (2, turned), (3, between), (4, "Released under the MIT License.\n// SPDX-License-Identifier: Apache-2.0"),
            (5, None), (6, ""), (7, "all rights reserved"), (7, "all rights reserved"), (None, "ALL RIGHTS RESERVED!"), (8, "x " * 20_000),
            (9, "/* SPDX-License-Identifier: GPL-3.0-or-later */"), (10, "long line of prose without any stop at its end, so it may go on\nAll rights reserved."),
            (11, "the license of software permits"), (12, "SPDX-License-Identifier: MIT and more")]
    got = sorted(((r.doc_id, r.licences, r.n_sentences) for r in licences.licences(docs(spark, rows)).collect()), key=str)
    assert got == sorted([(1, "BSD-2-Clause", 3), (2, "", 3), (3, "MIT", 3), (4, "MIT Apache-2.0", 2), (7, "Proprietary", 1),
                          (7, "Proprietary", 1), (None, "Proprietary", 1), (9, "GPL-3.0", 1), (10, "Proprietary", 1)], key=str)
    assert licences.licences(empty(spark)).count() == 0


def test_every_known_sentence_passes_the_first_look(spark):
    said = list(licences.SENTENCES.values())
    table = spark.createDataFrame([(x.upper(),) for x in said], "t string")
    assert table.where(licences.may_hold_sentence(F.col("t"), licences.SENTENCES)).count() == len(said)
    assert all(licences.normal_form(x) == x for x in said) and len(set(said)) == len(said)
    assert {name for r in licences.RULES for name in r.sentences} <= set(licences.SENTENCES)


# ---- decontamination -------------------------------------------------------------


def substring_distance(pattern, text):
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j - 1] + (p != t), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def edited(text, edits, rng):
    out = list(text)
    for _ in range(edits):
        at = rng.randrange(len(out))
        kind = rng.randrange(3)
        if kind == 0:
            out[at] = rng.choice("abcdefgh")
        elif kind == 1:
            out.insert(at, rng.choice("abcdefgh"))
        else:
            del out[at]
    return "".join(out)


def letters(rng, n):
    return "".join(rng.choice("abcdefgh ") for _ in range(n)).strip() or "a"


@pytest.mark.parametrize("seed", range(2))
def test_passages_within_the_edit_budget_are_found(spark, seed):
    rng = random.Random(seed)
    items = [(i, decontaminate.normal_form(letters(rng, rng.randrange(60, 200)))) for i in range(12)]
    items += [(50, "short"), (51, None), (52, ""), (0, items[0][1]), (53, "a b"), (54, "e"), (55, "A b"), (56, "...")]
    rows = [(i, None if i == 3 else "") for i in range(5)]
    for i in range(60):
        item = items[i % 12][1]
        planted = edited(item, rng.randrange(0, len(item) // 8), rng)
        rows.append((100 + i, f"{letters(rng, rng.randrange(0, 200))} {planted} {letters(rng, rng.randrange(0, 200))}".upper()))
    rows.append((100, rows[5][1]))
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.contaminated(docs(spark, rows), bench, index_chars=600).collect()
    want = set()
    for doc_id, text in rows:
        body = decontaminate.normal_form(text or "")
        for item_id, raw in items:
            item = decontaminate.normal_form(raw or "")
            if item and len(item) < decontaminate.Q and f" {item} " in f" {body} ":
                want.add((doc_id, item_id, 0))
            if item and len(item) >= decontaminate.Q:
                edits = substring_distance(item, body)
                if edits <= decontaminate.edit_budget(len(item), decontaminate.Q, decontaminate.EDIT_RATE):
                    want.add((doc_id, item_id, edits))
    assert {(r.doc_id, r.item_id, r.edits) for r in found} == want and len(want) > 20


def test_spans_point_at_the_passage(spark):
    item = "Alpha, beta gamma: delta epsilon zeta eta theta iota."
    text = "Before it -- " + item + " And after."
    row = decontaminate.contaminated(
        docs(spark, [(1, text)]), spark.createDataFrame([(9, item)], "item_id long, text string")
    ).first()
    assert text[row.span_start : row.span_end] == item[:-1] and row.edits == 0
    # Letters that grow in lower case stand before, inside and after.
    grown = "\u0130\u0130\u0130 x " + item.replace("gamma", "gamm\u0130") + " \u0130nd 42 so"
    bench = spark.createDataFrame([(9, item.replace("gamma", "gamm\u0130")), (8, "42")], "item_id long, text string")
    rows = {r.item_id: r for r in decontaminate.contaminated(docs(spark, [(1, grown)]), bench).collect()}
    assert grown[rows[9].span_start : rows[9].span_end] == item.replace("gamma", "gamm\u0130")[:-1]
    assert grown[rows[8].span_start : rows[8].span_end] == "42"
    assert decontaminate.contaminated(docs(spark, [(1, grown)]), bench, short_items=False).count() == 1
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contaminated(docs(spark, [(1, text)]), none).count() == 0
    assert decontaminate.contaminated(empty(spark), none).count() == 0


# ---- tokens ----------------------------------------------------------------------


@pytest.fixture(scope="module")
def tokenizer():
    return pytest.importorskip("tokenizers").Tokenizer.from_file(TOKENIZER)


ODD_TEXTS = [
    (10, "It's <|endoftext|> ok\x1cyes\x85no x y  z"),
    (11, "état É ΟΔΟΣ ΟΔΟΣ. İstanbul ﬁn ½ 日本語テキスト"),
    (-3, "first"),
    (12, "a" * 5_000),
    (13, "Word, word. WORD!! (word) word-word- a1. x\" --- ... don't. <|endoftext|>. é, É; e\u0301. naïve: ;*&%$#)-. _._"),
]


def test_token_files_round_trip(spark, tokenizer, tmp_path):
    rows = ODD_ROWS + ODD_TEXTS + [(9, words(i, 3)) for i in range(30)]
    path = str(tmp_path / "t")
    tokens.write_tokens(docs(spark, rows), path, TOKENIZER)
    back = sorted(tokens.read_tokens(spark, path).collect(), key=lambda r: r.start)
    encode = lambda t: [*tokenizer.encode(t or "", add_special_tokens=False).ids, tokens.END_ID]
    assert [r.doc_id for r in back] == sorted([i for i, _ in rows], key=lambda i: (i is not None, i or 0))
    assert sorted((str(r.doc_id), r.ids) for r in back) == sorted((str(i), encode(t)) for i, t in rows)
    at = 0
    for r in back:
        assert (r.start, r.n_tokens) == (at, len(r.ids))
        at += r.n_tokens
    sums = {(r.start, r.ids_crc32) for r in tokens.id_checksums(tokens.read_tokens(spark, path)).collect()}
    assert sums == {(r.start, zlib.crc32(np.array(r.ids, "<u4").tobytes())) for r in back}


@pytest.mark.parametrize("file,by_word", [("word_bpe_49k.json", True), ("byte_bpe_50k.json", False)])
def test_ids_of_odd_texts_are_the_librarys(file, by_word):
    import pyarrow as pa
    from tokenizers import Tokenizer

    path = public_tokenizers.path(file)
    library, encoder = Tokenizer.from_file(path), tokens.Encoder(path)
    assert encoder.by_word == by_word
    symbols = ("a B z \u0130 \u0131 \u00df \u00e9 \u00c9 e\u0301 \u0301 \u0307 \ufb01 \u039f\u03a3 \u65e5 \u00bd 1 23 's 'S ' \u2019 . , ! ? * - \" ) ( <| |> "
               "<|endoftext|> <|ENDOFTEXT|> _ \U0001f600 \u212a \u00c5 \u01c4 \u01c5 \u00aa \u00ba \u0149 \u1e9e \u017f ........").split(" ")
    symbols += [" ", "\t", "\n", "\x1c", "\x85", "\u00a0", "\u2003", "\x0b", "\x00", "\u200d"]
    rng = random.Random(4)
    texts = ["".join(rng.choices(symbols, k=rng.randrange(12))) for _ in range(10_000)]
    texts += [a + b + c for a in symbols for b in symbols for c in (".", "")] + [None, "", "x" * 5_000]
    for at in range(0, len(texts), 500):
        some = texts[at : at + 500]
        raw = pa.array([None if t is None else t.encode() for t in some], pa.binary())
        offsets, ids = encoder.encode(raw, 7)
        want = [[*library.encode(t or "", add_special_tokens=False).ids, 7] for t in some]
        assert [ids[a:b].tolist() for a, b in itertools.pairwise(offsets)] == want
        assert encoder.lengths(raw).tolist() == [len(x) - 1 for x in want]


def test_only_files_of_the_known_kind_are_cut_into_words():
    import json

    with open(TOKENIZER, encoding="utf-8") as file:
        known = json.load(file)
    assert tokens.cuts_at_white_space(known) and not tokens.cuts_at_white_space({})
    for name, value in (("normalizer", None), ("pre_tokenizer", {"type": "Whitespace"}), ("truncation", {"max_length": 5})):
        assert not tokens.cuts_at_white_space(known | {name: value})


def test_token_files_of_another_tokenizer(spark, tmp_path):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    tokens.write_tokens(docs(spark, ODD_ROWS + ODD_TEXTS), str(tmp_path / "t"), path, end_id=50256)
    got = sorted((str(r.doc_id), r.ids) for r in tokens.read_tokens(spark, str(tmp_path / "t")).collect())
    assert got == sorted((str(i), [*library.encode(t or "", add_special_tokens=False).ids, 50256]) for i, t in ODD_ROWS + ODD_TEXTS)


def test_token_files_have_page_indexes_and_small_groups(spark, tmp_path):
    import pyarrow.parquet as pq

    path = str(tmp_path / "t")
    layout = tokens.TokenFileFormat(row_group_bytes=20_000, page_rows=100)
    tokens.write_tokens(docs(spark, [(i, words(i, 60)) for i in range(3000)]), path, TOKENIZER, layout=layout)
    files = [pq.ParquetFile(p) for p in (tmp_path / "t").glob("*.parquet")]
    assert max(f.metadata.num_row_groups for f in files) > 1
    column = files[0].metadata.row_group(0).column(0)
    assert column.has_offset_index and column.has_column_index and column.compression == "ZSTD"
    one = tokens.read_tokens(spark, path).where("doc_id = 1234").first()
    assert one.doc_id == 1234 and one.n_tokens == len(one.ids)


def test_token_files_of_nothing(spark, tmp_path):
    tokens.write_tokens(empty(spark), str(tmp_path / "t"), TOKENIZER)
    assert tokens.read_tokens(spark, str(tmp_path / "t")).count() == 0


def test_length_histogram(spark):
    rng = random.Random(2)
    sizes = [rng.choice((0, 5, 4095, 4096, 4097, 9000, rng.randrange(20_000))) for _ in range(500)]
    frame = spark.createDataFrame([(i, s) for i, s in enumerate(sizes)] + [(None, None)], "doc_id long, n_tokens long")
    histogram = tokens.length_histogram(frame)
    rows = histogram.collect()
    assert sorted(r.length for r in rows) == sorted(set(sizes))
    for r in rows:
        n = np.array(sizes)
        assert (r.docs, r.docs_at_least, r.tokens_at_least) == ((n == r.length).sum(), (n >= r.length).sum(), n[n >= r.length].sum())
        assert (r.docs_up_to, r.tokens_up_to) == ((n <= r.length).sum(), n[n <= r.length].sum())
        assert r.truncated_tokens == np.minimum(n, r.length).sum() and abs(r.quantile - (n <= r.length).mean()) < 1e-12
    for r in tokens.at_limits(histogram, [0, 7, 4096, 10**6]).collect():
        assert r.truncated_tokens == np.minimum(n, r.context_limit).sum() and r.docs_longer == (n > r.context_limit).sum()
    assert tokens.length_histogram(frame.limit(0)).count() == 0


def test_token_lengths(spark, tokenizer):
    got = tokens.token_lengths(docs(spark, ODD_ROWS + ODD_TEXTS), TOKENIZER).collect()
    want = [(i, len(tokenizer.encode(t or "", add_special_tokens=False).ids)) for i, t in ODD_ROWS + ODD_TEXTS]
    assert sorted((tuple(r) for r in got), key=str) == sorted(want, key=str)


# ---- mixing ----------------------------------------------------------------------


def mixing_rows(seed):
    rng = random.Random(seed)
    rows = []
    for i in range(2400):
        source = "hot" if i % 3 == 0 else rng.choice(["a", "b", "é", "😀", None, "z"])
        rows.append((i, words(i, rng.randrange(0, 60)), source))
    return [*rows, (9000, None, "a"), (9001, "", None), (None, "no id here", "b"), (9002, "only one", "tiny"), (9003, "", "empty")]


def mixing_targets(rows, share=1.5):
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    size = {}
    for _, t, s in rows:
        size[s] = size.get(s, 0) + count(t)
    names = sorted(s for s in size if s is not None) + ([None] if None in size else [])
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    target, left, rest = {}, share * sum(size.values()), set(names)
    while rest:
        over = {s for s in rest if left * weight[s] / sum(weight[x] for x in rest) > 2 * size[s]}
        if not over:
            target |= {s: left * weight[s] / sum(weight[x] for x in rest) for s in rest}
            break
        target |= {s: 2.0 * size[s] for s in over}
        left -= sum(target[s] for s in over)
        rest -= over
    return size, target


def mixed_rows(mixed):
    """(source, doc_id, size, source_size, target, copies) of all documents."""
    return [
        (None if r.source_key == "t" else r.source_key[1:], r.doc_id, r.size, r.source_size, r.target, r.copies)
        for r in mixed.counted().collect()
    ]


def test_mix_meets_targets(spark):
    rows = mixing_rows(1)
    frame = docs(spark, rows)
    mixed = mixing.mix(frame, block_rows=16, shards=7)
    got = mixed_rows(mixed)
    size, target = mixing_targets(rows)
    taken = dict.fromkeys(size, 0)
    assert len(got) == len(rows) and sum(1 for r in got if r[1] is None) == 1
    for s, _, words_, source_size, goal, copies in got:
        assert source_size == size[s] and abs(goal - target[s]) < 1e-6 and 0 <= copies <= 2
        taken[s] += words_ * copies
    assert {s: (taken[s], target[s]) for s in size if abs(taken[s] - target[s]) > 30} == {}  # half a small document
    again = mixed_rows(mixing.mix(frame.repartition(7), block_rows=16, shards=7))
    assert sorted(map(str, again)) == sorted(map(str, got))
    assert mixing.mix(empty(spark)).counted().count() == 0

    # Shards hold whole blocks, as many as each other, and no block twice in one copy.
    draws = mixed.draws.collect()
    assert {d.shard for d in draws} == set(range(7)) and len({(d.place, d.copy) for d in draws}) == len(draws)
    by_shard = [sum(d.shard == k for d in draws) for k in range(7)]
    assert max(by_shard) < 1.5 * min(by_shard)
    assert len({d.order for d in draws}) == len(draws)


@pytest.mark.parametrize("share", [0.5, 1.5])
def test_a_very_long_document_does_not_spoil_a_target(spark, share):
    rng = random.Random(8)
    rows = [(i, "w " * rng.randrange(5, 55), "a") for i in range(2500)] + [(9999, "w " * 100_000, "a")]
    rows += [(None, f"n{i} " * rng.randrange(5, 55), "b") for i in range(1500)]  # no id: documents of their own
    rows += [(7, "same " * 20, "c")] * 900 + [(20_000 + i, "w " * 3_000, "d") for i in range(8)]
    size, target = mixing_targets(rows, share)
    taken = dict.fromkeys(size, 0)
    for s, _, words_, _, _, copies in mixed_rows(mixing.mix(docs(spark, rows), block_rows=64, shards=3, share=share)):
        taken[s] += words_ * copies
    for s in "abc":
        assert abs(taken[s] - target[s]) <= max(20, 0.001 * target[s]), (s, taken[s], target[s])
    assert abs(taken["d"] - target["d"]) <= 1_500  # eight long documents: to half of one


def test_targets_of_many_sources(spark):
    rng = random.Random(3)
    sizes = [rng.choice([0, 1, 5, 10_000, rng.randrange(2_000)]) for _ in range(400)]
    keys = sorted(f"s{i:03}" for i in range(400))
    frame = spark.createDataFrame([(k, n, 1) for k, n in zip(keys, sizes)], "source_key string, source_size long, rows long")
    weighted = mixing.with_weights(frame.repartition(3), (3.0, 1.0, 2.0))
    got = {r.source_key: (r.weight, r.target) for r in mixing.with_targets(weighted, 1.5, 2).collect()}
    _, want = mixing_targets([(i, "w " * n, k) for i, (k, n) in enumerate(zip(keys, sizes))])
    assert [got[k][0] for k in keys] == [(3.0, 1.0, 2.0)[i % 3] for i in range(400)]
    assert all(abs(got[k][1] - want[k]) < 1e-6 * max(1, want[k]) for k in keys)


def test_split_quotas_are_exact():
    quotas = np.array([0, 1, 17, 1000, 333])
    totals = mixing.even(int(quotas.sum()), 7)
    shard, source, blocks = mixing.split_quotas(quotas, totals, [1])
    parts = np.zeros((7, 5), np.int64)
    parts[shard, source] = blocks
    assert (parts.sum(axis=0) == quotas).all() and (parts.sum(axis=1) == totals).all() and (blocks > 0).all()
    assert all((a == b).all() for a, b in zip(mixing.split_quotas(quotas, totals, [1]), (shard, source, blocks)))
    huge = np.array([3_000_000_000, 1_000_000_000])
    drawn = mixing.draw(huge, 2_000_000_000, np.random.default_rng(1))
    assert drawn.sum() == 2_000_000_000 and abs(drawn[0] / 1.5e9 - 1) < 0.01
    # Over many seeds a source's share of a shard is its share of all blocks.
    some = [mixing.split_quotas(quotas, totals, [k]) for k in range(200)]
    mean = np.mean([n[(s == 0) & (q == 3)].sum() for s, q, n in some])
    assert abs(mean / (totals[0] * 1000 / 1351) - 1) < 0.03


# ---- helpers ---------------------------------------------------------------------


def test_attach_groups_keeps_every_row(spark):
    rows = [(i, "hot" if i % 3 == 0 else f"k{i % 50}") for i in range(3000)] + [(None, None)]
    groups = [("hot", 1000, "x"), *((f"k{i}", 40, f"v{i}") for i in range(25)), ("unused", 5, "u")]
    got = common.attach_groups(
        spark.createDataFrame(rows, "id long, key string"), spark.createDataFrame(groups, "key string, n long, v string"),
        "key", "n", 3001, "id",
    ).collect()
    value = {g[0]: (g[1], g[2]) for g in groups}
    assert sorted((tuple(r) for r in got), key=str) == sorted(((i, k, *value.get(k, (None, None))) for i, k in rows), key=str)
