"""The dictionary and the cascade."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyboard.operators import classify as cl
from tallyboard.operators import lookup
from tallyboard.operators import patterns as pt
from tallyboard.schemas import CATEGORY_PATTERNS, ZERO_ID

STRATEGIES = (cl.EXPRESSION, cl.MATCHER, cl.JOIN)


def documents(spark, *rows):
    """(category, app patterns, url patterns) in document order."""
    data = [(f"{i:024x}", c, apps, urls, i) for i, (c, apps, urls) in enumerate(rows, 1)]
    return spark.createDataFrame(data, CATEGORY_PATTERNS)


def messages(spark, *rows):
    data = [(i, *row) for i, row in enumerate(rows)]
    return spark.createDataFrame(data, "seq bigint, app string, title string, url string")


def url_categories(spark, rules, urls, strategy):
    docs = documents(spark, *[(category, [], [pattern]) for pattern, category in rules])
    found = cl.classify_url(messages(spark, *[("", "", u) for u in urls]), docs, strategy)
    return [r.url_category for r in found.orderBy("seq").collect()]


def expected(rules, url):
    """Straight from the rule: earliest end, then longest; the last rule of a pattern counts."""
    last = {pattern: category for pattern, category in rules}
    hits = []
    for pattern, category in last.items():
        at = url.find(pattern)
        if pattern and category and at >= 0:
            hits.append((at + len(pattern), -len(pattern), category))
    return min(hits)[2] if hits else None


@pytest.mark.parametrize("strategy", STRATEGIES)
@pytest.mark.parametrize(
    "rules,urls",
    [
        ([("abc", "A"), ("bc", "B"), ("abcd", "C")], {"xabcd": "A", "BC.org": None, "": None, "한글bc": "B"}),
        ([("x.com", "X"), ("글", "K"), ("😀b", "E")], {"netflix.com": "X", "한a😀b글": "E", "a글": "K"}),
        ([("bc", "B"), ("bc", "Z"), ("de", "D"), ("de", "")], {"abcd": "Z", "de": None}),
        ([("", "ANY"), ("bc", "B"), ("a.*c", "R"), ("longer-than-url", "L")], {"zz": None, "abbd": None, "xa.*c": "R"}),
        ([], {"abc": None}),
    ],
)
def test_url_rule(spark, strategy, rules, urls):
    assert dict(zip(urls, url_categories(spark, rules, list(urls), strategy))) == urls


_text = st.text(alphabet="ab.é😀", min_size=1, max_size=6)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    rules=st.lists(st.tuples(_text, st.sampled_from(["A", "B", "C", ""])), min_size=1, max_size=14),
    urls=st.lists(st.text(alphabet="ab.é😀", max_size=14), min_size=20, max_size=60),
)
def test_url_rule_property(spark, rules, urls):
    wanted = [expected(rules, url) for url in urls]
    for strategy in STRATEGIES:
        assert url_categories(spark, rules, urls, strategy) == wanted, strategy


def test_url_rule_large_dictionary(spark):
    rules = [(f"host{i}.", f"C{i % 19}") for i in range(700)] + [(f"t{i}.example/", "S") for i in range(700)]
    urls = [f"https://host{i}.example/{i}?host{i + 1}." for i in range(0, 900, 3)]
    wanted = [expected(rules, url) for url in urls]
    assert url_categories(spark, rules, urls, cl.MATCHER) == wanted
    assert url_categories(spark, rules, urls, cl.JOIN) == wanted


def test_strategy_follows_the_measured_size():
    assert cl.url_strategy(3) == cl.EXPRESSION
    assert cl.url_strategy(cl.EXPRESSION_PATTERNS + 1) == cl.JOIN
    assert cl.url_strategy(None) == cl.JOIN


def test_dictionary_beyond_the_bound_is_joined(spark, monkeypatch):
    docs = documents(spark, ("Dev", ["code"], ["git."]), ("News", ["reader"], ["news", "git.io"]))
    msgs = messages(spark, ("Code", "", ""), ("x", "", "git.io"), ("x", "", "my news"), ("x", "", ""), ("reader", "", "git."))
    small = cl.classify(msgs, docs).orderBy("seq").collect()
    monkeypatch.setattr(cl, "DICTIONARY_BOUND", lookup.BroadcastBound(rows=1, text_bytes=10))
    large = cl.classify(msgs, docs).orderBy("seq").collect()
    assert small == large
    assert [r.category for r in large] == ["Dev", "Dev", "News", "Uncategorized", "News"]


def app_categories(spark, docs, apps):
    found = cl.classify_app(messages(spark, *[(a, "", "") for a in apps]), docs)
    return [r.app_category for r in found.orderBy("seq").collect()]


def test_app_match_is_whole_and_lower_case(spark):
    docs = documents(spark, ("Dev", ["code", ""], []), ("Design", ["Figma"], []))
    assert app_categories(spark, docs, ["Code", "Code - Insiders", "Figma", "figma", "cod", ""]) == [
        "Dev",
        None,
        None,
        None,
        None,
        "Dev",
    ]


def test_last_app_pattern_wins(spark):
    docs = documents(spark, ("A", ["x", "y"], []), ("B", ["x"], []), ("", ["y"], []))
    assert app_categories(spark, docs, ["x", "y"]) == ["B", None]


def test_cascade_order_and_flags(spark):
    docs = documents(spark, ("Browser", ["chrome"], []), ("Shop", [], ["shop."]))
    labels = spark.createDataFrame(
        [
            ("app: safari, title: T, url: none", " Game\n"),
            ("app: safari, title: bad, url: none", "Music"),
            ("app: safari, title: wait, url: none", None),
            ("app: safari, title: shop, url: shop.", "Game"),
        ],
        "query string, label string",
    )
    msgs = messages(
        spark,
        ("Chrome", "t", "shop.com"),  # an app hit hides the URL
        ("Safari", "shop", "shop."),  # a URL hit hides the label
        ("Safari", "T", "none"),
        ("Safari", "bad", "none"),
        ("Safari", "wait", "none"),
        ("Safari", "t", "none"),  # titles keep their case
    )
    got = cl.classify(msgs, docs, labels).orderBy("seq").collect()
    assert [(r.category, r.method, r.is_llm) for r in got] == [
        ("Browser", "app", False),
        ("Shop", "url", False),
        ("Game", "label", True),
        ("Uncategorized", "label", True),
        ("Uncategorized", "none", True),
        ("Uncategorized", "none", True),
    ]
    open_keys = {r.query for r in cl.unresolved_keys(cl.classify(msgs, docs, labels)).collect()}
    assert open_keys == {"app: safari, title: wait, url: none", "app: safari, title: t, url: none"}


def test_dictionary_categories_need_not_be_known_labels(spark):
    docs = documents(spark, ("My Own", ["x"], []))
    assert cl.classify(messages(spark, ("X", "", "")), docs).first().category == "My Own"


def test_repeated_label_rows_do_not_repeat_messages(spark):
    labels = spark.createDataFrame([("app: a, title: , url: ", "Game")] * 3, "query string, label string")
    got = cl.classify(messages(spark, ("a", "", ""), ("a", "", "")), documents(spark), labels).collect()
    assert [r.category for r in got] == ["Game", "Game"]


def test_later_answers_replace_earlier_ones(spark):
    rows = [("q", "Productivity", 0), ("q", "Finance", 1), ("q", None, 2), ("r", "AFK", 0)]
    labels = spark.createDataFrame(rows, "query string, label string, batch_id bigint")
    assert sorted(map(tuple, cl.settled_labels(labels).collect())) == [("q", "Finance"), ("r", "AFK")]


def test_external_labeller_runs_once_per_key(spark):
    from tallyboard.operators import labelling as lab
    from tallyboard.schemas import LABEL_ATTEMPTS

    msgs = messages(spark, *[("A", "t", "u")] * 5, ("b", "", ""))
    docs, none = documents(spark), spark.createDataFrame([], LABEL_ATTEMPTS)
    open_keys = cl.unresolved_keys(cl.classify(msgs, docs))
    made = lab.attempt_labels(open_keys, none, lambda prompts: [" Game " if "Title" in p else None for p in prompts]).cache()
    assert sorted((r.tries, r.outcome) for r in made.collect()) == [(1, lab.ANSWERED), (1, lab.SILENT)]
    assert [r.category for r in cl.classify(msgs, docs, lab.answers(made)).orderBy("seq").collect()][:5] == ["Game"] * 5


@pytest.mark.parametrize("lot", [1, 7, 50])
def test_a_failing_labeller_loses_only_its_own_keys(spark, lot):
    from tallyboard.operators import labelling as lab
    from tallyboard.schemas import LABEL_ATTEMPTS

    keys = spark.createDataFrame([(f"q{i}", f"p{i}") for i in range(60)] + [("q1", "p1")], "query string, prompt string")

    def labeller(prompts):
        if any(p.endswith("3") for p in prompts):
            raise RuntimeError("no connection")
        return ["Game"] * (len(prompts) + ("p5" in prompts))  # one answer too many

    ledger = spark.createDataFrame([], LABEL_ATTEMPTS)
    for tries in range(1, 5):
        more = lab.attempt_labels(keys, ledger, labeller, most_tries=3, lot=lot).collect()
        ledger = spark.createDataFrame(ledger.collect() + more, LABEL_ATTEMPTS)
        failing = {f"q{i}" for i in range(60) if i % 10 == 3 or i == 5}
        assert {r.query for r in more} == ({f"q{i}" for i in range(60)} if tries == 1 else failing if tries <= 3 else set())
        assert all((r.outcome == lab.FAILED) == (r.query in failing) and r.tries == tries for r in more)
    assert lab.last_attempts(ledger).count() == 60 and lab.to_ask(keys, ledger, most_tries=3).count() == 0


def test_patterns_are_anchored_at_what_urls_have_least(spark):
    urls = [f"http://www.site{i}.com/a{i % 7}" for i in range(400)]
    rules = [("http://www.site7.", "A"), ("www.site11.com/", "B"), (".com/a3", "C"), ("http", "D")]
    frame = spark.createDataFrame(rules, "pattern string, category string")
    table = spark.createDataFrame([(u,) for u in urls], "url string")
    lengths = cl.gram_lengths(frame)
    assert lengths == [4] == cl.gram_lengths(frame, frame.collect())
    anchors = {r.pattern: r.gram for r in cl.anchors_of(frame, table, lengths).collect()}
    for pattern, _ in rules[:3]:  # no piece that nearly all URLs have
        assert sum(anchors[pattern] in u for u in urls) < 0.3 * len(urls)
        assert min(sum(pattern[k : k + 4] in u for u in urls) for k in range(len(pattern) - 3)) == sum(anchors[pattern] in u for u in urls)
    got = {r.url: r.url_category for r in cl.url_categories_by_join(table, frame).collect()}
    assert got == {u: expected(rules, u) for u in urls}


def test_category_ids(spark):
    docs = documents(spark, ("A", [], []), ("B", [], []), ("A", [], []))
    df = spark.createDataFrame([("A",), ("B",), ("Nope",)], "category string")
    got = {r.category: r.category_id for r in cl.attach_category_id(df, docs).collect()}
    assert got == {"A": f"{3:024x}", "B": f"{2:024x}", "Nope": ZERO_ID}
    assert [r.category for r in pt.list_categories(docs).collect()] == ["A", "B", "A"]
    assert pt.id_to_category(docs).count() == 3


def test_dictionary_rows_and_unmatchable(spark):
    docs = documents(spark, ("A", ["x", "Y"], ["u", ""]), ("B", [], None))
    rows = pt.pattern_dictionary(docs)
    assert sorted((r.kind, r.pos, r.pattern) for r in rows.collect()) == [
        ("app", 0, "x"),
        ("app", 1, "Y"),
        ("url", 0, "u"),
        ("url", 1, ""),
    ]
    assert sorted((r.pattern, r.reason) for r in pt.unmatchable_patterns(rows).collect()) == [
        ("", "empty url pattern"),
        ("Y", "upper case app"),
    ]


def test_add_patterns(spark):
    docs = documents(spark, ("A", ["x", "x"], None), ("B", ["z"], ["u"]))
    first, second = f"{1:024x}", f"{2:024x}"
    new = spark.createDataFrame(
        [(first, "app", "y", 3), (first, "app", "x", 1), (first, "app", "w", 2), (first, "app", "w", 9), (first, "url", "h", 1)],
        "category_id string, kind string, pattern string, seq bigint",
    )
    got = {r.category_id: r for r in pt.add_patterns(docs, new).collect()}
    assert got[first].app_patterns == ["x", "x", "w", "y"] and got[first].domain_patterns == ["h"]
    assert got[second].app_patterns == ["z"] and got[second].domain_patterns == ["u"]


def test_classification_adds_no_shuffle(spark, tmp_path):
    """Plan check: with a small dictionary and label table the messages are not exchanged."""
    msgs = messages(spark, ("a", "b", "c"))
    msgs.write.parquet(str(tmp_path / "m"))
    stored = spark.read.parquet(str(tmp_path / "m"))
    docs = documents(spark, ("A", ["x"], [f"p{i}" for i in range(cl.EXPRESSION_PATTERNS)]))
    plan = cl.classify(stored, docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_join_strategy_has_no_cross_join(spark):
    docs = documents(spark, ("A", [], [f"pattern{i}" for i in range(30)]))
    plan = cl.classify_url(messages(spark, ("a", "b", "c")), docs, cl.JOIN)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_lookup_with_hot_and_missing_keys(spark, monkeypatch):
    """A key with a third of the rows, and rows without a key, on the path beyond the bound."""
    fact = spark.range(9000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("k"), "id")).alias("k")
    )
    keyed = fact.where("k is not null").select("k").distinct().withColumn("v", F.concat(F.lit("v-"), "k"))
    keyed = keyed.where("k <> 'k1'")
    tiny = lookup.BroadcastBound(rows=10, text_bytes=100)
    got = lookup.attach(fact, keyed, ["k"], tiny)
    want = lookup.attach(fact, keyed, ["k"])
    assert got.columns == want.select(*got.columns).columns
    assert sorted(map(tuple, got.select("id", "k", "v").fillna("?").collect())) == sorted(
        map(tuple, want.select("id", "k", "v").fillna("?").collect())
    )
    assert got.where("k = 'hot' and v = 'v-hot'").count() == 3000


def test_size_checks(spark):
    df = spark.createDataFrame([("a" * 50,), ("b",)], "s string")
    assert lookup.within_bound(df, lookup.BroadcastBound(2, 51))
    assert not lookup.within_bound(df, lookup.BroadcastBound(2, 50))
    assert not lookup.within_bound(df, lookup.BroadcastBound(1, 100))
    assert lookup.bounded_rows(df, lookup.BroadcastBound(1, 100)) is None
    assert lookup.bounded_rows(df, lookup.BroadcastBound(2, 50)) is None
    assert len(lookup.bounded_rows(df, lookup.BroadcastBound(2, 51))) == 2
