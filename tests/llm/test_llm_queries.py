"""The registered queries on the small tables, and the pipeline."""

import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from oracle import difference, duck
from tallyboard.llm import decontaminate, labels, quality, queries, rules, toxicity

SF_DIR = "/root/testdata/sf0.01"
SMALL = "/root/testdata/sf0.001"
ORACLES = queries.all_oracles()
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    assert difference(queries.all_queries()[name](spark, SF_DIR), duck(SF_DIR), ORACLES[name]) is None


def held_out_labels(spark, label):
    table = spark.read.parquet(f"{SF_DIR}/labels.parquet").where(labels.held_out())
    return {r.doc_id: r[label] for r in table.collect()}


def test_quality_on_held_out_documents(spark):
    got = {r.doc_id: r for r in queries.op9_quality_classifier(spark, SF_DIR).collect()}
    truth = held_out_labels(spark, "quality")
    assert len(got) == 1000 and all(0 <= r.score <= 1 for r in got.values())
    right = sum(got[i].predicted == y for i, y in truth.items())
    assert right / len(truth) >= 0.95
    assert sum(got[i].predicted for i, y in truth.items() if y) / sum(truth.values()) >= 0.97


def test_toxicity_on_held_out_documents_of_all_languages(spark):
    large = "/root/testdata/sf0.1"
    got = {r.doc_id: r.predicted for r in queries.op10_toxicity(spark, large).collect()}
    table = spark.read.parquet(f"{large}/labels.parquet").where(labels.held_out() & F.col("toxic").isNotNull())
    lang = spark.read.parquet(f"{large}/documents.parquet").select("doc_id", "lang")
    marks = {}
    for r in table.join(lang, "doc_id").collect():
        marks.setdefault((r.lang, r.toxic), []).append(got[r.doc_id])
    clean = [p for (_, y), some in marks.items() if not y for p in some]
    toxic = [p for (_, y), some in marks.items() if y for p in some]
    assert sum(clean) <= 0.005 * len(clean)
    # About one labelled document in twenty is a single word or line over and over, without any insult.
    assert sum(toxic) >= 0.92 * len(toxic)
    for name in ("en", "de", "fr", "es"):
        assert sum(marks[name, 1]) >= 0.8 * len(marks[name, 1]), name


def test_the_lexicon_counts_as_stated(spark):
    import math

    texts = [("you foul beast and foolish foulard", 1), ("a foul day", 1), ("this foulness", 1), ("so foul indeed", 1), ("the foul end", 1)]
    texts += [(f"plain words number{i} and so on", 0) for i in range(40)] + [("one foul word", 0), ("copied text here", 1)]
    texts += [("copied text here", 1)] * 6
    frame = spark.createDataFrame(texts, "text string, y int")
    words = [(re.findall(r"[^\W\d_]+", t), y) for t, y in texts]
    positive, negative = sum(y for _, y in words), sum(1 - y for _, y in words)
    want = {}
    for stem in {s for ws, _ in words for w in ws for s in toxicity.stems_of(w)}:
        has = lambda ws: any(stem in toxicity.stems_of(w) for w in ws)
        p, n = sum(y for ws, y in words if has(ws)), sum(1 - y for ws, y in words if has(ws))
        before = {b for ws, y in words if y for b, w in zip(["", *ws], ws) if stem in toxicity.stems_of(w)}
        if p < 3:
            continue
        p = min(p, len(before))
        share = positive / (positive + negative)
        sure = 2 * (p * math.log(p / ((p + n) * share)) + (n * math.log(n / ((p + n) * (1 - share))) if n else 0))
        if sure >= toxicity.SURE and p > toxicity.PURE * n:
            want[stem] = (math.log((p + 0.5) / (positive + 1)) - math.log((n + 0.5) / (negative + 1))) / 4
    monkey = toxicity.SURE
    got = toxicity.learn_lexicon(frame)
    assert monkey == toxicity.SURE and got.keys() == want.keys()
    assert all(abs(got[s] - want[s]) < 1e-9 for s in want) and not any("copi" in s for s in got)


def test_models_without_labels_and_odd_rows(spark):
    rows = [(1, None, "en", "s", 0), (2, "", "en", "s", 0), (None, "a b", "en", "s", 3), (3, "word " * 9000, "en", "s", 1),
            (4, "x", None, None, None), (4, "x", None, None, None)]
    documents = spark.createDataFrame(rows, DOCS).withColumn("score", F.lit("mine")).withColumn("s_chars", F.lit(1))
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    some = spark.createDataFrame([(1, 1, 0), (2, 0, None), (2, 1, 1), (4, None, 1), (None, 1, 1), (77, 0, 1)], none.schema)
    for known in (none, some):
        for found in (quality.quality_scores(documents, known), toxicity.toxicity_scores(documents, known)):
            scored = found.collect()
            assert len(scored) == len(rows) and all(0 <= r.score <= 1 for r in scored)
            assert {r.predicted for r in scored if r.doc_id == 4} in ({0}, {1})
    assert {r.score for r in quality.quality_scores(documents, none).collect()} == {0.5}
    assert quality.quality_scores(documents.limit(0), none).count() == 0
    assert toxicity.toxicity_scores(documents.limit(0), none).count() == 0
    model = quality.fit(documents, none)
    assert quality.score(documents, model).columns == [*documents.columns, "quality_score"]


def test_held_out_rows_teach_nothing(spark):
    table = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    import zlib

    ids = [r.doc_id for r in labels.training_ids(table, "quality").collect()]
    assert ids and all(zlib.crc32(str(i).encode()) % 5 for i in ids)
    assert len(labels.training_ids(table, "quality", 10).collect()) == 10


def test_rules_compile_to_the_same_score(spark):
    import numpy as np

    rng = np.random.default_rng(0)
    x = rng.random((800, 3))
    y = ((x[:, 0] > 0.6) & (x[:, 1] < 0.5)).astype(float)
    model = rules.fit_rules(x, y, ("a", "b", "c"))
    assert ((model.score(x) > 0.5) == y).mean() > 0.97 and len(model.rules) < 200
    frame = spark.createDataFrame(x.tolist(), "a double, b double, c double")
    got = [r[0] for r in frame.select(model.column()).collect()]
    assert np.allclose(sorted(got), sorted(model.score(x)))


def test_grammar_scores_clauses():
    reader = toxicity.Reader({"=idiot": 1.0, "lowei": 0.5})
    plain, targeted, negated, reported, threat = range(5)

    def only(text, outcome):
        total = reader.outcomes(text)
        return total[outcome] > 0 and sum(total) == total[outcome]

    assert only("what an idiot.", plain) and only("you are an idiot", targeted) and only("idiot, you", targeted)
    assert only("this is not idiot talk", negated) and only("they wrote such idiot lines", reported)
    assert only("someone said idiot", reported) and only('a "stray idiot" remark', reported)
    assert only("we will kill you", threat) and not reader.outcomes("kill the lights").any()
    assert reader.outcomes("loweischaft und")[plain] == 0.5
    assert reader.outcomes("someone said so. idiot")[plain] == 1.0  # the report ends with its clause
    assert not reader.outcomes("").any()


# ---- the pipeline ----------------------------------------------------------------


def test_pipeline_stages_decide(spark):
    documents = spark.read.parquet(f"{SMALL}/documents.parquet").withColumn("copies", F.lit("mine"))
    quality_docs = corpus_pipeline.keep_quality(spark, documents, SMALL)
    assert quality_docs.columns == documents.columns
    scored = quality.quality_scores(documents, spark.read.parquet(f"{SMALL}/labels.parquet"))
    want = {r.doc_id for r in scored.where("predicted = 1").collect()}
    assert {r.doc_id for r in quality_docs.collect()} == want and len(want) > 100

    again = documents.unionByName(documents.limit(20)).unionByName(
        documents.limit(1).withColumn("doc_id", F.lit(None).cast("long")))
    near = corpus_pipeline.drop_near_duplicates(spark, again, SMALL)
    found = [r.doc_id for r in near.collect()]
    from tallyboard.llm import simhash

    least = {r.doc_id for r in simhash.near_duplicates(documents).where("doc_id = component_id").collect()}
    assert sorted(found) == sorted(least)  # of repeated rows one stays; the row without an id is a copy
    other = documents.unionByName(documents.limit(1).withColumns({"doc_id": F.lit(None).cast("long"), "text": F.lit("a text of its own")}))
    assert [r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, other, SMALL).collect()].count(None) == 1
    shared = documents.withColumn("doc_id", F.lit(1).cast("long"))  # one id for all: each row counts by its text
    assert corpus_pipeline.drop_near_duplicates(spark, shared, SMALL).count() == len(least)

    clean = corpus_pipeline.drop_contaminated(spark, documents, SMALL)
    bench = [decontaminate.normal_form(r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    held = {r.doc_id for r in documents.collect() if any(b in decontaminate.normal_form(r.text or "") for b in bench)}
    bench_table = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    near_passages = {r.doc_id for r in decontaminate.contaminated(documents, bench_table).collect()}
    assert near_passages >= held
    assert {r.doc_id for r in documents.collect()} - {r.doc_id for r in clean.collect()} == near_passages
    unnamed = documents.withColumn("doc_id", F.lit(None).cast("long"))
    assert corpus_pipeline.drop_contaminated(spark, unnamed, SMALL).count() == clean.count()

    mixed = corpus_pipeline.mix_sources(spark, documents, SMALL)
    assert mixed.columns == documents.columns
    total = sum(len(re.findall(r"\S+", r.text or "")) for r in documents.collect())
    assert abs(sum(len(re.findall(r"\S+", r.text or "")) for r in mixed.collect()) / total - 1.5) < 0.02

    rows = corpus_pipeline.write_tokens(spark, mixed, SMALL).collect()
    assert len(rows) == mixed.count() and all(r.n_tokens == len(r.ids) for r in rows)


def test_pipeline_of_odd_and_empty_tables(spark, tmp_path):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "plain words here", "en", "s", 1), (3, "ab " * 20_000, "en", "s", 1)]
    for name, table in (
        ("documents", spark.createDataFrame(rows, DOCS)),
        ("labels", spark.createDataFrame([], "doc_id long, quality int, toxic int")),
        ("benchmark", spark.createDataFrame([(1, None), (2, "")], "item_id long, text string")),
    ):
        table.write.parquet(f"{tmp_path}/odd/{name}.parquet")
        table.limit(0).write.parquet(f"{tmp_path}/none/{name}.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/odd").count() >= 1
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0


def test_pipeline_runs(spark):
    assert [len(stage) for stage in corpus_pipeline.STAGES] == [2] * 5
    out = corpus_pipeline.run(spark, SMALL)
    assert set(out.columns) == {"doc_id", "start", "n_tokens", "ids"} and out.count() > 50
