"""Toxicity: held-out accuracy on the given labels, and its edges."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterlake.llm import toxicity as tox
from meterlake.llm.queries import REGISTRY

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(llm_spark):
    """A third of the toxic labels are noise: texts without any insult."""
    rows = REGISTRY["op2_toxicity"](llm_spark, SF).join(llm_spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("held_out").collect()
    toxic, clean = [r for r in rows if r.toxic], [r for r in rows if not r.toxic]
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert sum(r.predicted for r in toxic) >= 0.55 * len(toxic)
    assert sum(1 - r.predicted for r in clean) >= 0.98 * len(clean)


def test_features_see_disguise_and_nearness():
    at = dict(zip(tox.FEATURES, tox.features("You ST4PID!!! id!ot, s t", {"st4p": 2.0})))
    assert at["disguised"] >= 1 and at["near_second"] > 0 and at["exclaim_rate"] > 0 and at["shouted_rate"] > 0
    assert tox.features(None, {}) == tox.features("", {})
    assert len(tox.features("x " * 50000, {"x": 1.0})) == len(tox.FEATURES)


def test_edge_rows(llm_spark, edge):
    none = llm_spark.createDataFrame([], "doc_id long, toxic int")
    model = tox.fit_toxicity(edge, none)
    assert {r.score for r in model.score(edge).collect()} == {0.0}
    one = llm_spark.createDataFrame([(1, 1), (1, 1), (3, 0), (2, None), (None, 1), (99, 1)], "doc_id long, toxic int")
    assert {r.score for r in tox.fit_toxicity(edge, one).score(edge).collect()} == {2 / 3}


def test_fitted_model_on_edge_rows(llm_spark, edge):
    docs = llm_spark.createDataFrame([(i, f"you are an idiot number {i}" if i % 3 == 0 else f"kind words number {i}") for i in range(300)], "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 3 == 0).cast("int").alias("toxic"))
    model = tox.fit_toxicity(docs, labels, rounds=3)
    assert "idiot" in model.learned
    got = model.score(edge)
    assert set(got.columns) == set(edge.columns) and got.count() == edge.count()
    assert all(0 <= r.score <= 1 for r in got.collect())
    scores = {r.doc_id: r.score for r in model.score(docs).collect()}
    assert min(scores[i] for i in scores if i % 3 == 0) > max(scores[i] for i in scores if i % 3)
    assert model.score(edge.where("false")).count() == 0


def test_rare_labels_are_learned_from_all_rows_and_calibrated_apart(llm_spark):
    """One text in 40 is toxic, or looks so, by a word of its own group of 12; the sample
    holds a quarter of the clean rows, and scores still are shares of all."""
    docs = llm_spark.range(12_000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 40 == 0, F.concat(F.lit("what a blurb"), F.chr((97 + F.floor(F.col("id") / 40) % 25).cast("long")), F.lit(" day"))).otherwise(F.concat(F.lit("what a fine day "), F.col("id") % 50)).alias("text"),
    )
    # half of the labels of such texts are noise
    labels = docs.select("doc_id", ((F.col("doc_id") % 40 == 0) & (F.xxhash64("doc_id") % 2 == 0)).cast("int").alias("toxic"))
    model = tox.fit_toxicity(docs, labels.where("toxic = 0 or doc_id % 40 = 0"), max_rows=6000, rounds=5, min_texts=2)
    assert len({w for w in model.learned if w.startswith("blurb")}) >= 20
    got = model.score(docs).groupBy((F.col("doc_id") % 40 == 0).alias("odd")).agg(F.avg("score").alias("score")).collect()
    score = {r.odd: r.score for r in got}
    assert 0.3 < score[True] < 0.7 and score[False] < 0.02


def test_lexicons_of_folds(llm_spark):
    rows = [(i, "awful thing" if i % 2 else "good thing", float(i % 2)) for i in range(200)] + [(5000 + i, "good thing", 0.0) for i in range(4000)] + [(1000 + i, "onlyhere", 1.0) for i in range(20)]
    labelled = llm_spark.createDataFrame(rows, "id long, text string, y double").withColumn("f", F.when(F.col("id").between(1000, 4999), 3).otherwise(F.col("id") % 5).cast("int"))
    counts = tox.count_words(labelled, "text", "y", "f")
    assert set(tox.learn_lexicon(counts)) == {"awful", "onlyhere"} and set(tox.learn_lexicon(counts, without=3)) == {"awful"}
    assert len(tox.learn_lexicon(counts, max_words=1)) == 1 and set(tox.learn_lexicon(counts, min_texts=50)) == {"awful"}


def test_fits_are_repeatable(llm_spark):
    """Other partitions and another run give the same model and scores."""
    docs = llm_spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    labels = llm_spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    runs = []
    for n in (2, 7, 7):
        model = tox.fit_toxicity(docs.repartition(n), labels.repartition(n), rounds=8)
        runs.append({r.doc_id: r.score for r in model.score(docs).collect()})
    assert runs[0] == runs[1] == runs[2] and len(set(runs[0].values())) > 2


def test_trees_keep_to_two_tasks_where_rows_are_dealt_widely(llm_spark, monkeypatch):
    """Hundreds of passes over a bounded sample do not start a task for each
    of a session's many partitions, and the model is the same."""
    docs = llm_spark.createDataFrame([(i, f"you are an idiot number {i}" if i % 3 == 0 else f"kind words number {i}") for i in range(600)], "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 3 == 0).cast("int").alias("toxic"))
    parts, frame = [], type(docs)
    fit, deal = tox.GBTClassifier.fit, frame.repartition
    monkeypatch.setattr(tox.GBTClassifier, "fit", lambda self, df: parts.append(df.rdd.getNumPartitions()) or fit(self, df))
    trees = [tox.fit_toxicity(docs, labels, rounds=3).trees.toDebugString]
    monkeypatch.setattr(frame, "repartition", lambda self, n, *cols: deal(self, max(n, 40) if cols and isinstance(n, int) else n, *cols))
    trees.append(tox.fit_toxicity(docs, labels, rounds=3).trees.toDebugString)
    plain = [t.split("\n", 1)[1] for t in trees]  # without the model's name
    assert parts == [2, 2] and plain[0] == plain[1]


def test_words_are_counted_as_in_all_texts_and_texts_do_not_travel(llm_spark, capsys):
    texts = llm_spark.range(4000).select(
        F.col("id").alias("__id"),
        F.when(F.col("id") % 9 == 0, "").otherwise(F.concat(F.lit(" (Some) text\n"), F.col("id") % 50, F.lit(" w"), F.col("id") % 97, F.lit("! clean"), F.col("id"), F.lit(" İ text"))).alias("__text"),
    )
    taught = texts.where("__id % 3 = 0").select("__id", (F.col("__id") % 2 == 0).cast("double").alias("__label"))
    taught = taught.union(taught.where("__id < 90")).union(taught.where("__id = 33").withColumn("__label", F.lit(0.0)))
    whole = tox.count_words(texts.join(taught, "__id").withColumn("f", tox.fold("__id")), "__text", "__label", "f")
    enough = " + ".join(f"t{f}" for f in range(tox.FOLDS)) + " >= 3 or word = ''"
    got = tox.count_toxic_words(texts, taught, 3)
    want = sorted(map(tuple, whole.where(enough).collect()))
    assert sorted(map(tuple, got.collect())) == want and len(want) > 50
    capsys.readouterr()
    got.explain("formatted")
    plan = capsys.readouterr().out
    exchanges = [p for p in plan.split("\n\n") if "Exchange" in p.split("\n")[0]]
    assert exchanges and not any("__text" in e for e in exchanges)


def test_texts_with_a_settled_label_stay_where_they_are(llm_spark):
    """Labelled twice, both ways, with another number, or in one slot with a
    text of another label: the join tells. All others are counted in place,
    and the counts are the same."""
    texts = llm_spark.range(3000).select(F.col("id").alias("__id"), F.concat(F.lit("Some text w"), F.col("id") % 97, F.lit("! clean"), F.col("id")).alias("__text"))
    texts = texts.union(texts.where("__id in (3, 6)")).union(texts.where("__id < 3").withColumn("__id", F.lit(None).cast("long")))
    taught = texts.where("__id % 3 = 0").select("__id", (F.col("__id") % 2 == 0).cast("double").alias("__label")).distinct()
    odd = [(30, 0.0), (33, 1.0), (36, 1.0), (900_000, 1.0)]
    taught = taught.union(llm_spark.createDataFrame(odd, taught.schema)).union(llm_spark.createDataFrame([(1, 0.5)], taught.schema))
    own = texts.where("__id % 3 = 0 or __id = 1")
    here, others = tox.by_label(own, taught)
    label = {r["__id"]: r["__label"] for r in here.collect()}
    kept, sent = set(label), {r["__id"] for r in others.collect()}
    assert {1, 30, 33, 36} <= sent and len(sent) < 40 and not kept & sent and len(kept | sent) == 1001
    assert all(label[i] == (i % 2 == 0) for i in kept) and here.where("__id in (3, 6)").count() == 4

    whole = tox.count_words(own.join(taught, "__id").withColumn("f", tox.fold("__id")), "__text", "__label", "f")
    enough = " + ".join(f"t{f}" for f in range(tox.FOLDS)) + " >= 3 or word = ''"
    want = sorted(map(tuple, whole.where(enough).collect()))
    for bits, some in ((tox.BITS, own), (tox.BITS, texts.where("__id is not null")), (4096, own), (64, own)):
        assert sorted(map(tuple, tox.count_toxic_words(some, taught, 3, bits).collect())) == want and len(want) > 50
    assert 40 < tox.by_label(own, taught, 4096)[1].count() < 900
