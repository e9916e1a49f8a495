"""Toxicity scores: gradient-boosted trees over dense features, calibrated.

Every text becomes a row of densities: words of a fixed lexicon of insults
and of a lexicon learned from labelled texts, how near they stand to a second
person, capitals, punctuation, and disguised spellings. The lexicon is counted
over all labelled texts; while fitting, a text meets the lexicon of the
``FOLDS - 1`` folds it is not in. Spark's boosted trees are fitted on four
fifths of a bounded sample of the labelled rows (of each label at most half of
``max_rows``, the ones with the least hash of their key), the isotonic
calibration on the fifth that the trees do not see, every row weighing as many
labelled rows as it stands for. Every text of the input is then scored whole,
without a shuffle.

Defined cases: null and empty texts get the score of a text without words;
labelled keys without a text, and null labels, teach nothing; a key labelled
twice counts twice; without two keys of each label every score is the mean
label (0 where there is none).
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.llm.near_dedup import BITS, key_filter, slot
from meterlake.llm.words import add_columns

# Common insults.
INSULTS = frozenset(
    "idiot idiots idiotic moron morons moronic stupid dumb dumbass fool loser losers pathetic worthless disgusting trash garbage scum filth clown "
    "vermin imbecile cretin jerk bastard bitch asshole crap shit bullshit fuck fucking fucker damn hate ugly retard retarded freak creep pig "
    "nazi racist whore slut liar coward traitor parasite subhuman hurensohn arschloch scheisse scheiße dumm dummkopf idiota imbécile connard "
    "salope merde crétin estúpido pendejo puta mierda cabrón tonto".split()
)
# Second person words of the corpus's languages.
SECOND = frozenset("you your yours yourself u ur ya du dich dir dein deine ihr euch sie tu te toi ton ta tes vous votre vos tú ti usted ustedes vosotros".split())
_FOLD = str.maketrans("013457@$!|", "oieastasil")
_EDGE = ".,;:!?\"'()[]{}<>*#%&$|-–—_…«»“”‘’"
_UPPER = bytes(range(65, 91))
_MARKS = bytes(c for c in range(33, 127) if not chr(c).isalnum())
_INNER = re.compile(r"[^\w]+|_+")
_RUNS = re.compile(r"(.)\1{2,}")
NEAR = 5
FEATURES = (
    "log_words", "insults", "insult_rate", "kinds_of_insult", "learned", "learned_rate", "learned_weight", "learned_most", "second_rate", "near_second",
    "capital_rate", "shouted_rate", "mark_rate", "exclaim_rate", "question_rate", "odd_rate", "disguised", "disguised_rate", "distinct_rate", "word_length",
)


def features(text: str | None, learned: dict[str, float]) -> list[float]:
    """The dense features of one text, in the order of ``FEATURES``."""
    text = text or ""
    raw = text.encode("utf-8", "replace")
    size = max(len(raw), 1)
    spaced = text.split()
    words = [w.strip(_EDGE) for w in text.lower().split()]
    n = max(len(words), 1)
    insults = [i for i, w in enumerate(words) if w in INSULTS]
    taught = [i for i, w in enumerate(words) if w in learned]
    odd = [(i, w) for i, w in enumerate(words) if w and not w.isalpha()]
    hidden = []
    for i, w in odd:
        plain = _RUNS.sub(r"\1", _INNER.sub("", w.translate(_FOLD)))
        if w not in INSULTS and w not in learned and (plain in INSULTS or plain in learned):
            hidden.append(i)
    marked = sorted({*insults, *taught, *hidden})
    second = [i for i, w in enumerate(words) if w in SECOND]
    near = 0
    if second and marked:
        at = np.searchsorted(second, marked)
        left = np.abs(np.array(marked) - np.array(second)[np.maximum(at - 1, 0)])
        right = np.abs(np.array(second)[np.minimum(at, len(second) - 1)] - np.array(marked))
        near = int(np.count_nonzero(np.minimum(left, right) <= NEAR))
    weights = [learned[words[i]] for i in taught]
    marks = len(raw) - len(raw.translate(None, _MARKS))
    return [
        float(np.log1p(len(words))), float(len(insults)), len(insults) / n, float(len({words[i] for i in insults})), float(len(taught)), len(taught) / n,
        sum(weights) / n, max(weights, default=0.0), len(second) / n, near / max(len(marked), 1),
        (len(raw) - len(raw.translate(None, _UPPER))) / size, sum(w.isupper() and len(w) > 1 for w in spaced) / n, marks / size, text.count("!") / size, text.count("?") / size,
        len(odd) / n, float(len(hidden)), len(hidden) / n, len(set(words)) / n, sum(map(len, words)) / n,
    ]


def with_features(docs: DataFrame, text_col: str, learned: dict[str, float] | list[dict[str, float]]) -> DataFrame:
    """``docs`` with an array column ``__features``; with a list of lexicons,
    column ``__fold`` tells each row's."""
    held = docs.sparkSession.sparkContext.broadcast(learned)  # at most max_words words each

    def run(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        texts = batch.column(text_col).to_pylist()
        own = [held.value[f] for f in batch.column("__fold").to_pylist()] if isinstance(held.value, list) else [held.value] * len(texts)
        return {"__features": pa.array(list(map(features, texts, own)), pa.list_(pa.float64()))}

    return add_columns(docs, text_col, [T.StructField("__features", T.ArrayType(T.DoubleType()))], run)


#: Folds of the labelled rows.
FOLDS = 5


def fold(key: str) -> Column:
    return F.pmod(F.xxhash64(key, F.lit("part")), F.lit(FOLDS)).cast("int")


def distinct_words(text_col: str) -> Column:
    """The distinct words of a text, and "", which every text has."""
    return F.array_distinct(F.concat(F.array(F.lit("")), F.transform(F.split(F.lower(text_col), r"\s+"), lambda w: F.regexp_replace(w, r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", ""))))


def count_words(labelled: DataFrame, text_col: str, label_col: str, fold_col: str) -> DataFrame:
    """For each word, the toxic (``t0`` ...) and clean (``c0`` ...) texts of
    each fold that have it; the word "" stands for all texts."""
    return _count(labelled.select(F.col(label_col).alias("y"), F.col(fold_col).alias("f"), F.explode(distinct_words(text_col)).alias("word")))


def _count(one: DataFrame) -> DataFrame:
    return one.groupBy("word").agg(*(F.sum(F.when(F.col("f") == f, n).otherwise(0.0)).alias(f"{s}{f}") for s, n in (("t", F.col("y")), ("c", 1 - F.col("y"))) for f in range(FOLDS)))


def by_label(texts: DataFrame, taught: DataFrame, bits: int = BITS) -> tuple[DataFrame, DataFrame]:
    """``texts`` in two parts: those that get their ``__label`` where they
    are, and the rest, whose labels a join must tell.

    Keys alone are joined with their labels. A hash slot is settled when all
    texts in it have one label each, and the same: that fits a bitmap of
    ``bits`` slots, whatever the number of keys. With very many keys few
    slots are settled, and the join behind decides for most texts."""
    labels = taught.groupBy("__id").agg(F.count(F.lit(1)).alias("n"), F.max("__label").alias("label"))
    label = F.when((F.col("n") == 1) & F.col("label").isin(0.0, 1.0), F.col("label")).otherwise(-1.0)
    slots = texts.select("__id").join(labels, "__id", "left").select(slot("__id", bits).alias("slot"), label.alias("label")).groupBy("slot").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    bit = F.expr("shiftleft(1L, slot & 63)")
    words = slots.where("low = high and low >= 0").groupBy(F.shiftright("slot", 6).alias("__word")).agg(F.bit_or(bit).alias("__settled"), F.bit_or(F.when(F.col("low") == 1, bit).otherwise(F.lit(0))).alias("__toxic"))
    bitmap = F.broadcast(texts.sparkSession.createDataFrame(words.toArrow(), "__word int, __settled bigint, __toxic bigint"))  # bits / 64 rows at most
    at = slot("__id", bits)
    settled = (F.shiftright(at, 6) == F.col("__word")) & (F.getbit("__settled", at.bitwiseAND(F.lit(63))) == 1)
    here = texts.join(bitmap, settled).withColumn("__label", F.getbit("__toxic", at.bitwiseAND(F.lit(63))).cast("double"))
    return here.select(*texts.columns, "__label"), texts.join(bitmap, settled, "left_anti")


def count_toxic_words(texts: DataFrame, taught: DataFrame, min_texts: int, bits: int = BITS) -> DataFrame:
    """What ``count_words`` gives for all labelled texts, of the words that
    ``min_texts`` toxic ones have, and "". The toxic texts tell those words
    (and few others, as ``key_filter`` does), and only those are counted in
    all. Words are counted where their text is; a text whose label is not
    settled there (``by_label``) travels as its distinct words."""
    enough = " + ".join(f"t{f}" for f in range(FOLDS)) + f" >= {min_texts} or word = ''"
    here, others = by_label(texts, taught, bits)
    worded = others.select("__id", F.array_join(distinct_words("__text"), " ").alias("__words"))  # words hold no blank
    kind = "__label > 0" if min_texts > 0 else "true"
    toxic = taught.where(kind)

    def one(own: DataFrame, sent: DataFrame, labels: DataFrame) -> DataFrame:
        rows = lambda df, words: df.select(F.col("__label").alias("y"), fold("__id").alias("f"), F.explode(words).alias("word"))
        return rows(own, distinct_words("__text")).union(rows(sent.join(labels, "__id"), F.split("__words", " ")))

    seen = _count(one(here.where(kind), key_filter(toxic.select(F.col("__id").alias("key")))(worded, "__id"), toxic)).where(enough)
    return _count(key_filter(seen.select(F.col("word").alias("key")))(one(here, worded, taught), "word")).where(enough)


def learn_lexicon(counts: DataFrame, *, without: int | None = None, max_words: int = 10_000, min_texts: int = 5) -> dict[str, float]:
    """Words that more toxic than clean texts of all folds (but ``without``)
    have: log odds, for the ``max_words`` words surest to have them (4
    standard errors and ``min_texts`` toxic texts at least)."""
    folds = [f for f in range(FOLDS) if f != without]
    seen = counts.select("word", *(sum((F.col(f"{s}{f}") for f in folds), F.lit(0.0)).alias(s) for s in "tc"))
    total = seen.where("word = ''").first()
    bad, good = (total.t, total.c) if total else (0.0, 0.0)
    odds = F.log((F.col("t") + 0.5) / (bad - F.col("t") + 0.5)) - F.log((F.col("c") + 0.5) / (good - F.col("c") + 0.5))
    error = F.sqrt(1 / (F.col("t") + 0.5) + 1 / (F.col("c") + 0.5) + 1 / (bad - F.col("t") + 0.5) + 1 / (good - F.col("c") + 0.5))
    best = seen.where((F.col("word") != "") & (F.col("t") >= min_texts)).select("word", odds.alias("odds"), (odds / error).alias("z")).where("z > 4 and odds > 1").orderBy(F.desc("z"), "word").limit(max_words)
    return {r.word: r.odds for r in best.collect()}


@dataclass
class ToxicityModel:
    learned: dict[str, float]
    trees: GBTClassificationModel | None
    curve: IsotonicRegressionModel | None
    mean: float

    def score(self, docs: DataFrame, text_col: str = "text", score_col: str = "score") -> DataFrame:
        """``docs`` with ``score_col`` between 0 and 1."""
        docs = docs.drop(score_col)
        if self.trees is None:
            return docs.withColumn(score_col, F.lit(self.mean))
        out = self._margin(with_features(docs, text_col, self.learned))
        return self.curve.transform(out).withColumn(score_col, F.least(F.greatest(F.col("__score"), F.lit(0.0)), F.lit(1.0))).drop("__score", "__margin")

    def _margin(self, featured: DataFrame) -> DataFrame:
        return self.trees.transform(featured.withColumn("__vector", array_to_vector("__features"))).withColumn("__margin", vector_to_array("__raw")[1]).drop("__vector", "__raw", "__probability", "__class", "__features")


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_rows: int = 20_000, rounds: int = 30, depth: int = 4, max_words: int = 10_000, min_texts: int = 5
) -> ToxicityModel:
    """Fit trees and curve on at most ``max_rows`` of the labelled rows (half
    of them of each label), the lexicon (``max_words`` words, each of
    ``min_texts`` toxic texts at least) on all of them."""
    texts = docs.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
    rows = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).cast(docs.schema[id_col].dataType).alias("__id"), F.col(label_col).cast("double").alias("__label"))
    texts = key_filter(rows.select(F.col("__id").alias("key")))(texts, "__id")
    held = [taught := rows.join(texts.select("__id"), "__id", "left_semi").persist()]
    try:
        kinds = {r["__label"]: (r["n"], r["ids"]) for r in taught.groupBy("__label").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("__id").alias("ids")).collect()}
        total = sum(n for n, _ in kinds.values())
        mean = kinds.get(1.0, (0, 0))[0] / total if total else 0.0
        if len(kinds) < 2 or min(ids for _, ids in kinds.values()) < 2:
            return ToxicityModel({}, None, None, mean)
        held.append(counts := count_toxic_words(texts, taught, min_texts).persist())
        learned = learn_lexicon(counts, max_words=max_words, min_texts=min_texts)
        others = [learn_lexicon(counts, without=f, max_words=max_words, min_texts=min_texts) for f in range(FOLDS)]
        sample = None
        for label, (n, _) in kinds.items():
            own = taught.where(F.col("__label") == label).orderBy(F.xxhash64("__id"), "__id").limit(max_rows // 2)
            # every fifth key is for the curve, the second first
            place = F.dense_rank().over(Window.partitionBy("__label").orderBy(F.xxhash64("__id"), "__id"))
            own = own.withColumn("__level", place % FOLDS == 2).withColumn("__weight", F.lit(n / min(n, max_rows // 2)))
            sample = own if sample is None else sample.union(own)
        # max_rows rows of numbers at most
        joined = texts.join(F.broadcast(sample), "__id").withColumn("__fold", fold("__id"))
        # in one order, whatever the input's partitions, as the trees draw rows by their place; and in two
        # tasks, as two sums of doubles add up alike in either order: a stage that runs again must come
        # to the same model. The partition is named for each row: the trees pass over these few rows some
        # hundred times, and a session that deals rows out more widely would start as many tasks each time
        half = F.pmod(F.hash("__id"), F.lit(2))
        rows_in_order = with_features(joined, "__text", others).drop("__text").repartitionById(2, half).sortWithinPartitions("__id", "__label", "__level", "__weight", "__features")
        held.append(featured := rows_in_order.persist())
        grower = GBTClassifier(featuresCol="__vector", labelCol="__label", predictionCol="__class", maxIter=rounds, maxDepth=depth, stepSize=0.2, maxBins=64, minInstancesPerNode=10, subsamplingRate=0.8, seed=7)
        grower.setProbabilityCol("__probability").setRawPredictionCol("__raw")
        trees = grower.fit(featured.where("not __level").withColumn("__vector", array_to_vector("__features")))
        model = ToxicityModel(learned, trees, None, mean)
        model.curve = IsotonicRegression(featuresCol="__margin", labelCol="__label", predictionCol="__score", weightCol="__weight").fit(model._margin(featured.where("__level")))
        return model
    finally:
        for frame in held:
            frame.unpersist()
