"""What each document filter removes in every order of the filters.

A document becomes a mask: one bit for each filter that it fails. Masks are
counted per part, so that the audit works on at most 32 cells a part however
many documents there are. A recursive CTE enumerates the orders: every level
extends each filter prefix by each unused letter, joins the part's cells,
carries the bits applied so far and appends that step's counts; the rows of
the last level hold all steps of one order.

Counting takes three shuffles of small rows: texts stay in their tasks and
only their 128-bit names travel. Equal texts meet after equal rows have been
counted, so a text that a third of all rows share is a handful of counts.

Defined cases: null text is empty; null and empty ``part`` are one part;
a row without a key never fails the repeat filter and makes no other row
fail it; rows of one key are separate documents, and of those with one text
none is smaller than the other; several label rows of a key count as one
that has the largest of each value; an empty table gives an empty result;
very long texts are read whole, one at a time; other columns of the input
are ignored, whatever they are called; ties do not occur.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterlake.llm.words import SPACED, buffers, pieces, tidy_batches, words_of
from meterlake.session import checkpoint_root

#: The filters: A few words, B repeated words, C capitals, D odd characters,
#: E a text that a smaller key has as well. Bits in this order.
LETTERS = "ABCDE"
_REPEAT = 1 << LETTERS.index("E")
#: Rows of the recursion for one part: the empty prefix and all others.
_ROWS_A_PART = 326
_CELL = "STRUCT<mask: INT, n: BIGINT, good: BIGINT, toxic: BIGINT>"
_COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")

_ODD = np.zeros(256, bool)
_ODD[[ord(c) for c in "#$%&*|"]] = True


def content_masks(texts: pa.Array, *, least_words: int = 100, distinct_percent: int = 80, capital_percent: int = 10) -> np.ndarray:
    """The bits of the filters that look at one text alone."""
    w = words_of(texts, SPACED, lower=False)
    data, offsets = buffers(texts)

    def per_text(flags: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(flags)])[offsets])

    n_words = np.diff(w.first)
    order = np.lexsort((w.hash, w.doc))
    own, doc = w.hash[order], w.doc[order]
    new = np.ones(len(own), bool)
    new[1:] = (own[1:] != own[:-1]) | (doc[1:] != doc[:-1])
    distinct = np.bincount(doc[new], minlength=len(n_words))
    points = per_text((data & 0xC0) != 0x80)
    capitals = per_text((data >= 65) & (data <= 90))
    fails = (n_words < least_words, 100 * distinct < distinct_percent * n_words, 100 * capitals > capital_percent * points, per_text(_ODD[data]) > 0)
    return sum(f.astype(np.int32) << i for i, f in enumerate(fails))


def _marked(docs: DataFrame) -> DataFrame:
    """``key, part``, the content bits ``mask`` and the text's name."""

    @tidy_batches
    def run(batches):
        for batch in batches:
            for piece in pieces(batch, "text"):
                data, offsets = buffers(piece.column("text"))
                raw = memoryview(np.ascontiguousarray(data))
                names = [blake2b(raw[a:b], digest_size=16).digest() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
                both = np.frombuffer(b"".join(names), "<i8").reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [piece.column("key"), piece.column("part"), pa.array(content_masks(piece.column("text")), pa.int32()), pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy())],
                    names=["key", "part", "mask", "hi", "lo"],
                )

    return docs.mapInArrow(run, f"key {docs.schema['key'].dataType.simpleString()}, part string, mask int, hi bigint, lo bigint")


def mask_cells(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """``part, mask, n, good, toxic``: documents of each part with each mask,
    and those labelled good or toxic among them."""
    source = docs.select(F.col(id_col).alias("key"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), F.col(text_col).alias("text"))

    def rows(some: DataFrame) -> DataFrame:
        return _marked(some).groupBy("key", "part", "mask", "hi", "lo").agg(F.count(F.lit(1)).alias("n"))

    one = lambda c: F.max(F.coalesce(F.col(c) == 1, F.lit(False)))
    flags = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("key")).agg(one("quality").alias("good"), one("toxic").alias("toxic"))
    no = F.lit(False)
    # rows without a key would all meet in one task of the join; each text is read by one of the two scans
    known = rows(source.where("key is not null")).join(flags, "key", "left").withColumns({c: F.coalesce(c, no) for c in ("good", "toxic")})
    labelled = known.unionByName(rows(source.where("key is null")).withColumns({"good": no, "toxic": no}))

    named = F.when(F.col("key").isNotNull(), F.struct("key", "n"))
    texts = labelled.groupBy("hi", "lo", "part", "mask", "good", "toxic").agg(F.sum("n").alias("n"), F.min(named).alias("first"), F.sum(F.when(F.col("key").isNull(), F.col("n")).otherwise(0)).alias("nameless"))
    least = F.min("first.key").over(Window.partitionBy("hi", "lo"))  # a row for each part and label there
    at_least = F.when(F.col("first.key") == F.col("least"), F.col("first.n")).otherwise(0)
    texts = texts.withColumn("least", least).withColumn("again", F.col("n") - F.col("nameless") - at_least)
    split = F.array(F.struct((F.col("mask") + _REPEAT).alias("mask"), F.col("again").alias("n")), F.struct(F.col("mask"), (F.col("n") - F.col("again")).alias("n")))
    counted = texts.select("part", "good", "toxic", F.inline(split)).where("n > 0")
    return counted.groupBy("part", "mask").agg(F.sum("n").alias("n"), *[F.sum(F.when(F.col(c), F.col("n")).otherwise(0)).alias(c) for c in ("good", "toxic")])


def _walk(cells: DataFrame, letters: str) -> DataFrame:
    """``part, filter_order, steps`` for every order of ``letters``."""
    total = lambda what, which: f"aggregate(filter(cells, x -> {which}), 0L, (s, x) -> s + x.{what})"
    here = "(x.mask & bit) != 0 AND (x.mask & applied) = 0"
    made = {
        "kept": total("n", "(x.mask & (applied | bit)) = 0"),
        "removed": total("n", here),
        "redundant": total("n", "(x.mask & bit) != 0 AND (x.mask & applied) != 0"),
        "unique_fails": total("n", "x.mask = bit"),
        "good_lost": total("good", here),
        "toxic_lost": total("toxic", here),
    }
    step_type = "ARRAY<STRUCT<step: INT, letter: STRING, " + ", ".join(f"{c}: BIGINT" for c in _COUNTS) + ">>"
    step = "named_struct('step', size(steps) + 1, 'letter', letter, " + ", ".join(f"'{c}', {made[c]}" for c in _COUNTS) + ")"
    unused = ", ".join(f"named_struct('letter', '{x}', 'bit', {1 << i})" for i, x in enumerate(letters))
    return cells.sparkSession.sql(
        f"""
        WITH RECURSIVE walk(part, filter_order, applied, steps) AS (
          SELECT part, '', 0, CAST(array() AS {step_type}) FROM {{cells}}
          UNION ALL
          SELECT part, concat(filter_order, letter), applied | bit, CAST(concat(steps, array({step})) AS {step_type})
          FROM (SELECT w.*, c.cells FROM walk w JOIN {{cells}} c ON w.part = c.part)
          LATERAL VIEW inline(array({unused})) AS letter, bit
          WHERE (applied & bit) = 0)
        SELECT part, filter_order, steps FROM walk WHERE length(filter_order) = {len(letters)}
        """,
        cells=cells,
    )


def audit_orders(cells: DataFrame, letters: str = LETTERS) -> DataFrame:
    """One row for each part, order and step, from ``mask_cells``.

    A recursion may make ``spark.sql.cteRecursionRowLimit`` rows; more parts
    than that allows are walked in several recursions."""
    spark = cells.sparkSession
    checkpoint_root(spark)
    packed = cells.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).cast(f"ARRAY<{_CELL}>").alias("cells")).checkpoint()
    limit = int(spark.conf.get("spark.sql.cteRecursionRowLimit", "1000000"))
    slices = 1 if limit < 0 else -(-2 * _ROWS_A_PART * packed.count() // limit) or 1
    walked = None
    for i in range(slices):
        own = packed if slices == 1 else packed.where(F.pmod(F.xxhash64("part"), F.lit(slices)) == i)
        walked = _walk(own, letters) if walked is None else walked.union(_walk(own, letters))
    rows = walked.select("part", "filter_order", F.inline("steps"))
    of_letter = Window.partitionBy("part", "letter")  # a row for each order
    return rows.withColumn("shapley", F.sum("removed").over(of_letter))


def filter_audit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """``part, filter_order, step, letter``, the counts of that step and
    ``shapley``, zeros included, for every part of ``docs``."""
    return audit_orders(mask_cells(docs, labels, id_col=id_col, text_col=text_col, part_col=part_col))
