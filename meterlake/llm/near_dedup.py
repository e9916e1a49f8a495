"""MinHash near-duplicates, confirmed on whole sets, and their components.

Every document becomes its set of distinct word shingles. Documents with the
same set form one class, so copies are never paired. For each class, 160
minima under universal hash functions form 32 bands of 5; classes that share
a band share a bucket. In a bucket the signatures of two classes, 256 more
minima of 8 bits each, are compared, and pairs whose share of equal minima
is within 0.13 of the threshold or above it (5 standard deviations at the
threshold: fewer than one in a million pairs at 0.8 or more fall below) are confirmed by the exact overlap of their sets. A band of a pair
at 0.8 is equal with probability 0.33, so all 32 differ in 3 of a million
such pairs.

Links are confirmed in two rounds. First each class with its likeliest
partner of every bucket, which joins a group of copies to what they were
made from; then all remaining pairs of a bucket that still lie in different
components. For those, the sets of the classes that have such a pair are
sent to the bucket, and only confirmed links leave it, so a link between
different texts is lost only where all bands differ or the signatures do, and neither pairs inside a component nor pairs that
fail are ever spelled out. A bucket with more than ``BLOCK`` classes is
split into blocks, and every pair of blocks is compared by a task of its
own. A pair is looked at in the first bucket it shares only.

Defined cases: a text with fewer words than a shingle is one shingle; texts
without words (null, empty, blank) have the empty set and are linked with
nothing; rows of one key are one document; rows without a key are linked
with nothing, have no component, and are kept.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.llm.components import components, release
from meterlake.llm.words import SPACED, mix, pieces, tidy_batches, words_of
from meterlake.session import checkpoint_root

BANDS, ROWS, BLOCK = 32, 5, 2048
SLACK, MINIMA = 0.13, 256
_PAIRS_AT_ONCE = 1 << 15
_rng = np.random.default_rng(20240501)
_A = _rng.integers(0, 2**63, BANDS * ROWS + MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 2**63, BANDS * ROWS + MINIMA, dtype=np.uint64)


def shingle_sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, concatenated, and the
    number of each text."""
    w = words_of(texts, SPACED, lower=True)
    grams, whole = w.ngrams(size)
    n_words = np.diff(w.first)
    doc, grams = w.doc[whole], grams[whole]
    short = np.flatnonzero((n_words > 0) & (n_words < size))
    if len(short):
        few = np.empty(len(short), np.uint64)
        for n in np.unique(n_words[short]):
            own = short[n_words[short] == n]
            few[n_words[short] == n] = w.ngrams(int(n))[0][w.first[own]]
        doc, grams = np.concatenate([doc, short]), np.concatenate([grams, few])
    order = np.lexsort((grams, doc))
    doc, grams = doc[order], grams[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (grams[1:] != grams[:-1])
    return grams[new], np.bincount(doc[new], minlength=len(n_words))


def signatures(shingles: np.ndarray, counts: np.ndarray, functions: int = BANDS * ROWS) -> np.ndarray:
    """A row of 32-bit minima for each set that has members."""
    counts = counts[counts > 0]
    ends = np.cumsum(counts)
    out = np.empty((len(counts), functions), np.uint32)
    # a few thousand shingles at a time stay in the processor's cache
    first = 0
    while first < len(counts):
        last = max(first + 1, int(np.searchsorted(ends, ends[first] - counts[first] + 16384, side="right")))
        begin = int(ends[first] - counts[first])
        part = shingles[begin : ends[last - 1]]
        at = ends[first:last] - counts[first:last] - begin
        for j in range(functions):
            out[first:last, j] = np.minimum.reduceat(part * _A[j] + _B[j], at) >> np.uint64(32)
        first = last
    return out


def band_keys(sig: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band of each row."""
    rows = sig.reshape(len(sig), BANDS, ROWS).astype(np.uint64)
    key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), rows.shape[:2]).copy()
    for j in range(ROWS):
        key = mix(key ^ (rows[:, :, j] + np.uint64(0x9E3779B97F4A7C15)))
    return key


def _sets_of(docs: DataFrame, size: int, *, full: bool) -> DataFrame:
    """``key``, ``n`` and the set's 128-bit name; then its bands, or (``full``)
    its signature (32 bits of each band, then 8 of each further minimum) and
    all of its shingles."""
    extra = "sig binary, members binary" if full else "bands array<bigint>"

    @tidy_batches
    def run(batches):
        for batch in batches:
            for part in pieces(batch, "text"):
                members, counts = shingle_sets(part.column("text"), size)
                some = counts > 0
                at = (np.cumsum(counts) - counts)[some]
                hi, lo = np.zeros(len(counts), np.uint64), np.zeros(len(counts), np.uint64)
                sig = np.zeros((0, BANDS * ROWS), np.uint32)
                if len(members):
                    hi[some] = np.add.reduceat(mix(members), at)
                    lo[some] = np.add.reduceat(mix(members ^ _B[0]), at)
                    sig = signatures(members, counts, len(_A) if full else BANDS * ROWS)
                row = np.cumsum(some) - 1
                if full:
                    raw = memoryview(members.astype("<u8").tobytes())
                    short = band_keys(sig[:, : BANDS * ROWS]).astype("<u4").view(np.uint8)
                    sig = np.concatenate([short, sig[:, BANDS * ROWS :].astype(np.uint8)], axis=1)
                    end = np.cumsum(counts)
                    cols = [
                        pa.array([sig[r].tobytes() if s else None for r, s in zip(row, some)], pa.binary()),
                        pa.array([bytes(raw[8 * (e - c) : 8 * e]) for e, c in zip(end.tolist(), counts.tolist())], pa.binary()),
                    ]
                else:
                    keys = band_keys(sig).view(np.int64)
                    offsets = np.concatenate([[0], np.cumsum(some * BANDS)])
                    cols = [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(keys.ravel()))]
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), pa.array(counts, pa.int64()), pa.array(hi.view(np.int64)), pa.array(lo.view(np.int64)), *cols],
                    names=["key", "n", "hi", "lo", *(f.split()[0] for f in extra.split(", "))],
                )

    kind = docs.schema["key"].dataType.simpleString()
    return docs.mapInArrow(run, f"key {kind}, n bigint, hi bigint, lo bigint, {extra}")


_NODE = [("hi", T.LongType()), ("rep", T.LongType())]
_PAIR = T.StructType([T.StructField(f"{s}_{n}", t) for s in "ab" for n, t in _NODE])
_SPOT = T.StructType([T.StructField(n, T.LongType()) for n in ("bucket", "bi", "bj", "hi")])


def _overlap(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets share enough."""
    if min(len(x), len(y)) * 100 < percent * max(len(x), len(y)):
        return False
    at = np.minimum(np.searchsorted(x, y), len(x) - 1)
    shared = int(np.count_nonzero(x[at] == y))
    return 100 * shared >= percent * (len(x) + len(y) - shared)


def _in_buckets(rows: DataFrame, percent: int, want: str) -> DataFrame:
    """Look at the pairs of classes of every bucket (or of two blocks of it)
    that are likely enough, lie in different components and share no earlier
    band. ``want``: "best" gives for each class its likeliest pair, "spots"
    the classes that have a pair, "links" (with sets) the confirmed pairs."""
    least = percent / 100 - SLACK

    def judge(t: pa.Table):
        col = lambda n: t.column(n).to_numpy()
        sig = np.frombuffer(b"".join(t.column("sig").to_pylist()), np.uint8).reshape(t.num_rows, BANDS * 4 + MINIMA)
        bands, low = np.ascontiguousarray(sig[:, : BANDS * 4]).view("<u4"), sig[:, BANDS * 4 :]
        bucket, bi, bj, block, band, root = (col(n) for n in ("bucket", "bi", "bj", "block", "band", "root"))
        edge = np.flatnonzero((np.diff(bucket) != 0) | (np.diff(bi) != 0) | (np.diff(bj) != 0)) + 1
        end_of = np.repeat(np.append(edge, t.num_rows), np.diff(np.concatenate([[0], edge, [t.num_rows]])))
        more = end_of - np.arange(t.num_rows) - 1  # partners after each row in its run
        total = np.concatenate([[0], np.cumsum(more)])
        kept: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        row = 0
        while row < t.num_rows:
            to = max(row + 1, int(np.searchsorted(total, total[row] + _PAIRS_AT_ONCE, side="right")) - 1)
            x = np.repeat(np.arange(row, to), more[row:to])
            y = x + 1 + np.arange(len(x)) - np.repeat(total[row:to] - total[row], more[row:to])
            ok = (root[x] != root[y]) & ((bi[x] == bj[x]) | (block[x] != block[y]))
            x, y = x[ok], y[ok]
            for s in range(0, len(x), _PAIRS_AT_ONCE):
                p, q = x[s : s + _PAIRS_AT_ONCE], y[s : s + _PAIRS_AT_ONCE]
                share = (low[p] == low[q]).mean(axis=1)
                p, q, share = p[share >= least], q[share >= least], share[share >= least]
                first = (bands[p] == bands[q]).argmax(axis=1) == band[p]
                kept.append((p[first], q[first], share[first]))
            row = to
        if not kept:
            return
        x, y, share = (np.concatenate(z) for z in zip(*kept))
        if want == "spots":
            i = np.unique(np.concatenate([x, y]))
            yield pa.RecordBatch.from_arrays([pa.array(col(n)[i].astype(np.int64)) for n in _SPOT.names], names=_SPOT.names)
            return
        if want == "best" and len(x):
            node, other, s = np.concatenate([x, y]), np.concatenate([y, x]), np.concatenate([share, share])
            order = np.lexsort((other, -s, node))
            node, other = node[order], other[order]
            lead = np.ones(len(node), bool)
            lead[1:] = node[1:] != node[:-1]
            x, y = np.minimum(node[lead], other[lead]), np.maximum(node[lead], other[lead])
            x, y = np.unique(np.stack([x, y]), axis=1)
        if want == "links" and len(x):
            sets = [np.frombuffer(v.as_buffer(), np.uint64) for v in t.column("members")]
            good = np.array([_overlap(sets[i], sets[j], percent) for i, j in zip(x.tolist(), y.tolist())])
            x, y = x[good], y[good]
        swap = col("hi")[x] > col("hi")[y]
        a, b = np.where(swap, y, x), np.where(swap, x, y)
        yield pa.RecordBatch.from_arrays([pa.array(col(n)[i]) for i in (a, b) for n, _ in _NODE], names=_PAIR.names)

    @tidy_batches
    def run(batches):
        held: pa.Table | None = None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            held = t if held is None else pa.concat_tables([held, t]).combine_chunks()
            keys = [held.column(n).to_numpy() for n in ("bucket", "bi", "bj")]
            change = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1
            if len(change):  # the last run may go on in the next batch
                yield from judge(held.slice(0, change[-1]))
                held = held.slice(change[-1])
        if held is not None and held.num_rows:
            yield from judge(held)

    lined = rows.repartition("bucket", "bi", "bj").sortWithinPartitions("bucket", "bi", "bj")
    return lined.mapInArrow(run, _SPOT if want == "spots" else _PAIR)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose whole sets overlap enough."""
    side = lambda s: sets.select(F.col("hi").alias(f"{s}_hi"), F.col("members").alias(f"{s}_set"))
    both = pairs.join(side("a"), "a_hi").join(side("b"), "b_hi").select("a_rep", "b_rep", "a_set", "b_set")

    @tidy_batches
    def run(batches):
        for batch in batches:
            views = [[np.frombuffer(v.as_buffer(), np.uint64) for v in batch.column(c)] for c in ("a_set", "b_set")]
            good = [_overlap(x, y, percent) for x, y in zip(*views)]
            yield batch.select(["a_rep", "b_rep"]).filter(pa.array(good, pa.bool_()))

    return both.mapInArrow(run, "a_rep bigint, b_rep bigint").withColumnsRenamed({"a_rep": "a", "b_rep": "b"})


#: Hash slots of the bitmaps that keys are looked up in.
BITS = 1 << 23


def slot(key: Column | str, bits: int = BITS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(bits)).cast("int")


def key_filter(keys: DataFrame, bits: int = BITS) -> Callable[..., DataFrame]:
    """A function that keeps the rows of a frame whose column is one of
    ``keys`` (a column ``key``), and few others, or with ``others`` the rest
    (with the nulls). It looks keys up in a bitmap of ``bits`` hash slots,
    whatever their number: rows that fail need no shuffle. With very many keys
    it passes all, and the join behind it decides alone, as it always does.
    The look-up is a join with the bitmap's words, so that a task that runs
    Python behind it has one Python worker and not two."""
    own = keys.select(slot(F.col("key"), bits).alias("slot"))
    words = own.groupBy(F.shiftright("slot", 6).alias("__word")).agg(F.bit_or(F.expr("shiftleft(1L, slot & 63)")).alias("__bits"))
    bitmap = keys.sparkSession.createDataFrame(words.toArrow(), "__word int, __bits bigint")  # bits / 64 rows at most

    def known(rows: DataFrame, key: str, *, others: bool = False) -> DataFrame:
        at = slot(F.col(key), bits)
        taken = (F.shiftright(at, 6) == F.col("__word")) & (F.getbit("__bits", at.bitwiseAND(F.lit(63))) == 1)
        return rows.join(F.broadcast(bitmap), F.col(key).isNotNull() & taken, "left_anti" if others else "left_semi")

    return known


def near_duplicates(docs: DataFrame, *, percent: int = 80, size: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: the key, ``n_shingles``,
    ``component_id`` (the smallest key reachable over links of ``percent``
    or more) and ``kept``."""
    checkpoint_root(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("key"), F.col(text_col).alias("text"))
    all_sets = _sets_of(rows, size, full=False).checkpoint()
    named = all_sets.where("key is not null and n > 0")
    # written, so that joins of a hot class's rows shuffle both sides and can be split
    classes = named.groupBy("hi", "lo", "n").agg(F.min("key").alias("rep")).checkpoint()

    # buckets: the rows that stand for their class, named by half of its name
    own = named.join(classes.select("hi", "lo", F.col("rep").alias("key")), ["hi", "lo", "key"]).dropDuplicates(["hi"])
    banded = own.select("hi", F.posexplode("bands").alias("band", "bucket"))
    full = banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("in_bucket")).where("in_bucket > 1")
    shared = banded.join(full, "bucket").checkpoint()

    wanted = own.select("hi", "lo", "key").join(shared.select("hi").distinct(), "hi", "left_semi")
    needed = wanted.select("key").distinct()
    texts = key_filter(needed)(rows, "key").join(needed, "key", "left_semi")
    sets = _sets_of(texts, size, full=True).join(wanted, ["key", "hi", "lo"], "left_semi").dropDuplicates(["hi"]).select("hi", F.col("key").alias("rep"), "sig", "members").checkpoint()
    release(docs.sparkSession)

    parts = F.ceil(F.col("in_bucket") / BLOCK).cast("int")
    dealt = (
        shared.withColumn("parts", parts).withColumn("block", F.pmod(F.xxhash64("hi"), F.col("parts")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .withColumn("bi", F.least("block", "other")).withColumn("bj", F.greatest("block", "other")).drop("parts", "other", "in_bucket")
    )
    signed = sets.select("hi", "rep", "sig")

    def remaining(roots: DataFrame) -> DataFrame:
        """Links of buckets that hold several components."""
        rooted = sets.select("hi", "rep").join(roots.withColumnRenamed("node", "rep"), "rep", "left").select("hi", F.coalesce("root", "rep").alias("root"))
        labelled = dealt.join(rooted, "hi")
        several = labelled.groupBy("bucket").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x != y").select("bucket")
        opened = labelled.join(several, "bucket", "left_semi").checkpoint()
        spots = _in_buckets(opened.join(signed, "hi"), percent, "spots")
        spots = spots.withColumns({"bi": F.col("bi").cast("int"), "bj": F.col("bj").cast("int")})
        return _in_buckets(opened.join(spots, ["bucket", "bi", "bj", "hi"], "left_semi").join(sets, "hi"), percent, "links").select(F.col("a_rep").alias("a"), F.col("b_rep").alias("b"))

    # rows of one key belong together, whatever their texts
    of_key = named.join(classes.select("hi", "lo", "rep"), ["hi", "lo"]).select("key", "rep")
    several = of_key.groupBy("key").agg(F.min("rep").alias("x"), F.max("rep").alias("y")).where("x != y").select("key")
    same_key = of_key.join(several, "key", "left_semi").select(F.col("key").alias("a"), F.col("rep").alias("b"))

    likeliest = _in_buckets(dealt.withColumn("root", F.col("hi")).join(signed, "hi"), percent, "best").distinct()
    links = _confirmed(likeliest, sets, percent).checkpoint()
    release(docs.sparkSession)
    links = links.union(remaining(components(links))).union(same_key).checkpoint()
    release(docs.sparkSession)
    roots = components(links)

    placed = all_sets.select("key", "n", "hi", "lo").join(classes.select("hi", "lo", "n", "rep"), ["hi", "lo", "n"], "left")
    placed = placed.withColumn("rep", F.when(F.col("key").isNotNull(), F.coalesce("rep", "key")))
    placed = placed.join(roots, F.col("rep") == F.col("node"), "left")
    component = F.coalesce("root", "rep")
    return placed.select(F.col("key").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("key") == component, F.lit(True)).alias("kept"))
