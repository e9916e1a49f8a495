"""The registered queries of this subpackage: thin digests of what the
operators return over the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.llm import chat, filter_audit, fingerprints, katz, near_dedup, neighbours, packing, substring_dedup, token_files, toxicity, whitening, wrappers
from meterlake.llm import decontaminate as leaks
from meterlake.llm.deploy import ship
from meterlake.session import shared_dir

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return fn(spark, sf_dir)

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    REGISTRY[fn.__name__] = run
    return run


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


@register
def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents linked at 85 percent of their shingles."""
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"), percent=85, size=5)


@register
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the rows not held out."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    model = toxicity.fit_toxicity(docs, labels.where(~held_out))
    scored = model.score(docs.select("doc_id", "text"))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@register
def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one made of control strings, in windows."""
    own = spark.createDataFrame([(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")], "conv_id long, turn long, role string, text string")
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(own)
    return chat.digest(chat.format_chat(turns, budget=512, history=128))


@register
def op4_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The article of every page, by its host's wrapper."""
    return wrappers.extract_main_text(_table(spark, sf_dir, "pages"), keep=["page_id", "url"])


@register
def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document that a repeated window of 20 words covers."""
    done = substring_dedup.substring_dedup(_table(spark, sf_dir, "documents"), window=20)
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


SQL["op5_substring_dedup"] = r"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(list_slice(w, i, i + 19), ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20)),
later AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS nth FROM windows)
  WHERE nth > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM later),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text
  FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id),
removed AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(r.n, 0) AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM d LEFT JOIN removed r USING (doc_id) LEFT JOIN kept k USING (doc_id)
"""


@register
def op6_katz_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Katz and unigram log probabilities of every document."""
    remainder = F.crc32(F.col("doc_id").cast("string")) % 10
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", (remainder != 0).alias("train"))
    return katz.katz_scores(docs, train_col="train")


@register
def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document and its place in a packed sequence."""
    packed = packing.pack_documents(_table(spark, sf_dir, "documents"), tokenizer=tokenizer_path(), end_id=0, capacity=2048)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@register
def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all ids as bit-packed files and report each document from them."""
    path = shared_dir(spark, "tokens")
    token_files.write_tokens(_table(spark, sf_dir, "documents"), path, tokenizer=tokenizer_path(), end_id=2)
    return token_files.read_documents(spark, path, ids=False).withColumnRenamed("key", "doc_id")


@register
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document inside a benchmark window, and whose."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = leaks.decontaminate(docs, _table(spark, sf_dir, "benchmark"), window=10, keep=["doc_id"])
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


SQL["op9_decontamination"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
b AS (
  SELECT item_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, list_slice(w, i, i + least(10, len(w)) - 1) AS words
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM windows),
placed AS (
  SELECT doc_id, n, i, list_slice(w, i, i + n - 1) AS words
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT DISTINCT doc_id, n, i, item_id FROM placed JOIN windows USING (n, words)),
words_hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(h.n_hit, 0) AS n_hit,
       coalesce(f.n_items, 0) AS n_items, sha256(coalesce(f.items, '')) AS items_sha256,
       coalesce(h.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words_hit h USING (doc_id) LEFT JOIN found f USING (doc_id)
"""


@register
def op10_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    return fingerprints.edit_report(_table(spark, sf_dir, "documents"))


@register
def op11_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest others of every vector whose id 20 divides."""
    return neighbours.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


SQL["op11_nearest_neighbours"] = r"""
WITH e AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v) AS score
  FROM e q JOIN e c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 20
"""


@register
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove in each of their 120 orders, by language."""
    audit = filter_audit.filter_audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return audit.select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


SQL["op12_filter_audit"] = r"""
WITH RECURSIVE flags AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id),
d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
masks AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         CASE WHEN len(w) < 100 THEN 1 ELSE 0 END
         + CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 2 ELSE 0 END
         + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 4 ELSE 0 END
         + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
         + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END AS mask
  FROM d LEFT JOIN flags USING (doc_id)),
cells AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM masks GROUP BY part, mask),
letters(letter, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
walk(prefix, step, letter, bit, before) AS (
  SELECT letter, 1, letter, bit, 0 FROM letters
  UNION ALL
  SELECT prefix || l.letter, step + 1, l.letter, l.bit, before | walk.bit
  FROM walk JOIN letters l ON ((before | walk.bit) & l.bit) = 0),
steps AS (
  SELECT o.prefix AS filter_order, w.step, w.letter, w.bit, w.before
  FROM walk o JOIN walk w ON o.step = 5 AND starts_with(o.prefix, w.prefix)),
counts AS (
  SELECT c.part, s.filter_order, s.step, s.letter,
         coalesce(sum(n) FILTER (mask & (before | bit) = 0), 0) AS kept,
         coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & before = 0), 0) AS removed,
         coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & before <> 0), 0) AS redundant,
         coalesce(sum(n) FILTER (mask = bit), 0) AS unique_fails,
         coalesce(sum(good) FILTER (mask & bit <> 0 AND mask & before = 0), 0) AS good_lost,
         coalesce(sum(toxic) FILTER (mask & bit <> 0 AND mask & before = 0), 0) AS toxic_lost
  FROM steps s CROSS JOIN cells c GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM counts
"""


@register
def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened values of every embedding, a row a component."""
    return whitening.components_long(whitening.whiten(_table(spark, sf_dir, "embeddings"), components=32))
