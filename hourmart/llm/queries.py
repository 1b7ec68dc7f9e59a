"""Registered queries of the training-data operators and their check SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourmart.llm import (
    audit,
    brown,
    exact_dedup,
    langid,
    merkle,
    mixing,
    passages,
    pieces,
    repetition,
    simhash,
    topk,
    toxicity,
    warc,
)
from hourmart.llm.common import Scratch, hash_remainder, partitions, tuned

SCHEMAS = {
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "embeddings": "vec_id long, embedding array<float>, label int",
    "pages": "page_id long, url string, html string",
    "labels": "doc_id long, quality int, toxic int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tuned(spark).read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def op1_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    rows = topk.dense_vectors(embeddings, "vec_id", "embedding")
    found = topk.top_k(rows.where("id % 50 = 0"), rows, 5)
    return found.withColumnRenamed("id", "vec_id")


OP1_SQL = """
WITH t AS (
  SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings WHERE vec_id IS NOT NULL
), e AS (
  SELECT vec_id FROM t GROUP BY vec_id HAVING bool_and(coalesce(isfinite(x), FALSE))
), v AS (
  SELECT vec_id, i, CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) AS w FROM t JOIN e USING (vec_id)
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.w * c.w) AS BIGINT) AS score
  FROM v q JOIN v c ON q.i = c.i AND q.vec_id <> c.vec_id
  WHERE q.vec_id % 50 = 0
  GROUP BY q.vec_id, c.vec_id
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    result = exact_dedup.content_sort(docs)
    return result.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP6_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS content FROM documents
)
SELECT doc_id,
  min(doc_id) OVER (PARTITION BY content) AS keep_id,
  count(*) OVER (PARTITION BY content) AS group_size,
  row_number() OVER (PARTITION BY content ORDER BY doc_id NULLS LAST) = 1 AS kept,
  sha256(content) AS text_sha256
FROM d
"""


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


# The level of the targets: the highest of those at which the first k sources, by own
# words over weight, are capped.
OP10_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    md5(concat_ws(':', '7', CAST(doc_id AS VARCHAR), text)) AS key
  FROM documents
), s AS (
  SELECT source, source_size, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight
  FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source)
), c AS (
  SELECT *, CAST(sum(source_size) OVER () AS BIGINT) AS total,
    CAST(coalesce(sum(3 * source_size) OVER (ORDER BY 3.0 * source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS held,
    CAST(sum(weight) OVER (ORDER BY 3.0 * source_size / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS share
  FROM s
), l AS (
  SELECT max(CAST(total - held AS DOUBLE) / CAST(share AS DOUBLE)) AS level FROM c
), t AS (
  SELECT source, source_size, least(CAST(weight AS DOUBLE) * level, CAST(3 * source_size AS DOUBLE)) AS target,
    least(CAST(floor(least(CAST(weight AS DOUBLE) * level, CAST(3 * source_size AS DOUBLE)) + 0.5) AS BIGINT), 3 * source_size) AS budget
  FROM c, l
), r AS (
  SELECT doc_id, size, source_size, target, budget,
    CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS epochs,
    CAST(coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id NULLS LAST, size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS earlier
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
  CAST(epochs * size + greatest(0, least(size, budget - epochs * source_size - earlier)) AS BIGINT) AS taken
FROM r
"""

def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.near_duplicates(docs, keep=["doc_id"]).select("doc_id", "fingerprint", "component_id")


def language_model(docs: DataFrame) -> langid.LanguageFilter:
    """Learned from the documents that are not held out."""
    return langid.learn(docs.where(hash_remainder("doc_id", 4) != 2))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(hash_remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out")
    result = langid.predict(docs, language_model(docs), keep=["doc_id"])
    return result.select("doc_id", held_out, "lang_pred", "score")


def op2_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all pages as archives below the shared folder and read these back."""
    pages = table(spark, sf_dir, "pages")
    scratch = Scratch(spark, "archives")
    files = scratch.store(warc.write_archives(pages, scratch.path("files")), "listed")
    return warc.read_archives(spark, files, partitions(spark), payloads=False)


OP3_SQL = """
WITH p AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages
), f AS (
  SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest, payload_bytes) END AS first
  FROM p
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN first IS NOT NULL AND first IS DISTINCT FROM page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first IS DISTINCT FROM page_id THEN first END AS refers_to,
  TRUE AS digest_ok
FROM f
"""

def op7_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    remainder = hash_remainder("doc_id", 7)
    held_out = F.coalesce(remainder == 2, F.lit(False))
    marked = docs.withColumn("held_out", held_out)
    scored = brown.score(marked, docs.where(remainder != 2), keep=["doc_id", "held_out"])
    columns = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity")
    return scored.select(*columns)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both labelled categories: low quality first, which then helps to tell toxic texts."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels")
    marks = labels.select("doc_id", (1 - F.col("quality")).alias("low_quality"), "toxic")
    chain = toxicity.learn(docs, marks, ["low_quality", "toxic"])
    return toxicity.predict(docs, chain, keep=["doc_id"])


#: A public vocabulary; a path on the driver.
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"


def op9_pieces(spark: SparkSession, sf_dir: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """Encode and decode again; ``round_trip`` compares the decoded text's hash."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    known = pieces.load_pieces(vocabulary)
    hashed = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    encoded = pieces.encode(hashed, known, keep=["doc_id", "text_hash"])
    decoded = pieces.decode(encoded, known)
    return decoded.select(
        "doc_id",
        F.length("decoded").cast("long").alias("n_chars"),
        F.size("ids").cast("long").alias("n_pieces"),
        F.xxhash64("decoded").eqNullSafe(F.col("text_hash")).alias("round_trip"),
        "ids",
    )


UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fifth row (by crc32 of its identifier) is checked with A-Z of its text lower-cased."""
    docs = table(spark, sf_dir, "documents")
    chosen = F.coalesce(hash_remainder("doc_id", 5) == 0, F.lit(False))
    lowered = F.translate("text", UPPER, UPPER.lower())
    fields = [lowered if c == "text" else F.col(c) for c in LEAF_COLUMNS]
    claimed = F.when(chosen, merkle.leaf_digest(fields))
    manifest = merkle.build_manifest(docs, LEAF_COLUMNS, carry={"doc_id": docs["doc_id"], "claimed": claimed})
    folded = merkle.fold(F.coalesce("claimed", "leaf"), F.col("path"))
    found = manifest.proofs().select(
        "doc_id", "leaf", "subroot", "root", merkle.path_digest(F.col("path")).alias("proof_sha256"), folded.alias("folded_root")
    )
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


# DuckDB has no crc32: it is folded over the digits, eight steps a byte.
OP11_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, text,
    coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || CAST(doc_id AS VARCHAR), '-')
      || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
      || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || CAST(n_chars AS VARCHAR), '-') AS head,
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lowered,
    xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
      string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
      lambda a, b: xor(xor(a, b) >> 1, 3988292384 * (xor(a, b) & 1)))) AS crc
  FROM documents
), e AS (
  SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    CASE WHEN crc % 5 = 0 THEN sha256(head || coalesce(strlen(lowered) || ':' || lowered, '-')) END AS claimed
  FROM d
), t AS (
  SELECT *, row_number() OVER () AS uid, count(*) OVER (PARTITION BY source) AS n,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
  FROM e
), levels AS (
  SELECT 0 AS level, source, pos, n, leaf AS node FROM t
  UNION ALL
  SELECT level + 1, source, pos // 16, (n + 15) // 16, sha256(string_agg(node, '' ORDER BY pos))
  FROM levels WHERE n > 1 GROUP BY level, source, pos // 16, n
), subroots AS (
  SELECT source, node AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
  FROM levels WHERE n = 1
), tops AS (
  SELECT 0 AS level, pos, n, subroot AS node FROM subroots
  UNION ALL
  SELECT level + 1, pos // 16, (n + 15) // 16, sha256(string_agg(node, '' ORDER BY pos))
  FROM tops WHERE n > 1 GROUP BY level, pos // 16, n
), low AS (
  SELECT level, source, pos,
    coalesce(string_agg(node, '') OVER (b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
    coalesce(string_agg(node, '') OVER (b ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM levels WHERE n > 1 WINDOW b AS (PARTITION BY level, source, pos // 16 ORDER BY pos)
), high AS (
  SELECT level, pos,
    coalesce(string_agg(node, '') OVER (b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
    coalesce(string_agg(node, '') OVER (b ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM tops WHERE n > 1 WINDOW b AS (PARTITION BY level, pos // 16 ORDER BY pos)
), u AS (
  SELECT t.uid, 0 AS tree, level, l, r FROM t JOIN low
    ON t.source IS NOT DISTINCT FROM low.source AND low.pos = t.pos // CAST(pow(16, level) AS BIGINT)
  UNION ALL
  SELECT t.uid, 1, level, l, r FROM t JOIN subroots s ON t.source IS NOT DISTINCT FROM s.source
    JOIN high ON high.pos = s.pos // CAST(pow(16, level) AS BIGINT)
), path AS (
  SELECT *, row_number() OVER (PARTITION BY uid ORDER BY tree, level) AS step FROM u
), folds AS (
  SELECT uid, 1 AS step, coalesce(claimed, leaf) AS node FROM t
  UNION ALL
  SELECT f.uid, f.step + 1, sha256(p.l || f.node || p.r) FROM folds f JOIN path p ON p.uid = f.uid AND p.step = f.step
), ends AS (
  SELECT uid, arg_max(node, step) AS folded_root FROM folds GROUP BY uid
), proofs AS (
  SELECT t.uid, sha256(coalesce(string_agg(l || r, '' ORDER BY step), '')) AS proof_sha256
  FROM t LEFT JOIN path ON t.uid = path.uid GROUP BY t.uid
)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified
FROM t JOIN subroots s ON t.source IS NOT DISTINCT FROM s.source JOIN proofs USING (uid) JOIN ends USING (uid),
  (SELECT node AS root FROM tops WHERE n = 1)
"""


def op12_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return repetition.repetition_rules(docs, keep=["doc_id"]).drop("repeats")


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return audit.interaction_audit(docs, table(spark, sf_dir, "labels"))


OP13_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), f AS (
  SELECT part, doc_id,
    CASE WHEN len(words) < 100 THEN 'A' ELSE '' END
    || CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 'B' ELSE '' END
    || CASE WHEN 100 * len(regexp_extract_all(text, '[A-Z]')) > 10 * length(text) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
    || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 'E' ELSE '' END AS fails
  FROM d
), l AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), p AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM f LEFT JOIN l ON f.doc_id = l.doc_id GROUP BY part, fails
), c AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c
), o AS (
  SELECT concat(a.c, b.c, g.c, h.c, i.c) AS filter_order FROM c a, c b, c g, c h, c i
  WHERE len(list_distinct([a.c, b.c, g.c, h.c, i.c])) = 5
), s AS (
  SELECT filter_order, CAST(step AS INTEGER) AS step, filter_order[step] AS letter, filter_order[1:step - 1] AS earlier
  FROM o, range(1, 6) r(step)
), m AS (
  SELECT part, filter_order, step, letter, n, good, toxic, fails = letter AS alone,
    contains(fails, letter) AS failing, earlier <> '' AND regexp_matches(fails, '[' || earlier || 'x]') AS gone
  FROM p, s
), t AS (
  SELECT part, filter_order, step, letter,
    CAST(coalesce(sum(n) FILTER (NOT gone AND NOT failing), 0) AS BIGINT) AS kept,
    CAST(coalesce(sum(n) FILTER (NOT gone AND failing), 0) AS BIGINT) AS removed,
    CAST(coalesce(sum(n) FILTER (gone AND failing), 0) AS BIGINT) AS redundant,
    CAST(coalesce(sum(n) FILTER (alone), 0) AS BIGINT) AS unique_fails,
    CAST(coalesce(sum(good) FILTER (NOT gone AND failing), 0) AS BIGINT) AS good_lost,
    CAST(coalesce(sum(toxic) FILTER (NOT gone AND failing), 0) AS BIGINT) AS toxic_lost
  FROM m GROUP BY part, filter_order, step, letter
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM t
"""


ENTRIES = {
    "op13_filter_audit": (op13_filter_audit, OP13_SQL),
    "op12_repetition": (op12_repetition, None),
    "op11_merkle": (op11_merkle, OP11_SQL),
    "op2_passages": (op2_passages, None),
    "op8_toxicity": (op8_toxicity, None),
    "op7_class_lm": (op7_class_lm, None),
    "op1_top_k": (op1_top_k, OP1_SQL),
    "op3_warc": (op3_warc, OP3_SQL),
    "op9_pieces": (op9_pieces, None),
    "op4_language": (op4_language, None),
    "op5_simhash": (op5_simhash, None),
    "op6_exact_dedup": (op6_exact_dedup, OP6_SQL),
    "op10_mixing": (op10_mixing, OP10_SQL),
}
