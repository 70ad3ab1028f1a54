"""The corpus operators over the test tables, by query name, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rangeload.llm import alignment, language, linededup, manifest, mixing, packing, quality, sharding, simhash, tokenfiles, tokens, topk, vectordedup
from rangeload.llm.common import ascii_lower, id_remainder, read
from rangeload.session import scratch_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op2_hypergeometric_shards(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text")
    placed = sharding.shuffle_into_shards(docs, 24)
    text = F.coalesce("text", F.lit(""))
    return placed.select(
        "doc_id",
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op5_two_tier_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    counted = tokens.token_counts(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 512)


@query
def op9_compression_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    learned = language.learn_dictionaries(docs.where(id_remainder("doc_id", 4) != 2))
    predicted = language.predict_language(docs, learned)
    return predicted.withColumn("held_out", id_remainder("doc_id", 4) == 2)


@query
def op4_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), 2048)


@query
def op10_simhash_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    return simhash.near_duplicates(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id")
    )


@query
def op6_levelled_line_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    kept = linededup.drop_shared_lines(docs.select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


ORACLES["op6_levelled_line_runs"] = """
WITH split AS (
  SELECT nr, doc_id, unnest(range(1, len(parts) + 1)) AS pos, unnest(parts) AS line
  FROM (SELECT row_number() OVER () AS nr, doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
), keyed AS (
  SELECT *, translate(regexp_replace(regexp_replace(line, '^[\\x20\\x09-\\x0D]+', ''), '[\\x20\\x09-\\x0D]+\\z', ''),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM split
), shared AS (
  SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT coalesce(doc_id::VARCHAR, '')) >= 5
), judged AS (
  SELECT nr, doc_id, pos, line, last IS NOT NULL AND doc_id IS DISTINCT FROM last AS lost FROM keyed LEFT JOIN shared USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (lost) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT lost), '')) AS kept_sha256
FROM judged GROUP BY nr, doc_id
"""


@query
def op7_pivot_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(read(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0, 5)


ORACLES["op7_pivot_top_k"] = """
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM usable q JOIN usable c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


@query
def op8_quantised_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    vectors = read(spark, folder, "embeddings").select("vec_id", "embedding")
    return vectordedup.near_duplicates(vectors).select("vec_id", "n_links", "component_id", "kept")


@query
def op1_pfair_mixture(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    size = F.octet_length(F.coalesce("text", F.lit(""))) + 1
    parts = mixing.tempered_parts(docs, "source", size, 1000)
    mixed = mixing.mix_sources(docs, parts, size=size)
    return mixed.select("doc_id", "source", "block", "slot", "start", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


ORACLES["op1_pfair_mixture"] = """
WITH RECURSIVE sized AS (
  SELECT doc_id, source, text, strlen(coalesce(text, '')) + 1 AS size,
         md5(coalesce(doc_id::VARCHAR, '')) AS mix_key
  FROM documents
), roots AS (
  SELECT source, floor(sqrt(sum(size)))::BIGINT AS root FROM sized GROUP BY source
), shares AS (
  SELECT source, greatest(1, root * (SELECT greatest(1000, least(1048576, 50 * count(*))) FROM roots) // (SELECT sum(root) FROM roots))::BIGINT AS parts,
         row_number() OVER (ORDER BY source NULLS FIRST) AS nr
  FROM roots
), cycle AS (
  SELECT list(parts ORDER BY nr) AS parts, sum(parts)::BIGINT AS len, count(*) AS n FROM shares
), schedule AS (
  SELECT 0::BIGINT AS slot, list_transform(parts, lambda p: 0::BIGINT) AS done, 0::BIGINT AS nr, 0::BIGINT AS nth FROM cycle
  UNION ALL
  SELECT slot + 1, list_transform(done, lambda d, i: CASE WHEN i = pick THEN d + 1 ELSE d END), pick, done[pick]
  FROM (
    SELECT slot, done, list_position(due, list_min(due)) AS pick
    FROM (
      SELECT s.slot, s.done, list_transform(range(1, c.n + 1), lambda i:
               CASE WHEN s.done[i] < c.parts[i] AND s.done[i] * c.len // c.parts[i] <= s.slot
                    THEN ((s.done[i] + 1) * c.len + c.parts[i] - 1) // c.parts[i] END) AS due
      FROM schedule s, cycle c WHERE s.slot < c.len
    )
  )
), slots AS (
  SELECT nr, nth, slot - 1 AS first FROM schedule WHERE slot > 0
), placed AS (
  SELECT *, (coalesce(sum(size) OVER (PARTITION BY source ORDER BY mix_key, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS start
  FROM sized
)
SELECT doc_id, p.source, start // 65536 AS block,
       (start // 65536) // h.parts * c.len + s.first AS slot, start, sha256(coalesce(text, '')) AS text_sha256
FROM placed p JOIN shares h ON p.source IS NOT DISTINCT FROM h.source CROSS JOIN cycle c
JOIN slots s ON s.nr = h.nr AND s.nth = (start // 65536) % h.parts
"""


@query
def op3_byte_network_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    held_out = id_remainder("doc_id", 3) == 1
    network = quality.fit_quality(docs.where(~held_out), read(spark, folder, "labels"))
    scored = quality.score_quality(docs, network)
    return scored.withColumn("held_out", held_out).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@query
def op11_perfect_hash_files(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    files = tokenfiles.write_token_files(docs, public_tokenizers.path("word_bpe_49k.json"), scratch_dir(spark, "token-files"))
    return files.fetch(files.keys()).select(F.col("key").alias("doc_id"), "start", F.col("length").alias("n_tokens"), "ids_crc32")


@query
def op12_postorder_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    columns = [F.col(name) for name in ("doc_id", "source", "lang", "n_chars", "text")]
    tampered = manifest.row_digest([*columns[:-1], ascii_lower(F.col("text"))])
    some = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    rows = docs.select("doc_id", "source", manifest.row_digest(columns).alias("leaf"), F.when(some, tampered).alias("tampered"))
    built = manifest.build_manifest(rows, part="source", order=["doc_id"], leaf="leaf")
    return built.proofs("tampered").select(
        "doc_id",
        F.col("digest").alias("leaf"),
        "subroot",
        F.lit(built.root).alias("root"),
        F.sha2(F.array_join("proof", ""), 256).alias("proof_sha256"),
        F.col("folded").alias("folded_root"),
        (F.col("folded") == F.lit(built.root)).alias("verified"),
        "position",
    )


ORACLES["op12_postorder_manifest"] = """
WITH RECURSIVE leaves AS (
  SELECT doc_id, source, crc % 5 = 0 AS tampered,
         sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         sha256(head || coalesce(strlen(low) || ':' || low, '-')) AS changed
  FROM (
    SELECT *, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
           coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
           || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
           xor(list_reduce(
             list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
             lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                                      lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295::BIGINT) AS crc
    FROM documents
  )
), placed AS (
  SELECT *, coalesce('=' || source, '') AS part, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS nth
  FROM leaves
), tree AS (
  SELECT part, 0 AS level, nth AS spot, leaf AS digest, count(*) OVER (PARTITION BY part) AS many FROM placed
  UNION ALL
  SELECT part, level + 1, spot // 16, sha256(string_agg(digest, '' ORDER BY spot)), (many + 15) // 16
  FROM tree WHERE many > 1 GROUP BY part, level, spot // 16, many
), ends AS (
  SELECT part, level, digest, row_number() OVER (ORDER BY part) - 1 AS nth FROM tree WHERE many = 1
), top AS (
  SELECT 0 AS level, nth AS spot, digest, count(*) OVER () AS many FROM ends
  UNION ALL
  SELECT level + 1, spot // 16, sha256(string_agg(digest, '' ORDER BY spot)), (many + 15) // 16
  FROM top WHERE many > 1 GROUP BY level, spot // 16, many
), steps AS (
  SELECT p.part, p.nth, t.level AS step,
         coalesce(string_agg(t.digest, '' ORDER BY t.spot) FILTER (t.spot < (p.nth >> (4 * t.level))), '') AS l,
         coalesce(string_agg(t.digest, '' ORDER BY t.spot) FILTER (t.spot > (p.nth >> (4 * t.level))), '') AS r
  FROM placed p JOIN tree t ON p.part = t.part AND t.many > 1 AND t.spot // 16 = (p.nth >> (4 * t.level + 4))
  GROUP BY p.part, p.nth, t.level
  UNION ALL
  SELECT p.part, p.nth, e.level + t.level,
         coalesce(string_agg(t.digest, '' ORDER BY t.spot) FILTER (t.spot < (e.nth >> (4 * t.level))), ''),
         coalesce(string_agg(t.digest, '' ORDER BY t.spot) FILTER (t.spot > (e.nth >> (4 * t.level))), '')
  FROM placed p JOIN ends e ON p.part = e.part JOIN top t ON t.many > 1 AND t.spot // 16 = (e.nth >> (4 * t.level + 4))
  GROUP BY p.part, p.nth, e.level, t.level
), folds AS (
  SELECT part, nth, 0 AS step, CASE WHEN tampered THEN changed ELSE leaf END AS digest FROM placed
  UNION ALL
  SELECT f.part, f.nth, f.step + 1, sha256(s.l || f.digest || s.r) FROM folds f JOIN steps s ON s.part = f.part AND s.nth = f.nth AND s.step = f.step
), paths AS (
  SELECT part, nth, count(*) AS many, sha256(string_agg(l || r, '' ORDER BY step)) AS proof_sha256 FROM steps GROUP BY part, nth
)
SELECT p.doc_id, p.leaf, e.digest AS subroot, t.digest AS root, coalesce(s.proof_sha256, sha256('')) AS proof_sha256,
       f.digest AS folded_root, f.digest = t.digest AS verified,
       (p.nth + p.nth // 16 + p.nth // 256 + p.nth // 4096 + p.nth // 65536 + p.nth // 1048576)::BIGINT AS position
FROM placed p JOIN ends e ON p.part = e.part JOIN top t ON t.many = 1
LEFT JOIN paths s ON s.part = p.part AND s.nth = p.nth
JOIN folds f ON f.part = p.part AND f.nth = p.nth AND f.step = coalesce(s.many, 0)
"""


@query
def op13_pair_bitmaps(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    aligned = alignment.align_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    return aligned.scored().withColumnRenamed("key", "doc_id")
