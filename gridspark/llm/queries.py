"""The registered queries of this subpackage and their DuckDB SQL."""
from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import collocations, decontam, langid, licenses, mixing, periodic, pieces, quality, simhash, token_bin, topk, url_filter, warc


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_quality_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"), "doc_id", "lang", "text")
    return judged.withColumnRenamed("id", "doc_id").drop("h")


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.plan_mix(_read(spark, sf_dir, "documents"), "doc_id", "text", "source")
    return mixing.taken_words(mix, "doc_id")


def op3_license_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(_read(spark, sf_dir, "documents"), "doc_id", "text")
    return found.drop("matches")


def op4_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = topk.scaled(_read(spark, sf_dir, "embeddings"), "vec_id", "embedding", 256.0)
    return topk.top_k(rows, rows.filter(F.col("id") % 50 == 0), 5)


def op5_simhash_gph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_read(spark, sf_dir, "documents"), "doc_id", "text", shingle=4, max_bits=4).drop("root")


def op6_warc_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, manifest = warc.write_archives(_read(spark, sf_dir, "pages"), "page_id", "url", "html")
    captures = warc.captures_of_pages(warc.assemble(warc.read_records(spark, root, manifest)))
    return captures.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_token_elias_fano(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens_of(spark, _read(spark, sf_dir, "documents"))


def tokens_of(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Write the token files of documents and read them back."""
    import public_tokenizers
    root, manifest = token_bin.write_tokens(docs, "doc_id", "text", public_tokenizers.path("byte_bpe_50k.json"),
                                            end_id=2, vocabulary=50_257)
    return token_bin.read_tokens(spark, root, manifest, "doc_id")


def op8_url_digest_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(url_filter.RULES, "host string, path string, action string")
    return url_filter.filter_urls(_read(spark, sf_dir, "pages"), url_filter.build_index(rules), "page_id", "url")


def op9_decontaminate_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = decontam.build_index(_read(spark, sf_dir, "benchmark"), "item_id", "text")
    return decontam.find_contaminated(_read(spark, sf_dir, "documents"), index, "doc_id", "text")


def op10_lang_zstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    learned = docs.filter(~held_out & F.col("lang").isNotNull())
    dicts = langid.train(learned, "text", "lang", ["doc_id"])
    rows = docs.withColumn("held_out", F.coalesce(held_out, F.lit(False)))
    return langid.predict(rows, dicts, "text", ["doc_id", "held_out"])


def op11_toivonen_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_read(spark, sf_dir, "documents"), "doc_id", "lang", "text")


def op12_sentencepiece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    coded = pieces.encode_pieces(_read(spark, sf_dir, "documents"), "doc_id", "text",
                                 public_tokenizers.path("piece_bpe_32k.model"), end_id=2)
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return coded.select(F.col("id").alias("doc_id"), "n_tokens", F.sha2(ids, 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


def _tails(ids: list[int | None], first: np.ndarray) -> np.ndarray:
    """The periodic tails of the contract: which word each place of the documents reads."""
    at = np.arange(first[-1])
    for i, doc_id in enumerate(ids):
        n, h = int(first[i + 1] - first[i]), zlib.crc32(str(doc_id).encode())
        if doc_id is not None and n and h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            at[first[i] + a:first[i + 1]] = first[i] + a + np.arange(n - a) % p
    return at


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.periodic_runs(_read(spark, sf_dir, "documents"), "doc_id", "text", 12, _tails)
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r.length, (-r.start).alias("s"), (-r.period).alias("p"), r.start, r.period)))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n")))
    return found.withColumn("best", longest).select(
        F.col("id").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


QUERIES = {
    "op1_quality_kneser_ney": op1_quality_kneser_ney,
    "op2_mix_sources": op2_mix_sources,
    "op3_license_templates": op3_license_templates,
    "op4_exact_topk": op4_exact_topk,
    "op5_simhash_gph": op5_simhash_gph,
    "op6_warc_transactions": op6_warc_transactions,
    "op7_token_elias_fano": op7_token_elias_fano,
    "op8_url_digest_filter": op8_url_digest_filter,
    "op9_decontaminate_minhash": op9_decontaminate_minhash,
    "op10_lang_zstd": op10_lang_zstd,
    "op11_toivonen_collocations": op11_toivonen_collocations,
    "op12_sentencepiece_bpe": op12_sentencepiece_bpe,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLE: dict[str, str] = {}

ORACLE["op4_exact_topk"] = """
WITH v AS (
  SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) for x in embedding] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

ORACLE["op8_url_digest_filter"] = """
WITH u AS (
  SELECT page_id, CASE WHEN contains(url, '://')
    THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^?#]*') ELSE '' END AS rest FROM pages
), p AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(substr(rest, len(regexp_extract(rest, '^[^/]*')) + 1), '') AS path FROM u
), rules(h, p, action) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), m AS (
  SELECT page_id, max_by(h || rules.p, len(h || rules.p)) AS rule, max_by(action, len(h || rules.p)) AS action
  FROM p JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, rules.p) GROUP BY page_id
)
SELECT page_id, coalesce(host, '') AS host, path, rule, coalesce(action, 'allow') AS verdict FROM p LEFT JOIN m USING (page_id)
"""

ORACLE["op6_warc_transactions"] = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), w AS (
  SELECT payload_digest, max(page_id) AS target FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN target <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN target <> page_id THEN target END AS refers_to
FROM p LEFT JOIN w USING (payload_digest)
"""

# distinct five-word shingles (fewer words: the whole sequence) of a table's texts
_SHINGLES = """SELECT DISTINCT {key}, unnest([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, greatest(len(w) - 4, 1) + 1)]) AS s
  FROM (SELECT {key}, regexp_extract_all(lower(coalesce(text, '')), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM {table})
  WHERE len(w) > 0"""

ORACLE["op9_decontaminate_minhash"] = f"""
WITH d AS ({_SHINGLES.format(key="doc_id", table="documents")}),
b AS ({_SHINGLES.format(key="item_id", table="benchmark")}),
n AS (SELECT item_id, count(*) AS n_shingles FROM b GROUP BY item_id),
m AS (SELECT doc_id, item_id, count(*) AS n_shared FROM b JOIN d USING (s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n_shared, n_shingles, n_shared / n_shingles AS containment
FROM m JOIN n USING (item_id) WHERE n_shared >= 0.8 * n_shingles
"""

ORACLE["op11_toivonen_collocations"] = r"""
WITH p AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents)
), n AS (SELECT lang, CAST(sum(len(w)) AS HUGEINT) AS n FROM p GROUP BY lang
), g AS (
  SELECT lang, k, unnest([array_to_string(w[i:i + k - 1], ' ') FOR i IN range(1, len(w) - k + 2)]) AS phrase
  FROM p, (SELECT unnest([1, 2, 3, 4, 5]) AS k)
), f AS (SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= 100
), c AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE k > 1
), x AS (
  SELECT lang, a, unnest([array_to_string(w[i:i + m - 1], ' ') FOR i IN range(1, k - m + 2)]) AS phrase
  FROM c, (SELECT unnest([2, 3, 4]) AS m) WHERE m < k
), o AS (
  SELECT * FROM c WHERE NOT EXISTS (
    SELECT 1 FROM x WHERE x.lang = c.lang AND x.phrase = c.phrase AND 100 * x.a >= 100 * c.a)
), s AS (
  SELECT lang, phrase, a, unnest(range(1, k)) AS cut, w, k FROM o
), t AS (
  SELECT s.lang, s.phrase, s.a, cut, l.a AS l, r.a AS r, n.n, (CAST(1000 AS HUGEINT) * s.a * n.n) // (CAST(l.a AS HUGEINT) * r.a) AS score
  FROM s JOIN f l ON l.lang = s.lang AND l.phrase = array_to_string(s.w[1:cut], ' ')
  JOIN f r ON r.lang = s.lang AND r.phrase = array_to_string(s.w[cut + 1:s.k], ' ') JOIN n ON n.lang = s.lang
), b AS (
  SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS nth FROM t
), q AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r,
         CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM b WHERE nth = 1
)
SELECT * FROM q WHERE rank <= 2000
"""
