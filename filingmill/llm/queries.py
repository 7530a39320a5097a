"""The corpus operators applied to the driver's tables, one query each, and their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers
from filingmill.llm import alignment, collocations, decontaminate, hyperminhash, main_text, mixing, quality, sharding, simhash, sketch, token_count, token_file, warc

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")
QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.fingerprint_hex(F.col("code")).alias("fingerprint"), "component_id")


@query
def op8_token_id_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_file.token_table(table(spark, sf_dir, "documents"), BYTE_BPE)


@query
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.token_counts(table(spark, sf_dir, "documents"), BYTE_BPE)


@query
def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("items")


SQL["op4_benchmark_decontamination"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents
), i AS (
  SELECT item_id::VARCHAR AS item_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), starts AS (
  SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS s FROM i WHERE len(w) > 0
), windows AS (
  SELECT DISTINCT item_id, n, array_to_string(list_slice(w, s, s + n - 1), ' ') AS k FROM starts
), sizes AS (
  SELECT DISTINCT n FROM windows
), places AS (
  SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, sizes WHERE len(w) >= n
), found AS (
  SELECT r, s, p.n, item_id FROM (SELECT r, s, n, array_to_string(list_slice(w, s, s + n - 1), ' ') AS k FROM places) p JOIN windows v ON v.n = p.n AND v.k = p.k
), hit AS (
  SELECT r, count(DISTINCT x) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS x FROM found) GROUP BY r
), named AS (
  SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items FROM (SELECT DISTINCT r, item_id FROM found) GROUP BY r
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN named USING (r)
"""


@query
def op2_quality_bradley_terry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op6_hash_tree_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(table(spark, sf_dir, "documents"), 8)


@query
def op7_bottom_k_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketch.compared(table(spark, sf_dir, "documents"))


def family(source: Column) -> Column:
    """The documents' tables name no domain: sources fall into four families by checksum."""
    return F.concat(F.lit("family"), (F.crc32(F.coalesce(source, F.lit("")).cast("binary")) % 4).cast("string"))


#: Target weights among the languages of a family; others weigh 1. Families weigh by their number, sources are even.
LANGUAGE_WEIGHTS = {"en": 4.0, "de": 2.0, "fr": 2.0, "es": 1.0}


def target_weight(path: tuple[str, ...]) -> float:
    """The weight of a domain, language or source among its siblings."""
    if len(path) == 1:
        return 1.0 + int(path[0][-1])
    return LANGUAGE_WEIGHTS.get(path[1], 1.0) if len(path) == 2 else 1.0


@query
def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.selected(table(spark, sf_dir, "documents"), family(F.col("source")), target_weight, max_epochs=2)


@query
def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extracted(table(spark, sf_dir, "pages"))


@query
def op1_warc_normaliser(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.archived(table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL["op1_warc_normaliser"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
g AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS payload_digest, max(page_id) OVER (PARTITION BY sha1(html)) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM g
"""


@query
def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


SQL["op13_phrase_collocations"] = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), w AS (
  SELECT row_number() OVER () AS p, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), words AS (
  SELECT p, lang, unnest(w) AS w1, unnest(range(1, len(w) + 1)) AS s FROM w
), following AS (
  SELECT lang, w1, lead(w1, 1) OVER o AS w2, lead(w1, 2) OVER o AS w3 FROM words WINDOW o AS (PARTITION BY p ORDER BY s)
), grams AS (
  SELECT lang, 1 AS k, w1 AS phrase FROM following
  UNION ALL SELECT lang, 2, w1 || ' ' || w2 FROM following WHERE w2 IS NOT NULL
  UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3 FROM following WHERE w3 IS NOT NULL
), f AS (
  SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL
), n AS (
  SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang
), cand AS (
  SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 10
), cuts AS (
  SELECT lang, k, phrase, a, w, unnest(range(1, k)) AS cut FROM cand
), scored AS (
  SELECT c.lang, c.k, c.phrase, a, cut, x.f AS l, y.f AS r, (1000000::HUGEINT * a * a // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(list_slice(w, 1, cut), ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(list_slice(w, cut + 1, c.k), ' ')
), lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), inner_ AS (
  SELECT lang, phrase, max(a) AS within
  FROM (SELECT lang, a, unnest([array_to_string(list_slice(w, 1, 2), ' '), array_to_string(list_slice(w, 2, 3), ' ')]) AS phrase FROM cand WHERE k = 3) GROUP BY ALL
), kept AS (
  SELECT s.* FROM lowest s LEFT JOIN inner_ i USING (lang, phrase) WHERE i.within IS NULL OR 100 * i.within < 50 * s.a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN n USING (lang) QUALIFY rank <= 2000
"""


@query
def op11_hyperminhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hyperminhash.near_duplicates(table(spark, sf_dir, "documents"))


SQL["op11_hyperminhash_near_dedup"] = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w
  FROM documents
), words AS (
  SELECT r, len(w) AS m, unnest(w) AS w1, unnest(range(1, len(w) + 1)) AS s FROM d
), following AS (
  SELECT r, m, s, w1, lead(w1, 1) OVER o AS w2, lead(w1, 2) OVER o AS w3, lead(w1, 3) OVER o AS w4, lead(w1, 4) OVER o AS w5 FROM words WINDOW o AS (PARTITION BY r ORDER BY s)
), shingles AS (
  SELECT DISTINCT r, concat_ws(' ', w1, w2, w3, w4, w5) AS k FROM following WHERE s = 1 OR s <= m - 4
), n AS (
  SELECT r, count(*) AS n FROM shingles GROUP BY r
), common AS (
  SELECT x.r AS a, y.r AS b, count(*) AS c FROM shingles x JOIN shingles y ON x.k = y.k AND x.r < y.r GROUP BY ALL
), links AS (
  SELECT a, b FROM common JOIN n x ON x.r = a JOIN n y ON y.r = b WHERE 100 * c >= 85 * (x.n + y.n - c)
), both_ways AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reached AS (
  SELECT r AS a, r AS b FROM d
  UNION
  SELECT reached.a, both_ways.b FROM reached JOIN both_ways ON reached.b = both_ways.a
), classes AS (
  SELECT a AS r, min(doc_id) AS component_id FROM reached JOIN d ON d.r = b GROUP BY a
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, coalesce(doc_id = component_id, false) AS kept
FROM d JOIN classes USING (r) LEFT JOIN n USING (r)
"""


@query
def op12_dangling_suffix_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignments(table(spark, sf_dir, "documents"), BYTE_BPE, PIECE_BPE)
