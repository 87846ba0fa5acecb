"""The queries of this subpackage over the given tables, and SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradloom.llm.hyperminhash import near_duplicates
from gradloom.llm.jaccard import link_components
from gradloom.llm.licenses import scan_licenses
from gradloom.llm.neighbours import nearest_neighbours
from gradloom.llm.numbering import number_in_groups
from gradloom.llm.packing import packed_documents
from gradloom.llm.phrases import collocations
from gradloom.llm.pieces import round_trip
from gradloom.llm.pii import find_personal_data, span_list
from gradloom.llm.quality import MEASURES, fit_line_field, judge_quality
from gradloom.llm.sharding import shard_rows, shard_tree
from gradloom.llm.urls import filter_urls
from gradloom.llm.warc import mark_revisits, read_warc, write_warc
from gradloom.llm.whitening import whiten
from gradloom.session import scratch_path

SHARDS = 8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_weighted_hash_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards 0 to 7 of all documents by the key law; slots number each shard without gaps."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(text).alias("text_crc32"), F.lit("key").alias("law")
    )
    placed = shard_rows(docs, "doc_id", shard_tree(SHARDS), "shard")
    placed = shard_rows(placed, "doc_id", shard_tree(SHARDS, added=1), "grown_shard")
    return number_in_groups(placed, "shard", "slot").select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )


def op2_shortest_pack_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as pieces of sequences of 1024 tokens."""
    return packed_documents(table(spark, sf_dir, "documents"))


def op3_sampled_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sampled segmentation of every document, and whether decoding gives the text back."""
    return round_trip(table(spark, sf_dir, "documents"))


def op4_jaccard_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose three-word shingles overlap by 90 of 100 or more."""
    return link_components(table(spark, sf_dir, "documents"))


def op5_patience_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices in all documents, with the words they cover."""
    return scan_licenses(table(spark, sf_dir, "documents"))


def op6_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC records and read back by byte ranges."""
    archive = scratch_path(spark, "warc")
    write_warc(mark_revisits(table(spark, sf_dir, "pages")), archive)
    return read_warc(spark, archive).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url judged by host rules and pattern rules."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return filter_urls(pages).select("page_id", "host", "path", "rule", "verdict")


def op8_context_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base matches and what contexts add, for every document."""
    return find_personal_data(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", span_list(F.col("spans")).alias("spans")
    )


def op9_inverted_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors found for every fiftieth vec_id."""
    return nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op10_line_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base measures and the line field's verdict for every document."""
    docs = table(spark, sf_dir, "documents")
    field = fit_line_field(docs, table(spark, sf_dir, "labels"))
    return judge_quality(docs.select("doc_id", "text"), field).select("doc_id", *MEASURES, "base_failed", "kept", "content_share")


def op11_suffix_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's phrases of two to four words, by the share of their parts' occurrences."""
    return collocations(table(spark, sf_dir, "documents"))


def op12_cholesky_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings on the first four whitened components."""
    return whiten(table(spark, sf_dir, "embeddings"))


def op13_hyperminhash_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose four-word shingles overlap by 80 of 100 or more, and which document stays."""
    return near_duplicates(table(spark, sf_dir, "documents"))


QUERIES = [
    op1_weighted_hash_tree, op2_shortest_pack_first, op3_sampled_pieces, op4_jaccard_components, op5_patience_licenses,
    op6_warc_round_trip, op7_url_filter, op8_context_bootstrap, op9_inverted_multi_index, op10_line_field,
    op11_suffix_collocations, op12_cholesky_whitening, op13_hyperminhash_duplicates,
]

# Components of documents whose distinct shingles overlap enough: all pairs that share a shingle, then reachability.
LINKED = r"""
WITH RECURSIVE texts AS (
  SELECT row_number() OVER () AS id, doc_id,
         list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
           lambda w: w <> '') AS ws
  FROM documents),
words AS (
  SELECT id, w, {following} FROM (SELECT id, unnest(ws) AS w, generate_subscripts(ws, 1) AS pos FROM texts)),
shingles AS (
  SELECT DISTINCT id, {shingle} AS s FROM words WHERE w{width} IS NOT NULL
  UNION ALL SELECT id, array_to_string(ws, ' ') FROM texts WHERE len(ws) BETWEEN 1 AND {width} - 1),
sizes AS (SELECT id, count(*) AS n FROM shingles GROUP BY id),
shared AS (
  SELECT a.id AS a, b.id AS b, count(*) AS o FROM shingles a JOIN shingles b ON a.s = b.s AND a.id < b.id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.id = a JOIN sizes y ON y.id = b WHERE 100 * o >= {percent} * (x.n + y.n - o)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT DISTINCT a AS id, a AS other FROM edges
  UNION SELECT reach.id, edges.b FROM reach JOIN edges ON edges.a = reach.other),
lowest AS (SELECT reach.id, min(doc_id) AS component_id FROM reach JOIN texts ON texts.id = reach.other GROUP BY reach.id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, doc_id) AS component_id{more}
FROM texts LEFT JOIN sizes USING (id) LEFT JOIN lowest USING (id)"""


def linked_sql(width: int, percent: int, more: str = "") -> str:
    following = ", ".join(f"lead(w, {k}) OVER (PARTITION BY id ORDER BY pos) AS w{k + 1}" for k in range(1, width))
    shingle = " || ' ' || ".join(["w", *(f"w{k}" for k in range(2, width + 1))])
    return LINKED.format(following=following, shingle=shingle, width=width, percent=percent, more=more)


SQL = {
    "op4_jaccard_components": linked_sql(3, 90),
    "op13_hyperminhash_duplicates": linked_sql(4, 80, ", doc_id IS NOT DISTINCT FROM coalesce(component_id, doc_id) AS kept"),
    "op11_suffix_collocations": r"""
WITH texts AS (
  SELECT coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
pieces AS (
  SELECT row_number() OVER () AS id, lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS ws
  FROM (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM texts)),
words AS (
  SELECT lang, w AS w1, lead(w, 1) OVER (PARTITION BY id ORDER BY pos) AS w2,
         lead(w, 2) OVER (PARTITION BY id ORDER BY pos) AS w3, lead(w, 3) OVER (PARTITION BY id ORDER BY pos) AS w4
  FROM (SELECT id, lang, unnest(ws) AS w, generate_subscripts(ws, 1) AS pos FROM pieces)),
grams AS (
  SELECT lang, 1 AS k, w1 AS phrase, count(*) AS f FROM words GROUP BY ALL
  UNION ALL SELECT lang, 2, w1 || ' ' || w2, count(*) FROM words WHERE w2 IS NOT NULL GROUP BY ALL
  UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3, count(*) FROM words WHERE w3 IS NOT NULL GROUP BY ALL
  UNION ALL SELECT lang, 4, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4, count(*) FROM words WHERE w4 IS NOT NULL GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM grams WHERE k = 1 GROUP BY lang),
phrases AS (SELECT lang, k AS size, phrase, string_split(phrase, ' ') AS ws, f AS a FROM grams WHERE k > 1 AND f >= 30),
cuts AS (
  SELECT p.lang, p.size, p.phrase, p.a, c.k, x.f AS l, y.f AS r,
         ((2000000::HUGEINT * p.a) // (x.f::HUGEINT + y.f))::BIGINT AS score
  FROM phrases p JOIN (SELECT unnest([1, 2, 3]) AS k) c ON c.k < p.size
  JOIN grams x ON x.lang = p.lang AND x.k = c.k AND x.phrase = array_to_string(list_slice(p.ws, 1, c.k), ' ')
  JOIN grams y ON y.lang = p.lang AND y.k = p.size - c.k AND y.phrase = array_to_string(list_slice(p.ws, c.k + 1, p.size), ' ')),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_phrases AS (
  SELECT lang, array_to_string(list_slice(ws, i, i + k - 1), ' ') AS phrase, max(a) AS around
  FROM (SELECT lang, ws, a, k, unnest(generate_series(1, size - k + 1)) AS i
        FROM phrases JOIN (SELECT unnest([2, 3]) AS k) ON k < size)
  GROUP BY ALL),
kept AS (
  SELECT b.* FROM best b LEFT JOIN inner_phrases i ON i.lang = b.lang AND i.phrase = b.phrase
  WHERE i.around IS NULL OR 100::HUGEINT * i.around < 80::HUGEINT * b.a),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase ASC) AS rank FROM kept)
SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, t.n, r.score
FROM ranked r JOIN totals t ON t.lang = r.lang WHERE r.rank <= 2000""",
    "op7_url_filter": r"""
WITH known AS (
  SELECT page_id, url,
         translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)([^?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '://([^/?#]*)([^?#]*)', 2) AS path,
         translate(url, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lowered
  FROM pages),
ruled AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM known)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow'
            WHEN rule IS NOT NULL THEN 'block'
            WHEN regexp_matches(lowered, '[/.]login([/.?#]|$)') OR regexp_matches(lowered, '[/.]signin([/.?#]|$)')
              OR regexp_matches(lowered, '/cart([/?#]|$)') OR regexp_matches(lowered, '[?&;]phpsessid=[0-9a-f]{8,}')
              OR regexp_matches(lowered, '/search/?\?q=') OR regexp_matches(lowered, '/calendar/[0-9]{4}/[0-9]{2}')
            THEN 'block' ELSE 'allow' END AS verdict
FROM ruled""",
}
