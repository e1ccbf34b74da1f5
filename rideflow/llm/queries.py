"""The registered queries of this subpackage and their DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rideflow.llm import (
    bpe_chunks,
    chat,
    decontaminate,
    licenses,
    mask_search,
    mixing,
    nn_descent,
    order_minhash,
    spelling,
    suffix_dedup,
    toxicity,
    url_reputation,
    warc,
)
from rideflow.session import scratch_path
from rideflow.sources import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


_WARC_SQL = """
WITH records AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), kept AS (
  SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) END AS keep FROM records
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN keep IS NOT NULL AND page_id IS DISTINCT FROM keep THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN keep IS NOT NULL AND page_id IS DISTINCT FROM keep THEN keep END AS refers_to
FROM kept
"""


@query("op1_warc_round_trip", _WARC_SQL)
def op1_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    archive = warc.write_warc(table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))
    records = warc.read_warc(archive.select("file", "n_bytes"), with_payload=False)
    return records.select(
        warc.page_of("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        warc.page_of("refers_to").alias("refers_to"),
    )


_MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS place
  FROM documents
), per_source AS (
  SELECT source, CAST(sum(size) AS HUGEINT) AS s, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rnk
  FROM sized GROUP BY source
), weighted AS (
  SELECT *, CASE rnk % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS w FROM per_source
), filling AS (
  SELECT *, s * 6 // w AS room, sum(s) OVER () AS total,
         coalesce(sum(s) OVER (ORDER BY s * 6 // w, rnk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS filled,
         sum(w) OVER (ORDER BY s * 6 // w, rnk ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rivals
  FROM weighted
), first_open AS (
  SELECT 3 * total - 4 * filled AS remaining, rivals, room, rnk FROM filling
  WHERE (3 * total - 4 * filled) * w < 4 * s * rivals ORDER BY room, rnk LIMIT 1
), targets AS (
  SELECT f.source, f.rnk, CAST(f.s AS BIGINT) AS s,
         CASE WHEN o.room IS NOT NULL AND (f.room, f.rnk) >= (o.room, o.rnk)
              THEN CAST(o.remaining * f.w AS DOUBLE) / CAST(o.rivals * 2 AS DOUBLE) ELSE CAST(2 * f.s AS DOUBLE) END AS target
  FROM filling f LEFT JOIN first_open o ON true
), placed AS (
  SELECT d.doc_id, d.size, t.s AS source_size, t.target, CAST(floor(t.target + 0.5) AS BIGINT) AS wanted,
         CAST(coalesce(sum(d.size) OVER (PARTITION BY t.rnk ORDER BY d.place, d.doc_id, d.size
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       CASE WHEN source_size = 0 THEN 0 ELSE CAST((wanted // source_size) * size
         + greatest(least(wanted % source_size - before, size), 0) AS BIGINT) END AS taken
FROM placed
"""


@query("op2_mix_sources", _MIX_SQL)
def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


URL_RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)

_HOST = r"translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PATH = r"regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1)"
_TWO = "(" + ", ".join(f"'{s}'" for s in url_reputation.TWO_LABEL_SUFFIXES) + ")"


def _level_sql(level: str, rows: str) -> str:
    """Prior strength of ``rows`` (n, bad, mean), as a one-row table."""
    return f"""{level} AS (
  SELECT coalesce(1.0 / greatest(least((seen - chance) / nullif(room, 0), 0.5), 1e-4) - 1.0, 1.0) AS s FROM (
    SELECT sum(n * pow(bad / n - mean, 2)) AS seen, sum(mean * (1 - mean)) AS chance, sum(mean * (1 - mean) * (n - 1)) AS room
    FROM {rows} WHERE n > 0))"""


_URL_SQL = f"""
WITH parsed AS (
  SELECT page_id, {_HOST} AS host, {_PATH} AS path FROM pages
), marks AS (
  SELECT doc_id, CASE WHEN toxic = 1 OR quality = 0 THEN 1 WHEN toxic IS NOT NULL OR quality IS NOT NULL THEN 0 END AS bad FROM labels
), hosts AS (
  SELECT host, CAST(count(bad) AS DOUBLE) AS n, CAST(coalesce(sum(bad), 0) AS DOUBLE) AS bad
  FROM (SELECT p.host, m.bad FROM parsed p LEFT JOIN marks m ON try_cast(regexp_extract(p.path, '/([0-9]+)', 1) AS BIGINT) = m.doc_id)
  GROUP BY host
), named AS (
  SELECT *, string_split(host, '.') AS parts,
         array_to_string(list_slice(string_split(host, '.'), -2, -1), '.') AS two FROM hosts
), leveled AS (
  SELECT host, n, bad, CASE WHEN two IN {_TWO} THEN array_to_string(list_slice(parts, -3, -1), '.') ELSE two END AS domain,
         CASE WHEN two IN {_TWO} THEN two ELSE parts[len(parts)] END AS suffix FROM named
), suffixes AS (
  SELECT suffix, sum(n) AS n, sum(bad) AS bad, (SELECT coalesce(sum(bad) / nullif(sum(n), 0), 0) FROM hosts) AS mean FROM leveled GROUP BY suffix
), {_level_sql("s1", "suffixes")}, domains AS (
  SELECT d.domain, d.suffix, d.n, d.bad, (s1.s * x.mean + x.bad) / (s1.s + x.n) AS mean
  FROM (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM leveled GROUP BY domain, suffix) d JOIN suffixes x ON d.suffix = x.suffix CROSS JOIN s1
), {_level_sql("s2", "domains")}, single AS (
  SELECT l.host, l.n, l.bad, (s2.s * d.mean + d.bad) / (s2.s + d.n) AS mean FROM leveled l JOIN domains d ON l.domain = d.domain CROSS JOIN s2
), {_level_sql("s3", "single")}, post AS (
  SELECT host, (s3.s * mean + bad) / (s3.s + n) AS p, s3.s + n AS mass FROM single CROSS JOIN s3
), verdicts AS (
  SELECT host, CASE WHEN p - 1.645 * sqrt(p * (1 - p) / (mass + 1)) > 0.25 THEN 'block' ELSE 'allow' END AS reputation FROM post
), ruled AS (
  SELECT p.page_id, p.host, p.path, v.reputation,
    CASE WHEN (p.host = 'www.example.com' OR p.host LIKE '%.www.example.com') AND p.path LIKE '/en/%' THEN 'www.example.com/en/'
         WHEN (p.host = 'example.com' OR p.host LIKE '%.example.com') AND p.path LIKE '/en/%' THEN 'example.com/en/'
         WHEN (p.host = 'net' OR p.host LIKE '%.net') AND p.path LIKE '/es/%' THEN 'net/es/'
         WHEN (p.host = 'net' OR p.host LIKE '%.net') AND p.path LIKE '/fr/%' THEN 'net/fr/'
         WHEN (p.host = 'com' OR p.host LIKE '%.com') AND p.path LIKE '/%' THEN 'com/' END AS rule
  FROM parsed p JOIN verdicts v ON p.host = v.host
)
SELECT page_id, host, path, rule,
  CASE WHEN rule IS NULL THEN reputation WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' ELSE 'block' END AS verdict
FROM ruled
"""


@query("op5_judge_urls", _URL_SQL)
def op5_judge_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    outcomes = url_reputation.page_outcomes(pages, table(spark, sf_dir, "labels"))
    judged = url_reputation.judge_urls(pages, outcomes, URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def _remainder(doc_id: str = "doc_id"):
    """The remainder that tells learning rows from held-out rows (1)."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), F.lit(3))


def toxicity_models(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.Models:
    """Models of the texts of ``docs``, learnt from no held-out label."""
    marks = table(spark, sf_dir, "labels").filter(_remainder() != 1).select("doc_id", "toxic")
    return toxicity.fit(docs, marks)


@query("op6_toxicity")
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity_models(spark, docs, sf_dir), carry=["doc_id"])
    return scored.select(
        "doc_id", (_remainder() == 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


@query("op10_chat_turns")
def op10_chat_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(chat.rough_transcripts(table(spark, sf_dir, "conversations")))


@query("op3_decontaminate")
def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = decontaminate.mark_leaks(docs, table(spark, sf_dir, "benchmark"), carry=["doc_id"])
    return marked.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")


@query("op7_license_scan")
def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.document_licenses(table(spark, sf_dir, "documents"))


@query("op9_near_duplicates")
def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op8_remove_repeats")
def op8_remove_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup.remove_repeats(docs, with_text=False, carry=["doc_id"])


@query("op4_nearest_neighbours")
def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nn_descent.nearest_neighbours(vectors, F.col("vec_id") % 100 == 0)


@query("op11_bpe_round_trip")
def op11_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        tokenizer_json = file.read()
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe_chunks.encode_documents(docs, tokenizer_json, outputs=["n_tokens", "ids_sha256", "decoded_sha256"])


_SEARCH_SQL = r"""
WITH words AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents
), sized AS (
  SELECT row, doc_id, CAST(len(terms) AS BIGINT) AS n, terms FROM words WHERE len(terms) > 0
), total AS (
  SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sized
), wanted AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), held AS (
  SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(terms) AS term FROM sized)
  WHERE term IN (SELECT term FROM wanted) GROUP BY row, term
), weighted AS (
  SELECT h.term, CAST(floor(1000 * ln((2.0 * any_value(t.docs) + 2.0) / (2.0 * count(*) + 1.0))) AS BIGINT) AS w
  FROM held h CROSS JOIN total t GROUP BY h.term
), scored AS (
  SELECT i.item_id, s.row, any_value(s.doc_id) AS doc_id,
         CAST(sum(w.w * ((1000000000 * h.tf) // (1000 * h.tf + 8 * (10 + (90 * s.n * t.docs) // t.terms)))) AS BIGINT) AS score
  FROM held h JOIN weighted w ON h.term = w.term JOIN sized s ON h.row = s.row JOIN wanted i ON h.term = i.term CROSS JOIN total t
  GROUP BY i.item_id, s.row
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""


@query("op12_rank_documents", _SEARCH_SQL)
def op12_rank_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mask_search.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op13_spelling_variants")
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))
