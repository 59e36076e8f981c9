"""One registered query for each operator of this package, and its SQL twin where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from textmill.llm import ann, bpe, conversations, hard_negatives, html_extract, mixing, ngram_join, quality, suffix_dedup, token_files, url_lists, vector_file, warc

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
TWINS: dict[str, str] = {}

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            TWINS[name] = sql
        return function

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op10_bpe")
def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode_bpe(docs, BYTE_BPE, decoded="decoded")
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


@query("op5_quality_rules")
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return quality.add_quality(docs, BYTE_BPE, PIECE_BPE).drop("text", "lang")


@query("op6_token_files")
def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    read = token_files.read_token_files(token_files.write_token_files(docs, BYTE_BPE))
    return read.select(F.col("id").alias("doc_id"), "start", "n_tokens", F.crc32("tokens").alias("ids_crc32"))


@query("op9_mix_sources")
def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    mixed = mixing.mix_sources(docs)
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


@query(
    "op4_warc_members",
    r"""WITH payloads AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
digests AS (
  SELECT page_id, strlen(payload) AS payload_bytes, sha1(payload) AS hex, min(page_id) OVER (PARTITION BY payload) AS first FROM payloads),
parts AS (
  SELECT *, list_transform(range(8), lambda i: CAST('0x' || substr(hex, CAST(1 + 5 * i AS BIGINT), 5) AS INTEGER)) AS twenties FROM digests)
SELECT page_id, payload_bytes, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to,
  array_to_string(list_transform(twenties, lambda v: array_to_string(list_transform([15, 10, 5, 0],
    lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((v >> s) & 31), 1)), '')), '') AS payload_digest
FROM parts""",
)
def op4_warc_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives, folder = warc.archive_pages(table(spark, sf_dir, "pages"))
    read = warc.read_archives(archives, folder).withColumnRenamed("key", "page_id")
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op2_html_text")
def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = html_extract.extract_main_text(table(spark, sf_dir, "pages"))
    return pages.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query(
    "op1_ngram_join",
    r"""WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i : i + 3], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE CAST([] AS VARCHAR[]) END) AS s FROM words),
sizes AS (SELECT doc_id, len(s) AS n FROM sets),
flat AS (SELECT doc_id, unnest(s) AS shingle FROM sets),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS m FROM flat a JOIN flat b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * m >= 85 * (x.n + y.n - m)),
twoway AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(doc_id, other) AS (SELECT a, b FROM twoway UNION SELECT r.doc_id, l.b FROM reach r JOIN twoway l ON l.a = r.other),
least AS (SELECT doc_id, min(other) AS other FROM reach GROUP BY doc_id)
SELECT sizes.doc_id, n AS n_shingles, least(sizes.doc_id, coalesce(other, sizes.doc_id)) AS component_id
FROM sizes LEFT JOIN least ON least.doc_id = sizes.doc_id""",
)
def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.link_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op7_suffix_dedup")
def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    # Most passages of a little over 50 words have under 400 bytes: they stay in the kept bytes and are cut in ``cut_text``.
    out = suffix_dedup.remove_repeats(docs, gram=64, passages=(200, 50))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), "kept_text", "n_passages", "cut_text")


@query("op8_permutation_index")
def op8_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


# Captures are the pages, fetched on a day that their id gives. The lists hold hosts, domains and
# sections of the pages' own URLs; the digest of each pattern decides when it comes and goes.
FETCHED = "date_add(DATE'2024-01-01', CAST(page_id * 37 % 365 AS INT))"


def list_entries(pages: DataFrame) -> DataFrame:
    host = url_lists.url_host(F.col("url"))
    domain = F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1)
    section = F.concat(host, F.lit("/"), F.regexp_extract("url", "^[a-z]+://[^/]+/([^/?#]+)/", 1))
    named = F.array(*[F.struct(F.lit(n).alias("list"), p.alias("pattern")) for n, p in (("hosts", host), ("domains", domain), ("sections", section))])
    patterns = pages.select(F.inline(named)).distinct()
    number = lambda at: F.conv(F.substring(F.md5("pattern"), at, 4), 16, 10).cast("int")
    begin = F.date_add(F.lit("2024-01-01").cast("date"), number(1) % 200)
    end = F.date_add(begin, 10 + number(5) % 90)
    again = F.date_add(end, 10 + number(9) % 90)
    events = F.array(
        F.struct(F.lit("add").alias("action"), begin.alias("at")),
        F.struct(F.lit("remove").alias("action"), F.when(number(13) % 4 > 0, end).alias("at")),
        F.struct(F.lit("add").alias("action"), F.when(number(13) % 4 == 3, again).alias("at")),
    )
    listed = patterns.filter((F.col("list") == "domains") | (number(17) % 2 == 0))
    return listed.select("list", "pattern", F.inline(events)).filter("at IS NOT NULL")


@query(
    "op3_url_lists",
    r"""WITH hosts AS (
  SELECT page_id, url, lower(regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1)) AS host,
    '/' || regexp_extract(url, '^[a-z]+://[^/?#]+/([^?#]*)', 1) AS path,
    DATE '2024-01-01' + CAST(page_id * 37 % 365 AS INTEGER) AS fetched_at FROM pages),
patterns AS (
  SELECT 'hosts' AS list, host AS pattern FROM hosts UNION
  SELECT 'domains', regexp_extract(host, '([^.]+\.[^.]+)$', 1) FROM hosts UNION
  SELECT 'sections', host || '/' || regexp_extract(url, '^[a-z]+://[^/]+/([^/?#]+)/', 1) FROM hosts),
numbers AS (
  SELECT list, pattern, CAST('0x' || substr(md5(pattern), 1, 4) AS INTEGER) AS a, CAST('0x' || substr(md5(pattern), 5, 4) AS INTEGER) AS b,
    CAST('0x' || substr(md5(pattern), 9, 4) AS INTEGER) AS c, CAST('0x' || substr(md5(pattern), 13, 4) AS INTEGER) % 4 AS kind,
    CAST('0x' || substr(md5(pattern), 17, 4) AS INTEGER) % 2 AS side FROM patterns),
spans AS (
  SELECT *, DATE '2024-01-01' + a % 200 AS d1, DATE '2024-01-01' + a % 200 + 10 + b % 90 AS d2,
    DATE '2024-01-01' + a % 200 + 10 + b % 90 + 10 + c % 90 AS d3 FROM numbers WHERE list = 'domains' OR side = 0),
active AS (
  SELECT page_id, list, rtrim(pattern, '/') AS pattern FROM hosts JOIN spans
  ON (host = rtrim(pattern, '/') OR host LIKE '%.' || pattern OR host || rtrim(path, '/') || '/' LIKE rtrim(pattern, '/') || '/%')
  AND ((fetched_at >= d1 AND (kind = 0 OR fetched_at < d2)) OR (kind = 3 AND fetched_at >= d3))),
found AS (
  SELECT page_id, string_agg(DISTINCT list, ',' ORDER BY list) AS lists, arg_min(pattern, (-length(pattern), pattern)) AS pattern
  FROM active GROUP BY page_id)
SELECT page_id, url, CAST(fetched_at AS DATE) AS fetched_at, lists IS NOT NULL AS blocked, coalesce(lists, '') AS lists, pattern
FROM hosts LEFT JOIN found USING (page_id)""",
)
def op3_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    captures = pages.withColumn("fetched_at", F.expr(FETCHED))
    return url_lists.evaluate_captures(captures, list_entries(pages)).withColumn("lists", F.array_join("lists", ","))


def damaged(rows: DataFrame) -> DataFrame:
    """Conversation rows with the faults that a checksum of their place gives them."""
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    case = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn"))) % 20
    text = F.when(case == 1, "").when(case == 2, F.translate(shown("text"), ".!?", "")).otherwise(shown("text"))
    role = F.when(case == 4, "user").otherwise(shown("role"))
    times = F.array_repeat(F.lit(0), F.when(case == 0, 0).when(case == 3, 2).otherwise(1))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("_copy")).drop("_copy")


# The damage, then a step for each row with the cheapest audit that ends in each of the four states;
# a pair of cost and audit compares by cost and then by the audit's bytes.
_CRC = """list_reduce(list_concat([4294967295::BIGINT], list_transform(range(strlen(name)), lambda i: ascii(substr(name, CAST(i + 1 AS BIGINT), 1))::BIGINT)),
    lambda c, b: list_reduce([xor(c, b), 1, 2, 3, 4, 5, 6, 7, 8], lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END))"""


def _least(*ways: str) -> str:
    """The least of several pairs of which some are null."""
    return f"list_min(list_filter([{', '.join(ways)}], lambda x: x IS NOT NULL))"


def _step(state: str, cost: str, edit: str, when: str = "true") -> str:
    return f"CASE WHEN {state} IS NOT NULL AND {when} THEN {{'c': {state}.c + {cost}, 'a': {state}.a || '{edit}'}} END"


_REPAIR = f"""WITH RECURSIVE plain AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name FROM conversations),
cases AS (SELECT *, xor({_CRC}, 4294967295) % 20 AS k FROM plain),
bad AS (
  SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN k = 1 THEN '' WHEN k = 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(CASE WHEN k = 3 THEN 2 ELSE 1 END)) AS copy
  FROM cases WHERE k <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body FROM bad),
rows AS (
  SELECT *, CASE WHEN substr(role, 1, 1) IN ('s', 'u', 'a') THEN substr(role, 1, 1) ELSE 'x' END AS r,
    CASE WHEN body = '' THEN 'blank' WHEN seen > 1 THEN 'old' WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'cut' ELSE 'whole' END AS kind FROM placed),
stats AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (kind = 'blank') AS blank,
    count(*) FILTER (kind = 'old') AS duplicate, count(*) FILTER (kind = 'cut') AS truncated, max(i) AS n FROM rows GROUP BY conv_id),
pairs AS (
  SELECT conv_id, count(*) FILTER (two IS NOT NULL AND two NOT IN ('su', 'ua', 'au')) AS illegal FROM (
    SELECT conv_id, r || lead(r) OVER (PARTITION BY conv_id ORDER BY i) AS two FROM rows) GROUP BY conv_id),
walk AS (
  SELECT conv_id, 0::BIGINT AS i, {{'c': 0::BIGINT, 'a': ''}} AS s0, CAST(NULL AS STRUCT(c BIGINT, a VARCHAR)) AS s1,
    {{'c': 2::BIGINT, 'a': 'I'}} AS s2, {{'c': 4::BIGINT, 'a': 'II'}} AS s3 FROM (SELECT DISTINCT conv_id FROM rows)
  UNION ALL
  SELECT conv_id, i, s0, s1, u2, {_least("s3", _step("u2", "2", "I"))} FROM (
    SELECT *, {_least("s2", _step("s0", "2", "I"), _step("s1", "2", "I"), _step("s3", "2", "I"))} AS u2 FROM (
      SELECT w.conv_id, t.i, {_step("s0", "3", "D")} AS s0,
        {_least(_step("s1", "3", "D"), _step("s0", "x", "K", "ok AND r = 's'"))} AS s1,
        {_least(_step("s2", "3", "D"), *(_step(s, "x", "K", "ok AND r = 'u'") for s in ("s0", "s1", "s3")), *(_step(s, "x + 2", "R", "ok") for s in ("s0", "s1", "s3")))} AS s2,
        {_least(_step("s3", "3", "D"), _step("s2", "x", "K", "ok AND r = 'a'"), _step("s2", "x + 2", "R", "ok"))} AS s3
      FROM walk w JOIN (SELECT *, kind IN ('cut', 'whole') AS ok, CASE WHEN kind = 'cut' THEN 1::BIGINT ELSE 0::BIGINT END AS x FROM rows) t
        ON t.conv_id IS NOT DISTINCT FROM w.conv_id AND t.i = w.i + 1))),
done AS (
  SELECT w.conv_id, {_least("s0", "s3")} AS best FROM walk w JOIN stats s ON s.conv_id IS NOT DISTINCT FROM w.conv_id AND s.n = w.i),
letters AS (SELECT conv_id, best.a AS a, unnest(range(strlen(best.a))) + 1 AS p FROM done),
marks AS (
  SELECT conv_id, p, substr(a, CAST(p AS BIGINT), 1) AS e,
    count(*) FILTER (substr(a, CAST(p AS BIGINT), 1) <> 'I') OVER (PARTITION BY conv_id ORDER BY p) AS i FROM letters),
kept AS (
  SELECT m.conv_id, m.p, m.e, CASE WHEN m.e <> 'I' THEN t.role END AS role, CASE WHEN m.e = 'I' THEN '' ELSE t.text END AS text, t.r,
    m.e = 'K' AND t.r = 's' AS system FROM marks m LEFT JOIN rows t ON t.conv_id IS NOT DISTINCT FROM m.conv_id AND t.i = m.i WHERE m.e <> 'D'),
turns AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY p) - max(CAST(system AS INTEGER)) OVER (PARTITION BY conv_id) AS q FROM kept),
lines AS (
  SELECT conv_id, string_agg(CASE WHEN e = 'K' THEN role WHEN q % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY p) AS said
  FROM turns GROUP BY conv_id)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(best.c, 0) AS cost, coalesce(best.a, '') AS audit, sha256(coalesce(said, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN stats s ON s.conv_id IS NOT DISTINCT FROM c.conv_id
  LEFT JOIN pairs p ON p.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN done d ON d.conv_id IS NOT DISTINCT FROM c.conv_id
  LEFT JOIN lines l ON l.conv_id IS NOT DISTINCT FROM c.conv_id"""


@query("op11_repair_conversations", _REPAIR)
def op11_repair_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    talks = table(spark, sf_dir, "conversations")
    reports, turns = conversations.repair(damaged(talks))
    none = F.sha2(F.lit("").cast("binary"), 256)
    said = conversations.joined_digests(turns).withColumnRenamed("k", "_key")
    found = reports.join(said, reports["k"] == said["_key"], "left").drop("k", "_key")
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    found = found.withColumn("repaired_sha256", F.coalesce("repaired_sha256", none)).withColumnRenamed("conv_id", "_id")
    every = talks.select("conv_id").distinct()
    joined = every.join(found, every["conv_id"].eqNullSafe(found["_id"]), "left")
    columns = [F.coalesce(n, F.lit(0).cast("long")).alias(n) for n in names]
    return joined.select("conv_id", *columns, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", none).alias("repaired_sha256"))


_WHOLE = "list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE)))"
_USABLE = "embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"


@query(
    "op12_hard_negatives",
    f"""WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, {_WHOLE} AS v
  FROM embeddings WHERE label IS NOT NULL AND {_USABLE}),
scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM rows a JOIN rows b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, s.vec_id AS negative_id, positive_score, s.score AS negative_score
FROM positives JOIN scores s USING (anchor_id)
WHERE NOT s.same AND 80 * positive_score <= 100 * s.score AND 100 * s.score <= 100 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) QUALIFY row_number() OVER w <= 5""",
)
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", label.alias("label"))
    return hard_negatives.mine_negatives(vectors, F.col("vec_id") % 100 == 0)


@query(
    "op13_vector_file",
    f"""WITH rows AS (SELECT vec_id, {_WHOLE} AS v FROM embeddings WHERE {_USABLE}),
scores AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM rows a JOIN rows b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score FROM scores
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 5""",
)
def op13_vector_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_file.top_products(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
