"""The registered queries of the text operators, over whole tables of a lake folder."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from strataloom.llm import alignment, attention, language, leaks, pieces, repeats, secrets, sharding, shingle_links, spelling, token_count, url_lists, vector_links
from strataloom.sources import lake

Query = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, Query] = {}
# Where SQL can say what a query returns.
SQL: dict[str, str] = {}

PIECES = public_tokenizers.path("piece_bpe_32k.model")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


@query
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = lake.read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", language.held_out(F.col("doc_id")))
    prototypes = language.learn(docs.where("NOT held_out"))
    return language.predict(docs.drop("lang"), prototypes).select("doc_id", "held_out", "lang_pred", "score")


@query
def op3_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = lake.read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return pieces.encode(docs, PIECES, decoded="decoded").select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query
def op5_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = lake.read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_count.count_tokens(docs, PIECES).drop("text")


@query
def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = lake.read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.find(docs, RANKS, public_tokenizers.PATTERN).select("doc_id", "secrets")
    of = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("secrets", lambda s: s["kind"] != "dense")
    return found.select(
        "doc_id", of("assign").alias("n_assign"), of("access").alias("n_access"), of("hex").alias("n_hex"),
        F.sha2(secrets.as_text(base).cast("binary"), 256).alias("base_sha256"),
        secrets.as_text(F.col("secrets")).alias("spans"),
    )


@query
def op10_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = lake.read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = leaks.find(docs, lake.read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.explode("leaks").alias("leak")).select(
        "doc_id", F.col("leak.id").alias("item_id"), F.col("leak.shared").cast("long").alias("n_shared"),
        F.col("leak.of").cast("long").alias("n_item"), (F.col("leak.shared") / F.col("leak.of")).alias("containment"),
    )


@query
def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(lake.read_table(spark, sf_dir, "documents").select("doc_id", "text"))


# Fixed value: the tables hold no fetch times, so a page's day follows from its number.
FIRST_DAY = "2024-01-01"


def list_of_hosts(pages: DataFrame) -> DataFrame:
    """A dated list made from the pages' own hosts.

    Domains with a hyphen are listed, dropped after 60 days and listed again after
    120; each host's English pages are listed for 90 days.
    """
    hosts = pages.select(url_lists.host_of(F.col("url")).alias("host")).where("host != ''").distinct()
    domains = hosts.select(F.substring_index("host", ".", -3).alias("pattern")).distinct().where("pattern LIKE '%-%'")
    first = F.date_add(F.lit(FIRST_DAY).cast("date"), (F.length("pattern") * 11 % 150).cast("int"))

    def changes(df, kind, days):
        return df.select(F.lit(kind).alias("kind"), "pattern", F.explode(F.array(*[
            F.struct(F.lit(on).alias("listed"), F.date_add(first, d).alias("at")) for d, on in days])).alias("c")).select("kind", "pattern", "c.*")

    english = hosts.select(F.concat("host", F.lit("/en")).alias("pattern"))
    return changes(domains, "domain", [(0, True), (60, False), (120, True)]).unionAll(changes(english, "prefix", [(30, True), (120, False)]))


@query
def op6_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = lake.read_table(spark, sf_dir, "pages").select("page_id", "url")
    captures = pages.withColumn("fetched_on", F.date_add(F.lit(FIRST_DAY).cast("date"), F.pmod("page_id", F.lit(366)).cast("int")))
    return url_lists.evaluate(captures, list_of_hosts(pages), at="fetched_on").withColumn("fetched_on", F.col("fetched_on").cast("string"))


SQL["op6_url_lists"] = r"""
WITH seen AS (
  SELECT page_id, url, CAST(DATE '2024-01-01' + CAST(page_id % 366 AS INTEGER) AS DATE) AS fetched_on,
         lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)) AS host,
         rtrim(regexp_extract(url, '^[^:/?#]+://[^/?#]*([^?#]*)', 1), '/') AS path
  FROM pages),
hosts AS (SELECT DISTINCT host FROM seen WHERE host <> ''),
named AS (
  SELECT DISTINCT 'domain' AS kind, regexp_extract(host, '(?:[^.]*[.]){0,2}[^.]*$', 0) AS pattern FROM hosts
  UNION ALL SELECT 'prefix', host || '/en' FROM hosts),
dated AS (
  SELECT kind, pattern, DATE '2024-01-01' + CAST(length(pattern) * 11 % 150 AS INTEGER) AS first
  FROM named WHERE kind = 'prefix' OR contains(pattern, '-')),
changes AS (
  SELECT kind, pattern, first + d AS since, listed
  FROM dated JOIN (VALUES ('domain', 0, true), ('domain', 60, false), ('domain', 120, true),
                          ('prefix', 30, true), ('prefix', 120, false)) v(k, d, listed) ON k = kind),
valid AS (
  SELECT kind, pattern, listed, since AS b, lead(since) OVER (PARTITION BY kind, pattern ORDER BY since) AS e FROM changes),
active AS (
  SELECT page_id, s.url, s.fetched_on, kind, pattern
  FROM seen s JOIN valid v ON listed AND b <= s.fetched_on AND (e IS NULL OR s.fetched_on < e)
   AND (kind = 'domain' AND (host = pattern OR ends_with(host, '.' || pattern))
     OR kind = 'prefix' AND (host || path = pattern OR starts_with(host || path, pattern || '/'))))
SELECT p.page_id, p.url, CAST(p.fetched_on AS VARCHAR) AS fetched_on, count(kind) > 0 AS listed, count(kind) AS n_active,
       arg_max(kind || ':' || pattern, struct_pack(a := length(pattern), b := kind || ':' || pattern)) AS entry
FROM seen p LEFT JOIN active a ON a.page_id = p.page_id AND a.url = p.url
GROUP BY p.page_id, p.url, p.fetched_on
"""


@query
def op7_vector_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_links.link(lake.read_table(spark, sf_dir, "embeddings"))


@query
def op8_shingle_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingle_links.join(lake.read_table(spark, sf_dir, "documents")).drop("set", "root")


@query
def op4_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = lake.read_table(spark, sf_dir, "documents").select("doc_id", "text")
    known, found = repeats.spans(docs, extra=[F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("sha256")])
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    cut = repeats.kept(docs, found).select("key", F.sha2("kept", 256).alias("cut_sha256"))
    cut = found.select("key", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans")).join(cut, "key")
    # A text without repeats is kept as it is.
    return known.join(cut, "key", "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).alias("n_removed"), F.coalesce("n_spans", F.lit(0)).alias("n_spans"),
        F.coalesce("cut_sha256", "sha256").alias("kept_sha256"))


BYTE_LEVEL = public_tokenizers.path("byte_bpe_50k.json")


@query
def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = lake.read_table(spark, sf_dir, "documents").select("doc_id", "text")
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2(F.col("groups").cast("binary"), 256)).alias("groups_sha256")
    return alignment.align(docs, BYTE_LEVEL, PIECES, extra=[digest]).documents


# Texts that score this or more are predicted to have label 1.
GOOD = 0.7


@query
def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = lake.read_table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", attention.held_out(F.col("doc_id")))
    labels = lake.read_table(spark, sf_dir, "labels").where(~attention.held_out(F.col("doc_id")))
    model = attention.learn(docs.where("NOT held_out"), labels)
    return attention.score(docs, model).select("doc_id", "held_out", "score", (F.col("score") >= GOOD).cast("int").alias("predicted"))


def with_slips(doc_id: str, word: str) -> str:
    """One in 97 pairs of document and word loses a letter, both chosen by checksum."""
    h = zlib.crc32(f"{doc_id}:{word}".encode())
    return word if h % 97 else word[:h % len(word)] + word[h % len(word) + 1:]


@query
def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = lake.read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return spelling.variants(spelling.count_words(docs, change=with_slips))


def _shingles_sql(table: str, key: str) -> str:
    return rf"""
  SELECT DISTINCT {key}, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                                     WHEN len(w) > 0 THEN [array_to_string(w, ' ')] END) AS s
  FROM (SELECT {key}, regexp_extract_all(lower(text), '[\p{{L}}\p{{M}}\p{{N}}]+') AS w FROM {table})"""


SQL["op10_leaks"] = f"""
WITH doc AS ({_shingles_sql('documents', 'doc_id')}),
item AS ({_shingles_sql('benchmark', 'item_id')}),
size AS (SELECT item_id, count(*) AS n_item FROM item GROUP BY item_id)
SELECT doc_id, item_id, count(*) AS n_shared, n_item, count(*) / n_item AS containment
FROM doc JOIN item USING (s) JOIN size USING (item_id)
GROUP BY doc_id, item_id, n_item HAVING count(*) * 10 >= 8 * n_item
"""

SQL["op8_shingle_links"] = f"""
WITH RECURSIVE shingle AS ({_shingles_sql('documents', 'doc_id')}),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
pair AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
  FROM shingle x JOIN shingle y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY x.doc_id, y.doc_id),
link AS (
  SELECT a, b FROM pair JOIN size p ON a = p.doc_id JOIN size q ON b = q.doc_id
  WHERE pair.n * 10 >= 8 * (p.n + q.n - pair.n)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
least AS (SELECT a AS doc_id, min(b) AS class_id FROM reach GROUP BY a),
degree AS (SELECT a AS doc_id, count(*) AS n_links FROM link GROUP BY a)
SELECT doc_id, class_id, coalesce(n_links, 0) AS n_links, doc_id = class_id AS kept
FROM documents LEFT JOIN degree USING (doc_id) JOIN least USING (doc_id)
"""


SQL["op7_vector_links"] = """
WITH RECURSIVE good AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.95),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
least AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
degree AS (SELECT a AS vec_id, count(*) AS n_links FROM link GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings LEFT JOIN degree USING (vec_id) JOIN least USING (vec_id)
"""


SQL["op4_repeats"] = """
WITH doc AS (
  SELECT row_number() OVER () AS k, doc_id, encode(coalesce(text, '')) AS t, hex(encode(coalesce(text, ''))) AS h FROM documents),
place AS (SELECT k, t, unnest(range(0, length(h) // 2 - 399)) AS i FROM doc),
string AS (SELECT k, i, md5(t[i + 1:i + 400]) AS s FROM place),
again AS (SELECT k, i FROM string WHERE s IN (SELECT s FROM string GROUP BY s HAVING count(*) > 1)),
apart AS (SELECT k, i, CASE WHEN i - lag(i) OVER (PARTITION BY k ORDER BY i) <= 400 THEN 0 ELSE 1 END AS opens FROM again),
run AS (SELECT k, i, sum(opens) OVER (PARTITION BY k ORDER BY i) AS r FROM apart),
span AS (SELECT k, min(i) AS b, max(i) + 400 AS e FROM run GROUP BY k, r),
gap AS (
  SELECT k, e AS b, lead(b) OVER (PARTITION BY k ORDER BY b) AS e FROM span
  UNION ALL SELECT k, 0, min(b) FROM span GROUP BY k),
kept AS (
  SELECT k, string_agg(CASE WHEN e IS NULL THEN substr(h, 2 * b + 1) ELSE substr(h, 2 * b + 1, 2 * (e - b)) END, '' ORDER BY b) AS h
  FROM gap JOIN doc USING (k) GROUP BY k),
gone AS (SELECT k, sum(e - b) AS n_removed, count(*) AS n_spans FROM span GROUP BY k)
SELECT doc_id, CAST(length(d.h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(x.h, d.h))) AS kept_sha256
FROM doc d LEFT JOIN gone USING (k) LEFT JOIN kept x USING (k)
"""
