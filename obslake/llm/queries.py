"""The operators applied to the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from obslake.llm import (
    decontaminate, filter_audit, mixing, neighbour_graph, ngram_join, pii, quality, sharding, suffix_dedup, topk, toxicity, url_lists,
    vector_codes,
)

Run = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Run] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    def register(run: Run) -> Run:
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_ngram_jaccard_join")
def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"))


CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWERED = f"translate(coalesce(text, ''), '{CAPITALS}', '{CAPITALS.lower()}')"
ITEM_WORDS = rf"regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query(
    "op2_benchmark_decontamination",
    f"""
WITH docs AS (SELECT row_number() OVER () AS row, doc_id, {ITEM_WORDS} AS words FROM documents),
items AS (SELECT item_id, {ITEM_WORDS} AS words FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, n, array_to_string(list_slice(words, k, k + n - 1), ' ') AS phrase
  FROM (SELECT item_id, words, n, unnest(range(1, len(words) - n + 2)) AS k
        FROM (SELECT *, least(13, len(words)) AS n FROM items WHERE len(words) > 0))),
places AS (
  SELECT row, n, k, array_to_string(list_slice(words, k, k + n - 1), ' ') AS phrase
  FROM (SELECT row, words, n, unnest(range(1, len(words) - n + 2)) AS k
        FROM docs, (SELECT DISTINCT n FROM windows) WHERE len(words) >= n)),
found AS (SELECT row, places.n, k, item_id FROM places JOIN windows USING (n, phrase)),
hits AS (SELECT row, count(DISTINCT w) AS n_hit FROM (SELECT row, unnest(range(k, k + n)) AS w FROM found) GROUP BY row),
ids AS (
  SELECT row, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT row, item_id::VARCHAR AS id FROM found WHERE item_id IS NOT NULL) GROUP BY row)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM docs LEFT JOIN hits USING (row) LEFT JOIN ids USING (row)""",
)
def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination_table(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query(
    "op3_exact_topk",
    """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS cells FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT q.vec_id AS query_id, v.vec_id, list_dot_product(q.cells, v.cells)::BIGINT AS score
  FROM v AS q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 20 = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scores)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20""",
)
def op3_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


@query("op4_source_mixing")
def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_table(table(spark, sf_dir, "documents"))


@query("op8_sharding")
def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_table(table(spark, sf_dir, "documents"))


@query("op5_pii")
def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data_table(table(spark, sf_dir, "documents"))


@query("op6_toxicity")
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_table(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


# The tables have no times and no lists.  Fetch times follow from page ids, and every host and
# its language folders have a history of list entries that follows from the ids of its pages.
URL_PAGES = """
SELECT page_id, url, CAST({epoch} + page_id % 400 * 86400 + page_id % 86400 AS BIGINT) AS fetched_s,
       lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:@]+)', 1)) AS host,
       regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^/?#]*)', 1) AS folder
FROM pages"""
URL_EPOCH = 1_704_067_200
URL_LISTS = f"""
SELECT 'spam' AS list, 'host' AS scope, host AS value, 'add' AS action, {URL_EPOCH} + min(page_id) % 200 * 86400 AS effective_s
FROM captures WHERE host <> '' GROUP BY host
UNION ALL
SELECT 'spam', 'host', host, 'remove', {URL_EPOCH} + (min(page_id) % 200 + 30 + max(page_id) % 90) * 86400
FROM captures WHERE host <> '' GROUP BY host
UNION ALL
SELECT 'spam', 'host', host, 'add', {URL_EPOCH} + (min(page_id) % 200 + 150 + max(page_id) % 90) * 86400
FROM captures WHERE host <> '' GROUP BY host HAVING count(*) % 2 = 1
UNION ALL
SELECT 'adult', 'prefix', concat(host, '/', folder), 'add', {URL_EPOCH} + max(page_id) % 380 * 86400
FROM captures WHERE host <> '' AND folder <> '' GROUP BY host, folder
UNION ALL
SELECT 'parked', 'domain', host, 'add', {URL_EPOCH} + (50 + min(page_id) % 120) * 86400
FROM captures WHERE host <> '' GROUP BY host HAVING length(host) % 4 = 1"""


@query(
    "op7_url_filters",
    f"""
WITH captures AS ({URL_PAGES.format(epoch=URL_EPOCH)}),
entries AS ({URL_LISTS}),
events AS (SELECT list, scope, value, effective_s, max(action = 'add') AS added FROM entries GROUP BY ALL),
turns AS (SELECT *, lag(added, 1, false) OVER (PARTITION BY list, scope, value ORDER BY effective_s) AS before FROM events),
intervals AS (
  SELECT * FROM (
    SELECT *, lead(effective_s) OVER (PARTITION BY list, scope, value ORDER BY effective_s) AS until FROM turns WHERE added <> before)
  WHERE added),
paths AS (
  SELECT page_id, url, fetched_s, host,
         regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/+$', '') || '/' AS path FROM captures),
found AS (
  SELECT page_id, list, effective_s FROM paths JOIN intervals ON
    CASE scope WHEN 'host' THEN host = value
               WHEN 'domain' THEN host = value OR ends_with(host, '.' || value)
               ELSE starts_with(host || path, value || '/') END
    AND effective_s <= fetched_s AND (until IS NULL OR fetched_s < until))
SELECT page_id, host, fetched_s, coalesce(lists, '') AS lists, since_s
FROM captures LEFT JOIN (
  SELECT page_id, string_agg(DISTINCT list, ',' ORDER BY list) AS lists, min(effective_s) AS since_s FROM found GROUP BY page_id)
USING (page_id)""",
)
def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = {"pages": table(spark, sf_dir, "pages").select("page_id", "url")}
    captures = spark.sql(URL_PAGES.replace("FROM pages", "FROM {pages}").format(epoch=URL_EPOCH, **{"pages": "{pages}"}), **named)
    entries = spark.sql(URL_LISTS.replace("FROM captures", "FROM {captures}"), captures=captures)
    found = url_lists.match_lists(
        captures.withColumn("fetched_at", F.timestamp_seconds("fetched_s")),
        entries.withColumn("effective_at", F.timestamp_seconds("effective_s")),
    )
    return found.select(
        "page_id",
        "host",
        "fetched_s",
        F.array_join("lists", ",").alias("lists"),
        F.unix_seconds("listed_since").alias("since_s"),
    )


@query("op9_quality_classifier")
def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_table(table(spark, sf_dir, "documents"))


@query("op10_suffix_dedup")
def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), with_text=False)


# One pair of steps per round: the nearest entry of every part, then the entries' new places.
CODE_ROUNDS = ",\n".join(
    f"""
assigned{n} AS MATERIALIZED (
  SELECT r, p, min({{'d': list_dot_product(b.c, b.c) - 2 * list_dot_product(a.c, b.c), 'e': e}}) AS best, any_value(a.c) AS c
  FROM parts AS a JOIN book{n} AS b USING (p) GROUP BY r, p),
book{n + 1} AS MATERIALIZED (
  SELECT p, e, coalesce(moved.c, old.c) AS c FROM book{n} AS old LEFT JOIN (
    SELECT p, e, list(x ORDER BY i) AS c FROM (
      SELECT p, best.e AS e, i, floor(sum(c[i]) / count(*)) AS x
      FROM (SELECT p, best, c, unnest(range(1, len(c) + 1)) AS i FROM assigned{n}) GROUP BY p, best.e, i)
    GROUP BY p, e) AS moved USING (p, e))"""
    for n in range(vector_codes.ROUNDS)
)
FINAL = f"book{vector_codes.ROUNDS}"


@query(
    "op11_vector_codes",
    f"""
WITH v AS (
  SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label,
         list_transform(embedding, lambda x: floor({vector_codes.SCALE} * x::DOUBLE)) AS cells FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (
  SELECT r, p, cells[p * (len(cells) // 4) + 1 : (p + 1) * (len(cells) // 4)] AS c FROM v, range(4) AS t(p)),
book0 AS MATERIALIZED (SELECT p, r - 1 AS e, c FROM parts WHERE r <= 256),
{CODE_ROUNDS},
last AS (
  SELECT r, p, min({{'d': list_dot_product(b.c, b.c) - 2 * list_dot_product(a.c, b.c), 'e': e}}) AS best,
         list_dot_product(any_value(a.c), any_value(a.c)) AS own
  FROM parts AS a JOIN {FINAL} AS b USING (p) GROUP BY r, p),
coded AS (
  SELECT r, string_agg(format('{{:02x}}', best.e), '' ORDER BY p) AS code, sum(own + best.d)::BIGINT AS error FROM last GROUP BY r)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(array_to_string(list_transform(c, lambda x: x::BIGINT), ','), ',' ORDER BY p, e)) FROM {FINAL}) AS codebooks_sha256
FROM v JOIN coded USING (r)""",
)
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.code_table(table(spark, sf_dir, "embeddings"))


@query(
    "op12_filter_audit",
    r"""
WITH docs AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
masks AS (
  SELECT doc_id, part,
         (len(words) < 200)::INTEGER
         + 2 * (100 * len(list_distinct(words)) < 50 * len(words))::INTEGER
         + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text))::INTEGER
         + 8 * (regexp_matches(text, '[#$%&*|]'))::INTEGER
         + 16 * coalesce(doc_id > min(doc_id) OVER same, min(doc_id) OVER same IS NOT NULL)::INTEGER AS mask
  FROM docs WINDOW same AS (PARTITION BY text)),
marks AS (SELECT doc_id, max((quality = 1)::INTEGER) AS good, max((toxic = 1)::INTEGER) AS toxic FROM labels GROUP BY doc_id),
counts AS (
  SELECT part, mask, count(*) AS n, count(*) FILTER (good = 1) AS good, count(*) FILTER (toxic = 1) AS toxic
  FROM masks LEFT JOIN marks USING (doc_id) GROUP BY part, mask),
names AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS t(name, bit)),
orders AS (
  SELECT a.name || b.name || c.name || d.name || e.name AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM names a, names b, names c, names d, names e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31
   AND len(list_distinct([a.bit, b.bit, c.bit, d.bit, e.bit])) = 5),
steps AS (
  SELECT filter_order, step::INTEGER AS step, bits[step] AS bit, coalesce(list_sum(bits[1 : step - 1]), 0)::INTEGER AS prior
  FROM orders, range(1, 6) AS t(step))
SELECT part, filter_order, step,
       coalesce(sum(n) FILTER (mask & (bit | prior) = 0), 0)::BIGINT AS kept,
       coalesce(sum(n) FILTER (mask & bit > 0 AND mask & prior = 0), 0)::BIGINT AS removed,
       coalesce(sum(n) FILTER (mask & bit > 0 AND mask & prior > 0), 0)::BIGINT AS redundant,
       coalesce(sum(n) FILTER (mask = bit), 0)::BIGINT AS unique_fails,
       coalesce(sum(good) FILTER (mask & bit > 0 AND mask & prior = 0), 0)::BIGINT AS good_lost,
       coalesce(sum(toxic) FILTER (mask & bit > 0 AND mask & prior = 0), 0)::BIGINT AS toxic_lost,
       coalesce(sum(n * 120 // greatest(bit_count(mask), 1)) FILTER (mask & bit > 0), 0)::BIGINT AS shapley
FROM counts, steps GROUP BY part, filter_order, step""",
)
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_table(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


# The graph search may miss a link, so there is no SQL for its rows.
@query("op13_embedding_near_dedup")
def op13_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbour_graph.near_duplicates(table(spark, sf_dir, "embeddings"))
