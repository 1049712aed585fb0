"""One query for each operator, over its whole table, and SQL where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickshard.llm import codes, language, lexical, licenses, mixing, near, packing, pii, shards
from tickshard.llm import template, tiling, topk, url_lists
from tickshard.llm.scratch import small_batches
from tickshard.session import configure


def tokenizer_path() -> str:
    """The public byte-level BPE that sequences are counted in."""
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return small_batches(configure(spark)).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_html_extraction(spark, sf_dir):
    return template.extract_main_text(_table(spark, sf_dir, "pages"))


def op2_sharding(spark, sf_dir):
    return shards.shard_documents(_table(spark, sf_dir, "documents"))


def op3_decontamination(spark, sf_dir):
    benchmark = _table(spark, sf_dir, "benchmark")
    return tiling.contaminated(_table(spark, sf_dir, "documents"), benchmark)


def dated_captures(pages: DataFrame) -> DataFrame:
    """Pages with a fetch time made from their URL and id, in 2024."""
    second = _number(F.concat_ws(" ", "page_id", "url"), 7) % 31_536_000
    moment = F.timestamp_add("SECOND", second, F.lit("2024-01-01").cast("timestamp_ntz"))
    return pages.select("page_id", "url", moment.alias("fetched_at"))


def _number(text, digits: int):
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("bigint")


def dated_list(pages: DataFrame) -> DataFrame:
    """A list's history made from the hosts, languages and parent domains that pages have."""
    host = F.lower(F.regexp_extract("url", "^[a-z]+://([^/?#:]+)", 1))
    first = F.regexp_extract("url", "^[a-z]+://[^/?#:]+/([^/?#]+)", 1)
    parent = F.concat_ws(".", F.slice(F.split(host, r"\."), -2, 2))
    entry = lambda p, c: F.struct(p.alias("pattern"), F.lit(c).alias("category"))
    seen = pages.select(
        F.explode(
            F.array(
                entry(host, "spam"),
                entry(F.concat(host, F.lit("/"), first), "ads"),
                entry(parent, "tracker"),
            )
        ).alias("entry")
    )
    n = _number(F.concat_ws(" ", "pattern", "category"), 7)
    patterns = seen.select("entry.*").distinct().withColumn("n", n).where("n % 5 < 3")
    day = lambda shift: F.date_add(F.lit("2024-01-01").cast("date"), shift.cast("int"))
    add, drop, again = F.col("n") % 200, F.col("n") % 200 + 30, F.col("n") % 200 + 100
    step = lambda shift, active: F.struct(day(shift).alias("day"), F.lit(active).alias("active"))
    steps = F.explode(F.array(step(add, True), step(drop, False), step(again, True))).alias("step")
    return patterns.select("pattern", "category", "n", steps).select(
        "pattern", "category", "step.day", "step.active"
    )


def op4_url_filters(spark, sf_dir):
    pages = _table(spark, sf_dir, "pages")
    return url_lists.filter_urls(dated_captures(pages), dated_list(pages))


def op5_pii(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return pii.find(docs, pii.train(docs))


def op6_license_scans(spark, sf_dir):
    return licenses.scan_licenses(_table(spark, sf_dir, "documents"))


def op7_near_duplicates(spark, sf_dir):
    return near.near_duplicates(_table(spark, sf_dir, "documents"), shingle=2)


def op8_packing(spark, sf_dir):
    # the ids travel to their sequences and are stored there; the query shows their checksum
    return packing.pack(_table(spark, sf_dir, "documents"), tokenizer_path()).drop("ids")


def op9_language_id(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    held = language.held_out()
    model = language.train(docs.where(~held))
    found = language.identify(docs.select("doc_id", "text", held.alias("held_out")), model)
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op10_exact_top_k(spark, sf_dir):
    return topk.exact_top_k(_table(spark, sf_dir, "embeddings"))


def op11_vector_codes(spark, sf_dir):
    found = codes.compress(_table(spark, sf_dir, "embeddings"))
    return found.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def op12_lexical_search(spark, sf_dir):
    return lexical.rank_documents(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    )


def op13_mixing(spark, sf_dir):
    assigned = mixing.assign(_table(spark, sf_dir, "documents"))
    return mixing.in_order(assigned).select("doc_id", "size", "source_size", "target", "taken")


QUERIES = {
    "op1_html_extraction": op1_html_extraction,
    "op2_sharding": op2_sharding,
    "op3_decontamination": op3_decontamination,
    "op4_url_filters": op4_url_filters,
    "op5_pii": op5_pii,
    "op6_license_scans": op6_license_scans,
    "op7_near_duplicates": op7_near_duplicates,
    "op8_packing": op8_packing,
    "op9_language_id": op9_language_id,
    "op10_exact_top_k": op10_exact_top_k,
    "op11_vector_codes": op11_vector_codes,
    "op12_lexical_search": op12_lexical_search,
    "op13_mixing": op13_mixing,
}

# Codebooks of one round after the other, for the SQL of op11.
_CODEBOOK = """
        near{n} AS MATERIALIZED (
            SELECT rid, p, v, arg_min(e, (d, e)) AS e, min(d) AS d
            FROM (SELECT rid, p, a.v, b.e, CAST(list_sum(list_transform(list_zip(a.v, b.v),
                             lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d
                  FROM parts a JOIN book{n} b USING (p))
            GROUP BY rid, p, v)"""
_MEANS = """
        book{m} AS MATERIALIZED (
            SELECT b.p, b.e, CASE WHEN s.n IS NULL THEN b.v ELSE
                       list_transform(s.sums, lambda x: CAST((x - ((x % s.n) + s.n) % s.n) // s.n AS BIGINT))
                   END AS v
            FROM book{n} b LEFT JOIN (
                SELECT p, e, any_value(n) AS n, list(total ORDER BY i) AS sums
                FROM (SELECT p, e, i, count(*) AS n, CAST(sum(v[i]) AS BIGINT) AS total
                      FROM near{n}, (SELECT unnest(range(1, 1 + (SELECT max(len(v)) FROM parts))) AS i)
                      GROUP BY p, e, i)
                GROUP BY p, e) s ON b.p = s.p AND b.e = s.e)"""

ORACLE_SQL = {
    "op11_vector_codes": f"""
        WITH whole AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, x) AS rid, vec_id, label, x
            FROM (SELECT vec_id, label, list_transform(embedding,
                             lambda y: CAST(floor(256 * CAST(y AS DOUBLE)) AS BIGINT)) AS x
                  FROM embeddings WHERE embedding IS NOT NULL
                  AND len(list_filter(embedding, lambda y: y IS NULL OR NOT isfinite(y))) = 0)),
        parts AS MATERIALIZED (
            SELECT rid, p, x[1 + p * (len(x) // 16) : (p + 1) * (len(x) // 16)] AS v
            FROM whole, (SELECT unnest(range(16)) AS p)),
        book0 AS MATERIALIZED (SELECT p, rid - 1 AS e, v FROM parts WHERE rid <= 64),
        {_CODEBOOK.format(n=0)}, {_MEANS.format(n=0, m=1)},
        {_CODEBOOK.format(n=1)}, {_MEANS.format(n=1, m=2)}, {_CODEBOOK.format(n=2)},
        digest AS (SELECT sha256(string_agg(c, ',' ORDER BY p, e)) AS h
                   FROM (SELECT p, e, array_to_string(v, ',') AS c FROM book2)),
        coded AS (
            SELECT rid, string_agg(printf('%02x', e), '' ORDER BY p) AS code,
                   CAST(sum(d) AS BIGINT) AS error
            FROM near2 GROUP BY rid)
        SELECT vec_id, code, error,
               CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
               (SELECT h FROM digest) AS codebooks_sha256
        FROM coded JOIN whole USING (rid)""",
    "op12_lexical_search": r"""
        WITH low AS (
            SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(text,
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts
            FROM documents),
        held AS MATERIALIZED (SELECT rid, doc_id, len(ts) AS n, ts FROM low WHERE len(ts) > 0),
        whole AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS length FROM held),
        tf AS MATERIALIZED (
            SELECT rid, doc_id, n, t, count(*) AS tf
            FROM (SELECT rid, doc_id, n, unnest(ts) AS t FROM held) GROUP BY rid, doc_id, n, t),
        weights AS (
            SELECT t, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
            FROM tf, whole GROUP BY t, docs),
        asked AS (
            SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text,
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t
            FROM benchmark),
        scored AS (
            SELECT item_id, rid, doc_id, CAST(sum(w * ((1000000000 * tf)
                       // (1000 * tf + 8 * (10 + (90 * n * docs) // length)))) AS BIGINT) AS score
            FROM asked JOIN tf USING (t) JOIN weights USING (t), whole
            GROUP BY item_id, rid, doc_id)
        SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id
                   ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
        FROM scored WHERE score > 0
        QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) <= 10""",
    "op13_mixing": r"""
        WITH sized AS MATERIALIZED (
            SELECT row_number() OVER () AS rid, doc_id, source,
                   len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
                   sha256(concat_ws(':', coalesce(CAST(doc_id AS VARCHAR), ''), text)) AS digest
            FROM documents),
        sources AS (
            SELECT source, CAST(sum(size) AS BIGINT) AS own,
                   [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w
            FROM sized GROUP BY source),
        ranked AS (
            SELECT *, sum(own) OVER () AS words, sum(w) OVER () AS weights,
                   coalesce(sum(3 * own) OVER earlier, 0) AS used,
                   coalesce(sum(w) OVER earlier, 0) AS used_weights
            FROM sources
            WINDOW earlier AS (ORDER BY 10 * own // w, source NULLS LAST
                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        marked AS (
            SELECT *, 3 * own * (weights - used_weights) <= w * (words - used) AS is_full FROM ranked),
        left_over AS (
            SELECT any_value(words) - coalesce(sum(3 * own) FILTER (is_full), 0) AS words,
                   sum(w) FILTER (NOT is_full) AS weights FROM marked),
        targets AS (
            SELECT source, own, CASE WHEN is_full THEN CAST(3 * own AS DOUBLE)
                       ELSE CAST(w * left_over.words AS DOUBLE) / CAST(left_over.weights AS DOUBLE)
                   END AS target
            FROM marked, left_over),
        placed AS (
            SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY digest, doc_id, rid
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
            FROM sized)
        SELECT doc_id, size, own AS source_size, target, CAST(list_sum(list_transform([0, 1, 2],
                   lambda k: greatest(0, least(size, CAST(floor(target) AS BIGINT) - start - k * own))))
                   AS BIGINT) AS taken
        FROM placed JOIN targets ON placed.source IS NOT DISTINCT FROM targets.source""",
    "op4_url_filters": r"""
        WITH urls AS (
            SELECT page_id, url,
                   lower(regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1)) AS host,
                   regexp_extract(url, '^[a-z]+://[^/?#:]+/([^/?#]+)', 1) AS first,
                   regexp_extract(url, '^[a-z]+://[^/?#]+(/[^?#]*)', 1) AS path
            FROM pages),
        captures AS (
            SELECT DISTINCT page_id, url, host, path,
                   TIMESTAMP '2024-01-01' + to_seconds(
                       CAST('0x' || substr(md5(page_id || ' ' || url), 1, 7) AS BIGINT) % 31536000)
                       AS fetched_at
            FROM urls),
        patterns AS (
            SELECT DISTINCT pattern, category,
                   CAST('0x' || substr(md5(pattern || ' ' || category), 1, 7) AS BIGINT) AS n
            FROM (SELECT host AS pattern, 'spam' AS category FROM urls
                  UNION ALL SELECT host || '/' || first, 'ads' FROM urls
                  UNION ALL SELECT array_to_string(string_split(host, '.')[-2:], '.'), 'tracker'
                  FROM urls)),
        spans AS (
            SELECT pattern, category, lo, hi
            FROM (SELECT pattern, category, n % 200 AS lo, n % 200 + 30 AS hi FROM patterns
                  WHERE n % 5 < 3
                  UNION ALL SELECT pattern, category, n % 200 + 100, 100000 FROM patterns
                  WHERE n % 5 < 3)),
        met AS (
            SELECT c.page_id, c.url, c.fetched_at, s.pattern, s.category,
                   TIMESTAMP '2024-01-01' + to_days(CAST(lo AS INTEGER)) AS since
            FROM captures c JOIN spans s
            ON fetched_at >= TIMESTAMP '2024-01-01' + to_days(CAST(lo AS INTEGER))
               AND fetched_at < TIMESTAMP '2024-01-01' + to_days(CAST(hi AS INTEGER))
               AND (host = pattern OR ends_with(host, '.' || pattern)
                    OR contains(pattern, '/') AND starts_with(
                        host || rtrim(path, '/') || '/', pattern || '/')))
        SELECT c.page_id, c.url, c.fetched_at, count(m.pattern) > 0 AS blocked,
               coalesce(string_agg(DISTINCT m.category, ',' ORDER BY m.category), '') AS categories,
               arg_max(m.pattern, (length(m.pattern), m.pattern, m.since)) AS pattern,
               arg_max(m.since, (length(m.pattern), m.pattern, m.since)) AS listed_since
        FROM captures c LEFT JOIN met m
        ON c.page_id = m.page_id AND c.url = m.url AND c.fetched_at = m.fetched_at
        GROUP BY c.page_id, c.url, c.fetched_at""",
    "op10_exact_top_k": """
        WITH whole AS (
            SELECT vec_id,
                   list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT))
                       AS v
            FROM embeddings
            WHERE embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (
            SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
                   CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))
                        AS BIGINT) AS score
            FROM whole q JOIN whole c ON q.vec_id <> c.vec_id
            WHERE q.vec_id % 50 = 0)
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)
                              AS INTEGER) AS rank, vec_id, score
        FROM scored
        QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5""",
}
