"""Registered queries of the training-data operators, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orbgrid.llm import (
    exact_dedup,
    four_russians,
    license_scan,
    line_dedup,
    mixing,
    piece_lattice,
    prefix_forest,
    quality,
    sharding,
    simhash,
    source_audit,
    token_store,
    url_filter,
)
from orbgrid.llm.common import stored

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def keep(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return keep


def _documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(*columns)


@query()
def op1_simhash_golay(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(spark, _documents(spark, sf_dir, "doc_id", "text"))
    return found.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


NBEST = 4


@query()
def op2_piece_nbest(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = _documents(spark, sf_dir, "doc_id", "text")
    return piece_lattice.encode_pieces(docs, public_tokenizers.path("piece_bpe_32k.model"), NBEST, ids=False)


#: Tickets of the sources that don't have one; the hot one is held to a quarter, roughly.
TICKETS = {"src0": 8, "src1": 3, "src2": 3, "src3": 2}


@query()
def op3_pfair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(spark, _documents(spark, sf_dir, "doc_id", "source"), TICKETS, block_rows=4)


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: Host, path, verdict.
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


@query(
    f"""
    WITH r(rh, rp, v) AS (VALUES {", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)}),
    u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
    p AS (
        SELECT page_id, {_LOWER.format("regexp_extract(rest, '^[^/?#]*')")} AS host,
               regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path
        FROM u),
    d AS (SELECT DISTINCT host, path FROM p),
    f AS (
        SELECT host, path, rh || rp AS rule, v,
               row_number() OVER (PARTITION BY host, path
                                  ORDER BY length(rh) + length(rp) DESC, length(rh) DESC, v DESC) AS n
        FROM d JOIN r ON (host = rh OR suffix(host, '.' || rh)) AND starts_with(path, rp))
    SELECT page_id, p.host, p.path, f.rule, coalesce(f.v, 'allow') AS verdict
    FROM p LEFT JOIN f ON f.host = p.host AND f.path = p.path AND f.n = 1
    """
)
def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return url_filter.judge_urls(pages, rules)


@query(
    f"""
    WITH t AS (SELECT doc_id, {_LOWER.format("coalesce(text, '')")} AS norm FROM documents),
    g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm)
    SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(norm) AS text_sha256
    FROM t JOIN g USING (norm)
    """
)
def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_documents(spark, sf_dir, "doc_id", "text"))


@query()
def op6_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return prefix_forest.nearest(spark, vectors, F.col("vec_id") % 20 == 0, 20)


@query()
def op7_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = line_dedup.dedup_lines(spark, _documents(spark, sf_dir, "doc_id", "text"))
    return docs.select(
        "doc_id",
        "n_lines",
        "n_removed",
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
    )


END_ID = 2


@query()
def op8_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    manifest = token_store.write_tokens(
        spark, _documents(spark, sf_dir, "doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"), END_ID
    )
    return token_store.read_tokens(manifest)


#: A document is predicted good from this score on.
GOOD = 0.3


@query()
def op9_quality_rff(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir, "doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    stats = stored(spark, docs.select("doc_id", quality.statistics_of("text").alias("stats")))
    model = quality.fit(stats, labels)
    scored = stats.select(
        "doc_id", (quality.fold("doc_id") == 0).alias("held_out"), model.score_statistics(F.col("stats")).alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= GOOD).cast("int"))


SHARDS, SHARD_KEY = 40, 20240611


@query()
def op10_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    docs = _documents(spark, sf_dir, "doc_id", "text").select(
        "doc_id",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    sharded = sharding.shard_rows(spark, docs, ["doc_id", "text_crc32", "size"], SHARDS, SHARD_KEY)
    return sharded.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query(
    """
    WITH r AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
        FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (
        SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_dot_product(a.v, c.v)::BIGINT AS score
        FROM r a JOIN r c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0),
    p AS (
        SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
    SELECT anchor_id, positive_id,
           CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
           vec_id AS negative_id, positive_score, score AS negative_score
    FROM s JOIN p USING (anchor_id)
    WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
    QUALIFY rank <= 5
    """
)
def op11_four_russians(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return four_russians.hard_negatives(spark, vectors, F.col("vec_id") % 100 == 0, label)


@query(
    r"""
    WITH d AS (
        SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
        FROM documents),
    t AS (SELECT k, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
    v AS (SELECT lang, term, count(*)::HUGEINT AS lang_n FROM t GROUP BY ALL HAVING count(DISTINCT k) >= 10),
    l AS (SELECT lang, count(*)::HUGEINT AS terms, sum(lang_n)::HUGEINT AS total FROM v GROUP BY lang),
    n AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM t SEMI JOIN v USING (lang, term) GROUP BY ALL),
    g AS (
        SELECT lang, source, coalesce(sum(n), 0)::HUGEINT AS total
        FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN n USING (lang, source) GROUP BY ALL),
    p AS (
        SELECT g.lang, g.source, v.term, coalesce(n.n, 0) AS n,
               1 + 1000000000 * (coalesce(n.n, 0) + 2) // (g.total + 2 * l.terms) AS p,
               1 + 1000000000 * (v.lang_n + 2) // (l.total + 2 * l.terms) AS q
        FROM g JOIN l USING (lang) JOIN v USING (lang) LEFT JOIN n ON n.lang = g.lang AND n.source = g.source AND n.term = v.term),
    f AS (
        SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
        FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
    pairs AS (
        SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0) AS value
        FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
    terms AS (
        SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // (p + q) AS value
        FROM p WHERE n > 0 AND p > q)
    SELECT lang, source, part, item, value::BIGINT AS value,
           CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
    FROM (FROM pairs UNION ALL FROM terms) QUALIFY part = 'pair' OR rank <= 10
    """
)
def op12_source_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.audit(spark, _documents(spark, sf_dir, "text", "lang", "source"))


def _license_sql() -> str:
    listed = [(*x, True) for x in license_scan.PHRASES] + [(*x, False) for x in license_scan.NOTICES]
    rows = [(k, n, p, w, at) for k, (n, t, p) in enumerate(listed) for at, w in enumerate(license_scan.words_of(t))]
    # Blocks are two steps long: a word stands in its step's block and in the one before.
    step = license_scan.STEP_WORDS
    return rf"""
    WITH t(k, label, phrase, word, place) AS (VALUES {", ".join(f"({k}, '{n}', {p}, '{w}', {at})" for k, n, p, w, at in rows)}),
    need AS (
        SELECT k, label, phrase, count(DISTINCT word) AS size, count(*) AS length,
               CASE WHEN phrase THEN count(DISTINCT word) ELSE ceil({license_scan.CONTAINMENT} * count(DISTINCT word)) END AS least
        FROM t GROUP BY k, label, phrase),
    d AS (
        SELECT row_number() OVER () AS d, doc_id,
               regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
        FROM documents),
    w AS (
        SELECT d, words[pos] AS word, pos - 1 AS pos
        FROM (SELECT d, words, unnest(range(1, len(words) + 1)) AS pos FROM d)
        WHERE words[pos] IN (SELECT word FROM t)),
    b AS (
        SELECT d, pos // {step} AS block, word FROM w
        UNION SELECT d, pos // {step} - 1, word FROM w WHERE pos >= {step}),
    m AS (
        SELECT b.d, k, label, max(size) AS size, count(*) AS shared
        FROM b JOIN (SELECT DISTINCT k, word FROM t WHERE NOT phrase) USING (word) JOIN need USING (k)
        GROUP BY b.d, b.block, k, label HAVING count(*) >= max(least)),
    x AS (
        SELECT w.d, k, label, w.pos - place AS start
        FROM w JOIN t USING (word) JOIN need USING (k, label) WHERE t.phrase
        GROUP BY w.d, k, label, w.pos - place HAVING count(*) = max(length)),
    base AS (SELECT d, count(*) AS n, min(start) AS lo, max(start) AS hi, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM x GROUP BY d),
    every AS (
        SELECT d, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score
        FROM (SELECT d, label, shared / size AS share FROM m UNION ALL SELECT d, label, 1.0 FROM x) GROUP BY d)
    SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(base.n, 0) AS n_base, lo AS first_word, hi AS last_word,
           coalesce(base.labels, '') AS base_labels, coalesce(every.labels, '') AS labels, coalesce(score, 0.0)::DOUBLE AS score
    FROM d LEFT JOIN base USING (d) LEFT JOIN every USING (d)
    """


@query(_license_sql())
def op13_license_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.summary(license_scan.scan(spark, _documents(spark, sf_dir, "doc_id", "text")))
