"""Registered queries of the training-data operators: ``name -> (spark, sf_dir) -> DataFrame``, and DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.llm import ann, decontam, licenses, lines, mixing, periodic, pii, quality, ranked, secrets, sharding, simhash, urls
from wattlake.llm.common import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn

    return deco


@register("op1_simhash")
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"), shingle=3, radius=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@register("op2_nearest_neighbours")
def op2_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return ann.search(rows, rows.where("vec_id % 20 = 0"), k=20)


@register("op3_line_dedup")
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return lines.summary(docs, lines.repeats(docs))


_DECONTAM_SQL = r"""
WITH d AS (
    SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i, len(ws) AS n FROM (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS ws FROM documents)),
b AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS ws FROM benchmark),
windows AS (
    SELECT DISTINCT item_id, least(len(ws), 10) AS size,
        array_to_string(list_slice(ws, s, s + least(len(ws), 10) - 1), ' ') AS phrase
    FROM (SELECT item_id, ws, unnest(generate_series(1, greatest(len(ws) - 9, 1))) AS s FROM b WHERE len(ws) > 0)),
sizes AS (SELECT DISTINCT size FROM windows),
grams AS (
    SELECT doc_id, i, size, string_agg(w, ' ') OVER (
        PARTITION BY doc_id, size ORDER BY i ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS ten,
        list(w) OVER (PARTITION BY doc_id, size ORDER BY i ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS tens
    FROM d, sizes),
occurs AS (
    SELECT g.doc_id, g.i, g.size, v.item_id FROM grams g JOIN windows v
    ON v.size = g.size AND array_to_string(list_slice(g.tens, 1, g.size), ' ') = v.phrase
    WHERE len(g.tens) >= g.size),
hits AS (
    SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (
        SELECT doc_id, unnest(generate_series(i, i + size - 1)) AS pos FROM (SELECT DISTINCT doc_id, i, size FROM occurs))
    GROUP BY doc_id),
who AS (
    SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM occurs) GROUP BY doc_id),
words AS (SELECT doc_id, max(n) AS n_words FROM d GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(n_words, 0) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AS contaminated
FROM documents LEFT JOIN words USING (doc_id) LEFT JOIN hits USING (doc_id) LEFT JOIN who USING (doc_id)
"""


@register("op4_decontamination", _DECONTAM_SQL)
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    leaks = decontam.find_leaks(docs, read(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s["stop"] - s["start"])
    ids = F.array_join(F.array_sort("items"), ",")
    return leaks.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(ids.cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


def _span_text(spans):
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def _count(kind: str):
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


@register("op5_secret_scan")
def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(read(spark, sf_dir, "documents"))

    def by_start(spans):
        order = F.create_map(*[F.lit(x) for i, k in enumerate(secrets.KINDS) for x in (k, i)])
        keyed = F.transform(
            spans, lambda s: F.struct(s["start"].alias("start"), order[s["kind"]].alias("at"), s["stop"].alias("stop"), s["kind"].alias("kind"))
        )
        return F.array_sort(keyed)

    plain = lambda name: F.transform(name, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["stop"].alias("stop")))
    return found.select(
        "doc_id", *[_count(k) for k in ("assign", "access", "hex")],
        F.sha2(_span_text(by_start(plain("base"))).cast("binary"), 256).alias("base_sha256"),
        _span_text(by_start(F.concat(plain("base"), plain("inferred")))).alias("spans"),
    )


@register("op6_quality_classifier")
def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return quality.classify(docs, quality.learn(docs, read(spark, sf_dir, "labels")))


_URLS_SQL = r"""
WITH raw AS (
    SELECT page_id, url, CAST(DATE '2024-01-01' + CAST(page_id * 7919 % 365 AS INTEGER) AS DATE) AS fetched,
        rtrim(regexp_extract(lower(coalesce(url, '')), '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1), '.') AS host,
        regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS path FROM pages),
caps AS (SELECT page_id, url, fetched, host, CASE WHEN host = '' THEN '' ELSE host || rtrim(path, '/') END AS address FROM raw),
entries AS (
    SELECT * FROM (VALUES
        ('domain', 'spam-farm.example.org', 'block', DATE '2024-02-01'),
        ('domain', 'spam-farm.example.org', 'allow', DATE '2024-06-01'),
        ('domain', 'spam-farm.example.org', 'block', DATE '2024-09-01'),
        ('domain', 'cheap-pills.example.com', 'block', DATE '2024-01-15'),
        ('host', 'www.cheap-pills.example.com', 'allow', DATE '2024-11-01')) AS t(kind, value, action, listed)
    UNION ALL SELECT 'host', host, 'block', min(fetched) FROM caps WHERE url LIKE '%utm_source=%' GROUP BY host
    UNION ALL SELECT 'host', host, 'allow', CAST(min(fetched) + 90 AS DATE) FROM caps WHERE url LIKE '%utm_source=%' GROUP BY host
    UNION ALL SELECT 'address', address, 'block', max(fetched) FROM caps WHERE address <> '' GROUP BY address HAVING count(*) > 1),
daily AS (SELECT kind, value, listed, bool_or(action = 'block') AS block FROM entries GROUP BY ALL),
spells AS (SELECT *, lead(listed) OVER (PARTITION BY kind, value ORDER BY listed) AS until FROM daily),
labels AS (SELECT *, string_split(host, '.') AS l FROM caps WHERE host <> ''),
keys AS (
    SELECT page_id, fetched, 'address' AS kind, address AS value, 0 AS up FROM labels
    UNION ALL SELECT page_id, fetched, 'host', host, 1 FROM labels
    UNION ALL SELECT page_id, fetched, 'domain', array_to_string(list_slice(l, i, len(l)), '.'), i + 1
        FROM (SELECT *, unnest(generate_series(1, len(l))) AS i FROM labels)),
found AS (
    SELECT k.page_id, s.kind, s.value, s.listed, s.block,
        row_number() OVER (PARTITION BY k.page_id ORDER BY k.up) AS r
    FROM keys k JOIN spells s ON k.kind = s.kind AND k.value = s.value AND s.listed <= k.fetched
        AND (s.until IS NULL OR k.fetched < s.until))
SELECT c.page_id, c.url, c.host, c.fetched, f.kind, f.value, f.listed, coalesce(f.block, FALSE) AS blocked
FROM caps c LEFT JOIN (SELECT * FROM found WHERE r = 1) f ON c.page_id = f.page_id
"""


@register("op7_url_filter", _URLS_SQL)
def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages against a dated list: two known spam domains, hosts first seen with tracking, addresses captured again.

    Pages carry no fetch time, so a day of 2024 is taken from the id.
    """
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(F.col("page_id") * 7919, F.lit(365)).cast("int"))
    captures = read(spark, sf_dir, "pages").select("page_id", "url", day.alias("fetched"))
    known = [
        ("domain", "spam-farm.example.org", "block", "2024-02-01"),
        ("domain", "spam-farm.example.org", "allow", "2024-06-01"),
        ("domain", "spam-farm.example.org", "block", "2024-09-01"),
        ("domain", "cheap-pills.example.com", "block", "2024-01-15"),
        ("host", "www.cheap-pills.example.com", "allow", "2024-11-01"),
    ]
    cols = ["kind", "value", "action", "listed"]
    entries = spark.range(1).select(
        F.inline(F.array(*[F.struct(*[F.lit(v).alias(c) for c, v in zip(cols, row)]) for row in known]))
    ).withColumn("listed", F.col("listed").cast("date"))
    host, address = urls.host_of(F.col("url")), urls.address_of(F.col("url"))
    tracked = (
        captures.where(F.col("url").contains("utm_source=")).groupBy(host.alias("value")).agg(F.min("fetched").alias("first"))
        .select("value", F.explode(F.array(
            F.struct(F.lit("block").alias("action"), F.col("first").alias("listed")),
            F.struct(F.lit("allow").alias("action"), F.date_add("first", 90).alias("listed")),
        )).alias("e")).select(F.lit("host").alias("kind"), "value", "e.action", "e.listed")
    )
    again = (
        captures.where(address != "").groupBy(address.alias("value")).agg(F.max("fetched").alias("listed"), F.count("*").alias("n"))
        .where("n > 1").select(F.lit("address").alias("kind"), "value", F.lit("block").alias("action"), "listed")
    )
    return urls.filter_urls(captures, entries.unionByName(tracked).unionByName(again))


def _mixing_sql(rounds: int, residual: float, temper: float, budget: float, topics: int) -> str:
    """Bounded raking as a recursive query: one step a dimension and round, until every marginal is reached."""
    dims = ("source", "lang", "topic")
    parts = [rf"""
words AS (
    SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS ws FROM documents),
initials AS (
    SELECT doc_id, (ascii(w) - 97) % {topics} AS t, count(*) AS n
    FROM (SELECT doc_id, unnest(ws) AS w FROM words) WHERE w[1] BETWEEN 'a' AND 'z' GROUP BY ALL),
best AS (SELECT doc_id, arg_max('t' || t, n * 100 - t) AS topic FROM initials GROUP BY doc_id),
d AS (SELECT doc_id, source, lang, coalesce(topic, 'none') AS topic, CAST(len(ws) AS BIGINT) AS n_tokens
    FROM words LEFT JOIN best USING (doc_id)),
cells AS (SELECT source, lang, topic, CAST(sum(n_tokens) AS DOUBLE) AS tokens FROM d
    GROUP BY source, lang, topic HAVING sum(n_tokens) > 0),
wanted AS (SELECT {budget} * sum(tokens) AS budget FROM cells)"""]
    for c in dims:
        parts.append(f"""
v_{c} AS (SELECT {c}, pow(sum(tokens), {temper}) AS wish, sum(tokens) / any_value(budget) AS most FROM cells, wanted GROUP BY {c}),
l_{c} AS (SELECT max(scale) AS scale FROM (
    SELECT (1 - coalesce(sum(most) OVER (ORDER BY most / wish, {c} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(wish) OVER (ORDER BY most / wish, {c} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS scale FROM v_{c})),
g_{c} AS (SELECT {c}, least(most, wish * scale) * budget AS aim_{c} FROM v_{c}, l_{c}, wanted)""")
    step = "(SELECT * FROM raked WHERE miss > {} AND round < {})".format(residual, rounds)
    for c in dims:
        sums = f"""SELECT *, sum(least(weight, tokens)) OVER (PARTITION BY {c}) AS drawn,
            sum(CASE WHEN weight < tokens THEN weight ELSE 0 END) OVER (PARTITION BY {c}) AS open FROM {step}"""
        step = f"""(SELECT * EXCLUDE (drawn, open) REPLACE (weight * CASE WHEN drawn < aim_{c}
            THEN CASE WHEN open > 0 THEN (aim_{c} - drawn + open) / open ELSE 1 END ELSE aim_{c} / drawn END AS weight),
            abs(drawn / aim_{c} - 1) AS miss_{c} FROM ({sums}))"""
    parts.append(f"""
raked AS (
    SELECT source, lang, topic, tokens, aim_source, aim_lang, aim_topic, tokens * {budget} AS weight,
        CAST(1e9 AS DOUBLE) AS miss, 0 AS round
    FROM cells JOIN g_source USING (source) JOIN g_lang USING (lang) JOIN g_topic USING (topic)
    UNION ALL
    SELECT source, lang, topic, tokens, aim_source, aim_lang, aim_topic, weight,
        max(greatest(miss_source, miss_lang, miss_topic)) OVER () AS miss, round + 1 AS round FROM {step}),
done AS (SELECT source, lang, topic, least(weight, tokens) / tokens AS p, least(weight, tokens) / budget AS weight
    FROM raked, wanted WHERE round = (SELECT max(round) FROM raked))""")
    return "WITH RECURSIVE " + ",".join(parts) + """
SELECT doc_id, source, lang, topic, n_tokens, round(coalesce(weight, 0), 6) AS weight, round(coalesce(p, 1.0), 6) AS p,
    CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 13) AS BIGINT) / CAST(4503599627370496 AS DOUBLE)
        < coalesce(p, 1.0) AS sampled
FROM d LEFT JOIN done USING (source, lang, topic)"""


@register("op8_mixing", _mixing_sql(mixing.ROUNDS, mixing.RESIDUAL, mixing.TEMPER, mixing.BUDGET, mixing.TOPICS))
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    mixed = mixing.mix(docs)
    return mixed.select(
        "row.doc_id", "source", "lang", "topic", "n_tokens", F.round("weight", 6).alias("weight"),
        F.round("p", 6).alias("p"), "sampled",
    )


@register("op9_license_scan")
def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.summary(licenses.scan(read(spark, sf_dir, "documents")))


@register("op10_pii_scan")
def op10_pii_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.scan(read(spark, sf_dir, "documents"))

    def by_kind(spans):
        order = F.create_map(*[F.lit(x) for i, k in enumerate(pii.KINDS) for x in (k, i)])
        return F.array_sort(F.transform(
            spans, lambda s: F.struct(order[s["kind"]].alias("at"), s["start"].alias("start"), s["stop"].alias("stop"), s["kind"].alias("kind"))
        ))

    return found.select(
        "doc_id", *[_count(k) for k in pii.KINDS],
        F.sha2(_span_text(by_kind("base")).cast("binary"), 256).alias("base_sha256"),
        _span_text(by_kind(F.concat("base", "added"))).alias("spans"),
    )


@register("op11_sharding")
def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(read(spark, sf_dir, "documents"), shards=8)


@register("op12_periodic_runs")
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.summary(periodic.find_runs(read(spark, sf_dir, "documents"), plant=periodic.planted))


_RANKED_SQL = r"""
WITH d AS (
    SELECT row_number() OVER () AS row_id, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS ws FROM documents),
total AS (SELECT count(*) AS docs, CAST(sum(len(ws)) AS BIGINT) AS words FROM d WHERE len(ws) > 0),
tf AS (SELECT row_id, doc_id, n, w, count(*) AS tf FROM (SELECT row_id, doc_id, len(ws) AS n, unnest(ws) AS w FROM d) GROUP BY ALL),
wanted AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+')) AS w FROM benchmark),
weight AS (
    SELECT w, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight
    FROM tf, total GROUP BY w),
scores AS (
    SELECT item_id, row_id, doc_id, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // words)))) AS BIGINT) AS score
    FROM wanted JOIN tf USING (w) JOIN weight USING (w), total GROUP BY item_id, row_id, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
    SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
    FROM scores WHERE score > 0) WHERE rank <= 50
"""


@register("op13_ranked_search", _RANKED_SQL)
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), k=50)
