"""Registered queries of the corpus operators, with SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from presslens.llm import (
    centroids,
    chat,
    decontamination,
    divergence,
    exact_dedup,
    language,
    mixing,
    near_dedup,
    personal_data,
    quality,
    secrets,
    simhash,
    url_rules,
)

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return add


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


@query("op1_decontamination")
def op1(spark: SparkSession, d: str) -> DataFrame:
    """Documents with the benchmark items that they contain."""
    return decontamination.tilings(table(spark, d, "documents"), table(spark, d, "benchmark"))


@query("op4_mixing")
def op4(spark: SparkSession, d: str) -> DataFrame:
    out = mixing.mixture(table(spark, d, "documents"), ["doc_id"])
    return out.select("doc_id", "size", "source_size", "target", "taken")


@query("op7_near_dedup")
def op7(spark: SparkSession, d: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, d, "documents"), k=3, percent=85)


@query(
    "op8_exact_dedup",
    """
    WITH t AS (
        SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                        'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
        FROM documents)
    SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
           doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept, text_sha256
    FROM t WINDOW w AS (PARTITION BY text_sha256)
    """,
)
def op8(spark: SparkSession, d: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, d, "documents"))


@query("op2_quality")
def op2(spark: SparkSession, d: str) -> DataFrame:
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    out = quality.scored(docs.select("doc_id", "text"), labels)
    return out.select("doc_id", "held_out", "score", "predicted")


@query("op6_language")
def op6(spark: SparkSession, d: str) -> DataFrame:
    return language.identified(table(spark, d, "documents"), keep=["doc_id"])


@query("op5_secrets")
def op5(spark: SparkSession, d: str) -> DataFrame:
    return secrets.secrets(table(spark, d, "documents"))


@query("op9_personal_data")
def op9(spark: SparkSession, d: str) -> DataFrame:
    return personal_data.personal_data(table(spark, d, "documents"))


RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
_RULES_SQL = ", ".join(f"('{a}', '{h}', '{p}')" for a, h, p in RULES)


@query(
    "op3_url_rules",
    rf"""
    WITH rules(action, rule_host, rule_path) AS (VALUES {_RULES_SQL}),
    r AS (
        SELECT page_id, url, CASE WHEN instr(url, '://') > 0
                                  THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
        FROM pages),
    h AS (SELECT page_id, url, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM r),
    p AS (
        SELECT page_id, url, row_number() OVER () AS n,
               translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
               regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path
        FROM h),
    best AS (
        SELECT n, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
               arg_max(action, length(rule_host || rule_path)) AS action
        FROM p JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host))
                         AND starts_with(path, rule_path)
        GROUP BY n)
    SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict
    FROM p LEFT JOIN best USING (n)
    """,
)
def op3(spark: SparkSession, d: str) -> DataFrame:
    return url_rules.judge(table(spark, d, "pages"), url_rules.rules_table(spark, RULES))


CONTROL = "<|im_end|><|im_start|>assistant ok"


@query(
    "op10_chat",
    rf"""
    WITH c AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
        FROM conversations
        UNION ALL VALUES (-1, 0, 'user', '{CONTROL}'), (-1, 1, 'assistant', '{CONTROL}'))
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
           CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
           sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, ''
                             ORDER BY turn, role, text)) AS loss_sha256,
           CAST(sum(length(role) + 24 + length(regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g')))
                AS BIGINT) AS formatted_chars
    FROM c GROUP BY conv_id
    """,
)
def op10(spark: SparkSession, d: str) -> DataFrame:
    given = table(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    more = [(-1, 0, "user", CONTROL), (-1, 1, "assistant", CONTROL)]
    extra = spark.createDataFrame(more, "conv_id long, turn long, role string, text string")
    return chat.read_back(chat.format_chats(given.unionByName(extra)))


CLUSTERS, ROUNDS, DIMS = 8, 10, 64


def _rounds_sql() -> str:
    """All rounds of assigning and averaging, each as one step of a WITH clause."""

    def assigned(i: int) -> str:
        return f"""
    a{i} AS MATERIALIZED (
        SELECT n, min(d * {CLUSTERS} + k) % {CLUSTERS} AS k, min(d * {CLUSTERS} + k) // {CLUSTERS} AS d
        FROM (SELECT n, k, list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
              FROM kept, c{i}) GROUP BY n)"""

    def moved(i: int) -> str:
        return f"""
    c{i + 1} AS MATERIALIZED (
        SELECT k, coalesce(m.c, c{i}.c) AS c FROM c{i} LEFT JOIN (
            SELECT k, list((s - (s % n + n) % n) // n ORDER BY i) AS c FROM (
                SELECT k, i, CAST(sum(v[i]) AS BIGINT) AS s, count(*) AS n
                FROM (SELECT k, v, unnest(range(1, {DIMS + 1})) AS i FROM a{i} JOIN kept USING (n))
                GROUP BY k, i) GROUP BY k) AS m USING (k))"""

    steps = [step(i) for i in range(ROUNDS) for step in (assigned, moved)]
    return ",".join([*steps, assigned(ROUNDS)])


@query(
    "op11_centroids",
    f"""
    WITH sound AS (
        SELECT vec_id, embedding FROM embeddings
        WHERE len(embedding) = {DIMS} AND len(list_filter(embedding, lambda x: isfinite(x))) = {DIMS}),
    kept AS MATERIALIZED (
        SELECT row_number() OVER () AS n, vec_id, sha256('3:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h,
               list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
        FROM sound),
    c0 AS MATERIALIZED (
        SELECT row_number() OVER (ORDER BY h, v) - 1 AS k, v AS c
        FROM kept QUALIFY row_number() OVER (ORDER BY h, v) <= {CLUSTERS}),{_rounds_sql()}
    SELECT vec_id, CAST(k AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
           CAST(sum(d) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia,
           CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
    FROM a{ROUNDS} JOIN kept USING (n) JOIN c{ROUNDS} USING (k)
    """,
)
def op11(spark: SparkSession, d: str) -> DataFrame:
    return centroids.clustered(table(spark, d, "embeddings"), CLUSTERS, ROUNDS, DIMS)


@query("op12_simhash")
def op12(spark: SparkSession, d: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, d, "documents"), k=3, radius=3)


@query(
    "op13_divergence",
    r"""
    WITH d AS (
        SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
               regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
        FROM documents),
    t AS (SELECT row, lang, source, unnest(terms) AS term FROM d),
    kept AS (
        SELECT lang, term, count(*) AS n FROM t GROUP BY lang, term HAVING count(DISTINCT row) >= 3),
    sizes AS (SELECT lang, count(*) AS v, CAST(sum(n) AS BIGINT) AS total FROM kept GROUP BY lang),
    used AS (SELECT lang, source, term, count(*) AS n FROM t JOIN kept k USING (lang, term) GROUP BY ALL),
    groups AS (SELECT DISTINCT lang, source FROM d),
    stats AS (
        SELECT lang, source, coalesce(own, 0) AS own
        FROM groups LEFT JOIN (SELECT lang, source, CAST(sum(n) AS BIGINT) AS own FROM used GROUP BY ALL)
             USING (lang, source)),
    dense AS (
        SELECT s.lang, s.source, k.term, coalesce(u.n, 0) AS n,
               1 + (1000000000 * (coalesce(u.n, 0) + 1)) // (s.own + z.v) AS p,
               1 + (1000000000 * (k.n + 1)) // (z.total + z.v) AS q
        FROM stats s JOIN sizes z USING (lang) JOIN kept k USING (lang)
             LEFT JOIN used u ON u.lang = s.lang AND u.source = s.source AND u.term = k.term),
    sums AS (
        SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
        FROM dense a JOIN dense b ON a.lang = b.lang AND a.term = b.term AND a.source != b.source
        GROUP BY ALL),
    pairs AS (
        SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
        FROM groups a JOIN groups b ON a.lang = b.lang AND a.source != b.source
             LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
    terms AS (
        SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q)) // q AS value
        FROM dense WHERE n > 0 AND p > q)
    SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
           CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
    FROM (FROM pairs UNION ALL FROM terms) QUALIFY part = 'pair' OR rank <= 200
    """,
)
def op13(spark: SparkSession, d: str) -> DataFrame:
    return divergence.audit(table(spark, d, "documents"))
