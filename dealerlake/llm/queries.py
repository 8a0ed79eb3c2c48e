"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dealerlake.llm.chat import format_chats, read_back
from dealerlake.llm.clustering import clusters
from dealerlake.llm.fingerprints import fingerprints
from dealerlake.llm.hard_negatives import hard_negatives
from dealerlake.llm.katz import language_model
from dealerlake.llm.mixing import mix
from dealerlake.llm.near_duplicates import near_duplicates
from dealerlake.llm.packing import pack
from dealerlake.llm.quality_model import quality
from dealerlake.llm.quality_rules import quality_rules
from dealerlake.llm.store import importable, read
from dealerlake.llm.token_counts import token_counts
from dealerlake.llm.toxicity import toxicity
from dealerlake.llm.url_rules import judge_urls


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def one_two_three(names: list[str | None]) -> dict[str | None, float]:
    """Sources in order weigh 1, 2, 3, 1, 2, 3, ..."""
    return {name: float(1 + i % 3) for i, name in enumerate(names)}


def op1_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality(read(spark, folder, "documents"), read(spark, folder, "labels"))


RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op2_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    return judge_urls(read(spark, folder, "pages"), spark.createDataFrame(RULES, "host string, path string, verdict string"))


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity(read(spark, folder, "documents"), read(spark, folder, "labels"))


def op4_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text", F.array(F.col("source").cast("string")).alias("sources"))
    mixed, sizes, goal = mix(docs, weights=one_two_three)
    per_source = spark.createDataFrame([([s], sizes[s], float(goal[s])) for s in sizes], "sources array<string>, source_size long, target double")
    return mixed.join(per_source, "sources").select(
        "doc_id", "size", "source_size", "target", "taken", F.col("sources")[0].alias("source"), "copies"
    )


def op5_language_model(spark: SparkSession, folder: str) -> DataFrame:
    return language_model(read(spark, folder, "documents"))


def op6_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints(read(spark, folder, "documents"))


def op7_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules(read(spark, folder, "documents"), read(spark, folder, "labels"))


def op8_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(read(spark, folder, "documents"), percent=85, size=3)


def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    return piece_digests(pack(read(spark, folder, "documents"), tokenizer_file("byte_bpe_50k.json")))


def piece_digests(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "source")


def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts(read(spark, folder, "documents"), tokenizer_file("word_bpe_49k.json"))


#: A conversation whose texts are made of the template's own control strings.
TRICKY = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


def op11_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    every = read(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return read_back(format_chats(every.union(spark.createDataFrame(TRICKY, "conv_id long, turn long, role string, text string"))))


def op12_clustering(spark: SparkSession, folder: str) -> DataFrame:
    return clusters(read(spark, folder, "embeddings"), k=16, rounds=3, size=64, factor=64, seed=1).drop("n_distances")


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    def moved(vec_id, label):
        return F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)

    return hard_negatives(read(spark, folder, "embeddings"), every=100, positives=5, negatives=10, low=30, high=90, factor=256, relabel=moved)


QUERIES = (
    op1_quality, op2_url_rules, op3_toxicity, op4_mixing, op5_language_model, op6_fingerprints, op7_quality_rules, op8_near_duplicates,
    op9_packing, op10_token_counts, op11_chat_format, op12_clustering, op13_hard_negatives,
)


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: importable(f) for f in QUERIES}


def llm_sql() -> dict[str, str]:
    """DuckDB SQL of the queries that SQL can express."""
    rules = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)
    return {
        "op2_url_rules": f"""
            WITH rules(h, p, v) AS (VALUES {rules}),
            parts AS (
                SELECT page_id,
                    coalesce(translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
                    coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
                FROM pages
            ),
            fits AS (
                SELECT page_id, max_by(h || p, length(h || p)) AS rule, max_by(v, length(h || p)) AS verdict
                FROM parts, rules
                WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
                GROUP BY page_id
            )
            SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
            FROM parts LEFT JOIN fits USING (page_id)
        """,
        "op8_near_duplicates": r"""
            WITH RECURSIVE
            split AS (
                SELECT doc_id, regexp_extract_all(
                    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
                FROM documents
            ),
            sets AS (
                SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                    ELSE list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] for i in range(1, len(w) - 1)]) END AS s
                FROM split
            ),
            each AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
            links AS (
                SELECT a.doc_id AS x, b.doc_id AS y
                FROM each a JOIN each b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
                GROUP BY a.doc_id, b.doc_id, a.n, b.n
                HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
            ),
            ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
            reach(x, y) AS (
                SELECT doc_id, doc_id FROM documents
                UNION SELECT reach.x, ways.y FROM reach JOIN ways ON reach.y = ways.x
            ),
            smallest AS (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x)
            SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
            FROM sets JOIN smallest USING (doc_id)
        """,
        "op11_chat_format": _chat_sql(),
        "op12_clustering": _clustering_sql(),
        "op13_hard_negatives": _hard_negatives_sql(),
    }


def _chat_sql() -> str:
    tricky = ", ".join(f"({c}, {t}, '{r}', '{x}')" for c, t, r, x in TRICKY)
    inside = r"\[\\*(?:/?INST|/?SYS|/?ROLE|SAYS)\]|<\\*/?s>"
    place = "turn NULLS FIRST, role, text"
    return rf"""
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT * FROM (VALUES {tricky})
        ),
        placed AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY {place}) AS place,
                CASE WHEN role IN ('system', 'user', 'assistant') THEN role END AS known,
                length(text) + len(regexp_extract_all(text, '{inside}')) AS escaped,
                CASE role WHEN 'system' THEN 11 WHEN 'user' THEN 13 WHEN 'assistant' THEN 7
                    ELSE 19 + length(role) + len(regexp_extract_all(role, '{inside}')) END AS marks
            FROM turns
        ),
        states AS (
            SELECT *,
                coalesce(last_value(known IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 'start') AS before,
                coalesce(last_value(known IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 'start') AS after
            FROM placed
        )
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
            CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
            CAST(sum(escaped + marks) AS BIGINT) AS formatted_chars,
            count(*) FILTER (WHERE (before || '>' || role) NOT IN ('start>system', 'start>user', 'system>user', 'user>assistant', 'assistant>user')) AS n_invalid,
            arg_max(after, place) = 'assistant' AS complete
        FROM states GROUP BY conv_id
    """


_WHOLE = "len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"


def _clustering_sql() -> str:
    steps = []
    for n in range(4):
        steps.append(f"""
            near{n} AS (
                SELECT id, any_value(x.vec_id) AS vec_id, any_value(x.v) AS v,
                    min(struct_pack(d := CAST(list_sum(list_transform(range(1, 65), lambda i: (x.v[i] - m.v[i]) * (x.v[i] - m.v[i]))) AS BIGINT), c := m.c)) AS best
                FROM kept x, middle{n} m GROUP BY id
            )""")
        if n < 3:
            steps.append(f"""
            mean{n} AS (
                SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v
                FROM (SELECT best.c AS c, i, CAST(sum(v[i]) AS BIGINT) AS s, count(*) AS n FROM near{n}, range(1, 65) t(i) GROUP BY best.c, i)
                GROUP BY c
            ),
            middle{n + 1} AS (SELECT c, coalesce(e.v, m.v) AS v FROM middle{n} m LEFT JOIN mean{n} e USING (c))""")
    return f"""
        WITH kept AS (
            SELECT row_number() OVER (ORDER BY vec_id) AS id, vec_id,
                list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings WHERE len(embedding) = 64 AND {_WHOLE}
        ),
        middle0 AS (
            SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v
            FROM (SELECT v, sha256('1:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h FROM kept) ORDER BY h, v LIMIT 16
        ),
        {",".join(steps)}
        SELECT vec_id, CAST(best.c AS INTEGER) AS cluster, best.d AS distance,
            CAST(sum(best.d) OVER (PARTITION BY best.c) AS BIGINT) AS cluster_inertia, CAST(sum(best.d) OVER () AS BIGINT) AS inertia,
            sha256(array_to_string(m.v, ',')) AS centroid_sha256
        FROM near3 JOIN middle3 m ON m.c = best.c
    """


def _hard_negatives_sql() -> str:
    return f"""
        WITH kept AS (
            SELECT row_number() OVER (ORDER BY vec_id) AS id, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND {_WHOLE}
        ),
        scored AS (
            SELECT a.id AS anchor, a.vec_id AS anchor_id, x.id AS other, x.vec_id AS vec_id, a.label = x.label AS same,
                CAST(coalesce(list_sum(list_transform(range(1, least(len(a.v), len(x.v)) + 1), lambda i: a.v[i] * x.v[i])), 0) AS BIGINT) AS score
            FROM kept a, kept x WHERE a.vec_id % 100 = 0 AND a.id <> x.id
        ),
        positives AS (
            SELECT * FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id NULLS LAST, other) <= 5
        )
        SELECT p.anchor_id, p.vec_id AS positive_id,
            CAST(row_number() OVER (PARTITION BY p.anchor, p.other ORDER BY n.score DESC, n.vec_id NULLS LAST, n.other) AS INTEGER) AS rank,
            n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
        FROM positives p JOIN scored n ON n.anchor = p.anchor AND NOT n.same AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
        QUALIFY rank <= 10
    """
