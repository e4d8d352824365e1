"""The registered queries over the given tables, and SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.llm import maxent, neighbours, pii, quality, urls
from martwright.llm.collocations import collocations
from martwright.llm.common import shared_path, table
from martwright.llm.exact_dedup import exact_dedup
from martwright.llm.near_dedup import near_duplicates
from martwright.llm.packing import pack
from martwright.llm.pieces import piece_digests
from martwright.llm.token_counts import count_tokens
from martwright.llm.token_files import read_token_files, write_token_files
from martwright.llm.vector_codes import vector_codes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# DuckDB: the text with A-Z lower-cased.
LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql:
            ORACLE[name] = sql.strip()
        return function

    return register


@query(
    "op1_exact_dedup",
    f"""
    WITH d AS (SELECT doc_id, sha256({LOWERED}) AS h FROM documents)
    SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
           doc_id = max(doc_id) OVER g AS kept, h AS text_sha256
    FROM d WINDOW g AS (PARTITION BY h)
    """,
)
def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents")).drop("row")


@query("op2_quality_rules")
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.judge(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


URL_RULES = [
    urls.Rule("allow", "com/"),
    urls.Rule("block", "example.com/en/"),
    urls.Rule("allow", "www.example.com/en/"),
    urls.Rule("block", "net/es/"),
    urls.Rule("block", "net/fr/"),
]


@query("op3_url_filter")
def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = urls.ruled(table(spark, sf_dir, "pages"), URL_RULES)
    known = parts.where("rule IS NOT NULL").select("host", "path", F.col("rule_verdict").alias("verdict"))
    return urls.judge(parts, urls.fit(known))


@query("op4_token_files")
def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    path = write_token_files(table(spark, sf_dir, "documents"), tokenizer, 0, shared_path(spark, "token-files"))
    return read_token_files(spark, path, with_ids=False)


@query("op5_packing")
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return pack(table(spark, sf_dir, "documents"), tokenizer, 1, with_ids=False)


@query("op6_piece_encoding")
def op6_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query("op8_token_counts")
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op7_maxent_score")
def op7_maxent_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent.score(table(spark, sf_dir, "documents"))


@query("op9_personal_data")
def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.find(docs, pii.fit(docs))


@query("op10_near_dedup")
def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).drop("row", "component")


@query("op11_neighbour_quality")
def op11_neighbour_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 3 == 1
    scored = neighbours.score(docs, neighbours.fit(docs, labels.where(~held_out)))
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def _assigned(step: int) -> str:
    """DuckDB: each part's nearest entry of codebooks c<step>; distance and index in one number."""
    return f"""a{step} AS (
        SELECT id, q, min(list_sum(list_transform(range(1, len(x.w) + 1), lambda i: (x.w[i] - c.w[i]) * (x.w[i] - c.w[i])))::BIGINT * 64 + e) AS m
        FROM x JOIN c{step} AS c USING (q) GROUP BY id, q)"""


def _replaced(step: int) -> str:
    """DuckDB: codebooks after assignment a<step>: floors of means, unused entries as they were."""
    return f"""s{step} AS (
        SELECT q, e, list(((t - ((t % n) + n) % n) // n)::BIGINT ORDER BY i) AS w
        FROM (SELECT q, m % 64 AS e, i, sum(x.w[i])::BIGINT AS t, count(*)::BIGINT AS n
              FROM x JOIN a{step} USING (id, q), (SELECT unnest(range(1, (SELECT max(len(w)) FROM x) + 1)) AS i) GROUP BY ALL)
        GROUP BY q, e),
    c{step + 1} AS (SELECT c.q, c.e, coalesce(s.w, c.w) AS w FROM c{step} AS c LEFT JOIN s{step} AS s ON s.q = c.q AND s.e = c.e)"""


@query(
    "op12_vector_codes",
    f"""
    WITH kept AS (
        SELECT row_number() OVER (ORDER BY vec_id) - 1 AS id, vec_id, label,
               list_transform(embedding, lambda v: floor(256 * v::DOUBLE)::BIGINT) AS v
        FROM embeddings
        WHERE len(embedding) > 0 AND list_bool_and(list_transform(embedding, lambda v: v IS NOT NULL AND isfinite(v)))),
    x AS MATERIALIZED (
        SELECT id, q, v[q * (len(v) // 16) + 1 : (q + 1) * (len(v) // 16)] AS w FROM kept, (SELECT unnest(range(16)) AS q)),
    c0 AS (SELECT q, id AS e, w FROM x WHERE id < 64),
    {_assigned(0)}, {_replaced(0)}, {_assigned(1)}, {_replaced(1)}, {_assigned(2)},
    coded AS (
        SELECT id, string_agg(printf('%02x', m % 64), '' ORDER BY q) AS code, sum(m // 64)::BIGINT AS error
        FROM a2 GROUP BY id)
    SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
           (SELECT sha256(string_agg(array_to_string(w, ','), ',' ORDER BY q, e)) FROM c2) AS codebooks_sha256
    FROM kept JOIN coded USING (id)
    """,
)
def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes(table(spark, sf_dir, "embeddings"))


@query(
    "op13_phrase_collocations",
    f"""
    WITH pieces AS (
        SELECT row_number() OVER () AS piece, *
        FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({LOWERED}, '[.,;:!?\\x0A-\\x0D]')) AS body FROM documents)),
    words AS (
        SELECT piece, lang, unnest(w) AS word, generate_subscripts(w, 1) AS i
        FROM (SELECT piece, lang, list_filter(regexp_split_to_array(body, '[ \\t]+'), lambda x: x <> '') AS w FROM pieces)),
    places AS (
        SELECT lang, word AS x, lead(word) OVER g AS y, lead(word, 2) OVER g AS z
        FROM words WINDOW g AS (PARTITION BY piece ORDER BY i)),
    f AS (
        SELECT lang, 1 AS k, [x] AS ws, x AS p, count(*) AS a FROM places GROUP BY ALL UNION ALL
        SELECT lang, 2, [x, y], concat_ws(' ', x, y), count(*) FROM places WHERE y IS NOT NULL GROUP BY ALL UNION ALL
        SELECT lang, 3, [x, y, z], concat_ws(' ', x, y, z), count(*) FROM places WHERE z IS NOT NULL GROUP BY ALL),
    totals AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
    cut AS (
        SELECT lang, k, p, a, j, array_to_string(ws[1 : j], ' ') AS head, array_to_string(ws[j + 1 :], ' ') AS tail
        FROM f, (VALUES (1), (2)) AS t(j) WHERE k > j AND a >= 10),
    cuts AS (
        SELECT cut.lang, cut.k, cut.p, cut.a, x.a AS l, y.a AS r, j,
               (1000000::HUGEINT * cut.a * cut.a // (x.a::HUGEINT * y.a))::BIGINT AS score
        FROM cut JOIN f AS x ON x.lang = cut.lang AND x.p = head JOIN f AS y ON y.lang = cut.lang AND y.p = tail),
    lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, j) = 1),
    covers AS (
        SELECT lang, part, max(a) AS most
        FROM (SELECT lang, a, unnest([array_to_string(ws[1 : 2], ' '), array_to_string(ws[2 : 3], ' ')]) AS part FROM f WHERE k = 3 AND a >= 10)
        GROUP BY ALL),
    ranked AS (
        SELECT lowest.*, p AS phrase, row_number() OVER (PARTITION BY lowest.lang ORDER BY score DESC, a DESC, p) AS rank
        FROM lowest LEFT JOIN covers ON covers.lang = lowest.lang AND covers.part = lowest.p
        WHERE most IS NULL OR 100 * most < 50 * a)
    SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
    """,
)
def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))
