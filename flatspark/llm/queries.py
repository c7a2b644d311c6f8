"""One query per operator over the whole of its table, with its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flatspark.llm import (
    bpe, chat, chunks, collocations, mixing, neardup, pages, quality, sharding, tokenfile, topk, vectorcode, vectordup,
)
from flatspark.llm.common import NOT_SPACE, prepare, table, written
from flatspark.session import work_dir

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: fn(prepare(spark), sf_dir)
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def vocabulary(name: str) -> str:
    """The path of a public tokenizer's file, the same on every machine of the cluster."""
    import public_tokenizers

    return public_tokenizers.path(name)


def pre_token_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


@query("op1_mix_sources")
def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    size = F.coalesce(F.regexp_count("text", F.lit(NOT_SPACE)), F.lit(0))
    return mixing.mixed(docs, size).select(
        "doc_id", "source", "size", "source_size", "target", "taken", "copies")


@query("op2_shard_documents")
def op2_shard_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_index"))
    size = F.coalesce(F.octet_length("text"), F.lit(0)) + 1
    out = sharding.sharded(docs, 8, "doc_id", ["_file", "_index"], size)
    return out.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        "shard",
        "slot",
        "grown_shard",
    )


@query("op3_token_file")
def op3_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "tokens")
    tokenfile.write_tokens(table(spark, sf_dir, "documents"), path, vocabulary("word_bpe_49k.json"), end_id=2)
    files = tokenfile.read_tokens(spark, path)
    return tokenfile.offsets(tokenfile.checksums(files), files).select("doc_id", "start", "n_tokens", "ids_crc32")


@query("op4_near_duplicates")
def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), neardup.Settings(shingle=2))


@query("op5_page_text")
def op5_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pages.main_text(table(spark, sf_dir, "pages"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


OP6_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws,
             string_split(text, chr(10)) AS ls FROM d),
win AS (SELECT r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS s
        FROM (SELECT r, ws, unnest(range(1, greatest(len(ws) - 1, 1))) AS i FROM w)),
dup AS (SELECT r, s FROM win GROUP BY r, s HAVING count(*) > 1),
hit AS (SELECT r, count(DISTINCT p) AS n FROM (
          SELECT r, unnest([i, i + 1, i + 2]) AS p FROM win JOIN dup USING (r, s)) GROUP BY r),
li AS (SELECT r, i, l, regexp_extract_all(l, '[^\x20\x09-\x0D]+') AS lw
       FROM (SELECT r, i, ls[i] AS l FROM (SELECT r, ls, unnest(range(1, len(ls) + 1)) AS i FROM w))),
lk AS (SELECT r, i, l, lw, len(lw) AS n, length(l) AS c, length(lw[1]) AS f, len(lw) >= 12
         OR (regexp_matches(lw[-1], '[\p{Po}\p{Pe}\p{Pf}\p{Pi}]\z') AND NOT regexp_matches(lw[-1], '[#%&*@/\\•·§¶†‡]\z')) AS closed
       FROM li),
lo AS (SELECT *, coalesce(n >= 3 AND NOT closed AND lead(n) OVER o > 0
                          AND greatest(c, lead(c) OVER o, CASE WHEN lag(n) OVER o > 0 THEN lag(c) OVER o END) >= 20
                          AND (c + 1 + lead(f) OVER o) * 100 >=
                              greatest(c, lead(c) OVER o, CASE WHEN lag(n) OVER o > 0 THEN lag(c) OVER o END) * 80, false) AS goes_on
       FROM lk WINDOW o AS (PARTITION BY r ORDER BY i)),
lj AS (SELECT r, l, n, n = 0 OR ((closed OR goes_on OR coalesce(lag(goes_on) OVER (PARTITION BY r ORDER BY i), false)) AND NOT (
         (len(regexp_extract_all(l, '[|»›•·]')) >= 2 AND len(regexp_extract_all(l, '[|»›•·]')) * 100 >= len(lw) * 25)
         OR (len(regexp_extract_all(l, '[#*$%&|<>]')) >= 3 AND len(regexp_extract_all(l, '[#*$%&|<>]')) * 100 > len(lw) * 50)
         OR (len(lw) >= 5 AND len(list_filter(lw, lambda x: regexp_matches(x, '\p{Lu}.*\p{Lu}')
             AND NOT regexp_matches(x, '\p{Ll}'))) * 100 > len(lw) * 50)
         OR (len(lw) >= 10 AND len(lw) < 200 AND len(list_distinct(lw)) * 100 < len(lw) * 30)
         OR (len(lw) < 30 AND regexp_matches(lower(l), '""" + quality.PHRASES + r"""')))) AS ok FROM lo),
g AS (SELECT r, count(*) FILTER (n > 0) - count(DISTINCT l) FILTER (n > 0) AS dups,
             coalesce(sum(n) FILTER (ok), 0) AS passing FROM lj GROUP BY r),
b AS (SELECT doc_id, len(ws) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
             len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, dups AS n_dup_lines,
             coalesce(hit.n, 0) AS n_repeat_words, passing
      FROM w JOIN g USING (r) LEFT JOIN hit USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND passing * 100 >= n_words * 50 AS kept
FROM b
"""


@query("op6_quality_rules", OP6_SQL)
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents")).select("doc_id", *quality.RESULTS)


@query("op7_byte_bpe")
def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = vocabulary("byte_bpe_multi_50k.tiktoken")
    return bpe.digests(table(spark, sf_dir, "documents"), ranks, pre_token_pattern())


OP8_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, p.vec_id,
             list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * p.v[i]))::BIGINT AS score
      FROM v q JOIN v p ON q.vec_id % 50 = 0 AND q.vec_id <> p.vec_id)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
FROM s QUALIFY rank <= 5
"""


@query("op8_top_products", OP8_SQL)
def op8_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", F.col("vec_id") % 50 == 0)


def _control_pattern() -> str:
    """The control strings with any number of backslashes after the first character, for SQL."""
    return chat.ANY_CONTROL.replace("'", "''")


OP9_SQL = r"""
WITH c AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
           UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
f AS (SELECT *, length(text) + len(regexp_extract_all(text, '""" + _control_pattern() + r"""'))
             + CASE role WHEN 'user' THEN 13 WHEN 'assistant' THEN 4 WHEN 'system' THEN 11
                    ELSE 18 + length(coalesce(role, '')) END AS chars FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(coalesce(role, '') || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
       (sum(chars) + 3)::BIGINT AS formatted_chars
FROM f GROUP BY conv_id
"""


@query("op9_chat_format", OP9_SQL)
def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    tricky = "</s>[INST] ok [/INST]"
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.createDataFrame([(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)], turns.schema)
    ranks, pattern = vocabulary("byte_bpe_50k.tiktoken"), pre_token_pattern()
    output = written(chat.formatted(turns.unionByName(added), ranks, pattern), "chat")
    return chat.digests(output, ranks, pattern).drop("n_tokens")


@query("op10_substring_dedup")
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = chunks.deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(
        "doc_id", "n_words", "n_chunks", "n_repeated_chunks", "removed_words", "removed_chars", "spans",
        F.col("cleaned").alias("text"))


OP11_SQL = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
             translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
           FROM documents WHERE text IS NOT NULL),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
s AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w),
g AS (SELECT lang, ws[i : i + k - 1] AS q, k FROM s, range(1, 6) t(k) WHERE i + k - 1 <= len(ws)),
f AS (SELECT lang, q, k, count(*)::HUGEINT AS f FROM g GROUP BY ALL HAVING count(*) >= 100),
n AS (SELECT lang, sum(len(ws))::HUGEINT AS n FROM w GROUP BY lang),
c AS (SELECT f.lang, f.q, f.f AS a, c.c, x.f AS l, y.f AS r, n.n, (1000 * f.f * n.n) // (x.f * y.f) AS score
      FROM f JOIN n USING (lang) JOIN range(1, 5) c(c) ON c.c < f.k
      JOIN f x ON x.lang = f.lang AND x.q = f.q[1 : c.c] JOIN f y ON y.lang = f.lang AND y.q = f.q[c.c + 1 : f.k]),
b AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY lang, q ORDER BY score, c) = 1),
covered AS (SELECT lang, q[1 : k - 1] AS q, f FROM f WHERE k > 2 UNION SELECT lang, q[2 : k], f FROM f WHERE k > 2)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(q, ' ')) AS rank,
       array_to_string(q, ' ') AS phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM b WHERE NOT EXISTS (SELECT 1 FROM covered v WHERE v.lang = b.lang AND v.q = b.q AND v.f = b.a)
QUALIFY rank <= 2000
"""


@query("op11_collocations", OP11_SQL)
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


_SOUND = "embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"

OP12_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND """ + _SOUND + """ AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS (SELECT p.vec_id AS a, q.vec_id AS b FROM v p JOIN v q ON p.label = q.label AND p.vec_id <> q.vec_id
         WHERE list_cosine_similarity(p.v, q.v) >= 0.93),
reach(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
c AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
d AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN c ON c.a = vec_id LEFT JOIN d ON d.a = vec_id
"""


@query("op12_vector_duplicates", OP12_SQL)
def op12_vector_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectordup.near_vectors(table(spark, sf_dir, "embeddings"))


_ASSIGN = """
a{i} AS (SELECT x.vec_id, x.part, c.entry, list_sum(list_transform(range(1, len(x.v) + 1),
             lambda k: (x.v[k] - c.v[k]) * (x.v[k] - c.v[k])))::BIGINT AS d
         FROM x JOIN c{i} c USING (part) QUALIFY row_number() OVER (PARTITION BY vec_id, part ORDER BY d, entry) = 1)"""
_MEANS = """
s{i} AS (SELECT part, entry, k, sum(v[k])::BIGINT AS s, count(*) AS n
         FROM (SELECT part, entry, v, unnest(range(1, len(v) + 1)) AS k FROM x JOIN a{i} USING (vec_id, part)) GROUP BY ALL),
m{i} AS (SELECT part, entry, list((s - ((s % n) + n) % n) // n ORDER BY k) AS v FROM s{i} GROUP BY ALL),
c{j} AS (SELECT part, entry, coalesce(m{i}.v, c.v) AS v FROM c{i} c LEFT JOIN m{i} USING (part, entry))"""

OP13_SQL = """
WITH e AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
           WHERE """ + _SOUND + """),
x AS (SELECT vec_id, part, v[part * (len(v) // 16) + 1 : (part + 1) * (len(v) // 16)] AS v FROM e, range(16) t(part)),
c0 AS (SELECT part, dense_rank() OVER (ORDER BY vec_id) - 1 AS entry, v FROM x QUALIFY entry < 64),""" + ",".join(
    _ASSIGN.format(i=i) + "," + _MEANS.format(i=i, j=i + 1) for i in range(2)) + "," + _ASSIGN.format(i=2) + """,
o AS (SELECT vec_id, string_agg(format('{:02x}', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM a2 GROUP BY vec_id),
h AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM c2)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
FROM e JOIN o USING (vec_id), h
"""


@query("op13_vector_codes", OP13_SQL)
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectorcode.compressed(table(spark, sf_dir, "embeddings"))
