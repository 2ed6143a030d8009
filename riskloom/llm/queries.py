"""Queries over the operators of this package, and the SQL some of them equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, stage
from . import (
    bpe,
    chat,
    decontam,
    exact,
    lexical,
    minhash,
    neighbours,
    pii,
    records,
    secret_scan,
    token_counts,
    toxicity,
    vector_codes,
)
from .common import table

# A conversation that holds a template's control strings.
TRICKY_TEXT = "\\### Assistant: </turn> ok"


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = spark.createDataFrame(
        [(-7, 0, "user", TRICKY_TEXT), (-7, 1, "assistant", TRICKY_TEXT)],
        "conv_id bigint, turn bigint, role string, text string",
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.read_chats(stage(chat.format_chats(rows.unionByName(extra)), "chats"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return toxicity.score_documents(documents, toxicity.fit(documents, table(spark, sf_dir, "labels")))


def op6_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "records")
    index = records.write_records(table(spark, sf_dir, "documents"), path)
    return records.record_digests(index)


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans"
    )


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    found = pii.find_personal_data(documents, pii.train(documents))
    return found.select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans"
    )


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumn("score", F.round("score", 6))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "flat-tokens")
    token_counts.write_flat_tokens(table(spark, sf_dir, "documents"), path)
    return token_counts.document_token_counts(spark, path)


def op11_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors, vectors.where("vec_id % 100 = 0"), k=10, factor=1.0)


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, codebooks = vector_codes.compress(table(spark, sf_dir, "embeddings"))
    named = vector_codes.with_label_error(coded).select("vec_id", "code", "error", "label_error")
    return named.withColumn("codebooks_sha256", F.lit(vector_codes.codebooks_digest(codebooks)))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = stage(lexical.build_index(table(spark, sf_dir, "documents")), "lexical-index")
    return lexical.search(index, table(spark, sf_dir, "benchmark"), k=10)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_near_dedup": op1_near_dedup,
    "op2_chat_formatting": op2_chat_formatting,
    "op3_bpe": op3_bpe,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_toxicity": op5_toxicity,
    "op6_token_records": op6_token_records,
    "op7_secrets": op7_secrets,
    "op8_pii": op8_pii,
    "op9_decontamination": op9_decontamination,
    "op10_token_counts": op10_token_counts,
    "op11_nearest_neighbours": op11_nearest_neighbours,
    "op12_vector_codes": op12_vector_codes,
    "op13_lexical_search": op13_lexical_search,
}

_CHAT_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), escaped AS (
  SELECT *, replace(replace(replace(replace(text, '\', '\\'), '<turn>', '\<turn>'), '<says>', '\<says>'), '</turn>', '\</turn>') AS e_text,
    replace(replace(replace(replace(role, '\', '\\'), '<turn>', '\<turn>'), '<says>', '\<says>'), '</turn>', '\</turn>') AS e_role
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(e_text) + length(e_role) + length('<turn><says></turn>')) AS BIGINT) AS formatted_chars
FROM escaped GROUP BY conv_id
"""

_EXACT_SQL = r"""
WITH named AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
    sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents
), ranked AS (
  SELECT doc_id, text_sha256, count(*) OVER (PARTITION BY text_sha256) AS group_size,
    first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id
  FROM named
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM ranked
"""

_NEAR_SQL = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws
  FROM documents
), shingled AS (
  SELECT doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS s
  FROM worded
), sized AS (
  SELECT doc_id, len(s) AS n_shingles, s FROM shingled
), singles AS (
  SELECT doc_id, n_shingles, unnest(s) AS sh FROM sized
), links AS (
  SELECT a.doc_id AS x, b.doc_id AS y
  FROM singles a JOIN singles b ON a.sh = b.sh AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n_shingles, b.n_shingles
  HAVING 100 * count(*) >= 85 * (a.n_shingles + b.n_shingles - count(*))
), reached AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION
  SELECT r.doc_id, l.y FROM reached r JOIN links l ON r.other = l.x
), named AS (
  SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id
)
SELECT doc_id, n_shingles, component_id, doc_id = component_id AS kept FROM sized JOIN named USING (doc_id)
"""

_BENCHMARK_SQL = r"""
WITH items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS ws
  FROM benchmark
), segments AS (
  SELECT item_id, start // 64 AS part, ws[start + 1:start + 64] AS ws
  FROM (SELECT item_id, ws, unnest(range(0, len(ws), 64)) AS start FROM items)
), sizes AS (
  SELECT count(*) AS n, avg(len(ws)) AS mean FROM segments
), terms AS (
  SELECT item_id, part, len(ws) AS size, unnest(ws) AS word FROM segments
), tf AS (
  SELECT item_id, part, size, word, count(*) AS tf FROM terms GROUP BY ALL
), idf AS (
  SELECT word, ln(1 + (n - count(*) + 0.5) / (count(*) + 0.5)) AS w FROM tf, sizes GROUP BY word, n
), raw AS (
  SELECT item_id, part, word, w * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * size / mean)) AS score FROM tf JOIN idf USING (word), sizes
), own AS (
  SELECT item_id, part, word, score / sum(score) OVER (PARTITION BY item_id, part) AS score FROM raw
), docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS ws
  FROM documents
), placed AS (
  SELECT doc_id, greatest(1, (len(ws) + 63) // 64 - 1) AS many, unnest(ws) AS word, (unnest(range(0, len(ws)))) // 64 AS step FROM docs
), passages AS (
  SELECT doc_id, step AS passage, word FROM placed WHERE step < many
  UNION
  SELECT doc_id, step - 1, word FROM placed WHERE step >= 1
), scored AS (
  SELECT doc_id, passage, item_id, part, sum(score) AS score
  FROM passages JOIN own USING (word) GROUP BY ALL HAVING sum(score) >= 0.5 - 1e-9
), best AS (
  SELECT doc_id, item_id, max(score) AS score FROM scored GROUP BY ALL
), item_grams AS (
  SELECT item_id, least(5, len(ws)) AS size, list_transform(range(1, len(ws) - least(5, len(ws)) + 2), lambda i: array_to_string(ws[i:i + least(5, len(ws)) - 1], ' ')) AS runs
  FROM items
), parts AS (
  SELECT item_id, size, greatest(1, len(runs) // 4) AS last, runs FROM item_grams
), asked AS (
  SELECT b.doc_id, b.item_id, b.score, runs,
    CASE WHEN len(runs) > last THEN runs[1:len(runs) - last] ELSE runs END AS question,
    runs[len(runs) - last + 1:len(runs)] AS answer,
    list_transform(range(1, len(ws) - size + 2), lambda i: array_to_string(ws[i:i + size - 1], ' ')) AS held
  FROM best b JOIN parts USING (item_id) JOIN docs d ON d.doc_id = b.doc_id
), verified AS (
  SELECT doc_id, item_id, round(score, 6) AS score,
    len(list_filter(question, lambda g: list_contains(held, g))) / len(question) AS question_overlap,
    len(list_filter(answer, lambda g: list_contains(held, g))) / len(answer) AS answer_overlap,
    len(list_filter(runs, lambda g: list_contains(held, g))) / len(runs) AS whole_overlap
  FROM asked
)
SELECT doc_id, item_id, score, question_overlap, answer_overlap FROM verified
WHERE question_overlap >= 0.5 AND answer_overlap >= 0.5 OR whole_overlap >= 0.7
"""

_NEAREST_SQL = r"""
WITH vectors AS (
  SELECT vec_id, embedding FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), asked AS (
  SELECT DISTINCT vec_id AS query_id, embedding AS q FROM vectors WHERE vec_id % 100 = 0
), pairs AS (
  SELECT query_id, vec_id, sqrt(list_reduce(list_prepend(0::DOUBLE, list_transform(range(1, len(q) + 1),
    lambda i: (q[i]::DOUBLE - embedding[i]::DOUBLE) * (q[i]::DOUBLE - embedding[i]::DOUBLE))), lambda x, y: x + y)) AS score
  FROM asked JOIN vectors ON vec_id <> query_id AND len(q) = len(embedding)
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS INTEGER) AS rank, vec_id, score
FROM pairs QUALIFY rank <= 10
"""


def _codes_sql() -> str:
    """Lloyd's rounds that compare every part with every entry."""
    steps = []
    for step in range(vector_codes.ROUNDS + 1):
        steps.append(f"""
a{step} AS MATERIALIZED (
  SELECT n, x.p, min(struct_pack(d := list_dot_product(x, x) - 2 * list_dot_product(x, c) + list_dot_product(c, c), e := e)) AS best
  FROM parts x JOIN c{step} ON x.p = c{step}.p GROUP BY n, x.p
)""")
        if step < vector_codes.ROUNDS:
            steps.append(f"""
m{step} AS (
  SELECT p, e, list(mean ORDER BY i) AS c FROM (
    SELECT p, e, i, floor(sum(v) / count(*)) AS mean
    FROM (SELECT p, best.e AS e, unnest(x) AS v, unnest(range(len(x))) AS i FROM parts JOIN a{step} USING (n, p)) GROUP BY p, e, i
  ) GROUP BY p, e
), c{step + 1} AS MATERIALIZED (
  SELECT p, e, coalesce(m{step}.c, c{step}.c) AS c FROM c{step} LEFT JOIN m{step} USING (p, e)
)""")
    last = vector_codes.ROUNDS
    return f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST) - 1 AS n, vec_id, label,
    list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
  SELECT n, p, v[p * (len(v) // 4) + 1:(p + 1) * (len(v) // 4)] AS x FROM kept, range(4) r(p)
), c0 AS (
  SELECT p, n AS e, x AS c FROM parts WHERE n < 256
), {",".join(steps)}, coded AS (
  SELECT n, string_agg(printf('%02x', best.e), '' ORDER BY p) AS code, CAST(sum(best.d) AS BIGINT) AS error FROM a{last} GROUP BY n
), summed AS (
  SELECT label, CAST(sum(error) AS BIGINT) AS label_error FROM kept JOIN coded USING (n) GROUP BY label
), books AS (
  SELECT sha256(string_agg(CAST(CAST(v AS BIGINT) AS VARCHAR), ',' ORDER BY p, e, i)) AS codebooks_sha256
  FROM (SELECT p, e, unnest(c) AS v, unnest(range(len(c))) AS i FROM c{last})
)
SELECT vec_id, code, error, label_error, codebooks_sha256
FROM kept JOIN coded USING (n) JOIN summed ON kept.label IS NOT DISTINCT FROM summed.label, books
"""


_RANKED_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS n, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS ws
  FROM documents
), corpus AS (
  SELECT CAST(count(*) AS BIGINT) AS many, CAST(sum(len(ws)) AS BIGINT) AS words FROM docs WHERE len(ws) > 0
), asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+')) AS term
  FROM benchmark
), tf AS (
  SELECT n, doc_id, len(ws) AS size, term, count(*) AS tf
  FROM (SELECT n, doc_id, ws, unnest(ws) AS term FROM docs) WHERE term IN (SELECT term FROM asked) GROUP BY n, doc_id, ws, term
), weighted AS (
  SELECT term, CAST(floor(1000 * ln((2 * many + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM tf, corpus GROUP BY term, many
), scored AS (
  SELECT item_id, n, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * size * many) // words)))) AS BIGINT) AS score
  FROM asked JOIN tf USING (term) JOIN weighted USING (term), corpus GROUP BY item_id, n, doc_id
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 10
"""

ORACLE: dict[str, str] = {
    "op11_nearest_neighbours": _NEAREST_SQL,
    "op12_vector_codes": _codes_sql(),
    "op13_lexical_search": _RANKED_SQL,
    "op9_decontamination": _BENCHMARK_SQL,
    "op1_near_dedup": _NEAR_SQL,
    "op2_chat_formatting": _CHAT_SQL,
    "op4_exact_dedup": _EXACT_SQL,
}
