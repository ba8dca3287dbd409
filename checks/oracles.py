"""DuckDB SQL for the queries of the same name, written from the rules, not from the Spark plans."""

from __future__ import annotations

from checks.queries import (
    CONVERSATION_THRESHOLD,
    COPY_OFFSET,
    DOCUMENTS_PER_ARRAY,
    EVAL_RATIO,
    QUESTION,
    SAMPLE_CAP,
    SEED,
    SYSTEM_PROMPT,
    THRESHOLD,
)


# The characters that str.strip() removes.
PY_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008"
    "\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def _strip(text: str) -> str:
    return f"trim({text}, '{PY_WHITESPACE}')"


NL = "chr(10)"
WIDE = "chr(12288)"

ORACLES: dict[str, str] = {}

# -- reading ------------------------------------------------------------------------------------

ORACLES["jsonl_parse_status"] = """
SELECT doc_id,
       CASE n_chars % 8 WHEN 1 THEN 'Invalid JSON' WHEN 2 THEN 'not a JSON object'
                        WHEN 3 THEN 'Invalid JSON' ELSE 'ok' END AS status,
       CASE WHEN n_chars % 8 NOT IN (1, 2, 3) THEN text END AS text
FROM documents
"""

ORACLES["jsonl_source_order"] = """
SELECT row_number() OVER (ORDER BY doc_id) - 1 AS source_index, doc_id, text FROM documents
"""

ORACLES["exact_dedup_numbers"] = """
WITH placed AS (
    SELECT row_number() OVER (ORDER BY doc_id) - 1 AS source_index, n_chars % 50 AS n,
           doc_id % 2 AS spelling, lang, text
    FROM (SELECT * FROM documents
          UNION ALL SELECT * REPLACE (doc_id + 10000000000 AS doc_id) FROM documents)),
firsts AS (
    SELECT source_index, min(source_index) OVER (PARTITION BY n, spelling, lang, text) AS retained
    FROM placed)
SELECT source_index, retained FROM firsts WHERE source_index > retained
"""

ORACLES["json_document_records"] = f"""
SELECT doc_id // {DOCUMENTS_PER_ARRAY} AS part,
       row_number() OVER (PARTITION BY doc_id // {DOCUMENTS_PER_ARRAY} ORDER BY doc_id) - 1
           AS position,
       doc_id, text
FROM documents
"""

ORACLES["turns_to_conversations"] = f"""
SELECT conv_id, count(*) AS n_turns,
       string_agg(role || ': ' || text, {NL} ORDER BY turn) AS dialogue
FROM conversations GROUP BY conv_id
"""

ORACLES["conversations_to_turns"] = """
SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS turn,
       role, text AS content
FROM conversations
"""

# -- conversion and validation ------------------------------------------------------------------

VARIED = f"""
varied AS (
    SELECT conv_id, turn,
           CASE WHEN length(text) % 31 = 0 THEN 'tool'
                WHEN length(text) % 7 = 0 THEN ' ' || upper(role) || ' ' ELSE role END AS role,
           CASE WHEN length(text) % 37 = 0 THEN {WIDE} || {NL}
                ELSE chr(9) || text END AS text
    FROM conversations
)
"""

CONVERTED = f"""
WITH {VARIED},
messages AS (
    SELECT conv_id, turn, role AS raw_role, {_strip("text")} AS content,
           CASE lower({_strip("role")})
               WHEN 'user' THEN 'human' WHEN 'human' THEN 'human'
               WHEN 'assistant' THEN 'gpt' WHEN 'gpt' THEN 'gpt'
               WHEN 'system' THEN 'system' END AS role
    FROM varied
),
checked AS (
    SELECT *, CASE WHEN content = '' THEN 'Conversation message content must be a non-empty string'
                   WHEN role IS NULL THEN 'Unsupported role: ' || raw_role END AS message_error
    FROM messages
),
spoken AS (
    SELECT conv_id, count(*) AS n, arg_min(role, turn) AS first_role,
           arg_max(role, turn) AS last_role,
           count(*) FILTER (WHERE role = before) AS repeats
    FROM (SELECT conv_id, turn, role,
                 lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS before
          FROM checked WHERE role <> 'system')
    GROUP BY conv_id
),
grouped AS (
    SELECT conv_id,
           arg_min(message_error, turn) FILTER (WHERE message_error IS NOT NULL) AS message_error,
           string_agg(role || ': ' || content, {NL} ORDER BY turn) AS dialogue
    FROM checked GROUP BY conv_id
),
converted AS (
    SELECT conv_id, dialogue,
           coalesce(message_error,
               CASE WHEN coalesce(n, 0) < 2 OR first_role <> 'human' OR last_role <> 'gpt'
                    THEN 'Conversation must start with a user turn and end with an assistant turn'
                    WHEN repeats > 0 THEN 'User and assistant turns must alternate' END) AS error
    FROM grouped LEFT JOIN spoken USING (conv_id)
)
"""

ORACLES["conversation_validity"] = (
    CONVERTED
    + """
SELECT conv_id, error, CASE WHEN error IS NULL THEN dialogue END AS dialogue FROM converted
"""
)
ORACLES["sharegpt_to_chat"] = ORACLES["conversation_validity"]
ORACLES["turn_range_validity"] = (
    CONVERTED
    + """
SELECT conv_id, (SELECT count(*) FROM checked c WHERE c.conv_id = converted.conv_id) AS n_turns, error
FROM converted
"""
)
ORACLES["valid_turn_rows"] = (
    CONVERTED
    + """
SELECT conv_id, turn, role, content AS value FROM checked JOIN converted USING (conv_id)
WHERE error IS NULL
"""
)

ORACLES["invalid_reasons"] = (
    CONVERTED
    + """
SELECT coalesce(error, 'valid') AS reason, count(*) AS n_conversations FROM converted GROUP BY 1
"""
)

ORACLES["invalid_sample"] = (
    CONVERTED
    + """
SELECT record_no, 'record ' || record_no || ': ' || error AS message
FROM (SELECT row_number() OVER (ORDER BY conv_id) AS record_no, error FROM converted)
WHERE error IS NOT NULL ORDER BY record_no LIMIT 20
"""
)

ORACLES["message_shapes"] = (
    CONVERTED.replace(
        VARIED,
        """varied AS (
    SELECT conv_id, turn * 2 + again AS turn, role, text
    FROM conversations, (VALUES (0), (1)) twice(again)
    WHERE again = 0 OR conv_id % 7 = 5)""",
    )
    + """
SELECT conv_id,
       CASE conv_id % 7 WHEN 1 THEN 'ShareGPT record is missing conversations/messages'
                        WHEN 2 THEN 'ShareGPT record is missing conversations/messages'
                        WHEN 3 THEN 'ShareGPT record is missing conversations/messages'
                        WHEN 4 THEN coalesce(message_error, 'Each conversation entry must be an object')
                        WHEN 6 THEN 'ShareGPT record is missing conversations/messages'
                        ELSE error END AS error
FROM converted LEFT JOIN grouped USING (conv_id)
"""
).replace("converted LEFT JOIN grouped USING (conv_id)",
          "converted LEFT JOIN (SELECT conv_id, message_error FROM grouped) g USING (conv_id)")

NO_CONTENT = "'Conversation message content must be a non-empty string'"

ORACLES["qa_to_chat"] = f"""
WITH fields AS (
    SELECT doc_id, CASE WHEN n_chars % 7 NOT IN (2, 3) THEN {_strip("text")} ELSE '' END AS human,
           CASE n_chars % 7 WHEN 4 THEN '' WHEN 5 THEN '' WHEN 6 THEN {_strip("lang")}
                            ELSE {_strip("source")} END AS gpt
    FROM documents
)
SELECT doc_id, CASE WHEN human <> '' AND gpt <> '' THEN human END AS human,
       CASE WHEN human <> '' AND gpt <> '' THEN gpt END AS gpt,
       CASE WHEN human = '' OR gpt = '' THEN {NO_CONTENT} END AS error
FROM fields
"""

ORACLES["alpaca_to_chat"] = f"""
WITH fields AS (
    SELECT doc_id,
           lang || CASE WHEN n_chars % 6 = 1 THEN {NL} || {NL} || source ELSE '' END AS human,
           {_strip("text")} AS gpt,
           CASE WHEN n_chars % 6 = 4 THEN 'Alpaca record is missing a non-empty instruction'
                WHEN n_chars % 6 = 5 OR {_strip("text")} = '' THEN {NO_CONTENT} END AS error
    FROM documents
)
SELECT doc_id, CASE WHEN error IS NULL THEN human END AS human,
       CASE WHEN error IS NULL THEN gpt END AS gpt, error
FROM fields
"""

ORACLES["key_fallback_absent_vs_null"] = """
SELECT doc_id,
       CASE n_chars % 4 WHEN 0 THEN '"' || lang || '"' WHEN 1 THEN '"' || source || '"'
                        WHEN 2 THEN 'null' ELSE 'absent' END AS picked
FROM documents
"""

# -- exact copies -------------------------------------------------------------------------------

ORACLES["exact_dedup_normalized"] = f"""
SELECT min(doc_id) AS doc_id FROM documents
WHERE {_strip("text")} <> '' AND {_strip("lang")} <> ''
GROUP BY {_strip("text")}, {_strip("lang")}
"""

ORACLES["exact_dedup_log"] = """
SELECT doc_id AS duplicate_source_index, retained AS retained_source_index,
       'exact_duplicate' AS reason, 1.0::DOUBLE AS similarity, text
FROM (SELECT doc_id, text, min(doc_id) OVER (PARTITION BY text, lang) AS retained FROM documents)
WHERE doc_id > retained
"""

# -- texts for comparison -----------------------------------------------------------------------


def _text_oracle(text: str, needs_user: str) -> str:
    return f"""
WITH {VARIED},
said AS (
    SELECT conv_id, turn, lower({_strip("role")}) AS role, {_strip("text")} AS content FROM varied
),
grouped AS (
    SELECT conv_id, bool_or(content = '') AS blank,
           count(*) FILTER (WHERE role = 'user') AS users, {text} AS text
    FROM said GROUP BY conv_id
),
judged AS (
    SELECT conv_id, text,
           CASE WHEN blank THEN {NO_CONTENT}
                WHEN {needs_user} AND users = 0
                    THEN 'Record has no user/human turn' END AS text_error
    FROM grouped
)
SELECT conv_id, CASE WHEN text_error IS NULL THEN text END AS text, text_error FROM judged
"""


ORACLES["text_first_user"] = _text_oracle(
    "arg_min(content, turn) FILTER (WHERE role = 'user')", "true"
)
ORACLES["text_all_user"] = _text_oracle(
    f"string_agg(content, {NL} ORDER BY turn) FILTER (WHERE role = 'user')", "true"
)
ORACLES["text_full_dialogue"] = _text_oracle(
    f"string_agg(role || ': ' || content, {NL} ORDER BY turn)", "false"
)

# -- vectors ------------------------------------------------------------------------------------

WIDENED = "(SELECT *, embedding::DOUBLE[] AS v FROM embeddings)"

ORACLES["embedding_checks"] = f"""
WITH lengths AS (SELECT len(v) AS dimension, sqrt(list_dot_product(v, v)) AS norm FROM {WIDENED})
SELECT count(*) AS n_rows, min(dimension) AS min_dimension, max(dimension) AS max_dimension,
       count(*) FILTER (WHERE norm = 0) AS zero_vectors,
       count(*) FILTER (WHERE norm IS NULL OR isnan(norm) OR isinf(norm)) AS bad_vectors,
       round(min(norm), 5) AS min_norm, round(max(norm), 5) AS max_norm
FROM lengths
"""

ORACLES["embedding_checks_bad"] = """
SELECT count(*) AS n_rows,
       max(CASE vec_id % 11 WHEN 0 THEN NULL WHEN 4 THEN len(embedding) + 1
                            ELSE len(embedding) END) AS max_dimension,
       count(*) FILTER (WHERE vec_id % 11 = 1) AS zero_vectors,
       count(*) FILTER (WHERE vec_id % 11 IN (0, 2, 3)) AS bad_vectors
FROM embeddings
"""

ORACLES["renormalize_always"] = """
WITH stretched AS (
    SELECT vec_id, list_transform(embedding, lambda x: (x * 1.0005::DOUBLE)::FLOAT)::DOUBLE[] AS v
    FROM embeddings
),
measured AS (SELECT vec_id, v, sqrt(list_dot_product(v, v)) AS norm FROM stretched)
SELECT vec_id,
       round(list_sum(list_transform(v, lambda x, i: (x / norm)::FLOAT::DOUBLE * i)), 4)
           AS weighted_sum
FROM measured
"""

ORACLES["renormalize"] = """
WITH stretched AS (
    SELECT vec_id, list_transform(embedding, lambda x: (x * (label + 1))::FLOAT)::DOUBLE[] AS v
    FROM embeddings
),
measured AS (SELECT vec_id, v, sqrt(list_dot_product(v, v)) AS norm FROM stretched)
SELECT vec_id,
       round(list_sum(list_transform(v, lambda x, i: (x / norm)::FLOAT::DOUBLE * i)), 4)
           AS weighted_sum
FROM measured
"""

ORACLES["hash_embedding"] = """
WITH said AS (
    SELECT doc_id, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
runs AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM said),
hashed AS (SELECT doc_id, md5(array_to_string(w[i:i + 2], ' ')) AS h FROM runs),
placed AS (
    SELECT doc_id,
           (instr('0123456789abcdef', h[1]) - 1) * 256 + (instr('0123456789abcdef', h[2]) - 1) * 16
               + instr('0123456789abcdef', h[3]) - 1 AS bucket,
           CASE WHEN h[4] < '8' THEN 1 ELSE -1 END AS sign
    FROM hashed),
counts AS (
    SELECT doc_id, bucket, sum(sign) AS n FROM placed GROUP BY ALL HAVING sum(sign) <> 0),
lengths AS (SELECT doc_id, sqrt(sum(n * n)) AS norm FROM counts GROUP BY doc_id)
SELECT doc_id, count(*) AS n_used,
       round(sum((n / norm)::FLOAT::DOUBLE * (bucket + 1)), 4) AS weighted_sum
FROM counts JOIN lengths USING (doc_id) GROUP BY doc_id
"""

# Every document has a vector: the table's in order, again and again.
PLACED = """(SELECT row_number() OVER (ORDER BY vec_id) - 1 AS place, embedding,
                    embedding::DOUBLE[] AS v FROM embeddings)"""
TURNS = "(SELECT count(*) FROM embeddings)"

ORACLES["precomputed_vectors"] = f"""
SELECT doc_id, lang, len(embedding) AS dimension
FROM documents JOIN {PLACED} ON doc_id % {TURNS} = place
"""

# -- near copies --------------------------------------------------------------------------------


def _matches(vectors: str, threshold: float) -> str:
    """``vectors`` has ``id`` and the vector ``v``."""
    return f"""
vectors AS ({vectors}),
pairs AS (
    SELECT a.id AS dup, b.id AS earlier, list_dot_product(a.v, b.v) AS sim
    FROM vectors a JOIN vectors b ON b.id < a.id
),
matches AS (
    SELECT dup, arg_min(earlier, (-sim, earlier)) AS matched, max(sim) AS sim
    FROM pairs WHERE sim >= {threshold} GROUP BY dup
),
chain AS (
    SELECT dup, matched AS up FROM matches
    UNION ALL
    SELECT chain.dup, matches.matched FROM chain JOIN matches ON chain.up = matches.dup
),
anchors AS (SELECT dup, min(up) AS retained FROM chain GROUP BY dup),
log AS (
    SELECT dup AS duplicate_index, matched AS matched_index, retained AS retained_index,
           round(sim, 6) AS similarity, 'semantic_duplicate' AS reason
    FROM matches JOIN anchors USING (dup)
)
"""


ALL_MATCHES = "WITH RECURSIVE " + _matches(f"SELECT vec_id AS id, v FROM {WIDENED}", THRESHOLD)

ORACLES["nearest_earlier_match"] = (
    ALL_MATCHES + "SELECT duplicate_index, matched_index, similarity FROM log"
)
ORACLES["nearest_earlier_partitioned"] = ORACLES["nearest_earlier_match"]
ORACLES["nearest_earlier_repeated"] = (
    "WITH RECURSIVE "
    + _matches(
        f"""SELECT vec_id AS id, v FROM {WIDENED}
            UNION ALL SELECT vec_id + 2000000, v FROM {WIDENED}
            UNION ALL SELECT vec_id + 1000000,
                CASE WHEN vec_id % 2 = 0 THEN v ELSE
                list_transform(embedding, lambda x: (x * 1.0005::DOUBLE)::FLOAT)::DOUBLE[] END
                FROM {WIDENED}""",
        0.9,
    )
    + "SELECT duplicate_index, matched_index, similarity FROM log"
)

ORACLES["nearest_earlier_approximate"] = (
    ALL_MATCHES
    + """SELECT count(*) AS exact_matches, true AS recall_of_nine_tenths,
                0::BIGINT AS without_counterpart FROM log"""
)

SPLIT = f"""
SELECT {{name}} AS id, row_number() OVER (ORDER BY sha256('{SEED}:' || {{name}}))
    <= greatest(1, round_even(count(*) OVER () * {EVAL_RATIO}, 0)) AS held, * FROM {{table}}
"""

ORACLES["leakage_exact"] = f"""
WITH split AS ({SPLIT.format(name="doc_id", table="documents")})
SELECT e.doc_id AS eval_index, min(t.doc_id) AS train_index
FROM split e JOIN split t ON e.text = t.text AND e.held AND NOT t.held GROUP BY e.doc_id
"""

ORACLES["leakage_rate"] = f"""
WITH split AS ({SPLIT.format(name="doc_id", table="documents")}),
leaked AS (SELECT DISTINCT e.doc_id FROM split e JOIN split t ON e.text = t.text AND e.held AND NOT t.held)
SELECT count(*) FILTER (WHERE held) AS eval_records, (SELECT count(*) FROM leaked) AS leaked_records,
       round((SELECT count(*) FROM leaked) / greatest(1, count(*) FILTER (WHERE held)), 6) AS leakage_rate
FROM split
"""
ORACLES["leakage_semantic"] = f"""
WITH split AS ({SPLIT.format(name="vec_id", table=WIDENED)}),
pairs AS (
    SELECT e.vec_id AS eval_index, t.vec_id AS train_index, list_dot_product(e.v, t.v) AS sim
    FROM split e JOIN split t ON e.held AND NOT t.held)
SELECT eval_index, arg_min(train_index, (-sim, train_index)) AS train_index,
       round(max(sim), 6) AS similarity
FROM pairs WHERE sim >= {THRESHOLD} GROUP BY eval_index
"""

ORACLES["semantic_retained"] = (
    ALL_MATCHES
    + "SELECT vec_id FROM embeddings WHERE vec_id NOT IN (SELECT duplicate_index FROM log)"
)
ORACLES["anchor_chain"] = ALL_MATCHES + "SELECT * FROM log"
ORACLES["semantic_removal_detail"] = (
    "WITH RECURSIVE "
    + _matches(
        f"SELECT doc_id AS id, v FROM documents JOIN {PLACED} ON doc_id % {TURNS} = place", THRESHOLD
    )
    + """
SELECT log.*, d.text AS duplicate_text, m.text AS matched_text, r.text AS retained_text
FROM log JOIN documents d ON d.doc_id = duplicate_index
         JOIN documents m ON m.doc_id = matched_index
         JOIN documents r ON r.doc_id = retained_index
"""
)

DEDUPED = f"""
WITH RECURSIVE records AS (
    SELECT doc_id, text, v, min(doc_id) OVER (PARTITION BY text, lang) AS retained
    FROM documents JOIN {PLACED} ON doc_id % {TURNS} = place
),
kept AS (
    SELECT row_number() OVER (ORDER BY doc_id) - 1 AS id, doc_id, text, v
    FROM records WHERE doc_id = retained
),
{_matches("SELECT id, v FROM kept", THRESHOLD)}
"""

ORACLES["removal_log"] = (
    DEDUPED
    + """
SELECT doc_id AS duplicate_source_index, retained AS retained_source_index,
       'exact_duplicate' AS reason, 1.0::DOUBLE AS similarity, text AS record_text,
       NULL::BIGINT AS duplicate_index, NULL::BIGINT AS matched_index,
       NULL::BIGINT AS retained_index, NULL::VARCHAR AS duplicate_text,
       NULL::VARCHAR AS matched_text, NULL::VARCHAR AS retained_text
FROM records WHERE doc_id > retained
UNION ALL BY NAME
SELECT log.*, d.text AS record_text, d.text AS duplicate_text, m.text AS matched_text,
       r.text AS retained_text
FROM log JOIN kept d ON d.id = duplicate_index
         JOIN kept m ON m.id = matched_index
         JOIN kept r ON r.id = retained_index
"""
)

ORACLES["dedup_report"] = (
    DEDUPED
    + f"""
, counts AS (
    SELECT (SELECT count(*) FROM records) AS input_records,
           (SELECT count(*) FROM kept) AS exact_unique_records,
           (SELECT count(*) FROM log) AS semantic_duplicates_removed,
           (SELECT max(len(v)) FROM kept) AS embedding_dimension
)
SELECT *, input_records - exact_unique_records AS exact_duplicates_removed,
       exact_unique_records - semantic_duplicates_removed AS retained_records,
       input_records - exact_unique_records + semantic_duplicates_removed AS total_removed,
       round((input_records - exact_unique_records + semantic_duplicates_removed)
             / input_records, 6) AS removal_rate,
       round(semantic_duplicates_removed / exact_unique_records, 6)
           AS semantic_removal_rate_after_exact,
       {THRESHOLD}::DOUBLE AS similarity_threshold
FROM counts
"""
)

FIRSTS = """
WITH placed AS (
    SELECT row_number() OVER (ORDER BY doc_id) - 1 AS source_index, text FROM documents),
firsts AS (
    SELECT source_index, text, min(source_index) OVER (PARTITION BY text) AS retained FROM placed)
"""

ORACLES["removal_log_file"] = (
    FIRSTS
    + """
SELECT source_index AS duplicate_source_index, retained AS retained_source_index,
       'exact_duplicate' AS reason, 1.0::DOUBLE AS similarity, text
FROM firsts WHERE source_index > retained
"""
)
ORACLES["dedup_report_file"] = (
    FIRSTS
    + """
, counts AS (
    SELECT count(*) AS input_records, count(*) FILTER (WHERE source_index = retained) AS kept
    FROM firsts)
SELECT input_records, kept AS exact_unique_records, input_records - kept AS exact_duplicates_removed,
       0::BIGINT AS semantic_duplicates_removed, kept AS retained_records,
       input_records - kept AS total_removed,
       round((input_records - kept) / input_records, 6) AS removal_rate
FROM counts
"""
)
ORACLES["strict_extraction"] = """
SELECT coalesce('record ' || min(place) FILTER (WHERE length(text) % 11 = 3)
                || ' has no usable text: no text', 'accepted') AS said
FROM (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS place, text FROM documents)
"""
ORACLES["split_guards"] = """
WITH counts AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
asked AS (SELECT source, n, ratio, greatest(1, round_even(n * ratio, 0))::BIGINT AS size
          FROM counts, (VALUES (0.5::DOUBLE), (0.999::DOUBLE), (1.0::DOUBLE)) AS r(ratio))
SELECT source, ratio,
       CASE WHEN ratio >= 1 THEN 'eval_ratio has to lie between 0 and 1'
            WHEN n < 2 THEN 'a split needs at least two valid records that differ'
            WHEN size >= n THEN 'the ratio leaves no record for training'
            ELSE size::VARCHAR END AS said
FROM asked
"""

# -- the whole preparation ----------------------------------------------------------------------

# The same rules on the turns as they are.
PLAIN = CONVERTED.replace(VARIED, "varied AS (SELECT conv_id, turn, role, text FROM conversations)")

UNIQUE = """
, kept AS (SELECT min(conv_id) AS conv_id, dialogue FROM converted
           WHERE error IS NULL GROUP BY dialogue)
"""

ORACLES["prepared_dataset"] = (
    PLAIN
    + UNIQUE
    + f"""
, placed AS (SELECT *, row_number() OVER (ORDER BY sha256('{SEED}:' || conv_id)) AS place FROM kept)
SELECT conv_id, dialogue,
       CASE WHEN place <= greatest(1, round_even((SELECT count(*) FROM kept) * {EVAL_RATIO}, 0))
            THEN 'eval' ELSE 'train' END AS split
FROM placed
"""
)

WITH_COPIES = CONVERTED.replace(
    VARIED,
    f"""varied AS (SELECT conv_id, turn, role, text FROM conversations UNION ALL
                   SELECT conv_id + {COPY_OFFSET}, turn, role, text FROM conversations
                   WHERE conv_id % 2 = 0)""",
)

ORACLES["split_files"] = (
    ORACLES["prepared_dataset"].replace("SELECT conv_id, dialogue,\n       CASE", "SELECT dialogue,\n       CASE")
)

ORACLES["dataset_stats"] = (
    WITH_COPIES.replace("WITH", "WITH RECURSIVE", 1)
    + UNIQUE
    + ","
    + _matches(
        f"SELECT conv_id AS id, v FROM kept JOIN {PLACED} ON conv_id % {TURNS} = place",
        CONVERSATION_THRESHOLD,
    )
    + f"""
, counts AS (
    SELECT (SELECT count(*) FROM converted) AS input_records,
           (SELECT count(*) FROM converted WHERE error IS NOT NULL) AS invalid_records,
           (SELECT count(*) FROM kept) AS unique_records,
           (SELECT count(*) FROM log) AS semantic_duplicates_removed
),
sized AS (
    SELECT *, unique_records - semantic_duplicates_removed AS valid_unique_records,
           greatest(1, round_even((unique_records - semantic_duplicates_removed) * {EVAL_RATIO}, 0))
               ::BIGINT AS eval_records
    FROM counts
)
SELECT input_records, valid_unique_records,
       input_records - invalid_records - unique_records AS exact_duplicates_removed,
       true AS semantic_dedup_enabled, semantic_duplicates_removed,
       valid_unique_records - eval_records AS train_records, eval_records, invalid_records,
       {SEED} AS seed
FROM sized
"""
)

ORACLES["train_split"] = f"""
SELECT doc_id, lang,
       CASE WHEN row_number() OVER (ORDER BY sha256('{SEED}:' || doc_id))
                 <= greatest(1, round_even(count(*) OVER () * {EVAL_RATIO}, 0))
            THEN 'eval' ELSE 'train' END AS split
FROM documents
"""

ORACLES["capped_sample"] = f"""
SELECT doc_id, text FROM documents ORDER BY sha256('{SEED}:' || doc_id) LIMIT {SAMPLE_CAP}
"""

# -- chat histories -----------------------------------------------------------------------------

THOUGHT = f"'<think>' || {NL} || text || {NL} || '</think>'"

THINKING = f"""
thinking AS (
    SELECT conv_id, turn, role, CASE length(text) % 5
        WHEN 0 THEN {THOUGHT} || {NL} || {NL} || text
        WHEN 1 THEN ' ' || text || {NL} || {THOUGHT} || ' ' || {WIDE} || text || {THOUGHT}
        WHEN 2 THEN text || '<think>' || text
        WHEN 3 THEN {THOUGHT}
        ELSE text END AS text
    FROM conversations
)
"""


def _answer(text: str) -> str:
    removed = f"regexp_replace({text}, '<think>.*?</think>[{PY_WHITESPACE}]*', '', 'gs')"
    return _strip(removed)


ORACLES["strip_reasoning"] = f"""
WITH {THINKING} SELECT conv_id, turn, {_answer("text")} AS answer FROM thinking
"""

HISTORIES = f"""
WITH {THINKING},
histories AS (
    SELECT conv_id,
           coalesce(string_agg(role || ': ' || {_answer("text")}, {NL} ORDER BY turn)
                        FILTER (WHERE role IN ('user', 'assistant')), '') AS dialogue
    FROM thinking GROUP BY conv_id
)
"""

ORACLES["history_messages"] = HISTORIES + "SELECT conv_id, dialogue FROM histories"

ORACLES["history_pairs"] = f"""
WITH {THINKING},
numbered AS (
    SELECT conv_id, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS i
    FROM thinking
)
SELECT conv_id,
       coalesce(string_agg(CASE WHEN i % 2 = 0 THEN 'user: ' || text
                                ELSE 'assistant: ' || {_answer("text")} END, {NL} ORDER BY i)
                    FILTER (WHERE text <> ''), '') AS dialogue
FROM numbered GROUP BY conv_id
"""

ORACLES["request_assembly"] = (
    HISTORIES
    + f"""
SELECT conv_id, 'system: {SYSTEM_PROMPT}' || {NL}
       || CASE WHEN dialogue = '' THEN '' ELSE dialogue || {NL} END
       || 'user: {QUESTION}' AS dialogue
FROM histories
"""
)

ORACLES["no_think"] = f"""
WITH marked AS (
    SELECT conv_id, turn, role, text, turn = min(turn) OVER (PARTITION BY conv_id) AS leads
    FROM conversations
)
SELECT conv_id,
       CASE WHEN bool_or(leads AND role = 'system') THEN '' ELSE 'system: /no_think' || {NL} END
       || string_agg(role || ': ' || text || CASE WHEN leads AND role = 'system'
                                                  THEN {NL} || '/no_think' ELSE '' END,
                     {NL} ORDER BY turn) AS dialogue
FROM marked GROUP BY conv_id
"""

PROMPT = (
    f"'<|im_start|>user' || {NL} || text || '<|im_end|>' || {NL} || '<|im_start|>assistant' || {NL}"
)

ORACLES["turn_prompts"] = f"""
SELECT conv_id, turn,
       {PROMPT} || '<think>' || {NL} || {NL} || '</think>' || {NL} || {NL} AS prompt,
       {PROMPT} AS thinking_prompt
FROM conversations WHERE role = 'user'
"""

ORACLES["conversation_texts"] = (
    PLAIN
    + f"""
SELECT conv_id, string_agg(content, {NL} ORDER BY turn) FILTER (WHERE role = 'human') AS text
FROM checked JOIN converted USING (conv_id) WHERE error IS NULL GROUP BY conv_id
"""
)
