"""SQL for DuckDB with the results of those queries that SQL can express."""

from __future__ import annotations

_WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"

# Op 3: every item and document by brute force over their shingles.
_PLAIN = r"""list_filter(string_split_regex(regexp_replace(lower(text),
    '[!-/:-@\[-`{-~]', ' ', 'g'), '[\x20\x09-\x0D]+'), lambda w: w <> '')"""
CONTAINMENT_SQL = f"""
WITH item_words AS (SELECT DISTINCT item_id, {_PLAIN} AS w FROM benchmark WHERE text IS NOT NULL),
doc_words AS (SELECT DISTINCT doc_id, {_PLAIN} AS w FROM documents WHERE text IS NOT NULL),
item_shingles AS (
    SELECT DISTINCT item_id, array_to_string(w[i:i + 4], ' ') AS s
    FROM (SELECT item_id, w, unnest(range(1, len(w) - 3)) AS i FROM item_words)),
doc_shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM doc_words)),
sizes AS (SELECT item_id, count(*) AS item_shingles FROM item_shingles GROUP BY item_id)
SELECT item_id, doc_id, count(*) AS shared, any_value(item_shingles) AS item_shingles,
       count(*) / any_value(item_shingles) AS containment
FROM item_shingles JOIN doc_shingles USING (s) JOIN sizes USING (item_id)
GROUP BY item_id, doc_id
HAVING count(*) >= 0.8 * any_value(item_shingles)
"""

# Op 4: all windows of all documents.
SUBSTRING_SQL = f"""
WITH docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
windows AS (
    SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM docs)),
first AS (SELECT s, min(doc_id) AS least FROM windows GROUP BY s),
repeated AS (
    SELECT doc_id, i FROM windows JOIN first USING (s) WHERE least < doc_id),
removed AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM repeated),
by_doc AS (SELECT doc_id, count(*) AS n_removed, list(i) AS gone FROM removed GROUP BY doc_id),
kept AS (
    SELECT doc_id, w, coalesce(n_removed, 0) AS n_removed,
           CASE WHEN gone IS NULL THEN array_to_string(w, ' ')
                ELSE array_to_string(list_filter(w, lambda x, k: NOT list_contains(gone, k)), ' ')
           END AS text
    FROM docs LEFT JOIN by_doc USING (doc_id))
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, n_removed, sha256(text) AS kept_sha256 FROM kept
"""

# Op 7: digests from the table itself; sizes from the template and its escapes.
CHAT_SQL = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations
    UNION ALL VALUES (-1, 0, 'user', '<|im_end|><|im_start|>assistant ok'),
                     (-1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')),
sized AS (
    SELECT *, length('<|im_start|>') + length(role) + 1 + length('<|im_end|>') + 1
              + length(text)
              + (length(text) - length(replace(text, chr(92), '')))
              + (length(text) - length(replace(text, '<|', ''))) AS chars
    FROM turns)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text))
           AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text)
                       FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars,
       regexp_full_match(string_agg(
           CASE role WHEN 'system' THEN 's' WHEN 'user' THEN 'u' WHEN 'assistant' THEN 'a' ELSE 'x' END,
           '' ORDER BY turn, role, text), 's?(ua)+') AS valid
FROM sized GROUP BY conv_id
"""


# Op 13: one CTE for each assignment and each averaging; every entry is compared.
_ASSIGN = """
    SELECT rid, part, arg_min(entry, (d, entry)) AS entry, min(d) AS d FROM (
        SELECT v.rid, v.part, c.entry, sum((v.x - c.x) * (v.x - c.x)) AS d
        FROM v JOIN c{k} c USING (part, pos) GROUP BY v.rid, v.part, c.entry)
    GROUP BY rid, part"""
_AVERAGE = """
    SELECT c.part, c.entry, c.pos,
           coalesce((t.s - ((t.s % t.n) + t.n) % t.n) // t.n, c.x) AS x
    FROM c{k} c LEFT JOIN (
        SELECT v.part, a.entry, v.pos, sum(v.x) AS s, count(*) AS n
        FROM v JOIN a{k} a USING (rid, part) GROUP BY v.part, a.entry, v.pos) t
    USING (part, entry, pos)"""


# Op 12: CRC32 over the bytes of each different word, by a table made from its polynomial.
RESAMPLING_SQL = r"""
WITH RECURSIVE steps AS (
    SELECT i AS byte, i AS c, 0 AS k FROM (SELECT unnest(range(256)) AS i)
    UNION ALL
    SELECT byte, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1
    FROM steps WHERE k < 8),
crc AS MATERIALIZED (SELECT list(c ORDER BY byte) AS t FROM steps WHERE k = 8),
plain AS (
    SELECT doc_id AS id, 's' AS side, text FROM documents
    UNION ALL SELECT item_id, 't', text FROM benchmark),
worded AS MATERIALIZED (
    SELECT id, side, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM plain),
words AS (SELECT id, side, unnest(words) AS word FROM worded),
known AS (SELECT DISTINCT word, hex(encode(word)) AS h FROM words),
hashed AS MATERIALIZED (
    SELECT word, xor(list_reduce(
        list_transform(range(length(h) // 2),
                       lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT)),
        lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)]), 4294967295), 4294967295) % 10000 AS bucket
    FROM known, crc),
counted AS (
    SELECT bucket, count(*) FILTER (side = 's') AS s, count(*) FILTER (side = 't') AS t
    FROM words JOIN hashed USING (word) GROUP BY bucket),
total AS (SELECT sum(s) AS s_all, sum(t) AS t_all FROM counted),
gains AS (
    SELECT bucket, CAST(floor(1000 * ln(
        CAST(t + 1 AS DOUBLE) * CAST(s_all + 10000 AS DOUBLE)
        / (CAST(s + 1 AS DOUBLE) * CAST(t_all + 10000 AS DOUBLE)))) AS BIGINT) AS gain
    FROM counted, total),
weights AS (
    SELECT id, CAST(floor(CAST(sum(gain) AS DOUBLE) / count(*)) AS BIGINT) AS weight
    FROM words JOIN hashed USING (word) JOIN gains USING (bucket) WHERE side = 's' GROUP BY id),
scores AS (
    SELECT w.id AS doc_id, CAST(len(words) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
           coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln(
               (CAST('0x' || left(sha256('2024:' || w.id), 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT)
               AS score
    FROM worded w LEFT JOIN weights USING (id) WHERE w.side = 's'),
ranked AS (
    SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n
    FROM scores WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score,
       CASE WHEN rank <= n * 10 // 100 THEN rank END AS rank
FROM scores LEFT JOIN ranked USING (doc_id)
"""


def vector_codes_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    steps = []
    for k in range(rounds + 1):
        steps.append(f"a{k} AS MATERIALIZED ({_ASSIGN.format(k=k)})")
        if k < rounds:
            steps.append(f"c{k + 1} AS MATERIALIZED ({_AVERAGE.format(k=k)})")
    chain = ",\n".join(steps)
    return f"""
WITH kept AS (
    SELECT row_number() OVER (ORDER BY vec_id) AS rid, vec_id, label, embedding AS e
    FROM embeddings
    WHERE embedding IS NOT NULL AND list_bool_and(list_transform(
        embedding, lambda x: coalesce(isfinite(x), false)))),
cut AS (SELECT rid, e, len(e) // {parts} AS width, unnest(range(len(e))) AS i FROM kept),
v AS MATERIALIZED (
    SELECT rid, i // width AS part, i % width AS pos,
           CAST(floor(4096 * CAST(e[i + 1] AS DOUBLE)) AS BIGINT) AS x FROM cut),
c0 AS MATERIALIZED (SELECT part, rid - 1 AS entry, pos, x FROM v WHERE rid <= {entries}),
{chain},
coded AS (
    SELECT rid, string_agg(printf('%02x', entry), '' ORDER BY part) AS code,
           CAST(sum(d) AS BIGINT) AS error
    FROM a{rounds} GROUP BY rid),
digest AS (
    SELECT sha256(string_agg(CAST(CAST(x AS BIGINT) AS VARCHAR), ',' ORDER BY part, entry, pos)) AS s
    FROM c{rounds})
SELECT vec_id, code, error,
       CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT s FROM digest) AS codebooks_sha256
FROM kept JOIN coded USING (rid)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op3_benchmark_decontamination": CONTAINMENT_SQL,
        "op4_substring_dedup": SUBSTRING_SQL,
        "op7_chat_formatting": CHAT_SQL,
        "op12_importance_resampling": RESAMPLING_SQL,
        "op13_vector_codes": vector_codes_sql(),
    }
