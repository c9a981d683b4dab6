"""The registered queries as SQL for a single-node database, written independently of Spark."""

from __future__ import annotations

WORDS = r"len(list_filter(string_split_regex({0}, '\s+'), lambda x: x <> ''))"


def words(text: str) -> str:
    return f"CAST({WORDS.format(text)} AS INTEGER)"


def lines(text: str = "text") -> str:
    """The lines of a text; the data has plain line feeds only."""
    return (
        f"CASE WHEN {text} = '' THEN [] ELSE "
        f"string_split(regexp_replace({text}, '\\n$', ''), chr(10)) END"
    )


UPPER = "replace(upper(text), 'ẞ', 'SS')"
ONE_LINE = "replace(replace(text, chr(10), ' '), chr(13), '')"

ORACLES: dict[str, str] = {}

# --- text ---------------------------------------------------------------------------------

ORACLES["text_strip_newlines"] = "SELECT doc_id, replace(text, chr(10), ' ') AS out FROM documents"

ORACLES["text_trim"] = r"""
SELECT doc_id,
       regexp_replace(regexp_replace(' ' || chr(9) || ' ' || chr(10) || text || chr(12288)
           || chr(160) || ' ' || chr(13) || chr(10),
         '^[\s\x{00a0}\x{3000}]+', ''), '[\s\x{00a0}\x{3000}]+$', '') AS out
FROM documents"""

ORACLES["text_lower"] = "SELECT doc_id, lower(text) AS out FROM documents"
ORACLES["text_upper"] = f"SELECT doc_id, {UPPER} AS out FROM documents"

ORACLES["text_mode_per_row"] = f"""
SELECT doc_id,
       CASE doc_id % 6 WHEN 0 THEN 'Trim' WHEN 1 THEN 'lower' WHEN 2 THEN 'UPPERCASE'
                       WHEN 3 THEN 'raw' WHEN 4 THEN 'oneline' ELSE 'no such mode' END AS mode,
       CASE doc_id % 6 WHEN 0 THEN trim(text) WHEN 1 THEN lower(text) WHEN 2 THEN {UPPER}
                       WHEN 3 THEN text ELSE {ONE_LINE} END AS out
FROM documents"""

ORACLES["text_squeeze"] = r"""
SELECT doc_id,
       regexp_replace(replace(text, ' ', ' ' || chr(9) || ' '), '\s+', ' ', 'g') AS out
FROM documents"""

ORACLES["text_regex_replace"] = r"""
SELECT doc_id,
       regexp_replace(text, '([0-9])([0-9]*)', '<\2>', 'g') AS out
FROM documents"""

ORACLES["text_regex_posix"] = r"""
SELECT doc_id, regexp_replace(text, '[0-9]+', '#', 'g') AS digits, regexp_matches(text, '[A-Z]{2}') AS upper,
       md5(regexp_replace(text, '[^0-9A-Za-z \t\n\x0B\f\r]', '', 'g')) AS others
FROM documents"""

ORACLES["script_named_group"] = r"""
SELECT doc_id, regexp_replace(text, '([A-Za-z]+)[ \t\n\x0B\f\r]+([0-9])', '\2<\1>', 'g') AS out FROM documents"""

ORACLES["text_regex_match"] = r"""
SELECT doc_id, regexp_matches(text, '[0-9]') AS has_digit, text LIKE '%.' AS ends
FROM documents"""

ORACLES["text_lines"] = f"""
SELECT doc_id, CAST(i - 1 AS INTEGER) AS line_no, l[i] AS line
FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i
      FROM (SELECT doc_id, {lines()} AS l FROM documents))"""

ORACLES["text_take_lines"] = f"""
SELECT doc_id, array_to_string(l[1:2], chr(10)) AS out, '' AS none
FROM (SELECT doc_id, {lines()} AS l FROM documents)"""

ORACLES["text_skip_lines"] = f"""
SELECT doc_id, coalesce(array_to_string(l[3:], chr(10)), '') AS out,
       array_to_string(l, chr(10)) AS whole
FROM (SELECT doc_id, {lines()} AS l FROM documents)"""

ORACLES["text_truncate"] = "SELECT doc_id, left(text, 100) AS out, text AS whole FROM documents"

ORACLES["text_word_count"] = f"SELECT doc_id, {words('text')} AS words FROM documents"

ORACLES["script_steps"] = r"""
SELECT doc_id,
       left(lower(regexp_replace(regexp_replace(text, '\s+', ' ', 'g'), '[0-9]+', 'NUM', 'g')), 300)
         AS out
FROM documents"""

ORACLES["script_per_row"] = rf"""
SELECT doc_id,
       CASE doc_id % 4 WHEN 0 THEN lower(text)
                       WHEN 1 THEN coalesce(array_to_string(({lines()})[2:], chr(10)), '')
                       WHEN 2 THEN left(regexp_replace(text, '\s+', ' ', 'g'), 50)
                       ELSE text END AS out
FROM documents"""

ORACLES["cleaned_words_by_language"] = f"""
SELECT lang, count(*) AS documents, CAST(sum({words("text")}) AS BIGINT) AS words
FROM documents GROUP BY lang"""

# --- vectors, tokens, chunks --------------------------------------------------------------


def vector_rows(dim: int) -> str:
    return f"""
WITH bytes AS (
    SELECT doc_id, hex(encode(text)) AS h FROM documents
), folded AS (
    SELECT doc_id,
           list_reduce(list_prepend(CAST(0 AS DOUBLE),
             list_transform(regexp_extract_all(h, '..'),
               lambda b, i: CAST(('0x' || b)::INTEGER AS DOUBLE) * i * 0.001::DOUBLE)),
             lambda a, x: a + x) AS fold
    FROM bytes
)
SELECT doc_id, CAST(j AS INTEGER) AS place, round(sin((fold + j) * 0.01::DOUBLE), 6) AS value
FROM folded, range({dim}) AS t(j)"""


ORACLES["embed_fake_vectors"] = vector_rows(8)
ORACLES["embed_dedup_join"] = vector_rows(4)
ORACLES["embed_fetched_texts"] = vector_rows(4)
ORACLES["embed_in_place"] = vector_rows(4)

ORACLES["token_count_words"] = (
    f"SELECT doc_id, CAST({WORDS.format('text')} AS BIGINT) AS tokens FROM documents"
)
ORACLES["token_count_regex"] = (
    "SELECT doc_id, CAST(len(regexp_extract_all(text, '[A-Za-z]+|[0-9]')) AS BIGINT) AS tokens "
    "FROM documents"
)
ORACLES["token_count_service"] = (
    "SELECT doc_id, CAST(length(text) AS BIGINT) AS tokens FROM documents"
)


ORACLES["token_count_retried"] = ORACLES["token_count_service"]

POSIX_TOKENS = "len(regexp_extract_all({0}, '[A-Za-z]+|[0-9]'))"


def chunk_rows(table: str, keys: str, budget: int, count: str = WORDS) -> str:
    """Halving as a recursive query: open pieces are split or closed, a piece per row."""
    return rf"""
WITH RECURSIVE pieces AS (
    SELECT {keys}, '' AS path, text, FALSE AS closed FROM {table}
    UNION ALL
    SELECT {keys}, path || side, CASE side WHEN '0' THEN l WHEN '1' THEN r ELSE text END,
           side = ''
    FROM (
        SELECT *, unnest(CASE WHEN fits OR l = '' OR r = '' THEN [''] ELSE ['0', '1'] END) AS side
        FROM (
            SELECT {keys}, path, text, fits,
                   CASE WHEN fits THEN '' WHEN ahead <> '' THEN head || ahead
                        WHEN behind <> '' THEN behind
                        WHEN space > 0 THEN head || substring(tail, 1, space - 1) ELSE head END AS l,
                   CASE WHEN fits THEN ''
                        WHEN ahead <> '' THEN regexp_replace(substring(tail, length(ahead) + 1), '^ ', '')
                        WHEN behind <> '' THEN regexp_replace(substring(text, length(behind) + 1), '^ ', '')
                        WHEN space > 0 THEN substring(tail, space + 1) ELSE tail END AS r
            FROM (
                SELECT *, regexp_extract(tail, '^[^.!?]*[.!?]') AS ahead,
                       regexp_extract(head, '(?s)^.*[.!?]') AS behind, strpos(tail, ' ') AS space
                FROM (
                    SELECT *, decode(unhex(substring(h, 1, 2 * mid))) AS head,
                           decode(unhex(substring(h, 2 * mid + 1))) AS tail
                    FROM (
                        SELECT *, m + CASE WHEN substring(h, 2 * m + 1, 1) NOT IN ('8', '9', 'A', 'B') THEN 0
                                           WHEN substring(h, 2 * m + 3, 1) NOT IN ('8', '9', 'A', 'B') THEN 1
                                           WHEN substring(h, 2 * m + 5, 1) NOT IN ('8', '9', 'A', 'B') THEN 2
                                           ELSE 3 END AS mid
                        FROM (
                            SELECT {keys}, path, text, hex(encode(text)) AS h,
                                   strlen(text) // 2 AS m,
                                   {count.format("text")} <= {budget} AS fits
                            FROM pieces WHERE NOT closed
                        )
                    )
                )
            )
        )
    )
)
SELECT {keys}, CAST(row_number() OVER (PARTITION BY {keys} ORDER BY path) - 1 AS INTEGER) AS chunk_id,
       text, CAST({count.format("text")} AS BIGINT) AS n_tokens
FROM pieces WHERE closed"""


ORACLES["document_chunks"] = chunk_rows("documents", "doc_id", 100)
ORACLES["chunks_by_regex"] = f"""
SELECT *, n_tokens AS counted FROM ({chunk_rows("documents", "doc_id", 60, POSIX_TOKENS)})"""
ORACLES["conversation_chunks"] = chunk_rows("conversations", "conv_id, turn", 20)

# --- HTML ---------------------------------------------------------------------------------


# the last heading of a level; one above it clears it
LEVELS = ", ".join(
    f"coalesce(last_value(CASE WHEN tag = 'h{level}' THEN text WHEN tag < 'h{level}' THEN '' END IGNORE NULLS) "
    f"OVER (PARTITION BY page_id ORDER BY i), '') AS h{level}"
    for level in range(1, 7)
)


def html_elements(html: str = "html", skip: str = "FALSE", min_words: int = 10) -> str:
    """CTEs up to ``kept`` (page_id, pos, tag, text, words, classes, h1 to h6), pos from 1.

    The pages hold headings and p only, each ends at the next or at an end tag of one or of article.
    A character reference may lack its semicolon, where a heading was cut off in it.
    """
    return rf"""
WITH bare AS (
    SELECT page_id, regexp_replace({html},
        '(?s)<script.*?</script>|<style.*?</style>|<!--.*?-->|<title.*?</title>', '', 'g') AS h
    FROM pages
), split AS (
    SELECT page_id, string_split(regexp_replace(h, '<(p|h[1-6])( [^>]*)?>', chr(1) || '\1\2>', 'g'), chr(1)) AS parts
    FROM bare
), parts AS (
    SELECT page_id, i, parts[i] AS part
    FROM (SELECT page_id, parts, unnest(range(2, len(parts) + 1)) AS i FROM split)
), cut AS (
    SELECT page_id, i, regexp_extract(part, '^(p|h[1-6])', 1) AS tag,
           regexp_extract(part, '^(?:p|h[1-6]) class="([^"]*)"', 1) AS classes,
           regexp_extract(regexp_replace(part, '^[^>]*>', ''), '(?s)^(.*?)(?:</(?:p|h[1-6]|article)>|$)', 1) AS body
    FROM parts
), plain AS (
    SELECT page_id, i, tag, classes,
           regexp_replace(regexp_replace(
             regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(body, '<[^>]*>', '', 'g'),
               '&quot;?', '"', 'g'),
               '&copy;?', '©', 'g'),
               '&middot;?', '·', 'g'),
               '&lt;?', '<', 'g'),
               '&gt;?', '>', 'g'),
               '&amp;?', '&', 'g'),
             '^\s+', ''), '\s+$', '') AS text
    FROM cut
), counted AS (
    SELECT *, {words("text")} AS words, {LEVELS}
    FROM plain
), kept AS (
    SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY i) AS pos
    FROM counted WHERE tag <> 'p' OR (words >= {min_words} AND NOT ({skip}))
)"""


NO_DEEPER = "'' AS h2, '' AS h3, '' AS h4, '' AS h5, '' AS h6"

RAW_ROWS = f"""
SELECT page_id, CAST(pos - 1 AS INTEGER) AS position, tag AS element_type, text,
       words AS word_count, h1, h2, h3, h4, h5, h6, classes, '' AS error
FROM kept"""

ORACLES["html_raw"] = html_elements() + RAW_ROWS
ORACLES["html_raw_unfiltered"] = html_elements(min_words=0) + RAW_ROWS

MARKED = """replace(html, '<p>', '<p class="' || CASE page_id % 3 WHEN 0 THEN 'body'
    WHEN 1 THEN 'text NavBar-left' ELSE 'site-Footer wide' END || '">')"""
ORACLES["html_class_filter"] = (
    html_elements(MARKED, "lower(classes) LIKE '%navbar%' OR lower(classes) LIKE '%footer%'", 5)
    + RAW_ROWS
)

PARAGRAPH_ROWS = f"""
SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS INTEGER) AS chunk_id,
       text, h1, h2, h3, h4, h5, h6, words AS word_count, CAST(1 AS INTEGER) AS paragraph_count, '' AS error
FROM kept WHERE tag = 'p'"""
ORACLES["html_paragraph"] = html_elements() + PARAGRAPH_ROWS


def semantic_rows(low: int, high: int, min_words: int, html: str = "html", skip: str = "FALSE") -> str:
    """Chunk numbers by walking the paragraphs of all pages one place at a time."""
    start = html_elements(html, skip, min_words).replace("WITH bare", "WITH RECURSIVE bare", 1)
    return (
        start
        + f""", paragraphs AS (
    SELECT page_id, text, words, h1, h2, h3, h4, h5, h6, row_number() OVER (PARTITION BY page_id ORDER BY i) AS n
    FROM kept WHERE tag = 'p'
), walk AS (
    SELECT page_id, n, CASE WHEN words > {high} AND 0 >= {low} THEN 1 ELSE 0 END AS chunk,
           CAST(words AS BIGINT) AS filled
    FROM paragraphs WHERE n = 1
    UNION ALL
    SELECT p.page_id, p.n,
           CASE WHEN w.filled + p.words > {high} AND w.filled >= {low} THEN w.chunk + 1 ELSE w.chunk END,
           CASE WHEN w.filled + p.words > {high} AND w.filled >= {low} THEN p.words
                ELSE w.filled + p.words END
    FROM walk w JOIN paragraphs p ON p.page_id = w.page_id AND p.n = w.n + 1
), chunks AS (
    SELECT page_id, chunk AS chunk_id, string_agg(text, chr(10) || chr(10) ORDER BY n) AS text,
           {", ".join(f"arg_min(h{k}, n) AS h{k}" for k in range(1, 7))}, sum(words) AS word_count, count(*) AS paragraph_count
    FROM walk JOIN paragraphs USING (page_id, n) GROUP BY page_id, chunk
    UNION ALL
    SELECT page_id, 0, '', '', '', '', '', '', '', 0, 0 FROM walk WHERE n = 1 AND chunk = 1
)
SELECT page_id, CAST(chunk_id AS INTEGER) AS chunk_id, text, h1, h2, h3, h4, h5, h6,
       CAST(word_count AS INTEGER) AS word_count, CAST(paragraph_count AS INTEGER) AS paragraph_count,
       '' AS error
FROM chunks"""
    )


ORACLES["html_semantic"] = semantic_rows(100, 500, 10)
ORACLES["html_semantic_small"] = semantic_rows(0, 40, 3)

SKIPPED = "lower(classes) LIKE '%navbar%' OR lower(classes) LIKE '%footer%'"
OF_ELEMENTS = "page_id, '{mode}' AS mode, position, element_type, text, word_count, {h}, classes, NULL::INTEGER AS paragraph_count, error"
OF_CHUNKS = "page_id, '{mode}', chunk_id, NULL::VARCHAR, text, word_count, {h}, NULL::VARCHAR, paragraph_count, error"
# the five configs, by page_id % 5; nav and footer are among the default skip words, so the first two filters are alike
ORACLES["html_config_per_row"] = "\nUNION ALL\n".join(
    f"SELECT {columns.format(mode=mode, h='h1, h2, h3, h4, h5, h6')} FROM ({rows}) WHERE page_id % 5 = {rest}"
    for rest, mode, columns, rows in (
        (1, "raw", OF_ELEMENTS, html_elements(MARKED, SKIPPED, 5) + RAW_ROWS),
        (4, "raw", OF_ELEMENTS, html_elements(MARKED, min_words=0) + RAW_ROWS),
        (0, "semantic", OF_CHUNKS, semantic_rows(100, 500, 10, MARKED, SKIPPED)),
        (2, "paragraph", OF_CHUNKS, html_elements(MARKED, SKIPPED) + PARAGRAPH_ROWS),
        (3, "semantic", OF_CHUNKS, semantic_rows(0, 40, 3, MARKED)),
    )
)
ORACLES["sql_html_extract_config"] = ORACLES["html_config_per_row"]

ORACLES["heading_context_rows"] = ORACLES["html_raw"]
ORACLES["semantic_pack_elements"] = ORACLES["html_semantic"]
ORACLES["semantic_pack_lines"] = f"""
WITH RECURSIVE split AS (SELECT doc_id, {lines()} AS l FROM documents),
cut AS (SELECT doc_id, l[i] AS line, i AS n FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM split)),
counted AS (SELECT *, {words("line")} AS words FROM cut),
walk AS (
    SELECT doc_id, n, 0 AS chunk, CAST(words AS BIGINT) AS filled FROM counted WHERE n = 1
    UNION ALL
    SELECT c.doc_id, c.n, CASE WHEN filled + words > 50 AND filled >= 10 THEN chunk + 1 ELSE chunk END,
           CASE WHEN filled + words > 50 AND filled >= 10 THEN words ELSE filled + words END
    FROM walk w JOIN counted c ON c.doc_id = w.doc_id AND c.n = w.n + 1),
packed AS (
    SELECT doc_id, chunk, string_agg(line, chr(10) || chr(10) ORDER BY n) AS text, sum(words) AS words, count(*) AS rows
    FROM walk JOIN counted USING (doc_id, n) GROUP BY doc_id, chunk)
SELECT doc_id, chunk AS chunk_id, regexp_replace(regexp_replace(text, '^\\s+', ''), '\\s+$', '') AS text,
       CAST(words AS INTEGER) AS word_count, CAST(rows AS INTEGER) AS paragraph_count
FROM packed WHERE words > 0"""

ORACLES["html_guards"] = f"""
SELECT page_id, CAST(0 AS INTEGER) AS chunk_id, '' AS text, '' AS h1, {NO_DEEPER},
       CAST(0 AS INTEGER) AS word_count, CAST(0 AS INTEGER) AS paragraph_count,
       'extract_html expects HTML content, not URL. Fetch the object first.' AS error
FROM pages"""

LEVELED = """array_to_string(list_transform(string_split(html, '<p>'), lambda x, i:
    CASE WHEN i = 1 THEN x
         WHEN i % 3 = 2 AND contains(x, '</p>')
           THEN '<h' || ((page_id + i - 1) % 5 + 2) || '>' || replace(x, '</p>', '</h' || ((page_id + i - 1) % 5 + 2) || '>')
         ELSE '<p>' || x END), '')"""
ORACLES["html_heading_levels"] = html_elements(LEVELED) + RAW_ROWS
ORACLES["html_heading_levels_semantic"] = semantic_rows(100, 500, 10, LEVELED)

ORACLES["html_size_guard"] = (
    ORACLES["html_paragraph"].replace("FROM pages", "FROM pages WHERE strlen(html) <= 4000")
    + f"""
UNION ALL
SELECT page_id, CAST(0 AS INTEGER), '', '', {NO_DEEPER}, CAST(0 AS INTEGER), CAST(0 AS INTEGER),
       'Document too large: ' || strlen(html) || ' bytes (max 4000). Split into chapters.'
FROM pages WHERE strlen(html) > 4000"""
)

# --- language -----------------------------------------------------------------------------


def letters(text: str) -> str:
    return rf"' ' || trim(regexp_replace(lower({text}), '[^\p{{L}}]+', ' ', 'g')) || ' '"


def trigrams(table: str, columns: str) -> str:
    return f"""
    SELECT {columns}, chars[i] || chars[i + 1] || chars[i + 2] AS trigram
    FROM (SELECT {columns}, chars, unnest(range(1, len(chars) - 1)) AS i
          FROM (SELECT {columns}, string_split({letters("text")}, '') AS chars FROM {table}))"""


PROFILES = f"""
WITH profiles AS (
    SELECT lang, trigram, place - 1 AS rank
    FROM (SELECT lang, trigram, row_number() OVER (PARTITION BY lang ORDER BY n DESC, trigram) AS place
          FROM (SELECT lang, trigram, count(*) AS n FROM ({trigrams("documents", "lang")})
                GROUP BY lang, trigram))
    WHERE place <= 300
)"""

ORACLES["language_profiles"] = (
    PROFILES + " SELECT lang, trigram, CAST(rank AS INTEGER) AS rank FROM profiles"
)


def judged(table: str, keys: str) -> str:
    """CTE ``judged`` (keys, lang, confidence, reliable) for the texts with any known trigram."""
    return f"""
, ranked AS (
    SELECT {keys}, trigram, row_number() OVER (PARTITION BY {keys} ORDER BY n DESC, trigram) - 1 AS place,
           count(*) OVER (PARTITION BY {keys}) AS distinct_trigrams
    FROM (SELECT {keys}, trigram, count(*) AS n FROM ({trigrams(table, keys)}) GROUP BY {keys}, trigram)
), scores AS (
    SELECT {keys}, lang, sum(300 - least(abs(place - rank), 300)) AS score, max(distinct_trigrams) AS u
    FROM ranked JOIN profiles USING (trigram) WHERE place < 600
    GROUP BY {keys}, lang
), ordered AS (
    SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY score DESC, lang) AS nth,
           lead(score) OVER (PARTITION BY {keys} ORDER BY score DESC, lang) AS second
    FROM scores
), judged AS (
    SELECT {keys}, lang,
           CASE WHEN coalesce(second, 0) = 0 THEN 1.0::DOUBLE
                ELSE least(1.0::DOUBLE, (score - second)::DOUBLE / second::DOUBLE
                                        / (12.0::DOUBLE / u::DOUBLE + 0.05::DOUBLE)) END AS confidence
    FROM ordered WHERE nth = 1 AND score > 0
)"""


ORACLES["detected_languages"] = (
    PROFILES
    + judged("documents", "doc_id")
    + """
SELECT doc_id, d.lang, j.lang AS detected_lang, round(coalesce(confidence, 0), 6) AS confidence,
       coalesce(confidence > 0.9, FALSE) AS reliable
FROM documents d LEFT JOIN judged j USING (doc_id)"""
)

ORACLES["detected_many_languages"] = f"""
WITH labelled AS (SELECT doc_id, text, lang || '-' || (doc_id % 300) AS lang FROM documents),
{PROFILES.replace("FROM documents", "FROM labelled").lstrip()[len("WITH "):]}
{judged("documents", "doc_id")}
SELECT doc_id, d.lang AS label, j.lang AS detected_lang, round(coalesce(confidence, 0), 6) AS confidence,
       coalesce(confidence > 0.9, FALSE) AS reliable
FROM labelled d LEFT JOIN judged j USING (doc_id)"""

ORACLES["english_turns"] = (
    PROFILES
    + judged("conversations", "conv_id, turn")
    + """
SELECT conv_id, turn, coalesce(lang = 'en' AND confidence > 0.9, FALSE) AS english
FROM conversations LEFT JOIN judged USING (conv_id, turn)"""
)

# --- HTTP ---------------------------------------------------------------------------------


def batches(size: int, order: str) -> str:
    return f"""
WITH numbered AS (
    SELECT props, row_number() OVER (ORDER BY {order}) - 1 AS position FROM events
), batched AS (
    SELECT CAST(position // {size} AS BIGINT) AS batch_id, CAST(count(*) AS INTEGER) AS row_count,
           string_agg(props, '|' ORDER BY position) AS joined
    FROM numbered GROUP BY position // {size}
)"""


ORACLES["batch_payloads"] = (
    batches(100, "event_id") + " SELECT batch_id, row_count, md5(joined) AS digest FROM batched"
)

NO_CONNECTION = "'error sending request for url (http://service.example/post): refused'"

ORACLES["batch_outcomes"] = (
    batches(64, "ts, event_id")
    + f"""
SELECT batch_id, row_count,
       CAST(CASE WHEN length(joined) % 7 = 0 THEN -1 ELSE 200 END AS INTEGER) AS status_code,
       CASE WHEN length(joined) % 7 = 0 THEN {NO_CONNECTION} ELSE md5(joined) END AS response_body
FROM batched"""
)

# one micro-batch reads all that is there
ORACLES["stream_post_batches"] = ORACLES["batch_outcomes"]

ORACLES["post_by_host"] = """
SELECT page_id, lower(split_part(split_part(url, '://', 2), '/', 1)) AS host, CAST(200 AS INTEGER) AS status_code,
       page_id || ' ' || url || ' after ' || CASE WHEN length(url) % 3 = 0 THEN 1 ELSE 0 END AS response_body
FROM pages"""

ORACLES["post_outcomes"] = f"""
SELECT event_id,
       CAST(CASE event_id % 10 WHEN 7 THEN 500 WHEN 8 THEN -1 WHEN 9 THEN 404 ELSE 200 END AS INTEGER)
         AS status_code,
       CASE event_id % 10 WHEN 6 THEN 'attempt 1' WHEN 7 THEN 'attempt 3' WHEN 8 THEN {NO_CONNECTION}
                          ELSE 'attempt 0' END AS response_body,
       CASE WHEN event_id % 10 IN (7, 8) THEN NULL ELSE CAST(event_id AS VARCHAR) END AS echo
FROM events"""

ORACLES["post_keys"] = """
SELECT event_type, count(*) AS events, count(DISTINCT event_id) AS keys FROM events GROUP BY event_type"""
ORACLES["post_repeated_headers"] = "SELECT event_id, event_type || ', ' || event_id AS cookies FROM events"
ORACLES["payload_lines"] = """
SELECT batch_id, CAST(count(*) AS INTEGER) AS row_count,
       md5(string_agg(concat_ws(chr(9), event_id, props), '|' ORDER BY event_id)) AS digest
FROM (SELECT event_id, props, (row_number() OVER (ORDER BY event_id) - 1) // 50 AS batch_id FROM events)
GROUP BY batch_id"""
ORACLES["payload_array_file"] = """
SELECT batch_id, CAST(count(*) AS INTEGER) AS row_count, md5(string_agg(payload, '|' ORDER BY event_id)) AS digest
FROM (SELECT event_id, (row_number() OVER (ORDER BY event_id) - 1) // 100 AS batch_id,
             concat('{"event_id":', event_id, ',"event_type":', to_json(event_type), ',"props":', to_json(props), '}') AS payload
      FROM events)
GROUP BY batch_id"""
ORACLES["post_scripted"] = (
    "SELECT event_id, upper(event_type) || ' ' || event_type AS response_body FROM events"
)

# --- objects ------------------------------------------------------------------------------

ORACLES["objects_roundtrip"] = "SELECT doc_id, text FROM documents"
ORACLES["objects_scan"] = "SELECT doc_id, text FROM documents"
ORACLES["objects_probe"] = """
SELECT doc_id, suffix, suffix = 'txt' AS found
FROM documents, (VALUES ('txt'), ('gone')) AS s(suffix)"""
ORACLES["objects_probe_listing"] = """
SELECT doc_id, kind, kind = 'here' AS found FROM documents, (VALUES ('here'), ('gone'), ('elsewhere')) AS k(kind)"""
ORACLES["object_lines"] = ORACLES["text_lines"]
ORACLES["objects_transformed"] = f"""
SELECT doc_id, {ONE_LINE} AS one_line,
       CASE WHEN doc_id % 2 = 0 THEN lower(text) ELSE {ONE_LINE} END AS by_mode
FROM documents"""
ORACLES["objects_scripted"] = f"""
SELECT doc_id, coalesce(array_to_string(({lines()})[1:1], chr(10)), '') AS content FROM documents"""
ORACLES["object_paths"] = r"""
SELECT page_id, regexp_extract(url, '^([a-z0-9]+)://([^/]*)/(.*)$', 1) AS scheme,
       regexp_extract(url, '^([a-z0-9]+)://([^/]*)/(.*)$', 2) AS bucket,
       regexp_extract(url, '^([a-z0-9]+)://([^/]*)/(.*)$', 3) AS key
FROM pages"""

# --- SQL names ----------------------------------------------------------------------------

ORACLES["sql_html_paragraph"] = ORACLES["html_paragraph"]
ORACLES["sql_html_semantic"] = ORACLES["html_semantic"]
ORACLES["sql_html_raw"] = ORACLES["html_raw"]
ORACLES["sql_text_functions"] = f"""
SELECT doc_id, squeezed, lowered, rest, tokens, value
FROM (SELECT doc_id, regexp_replace(regexp_replace(text, '[0-9]+', 'NUM', 'g'), '\\s+', ' ', 'g') AS squeezed,
             lower(text) AS lowered
      FROM documents)
JOIN (SELECT doc_id, out AS rest FROM ({ORACLES["text_skip_lines"]})) USING (doc_id)
JOIN ({ORACLES["token_count_words"]}) USING (doc_id)
JOIN (SELECT doc_id, value FROM ({vector_rows(2)}) WHERE place = 1) USING (doc_id)"""
