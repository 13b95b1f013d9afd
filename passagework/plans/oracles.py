"""DuckDB SQL for the registered queries, written independently of the operators."""

from __future__ import annotations

from passagework.plans.inputs import (
    EVENT_BODY,
    QUESTION_DOC_TYPE,
    QUESTION_TOP_K,
    RUN_TEXT,
    SPACED_TEXT,
)

_SYMBOLS = "!\"#$%&'()*+,-./:;<=>?@[\\]^`{|}~©·–—…•"
_TOKEN = r"\s*(?:[\p{L}\p{N}]+|[^\s\p{L}\p{N}])"
_TERM = r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]"
_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"
_SPACES = "chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||chr(28)||chr(29)||chr(30)||chr(31)||' '||chr(133)||chr(160)"
_TARGET, _SIZE, _STEP, _DIM = 200, 64, 52, 64


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _lint(expr: str) -> str:
    """One replacement per symbol: the engine has no back-references."""
    for symbol in _SYMBOLS:
        pattern = "\\" + symbol + "{4,}" if symbol.isascii() else symbol + "{4,}"
        keep = "\\\\\\\\\\\\" if symbol == "\\" else symbol * 3
        expr = f"regexp_replace({expr}, {_quoted(pattern)}, {_quoted(keep)}, 'g')"
    return expr


def _lines(expr: str) -> str:
    return (
        f"list_filter(list_transform(string_split_regex(regexp_replace({expr}, '[ \\t]+', ' ', 'g'), "
        f"'{_BREAK}'), lambda x: trim(x, {_SPACES})), lambda x: x <> '')"
    )


def _strip(expr: str) -> str:
    return f"trim({expr}, {_SPACES})"


# Greedy sections: the running count starts again after the line that fills it.
_FILINGS = """src AS (SELECT CAST(doc_id AS VARCHAR) AS document_id, source AS tenant, lang AS doc_type, text AS body FROM documents)"""


def _sections(source: str) -> str:
    return f"""
{source},
lined AS (SELECT document_id, unnest({_lines(_lint('body'))}) AS line,
                 generate_subscripts({_lines(_lint('body'))}, 1) AS ln FROM src),
counted AS MATERIALIZED (SELECT *, len(regexp_extract_all(line, '{_TOKEN}')) AS n FROM lined),
walk AS (
  SELECT document_id, ln, 1 AS page_number, n AS total FROM counted WHERE ln = 1
  UNION ALL
  SELECT c.document_id, c.ln,
         CASE WHEN w.total >= {_TARGET} THEN w.page_number + 1 ELSE w.page_number END,
         CASE WHEN w.total >= {_TARGET} THEN c.n ELSE w.total + c.n END
  FROM walk w JOIN counted c ON c.document_id = w.document_id AND c.ln = w.ln + 1),
section AS (
  SELECT document_id, page_number, count(*) AS n_lines,
         string_agg(line, chr(10) ORDER BY ln) AS text
  FROM walk JOIN counted USING (document_id, ln) GROUP BY document_id, page_number)"""


def _chunks(source: str) -> str:
    return f"""{_sections(source)},
toks AS (SELECT document_id, page_number, regexp_extract_all({_strip('text')}, '{_TOKEN}') AS t FROM section),
starts AS (SELECT document_id, page_number, t, unnest(range(0, len(t), {_STEP})) AS s FROM toks),
cut AS (SELECT document_id, page_number, s,
               {_strip(f"array_to_string(list_slice(t, s + 1, s + {_SIZE}), '')")} AS text,
               least({_SIZE}, len(t) - s) AS token_count,
               len(array_to_string(list_slice(t, 1, s), '')) AS char_offset
        FROM starts),
chunk AS (SELECT document_id || ':' || page_number || ':' || (row_number() OVER w - 1) AS chunk_id,
                 document_id, page_number, row_number() OVER w - 1 AS chunk_index,
                 token_count, char_offset, text
          FROM cut WHERE text <> '' WINDOW w AS (PARTITION BY document_id, page_number ORDER BY s))"""


_SECTION_ROWS = f"""WITH RECURSIVE {_sections(_FILINGS)}
SELECT document_id, tenant, doc_type, CAST(page_number AS BIGINT) AS page_number,
       CAST(len(text) AS BIGINT) AS n_chars, md5(text) AS text_md5
FROM section JOIN src USING (document_id)"""

_CHUNK_ROWS = f"""WITH RECURSIVE {_chunks(_FILINGS)}
SELECT chunk_id, tenant, doc_type, CAST(page_number AS BIGINT) AS page_number,
       CAST(chunk_index AS BIGINT) AS chunk_index, CAST(token_count AS BIGINT) AS token_count,
       CAST(char_offset AS BIGINT) AS char_offset, md5(chunk.text) AS text_md5, doc_type AS lang
FROM chunk JOIN src USING (document_id)"""

# --- vector search --------------------------------------------------------

_VECTORS = """chunks AS (
  SELECT vec_id || ':1:0' AS chunk_id, CAST(vec_id AS VARCHAR) AS document_id, source AS tenant,
         lang AS doc_type, 1 AS page_number, text, CAST(embedding AS DOUBLE[]) AS v
  FROM embeddings JOIN documents ON vec_id = doc_id),
asked AS (
  SELECT l.doc_id AS q_id, d.source AS tenant, {doc_type} AS doc_type,
         coalesce(nullif({top_k}, 0), 5) AS k, CAST(e.embedding AS DOUBLE[]) AS v
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id JOIN embeddings e ON e.vec_id = l.doc_id)"""

_HITS = """,
scored AS (
  SELECT q_id, k, chunk_id, document_id, c.doc_type, page_number, text, c.tenant,
         round((1 + list_cosine_similarity(a.v, c.v)) / 2, 9) AS score
  FROM asked a JOIN chunks c ON c.tenant = a.tenant
   AND (nullif(a.doc_type, '') IS NULL OR c.doc_type = a.doc_type)),
hits AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY score DESC, chunk_id) AS rank
                 FROM scored) WHERE rank <= k)"""

_RANKED = """
SELECT q_id, rank, chunk_id, round(score, 6) AS score, document_id, doc_type,
       CAST(page_number AS BIGINT) AS page_number, md5(text) AS text_md5 FROM hits"""


# Questions of a tenant without chunks stand beside the others.
_WITH_STRANGERS = """,
q AS (SELECT q_id FROM asked UNION ALL SELECT -q_id - 1 FROM asked WHERE q_id % 3 = 0)"""


def _hits(doc_type: str = "NULL") -> str:
    return "WITH " + _VECTORS.format(doc_type=doc_type, top_k=QUESTION_TOP_K) + _HITS


# Cells are the mean unit vectors of the labels; each vector stands in its nearest cell and in
# the best one by residual angle, and a question visits the five nearest cells.
_CELL_HITS = (
    "WITH "
    + _VECTORS.format(doc_type="NULL", top_k=QUESTION_TOP_K)
    + """,
unit AS (SELECT vec_id, label, list_transform(CAST(embedding AS DOUBLE[]),
           lambda x: x / sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])))) AS u
         FROM embeddings),
places AS (SELECT label, unnest(range(1, len(u) + 1)) AS place, unnest(u) AS x FROM unit),
centre AS (SELECT label, list(x ORDER BY place) AS c FROM (SELECT label, place, avg(x) AS x FROM places GROUP BY label, place) GROUP BY label),
dots AS (SELECT vec_id, label AS cell, u, c, list_dot_product(c, u) AS uc, list_dot_product(c, c) AS cc
         FROM (SELECT vec_id, u FROM unit), (SELECT label, c FROM centre)),
near AS (SELECT vec_id, cell, row_number() OVER (PARTITION BY vec_id ORDER BY round(cc - 2 * uc, 12), cell) AS nth FROM dots),
one AS (SELECT d.vec_id, d.cell, d.c, d.uc, d.cc FROM dots d JOIN near n ON n.vec_id = d.vec_id AND n.cell = d.cell AND n.nth = 1),
two AS (
  SELECT vec_id, cell FROM (
    SELECT d.vec_id, d.cell, row_number() OVER (PARTITION BY d.vec_id ORDER BY round(d.cc - 2 * d.uc
             + pow(list_dot_product(d.u, d.u) - o.uc - d.uc + list_dot_product(o.c, d.c), 2)
             / (list_dot_product(d.u, d.u) - 2 * o.uc + o.cc), 12), d.cell) AS nth
    FROM dots d JOIN one o ON o.vec_id = d.vec_id AND o.cell <> d.cell) WHERE nth = 1),
placed AS (SELECT vec_id, cell FROM one UNION ALL SELECT vec_id, cell FROM two),
met AS (
  SELECT DISTINCT n.vec_id AS q, m.vec_id FROM near n JOIN placed m ON m.cell = n.cell WHERE n.nth <= 5),
scored AS (
  SELECT q_id, k, chunk_id, document_id, c.doc_type, page_number, text, c.tenant,
         round((1 + list_cosine_similarity(a.v, c.v)) / 2, 9) AS score
  FROM asked a JOIN met m ON m.q = a.q_id
  JOIN chunks c ON c.tenant = a.tenant AND c.document_id = CAST(m.vec_id AS VARCHAR)),
hits AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY score DESC, chunk_id) AS rank
                 FROM scored) WHERE rank <= k)"""
)

# --- messages -------------------------------------------------------------


def _blank(field: str) -> str:
    kind = f"json_type(body, '$.{field}')"
    return (
        f"({kind} IS NULL OR {kind} = 'NULL' OR ({kind} = 'VARCHAR' AND "
        f"{_strip(f'''json_extract_string(body, '$.{field}')''')} = ''))"
    )


def _mistyped(field: str) -> str:
    return f"CASE WHEN json_type(body, '$.{field}') <> 'VARCHAR' THEN '{field}' END"


_REQUIRED = ("document_id", "s3_bucket", "s3_key", "tenant")
_WRONG = "concat_ws(', ', " + ", ".join(_mistyped(f) for f in (*_REQUIRED, "doc_type")) + """,
  CASE WHEN json_type(body, '$.metadata') <> 'OBJECT'
         OR len(list_filter(json_extract(body, '$.metadata.*'), lambda x: json_type(x) <> 'VARCHAR')) > 0
       THEN 'metadata' END)"""
_CHECKED = f"""WITH bodies AS (SELECT event_id, {EVENT_BODY} AS body FROM events),
shaped AS (SELECT event_id, body AS raw, CASE WHEN json_valid(body) THEN body END AS body FROM bodies),
checked AS (SELECT *, CASE
  WHEN body IS NULL THEN 'body is not valid JSON'
  WHEN json_type(body) <> 'OBJECT' THEN 'body must be a JSON object'
  {' '.join(f"WHEN {_blank(f)} THEN 'required field ''{f}'' is missing or empty'" for f in _REQUIRED)}
  WHEN {_WRONG} <> '' THEN 'wrong type for: ' || {_WRONG} END AS reason FROM shaped)"""

# --- catalogue ------------------------------------------------------------

_COMPANIES = """WITH catalogue AS (
  SELECT s_suppkey AS pos, 't' || (s_suppkey % 70) AS ticker,
         CAST(s_suppkey * 7919 AS BIGINT) AS cik, s_name AS title FROM supplier),
firsts AS (SELECT upper(ticker) AS key, arg_min(cik, pos) AS cik, arg_min(title, pos) AS title
           FROM catalogue GROUP BY 1),
asked AS (SELECT c_custkey, CASE WHEN c_nationkey % 3 = 0 THEN 't' ELSE 'T' END || (c_custkey % 90) AS ticker
          FROM customer),
companies AS (SELECT c_custkey, ticker, lpad(CAST(cik AS VARCHAR), 10, '0') AS cik, title
              FROM asked LEFT JOIN firsts ON upper(ticker) = key)"""

_FILED = """filed AS (
  SELECT o_custkey AS company,
         replace(concat_ws('-', o_custkey, year(o_orderdate), o_orderkey), '-', '') AS accession,
         'd' || o_orderkey || '.htm' AS primary_document
  FROM orders WHERE o_orderpriority = '1-URGENT'
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE) DESC, o_orderkey) = 1)"""

_LOCATED = f"""{_COMPANIES}, {_FILED},
located AS (SELECT c_custkey, upper(ticker) AS ticker, title, accession,
  upper(ticker) || '-10K-' || accession AS document_id,
  upper(ticker) || '/' || accession || '/' || primary_document AS s3_key,
  'https://archive.example/data/' || CAST(cik AS BIGINT) || '/' || accession || '/' || primary_document AS archive_url
  FROM companies JOIN filed ON c_custkey = company WHERE cik IS NOT NULL)"""

# --- html -----------------------------------------------------------------

_ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&copy;": "©", "&middot;": "·", "&nbsp;": " "}


def _html_body() -> str:
    text = (
        "regexp_replace(html, '(?is)<!--.*?-->|<(script|style)\\b.*?</(script|style)\\s*>"
        "|<[!/a-z][^>]*>', chr(10), 'g')"
    )
    for name, value in _ENTITIES.items():
        text = f"replace({text}, '{name}', {_quoted(value)})"
    return f"replace({text}, '&amp;', '&')"


_HTML_LINES = f"""SELECT page_id, CAST(len(ls) AS BIGINT) AS n_lines,
  md5(array_to_string(ls, chr(10))) AS lines_md5
FROM (SELECT page_id, {_lines(_lint(_html_body()))} AS ls FROM pages)"""

# --- hashed vectors -------------------------------------------------------


def _unit_terms(table: str, key: str) -> str:
    """(key, slot, x): non-zero slots of the hashed unit vector, as stored in float."""
    return f"""
  SELECT {key}, slot, CAST(CAST(n / sqrt(sum(n * n) OVER (PARTITION BY {key})) AS FLOAT) AS DOUBLE) AS x
  FROM (SELECT {key}, slot, CAST(sum(sign) AS DOUBLE) AS n FROM (
          SELECT {key}, CAST('0x' || md5(term)[1:8] AS BIGINT) % {_DIM} AS slot,
                 CASE WHEN CAST('0x' || md5(term)[9:10] AS BIGINT) % 2 = 0 THEN 1 ELSE -1 END AS sign
          FROM (SELECT {key}, unnest(regexp_extract_all(lower(text), '{_TERM}')) AS term FROM {table}))
        GROUP BY {key}, slot HAVING sum(sign) <> 0)"""


# --- upsert ---------------------------------------------------------------

_UPSERT = """WITH stored AS (
  SELECT d.doc_id || ':1:0' AS chunk_id, CAST(d.doc_id AS VARCHAR) AS document_id, source AS tenant,
         lang AS doc_type, n_chars AS token_count, text, lang, CAST(quality AS BIGINT) AS quality,
         CAST(toxic AS BIGINT) AS toxic
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
batch AS (
  SELECT CASE WHEN quality = 0 THEN d.doc_id + 1000000000 ELSE d.doc_id END AS doc,
         source AS tenant, lower(lang) AS text
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)
SELECT coalesce(s.chunk_id, doc || ':1:0') AS chunk_id,
       coalesce(s.document_id, CAST(doc AS VARCHAR)) AS document_id,
       coalesce(b.tenant, s.tenant) AS tenant,
       CASE WHEN doc IS NULL THEN s.doc_type END AS doc_type,
       CASE WHEN doc IS NULL THEN s.token_count ELSE 2 END AS token_count,
       md5(coalesce(b.text, s.text)) AS text_md5,
       CASE WHEN doc IS NULL THEN 1.0 ELSE 0.0 END::DOUBLE AS v0,
       s.lang AS meta_lang,
       CASE WHEN doc IS NULL THEN '0' ELSE '2' END AS meta_pass,
       b.tenant AS meta_first, coalesce(s.quality, -1) AS quality, coalesce(s.toxic, -1) AS toxic
FROM stored s FULL OUTER JOIN batch b ON s.chunk_id = b.doc || ':1:0'"""

ORACLES: dict[str, str] = {
    "knn_topk": _hits() + _RANKED,
    "knn_topk_blocks": _hits() + _RANKED,
    "ann_ivf_all_cells": _hits() + _RANKED,
    "ann_bound": _hits() + _RANKED,
    "knn_doc_type": _hits(QUESTION_DOC_TYPE) + _RANKED,
    "tenant_isolation": "WITH "
    + _VECTORS.format(doc_type="NULL", top_k=QUESTION_TOP_K).replace(
        "d.source AS tenant", "'src' || ((CAST(d.source[4:] AS INT) + 1) % 20) AS tenant"
    )
    + _HITS
    + """
SELECT h.q_id, a.tenant AS asked_tenant, count(*) AS n_hits,
       count(*) FILTER (WHERE h.tenant <> a.tenant) AS n_foreign
FROM hits h JOIN asked a ON h.q_id = a.q_id GROUP BY ALL""",
    "tenant_shared_keys": _hits().replace(
        "vec_id || ':1:0' AS chunk_id", "'k' || CAST(floor(vec_id / 20) AS BIGINT) AS chunk_id"
    )
    + _RANKED,
    "question_rejects": """SELECT doc_id AS q_id, CASE doc_id % 4 WHEN 0 THEN 'no tenant'
  WHEN 1 THEN 'no vector' ELSE 'negative top_k' END AS reason
FROM labels JOIN documents USING (doc_id) JOIN embeddings ON vec_id = doc_id WHERE doc_id % 4 < 3""",
    "ann_ivf": _CELL_HITS + _RANKED,
    "citations": _hits()
    + " SELECT q_id, rank, document_id, CAST(page_number AS BIGINT) AS page_number, "
    "round(score, 6) AS score FROM hits",
    "results_per_question": _hits()
    + _WITH_STRANGERS
    + """ SELECT q.q_id, count(rank) AS n_chunks, coalesce(string_agg(document_id, ',' ORDER BY rank), '') AS cited,
  round(max(score), 6) AS best_score, md5(coalesce(string_agg(text, '|' ORDER BY rank), '')) AS texts_md5
FROM q LEFT JOIN hits ON q.q_id = hits.q_id GROUP BY q.q_id""",
    "context_budget": _hits()
    + _WITH_STRANGERS
    + """ SELECT q.q_id, CAST(coalesce(sum(len(text)), 0) AS BIGINT) AS context_chars, count(rank) AS n_hits,
  coalesce(sum(len(text)), 0) <= 12000 AS accepted FROM q LEFT JOIN hits ON q.q_id = hits.q_id GROUP BY q.q_id""",
    "retrieve_text": f"""WITH RECURSIVE {_chunks(_FILINGS)},
question AS (SELECT conv_id || '-' || turn AS q_id, text, 'src' || (conv_id % 20) AS tenant
             FROM conversations WHERE role = 'user'),
cv AS ({_unit_terms('chunk', 'chunk_id')}),
qv AS ({_unit_terms('question', 'q_id')}),
chunk_norm AS (SELECT chunk_id, sqrt(sum(x * x)) AS n FROM cv GROUP BY chunk_id),
question_norm AS (SELECT q_id, sqrt(sum(x * x)) AS n FROM qv GROUP BY q_id),
owned AS (SELECT chunk.*, tenant, doc_type FROM chunk JOIN src USING (document_id)),
dots AS (SELECT q_id, o.chunk_id, sum(qv.x * cv.x) AS dot
         FROM question q JOIN qv USING (q_id) JOIN owned o ON o.tenant = q.tenant
         JOIN cv ON cv.chunk_id = o.chunk_id AND cv.slot = qv.slot GROUP BY q_id, o.chunk_id),
scored AS (SELECT q.q_id, o.chunk_id, o.document_id, o.doc_type, o.page_number, o.text,
             round((1 + coalesce(dot, 0) / (cn.n * qn.n)) / 2, 9) AS score
           FROM question q JOIN question_norm qn USING (q_id) JOIN owned o ON o.tenant = q.tenant
           JOIN chunk_norm cn ON cn.chunk_id = o.chunk_id
           LEFT JOIN dots d ON d.q_id = q.q_id AND d.chunk_id = o.chunk_id),
hits AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY score DESC, chunk_id) AS rank
                        FROM scored) WHERE rank <= 5)
{_RANKED}""",
    "utf8_decode": "SELECT doc_id, len(t) AS n_chars, md5(t) AS text_md5 "
    "FROM (SELECT doc_id, text || chr(65533) || ' end' AS t FROM documents)",
    "lint_text": "SELECT doc_id, len(dirty) - len(clean) AS chars_saved, md5(clean) AS text_md5 "
    f"FROM (SELECT doc_id, dirty, {_lint('dirty')} AS clean "
    f"FROM (SELECT doc_id, {RUN_TEXT} AS dirty FROM documents))",
    "normalise_lines": "SELECT doc_id, CAST(len(ls) AS BIGINT) AS n_lines, "
    "md5(array_to_string(ls, chr(10))) AS lines_md5 "
    f"FROM (SELECT doc_id, {_lines('t')} AS ls FROM (SELECT doc_id, {SPACED_TEXT} AS t FROM documents))",
    "token_counts": f"""SELECT doc_id, CAST(list_sum(c) AS BIGINT) AS n_tokens, CAST(list_max(c) AS BIGINT) AS longest_line
FROM (SELECT doc_id, list_transform({_lines('text')}, lambda l: len(regexp_extract_all(l, '{_TOKEN}'))) AS c FROM documents)""",
    "html_sniff": " UNION ALL ".join(
        f"SELECT '{kind}' AS kind, {key} AS id, contains(lower({column}[1:2000]), '<html') "
        f"OR contains(lower({column}[1:5000]), '<div') AS is_html FROM {table}"
        for kind, key, column, table in (
            ("page", "page_id", "html", "pages"),
            ("document", "doc_id", "text", "documents"),
        )
    ),
    "html_text": _HTML_LINES,
    "html_text_parser": _HTML_LINES,
    "sections": _SECTION_ROWS,
    "long_sections_by_pieces": _SECTION_ROWS,
    "section_stats": f"""WITH RECURSIVE {_sections(_FILINGS)}
SELECT tenant, doc_type, count(*) AS n_sections, CAST(sum(n_lines) AS BIGINT) AS n_lines,
       CAST(max(page_number) AS BIGINT) AS most_sections
FROM section JOIN src USING (document_id) GROUP BY tenant, doc_type""",
    "chunk_windows": _CHUNK_ROWS,
    "stream_ingest": _CHUNK_ROWS,
    "chunk_stats": f"""WITH RECURSIVE {_chunks(_FILINGS)}
SELECT tenant, count(*) AS n_chunks, CAST(sum(token_count) AS BIGINT) AS n_tokens,
       count(*) FILTER (WHERE token_count < {_SIZE}) AS n_short,
       CAST(max(chunk_index) AS BIGINT) AS last_index
FROM chunk JOIN src USING (document_id) GROUP BY tenant""",
    "web_chunks": f"""WITH RECURSIVE {_chunks(
        f"src AS (SELECT CAST(page_id AS VARCHAR) AS document_id, {_html_body()} AS body FROM pages)"
    )}
SELECT chunk_id, CAST(token_count AS BIGINT) AS token_count, CAST(char_offset AS BIGINT) AS char_offset,
       md5(text) AS text_md5 FROM chunk""",
    "message_validation": f"""{_CHECKED}
SELECT event_id, {', '.join(f"json_extract_string(body, '$.{f}') AS {f}" for f in _REQUIRED)},
       coalesce(json_extract_string(body, '$.doc_type'), '10-K') AS doc_type,
       CAST(coalesce(len(json_keys(body, '$.metadata')), 0) AS BIGINT) AS n_metadata,
       json_extract_string(body, '$.metadata.type') AS metadata_type
FROM checked WHERE reason IS NULL""",
    "message_rejects": f"{_CHECKED} SELECT event_id, reason, md5(raw) AS body_md5 FROM checked "
    "WHERE reason IS NOT NULL",
    "queue_messages": f"""{_CHECKED} SELECT md5(raw) AS body_md5, reason,
       CASE WHEN reason IS NULL THEN json_extract_string(body, '$.document_id') END AS document_id,
       CASE WHEN reason IS NULL THEN json_extract_string(body, '$.tenant') END AS tenant FROM checked""",
    "message_build": f"""{_LOCATED}
SELECT CAST(to_json({{'document_id': document_id, 's3_bucket': 'raw', 's3_key': s3_key, 'tenant': ticker,
  'doc_type': '10-K', 'metadata': {{'company': title, 'accession': accession}}}}) AS VARCHAR) AS body FROM located""",
    "catalogue_lookup": f"{_COMPANIES} SELECT c_custkey, ticker, cik, title FROM companies",
    "catalogue_rejects": f"{_COMPANIES} SELECT c_custkey, ticker, 'ticker not found: ' || ticker AS reason "
    "FROM companies WHERE cik IS NULL",
    "filing_rejects": f"""{_COMPANIES}, {_FILED}
SELECT c_custkey, ticker, CASE WHEN cik IS NULL THEN 'ticker not found: ' ELSE 'no 10-K filing: ' END || ticker AS reason
FROM companies LEFT JOIN filed ON c_custkey = company WHERE cik IS NULL OR company IS NULL""",
    "latest_filing": """WITH words AS (SELECT doc_id, string_split(text, ' ') AS w FROM documents),
found AS (SELECT doc_id, w, list_position(list_transform(w[1:greatest(len(w) - 2, 0)], lambda x: len(x) = 7), true) AS p FROM words)
SELECT doc_id, CASE WHEN p > 0 THEN '7' || md5(w[p]) END AS accession,
       CASE WHEN p > 0 THEN lower(w[p]) || '.htm' END AS primary_document FROM found""",
    "latest_filing_rows": f"WITH {_FILED} SELECT company, accession, primary_document FROM filed",
    "filing_location": f"{_LOCATED} SELECT c_custkey, document_id, s3_key, archive_url FROM located",
    "hashed_embedding": f"""WITH RECURSIVE {_chunks(_FILINGS)},
cv AS ({_unit_terms('chunk', 'chunk_id')})
SELECT chunk_id, CAST({_DIM} AS BIGINT) AS dim, count(x) AS n_slots,
       round(coalesce(sum(abs(x)), 0), 6) AS abs_sum, round(coalesce(sum(abs(x) * (slot + 1)), 0), 6) AS slot_sum,
       round(coalesce(sum(x * x), 0), 6) AS square_sum,
       md5(coalesce(string_agg(slot || ':' || CAST(round(x * 10000) AS BIGINT), ',' ORDER BY slot), '')) AS vector_md5
FROM chunk LEFT JOIN cv USING (chunk_id) GROUP BY chunk_id""",
    "embed_udf": f"""WITH RECURSIVE {_chunks(_FILINGS)}
SELECT chunk_id, CAST(len(text) - len(replace(text, ' ', '')) + 1 AS DOUBLE) AS v0, CAST(len(text) AS DOUBLE) AS v1,
  CAST(len(text) - len(replace(text, chr(10), '')) AS DOUBLE) AS v2, CAST(unicode(text) AS DOUBLE) AS v3 FROM chunk""",
    "l2_normalise": """WITH d AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x * 2::FLOAT AS DOUBLE)) AS v FROM embeddings),
n AS (SELECT vec_id, v, sqrt(list_dot_product(v, v)) AS n FROM d)
SELECT vec_id, round(n, 6) AS norm, CAST(1 AS DOUBLE) AS unit_norm, round(v[1] / n, 6) AS first, round(v[-1] / n, 6) AS last FROM n""",
    "dim_check": "SELECT label, count(*) FILTER (WHERE len(embedding) = 64) AS fitting, "
    "count(*) FILTER (WHERE len(embedding) <> 63) AS misfitting FROM embeddings GROUP BY label",
    "upsert_merge": _UPSERT,
    "upsert_table": _UPSERT,
    "upsert_counts": """WITH n AS (SELECT (SELECT count(*) FROM documents) AS d,
  (SELECT count(*) FROM documents JOIN labels USING (doc_id)) AS l,
  (SELECT count(*) FROM documents JOIN labels USING (doc_id) WHERE quality = 0) AS fresh)
SELECT unnest(['created', 'created again', 'received first', 'received second', 'stored']) AS step,
  unnest([1, 0, d, 2 * l, d + fresh]) AS n FROM n""",
    "raw_documents": """SELECT CAST(doc_id AS VARCHAR) AS document_id,
  CASE WHEN doc_id % 10 <> 0 THEN md5(text) END AS content_md5,
  CASE WHEN doc_id % 10 <> 0 THEN CAST(strlen(text) AS BIGINT) END AS n_bytes FROM documents""",
    "metadata_lookup": "SELECT d.doc_id || ':1:0' AS chunk_id, source AS tenant, CAST(coalesce(quality, -1) AS BIGINT) AS quality "
    "FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE lang = 'de'",
    "reject_unembedded": "SELECT doc_id || ':1:0' AS chunk_id, 'has no embedding' AS reason "
    "FROM documents LEFT JOIN embeddings ON doc_id = vec_id WHERE vec_id IS NULL",
}
