"""DuckDB oracles of the corpus queries, written as a SQL user would."""

from layerwell.llm.licenses import BASE, NOTICES, edits_of, pieces

WORDS = r"len(regexp_extract_all(text, '[^\x20\x09-\x0D]+'))"
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

EXACT_DEDUP = f"""
WITH digests AS (SELECT doc_id, sha256({LOWER}) AS text_sha256 FROM documents)
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept,
       text_sha256
FROM digests
WINDOW same AS (PARTITION BY text_sha256)
"""

MIXING = f"""
WITH sizes AS (
  SELECT doc_id, source, CAST(coalesce({WORDS}, 0) AS BIGINT) AS size, md5('mix:' || doc_id) AS key FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight
  FROM sizes GROUP BY source
), along AS (
  SELECT *, sum(source_size) OVER () AS words, sum(weight) OVER () AS weights,
         coalesce(sum(source_size) OVER earlier, 0) AS words_before, coalesce(sum(weight) OVER earlier, 0) AS weights_before
  FROM sources
  WINDOW earlier AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), capped AS (
  SELECT *, 3 * source_size * (weights - weights_before) < (words - 3 * words_before) * weight AS is_capped FROM along
), rest AS (
  SELECT any_value(words) - 3 * coalesce(sum(source_size) FILTER (WHERE is_capped), 0) AS words,
         any_value(weights) - coalesce(sum(weight) FILTER (WHERE is_capped), 0) AS weights
  FROM capped
), targets AS (
  SELECT source, source_size,
         CASE WHEN is_capped THEN CAST(3 * source_size AS DOUBLE)
              ELSE CAST(rest.words AS DOUBLE) * weight / CAST(rest.weights AS DOUBLE) END AS target
  FROM capped, rest
), placed AS (
  SELECT s.*, t.source_size, t.target, CAST(floor(t.target) AS BIGINT) AS budget,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY key, doc_id
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       CAST(CASE WHEN source_size = 0 THEN 0
                 ELSE budget // source_size * size + greatest(0, least(size, budget % source_size - before)) END AS BIGINT) AS taken
FROM placed
"""


def _spans(kind: str, rank: int, pattern: str, valid: str) -> str:
    """Spans of one kind: text before a match and earlier matches give its position."""
    return f"""
SELECT doc_id, {rank} AS rank, '{kind}' AS kind, value, start, start + length(value) AS stop
FROM ({_places("texts", pattern)}) WHERE {valid}"""


def _places(texts: str, pattern: str) -> str:
    """Matches of a pattern with their positions (doc_id, value, start)."""
    return f"""
SELECT doc_id, value,
       sum(length(gap)) OVER (PARTITION BY doc_id ORDER BY i)
         + coalesce(sum(length(value)) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
FROM (
  SELECT doc_id, unnest(range(len(found))) AS i, unnest(gaps[:len(found)]) AS gap, unnest(found) AS value
  FROM (SELECT doc_id, regexp_split_to_array(text, '{pattern}') AS gaps, regexp_extract_all(text, '{pattern}') AS found
        FROM {texts} WHERE regexp_matches(text, '{pattern}'))
)"""


def _masked(texts: str, pattern: str, valid: str) -> str:
    """Texts with a space for every valid match."""
    return f"""
SELECT doc_id, CASE WHEN len(found) = 0 THEN text ELSE
         array_to_string(list_transform(range(1, len(gaps) + 1), lambda i: gaps[i] || coalesce(found[i], '')), '') END AS text
FROM (SELECT doc_id, text, regexp_split_to_array(text, '{pattern}') AS gaps,
             list_transform(regexp_extract_all(text, '{pattern}'), lambda value: CASE WHEN {valid} THEN ' ' ELSE value END) AS found
      FROM {texts})"""


_DIGITS = "regexp_replace(value, '[^0-9]', '', 'g')"
_LUHN = f"""list_sum(list_transform(range(length({_DIGITS})),
  lambda i: CASE WHEN i % 2 = 0 THEN CAST({_DIGITS}[length({_DIGITS}) - i] AS INT)
                 WHEN CAST({_DIGITS}[length({_DIGITS}) - i] AS INT) > 4 THEN 2 * CAST({_DIGITS}[length({_DIGITS}) - i] AS INT) - 9
                 ELSE 2 * CAST({_DIGITS}[length({_DIGITS}) - i] AS INT) END)) % 10 = 0"""
_PARTS = "len(list_filter(string_split(value, '.'), lambda p: length(ltrim(p, '0')) > 3 OR CAST('0' || right(p, 3) AS INT) > 255)) = 0"
_KINDS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "true"),
    ("ip", r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)", _PARTS),
    ("card", r"[0-9](?:[\x20-]?[0-9])+", f"CASE WHEN length({_DIGITS}) BETWEEN 12 AND 19 THEN {_LUHN} ELSE false END"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", f"length({_DIGITS}) BETWEEN 9 AND 15"),
]
_BASE = " UNION ALL ".join(_spans(kind, rank, pattern, valid) for rank, (kind, pattern, valid) in enumerate(_KINDS))
_MASKS = ",\n".join(f"masked_{kind} AS ({_masked(before, pattern, valid)})" for before, (kind, pattern, valid) in zip(
    ["texts", *(f"masked_{kind}" for kind, _, _ in _KINDS)], _KINDS))
_TERM = r"[\p{L}\p{N}][\p{L}\p{M}\p{N}]*"

# Words are counted outside the identifiers, over whole texts; a telling word is marked in every document that holds the entity.
PERSONAL_DATA = rf"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
base AS ({_BASE}),
{_MASKS},
words AS (
  SELECT DISTINCT doc_id, term
  FROM (SELECT doc_id, unnest(list_transform(regexp_extract_all(text, '{_TERM}'), lambda w: lower(w))) AS term FROM masked_phone)
),
spoken AS (SELECT term, count(*) AS n_t FROM words GROUP BY term),
entities AS (
  SELECT DISTINCT doc_id, rank || ':' || CASE rank WHEN 0 THEN lower(value) WHEN 1 THEN value ELSE {_DIGITS} END AS entity FROM base
),
held AS (SELECT entity, count(*) AS n_c FROM entities GROUP BY entity),
pairs AS (SELECT entity, term, count(*) AS n_ct FROM entities JOIN words USING (doc_id) GROUP BY entity, term),
told AS (
  SELECT entity, term, log2(total / n_c) AS whole,
         log2(total * n_ct / (CAST(n_c AS DOUBLE) * (n_t + 3 * greatest(0, 4 - length(term))))) - 3.0 / (n_ct * n_ct) AS shared
  FROM pairs JOIN held USING (entity) JOIN spoken USING (term), (SELECT CAST(count(*) AS DOUBLE) AS total FROM documents)
),
marked AS (
  SELECT doc_id, term, max(shared / whole) AS share
  FROM entities JOIN told USING (entity) JOIN words USING (doc_id, term)
  WHERE whole > 0 AND shared >= 0.7 * whole GROUP BY doc_id, term
),
suspects AS (SELECT * FROM texts WHERE doc_id IN (SELECT doc_id FROM marked)),
spans AS (
  SELECT doc_id, rank, kind, start, stop FROM base
  UNION ALL
  SELECT w.doc_id, CASE WHEN share >= 0.95 THEN 5 ELSE 4 END, CASE WHEN share >= 0.95 THEN 'gone' ELSE 'term' END,
         start, start + length(value)
  FROM ({_places("suspects", _TERM)}) w JOIN marked m ON w.doc_id = m.doc_id AND lower(w.value) = m.term
),
joined AS (
  SELECT doc_id,
         count(*) FILTER (WHERE rank = 0) AS n_email, count(*) FILTER (WHERE rank = 1) AS n_ip,
         count(*) FILTER (WHERE rank = 2) AS n_card, count(*) FILTER (WHERE rank = 3) AS n_phone,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) FILTER (WHERE rank < 4) AS own,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) AS spans
  FROM spans GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card,
       coalesce(n_phone, 0) AS n_phone, sha256(coalesce(own, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents d LEFT JOIN joined j USING (doc_id)
"""

CHAT = """
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS name, coalesce(text, '') AS text FROM conversations
), seen AS (
  SELECT t.*, perspective,
         CASE WHEN name = 'system' THEN 'system' WHEN name = perspective THEN 'assistant' ELSE 'user' END AS role
  FROM turns t
  JOIN (SELECT DISTINCT conv_id, name AS perspective FROM turns WHERE name <> 'system') s ON t.conv_id IS NOT DISTINCT FROM s.conv_id
), headed AS (
  SELECT *, '<|im_start|>' || role || CASE role WHEN 'user' THEN ' name=' || name ELSE '' END || chr(10) AS head FROM seen
), rendered AS (
  SELECT *, head || text || '<|im_end|>' || chr(10) AS segment FROM headed
), placed AS (
  SELECT *, CAST(sum(length(segment)) OVER (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, name, segment
                                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS stop
  FROM rendered
)
SELECT conv_id, perspective, turn, role, name, segment, stop - length(segment) AS start, stop AS "end",
       CASE role WHEN 'assistant' THEN stop - length(segment) + length(head) END AS mask_start,
       CASE role WHEN 'assistant' THEN stop - 1 END AS mask_end
FROM placed
"""

def _crc32(text: str) -> str:
    """Unsigned CRC-32 of an ASCII text: bytes, then the eight bits of each."""
    step = "lambda x, bit: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END"
    one = f"lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)), {step})"
    codes = f"list_transform(string_split({text}, ''), lambda ch: CAST(ascii(ch) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {codes}), {one}), 4294967295)"


PREFIX_TRIE = rf"""
WITH turns AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS n
  FROM conversations WHERE conv_id IS NOT NULL
), skips AS (
  SELECT c, {_crc32("CAST(c AS VARCHAR)")} % 4 AS h FROM (SELECT DISTINCT c FROM turns)
), borrowed AS (
  SELECT s.c, t.n AS p, t.role, t.text FROM skips s JOIN turns t ON t.c = s.c - s.c % 20 AND t.n <= s.h
), rebuilt AS (
  SELECT * FROM borrowed
  UNION ALL
  SELECT t.c, t.n - s.h + (SELECT count(*) FROM borrowed b WHERE b.c = t.c), t.role, t.text
  FROM turns t JOIN skips s ON s.c = t.c AND t.n > s.h
), prefixes AS (
  SELECT c, p AS depth, text, string_agg(sha256(length(role) || ':' || role || text), ',') OVER (PARTITION BY c ORDER BY p) AS path
  FROM rebuilt
  UNION ALL
  SELECT c, 0, '', '' FROM skips
), ends AS (
  SELECT max_by(path, depth) AS path, c FROM prefixes GROUP BY c
), ended AS (
  SELECT path, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c)) AS ends_sha256 FROM ends GROUP BY path
), nodes AS (
  SELECT path, any_value(depth) AS depth, any_value(text) AS text, min(c) AS conv_id, count(*) AS n_convs FROM prefixes GROUP BY path
), upper AS (
  SELECT n.path, any_value(u.path) AS above
  FROM nodes n JOIN prefixes u ON u.c = n.conv_id AND u.depth = n.depth - 1 GROUP BY n.path
), children AS (
  SELECT above AS path, count(*) AS n_children FROM upper GROUP BY above
), below AS (
  SELECT u.path, count(*) FILTER (WHERE k.n_children IS NULL) AS n_leaves,
         sum((n.n_convs - 1) * len(regexp_extract_all(n.text, '[^\x20\x09-\x0D]+'))) AS saved_tokens
  FROM nodes n LEFT JOIN children k USING (path) JOIN prefixes u ON u.c = n.conv_id AND u.depth <= n.depth
  GROUP BY u.path
)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, a.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children,
       b.n_leaves, CAST(b.saved_tokens AS BIGINT) AS saved_tokens, coalesce(e.ends_sha256, sha256('')) AS ends_sha256
FROM nodes n
LEFT JOIN upper u ON u.path = n.path LEFT JOIN nodes a ON a.path = u.above
LEFT JOIN children k ON k.path = n.path JOIN below b ON b.path = n.path LEFT JOIN ended e ON e.path = n.path
"""

_NOTICES = ", ".join(f"('{label}', '{text}', {edits_of(text)}, {text in dict(BASE).values()})" for label, text in BASE + NOTICES)
_PIECES = ", ".join(f"('{text}', '{piece}')" for _, text in BASE + NOTICES for _, piece in pieces(text, edits_of(text)))

# Runs of words are compared with a notice only in texts that hold a piece of it: the others cannot be near enough.
LICENSES = rf"""
WITH notices(label, notice, edits, is_base) AS (VALUES {_NOTICES}), pieces(notice, piece) AS (VALUES {_PIECES}),
texts AS (
  SELECT doc_id, row_number() OVER () AS id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
), joined AS (
  SELECT id, words, array_to_string(words, ' ') AS joined FROM texts
), asked AS (
  SELECT DISTINCT j.id, p.notice FROM joined j JOIN pieces p ON contains(j.joined, p.piece)
), places AS (
  SELECT id, i, w, sum(length(w) + 1) OVER (PARTITION BY id ORDER BY i) - 1 AS stop
  FROM (SELECT id, unnest(range(1, len(words) + 1)) AS i, unnest(words) AS w FROM joined WHERE id IN (SELECT id FROM asked))
), starts AS (
  SELECT p.*, n.*, unnest(range(0, len(string_split(n.notice, ' ')) + n.edits + 1)) AS more
  FROM asked a JOIN notices n USING (notice) JOIN places p USING (id)
), runs AS (
  SELECT f.id, label, is_base, notice, f.i AS first, edits AS most,
         levenshtein(substr(joined, CAST(f.stop - length(f.w) + 1 AS BIGINT), CAST(l.stop - f.stop + length(f.w) AS BIGINT)), notice) AS edits
  FROM starts f JOIN places l ON l.id = f.id AND l.i = f.i + f.more AND abs(l.stop - f.stop + length(f.w) - length(notice)) <= edits
  JOIN joined j ON j.id = f.id
), found AS (
  SELECT id, min(first - 1) FILTER (WHERE is_base AND edits = 0) AS first_word, max(first - 1) FILTER (WHERE is_base AND edits = 0) AS last_word,
         count(*) FILTER (WHERE is_base AND edits = 0) AS n_base,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE is_base AND edits = 0) AS base_labels,
         string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(1 - edits / length(notice)) AS score
  FROM runs WHERE edits <= most GROUP BY id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
FROM texts LEFT JOIN found USING (id)
"""

ORACLES = {
    "op12_license_scan": LICENSES,
    "op11_prefix_trie": PREFIX_TRIE,
    "op7_chat_perspectives": CHAT,
    "op5_personal_data": PERSONAL_DATA,
    "op4_source_mixing": MIXING,
    "op6_exact_dedup": EXACT_DEDUP,
}
