"""DuckDB SQL of the queries, written independently of the column functions."""

from __future__ import annotations

from veilspan.functions.boundary import LEADING, TRAILING
from veilspan.operators.docs import PROMPT_RULES, REQUIRED_FIELDS
from veilspan.operators.layout import HINTS, QUANTILES, SENTINEL
from veilspan.sources import relations as R

_SPANS = "ents AS (SELECT " + ", ".join(f"{x} AS {n}" for n, x in R.SPAN_COLUMNS.items()) + " FROM lineitem)"

_FOLD = (
    "WITH RECURSIVE "
    + _SPANS
    + """,
o AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY s, score DESC, e - s DESC, entity_type) AS k, count(*) OVER (PARTITION BY doc_id) AS n
  FROM ents WHERE score >= 0.3),
r AS (
  SELECT doc_id, k, n, s AS cs, e AS ce, score AS cp, entity_type AS ct, 'first' AS ev, NULL::INT AS ls, NULL::INT AS le, NULL::VARCHAR AS lt, NULL::DOUBLE AS lp FROM o WHERE k = 1
  UNION ALL
  SELECT doc_id, k, n,
    CASE WHEN met AND NOT wins THEN cs ELSE s END, CASE WHEN met AND NOT wins THEN ce ELSE e END,
    CASE WHEN met AND NOT wins THEN cp ELSE score END, CASE WHEN met AND NOT wins THEN ct ELSE entity_type END,
    CASE WHEN met THEN 'drop' ELSE 'next' END,
    CASE WHEN met AND NOT wins THEN s ELSE cs END, CASE WHEN met AND NOT wins THEN e ELSE ce END,
    CASE WHEN met AND NOT wins THEN entity_type ELSE ct END, CASE WHEN met AND NOT wins THEN score ELSE cp END
  FROM (SELECT o.*, r.cs, r.ce, r.cp, r.ct, NOT (r.ce <= o.s OR r.cs >= o.e) AS met,
      (o.score > r.cp OR (o.score = r.cp AND (o.e - o.s > r.ce - r.cs OR (o.e - o.s = r.ce - r.cs AND (o.s < r.cs OR (o.s = r.cs AND o.entity_type < r.ct)))))) AS wins
    FROM r JOIN o ON o.doc_id = r.doc_id AND o.k = r.k + 1)
)
"""
)

_DECREE_COLS = ", ".join(f"{x} AS {n}" for n, x in R.DECREE_COLUMNS)
_DECREE = (
    f"dec AS (SELECT o_orderkey, o_custkey, {_DECREE_COLS} FROM orders),\n"
    + "ents AS ("
    + " UNION ALL ".join(f"SELECT o_orderkey AS doc_id, body AS text, {t} AS entity_type, CAST({s} AS INT) AS s, CAST({s} + {n} AS INT) AS e, CAST({p} AS DOUBLE) AS score FROM dec WHERE {c}" for t, s, n, p, c in R.DECREE_SPANS)
    + ")"
)
_LEAD = "|".join(LEADING["DATE_TIME"])
_TRAIL = "|".join(TRAILING["DATE_TIME"])
# the record's spans don't overlap each other, so that the floor alone leaves the survivors
_NORM = (
    _DECREE
    + rf""",
t0 AS (SELECT *, substring(text, s + 1, e - s) AS v0 FROM ents WHERE score >= 0.3),
t1 AS (SELECT *, regexp_replace(regexp_replace(v0, '^\s+', ''), '\s+$', '') AS v1, length(v0) - length(regexp_replace(v0, '^\s+', '')) AS cut FROM t0),
t2 AS (SELECT *, CASE WHEN entity_type = 'DATE_TIME' THEN regexp_replace(v1, '(?i)^((?:{_LEAD})(?:\s+|$))+', '') ELSE v1 END AS v2 FROM t1),
t3 AS (SELECT *, CASE WHEN entity_type = 'DATE_TIME' THEN regexp_replace(v2, '(?i)((?:^|\s+)(?:{_TRAIL}))+$', '') ELSE v2 END AS v3 FROM t2),
norm AS (SELECT *,
   CASE WHEN v1 = '' THEN s WHEN v3 = '' THEN s + cut ELSE s + cut + length(v1) - length(v2) END AS ns,
   CASE WHEN v1 = '' THEN e WHEN v3 = '' THEN s + cut + length(v1) ELSE s + cut + length(v1) - length(v2) + length(v3) END AS ne FROM t3),
val AS (SELECT *, substring(text, ns + 1, ne - ns) AS cutout, replace(substring(text, ns + 1, ne - ns), chr(10), ' ') AS value FROM norm),
num0 AS (SELECT *, min(ns) OVER (PARTITION BY doc_id, entity_type, value) AS first_start FROM val),
num AS (SELECT *, dense_rank() OVER (PARTITION BY doc_id, entity_type ORDER BY first_start) AS number FROM num0),
subs AS (SELECT *, '[' || entity_type || '_' || number || ']' AS placeholder, '[' || entity_type || '_' || number || ']' || repeat(chr(10), length(cutout) - length(replace(cutout, chr(10), ''))) AS replacement FROM num)
"""
)

#: (type, pattern, score) of the default recognizers, as DuckDB reads them.
_KINDS = (
    ("EMAIL_ADDRESS", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", 1.0),
    ("IP_ADDRESS", r"\b[0-9]{1,3}(?:\.[0-9]{1,3}){3}\b", 0.6),
    ("CREDIT_CARD", r"\b[0-9]{16}\b", 0.5),
    ("PHONE_NUMBER", r"\+1 \([0-9]{3}\) [0-9]{3}-[0-9]{4}", 0.75),
)


def found(src: str, name: str = "hits", key: str = "doc_id", kinds: tuple = _KINDS) -> str:
    """CTE of all matches in src (key, text): key, entity_type, s, e, score, match. Offsets by what is before each match, cut off piece by piece."""
    parts = []
    for t, p, score in kinds:
        parts.append(
            f"SELECT {key}, text, '{t}' AS entity_type, CAST({score} AS DOUBLE) AS score, unnest(regexp_extract_all(text, '{p}')) AS match, unnest(generate_series(1, len(regexp_extract_all(text, '{p}')))) AS nth, string_split_regex(text, '{p}') AS gaps, regexp_extract_all(text, '{p}') AS all_ FROM {src}"
        )
    raw = " UNION ALL ".join(parts)
    return f"{name} AS (SELECT {key}, entity_type, score, match, CAST(coalesce(list_sum(list_transform(gaps[1:nth], lambda g: length(g))), 0) + coalesce(list_sum(list_transform(all_[1:nth - 1], lambda g: length(g))), 0) AS INT) AS s, CAST(coalesce(list_sum(list_transform(gaps[1:nth], lambda g: length(g))), 0) + coalesce(list_sum(list_transform(all_[1:nth], lambda g: length(g))), 0) AS INT) AS e FROM ({raw}))"


_DOC_TEXT = "src AS (SELECT doc_id, coalesce(text, '') AS text FROM documents)"
# greedy by start is what the fold does here: default kinds meet in few ways, so the fold itself is run
_DOC_FOLD = f"""WITH RECURSIVE {_DOC_TEXT}, {found('src')},
o AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY s, score DESC, e - s DESC, entity_type) AS k, count(*) OVER (PARTITION BY doc_id) AS n FROM hits WHERE score >= 0.3),
r AS (SELECT doc_id, k, n, s AS cs, e AS ce, score AS cp, entity_type AS ct, NULL::INT AS ps, NULL::INT AS pe, NULL::VARCHAR AS pt FROM o WHERE k = 1
  UNION ALL
  SELECT doc_id, k, n, CASE WHEN met AND NOT wins THEN cs ELSE s END, CASE WHEN met AND NOT wins THEN ce ELSE e END, CASE WHEN met AND NOT wins THEN cp ELSE score END, CASE WHEN met AND NOT wins THEN ct ELSE entity_type END,
    CASE WHEN NOT met THEN cs END, CASE WHEN NOT met THEN ce END, CASE WHEN NOT met THEN ct END
  FROM (SELECT o.*, r.cs, r.ce, r.cp, r.ct, NOT (r.ce <= o.s OR r.cs >= o.e) AS met, (o.score > r.cp OR (o.score = r.cp AND (o.e - o.s > r.ce - r.cs OR (o.e - o.s = r.ce - r.cs AND o.s < r.cs)))) AS wins FROM r JOIN o ON o.doc_id = r.doc_id AND o.k = r.k + 1)),
alive AS (SELECT doc_id, ps AS s, pe AS e, pt AS entity_type FROM r WHERE ps IS NOT NULL UNION ALL SELECT doc_id, cs, ce, ct FROM r WHERE k = n),
val AS (SELECT a.*, src.text, substring(src.text, s + 1, e - s) AS value FROM alive a JOIN src USING (doc_id)),
num AS (SELECT *, dense_rank() OVER (PARTITION BY doc_id, entity_type ORDER BY f) AS number FROM (SELECT *, min(s) OVER (PARTITION BY doc_id, entity_type, value) AS f FROM val)),
subs AS (SELECT *, '[' || entity_type || '_' || number || ']' AS placeholder, lag(e, 1, 0) OVER (PARTITION BY doc_id ORDER BY s) AS upto FROM num),
done AS (SELECT doc_id, string_agg(substring(text, upto + 1, s - upto) || placeholder, '' ORDER BY s) || substring(any_value(text), max(e) + 1) AS new_text, count(*) AS n_subs FROM subs GROUP BY doc_id),
anon AS (SELECT src.doc_id, src.text, coalesce(new_text, src.text) AS new_text, coalesce(n_subs, 0) AS n_subs FROM src LEFT JOIN done USING (doc_id))
"""

_EDIT_ROWS = " UNION ALL ".join(f"SELECT doc_id, {i} AS id, {v} AS version, {act} AS action, CAST({s} AS INT) AS es, CAST({e} AS INT) AS ee, CAST({t} AS VARCHAR) AS et FROM prop WHERE {cond}" for cond, i, v, act, s, e, t in R.EDITS)
_REVIEW = (
    _NORM
    + f""",
prop AS (SELECT doc_id, text, sha256(doc_id || '|0|' || s || '|' || e || '|' || entity_type)[1:16] AS proposal_id, entity_type, ns AS a, ne AS b, value FROM val),
log AS ({_EDIT_ROWS}),
last_ AS (SELECT *, row_number() OVER (PARTITION BY doc_id, id ORDER BY version DESC) AS k, count(*) OVER (PARTITION BY doc_id, id) AS n_edits FROM log),
met AS (SELECT coalesce(prop.doc_id, l.doc_id) AS doc_id, coalesce(proposal_id, id) AS proposal_id, prop.entity_type, a, b, value, action, version, es, ee, et, coalesce(n_edits, 0) AS n_edits, dec.body AS whole
  FROM prop FULL JOIN (SELECT * FROM last_ WHERE k = 1) l ON l.doc_id = prop.doc_id AND l.id = prop.proposal_id JOIN dec ON dec.o_orderkey = coalesce(prop.doc_id, l.doc_id)),
told AS (SELECT *, CASE WHEN action IS NULL THEN 'proposed' WHEN a IS NULL AND action <> 'add' THEN 'stale' WHEN action IN ('move', 'add') AND NOT (es >= 0 AND es < ee AND ee <= length(whole)) THEN 'invalid'
  WHEN action = 'accept' THEN 'accepted' WHEN action = 'reject' THEN 'rejected' WHEN action = 'move' THEN 'moved' WHEN action = 'retype' THEN 'retyped' ELSE 'added' END AS status FROM met),
res AS (SELECT doc_id, proposal_id, status, version, n_edits, CASE WHEN status IN ('rejected', 'stale') THEN NULL WHEN status IN ('retyped', 'added') THEN et ELSE entity_type END AS entity_type,
  CASE WHEN status IN ('rejected', 'stale') THEN NULL WHEN status IN ('moved', 'added') THEN es ELSE a END AS ns, CASE WHEN status IN ('rejected', 'stale') THEN NULL WHEN status IN ('moved', 'added') THEN ee ELSE b END AS ne,
  CASE WHEN status IN ('rejected', 'stale') THEN NULL WHEN status IN ('moved', 'added') THEN replace(substring(whole, es + 1, ee - es), chr(10), ' ') ELSE value END AS value FROM told),
res0 AS (SELECT *, min(ns) OVER (PARTITION BY doc_id, entity_type, value) AS first_start FROM res WHERE ns IS NOT NULL),
res1 AS (SELECT *, '[' || entity_type || '_' || dense_rank() OVER (PARTITION BY doc_id, entity_type ORDER BY first_start) || ']' AS placeholder FROM res0)"""
)

_LINES = f"""
lines AS (SELECT doc_id, CAST(i // {R.LINES_ON_PAGE} AS INT) AS page_index, CAST(i % {R.LINES_ON_PAGE} AS INT) AS line_no, line AS text,
   (i % {R.LINES_ON_PAGE}) // 4 || ':' || (i % 4) // 2 || ':' || i % {R.LINES_ON_PAGE} AS line_id
   FROM (SELECT doc_id, unnest(ls) AS line, unnest(generate_series(0, len(ls) - 1)) AS i FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)))"""
_RAW = (
    _LINES
    + """,
raw AS (SELECT doc_id, page_index, line_no, line_id, line_no * 100000 + k AS seq, w AS text, (doc_id * 7 + k * 13 + line_no * 3) % 101 - 1 AS conf,
   300 + 600 * least(k // 3, 2) + 60 * (k - 3 * least(k // 3, 2)) + (doc_id * 7 + line_no * 11) % 40 AS x, 300 + 40 * line_no AS y, least(12 * length(w), 50) AS w, 30 AS h
   FROM (SELECT *, unnest(ws) AS w, unnest(generate_series(0, len(ws) - 1)) AS k FROM (SELECT *, string_split(text, ' ') AS ws FROM lines))),
words AS (SELECT * FROM raw WHERE trim(text, chr(32) || chr(9) || chr(10) || chr(13)) <> '' AND conf >= 0)"""
)
_CHARS = (
    _RAW
    + """,
seen AS (SELECT *, min(seq) OVER (PARTITION BY doc_id, page_index, line_id) AS line_seq FROM words),
chars AS (SELECT *, CAST(sum(length(text) + 1) OVER (PARTITION BY doc_id, page_index ORDER BY line_seq, seq ROWS UNBOUNDED PRECEDING) - 1 AS INT) AS e FROM seen),
spans AS (SELECT *, e - length(text) AS s FROM chars),
linerows AS (SELECT doc_id, page_index, line_id, min(line_seq) AS line_seq, string_agg(text, ' ' ORDER BY seq) AS text, min(x) AS x, min(y) AS y, max(x + w) - min(x) AS w, max(y + h) - min(y) AS h FROM spans GROUP BY ALL),
pagetext AS (SELECT doc_id, page_index, string_agg(text, chr(10) ORDER BY line_seq) AS text FROM linerows GROUP BY ALL)"""
)
_GAPS = _RAW + ",\ngapped AS (SELECT *, x - lag(x + w) OVER (PARTITION BY doc_id, page_index, line_no ORDER BY x, seq) AS gap FROM words)"


_QUANTILES = "len(g) AS n, g[1] AS least, g[-1] AS most, " + ", ".join(f"g[CAST(floor(len(g) * {q} / 100.0) AS INT) + 1] AS p{q}" for q in QUANTILES)
_LEDGER = f"""
ranked AS (SELECT l_orderkey, l_partkey, l_suppkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) - 1 AS k FROM lineitem),
ledrows AS (SELECT l_orderkey, CAST(k // 2 AS INT) AS page, string_agg('| part ' || l_partkey || ' | ' || l_suppkey || ' |', chr(10) ORDER BY k) AS rows FROM ranked GROUP BY ALL),
led AS (SELECT l_orderkey AS doc_id, page AS page_index, {R.LEDGER_TEXT} AS text FROM ledrows),
ledlines AS (SELECT doc_id, page_index, unnest(ls) AS line, unnest(generate_series(0, len(ls) - 1)) AS line_no FROM (SELECT *, string_split(text, chr(10)) AS ls FROM led)),
ledcells AS (SELECT doc_id, page_index, line_no, CASE WHEN line[1] = '|' THEN string_split(line, '|')[2:-2] ELSE [line] END AS cs FROM ledlines WHERE line <> '' AND line NOT LIKE '|--%' AND line NOT LIKE 'Page %'),
ledwords AS (SELECT doc_id, page_index, line_no, unnest(generate_series(0, len(cs) - 1)) AS k FROM ledcells),
gapped AS (SELECT doc_id, page_index, line_no, 300 + 600 * k AS x, CASE WHEN k > 0 THEN 500 END AS gap FROM ledwords)"""


_LINE_KEY = "doc_id, page_index, line_no"
_NO_FOOTER = rf"""NOT ((CASE WHEN doc_id % 5 = 0 THEN 0 ELSE {R.HEIGHT} END <> 0 AND line_y > 0.92::DOUBLE * CASE WHEN doc_id % 5 = 0 THEN 0 ELSE {R.HEIGHT} END) OR regexp_matches(line_text, '(?i)(Page\s+\d+\s*[—-]|Sayfa\s+\d+\s*[—-]|FABRICATED DOCUMENT|YAZILIM TEST)'))"""
_CONTENT = _GAPS.replace("gapped AS", "all_gapped AS") + f""",
whole AS (SELECT {_LINE_KEY}, min(y) AS line_y, string_agg(text, ' ' ORDER BY seq) AS line_text FROM words GROUP BY ALL),
gapped AS (SELECT all_gapped.* FROM all_gapped JOIN whole USING ({_LINE_KEY}) WHERE {_NO_FOOTER})"""


def _runs(threshold: str, extra: str = "") -> str:
    """CTEs from gapped words to verdicts, for a threshold or a column of thresholds."""
    key = f"doc_id, page_index{extra}"
    return f""",
bands AS (SELECT {key}, line_no, list(x ORDER BY x) FILTER (gap IS NULL OR gap > {threshold}) AS bands FROM gapped GROUP BY {key}, line_no),
marked AS (SELECT *, first_value(bands) OVER (PARTITION BY {key} ORDER BY line_no) AS hr, first_value(bands) OVER (PARTITION BY {key} ORDER BY line_no DESC) AS tr FROM bands),
oks AS (SELECT *, len(bands) >= 2 AND len(bands) = len(hr) AND NOT list_contains(list_transform(generate_series(1, least(len(bands), len(hr))), lambda i: abs(bands[i] - hr[i]) <= 25), false) AS hk,
   len(bands) >= 2 AND len(bands) = len(tr) AND NOT list_contains(list_transform(generate_series(1, least(len(bands), len(tr))), lambda i: abs(bands[i] - tr[i]) <= 25), false) AS tk FROM marked),
cum AS (SELECT *, min(hk::INT) OVER (PARTITION BY {key} ORDER BY line_no ROWS UNBOUNDED PRECEDING) AS ha, min(tk::INT) OVER (PARTITION BY {key} ORDER BY line_no DESC ROWS UNBOUNDED PRECEDING) AS ta FROM oks),
runs AS (SELECT {key}, CAST(sum(ha) AS INT) AS head_lines, any_value(hr) AS head_bands, CAST(sum(ta) AS INT) AS tail_lines, any_value(tr) AS tail_bands FROM cum GROUP BY {key}),
pairs AS (SELECT *, lead(page_index) OVER w AS next_page, lead(head_lines) OVER w AS next_lines, lead(head_bands) OVER w AS next_bands FROM runs WINDOW w AS (PARTITION BY doc_id{extra} ORDER BY page_index)),
verdict AS (SELECT *, tail_lines >= 2 AND next_lines >= 2 AND len(tail_bands) >= 2 AND len(next_bands) >= 2 AND len(tail_bands) = len(next_bands)
   AND NOT list_contains(list_transform(generate_series(1, least(len(tail_bands), len(next_bands))), lambda i: abs(tail_bands[i] - next_bands[i]) <= 25), false) AS fires FROM pairs WHERE next_page IS NOT NULL)"""


_MD = f"""
ranked AS (SELECT l_orderkey, l_partkey, l_suppkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) - 1 AS k FROM lineitem),
mdrows AS (SELECT l_orderkey, CAST(k // 3 AS INT) AS page, string_agg('| part ' || l_partkey || ' | ' || l_suppkey || CASE WHEN l_orderkey % 5 = 0 AND k = 4 THEN ' | extra |' ELSE ' |' END, chr(10) ORDER BY k) AS rows FROM ranked GROUP BY ALL),
md AS (SELECT l_orderkey AS doc_id, page AS page_index, {R.MARKDOWN_TEXT} AS text FROM mdrows)"""
_SEP = r"^\s*\|?[\s:|-]*-[\s:|-]*\|?\s*$"
_FOOT = r"^\s*(Sayfa|Page)\s+\d+|^\s*(FABRICATED DOCUMENT|YAZILIM TEST)"
# blocks that begin and end with pipe rows don't follow each other in this relation, so that blank lines alone part them
_BLOCKS = (
    _MD
    + rf""",
blocks AS (SELECT doc_id, page_index, unnest(bs) AS block, CAST(unnest(generate_series(0, len(bs) - 1)) AS INT) AS block_idx FROM (SELECT *, string_split_regex(text, '\n\s*\n') AS bs FROM md)),
b1 AS (SELECT *, list_filter(string_split(block, chr(10)), lambda l: trim(l) <> '') AS ls FROM blocks),
b2 AS (SELECT *, NOT list_contains(list_transform(ls, lambda l: regexp_matches(l, '(?i){_FOOT}')), false) AS foot,
   NOT list_contains(list_transform(ls, lambda l: starts_with(l, '|') AND ends_with(l, '|') AND length(l) > 1), false) AND NOT list_contains(list_transform(ls, lambda l: regexp_matches(l, '{_SEP}')), true) AS cont,
   len(ls) >= 2 AND starts_with(ls[1], '|') AND coalesce(regexp_matches(ls[2], '{_SEP}'), false) AS tab,
   list_transform(ls, lambda l: len(string_split(l, '|')) - 2) AS widths FROM b1),
kinds AS (SELECT *, CASE WHEN starts_with(ls[1], '[TABLE — STRUCTURE UNCERTAIN, REVIEW]') THEN 'review' WHEN tab THEN 'table' WHEN len(ls) = 1 AND starts_with(ls[1], '## ') THEN 'h2' WHEN len(ls) = 1 AND starts_with(ls[1], '# ') THEN 'h1' WHEN regexp_matches(ls[1], '^Sayfa\s+\d+') THEN 'footer' ELSE 'paragraph' END AS kind FROM b2)"""
)
_SPLICE = (
    "WITH RECURSIVE "
    + _BLOCKS
    + """,
pg AS (SELECT doc_id, page_index, list({'foot': foot, 'cont': cont, 'tab': tab, 'widths': widths} ORDER BY block_idx) AS bs, row_number() OVER (PARTITION BY doc_id ORDER BY page_index) AS k FROM b2 GROUP BY doc_id, page_index),
st AS (
  SELECT doc_id, k, page_index, open_, 0 AS taken, 0 AS n_rows, NULL::INT AS target, CASE WHEN open_ IS NOT NULL THEN page_index END AS op FROM (SELECT *, CASE WHEN last_.tab THEN last_.widths[1] END AS open_ FROM (SELECT *, list_filter(bs, lambda b: NOT b.foot)[-1] AS last_ FROM pg WHERE k = 1))
  UNION ALL
  SELECT doc_id, k, page_index, CASE WHEN last_ IS NULL THEN open_ WHEN last_.tab THEN last_.widths[1] END, taken, n_rows, CASE WHEN n_rows > 0 THEN at_ END, CASE WHEN last_ IS NULL THEN at_ WHEN last_.tab THEN page_index END
  FROM (SELECT *, list_filter(bs[taken + 1:], lambda b: NOT b.foot)[-1] AS last_, CAST(coalesce(list_sum(list_transform(bs[1:taken], lambda b: len(b.widths))), 0) AS INT) AS n_rows
    FROM (SELECT pg.doc_id, pg.k, pg.page_index, pg.bs, st.open_, st.op AS at_,
        CAST(coalesce(list_position(list_transform(pg.bs, lambda b: b.cont AND st.open_ IS NOT NULL AND NOT list_contains(list_transform(b.widths, lambda w: w = st.open_), false)), false) - 1, len(pg.bs)) AS INT) AS taken
      FROM st JOIN pg ON pg.doc_id = st.doc_id AND pg.k = st.k + 1)))
"""
)


_REGIONS = """,
boxes AS (SELECT doc_id, page_index, unnest([{'x': 290, 'y': 295 + 40 * line_no, 'w': 100 + doc_id % 200, 'h': 40}, {'x': 2300, 'y': 300 + 40 * line_no, 'w': 100, 'h': 30}, {'x': 290, 'y': 295 + 40 * line_no, 'w': 19, 'h': 21}, {'x': 0, 'y': 0, 'w': 2550, 'h': 1485 + line_no}]) AS b FROM lines),
regions AS (SELECT doc_id, page_index, b.x, b.y, b.w, b.h FROM boxes WHERE b.w * b.h >= 400 AND b.w * b.h <= 0.45::DOUBLE * 2550 * 3300)"""
_INSIDE = "SELECT 1 FROM words v WHERE v.doc_id = r.doc_id AND v.page_index = r.page_index AND v.x + v.w / 2 BETWEEN r.x AND r.x + r.w AND v.y + v.h / 2 BETWEEN r.y AND r.y + r.h"


def with_(ctes: str, select: str) -> str:
    return f"WITH {ctes}\n{select}"


ORACLES: dict[str, str] = {
    "score_floor": f"WITH {_SPANS} SELECT doc_id, entity_type, s AS span_start, e AS span_end, score FROM ents WHERE score >= 0.3",
    "resolve_overlaps": _FOLD + "SELECT doc_id, lt AS entity_type, ls AS span_start, le AS span_end, lp AS score FROM r WHERE ev = 'next' UNION ALL SELECT doc_id, ct, cs, ce, cp FROM r WHERE k = n",
    "overlap_exposure_warnings": _FOLD
    + """SELECT doc_id, lt AS dropped_type, ls AS dropped_start, le AS dropped_end, ct AS winner_type, cs AS winner_start, ce AS winner_end,
  concat_ws(',', CASE WHEN ls < cs THEN ls || '-' || cs END, CASE WHEN le > ce THEN ce || '-' || le END) AS exposed
FROM r WHERE ev = 'drop' AND (ls < cs OR le > ce)""",
    "detect_regex_entities": f"WITH {_DOC_TEXT}, {found('src')} SELECT doc_id, entity_type, s AS span_start, e AS span_end, score, match AS span_text FROM hits",
    "phrase_entities": rf"""WITH {_DOC_TEXT}, toks AS (SELECT doc_id, list_transform(regexp_extract_all(text, '[\pL\pN]+'), lambda w: lower(w)) AS ws, list_transform(regexp_extract_all(text, '[\pL\pN]+'), lambda w: length(w)) AS ns, list_transform(string_split_regex(text, '[\pL\pN]+'), lambda g: length(g)) AS gs FROM src),
w AS (SELECT doc_id, unnest(ws) AS t, unnest(ns) AS n, unnest(gs[1:len(ws)]) AS g, unnest(generate_series(1, len(ws))) AS k FROM toks),
p AS (SELECT doc_id, t, k, CAST(sum(n + g) OVER o - n AS INT) AS s, CAST(sum(n + g) OVER o AS INT) AS e, lead(t) OVER o AS t2, lead(t, 2) OVER o AS t3, n, lead(n) OVER o + lead(g) OVER o AS n2, lead(n, 2) OVER o + lead(g, 2) OVER o AS n3 FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY k)),
grams AS (SELECT doc_id, 1 AS size, t AS gram, s, e FROM p UNION ALL SELECT doc_id, 2, t || ' ' || t2, s, e + n2 FROM p WHERE t2 IS NOT NULL UNION ALL SELECT doc_id, 3, t || ' ' || t2 || ' ' || t3, s, e + n2 + n3 FROM p WHERE t3 IS NOT NULL),
ph AS (SELECT DISTINCT 'FIRST_' || m AS entity_type, array_to_string(ws[1:m], ' ') AS gram, least(m, len(ws)) AS size FROM toks, (SELECT unnest([2, 3]) AS m) WHERE len(ws) > 0)
SELECT doc_id, entity_type, count(*) AS n, min(s) AS first_start, CAST(max(e) AS INT) AS last_end FROM grams JOIN ph USING (gram, size) GROUP BY ALL""",
    "case_number_context": "WITH "
    + f"dec AS (SELECT o_orderkey, o_custkey, {_DECREE_COLS} FROM orders), src AS (SELECT o_orderkey AS doc_id, body AS text FROM dec), "
    + found("src", kinds=(("ALPHA", r"\b\d{2,4}[-/][A-Z]{2,4}[-/]\d{3,6}\b", 0.85), ("NUMERIC", r"\b\d{2,4}[-/]\d{2,4}[-/]\d{3,6}\b", 0.4)))
    + r" SELECT doc_id, 'CASE_NUMBER' AS entity_type, s AS span_start, e AS span_end, CASE WHEN hits.entity_type = 'NUMERIC' AND regexp_matches(lower(substring(src.text, greatest(s - 40, 0) + 1, s - greatest(s - 40, 0))), '\b(case number|case no|docket|file no|dosya no|esas no|karar|dosya|case|esas)\b') THEN 0.9 ELSE score END AS score FROM hits JOIN src USING (doc_id)",
    "normalize_boundaries": with_(_NORM, "SELECT doc_id, entity_type, s AS span_start, e AS span_end, ns AS new_start, ne AS new_end, value FROM val"),
    "boundary_actions": with_(
        _NORM,
        r"""SELECT doc_id, entity_type, s AS span_start, concat_ws(';',
  CASE WHEN s > 0 AND regexp_matches(substring(text, s, 2), '^[\pL\pN][\pL\pN]$') THEN 'mid_word_start' END,
  CASE WHEN e > 0 AND regexp_matches(substring(text, e, 2), '^[\pL\pN][\pL\pN]$') THEN 'mid_word_end' END,
  CASE WHEN v1 = '' THEN 'abort_empty_span:span is whitespace-only' END,
  CASE WHEN v1 <> '' AND v1 <> v0 THEN 'whitespace_trim' END,
  CASE WHEN v1 <> '' AND v3 = '' THEN 'abort_empty_span:every token blacklisted' END,
  CASE WHEN v3 <> '' AND v2 <> v1 THEN array_to_string(list_transform(string_split_regex(trim(substring(v1, 1, length(v1) - length(v2))), '\s+'), lambda w: 'leading_trim:' || w), ';') END,
  CASE WHEN v3 <> '' AND v3 <> v2 THEN array_to_string(list_transform(list_reverse(string_split_regex(trim(substring(v2, length(v3) + 1)), '\s+')), lambda w: 'trailing_trim:' || w), ';') END,
  CASE WHEN contains(cutout, chr(10)) THEN 'newline_reemit:' || (length(cutout) - length(replace(cutout, chr(10), ''))) END) AS actions FROM val""",
    ),
    "placeholder_numbering": with_(_NORM, "SELECT doc_id, entity_type, ns AS span_start, value, placeholder, first_start FROM subs"),
    "reviewed_proposals": with_(_REVIEW, "SELECT res.doc_id, res.proposal_id, res.status, res.entity_type, res.ns AS span_start, res.ne AS span_end, res.value, res1.placeholder, res.version, res.n_edits FROM res LEFT JOIN res1 USING (doc_id, proposal_id)"),
    "newline_preservation": with_(
        _NORM + ", gaps AS (SELECT *, lag(ne, 1, 0) OVER (PARTITION BY doc_id ORDER BY ns) AS upto FROM subs), done AS (SELECT doc_id, any_value(text) AS text, string_agg(substring(text, upto + 1, ns - upto) || replacement, '' ORDER BY ns) || substring(any_value(text), max(ne) + 1) AS new_text FROM gaps GROUP BY doc_id)",
        "SELECT doc_id, new_text, len(string_split(text, chr(10))) = len(string_split(new_text, chr(10))) AS same_lines FROM done",
    ),
    "apply_substitution": _DOC_FOLD + "SELECT doc_id, new_text AS anonymized_text, n_subs FROM anon",
    "restore_roundtrip": _DOC_FOLD + "SELECT doc_id, n_subs AS restored_count, TRUE AS same FROM anon",
    "residual_pii": _DOC_FOLD + f", again AS (SELECT doc_id, new_text AS text FROM anon), {found('again', 'left_')} SELECT doc_id, entity_type, s AS span_start, match AS span_text FROM left_",
    "missing_placeholders": with_(
        _NORM,
        "SELECT doc_id, count(DISTINCT CASE WHEN doc_id % 3 = number % 3 THEN placeholder END) AS n_missing, coalesce(string_agg(DISTINCT CASE WHEN doc_id % 3 = number % 3 THEN placeholder END, ',' ORDER BY CASE WHEN doc_id % 3 = number % 3 THEN placeholder END), '') AS missing FROM subs GROUP BY doc_id",
    ),
    "unresolved_tokens": with_(
        _NORM,
        "SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN '[PERSON_77],[STRAY_1]' ELSE '[STRAY_1]' END AS unresolved FROM (SELECT DISTINCT doc_id FROM subs)",
    ),
    "word_char_spans": with_(_CHARS, "SELECT doc_id, page_index, seq, s AS span_start, e AS span_end, text FROM spans"),
    "char_span_violations": with_(_CHARS, "SELECT spans.doc_id, spans.page_index, seq FROM spans JOIN pagetext USING (doc_id, page_index) WHERE substring(pagetext.text, s + 1, e - s) <> spans.text"),
    "char_span_mutations": with_(_CHARS, "SELECT spans.doc_id, spans.page_index, seq FROM spans JOIN pagetext USING (doc_id, page_index) WHERE substring(pagetext.text, s + 2, e - s) <> spans.text"),
    "line_union_box": with_(_CHARS, "SELECT doc_id, page_index, line_id, text, x, y, w, h FROM linerows"),
    "conf_summary": with_(_RAW, "SELECT doc_id, page_index, count(*) AS n_words, avg(conf) AS mean_conf, min(conf) AS min_conf, max(conf) AS max_conf, count(*) FILTER (conf < 60) AS n_low, coalesce(string_agg(text, ' ' ORDER BY seq) FILTER (conf < 60), '') AS low_words FROM words GROUP BY ALL"),
    "redaction_boxes": with_(
        _CHARS + ",\n" + found("pagetext", key="doc_id, page_index"),
        "SELECT spans.doc_id, spans.page_index, seq, any_value(text) AS text, greatest(0, any_value(x) - 3) AS box_left, greatest(0, any_value(y) - 3) AS box_top, least(2550, any_value(x + w) + 3) AS box_right, least(3300, any_value(y + h) + 3) AS box_bottom, string_agg(DISTINCT entity_type, ',' ORDER BY entity_type) AS entity_types FROM spans JOIN hits ON hits.doc_id = spans.doc_id AND hits.page_index = spans.page_index AND NOT (spans.e <= hits.s OR spans.s >= hits.e) WHERE hits.score >= 0.3 GROUP BY spans.doc_id, spans.page_index, seq",
    ),
    "line_bands": with_(_GAPS, "SELECT doc_id, page_index, line_no, array_to_string(list(x ORDER BY x) FILTER (gap IS NULL OR gap > 150), ',') AS bands FROM gapped GROUP BY ALL"),
    "gap_quantiles": with_(_GAPS, f"SELECT doc_id, {_QUANTILES} FROM (SELECT doc_id, list(gap ORDER BY gap) AS g FROM gapped WHERE gap IS NOT NULL GROUP BY doc_id)"),
    "corpus_gap_quantiles": with_(_GAPS, f"SELECT {_QUANTILES} FROM (SELECT list(gap ORDER BY gap) AS g FROM gapped WHERE gap IS NOT NULL)"),
    "largest_gaps": with_(
        _GAPS + ", said AS (SELECT doc_id, page_index, line_no, string_agg(text, ' ' ORDER BY seq) AS line_text FROM words GROUP BY ALL)",
        "SELECT gap, doc_id, page_index, line_text AS text FROM gapped JOIN said USING (doc_id, page_index, line_no) WHERE gap IS NOT NULL ORDER BY gap DESC, doc_id DESC, page_index DESC, text DESC LIMIT 15",
    ),
    "verdict_hints": with_(
        _LEDGER + _runs("150") + """,
pages AS (SELECT led.doc_id, led.page_index, coalesce(fires, false) AS goes_on, CASE WHEN doc_id % 4 = 1 AND led.page_index = 1 THEN NULL WHEN led.page_index = 0 THEN 'Item ' || doc_id || '/Supplier' WHEN doc_id % 7 = 3 AND led.page_index = 1 THEN 'Piece ' || doc_id || '/Maker' END AS header
  FROM led LEFT JOIN (SELECT doc_id, next_page AS page_index, fires FROM verdict) v USING (doc_id, page_index)),
tabs AS (SELECT *, count(*) FILTER (NOT goes_on) OVER (PARTITION BY doc_id ORDER BY page_index) AS tab FROM pages),
kept AS (SELECT *, last_value(header IGNORE NULLS) OVER (PARTITION BY doc_id, tab ORDER BY page_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS carried FROM tabs)""",
        f"""SELECT doc_id, page_index, carried AS header, '{SENTINEL}' || chr(10) || 'The table of the page before goes on here. Columns: "' || replace(carried, '/', '" | "') || '". {HINTS['full']}' || chr(10) || '{SENTINEL}' || chr(10) || chr(10) AS hint FROM kept WHERE goes_on AND carried IS NOT NULL""",
    ),
    "continuation_verdict": with_(_CONTENT + _runs("150"), "SELECT doc_id, page_index, next_page AS next_page_index, tail_lines, next_lines AS next_head_lines, coalesce(fires, false) AS fires FROM verdict"),
    "threshold_sweep": with_(
        _CONTENT.replace("\ngapped AS", "\ngapped0 AS") + ", gapped AS (SELECT gapped0.*, t AS threshold FROM gapped0, (SELECT unnest(generate_series(60, 420, 20)) AS t))" + _runs("threshold", ", threshold"),
        "SELECT threshold, count(*) AS boundaries, count(*) FILTER (coalesce(fires, false)) AS firing FROM verdict GROUP BY threshold",
    ),
    "sweep_pivot": with_(
        _LEDGER.replace("\ngapped AS (SELECT doc_id, page_index, line_no, 300 + 600 * k AS x, CASE WHEN k > 0 THEN 500 END AS gap FROM ledwords)", "\ngapped AS (SELECT doc_id, page_index, line_no, 300 + (160 + doc_id % 40 * 10) * k AS x, CASE WHEN k > 0 THEN 60 + doc_id % 40 * 10 END AS gap, threshold FROM ledwords, (SELECT unnest(generate_series(60, 420, 20)) AS threshold))")
        + _runs("threshold", ", threshold")
        + """,
cells AS (SELECT doc_id, threshold, coalesce(string_agg(CASE WHEN fires THEN page_index || '->' || next_page END, ',' ORDER BY page_index), '') AS fires, count(*) AS n_boundaries FROM verdict GROUP BY ALL),
moves AS (SELECT *, coalesce(fires <> lag(fires) OVER (PARTITION BY doc_id ORDER BY threshold), true)::INT AS changed FROM cells),
sames AS (SELECT *, sum(changed) OVER (PARTITION BY doc_id ORDER BY threshold) AS same FROM moves)""",
        "SELECT doc_id, threshold, fires, n_boundaries, row_number() OVER (PARTITION BY doc_id, same ORDER BY threshold) AS steady FROM sames",
    ),
    "md_block_kinds": with_(_BLOCKS, "SELECT doc_id, page_index, block_idx, kind FROM kinds"),
    "table_splice": _SPLICE + "SELECT doc_id, page_index, taken AS popped_blocks, n_rows AS spliced_rows, coalesce(target, -1) AS target_page FROM st",
    "ragged_tables": with_(_BLOCKS, "SELECT doc_id, page_index, block_idx, list_contains(list_transform(widths[3:], lambda w: w <> widths[1]), true) AS ragged FROM kinds WHERE kind = 'table'"),
    "column_widths": with_(
        _BLOCKS,
        "SELECT doc_id, page_index, block_idx, array_to_string(list_transform(m, lambda x: greatest(CAST(floor(9360.0::DOUBLE * x / greatest(list_sum(m), 1)) AS INT), 720)), ',') AS widths FROM (SELECT *, list_transform(generate_series(2, widths[1] + 1), lambda i: coalesce(list_max(list_transform(list_filter(ls[1:1] || ls[3:], lambda l: len(string_split(l, '|')) - 1 > i - 1), lambda l: length(trim(string_split(l, '|')[i])))), 0)) AS m FROM kinds WHERE kind = 'table')",
    ),
    "caption_zone": with_(
        _BLOCKS,
        "SELECT doc_id, page_index, block_idx FROM (SELECT *, min(page_index) OVER (PARTITION BY doc_id) AS first_page, min(CASE WHEN starts_with(ls[1], '## ') THEN block_idx END) OVER (PARTITION BY doc_id, page_index) AS h2 FROM kinds) WHERE page_index = first_page AND block_idx < h2",
    ),
    "doc_aggregate_flags": with_(
        _BLOCKS,
        "SELECT doc_id, count(*) AS page_count, bool_or(bad) AS has_integrity_flags, coalesce(string_agg(page_index, ',' ORDER BY page_index) FILTER (bad), '') AS flagged_pages FROM (SELECT doc_id, page_index, contains(text, '[PERSON_') OR NOT contains(text, 'Sayfa') AS bad FROM md) GROUP BY doc_id",
    ),
    "structured_text": with_(
        _CHARS,
        "SELECT doc_id, page_index, string_agg(t, chr(10) || chr(10) ORDER BY at_) AS structured, count(*) AS n_paragraphs FROM (SELECT doc_id, page_index, split_part(line_id, ':', 1) || ':' || split_part(line_id, ':', 2) AS par, min(line_seq) AS at_, string_agg(text, ' ' ORDER BY line_seq) AS t FROM linerows GROUP BY ALL) GROUP BY ALL",
    ),
    "direction_inference": r"""WITH t AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN replace(replace(coalesce(text, ''), 'en', 'ğı'), 'an', 'şİ') ELSE coalesce(text, '') END AS text FROM documents)
SELECT doc_id, CASE WHEN length(regexp_replace(text, '[^ğĞıİşŞ]', '', 'g')) > 0.005 * length(regexp_replace(text, '[^\pL]', '', 'g')) THEN 'tr>en' ELSE 'en>tr' END AS direction FROM t""",
    "glossary_upsert": """WITH g AS (SELECT CASE n_nationkey % 4 WHEN 0 THEN 'IS' WHEN 1 THEN 'İs' WHEN 2 THEN 'ıs' ELSE 'is' END || n_nationkey // 4 AS term, n_name AS translation, n_nationkey % 3 = 0 AS verified FROM nation),
c AS (SELECT CASE s_suppkey % 2 WHEN 0 THEN 'ıS' ELSE 'iS' END || s_suppkey % 9 AS term, 'new ' || s_suppkey AS translation FROM supplier),
f AS (SELECT *, lower(replace(replace(term, 'I', 'ı'), 'İ', 'i')) AS fold FROM g),
n AS (SELECT fold, arg_min(term, term || '|' || translation) AS term, arg_min(translation, term || '|' || translation) AS translation FROM (SELECT *, lower(replace(replace(term, 'I', 'ı'), 'İ', 'i')) AS fold FROM c) GROUP BY fold),
free AS (SELECT * FROM n WHERE fold NOT IN (SELECT fold FROM f WHERE verified))
SELECT fold, term, translation, verified FROM f WHERE verified UNION ALL SELECT fold, term, translation, verified FROM f WHERE NOT verified AND fold NOT IN (SELECT fold FROM free) UNION ALL SELECT fold, term, translation, FALSE FROM free""",
    "glossary_harvest": f"""WITH l0 AS (SELECT doc_id, unnest(ls) AS line, unnest(generate_series(0, len(ls) - 1)) AS line_no FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)),
l1 AS (SELECT *, lag(line) OVER (PARTITION BY doc_id ORDER BY line_no) AS before FROM l0),
l2 AS (SELECT line AS original, coalesce(CASE WHEN {R.SHIFTED} THEN {R.TRANSLATED.replace('line', 'before')} ELSE {R.TRANSLATED} END, '') AS translated FROM l1),
p AS (SELECT row_number() OVER () AS id, {", ".join(f"list_distinct(list_filter(regexp_extract_all({c}, '[\\[\\pL\\pN]*[\\pL\\pN_\\]]+'), lambda w: regexp_matches(w, '^\\p{{Lu}}\\pL{{3,}}$'))) AS {n}" for c, n in (("original", "a"), ("translated", "b")))} FROM l2),
na AS (SELECT term, count(*) AS n_a FROM (SELECT unnest(a) AS term FROM p) GROUP BY term), nb AS (SELECT translation, count(*) AS n_b FROM (SELECT unnest(b) AS translation FROM p) GROUP BY translation),
met AS (SELECT term, translation, count(*) AS together FROM (SELECT term, unnest(b) AS translation FROM (SELECT unnest(a) AS term, b FROM p)) GROUP BY ALL HAVING count(*) >= 3),
t AS (SELECT *, (SELECT count(*) FROM p)::DOUBLE AS n FROM met JOIN na USING (term) JOIN nb USING (translation)),
c AS (SELECT *, unnest([1, 2, 3, 4]) AS cell FROM t WHERE together * n > n_a::DOUBLE * n_b),
k AS (SELECT *, CASE cell WHEN 1 THEN together WHEN 2 THEN n_a - together WHEN 3 THEN n_b - together ELSE n - n_a - n_b + together END AS o, CASE WHEN cell <= 2 THEN n_a ELSE n - n_a END AS r, CASE WHEN cell IN (1, 3) THEN n_b ELSE n - n_b END AS q FROM c),
s AS (SELECT term, translation, together, round(2 * sum(CASE WHEN o > 0 THEN o * ln(o * n / (r * q)) ELSE 0 END ORDER BY cell), 6) AS ratio FROM k GROUP BY ALL),
w AS (SELECT *, row_number() OVER (PARTITION BY term ORDER BY ratio DESC, together DESC, translation) AS x, row_number() OVER (PARTITION BY translation ORDER BY ratio DESC, together DESC, term) AS y FROM s WHERE ratio >= 10.83)
SELECT term, translation, together, ratio FROM w WHERE x = 1 AND y = 1""",
    "bookmark_offsets": "SELECT o_custkey AS doc_id, o_orderkey AS part, pages, CAST(coalesce(sum(pages) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS first_page FROM (SELECT o_custkey, o_orderkey, 1 + o_orderkey % 6 AS pages FROM orders)",
    "survival_rate": with_(_NORM, "SELECT entity_type, count(*) FILTER (doc_id % 4 <> number % 4) AS survived, count(*) AS total, avg(CASE WHEN doc_id % 4 <> number % 4 THEN 1 ELSE 0 END) AS rate FROM subs GROUP BY entity_type"),
    "outcome_buckets": with_(
        _MD,
        r"SELECT outcome, attribution, count(*) AS n FROM (SELECT CASE WHEN contains(text, '[TABLE — STRUCTURE UNCERTAIN, REVIEW]') THEN 'hatch' WHEN regexp_matches(text, '(^|\n)\| :?---? \|') OR regexp_matches(text, '\| :--- \|') OR regexp_matches(text, '\| --- \|') THEN 'table' ELSE 'prose' END AS outcome, CASE WHEN contains(text, 'davac') THEN 'correct' ELSE 'ambiguous' END AS attribution FROM md) GROUP BY ALL",
    ),
    "table_scores": with_(
        _MD,
        rf"""SELECT doc_id, page_index, len(p) AS n_rows, len(list_filter(p, lambda l: regexp_matches(l, '{_SEP}'))) AS n_separators, array_to_string(list_transform(list_filter(p, lambda l: NOT regexp_matches(l, '{_SEP}')), lambda l: len(string_split(l, '|')) - 2), ',') AS col_counts,
  contains(text, '[TABLE — STRUCTURE UNCERTAIN, REVIEW]') AS hatch_fired, contains(text, '[[TABLE') AS hint_leaked FROM (SELECT *, list_filter(string_split(text, chr(10)), lambda l: starts_with(l, '|') AND ends_with(l, '|')) AS p FROM md)""",
    ),
    "regions_accounted": with_(_RAW + _REGIONS, f"SELECT doc_id, page_index, x, y, w, h FROM regions r WHERE EXISTS ({_INSIDE})"),
    "regions_unaccounted": with_(_RAW + _REGIONS, f"SELECT doc_id, page_index, x, y, w, h FROM regions r WHERE NOT EXISTS ({_INSIDE})"),
    "region_scores": with_(_RAW + _REGIONS + ", truth AS (SELECT doc_id, page_index, line_no, 1470 + 10 * line_no + doc_id % 20 AS top FROM lines)", "SELECT doc_id, page_index, line_no, EXISTS (SELECT 1 FROM regions r WHERE r.doc_id = truth.doc_id AND r.page_index = truth.page_index AND r.x < 10 AND 5 < r.x + r.w AND r.y < top + 5 AND top < r.y + r.h) AS detected FROM truth"),
    "point_boxes": "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, " + ", ".join(f"CAST(round_even({v} * 200 / 72.0::DOUBLE, 0) AS INT) AS box_{n}" for n, v in (("left", "x"), ("top", "(792.0::DOUBLE - (y + 9))"), ("right", "(x + 4.5::DOUBLE)"), ("bottom", "(792.0::DOUBLE - y)"))) + " FROM (SELECT *, (l_partkey % 600)::DOUBLE / 2 AS x, (l_suppkey % 600)::DOUBLE / 2 AS y FROM lineitem)",
    "unmatched_pages": with_(
        _CHARS + ",\n" + found("pagetext", key="doc_id, page_index") + ", a AS (SELECT DISTINCT doc_id, page_index FROM spans WHERE doc_id % 3 > 0), b AS (SELECT DISTINCT doc_id, page_index FROM hits)",
        "(SELECT *, 'words' AS missing FROM b WHERE (doc_id, page_index) NOT IN (SELECT (doc_id, page_index) FROM a)) UNION ALL (SELECT *, 'entities' FROM a WHERE (doc_id, page_index) NOT IN (SELECT (doc_id, page_index) FROM b))",
    ),
    "page_envelopes": with_(
        _CHARS,
        "SELECT doc_id, page_index, any_value(pagetext.text) AS text, count(*) AS n_words, count(DISTINCT line_id) AS n_lines, arg_max(spans.text, e) AS last_word, max(e) AS last_end, arg_max(line_id, e) AS last_line, arg_max(y, e) AS last_y FROM spans JOIN pagetext USING (doc_id, page_index) GROUP BY doc_id, page_index",
    ),
    "line_pairs": with_(
        _CHARS,
        "SELECT doc_id, page_index, row_number() OVER (PARTITION BY doc_id, page_index ORDER BY line_seq) - 1 AS line_no, line_id, text AS original, replace(text, 'e', '3') AS anonymized FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, page_index) AS n FROM linerows) WHERE doc_id % 5 <> 0 OR n = 1",
    ),
    "raster_parity": "SELECT doc_id, TRUE AS same FROM documents",
    "page_counts": with_(_LINES, "SELECT doc_id, count(DISTINCT page_index) AS n_pages FROM lines GROUP BY doc_id"),
    "pages_in_bounds": with_(
        _LINES + ", p AS (SELECT doc_id, page_index, string_agg(text, chr(10) ORDER BY line_no) AS text FROM lines GROUP BY ALL)",
        "SELECT doc_id, page_index, text FROM (SELECT *, max(page_index) OVER (PARTITION BY doc_id) AS top FROM p) WHERE page_index IN (0, top)",
    ),
    "payload_roundtrip": with_(_LINES, "SELECT doc_id, page_index, len(string_split(text, ' ')) AS n_words, text FROM (SELECT doc_id, page_index, string_agg(text, chr(10) ORDER BY line_no) AS text FROM lines GROUP BY ALL)"),
    "footer_lines": with_(_CHARS, "SELECT doc_id, page_index, line_id FROM (SELECT doc_id, page_index, line_id, y AS line_y, text || CASE WHEN doc_id % 7 = 3 THEN ' page 4 - x' ELSE '' END AS line_text FROM linerows) WHERE NOT (" + _NO_FOOTER + ")"),
    "ink_regions": """WITH bars AS (SELECT doc_id, unnest([""" + ", ".join(f"{{'k': {k}, 'x': {x}, 'y': {y}, 'w': {w}, 'h': {h}}}" for k, (x, y, w, h) in enumerate(R.IMAGE_BARS)) + f"""]) AS b FROM documents),
wide AS (SELECT doc_id, b.k AS k, greatest(b.x - 14, 0) AS x0, greatest(b.y - 8, 0) AS y0, least(b.x + b.w + 14, {R.IMAGE[0]}) AS x1, least(b.y + b.h + 8, {R.IMAGE[1]}) AS y1 FROM bars),
met AS (SELECT doc_id, min(x0) AS x, min(y0) AS y, max(x1) - min(x0) AS w, max(y1) - min(y0) AS h FROM wide GROUP BY doc_id, CASE WHEN k = 3 AND doc_id % 4 <> 0 THEN 2 ELSE k END)
SELECT CAST(doc_id AS VARCHAR) AS path, 0 AS page_index, x, y, w, h FROM met WHERE w * h BETWEEN 400 AND 0.45 * {R.IMAGE[0] * R.IMAGE[1]}""",
    "md_elements": with_(
        _BLOCKS
        + """, item AS (SELECT *, CASE kind WHEN 'review' THEN CASE WHEN i = 1 THEN 'flag' ELSE 'body' END WHEN 'table' THEN CASE WHEN i = 0 THEN 'flag' WHEN i = 1 THEN 'header_row' ELSE 'row' END WHEN 'paragraph' THEN CASE WHEN page_index = first_page AND block_idx < h2 THEN 'caption' ELSE 'body' END ELSE kind END AS style
  FROM (SELECT *, unnest(generate_series(CASE WHEN kind = 'table' AND list_contains(list_transform(widths[3:], lambda w: w <> widths[1]), true) THEN 0 ELSE 1 END, len(ls))) AS i, min(page_index) OVER (PARTITION BY doc_id) AS first_page, min(CASE WHEN kind = 'h2' OR starts_with(ls[1], '## ') THEN block_idx END) OVER (PARTITION BY doc_id, page_index) AS h2 FROM kinds) WHERE NOT (kind = 'table' AND i = 2))""",
        """SELECT doc_id, page_index, block_idx, style, CASE WHEN kind = 'table' AND i = 0 THEN '[TABLE ROWS UNEVEN — auto-aligned, REVIEW cell placement]' WHEN kind = 'table' THEN array_to_string(list_transform(list_resize(string_split(ls[i], '|')[2:-2], widths[1], ''), lambda c: trim(c)), '/') WHEN kind = 'h1' THEN trim(ls[i][3:]) WHEN kind = 'h2' THEN trim(ls[i][4:]) ELSE trim(ls[i]) END AS said,
  page_index > first_page AND row_number() OVER (PARTITION BY doc_id, page_index ORDER BY block_idx, i) = 1 AS break_before FROM item""",
    ),
    "continuation_hints": with_(
        _BLOCKS,
        "SELECT doc_id, page_index, block_idx, " + ", ".join(f"'{SENTINEL}' || chr(10) || 'The table of the page before goes on here. Columns: \"Item\" | \"Supplier\". {said}' || chr(10) || '{SENTINEL}' || chr(10) || chr(10) AS {style}" for style, said in HINTS.items()) + " FROM kinds WHERE kind = 'table'",
    ),
    "translation_prompts": with_(
        _MD,
        "SELECT doc_id, page_index, sha256('Translate this legal document from ' || CASE WHEN doc_id % 2 = 0 THEN 'Turkish into English.' ELSE 'English into Turkish.' END || chr(10) || " + " || chr(10) || ".join("'- " + r.replace("'", "''") + "'" for r in PROMPT_RULES) + " || chr(10) || chr(10) || text) AS prompt_sha256 FROM md",
    ),
    "direction_languages": "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'Turkish' ELSE 'English' END AS source_language, CASE WHEN doc_id % 3 = 0 THEN 'English' ELSE 'Turkish' END AS target_language FROM documents",
    "blank_fields": "SELECT c_custkey, concat_ws(',', " + ", ".join(f"CASE WHEN coalesce({dict(R.PROFILE).get(k, 'NULL')}, '') = '' THEN '{k}' END" for k in REQUIRED_FIELDS) + ") AS blank FROM customer",
    "labelled_sources": "SELECT o_orderkey, CAST(part AS INT) AS part, substr('abc', part + 1, 1) || '-' || o_orderkey AS source, CASE WHEN o_orderkey % 2 = 0 THEN 'L' || substr('abc', part + 1, 1) || ' ' || o_orderkey ELSE ['Translated Document', 'Certification of Accuracy', 'Source Document'][part + 1] END AS label FROM orders, (SELECT unnest([0, 1, 2]) AS part)",
    "package_manifest": """SELECT o_orderkey AS doc_id, part, ['Translated Document', 'Certification of Accuracy', 'Source Document'][part + 1] AS label, [1 + o_orderkey % 6, 1, 1 + o_orderkey % 4][part + 1] AS pages, [0, 1 + o_orderkey % 6, 2 + o_orderkey % 6][part + 1] AS first_page,
  'ata_member_number=7;city=C;date=2024-05-06;page_count=' || (1 + o_orderkey % 6) || ';source_language=' || CASE WHEN o_orderkey % 2 = 0 THEN 'Turkish;state_name=S;target_language=English' ELSE 'English;state_name=S;target_language=Turkish' END || ';translator_full_name=T' || o_orderkey % 9 AS certificate FROM orders, (SELECT unnest([0, 1, 2]) AS part)""",
    "overlap_guard": f"WITH {_SPANS} SELECT doc_id, count(*) FILTER (s < before) AS n_overlaps FROM (SELECT *, lag(e) OVER (PARTITION BY doc_id ORDER BY s, e) AS before FROM ents) GROUP BY doc_id",
    "warning_list": with_(
        _NORM,
        r"""SELECT doc_id, 'boundary_normalization' AS kind, row_number() OVER (PARTITION BY doc_id ORDER BY ns, ne) - 1 AS pos, entity_type FROM val WHERE (s > 0 AND regexp_matches(substring(text, s, 2), '^[\pL\pN][\pL\pN]$')) OR (e > 0 AND regexp_matches(substring(text, e, 2), '^[\pL\pN][\pL\pN]$')) OR v1 <> v0 OR v1 = '' OR v3 = '' OR v2 <> v1 OR v3 <> v2 OR contains(cutout, chr(10))""",
    ),
    "placeholder_formats": with_(_NORM, "SELECT doc_id, ns AS span_start, '[' || t || ']' AS square, '⟦' || t || '⟧' AS double_bracket, '<<' || t || '>>' AS angle, 'XPIIX_' || t AS opaque FROM (SELECT *, entity_type || '_' || number AS t FROM subs)"),
    "expected_tokens": "SELECT o_orderkey, repeat(a || ' met ' || b || '. ', 1 + k) || b || ' left.' AS said, a || repeat(',' || a, k) || repeat(',' || b, 2 + k) AS expected FROM (SELECT o_orderkey, CAST(o_orderkey % 3 AS INT) AS k, '[PERSON_1' || o_orderkey % 5 || ']' AS a, '[PERSON_2' || o_orderkey % 5 || ']' AS b FROM orders)",
    "newline_failures": with_(_NORM, "SELECT entity_type, coalesce(string_agg(DISTINCT doc_id % 10, ',' ORDER BY doc_id % 10) FILTER (doc_id % 7 = 0 AND doc_id % 10 IN (1, 3, 8)), '') AS failed FROM subs GROUP BY entity_type"),
    "retry_delays": "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN (o_orderkey % 90)::DOUBLE + 0.5 END AS seconds FROM orders",
    "sniffed_formats": "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'pdf' ELSE 'image' END AS format FROM documents",
}
