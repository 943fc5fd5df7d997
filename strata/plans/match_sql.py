"""SQL of the oracle for text cleaning, entities, sparse and dense rankings: RE2 patterns, lists and recursion of its own."""

from __future__ import annotations

from ..functions import entities, text
from ..operators import retrieval

WORD_CHARS = r"[\p{L}\p{M}\p{N}_]+"


def quote(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def re2(s: str) -> str:
    return "".join("\\" + c if c in "\\^$.|?*+()[]{}" else c for c in s)


def either(words: list[str]) -> str:
    return "|".join(re2(w) for w in sorted(words, key=len, reverse=True))


def replace_all(items: list[tuple[str, str]], expr: str) -> str:
    for p, r in items:
        expr = f"regexp_replace({expr}, {quote(p)}, {quote(r)}, 'gi')"
    return expr


def expand(expr: str) -> str:
    by_length = sorted(text.ABBREVIATIONS.items(), key=lambda kv: -len(kv[0]))
    slashed = [(rf"(^|[^A-Za-z0-9]){a}($|[^A-Za-z0-9])", rf"\1{a} ({x})\2") for a, x in by_length if not a.isalnum()]
    return replace_all(slashed + [(rf"\b{a}\b", f"{a} ({x})") for a, x in by_length if a.isalnum()], expr)


def clean(expr: str) -> str:
    """Quotes, typing errors, then neighbouring equal words word by word."""
    c = replace_all([('"{2,}', '"'), *[(rf"\b{bad}\b", good) for bad, good in text.TYPOS]], expr)
    tail, head = f"regexp_extract(a, '({WORD_CHARS})$', 1)", f"regexp_extract(b, '^({WORD_CHARS})', 1)"
    return f"list_reduce(list_filter(string_split_regex({c}, '\\s+'), lambda x: x <> ''), lambda a, b: CASE WHEN {tail} <> '' AND lower({tail}) = lower({head}) THEN a || substr(b, length({head}) + 1) ELSE a || ' ' || b END)"


def filename_sql() -> str:
    pattern = quote(r"(?i)^(15_9_(?:F_)?[0-9]+(?:_[A-Z]+[0-9]*)?)_([0-9]{4})_([0-9]{2})_([0-9]{2})\.pdf$")
    families = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in text.WELL_FAMILIES.items())
    return f"""SELECT path, CASE WHEN day IS NOT NULL THEN p END AS prefix, CASE WHEN day IS NOT NULL THEN CASE p {families} ELSE p END END AS family, day AS report_date
FROM (SELECT path, regexp_extract(b, {pattern}, 1) AS p, CAST(try_strptime(regexp_extract(b, {pattern}, 2) || regexp_extract(b, {pattern}, 3) || regexp_extract(b, {pattern}, 4), '%Y%m%d') AS DATE) AS day
FROM (SELECT path, regexp_extract(path, '[^/]*$') AS b FROM (SELECT CASE n_ops % 5 WHEN 0 THEN 'x' || pdf_path WHEN 1 THEN replace(pdf_path, '_2024_01', '_2024_13') ELSE 'dir/' || pdf_path END AS path FROM reports)))"""


# ---- entities: every place of a text is tried ---------------------------------------------------------


def _sizes(x: str) -> str:
    """The value of a size as written: a whole number, one with a fraction, or one with decimals."""
    n = lambda i: f"TRY_CAST(regexp_extract({x}, '^(\\d+)\\s+(\\d+)\\s*[/-]\\s*(\\d+)', {i}) AS DOUBLE)"
    return f"CASE WHEN {n(3)} > 0 THEN {n(1)} + {n(2)} / {n(3)} WHEN regexp_matches({x}, '^\\d+[.,]\\d+') THEN TRY_CAST(replace(regexp_extract({x}, '^\\d+[.,]\\d+'), ',', '.') AS DOUBLE) ELSE TRY_CAST(regexp_extract({x}, '^\\d+') AS DOUBLE) END"


NUMBER = r"\d{1,3}(?:\s+\d{1,3}\s*[/-]\s*\d{1,3}|[.,]\d{1,3})?"
MARK = r"""\s*(?:"|''|\s*in(?:ch(?:es)?)?\b)"""
DEPTH = r"\d{1,5}(?:[.,]\d{1,3})?\s*(?:m\s*MD|mMD|m\s*TVD|mTVD|m)\b"


def _places() -> list[tuple[int, str, str, str]]:
    """rank, label, pattern at a place, class of characters that may not stand before it."""
    return [
        (0, "DEPTH", f"(?i)^(?:{DEPTH})", "[A-Za-z0-9]"), (1, "BIT_SIZE", f"(?i)^(?:{NUMBER}{MARK})", "[A-Za-z0-9]"),
        (2, "MEASUREMENT", rf"(?i)^(?:-?\d{{1,6}}(?:[.,]\d{{1,3}})?\s*(?:{either(entities.UNITS)})\b)", "[A-Za-z0-9.]"),
        (3, "TIME", r"^(?:(?:[01]\d|2[0-3]):[0-5]\d\b)", "[A-Za-z0-9_]"), (4, "EQUIPMENT", rf"(?i)^(?:(?:{either(entities.EQUIPMENT)})\b)", "[A-Za-z0-9_]"),
    ]


def entity_ctes() -> str:
    """... found(op_id, k, s, e, rank, label, m, value, unit): what is left of each remark, after ops."""
    one = lambda rank, label, p, before: f"SELECT op_id, {rank} AS rank, '{label}' AS label, i AS s, regexp_extract(substr(remark, i), {quote(p)}) AS m FROM spots WHERE NOT regexp_matches(substr(remark, i - 1, CASE WHEN i > 1 THEN 1 ELSE 0 END), '{before}') AND regexp_matches(substr(remark, i), {quote(p)})"
    number = "TRY_CAST(replace(regexp_extract(m, '^-?\\d+(?:[.,]\\d+)?'), ',', '.') AS DOUBLE)"
    measure_unit = "regexp_replace(m, '^-?[0-9.,]+\\s*', '')"
    depth_unit = "upper(replace(regexp_extract(m, '(?i)(m\\s*MD|mMD|m\\s*TVD|mTVD|m)$', 1), ' ', ''))"
    return f"""spots AS (SELECT op_id, remark, unnest(range(1, length(remark) + 1)) AS i FROM ops WHERE remark <> ''),
cand AS (SELECT *, s + length(m) AS e FROM ({' UNION ALL '.join(one(*p) for p in _places())})),
runs AS (SELECT c.* FROM cand c JOIN (SELECT op_id, label, min(s) AS s FROM cand GROUP BY 1, 2) f ON c.op_id = f.op_id AND c.label = f.label AND c.s = f.s
 UNION ALL SELECT op_id, rank, label, s, m, e FROM (SELECT c.*, row_number() OVER (PARTITION BY c.op_id, c.label ORDER BY c.s) AS k FROM runs r JOIN cand c ON c.op_id = r.op_id AND c.label = r.label AND c.s >= r.e) WHERE k = 1),
valued AS (SELECT *, CASE label WHEN 'BIT_SIZE' THEN {_sizes('m')} WHEN 'DEPTH' THEN {number} WHEN 'MEASUREMENT' THEN {number} END AS v FROM runs),
ranged AS (SELECT op_id, s, e, rank, label, m, CASE WHEN label IN ('DEPTH', 'BIT_SIZE', 'MEASUREMENT') THEN format('{{:g}}', v) WHEN label = 'TIME' THEN m ELSE upper(m) END AS value,
  CASE label WHEN 'DEPTH' THEN CASE WHEN {depth_unit} LIKE '%TVD%' THEN 'mTVD' WHEN {depth_unit} LIKE '%MD%' THEN 'mMD' ELSE 'm' END WHEN 'BIT_SIZE' THEN '"' WHEN 'MEASUREMENT' THEN CASE WHEN lower({measure_unit}) IN ('ton', 'tons') THEN 'MT' ELSE {measure_unit} END END AS unit
  FROM valued WHERE CASE label WHEN 'DEPTH' THEN v BETWEEN 5 AND 9999 WHEN 'BIT_SIZE' THEN v BETWEEN 3 AND 40 ELSE true END),
placed AS (SELECT *, row_number() OVER (PARTITION BY op_id ORDER BY s, rank, e DESC) AS k FROM ranged),
chosen AS (SELECT op_id, k, [{{'s': s, 'e': e, 'r': rank, 'k': k}}] AS kept FROM placed WHERE k = 1
 UNION ALL SELECT p.op_id, p.k, CASE WHEN len(list_filter(c.kept, lambda x: p.s < x.e AND x.s < p.e AND x.r <= p.rank)) > 0 THEN c.kept ELSE list_append(c.kept, {{'s': p.s, 'e': p.e, 'r': p.rank, 'k': p.k}}) END FROM chosen c JOIN placed p ON p.op_id = c.op_id AND p.k = c.k + 1),
final AS (SELECT op_id, unnest(list_transform(kept, lambda x: x.k)) AS k FROM (SELECT op_id, kept, row_number() OVER (PARTITION BY op_id ORDER BY k DESC) AS z FROM chosen) WHERE z = 1),
found AS (SELECT p.* FROM placed p JOIN final f ON p.op_id = f.op_id AND p.k = f.k)"""


def sets(expr: str) -> dict[str, str]:
    """The four sets that the reranker compares, as sorted lists."""
    bits = f"regexp_extract_all({expr}, {quote(f'(?i)(?:^|[^A-Za-z0-9])({NUMBER}){MARK}')}, 1)"
    depths = f"regexp_extract_all({expr}, {quote(r'(?i)\b(\d{2,5}(?:[.,]\d{1,3})?)\s*(?:m\s*MD|mMD|m)\b')}, 1)"
    gear = f"regexp_extract_all({expr}, {quote(rf'\b({either([a for a in text.ABBREVIATIONS if a.isalnum()])})\b')}, 1)"
    problems = f"list_transform(regexp_extract_all({expr}, {quote(rf'(?i)\b({either(entities.PROBLEMS)})\b')}, 1), lambda x: lower(x))"
    of = {
        "bit_sizes": f"list_transform(list_filter(list_transform({bits}, lambda x: {_sizes('x')}), lambda v: v BETWEEN 4 AND 40), lambda v: format('{{:g}}', v) || '\"')",
        "depths": f"list_filter(list_transform({depths}, lambda x: CAST(round_even(CAST(replace(x, ',', '.') AS DOUBLE), 0) AS INT)), lambda v: v BETWEEN 1 AND 10000)",
        "problems": problems, "equipment": gear,
    }
    return {k: f"list_sort(list_distinct({v}))" for k, v in of.items()}


def overlap(a: str, b: str) -> str:
    """Of two rows with the columns of sets()."""
    return " + ".join(f"CASE WHEN len({a}.{n}) > 0 AND len({b}.{n}) > 0 THEN CAST({w} AS DOUBLE) * (CAST(len(list_intersect({a}.{n}, {b}.{n})) AS DOUBLE) / len(list_distinct(list_concat({a}.{n}, {b}.{n})))) ELSE 0.0 END" for n, w in entities.WEIGHTS.items())


# ---- rankings -------------------------------------------------------------------------------------------


def event_values(events: list[tuple]) -> str:
    rows = ", ".join(f"({i}, {quote(w)}, '{w.replace('/', '_').replace('-', '_')}', {quote(t)})" for i, w, t in events)
    free = ", ".join(quote(w) for w in text.WELLS_WITHOUT_REPORTS)
    return f"ev AS (SELECT *, well_family NOT IN ({free}) AS has_pdf_corpus FROM (VALUES {rows}) t(event_id, well_raw, well_family, event_text)), eq AS (SELECT *, {expand('c')} AS q FROM (SELECT *, {clean('event_text')} AS c FROM ev))"


def _terms(src: str, key: str, txt: str, out: str) -> str:
    ws = f"regexp_extract_all(lower({txt}), '\\b\\w\\w+\\b')"
    return f"{out}_t AS (SELECT {key}, {ws} AS ws FROM {src}), {out} AS (SELECT {key}, term, count(*) AS tf FROM (SELECT {key}, unnest(list_concat(ws, list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]))) AS term FROM {out}_t) GROUP BY 1, 2)"


def _unit(counts: str, key: str, out: str) -> str:
    return f"{out} AS (SELECT {key}, term, w / sqrt(sum(w * w) OVER (PARTITION BY {key})) AS weight FROM (SELECT {key}, c.term, (1.0 + ln(tf)) * idf AS w FROM {counts} c JOIN idf ON c.term = idf.term))"


def sparse_ctes(events: list[tuple]) -> str:
    """... scope(event_id, op_id), sparse(event_id, op_id, score) of all candidates, after ops."""
    return f"""{event_values(events)}, o AS (SELECT * FROM ops WHERE length(trim(op_text)) > 0),
{_terms('o', 'op_id', expand('op_text'), 'dc')}, {_terms('eq', 'event_id', 'q', 'qc')},
idf AS (SELECT term, ln((1.0 + n) / (1.0 + count(*))) + 1.0 AS idf FROM dc, (SELECT count(*) AS n FROM o) GROUP BY term, n HAVING count(*) >= 2 AND count(*) <= CAST(0.95 AS DOUBLE) * n),
{_unit('dc', 'op_id', 'dw')}, {_unit('qc', 'event_id', 'qw')},
scope AS (SELECT event_id, op_id FROM ev JOIN o ON NOT has_pdf_corpus OR ev.well_family = o.well_family),
dots AS (SELECT event_id, op_id, round(sum(dw.weight * qw.weight), 12) AS s FROM dw JOIN qw ON dw.term = qw.term GROUP BY 1, 2),
sparse AS (SELECT scope.event_id, scope.op_id, coalesce(s, CAST(0 AS DOUBLE)) AS score FROM scope LEFT JOIN dots ON scope.event_id = dots.event_id AND scope.op_id = dots.op_id)"""


def match_ctes(events: list[tuple]) -> str:
    """... matches, as retrieval.match() gives them."""
    top = lambda src, score: f"SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY event_id ORDER BY {score} DESC, op_id) AS INT) AS rank FROM {src})"
    spread = lambda c: f"CASE WHEN max({c}) OVER w - min({c}) OVER w < 1e-12 THEN 0.5 ELSE ({c} - min({c}) OVER w) / (max({c}) OVER w - min({c}) OVER w) END"
    listed = lambda expr: ", ".join(f"{v} AS {k}" for k, v in sets(expr).items())
    raw = {"tfidf": "JOIN a ON full_.event_id = a.event_id AND full_.op_id = a.op_id", "sbert": "JOIN b ON full_.event_id = b.event_id AND full_.op_id = b.op_id"}
    ranked = " UNION ALL ".join(f"SELECT event_id, op_id, '{m}' AS match_method, rank, {m} AS similarity_score, tfidf, sbert, entity_overlap FROM ({top(f'(SELECT full_.* FROM full_ {raw.get(m, '')})', m)}) WHERE rank <= 5" for m in retrieval.METHODS)
    return f"""{sparse_ctes(events)},
nv AS (SELECT count(*) AS n FROM embeddings),
dv AS (SELECT op_id, CAST(embedding AS DOUBLE[]) AS vec FROM o, nv JOIN embeddings v ON o.op_id % n = v.vec_id),
dense AS (SELECT scope.event_id, scope.op_id, round(list_dot_product(CAST(q.embedding AS DOUBLE[]), dv.vec), 12) AS score FROM scope JOIN dv ON scope.op_id = dv.op_id JOIN embeddings q ON q.vec_id = scope.event_id),
a AS (SELECT event_id, op_id, score FROM ({top('sparse', 'score')}) WHERE rank <= {retrieval.POOL}), b AS (SELECT event_id, op_id, score FROM ({top('dense', 'score')}) WHERE rank <= {retrieval.POOL}),
both_ AS (SELECT coalesce(a.event_id, b.event_id) AS event_id, coalesce(a.op_id, b.op_id) AS op_id, coalesce(a.score, CAST(0 AS DOUBLE)) AS tfidf, coalesce(b.score, CAST(0 AS DOUBLE)) AS sbert FROM a FULL JOIN b ON a.event_id = b.event_id AND a.op_id = b.op_id),
blend AS (SELECT *, round(0.5 * {spread('tfidf')} + 0.5 * {spread('sbert')}, 12) AS hybrid FROM both_ WINDOW w AS (PARTITION BY event_id)),
es AS (SELECT event_id, {listed('q')} FROM eq), os AS (SELECT op_id, {listed('op_text')} FROM o WHERE op_id IN (SELECT op_id FROM blend)),
over_ AS (SELECT blend.*, {overlap('es', 'os')} AS entity_overlap FROM blend JOIN es ON blend.event_id = es.event_id JOIN os ON blend.op_id = os.op_id),
full_ AS (SELECT *, round(CAST(0.7 AS DOUBLE) * hybrid + CAST(0.3 AS DOUBLE) * entity_overlap, 12) AS reranked FROM over_),
best AS ({ranked}),
matches AS (SELECT best.event_id, ev.well_raw AS nds_well, ev.event_text AS nds_event_text, CASE WHEN ev.has_pdf_corpus THEN 'strict_same_well' ELSE 'cross_well_fallback' END AS match_type, match_method, rank,
  round(similarity_score, 6) AS similarity_score, round(tfidf, 6) AS tfidf_score, round(sbert, 6) AS sbert_score, round(entity_overlap, 6) AS entity_overlap, best.op_id AS matched_op_id, o.pdf_path AS matched_pdf, {', '.join(f'o.{c} AS matched_{c}' for c in retrieval.MATCHED)}
  FROM best JOIN ev ON best.event_id = ev.event_id JOIN o ON best.op_id = o.op_id),
bench AS (SELECT event_id, nds_well, substr(nds_event_text, 1, 120) AS nds_event_text, match_type,
  {', '.join(f"max({c}) FILTER (WHERE match_method = '{m}') AS {m}_{n}" for m in retrieval.METHODS for c, n in (('similarity_score', 'score'), ("string_split(matched_pdf, '/')[-1]", 'pdf'), ('matched_well_family', 'well')))},
  count(DISTINCT matched_pdf) AS n_unique_pdfs, count(DISTINCT matched_op_id) AS n_unique_ops, count(DISTINCT matched_op_id) = 1 AS all_methods_agree FROM matches WHERE rank = 1 GROUP BY 1, 2, 3, 4)"""


