"""DuckDB SQL of the registered queries, built from common table expressions."""

from __future__ import annotations

from docmill.functions import html as H
from docmill.functions import urls as U
from docmill.operators import clean as C
from docmill.operators import evaluate as E
from docmill.plans.fixtures import EDGES, EVALUATION, MARKDOWN

STRIP = r"regexp_replace({}, '^\s+|\s+$', '', 'g')"
FENCE = "repeat(chr(96), 3)"


def strip(x: str) -> str:
    return STRIP.format(x)


def quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def words(x: str) -> str:
    return rf"list_filter(regexp_split_to_array({x}, '\s+'), lambda w: w <> '')"


def ident(x: str) -> str:
    return f"list_filter(regexp_split_to_array(lower({x}), '[^a-z0-9]+'), lambda t: t <> '')"


# ---- URLs

_PARTS = r"'^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?'"
_PAIRS = rf"list_filter(string_split(regexp_extract(url, {_PARTS}, 4), '&'), lambda p: regexp_matches(p, '^[^=]*=.'))"
URLS = rf"""urls AS (
  SELECT page_id, url, lower(regexp_extract(url, {_PARTS}, 1)) AS scheme, regexp_extract(url, {_PARTS}, 2) AS host,
    regexp_replace(regexp_extract(url, {_PARTS}, 3), ';[^/]*$', '') AS path, {_PAIRS} AS pairs
  FROM pages
), normal AS (
  SELECT *, concat(scheme, '://', lower(host), path, CASE WHEN len(kept) > 0 THEN '?' || array_to_string(list_transform(kept, lambda p: replace(p, '%20', '+')), '&') ELSE '' END) AS norm_url
  FROM (SELECT *, list_filter(pairs, lambda p: string_split(p, '=')[1] <> 'hl') AS kept FROM urls) u
)"""
_PAGES = "'^(" + "|".join(U.PAGINATION_KEYS) + ")$'"
REASONS = rf"""reasons AS (
  SELECT page_id, url, norm_url, CASE
    WHEN NOT (lower(host) IN ('example.com', 'example.net') OR ends_with(lower(host), '.example.com') OR ends_with(lower(host), '.example.net')) THEN {quoted(U.DOMAIN)}
    WHEN {" OR ".join(f"regexp_matches(url, {quoted('^(?:' + p + ')')})" for p in (*U.BINARY_PATTERNS, ".*[.]html$"))} THEN {quoted(U.PATTERN)}
    WHEN len(list_filter(pairs, lambda p: regexp_matches(string_split(p, '=')[1], {_PAGES}))) > 0 THEN {quoted(U.PAGINATION)}
    WHEN length(path) < 5 THEN {quoted(U.SHORT)} END AS filter_reason
  FROM normal
)"""


# ---- HTML

#: The library reads pages tag by tag; SQL, by replacements in this order. Both agree on pages without nested or inline marks.
STEPS = (
    (r"(?is)<(script|style|head|template)\b[^>]*>.*?</\1\s*>", ""),
    (r"(?s)<!--.*?-->", ""),
    (r"(?is)<pre\b[^>]*>(.*?)</pre>", "\n```\n$1\n```\n"),
    *((rf"(?is)<h{k}\b[^>]*>(.*?)</h{k}>", f"\n{'#' * k} $1\n") for k in range(1, 7)),
    (r"(?is)<a\b[^>]*?\bhref=[\"']([^\"']*)[\"'][^>]*>(.*?)</a>", r"[$2]($1)"),
    (r"(?is)<li\b[^>]*>", "\n- "),
    (r"(?is)</t[dh]>\s*(?=<t[dh]\b)", " | "),
    (r"(?is)<tr\b[^>]*>\s*<t[dh]\b[^>]*>", "\n| "),
    (r"(?is)</t[dh]>\s*</tr>", " |\n"),
    (r"(?is)<br\s*/?>", "\n"),
    (r"(?is)</?(p|div|ul|ol|article|nav|footer|header|section|table|blockquote)\b[^>]*>", "\n\n"),
    (r"(?s)<[^>]*>", ""),
    *((e, c) for e, c in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&"))),
    (r"[ \t]+\n", "\n"),
    (r"\n{3,}", "\n\n"),
)


def _cascade(x: str) -> str:
    for pattern, to in STEPS:
        to = to.replace("$1", "\\1").replace("$2", "\\2")
        head = pattern.replace(r"</\1\s*>", r"</(?:script|style|head|template)\s*>").replace(r"</t[dh]>\s*(?=<t[dh]\b)", r"</t[dh]>\s*<t[dh]\b")
        if head != pattern and "<t[dh]" in head:
            to += "<td"
        x = f"regexp_replace({x}, {quoted(head)}, {quoted(to)}, 'g')"
    return strip(x)


MARK = f"marked AS (SELECT page_id, url, html, {_cascade('html')} AS md FROM pages)"
_BASE = rf"regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*')"
_RESOLVED = rf"""list_transform(regexp_extract_all(md, '\[.+?\]\((.+?)\)', 1), lambda l: CASE
    WHEN regexp_matches(l, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN l WHEN starts_with(l, '//') THEN concat(regexp_extract(url, '^[A-Za-z]+:'), l)
    WHEN starts_with(l, '/') THEN concat({_BASE}, l) WHEN starts_with(l, '#') THEN concat(regexp_replace(url, '#.*$', ''), l)
    WHEN starts_with(l, '?') THEN concat(regexp_replace(url, '[?#].*$', ''), l)
    ELSE concat({_BASE}, CASE WHEN regexp_replace(path, '[^/]*$', '') = '' THEN '/' ELSE regexp_replace(path, '[^/]*$', '') END, l) END)"""

# ---- blocks

BLOCKS = rf"""md AS ({MARKDOWN}), raw_lines AS (
  SELECT doc, unnest(string_split(markdown_content, chr(10))) AS line, generate_subscripts(string_split(markdown_content, chr(10)), 1) AS pos FROM md
), l1 AS (
  SELECT *, CAST((length(line) - length(replace(line, {FENCE}, ''))) / 3 AS BIGINT) % 2 AS odd, starts_with({strip('line')}, '|') AND ends_with({strip('line')}, '|') AS is_row FROM raw_lines
), l2 AS (
  SELECT *, sum(odd) OVER (PARTITION BY doc ORDER BY pos ROWS UNBOUNDED PRECEDING) % 2 = 1 AS code FROM l1
), l3 AS (
  SELECT *, coalesce(last_value(CASE WHEN NOT code THEN is_row END IGNORE NULLS) OVER (PARTITION BY doc ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), false) AS tab FROM l2
), l4 AS (
  SELECT *, NOT code AND coalesce(lag(tab) OVER (PARTITION BY doc ORDER BY pos), false) AND NOT is_row AS pre, NOT code AND NOT tab AS post FROM l3
), l5 AS (
  SELECT *, CASE WHEN pre OR coalesce(lag(post) OVER (PARTITION BY doc ORDER BY pos), false) THEN 1 ELSE 0 END AS turn FROM l4
), l6 AS (
  SELECT *, sum(turn) OVER (PARTITION BY doc ORDER BY pos ROWS UNBOUNDED PRECEDING) AS run FROM l5
), joined AS (
  SELECT doc, run, {strip('string_agg(line, chr(10) ORDER BY pos)')} AS content FROM l6 GROUP BY doc, run
), blocks AS (
  SELECT doc, CAST(row_number() OVER (PARTITION BY doc ORDER BY run) - 1 AS INTEGER) AS block_idx, content FROM joined WHERE content <> ''
)"""

_HASH = r"md5({})".format(strip(r"regexp_replace(regexp_replace(regexp_replace(content, '\[([^\]]+)\]\([^\)]+\)', '[\1]', 'g'), '\d{4}-\d{2}-\d{2}', '', 'g'), '\s+', ' ', 'g')"))
MEASURED = rf"""typed AS (
  SELECT *, starts_with(content, {FENCE}) AND ends_with(content, {FENCE}) AS is_code, {_HASH} AS content_hash,
    regexp_extract_all(lower(content), '[\p{{L}}\p{{N}}_]+') AS ws, regexp_extract_all(content, '\[([^\]]+)\]\([^\)]+\)', 1) AS ls
  FROM blocks
), typed2 AS (
  SELECT *, NOT is_code AND starts_with(content, '#') AS is_heading FROM typed
), typed3 AS (
  SELECT *, NOT is_code AND NOT is_heading AND (contains(content, '|---') OR contains(content, '---|')) AS is_table FROM typed2
), measured AS (
  SELECT doc, block_idx, content, content_hash, is_code, is_heading, is_table,
    NOT is_code AND NOT is_heading AND NOT is_table AND (starts_with(content, '- ') OR starts_with(content, '* ') OR regexp_matches(content, '^\d+\.\s')) AS is_list,
    block_idx / count(*) OVER (PARTITION BY doc)::DOUBLE AS position_ratio, len(ws)::BIGINT AS word_count,
    CASE WHEN len(ws) > 0 THEN len(list_distinct(ws)) / len(ws)::DOUBLE ELSE 0.0 END AS unique_word_ratio, len(ls)::BIGINT AS link_count,
    coalesce(list_sum(list_transform(ls, lambda x: length(x))), 0) / length(content)::DOUBLE AS link_density
  FROM typed3
)"""


def _case(steps: list[tuple[str, str]], other: str = "0.0") -> str:
    return "CASE " + " ".join(f"WHEN {c} THEN {v}" for c, v in steps) + f" ELSE {other} END"


_GUARD = "is_code OR is_table OR is_heading"
_FAMILIES = {
    "freq": ([(f"df > {t}", str(p), s) for s, t, p, _ in C.FREQUENCY]),
    "edge": [("position_ratio < 0.1 OR position_ratio > 0.9", "1.5", "edge_position")],
    "dens": ([(f"link_density > {t}", str(p), s) for s, t, p, _ in C.DENSITY]),
    "info": [("word_count < 10 AND link_count > 0", "2.0", "info_density_low"), ("word_count > 30 AND link_density < 0.1", "-3.0", None)],
    "dive": [("word_count > 5 AND unique_word_ratio < 0.5", "2.0", "diversity_low")],
    "ctx": [("near > 0", "near", "context_penalty")],
}
_POINTS = " + ".join(_case([(c, p) for c, p, _ in steps]) for steps in _FAMILIES.values())
_SIGNALS = ", ".join(_case([(c, quoted(s) if s else "NULL") for c, _, s in steps], "NULL") for steps in _FAMILIES.values())
SCORED = f"""dfs AS (
  SELECT content_hash, count(DISTINCT doc) AS n_docs FROM measured GROUP BY content_hash
), framed AS (
  SELECT m.*, d.n_docs / (SELECT count(*) FROM documents)::DOUBLE AS df,
    coalesce(CAST(lag(link_density > 0.5 AND word_count < 15) OVER w AS INTEGER), 0) + coalesce(CAST(lead(link_density > 0.5 AND word_count < 15) OVER w AS INTEGER), 0) AS near
  FROM measured m JOIN dfs d USING (content_hash) WINDOW w AS (PARTITION BY doc ORDER BY block_idx)
), points AS (
  SELECT *, CASE WHEN {_GUARD} THEN 0.0 ELSE CAST({_POINTS} AS DOUBLE) END AS score,
    CASE WHEN {_GUARD} THEN [] ELSE list_filter([{_SIGNALS}], lambda s: s IS NOT NULL) END AS signals
  FROM framed
), scored AS (
  SELECT *, CASE WHEN {_GUARD} OR score <= -1.0 THEN 0 WHEN df > 0.95 AND word_count < 15 THEN 1
    WHEN score >= 6.0 AND len(list_distinct(list_transform(signals, lambda s: string_split(s, '_')[1]))) >= 2 THEN 2
    WHEN link_density > 0.9 AND df > 0.2 THEN 3 ELSE 0 END AS tier
  FROM points
)"""
ALL_BLOCKS = with_(BLOCKS, MEASURED, SCORED)


def _shape(x: str, side: str) -> str:
    count = lambda p: f"len(regexp_extract_all({x}, {quoted(p)}))::BIGINT"
    heads = ", ".join(f"{count(p.replace('(?mU)', '(?m)'))} AS h{k}_{side}" for k, p in enumerate(C.HEADINGS, 1))
    return f"len({words(x)})::BIGINT AS words_{side}, {heads}, {count(C.FENCES)} // 2 AS code_blocks_{side}, {count(C.TABLES.replace('(?U)', ''))} AS tables_{side}"


PROCESSED = f"""kept AS (
  SELECT doc, coalesce(string_agg(CASE WHEN tier = 0 THEN content END, chr(10) || chr(10) ORDER BY block_idx), '') AS cleaned, count_if(tier > 0) AS blocks_removed, count_if(tier = 0) AS blocks_retained,
    count_if(tier = 0 AND is_code) AS n_code, count_if(tier = 0 AND is_list) AS n_list
  FROM scored GROUP BY doc
), full_docs AS (
  SELECT md.doc, md.markdown_content, coalesce(cleaned, '') AS cleaned, coalesce(blocks_removed, 0) AS blocks_removed, coalesce(blocks_retained, 0) AS blocks_retained, coalesce(n_code, 0) AS n_code, coalesce(n_list, 0) AS n_list
  FROM md LEFT JOIN kept USING (doc)
), processed AS (
  SELECT doc, md5(cleaned) AS cleaned_md5, blocks_removed, blocks_retained,
    CASE WHEN blocks_retained = 0 THEN 'uncategorized' WHEN blocks_retained <= 5 THEN 'overview' WHEN n_code / blocks_retained::DOUBLE >= 0.3 THEN 'reference'
      WHEN n_list / blocks_retained::DOUBLE >= 0.25 THEN 'tutorial' ELSE 'guide' END AS page_category,
    {_shape('markdown_content', 'before')}, {_shape('cleaned', 'after')}
  FROM full_docs
)"""

# ---- sections

SECTIONS = rf"""md AS ({MARKDOWN}), raw_lines AS (
  SELECT doc, unnest(string_split(markdown_content, chr(10))) AS line, generate_subscripts(string_split(markdown_content, chr(10)), 1) AS pos FROM md
), s1 AS (
  SELECT *, regexp_matches(line, '^(#{{1,6}})\s+(.*)$') AS head, sum(length(line) + 1) OVER (PARTITION BY doc ORDER BY pos ROWS UNBOUNDED PRECEDING) - length(line) - 1 AS at_ FROM raw_lines
), s2 AS (
  SELECT *, sum(CAST(head AS INTEGER)) OVER (PARTITION BY doc ORDER BY pos ROWS UNBOUNDED PRECEDING) AS section FROM s1
), heads AS (
  SELECT doc, CAST(section AS BIGINT) AS section, pos, length(regexp_extract(line, '^(#{{1,6}})\s+(.*)$', 1)) AS level, {strip(r"regexp_extract(line, '^(#{1,6})\s+(.*)$', 2)")} AS title FROM s2 WHERE head
), sections AS (
  SELECT s.doc, CAST(s.section AS BIGINT) AS section, CAST(coalesce(any_value(h.level), 0) AS INTEGER) AS level, coalesce(any_value(h.title), 'Introduction') AS title,
    CAST(min(s.at_) AS BIGINT) AS char_start, string_agg(s.line, chr(10) ORDER BY s.pos) AS content
  FROM s2 s LEFT JOIN heads h ON s.doc = h.doc AND s.section = h.section GROUP BY s.doc, s.section HAVING {strip('string_agg(s.line, chr(10) ORDER BY s.pos)')} <> ''
)"""
_COUNT = r"len(regexp_extract_all({}, '[\p{{L}}\p{{N}}_]+|[^\s\p{{L}}\p{{N}}_]'))::BIGINT"
SECTION_BLOCKS = rf"""pieces AS (
  SELECT doc, section, char_start AS base, unnest(regexp_split_to_array({strip('content')}, '\n\n+')) AS text, generate_subscripts(regexp_split_to_array({strip('content')}, '\n\n+'), 1) - 1 AS block FROM sections
), trimmed AS (
  SELECT doc, section, base, {strip('text')} AS text, CAST(block AS INTEGER) AS block FROM pieces WHERE {strip('text')} <> ''
), section_blocks AS (
  SELECT doc, section, block, CASE WHEN starts_with(text, {FENCE}) AND ends_with(text, {FENCE}) THEN 'code' WHEN starts_with(text, '|') OR contains(text, chr(10) || '|') THEN 'table' ELSE 'text' END AS block_type,
    md5(text) AS text_md5, {_COUNT.format('text')} AS token_count,
    CAST(base + coalesce(sum(length(text) + 2) OVER (PARTITION BY doc, section ORDER BY block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS char_start
  FROM trimmed
)"""

# ---- retrieval

_TERMS = words("lower({})")
BM25 = rf"""corpus AS (SELECT doc_id AS item_id, {_TERMS.format("coalesce(text, '')")} AS ts FROM documents
), lengths AS (SELECT item_id, len(ts)::BIGINT AS length FROM corpus
), postings AS (SELECT term, item_id, count(*) AS tf FROM (SELECT item_id, unnest(ts) AS term FROM corpus) p GROUP BY term, item_id
), dfs AS (SELECT term, count(*) AS df FROM postings GROUP BY term
), raws AS (SELECT term, ln((SELECT count(*) FROM documents) - df + 0.5) - ln(df + 0.5) AS raw FROM dfs
), idfs AS (SELECT term, CASE WHEN raw < 0 THEN 0.25 * (SELECT avg(raw) FROM raws) ELSE raw END AS idf FROM raws
), asked AS (SELECT item_id AS query_id, term, count(*) AS qf FROM (SELECT item_id, unnest({_TERMS.format('text')}) AS term FROM benchmark) q GROUP BY 1, 2
), bm25 AS (
  SELECT a.query_id, p.item_id, round(sum(a.qf * i.idf * p.tf * 2.5 / (p.tf + 1.5 * (0.25 + 0.75 * l.length / (SELECT avg(length) FROM lengths)))), 6) AS score
  FROM asked a JOIN postings p USING (term) JOIN idfs i USING (term) JOIN lengths l ON l.item_id = p.item_id GROUP BY 1, 2
), sparse AS (
  SELECT query_id, rank, item_id, score FROM (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, item_id) AS INTEGER) AS rank FROM bm25) r WHERE rank <= 20 AND score > 0
)"""
DENSE = """vectors AS (SELECT vec_id AS item_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
), near AS (
  SELECT b.item_id AS query_id, e.item_id, round(greatest(list_cosine_similarity(q.v, e.v), 0.0), 6) AS score
  FROM benchmark b JOIN vectors q ON q.item_id = b.item_id CROSS JOIN vectors e
), dense AS (
  SELECT query_id, rank, item_id, score FROM (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, item_id) AS INTEGER) AS rank FROM near) r WHERE rank <= 20
)"""
EVAL = rf"""asked_for AS ({EVALUATION}), hits AS (
  SELECT b.item_id AS query_id, concat('doc-', d.doc_id) AS target FROM benchmark b JOIN documents d ON contains(d.text, b.text)
), evaluated AS (
  SELECT a.*, coalesce((SELECT list(target ORDER BY target) FROM hits h WHERE h.query_id = a.query_id), []) AS targets, CASE WHEN query_id % 2 = 0 THEN [] ELSE ['source 3', 'source 7', 'source 11'] END AS headings FROM asked_for a
), found AS (
  SELECT s.query_id, s.rank, s.item_id, concat('doc-', s.item_id) AS identifier, concat('Source ', replace(d.source, 'src', '')) AS section_title FROM sparse s JOIN documents d ON d.doc_id = s.item_id WHERE s.rank <= 5
), spaced AS (
  SELECT f.*, e.targets, e.headings, ' ' || array_to_string({ident('identifier')}, ' ') || ' ' AS ids, ' ' || array_to_string({ident('section_title')}, ' ') || ' ' AS title_ids
  FROM found f JOIN evaluated e USING (query_id)
), matched AS (
  SELECT *, list_filter(targets, lambda t: contains(identifier, t)) AS exact, list_filter(targets, lambda t: contains(ids, ' ' || array_to_string({ident('t')}, ' ') || ' ')) AS loose,
    len(list_filter(headings, lambda h: contains(title_ids, ' ' || array_to_string({ident('h')}, ' ') || ' '))) > 0 AS heading_match
  FROM spaced
), classified AS (
  SELECT query_id, rank, item_id, coalesce(exact[1], loose[1], '') AS matched_target, CASE WHEN len(exact) > 0 THEN {quoted(E.SUBSTRING_RULE)} WHEN len(loose) > 0 THEN {quoted(E.TOKEN_RULE)} ELSE '' END AS matching_rule,
    heading_match, CASE WHEN len(exact) + len(loose) = 0 THEN {quoted(E.NO_MATCH)} WHEN len(headings) = 0 OR heading_match THEN {quoted(E.EXACT)} ELSE {quoted(E.PARTIAL)} END AS match_type,
    CASE WHEN len(exact) + len(loose) = 0 THEN {quoted(E.NO_TARGET)} ELSE concat(
      CASE WHEN len(exact) > 0 THEN concat('Raw identifier contains exact acceptable target: ''', exact[1], '''') ELSE concat('Normalized identifier contains normalized target tokens: [''', array_to_string({ident('loose[1]')}, ''', '''), ''']') END,
      CASE WHEN len(headings) = 0 THEN {quoted(E.NO_HEADINGS)} WHEN heading_match THEN {quoted(E.HEADING_OK)} ELSE {quoted(E.HEADING_BAD)} END) END AS reason
  FROM matched
), ranked AS (
  SELECT e.query_id, e.query, e.difficulty, e.category, coalesce(min(CASE WHEN match_type IN ({quoted(E.EXACT)}, {quoted(E.PARTIAL)}) THEN rank END), -1) AS first_hit_rank,
    coalesce(min(CASE WHEN match_type = {quoted(E.EXACT)} THEN rank END), -1) AS first_exact_rank, count(c.item_id) AS n
  FROM evaluated e LEFT JOIN classified c USING (query_id) GROUP BY 1, 2, 3, 4
), best AS (
  SELECT *, CASE WHEN n = 0 THEN {quoted(E.NO_MATCH)} WHEN first_exact_rank > 0 THEN {quoted(E.EXACT)} WHEN first_hit_rank > 0 THEN {quoted(E.PARTIAL)} ELSE {quoted(E.WRONG)} END AS best_match_type FROM ranked
)"""
_FIRST = "first_hit_rank"
MEASURES = (
    "count(*) AS n_queries, "
    + ", ".join(f"round(avg(CASE WHEN {_FIRST} BETWEEN 1 AND {k} THEN 1.0 ELSE 0.0 END), 6)::DOUBLE AS recall_at_{k}" for k in (1, 3, 5))
    + f", round(avg(CASE WHEN {_FIRST} > 0 THEN 1.0 / {_FIRST} ELSE 0.0 END), 6)::DOUBLE AS mrr"
)
RETRIEVAL = with_(BM25, EVAL)

ORACLE_SQL: dict[str, str] = {
    "url_normalize": with_(URLS) + "SELECT page_id, url, norm_url FROM normal",
    "url_filter_reason": with_(URLS, REASONS) + "SELECT page_id, norm_url, filter_reason FROM reasons",
    "url_filter_report": with_(URLS, REASONS) + "SELECT filter_reason, count(*) AS n FROM reasons WHERE filter_reason IS NOT NULL GROUP BY ROLLUP (filter_reason)",
    "file_names": with_(URLS) + r"""SELECT page_id, CASE WHEN regexp_replace(path, '^/+|/+$', '', 'g') = '' THEN 'index' ELSE replace(regexp_replace(path, '^/+|/+$', '', 'g'), '/', '_') END AS raw_name,
        translate(string_split(url, '://')[-1], '/.', '__') AS processed_name FROM normal""",
    "html_to_markdown": with_(MARK) + "SELECT page_id, md5(md) AS md_md5, length(md)::BIGINT AS n_chars FROM marked",
    "html_title_lang": with_(URLS, MARK) + rf"""SELECT m.page_id, lower(regexp_extract(html, '(?is)<html\b[^>]*\blang=["'']?([^"''\s>]+)', 1)) AS lang,
        CASE WHEN regexp_matches(md, '(?m)^# ') THEN {strip("replace(regexp_extract(md, '(?m)^(# .*)$', 1), '# ', '')")} ELSE string_split(regexp_replace(n.path, '/+$', ''), '/')[-1] END AS title
        FROM marked m JOIN normal n USING (page_id)""",
    "html_links": with_(URLS, MARK) + f"SELECT page_id, array_to_string(list_sort(list_distinct(links)), ' ') AS links FROM (SELECT m.page_id, {_RESOLVED.replace('url,', 'm.url,')} AS links FROM marked m JOIN normal n USING (page_id)) x",
    "crawl_pages": with_(MARK) + rf"""SELECT count(*) AS attempted, count_if(ok) AS crawled, count_if(NOT ok) AS failed, coalesce(sum(CASE WHEN ok THEN w END), 0)::BIGINT AS total_words, round(avg(CASE WHEN ok THEN w END), 6)::DOUBLE AS average_page_words
        FROM (SELECT (regexp_extract(lower(html), '<html[^>]*\blang=["'']?([^"''\s>]+)', 1) = '' OR starts_with(regexp_extract(lower(html), '<html[^>]*\blang=["'']?([^"''\s>]+)', 1), 'en')) AND md <> '' AS ok, len({words('md')})::BIGINT AS w FROM marked) x""",
    "crawl_bfs": f"""WITH RECURSIVE e AS ({EDGES}), walk AS (
        SELECT url, 0 AS depth FROM e WHERE n = 0 UNION SELECT t.url, w.depth + 1 FROM walk w JOIN e s ON s.url = w.url JOIN e t ON t.url IN (s.a, s.b) WHERE w.depth < 64
      ) SELECT url, CAST(min(depth) AS INTEGER) AS depth FROM walk GROUP BY url""",
    "sitemap_urls": with_(URLS) + "SELECT DISTINCT url FROM pages",
    "block_parse": ALL_BLOCKS + "SELECT doc, block_idx, md5(content) AS content_md5, content_hash, CASE WHEN is_code THEN 'code' WHEN is_heading THEN 'heading' WHEN is_table THEN 'table' WHEN is_list THEN 'list' ELSE 'text' END AS block_type FROM measured",
    "block_metrics": ALL_BLOCKS + "SELECT doc, block_idx, round(position_ratio, 6) AS position_ratio, word_count, round(unique_word_ratio, 6) AS unique_word_ratio, link_count, round(link_density, 6) AS link_density FROM measured",
    "repeated_blocks": ALL_BLOCKS + "SELECT content_hash, n_docs, round(n_docs * 100.0 / (SELECT count(*) FROM documents), 6)::DOUBLE AS percent FROM dfs ORDER BY n_docs DESC, content_hash LIMIT 100",
    "clean_scores": ALL_BLOCKS + "SELECT doc, block_idx, round(df, 6) AS document_frequency, round(score, 6) AS boilerplate_score, array_to_string(signals, ',') AS signals, tier > 0 AS is_removed FROM scored",
    "clean_removed": ALL_BLOCKS + f"SELECT doc, block_idx, translate(substr(content, 1, 100), chr(10), ' ') AS preview, {_case([(f'tier = {k}', quoted(t)) for k, t in enumerate(C.TIERS, 1)], 'NULL')} AS tier FROM scored WHERE tier > 0",
    "signal_report": ALL_BLOCKS + "SELECT count(*) AS total_blocks, " + ", ".join(f"count_if(list_contains(signals, '{x}')) AS {x}" for x in ("frequency_high", "frequency_med", "frequency_low", "link_density_high", "link_density_med", "edge_position", "info_density_low", "diversity_low", "context_penalty")) + " FROM scored",
    "signal_histogram": ALL_BLOCKS + "SELECT signal, count(*) AS n FROM (SELECT unnest(signals) AS signal FROM scored) x GROUP BY signal",
    "processing_stats": ALL_BLOCKS.rstrip() + ",\n" + PROCESSED + "SELECT *, round(CASE WHEN words_before > 0 THEN words_after * 100.0 / words_before ELSE 0 END, 6)::DOUBLE AS retention FROM processed",
    "page_category": ALL_BLOCKS.rstrip() + ",\n" + PROCESSED + "SELECT page_category, count(*) AS n_docs, CAST(sum(blocks_retained) AS BIGINT) AS blocks_retained FROM processed GROUP BY page_category",
    "corpus_report": ALL_BLOCKS.rstrip() + ",\n" + PROCESSED + """SELECT count(*) AS total_documents, CAST(sum(words_before) AS BIGINT) AS words_before, CAST(sum(words_after) AS BIGINT) AS words_after,
        round(sum(words_after) * 100.0 / sum(words_before), 6)::DOUBLE AS overall_retention, CAST(sum(code_blocks_after) - sum(code_blocks_before) AS BIGINT) AS code_diff, CAST(sum(tables_after) - sum(tables_before) AS BIGINT) AS table_diff,
        CAST(sum(blocks_removed) AS BIGINT) AS blocks_removed, round(sum(blocks_removed) * 100.0 / (sum(blocks_removed) + sum(blocks_retained)), 6)::DOUBLE AS removal_rate FROM processed""",
    "review_sample": ALL_BLOCKS.rstrip() + ",\n" + PROCESSED + """, picked AS (SELECT doc, page_category FROM (SELECT doc, page_category, row_number() OVER (PARTITION BY page_category ORDER BY md5(CAST(doc AS VARCHAR)), doc) AS r FROM processed) x WHERE r <= 4)
        SELECT p.doc, p.page_category, count_if(tier > 0) AS removed_count, least(count_if(tier > 0), 10) AS removed_shown, count_if(tier = 0 AND score >= 4) AS borderline_shown, least(count_if(tier = 0 AND score < 4), 5) AS preserved_shown
        FROM scored s JOIN picked p USING (doc) GROUP BY 1, 2""",
    "sections": with_(SECTIONS) + "SELECT doc, section, level, title, char_start, md5(content) AS content_md5 FROM sections",
    "heading_paths": with_(SECTIONS) + """SELECT h.doc, CAST(h.section AS INTEGER) AS section, string_agg(a.title, ' > ' ORDER BY a.pos) AS heading_path FROM heads h JOIN heads a ON a.doc = h.doc AND a.pos <= h.pos AND (a.level < h.level OR a.pos = h.pos)
        WHERE NOT EXISTS (SELECT 1 FROM heads b WHERE b.doc = h.doc AND b.pos > a.pos AND b.pos <= h.pos AND b.level <= a.level) GROUP BY h.doc, h.section""",
    "section_blocks": with_(SECTIONS, SECTION_BLOCKS) + "SELECT * FROM section_blocks",
    "token_estimate": f"SELECT doc_id, {_COUNT.format('text')} AS n_tokens FROM documents",
    "token_budget": f"""WITH t AS (SELECT doc_id, {_COUNT.format('text')} AS n FROM documents) SELECT doc_id, n <= 600 AS fits, greatest(0, 600 - n)::BIGINT AS remaining, n >= 600 AS should_start, least(125, n)::BIGINT AS overlap, 475::BIGINT AS new_content FROM t""",
    "word_counts": f"SELECT doc_id, len({words('text')})::BIGINT AS n_words FROM documents",
    "embed_validate_failed": """WITH e AS (SELECT CASE WHEN label <> 3 THEN embedding END AS v FROM embeddings)
        SELECT false AS is_valid, count(*) AS total, CAST(max(len(v)) AS INTEGER) AS dimensions, count_if(v IS NULL) AS null_vectors, count_if(list_dot_product(CAST(v AS DOUBLE[]), CAST(v AS DOUBLE[])) < 1e-5) AS zero_vectors, 'null vectors' AS reason FROM e""",
    "near_duplicate_report": """WITH v AS (SELECT vec_id, concat('section ', label) AS section, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)
        SELECT a.vec_id AS id_a, b.vec_id AS id_b, round(list_cosine_similarity(a.v, b.v), 4) AS similarity, a.section AS section_a, b.section AS section_b FROM v a JOIN v b ON a.vec_id < b.vec_id
        WHERE list_cosine_similarity(a.v, b.v) > 0.3 ORDER BY similarity DESC, id_a, id_b LIMIT 50""",
    "dense_topk_index": with_(DENSE) + "SELECT query_id, rank, item_id, score FROM dense WHERE rank <= 5",
    "embed_validate": "WITH n AS (SELECT len(embedding) AS d, list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])) AS q FROM embeddings) SELECT count(*) AS total, CAST(max(d) AS INTEGER) AS dimensions, count_if(q < 1e-5) AS zero_vectors, CASE WHEN count(*) = 0 THEN 'empty' WHEN min(d) <> 64 OR max(d) <> 64 THEN 'dimension mismatch' WHEN count_if(q < 1e-5) > 0 THEN 'zero vectors' END AS reason FROM n",
    "norm_audit": "WITH n AS (SELECT sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))) AS n FROM embeddings) SELECT count(*) AS total, count_if(n = 0) AS zero_vectors, count_if(n < 1e-5) AS near_zero_vectors, round(min(n), 4) AS min_norm, round(max(n), 4) AS max_norm, round(avg(n), 4) AS avg_norm, round(median(n), 4) AS median_norm, round(coalesce(stddev_samp(n), 0), 4) AS stdev_norm FROM n",
    "near_duplicates": "SELECT * FROM (SELECT a.vec_id AS id_a, b.vec_id AS id_b, round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 4) AS similarity FROM embeddings a JOIN embeddings b ON a.vec_id < b.vec_id WHERE list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) > 0.3) x ORDER BY similarity DESC, id_a, id_b LIMIT 100",
    "similarity_health": """WITH v AS (SELECT vec_id, label, label % 2 AS part, CAST(embedding AS DOUBLE[]) AS v FROM embeddings), q AS (SELECT * FROM v ORDER BY md5(CAST(vec_id AS VARCHAR)), vec_id LIMIT 100), p AS (
        SELECT CASE WHEN q.part <> v.part THEN 2 WHEN q.label = v.label THEN 0 ELSE 1 END AS b, list_cosine_similarity(q.v, v.v) AS s FROM q JOIN v ON q.vec_id <> v.vec_id)
        SELECT round(avg(CASE WHEN b = 0 THEN s END), 6) AS same_section, round(avg(CASE WHEN b = 1 THEN s END), 6) AS same_document, round(avg(CASE WHEN b = 2 THEN s END), 6) AS different_document, avg(CASE WHEN b = 0 THEN s END) >= avg(CASE WHEN b = 1 THEN s END) AND avg(CASE WHEN b = 1 THEN s END) >= avg(CASE WHEN b = 2 THEN s END) AS holds FROM p""",
    "bm25_topk": with_(BM25) + "SELECT * FROM sparse",
    "bm25_topk_index": with_(BM25) + "SELECT * FROM sparse",
    "dense_topk": with_(DENSE) + "SELECT query_id, rank, item_id, score FROM dense WHERE rank <= 5",
    "hybrid_rrf": with_(BM25, DENSE) + """SELECT query_id, rank, item_id, score FROM (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, item_id) AS INTEGER) AS rank FROM (
        SELECT query_id, item_id, round(sum(1.0::DOUBLE / (60 + rank)), 8) AS score FROM (SELECT query_id, item_id, rank FROM sparse UNION ALL SELECT query_id, item_id, rank FROM dense) u GROUP BY 1, 2) f) r WHERE rank <= 5""",
    "hybrid_rerank": with_(BM25.replace("rank <= 20", "rank <= 80"), DENSE.replace("rank <= 20", "rank <= 80")) + f"""SELECT query_id, rank, item_id, score FROM (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, item_id) AS INTEGER) AS rank FROM (
        SELECT s.query_id, s.item_id, round(len(list_filter(list_distinct({_TERMS.format('b.text')}), lambda t: list_contains(c.ts, t))) / len(list_distinct({_TERMS.format('b.text')}))::DOUBLE, 6) AS score
        FROM (SELECT query_id, item_id FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, item_id) AS r FROM (
          SELECT query_id, item_id, round(sum(1.0::DOUBLE / (60 + rank)), 8) AS score FROM (SELECT query_id, item_id, rank FROM sparse UNION ALL SELECT query_id, item_id, rank FROM dense) u GROUP BY 1, 2) g) h WHERE r <= 20) s
        JOIN benchmark b ON b.item_id = s.query_id JOIN corpus c ON c.item_id = s.item_id) f) r WHERE rank <= 5""",
    "rerank_lexical": with_(BM25) + f"""SELECT query_id, rank, item_id, score FROM (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, item_id) AS INTEGER) AS rank FROM (
        SELECT s.query_id, s.item_id, round(len(list_filter(list_distinct({_TERMS.format('b.text')}), lambda t: list_contains(c.ts, t))) / len(list_distinct({_TERMS.format('b.text')}))::DOUBLE, 6) AS score
        FROM sparse s JOIN benchmark b ON b.item_id = s.query_id JOIN corpus c ON c.item_id = s.item_id) f) r WHERE rank <= 5""",
    "match_classify": RETRIEVAL + "SELECT * FROM classified",
    "eval_ranks": RETRIEVAL + "SELECT query_id, CAST(first_hit_rank AS INTEGER) AS first_hit_rank, CAST(first_exact_rank AS INTEGER) AS first_exact_rank, best_match_type FROM best",
    "eval_metrics": RETRIEVAL + f"SELECT {MEASURES} FROM best",
    "eval_by_group": RETRIEVAL + f"SELECT 'all' AS dimension, 'all' AS value, {MEASURES} FROM best UNION ALL SELECT 'difficulty', difficulty, {MEASURES} FROM best GROUP BY difficulty UNION ALL SELECT 'category', category, {MEASURES} FROM best GROUP BY category",
    "eval_integrity": RETRIEVAL + "SELECT count(*) AS total, count(*) - count(DISTINCT query) AS repeated, count_if(len(targets) = 0) AS no_documents, count_if(expected_topic = '') AS no_topic, count_if(difficulty = '') AS no_difficulty, count_if(category = '') AS no_category, count_if(len(targets) = 0 OR expected_topic = '') = 0 AS ok FROM evaluated",
    "eval_evidence": RETRIEVAL + f"SELECT e.query_id, c.item_id, coalesce(c.match_type, {quoted(E.NO_MATCH)}) AS match_type, coalesce(c.matched_target, '') AS matched_target, coalesce(c.reason, '') AS reason FROM evaluated e LEFT JOIN (SELECT * FROM classified WHERE rank = 1) c USING (query_id)",
    "eval_review": RETRIEVAL + "SELECT query_id, best_match_type FROM (SELECT query_id, best_match_type, row_number() OVER (PARTITION BY best_match_type ORDER BY md5(CAST(query_id AS VARCHAR)), query_id) AS r FROM best) x WHERE r <= 5",
    "evalset_sample": f"SELECT doc_id FROM (SELECT doc_id, row_number() OVER (ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id) AS r FROM documents WHERE len({words('text')}) > 40) x WHERE r <= 20",
    "identifier_tokens": f"SELECT page_id, array_to_string({ident('url')}, ' ') AS ids, contains(' ' || array_to_string({ident('url')}, ' ') || ' ', ' example com ') AS has_run FROM pages",
    "heading_path_parse": f"WITH md AS ({MARKDOWN}) SELECT doc, concat(source, '/', lang) AS from_json, concat(source, '/', lang) AS from_text FROM md",
    "latest_version": "SELECT concat('v', max(n)) AS latest, concat('v', max(n) + 1) AS next FROM (SELECT CAST(replace(source, 'src', '') AS INTEGER) AS n FROM documents) x",
    "snippet": "SELECT doc_id, CASE WHEN length(text) > 300 THEN substr(text, 1, 300) || '...' ELSE text END AS snippet FROM documents",
    "json_fence_strip": f"SELECT doc_id, md5({strip('text')}) AS body_md5 FROM documents",
    "store_upsert": "SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'first' ELSE 'second' END AS batch FROM documents",
    "token_round_trip": "SELECT doc_id, true AS exact, coalesce(text, '') <> '' AS has_ids FROM documents",
    "metadata_flat": f"WITH md AS ({MARKDOWN}) SELECT doc, to_json([source, lang]) AS heading_path, title, url FROM md",
}
ORACLE_SQL["repeated_blocks_updated"] = ORACLE_SQL["repeated_blocks"]
