"""DuckDB SQL for the queries that SQL can express, by name."""

from __future__ import annotations

# What the rules say, written out again here: nothing of the code under test is imported (fixed values).
S = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
NS = S.replace("[", "[^", 1)
SCRIPT_RUN = r"[\x{4e00}-\x{9fff}]+|[a-zA-Z]+|\p{Nd}+"
DIGIT = r"[\p{Nd}\x{b2}\x{b3}\x{b9}\x{2070}\x{2074}-\x{2079}\x{2080}-\x{2089}\x{2460}-\x{2468}\x{2474}-\x{247c}\x{2488}-\x{2490}\x{24ea}\x{24f5}-\x{24fd}\x{24ff}\x{2776}-\x{277e}\x{2780}-\x{2788}\x{278a}-\x{2792}]"
CONTROL = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x9f]"
EMAIL = r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b"
NAV_TOKENS = ("概览", "学院新闻", "分页", "下一页", "上一页", "查看更多", "页面", "了解更多", "活动预告", "学院手册")
PAGE_NAV = ("登录|注册", "返回主站", "MENU", "首页>", "返回列表", "下一篇", "相关推荐", "CN|EN")
PAGE_NAV_TEXT = ("登录|注册CN|EN", "返回主站", "MENU", "返回", "招生网科研处")
PAGE_CATEGORIES = ("通知公告", "招生政策", "网上申请", "学费及住宿费", "常见问题", "招生活动")
PERSON_NAV = ("登录", "注册", "Sub Main", "My Portal", "校园生活", "招生", "就业指导", "校园地图", "版权所有", "粤ICP备")
PERSON_WORDS = ("教授", "讲席", "博士", "Distinguished Professor", "Nobel")
DESCRIPTIVE = (
    "研究", "research", "教育", "education", "背景", "background", "经历", "experience", "发表", "publication", "论文", "paper",
    "项目", "project", "课程", "course", "教学", "teaching", "简介", "introduction", "biography", "bio", "个人", "personal",
    "博士", "phd", "教授", "professor", "副教授", "associate", "学位", "degree", "学术", "academic", "领域", "field",
    "研究领域", "research area", "研究兴趣", "research interest", "教育背景", "educational background", "文学", "文学学士",
    "文学硕士", "艺术硕士", "学部分类", "创意", "剧本", "社交媒体", "语料库", "第二语言", "语言教学", "语言教育",
)
PAGE_PATTERNS = (
    rf"登录{S}*\|{S}*注册{S}*CN{S}*\|{S}*EN", "返回主站", "MENU", rf"首页{S}*>", "返回列表", "下一篇", "相关推荐", "招生网科研处",
    rf"返回{S}*$", rf"分页{S}*当前页", rf"页面{S}*\p{{Nd}}+", "上一页|下一页|末页|尾页",
)
PERSON_PATTERNS = (
    rf"登录{S}*\|{S}*注册", "Sub Main", "My Portal", "校园生活", "校园地图", "版权所有[^\n]+?粤公网安备", r"粤ICP备\p{Nd}+号",
    "上一页", "下一页", "末页", "尾页", rf"分页{S}*当前页",
)
LABELS = {"code": "课程代码", "title": "课程名称", "level": "学历层次", "school": "所属学院", "credits": "学分", "term": "开课学期", "category": "课程类别"}


def quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strip(c: str) -> str:
    return f"regexp_replace({c}, '^{S}+|{S}+\\z', '', 'g')"


def compact(c: str) -> str:
    return f"regexp_replace({c}, '{S}+', '', 'g')"


def count(c: str, pattern: str) -> str:
    return f"len(regexp_extract_all({c}, {quoted(pattern)}))"


def share(c: str, pattern: str) -> str:
    return f"(CASE WHEN length({c}) = 0 THEN 0.0 ELSE {count(c, pattern)} / length({c}) END)"


def hits(c: str, parts) -> str:
    return "(" + " + ".join(f"contains({c}, {quoted(p)})::INT" for p in parts) + ")"


def occurrences(c: str, part: str) -> str:
    return f"((length({c}) - length(replace({c}, {quoted(part)}, ''))) // {len(part)})"


def lines(c: str) -> str:
    return f"list_filter(list_transform(string_split({c}, chr(10)), lambda x: {strip('x')}), lambda x: x <> '')"


def acceptable(c: str, ascii_share: float, digit_share: float) -> str:
    bare = compact(c)
    return (
        f"(length({bare}) >= 120 AND {share(bare, '[\\x00-\\x7f]')} < {ascii_share} AND {share(bare, DIGIT)} < {digit_share} "
        f"AND NOT ({hits(c, NAV_TOKENS)} >= 5 AND length({c}) < 1000))"
    )


GOOD = acceptable("text", 0.97, 0.05)
FIRST = "SELECT *, row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) AS rank FROM documents"
RUNS = quoted(SCRIPT_RUN)
DENSITY = f"len(list_distinct(regexp_extract_all(text, {RUNS})))"
LONG = f"length({compact('text')}) >= 400"
OF_SOURCE = "row_number() OVER (PARTITION BY source, md5(text) ORDER BY doc_id)"


def page_reason() -> str:
    bare = strip("text")
    n = "len(ls)"
    nav = " + ".join(f"{len(p)} * {occurrences('text', p)}" for p in PAGE_NAV_TEXT)
    return f"""
SELECT doc_id, CASE
  WHEN length(bare) < 100 THEN 'short'
  WHEN {share('text', '\\x{fffd}')} > 0.03 THEN 'broken'
  WHEN contains(lower(text), ' actor') THEN 'pattern'
  WHEN {n} > 0 AND ({occurrences('text', '-')} + {occurrences('text', '*')} + {occurrences('text', '•')}) / greatest({n}, 1) > 0.8 AND length(bare) < 500 THEN 'list'
  WHEN {n} > 10 AND len(list_distinct(ls)) / greatest({n}, 1) < 0.3 THEN 'repeated'
  WHEN {hits('text', PAGE_NAV)} >= 5 OR ({nav}) / greatest(length(bare), 1) > 0.4 THEN 'navigation'
  WHEN {hits('text', PAGE_CATEGORIES)} >= 6 AND length(bare) < 400 THEN 'menu' END AS reason
FROM (SELECT doc_id, text, bare, {lines('bare')} AS ls FROM (SELECT doc_id, text, {bare} AS bare FROM documents))"""


def person_reason() -> str:
    return f"""
SELECT doc_id, CASE
  WHEN bare = '' THEN 'empty'
  WHEN length(bare) < 80 THEN 'short'
  WHEN {share('text', '\\x{fffd}')} > 0.03 THEN 'broken'
  WHEN {hits('text', PERSON_NAV)} >= 6 AND length(bare) < 800 THEN 'navigation'
  WHEN len(ls) >= 10 AND len(list_distinct(ls)) / greatest(len(ls), 1) < 0.25 THEN 'repeated' END AS reason
FROM (SELECT doc_id, text, bare, {lines('bare')} AS ls FROM (SELECT doc_id, text, {strip('text')} AS bare FROM documents))"""


def cleaned(patterns, least: int, runs: bool) -> str:
    c = "replace(text, chr(65533), '')"
    for p in patterns:
        c = f"regexp_replace({c}, {quoted('(?im)' + p)}, '', 'g')"
    c = f"regexp_replace({c}, '\\n{{3,}}', chr(10) || chr(10), 'g')"
    kept = "list_filter(ls, lambda x, i: NOT (i > 2 AND x = ls[i - 1] AND x = ls[i - 2]))" if runs else "ls"
    return f"""
WITH a AS (SELECT doc_id, {lines(c)} AS ls FROM documents),
b AS (SELECT doc_id, {kept} AS ls FROM a),
c AS (SELECT doc_id, list_filter(ls, lambda x, i: length(x) < {least} OR list_position(ls, x) = i) AS ls FROM b)
SELECT doc_id, {strip("regexp_replace(array_to_string(ls, chr(10)), ' {2,}', ' ', 'g')")} AS cleaned FROM c"""


def blank(c: str) -> str:
    return f"nullif({c}, '')"


COURSES = """courses AS (
  SELECT p_partkey AS part, CASE WHEN p_partkey % 5 <> 0 THEN 'CSC' || (1000 + p_partkey % 900) END AS code, CASE WHEN p_partkey % 7 <> 0 THEN p_name END AS title,
    CASE WHEN p_partkey % 3 = 0 THEN '' ELSE p_brand END AS level, p_type AS school, p_size::VARCHAR AS credits, '2' AS term,
    CASE WHEN p_partkey % 2 = 0 THEN 'major' END AS category, 'http://x' AS url, CASE WHEN p_partkey % 4 = 0 THEN 'about ' || p_name END AS description FROM part)"""
_labels = lambda names: ", ".join(f"{quoted(LABELS[n] + '：')} || {blank(n)}" for n in names)
ABOUT = f"chr(10) || {quoted('课程描述：')} || chr(10) || {blank('description')}"
CONTENT = f"{strip(f'concat_ws(chr(10) || chr(10), concat_ws(chr(10), {_labels(["code", "title", "level", "school", "credits", "term", "category"])}), {ABOUT})')}"
TITLE = f"coalesce(nullif(concat_ws('{{}}', {blank('code')}, {blank('title')}), ''), {quoted('未知课程')})"
PATH = "regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1)"
HOST = "regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)"
SEGMENTS = f"list_filter(string_split({PATH}, '/'), lambda x: x <> '')"
LISTING_FILES = " OR ".join(f"ends_with(lower(url), '{e}')" for e in (".pdf", ".doc", ".docx", ".xls", ".xlsx", ".zip", ".rar", ".jpg", ".jpeg", ".png", ".gif", ".mp4", ".mp3", ".exe"))
VECTOR = "(SELECT embedding::DOUBLE[] FROM embeddings WHERE vec_id = 0)"
SCORE = f"list_inner_product(embedding::DOUBLE[], {VECTOR})"
GRAPH = f"""
entities AS (SELECT label AS entity, arg_min(embedding, vec_id) AS embedding FROM embeddings GROUP BY label),
relations AS (SELECT vec_id AS relation, label AS src, (label + 1) % 10 AS dst, embedding, vec_id AS chunk_id FROM embeddings),
naive AS (SELECT vec_id AS chunk_id FROM embeddings ORDER BY {SCORE} DESC, vec_id LIMIT 3),
best_e AS (SELECT entity FROM entities ORDER BY {SCORE} DESC, entity LIMIT 3),
best_r AS (SELECT src, dst FROM relations ORDER BY {SCORE} DESC, relation LIMIT 3),
loc AS (SELECT DISTINCT chunk_id FROM relations WHERE src IN (SELECT entity FROM best_e) OR dst IN (SELECT entity FROM best_e)),
glo AS (SELECT DISTINCT chunk_id FROM relations WHERE (src, dst) IN (SELECT (src, dst) FROM best_r))
"""
CUT = quoted('……（内容已截断）')
PACKED = f"""
WITH RECURSIVE p AS (
  SELECT doc_id, list_filter(list_transform(string_split({strip("regexp_replace(regexp_replace(replace(replace(text, chr(10), chr(10) || chr(10)), chr(160), ' '), '[ \\t]+', ' ', 'g'), '\\n{2,}', chr(10) || chr(10), 'g')")}, chr(10) || chr(10)), lambda x: {strip('x')}), lambda x: x <> '') AS ps
  FROM documents
), w AS (
  SELECT doc_id, ps, 0 AS i, []::VARCHAR[] AS pieces, []::VARCHAR[] AS buffer, 0 AS used FROM p
  UNION ALL
  SELECT doc_id, ps, i + 1,
    CASE WHEN used + length(ps[i + 1]) <= 800 THEN pieces ELSE list_concat(CASE WHEN len(buffer) > 0 THEN list_append(pieces, array_to_string(buffer, chr(10) || chr(10))) ELSE pieces END,
      CASE WHEN length(ps[i + 1]) > 800 THEN list_transform(range(0, length(ps[i + 1]), 800), lambda k: substr(ps[i + 1], k::INT + 1, 800)) ELSE []::VARCHAR[] END) END,
    CASE WHEN used + length(ps[i + 1]) <= 800 THEN list_append(buffer, ps[i + 1]) WHEN length(ps[i + 1]) > 800 THEN []::VARCHAR[] ELSE [ps[i + 1]] END,
    CASE WHEN used + length(ps[i + 1]) <= 800 THEN used + length(ps[i + 1]) + 2 WHEN length(ps[i + 1]) > 800 THEN 0 ELSE length(ps[i + 1]) END
  FROM w WHERE i < len(ps)
), f AS (
  SELECT doc_id, CASE WHEN len(buffer) > 0 THEN list_append(pieces, array_to_string(buffer, chr(10) || chr(10))) ELSE pieces END AS pieces FROM w WHERE i = len(ps)
), u AS (SELECT doc_id, unnest(pieces) AS content, unnest(range(0, len(pieces))) AS piece_no FROM f)
SELECT doc_id, piece_no, length(content) AS n, md5(content) AS digest FROM u WHERE length(content) >= 30
"""

SEEN = "regexp_replace(html, '(?s)<!--.*?-->|<script>.*?</script>|<style>.*?</style>|<!DOCTYPE[^>]*>', '', 'g')"


def unescaped(c: str) -> str:
    for entity, character in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#x27;", "'"), ("&#39;", "'"), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")):
        c = f"replace({c}, {quoted(entity)}, {quoted(character)})"
    return c


def repaired(c: str) -> str:
    """Without a sequence that is UTF-8 read as Latin-1, nothing above ASCII survives the second reading."""
    plain = f"regexp_replace({c}, '[^\\x00-\\x7f]', '', 'g')"
    odd = f"regexp_matches(substr({c}, 1, 100), '[^\\x00-\\x7f\\x{{4e00}}-\\x{{9fff}}\\x{{3400}}-\\x{{4dbf}}]')"
    twice = f"regexp_matches({c}, '[\\x{{c2}}-\\x{{df}}][\\x{{80}}-\\x{{bf}}]')"
    return f"(CASE WHEN {twice} THEN 'not expected' WHEN length({c}) >= 10 AND {odd} AND length({plain}) > length({c}) * 0.5 THEN {plain} ELSE {c} END)"


def strings(html: str) -> str:
    """The texts between tags, a line each."""
    return f"array_to_string(list_filter(list_transform(regexp_split_to_array({html}, '<[^>]*>'), lambda x: {strip(unescaped('x'))}), lambda x: x <> ''), chr(10))"


LINKS = """links AS (
  SELECT page_id, base, unnest(hrefs) AS href, unnest(texts) AS text, unnest(range(0, len(hrefs))) AS pos FROM (
    SELECT page_id, regexp_extract(url, '^[a-z]+://[^/?#]*') AS base, regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1) AS hrefs, regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2) AS texts FROM pages)
)"""
DENSE = f"SELECT doc_id, density FROM (SELECT doc_id, {DENSITY} AS density FROM documents) ORDER BY density DESC, doc_id LIMIT (SELECT least(100, greatest(50, floor(count(*) * 0.3)))::BIGINT FROM documents)"
MESSAGE = """'{"role":"' || role || '","content":' || to_json(text)::VARCHAR || '}'"""

ORACLES = {
    "mojibake_repair": f"SELECT doc_id, {repaired('text')} AS repaired FROM documents",
    "smart_sample": f"SELECT doc_id, density FROM ({DENSE}) ORDER BY md5('42:' || doc_id), doc_id LIMIT 50",
    "seeded_sample": "SELECT doc_id FROM documents ORDER BY md5('42:' || doc_id), doc_id LIMIT 100",
    "chat_messages": f"""
        WITH said AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n FROM conversations WHERE role <> 'system'),
        lead AS (SELECT conv_id, string_agg(text, chr(10) || chr(10) ORDER BY turn) AS text FROM conversations WHERE role = 'system' GROUP BY conv_id),
        asked AS (SELECT conv_id, turn, n FROM said WHERE role = 'user' UNION ALL SELECT conv_id, turn, n FROM said WHERE n = 1 AND conv_id NOT IN (SELECT conv_id FROM said WHERE role = 'user')
          UNION ALL SELECT conv_id, min(turn), 1 FROM conversations WHERE conv_id NOT IN (SELECT conv_id FROM said) GROUP BY conv_id),
        ends AS (SELECT conv_id, turn, coalesce(lead(n) OVER (PARTITION BY conv_id ORDER BY n), 1000000000) AS stop FROM asked),
        parts AS (SELECT e.conv_id, e.turn, s.n, {MESSAGE} AS m FROM ends e JOIN said s ON s.conv_id = e.conv_id AND s.n < e.stop
          UNION ALL SELECT e.conv_id, e.turn, 0, {MESSAGE.replace("role || '", "'system' || '")} FROM ends e JOIN lead l ON l.conv_id = e.conv_id WHERE text <> '')
        SELECT conv_id, turn, '[' || string_agg(m, ',' ORDER BY n) || ']' AS messages FROM parts GROUP BY conv_id, turn""",
    "html_links": f"WITH {LINKS} SELECT page_id, pos, {strip('text')} AS text, base || href AS url FROM links",
    "frontier_anti_join": f"WITH {LINKS} SELECT DISTINCT base || href AS url FROM links WHERE base || href NOT IN (SELECT regexp_replace(regexp_replace(url, '(?s)#.*$', ''), '/+$', '') FROM pages)",
    "html_main": f"""
        WITH p AS (SELECT page_id, {SEEN} AS h FROM pages), t AS (SELECT page_id, {strings("regexp_extract(h, '(?s)<article>(.*?)(</article>|$)', 1)")} AS article, {strings("regexp_extract(h, '(?s)<body>(.*?)(</body>|$)', 1)")} AS body, {strings('h')} AS whole FROM p),
        c AS (SELECT page_id, CASE WHEN length(article) > 50 THEN article WHEN length(body) > 50 THEN body ELSE whole END AS content FROM t)
        SELECT page_id, content, {count('content', NS + '+')} AS word_count, '' AS meta_description FROM c""",
    "html_person": f"""
        SELECT page_id, 1 AS max_page, {strip(unescaped("regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)"))} AS name, regexp_extract({strings(SEEN)}, {quoted(EMAIL)}) AS email, NULL::VARCHAR AS site FROM pages""",
    "clean_documents": f"SELECT doc_id, source FROM ({FIRST}) WHERE rank = 1 AND {GOOD}",
    "clean_report_by_source": f"SELECT source, count(*) AS total, sum((rank = 1 AND {GOOD})::INT)::BIGINT AS kept, round(100.0 * sum((rank = 1 AND {GOOD})::INT) / count(*), 2)::DOUBLE AS kept_percent FROM ({FIRST}) GROUP BY source",
    "dedup_mark_before": f"SELECT doc_id, source FROM (SELECT *, {OF_SOURCE} AS rank FROM documents) WHERE rank = 1 AND {LONG}",
    "dedup_mark_after": f"SELECT doc_id, source FROM (SELECT *, {OF_SOURCE} AS rank FROM documents WHERE {LONG}) WHERE rank = 1",
    "quality_page": page_reason(),
    "quality_person": person_reason(),
    "clean_lines_page": cleaned(PAGE_PATTERNS, 10, True),
    "clean_lines_person": cleaned(PERSON_PATTERNS, 12, False),
    "control_strip": f"SELECT doc_id, regexp_replace(text, {quoted(CONTROL)}, '', 'g') AS stripped FROM documents",
    "word_counts": f"SELECT doc_id, {count('text', NS + '+')} AS words, {count('text', SCRIPT_RUN)} AS script_runs FROM documents",
    "info_density": f"SELECT doc_id, {DENSITY} AS density FROM documents",
    "density_candidates": DENSE,
    "truncate_marker": f"SELECT doc_id, CASE WHEN length(text) > 2800 THEN substr(text, 1, 2800) || {CUT} ELSE text END AS cut FROM documents",
    "head_tail_split": "SELECT doc_id, substr(text, 1, 2000) AS head, substr(text, 2001) AS tail FROM documents",
    "mostly_english": f"SELECT doc_id, coalesce(CASE WHEN l > 0 THEN l / (l + c) > 0.7 END, false) AS english FROM (SELECT doc_id, {count('text', '[a-zA-Z]')} AS l, {count('text', '[\\x{4e00}-\\x{9fff}]')} AS c FROM documents)",
    "person_prefilter": f"SELECT doc_id, length(text) >= 80 AND ({hits('text', PERSON_WORDS)} > 0 OR doc_id % 2 = 0) AS kept FROM documents",
    "minimal_page": f"SELECT doc_id, CASE WHEN len({lines('text')}) < 3 OR n < 15 THEN true WHEN {hits('lower(text)', DESCRIPTIVE)} > 0 THEN false ELSE n < 30 END AS minimal FROM (SELECT doc_id, text, {count('text', NS + '+')} AS n FROM documents)",
    "compact_squeeze": f"SELECT doc_id, length({compact('text')}) AS compact, {strip(f"regexp_replace(text, '{S}+', ' ', 'g')")} AS squeezed FROM documents",
    "index_text": "SELECT doc_id, '标题: ' || source || chr(10) || chr(10) || text AS indexed FROM documents",
    "token_estimate": "SELECT doc_id, length(text) // 4 AS embedding_tokens, length(text) // 2 AS chat_tokens FROM documents",
    "email_extract": f"SELECT doc_id, regexp_extract_all(text, {quoted(EMAIL)}) AS emails FROM documents",
    "interleave_sources": """
        WITH r AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS place, dense_rank() OVER (ORDER BY source) - 1 AS file_ordinal FROM documents)
        SELECT doc_id, source, file_ordinal, place, place // 2 AS round FROM r""",
    "resume_offsets": """
        WITH o AS (SELECT source, max(doc_id) // 2 AS line_offset FROM documents WHERE doc_id % 3 = 0 AND source <> 'src3' GROUP BY source)
        SELECT d.doc_id, d.source FROM documents d LEFT JOIN o USING (source) WHERE d.doc_id > coalesce(line_offset, 0)""",
    "round_robin_shards": "SELECT doc_id % 7 AS shard, count(*) AS n, min(doc_id) AS first FROM documents GROUP BY 1",
    "union_of_sources": "SELECT doc_id, source FROM documents",
    "anti_join_labels": "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "chunk_paragraphs": PACKED,
    "html_title": f"SELECT page_id, {strip(repaired('text'))} AS title FROM (SELECT page_id, {strip(unescaped("regexp_extract(html, '(?s)<title>(.*?)</title>', 1)"))} AS text FROM pages)",
    "url_functions": f"""
        SELECT page_id, regexp_replace(regexp_replace(url, '(?s)#.*$', ''), '/+$', '') AS normalised, regexp_extract(url, '^[^?#]*') AS bare,
          concat_ws('_', replace(lower({HOST}), '.', '_'), nullif(array_to_string({SEGMENTS}, '_'), '')) AS slug,
          CASE WHEN len({SEGMENTS}) = 0 THEN 'index' ELSE regexp_replace(array_to_string({SEGMENTS}, '_'), '[^\\p{{L}}\\p{{N}}_\\-.]', '_', 'g') END || CASE WHEN ends_with(array_to_string({SEGMENTS}, '_'), '.html') THEN '' ELSE '.html' END AS filename,
          greatest(len({SEGMENTS}) - 1, 0) AS depth,
          {HOST} IN ('therhe.example.org', 'ththan.example.com') AND NOT ({LISTING_FILES}) AND NOT regexp_matches(lower(regexp_extract(replace(url, '/en/', '/zh/'), '^[a-z]+://[^/?#]*([^?#]*)', 1)), '^/(en|event)(/|$)') AS crawlable
        FROM pages""",
    "url_valid": f"""
        WITH h AS (SELECT DISTINCT {HOST} AS h FROM pages)
        SELECT page_id, {HOST} IN (SELECT h FROM h) AND NOT ({LISTING_FILES}) AND NOT regexp_matches(lower({PATH}), '^/(en|event)(/|$)') AS valid FROM pages""",
    "site_tree": f"SELECT {SEGMENTS} AS path_segments, count(*) AS n FROM pages GROUP BY 1",
    "course_record_build": f"WITH {COURSES}, c AS (SELECT *, {CONTENT} AS content FROM courses) SELECT part, {TITLE.format(' - ')} AS title, content, {count('content', SCRIPT_RUN)} AS word_count FROM c",
    "course_record_flat": f"WITH {COURSES} SELECT part, {TITLE.format(' ')} AS title, concat_ws(chr(10), {_labels(['level', 'school', 'credits', 'term', 'category'])}, {quoted('课程链接：')} || url, {ABOUT}) AS content FROM courses",
    "course_dedup": f"""
        WITH {COURSES}, c AS (SELECT *, {CONTENT} AS content FROM courses),
        g AS (SELECT *, row_number() OVER (PARTITION BY coalesce({blank('code')}, {blank('title')}, url) ORDER BY part) AS rank FROM c
              WHERE length({compact('content')}) >= 60 AND NOT ({blank('code')} IS NULL AND {blank('description')} IS NULL) AND content <> '')
        SELECT part, code, title FROM g WHERE rank = 1""",
    "upsert_merge": """
        WITH l AS (SELECT p_brand AS scheme, 'CSC' || (1000 + p_partkey % 1000) AS code, p_partkey AS list_no, CASE WHEN p_partkey % 4 = 0 THEN p_name END AS name_en, CASE WHEN p_partkey % 3 = 0 THEN p_size END AS units FROM part WHERE p_size <= 30),
        r AS (SELECT *, row_number() OVER (PARTITION BY scheme, code ORDER BY list_no) AS nth FROM l),
        t AS (SELECT p_brand AS scheme, 'CSC' || (1000 + p_partkey % 1000) AS code, 1 AS nth, 'T ' || arg_min(p_name, p_partkey) AS name_en, arg_min(p_size, p_partkey) + 100 AS units FROM part WHERE p_size >= 20 OR p_size IS NULL GROUP BY 1, 2)
        SELECT coalesce(r.scheme, t.scheme) AS scheme, coalesce(r.code, t.code) AS code, CASE WHEN r.scheme IS NULL THEN 'elective' ELSE 'required' END AS course_type,
          coalesce(r.name_en, t.name_en) AS name_en, coalesce(nullif(r.units, 0), t.units, r.units)::BIGINT AS units
        FROM r FULL JOIN t ON r.scheme = t.scheme AND r.code = t.code AND r.nth = t.nth""",
    "table_sentences": """
        SELECT n_regionkey AS page_number, row_number() OVER (PARTITION BY n_regionkey ORDER BY lpad(n_nationkey::VARCHAR, 3, '0')) AS row_idx,
          's（f）第' || n_regionkey || '页表格：key：' || lpad(n_nationkey::VARCHAR, 3, '0') || '；列2：' || n_name AS content FROM nation""",
    "qa_prompt": f"""
        WITH c AS (SELECT doc_id, source, CASE WHEN length(t) > 2800 THEN substr(t, 1, 2800) || {CUT} ELSE t END AS t FROM (SELECT doc_id, source, {strip('text')} AS t FROM documents))
        SELECT doc_id, '标题：' || source || chr(10) || '链接：未知链接' || chr(10) || '正文（' || length(t) || ' 字）：' || chr(10) || t || chr(10) || chr(10)
          || '请仅依据正文写出 2 组问答，以 JSON 返回 {{"qas": [...]}}；材料不可用时返回 {{"skip": true, "reason": "..."}}。' AS prompt FROM c""".replace("{{", "{").replace("}}", "}"),
    "qa_response_validate": """
        SELECT doc_id, CASE WHEN doc_id % 6 = 0 THEN 'skip' WHEN doc_id % 6 IN (2, 4) THEN 'ok' ELSE 'error' END AS status, CASE WHEN doc_id % 6 = 0 THEN 'noise' END AS reason,
          CASE WHEN doc_id % 6 IN (2, 4) THEN 1 ELSE 0 END AS n, CASE doc_id % 6 WHEN 2 THEN 'q' WHEN 4 THEN 'q2' END AS question, CASE doc_id % 6 WHEN 2 THEN 'other' WHEN 4 THEN 'contact' END AS answer_type
        FROM documents""",
    "context_guard": """
        WITH c AS (SELECT doc_id, repeat(text, 8) AS t FROM documents),
        g AS (SELECT doc_id, CASE WHEN (1 + length(t)) // 2 > 900 AND length(t) > 1800 THEN substr(t, 1, 1800) || chr(10) || chr(10) || '[内容已截断...]' ELSE t END AS t FROM c)
        SELECT doc_id, length(t) AS n, substr(t, greatest(length(t) - 20, 1)) AS ending FROM g""",
    "naive_topk": f"SELECT vec_id, round({SCORE}, 6) AS score FROM embeddings ORDER BY {SCORE} DESC, vec_id LIMIT 10",
    "batch_topk_per_query": """
        WITH s AS (SELECT q.vec_id AS q_id, e.vec_id, list_inner_product(e.embedding::DOUBLE[], q.embedding::DOUBLE[]) AS s FROM embeddings e, embeddings q WHERE q.vec_id % 50 = 0),
        r AS (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY s DESC, vec_id) AS rank FROM s)
        SELECT q_id, vec_id, rank, round(s, 6) AS score FROM r WHERE rank <= 5""",
    "retrieve_naive": f"WITH {GRAPH} SELECT chunk_id FROM naive",
    "retrieve_local": f"WITH {GRAPH} SELECT chunk_id FROM loc",
    "retrieve_global": f"WITH {GRAPH} SELECT chunk_id FROM glo",
    "retrieve_hybrid": f"WITH {GRAPH} SELECT chunk_id FROM loc UNION SELECT chunk_id FROM glo",
    "retrieve_mix": f"WITH {GRAPH} SELECT chunk_id FROM loc UNION SELECT chunk_id FROM glo UNION SELECT chunk_id FROM naive",
    "retrieve_bypass": "SELECT vec_id AS chunk_id FROM embeddings WHERE false",
    "event_windows": "SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2",
}
