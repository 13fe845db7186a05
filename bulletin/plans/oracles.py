"""The catalog's queries in DuckDB SQL.

Written on their own terms (line windows instead of splits, joins instead of array
functions) so that agreement means something. Only the rule lists are shared.
"""

from __future__ import annotations

import datetime as dt
import re
from html.entities import html5

from bulletin import rules
from bulletin.functions.basics import CJK, DIGIT, FULLWIDTH_DIGITS, LINE_BREAK, WORD, WS, WS_CHARS
from bulletin.functions.dates import ANY_DATE, CLOCK, FULL_DATE, FULL_STAMP, LOOSE_FULL_STAMP, SHORT_DATE, SHORT_STAMP, SIGNAL
from bulletin.plans import inputs as I

ORACLES: dict[str, str] = {}
NL = "chr(10)"


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def trim(x: str) -> str:
    return f"trim({x}, {lit(WS_CHARS)})"


def first(x: str, pattern: str, group: int = 0) -> str:
    return f"nullif(regexp_extract({x}, {lit(pattern)}, {group}), '')"


def every(x: str, pattern: str, group: int = 0) -> str:
    return f"regexp_extract_all({x}, {lit(pattern)}, {group})"


def swap(x: str, pattern: str, to: str = "", flags: str = "g") -> str:
    return f"regexp_replace({x}, {lit(pattern)}, {lit(to)}, {lit(flags)})"


def hit(x: str, pattern: str) -> str:
    return f"regexp_matches({x}, {lit('(?i)' + pattern)})"


def any_of(x: str, words: list[str]) -> str:
    return "(" + " OR ".join(f"contains({x}, {lit(w)})" for w in words) + ")"


def any_of_ci(x: str, words: list[str]) -> str:
    return any_of(f"lower({x})", [w.lower() for w in words])


def collapse(x: str) -> str:
    return trim(swap(x, f"{WS}+", " "))


def count(x: str, pattern: str) -> str:
    return f"len({every(x, pattern)})"


def minute(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%dT%H:%M')"


def _stamp(matched: str, hour: int, minute_: int) -> str:
    n = every(f"translate({matched}, '{FULLWIDTH_DIGITS}', '0123456789')", "[0-9]+")
    pad = lambda x, w=2: f"lpad(CAST({x} AS VARCHAR), {w}, '0')"
    at = lambda i: f"({n})[{i}]"
    h = f"least(coalesce(CAST({at(4)} AS INT), {hour}), 23)"
    m = f"least(coalesce(CAST({at(5)} AS INT), {minute_}), 59)"
    return (
        f"try_cast({at(1)} || '-' || {pad(at(2))} || '-' || {pad(at(3))} || ' ' || {pad(h)} || ':' || {pad(m)} || ':00' AS TIMESTAMP)"
    )


def parsed(x: str) -> str:
    return _stamp(f"coalesce({first(x, FULL_STAMP)}, '2026年' || {first(x, SHORT_STAMP)})", 0, 0)


def parsed_eod(x: str) -> str:
    return _stamp(first(x, LOOSE_FULL_STAMP), 23, 59)


def inline(x: str) -> str:
    n = every(first(x, FULL_DATE), f"{DIGIT}+")
    return f"coalesce(({n})[1] || '-' || lpad(({n})[2], 2, '0') || '-' || lpad(({n})[3], 2, '0'), '')"


def publish_text(x: str) -> str:
    label = first(x, rf"(?:发布时间|发布日期|日期)[:：]{WS}*([^\n]+)", 1)
    return f"coalesce({trim(f'coalesce({label}, {first(x, FULL_DATE)}, {first(x, SHORT_DATE)})')}, '')"


def v(sql: str) -> str:
    return f"({I.for_duckdb(sql)})"


NOTICES, ARTICLES, REPORTS, DIGESTS = v(I.NOTICES), v(I.ARTICLES), v(I.REPORTS), v(I.DIGESTS)
DIRTY, DATE_TEXTS, LINKS, MARKED = v(I.DIRTY), v(I.DATE_TEXTS), v(I.LINKS), v(I.MARKED_ISSUES)
NOW, CUTOFF, GRACE = "TIMESTAMP '2026-04-20'", "TIMESTAMP '2026-04-13'", "TIMESTAMP '2026-04-19 12:00:00'"
UNITS = lambda x: f"({count(x, CJK)} + {count(x, WORD)})"


def add(name: str, sql: str) -> None:
    ORACLES[name] = sql


# --- sources -----------------------------------------------------------------

_LINES = f"""
 lines AS (SELECT doc_id, unnest(string_split_regex(text, {lit(LINE_BREAK)})) AS line,
   generate_subscripts(string_split_regex(text, {lit(LINE_BREAK)}), 1) AS n FROM {DIGESTS} d),
 marked AS (SELECT *, regexp_matches(line, '^# .*\\S') AS is_sec, regexp_matches(line, '^## .*\\S') AS is_item FROM lines),
 sec AS (SELECT *, CAST(sum(CAST(is_sec AS INT)) OVER (PARTITION BY doc_id ORDER BY n) AS BIGINT) AS section_ord FROM marked),
 itm AS (SELECT *, CAST(sum(CAST(is_item AS INT)) OVER (PARTITION BY doc_id, section_ord ORDER BY n) AS BIGINT) AS item_ord,
   coalesce(max(CASE WHEN is_sec THEN {trim('substr(line, 3)')} END) OVER (PARTITION BY doc_id, section_ord), '未分类') AS section FROM sec),
 items AS (SELECT doc_id, section, section_ord, item_ord, max(CASE WHEN is_item THEN {trim('substr(line, 4)')} END) AS title,
   {trim(f"coalesce(string_agg(CASE WHEN NOT is_item THEN line END, {NL} ORDER BY n), '')")} AS content
   FROM itm WHERE item_ord > 0 GROUP BY 1, 2, 3, 4)
"""
add("read_digest_items", f"WITH {_LINES} SELECT * FROM items")

_clean_url = lambda u: (
    f"CASE WHEN {u} LIKE '//%' THEN 'https:' || {u} WHEN {u} LIKE '/%' THEN 'https://mp.example.com' || {u} ELSE nullif({u}, '') END"
)
_json = lambda keys: "coalesce(" + ", ".join(f"nullif(r->>'$.{k}', '')" for k in keys) + ")"
_epoch = lambda t: (
    f"CASE WHEN regexp_matches({t}, '^[0-9]+$') THEN nullif(try_cast({t} AS BIGINT), 0) "
    f"WHEN regexp_matches({t}, '^[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}( [0-9]{{1,2}}:[0-9]{{1,2}}(:[0-9]{{1,2}})?)?$') "
    f"THEN CAST(epoch(try_cast(CASE WHEN regexp_matches({t}, ' [0-9]+:[0-9]+$') THEN {t} || ':00' ELSE {t} END AS TIMESTAMP)) AS BIGINT) END"
)
add(
    "normalize_articles",
    f"""WITH l AS (SELECT feed_id, account_keyword, CAST(coalesce(raw->'$.list', raw->'$.items', raw->'$.articles', raw->'$.rows') AS JSON[]) AS rs FROM {v(I.FEEDS)} f),
 e AS (SELECT feed_id, account_keyword, unnest(rs) AS r, generate_subscripts(rs, 1) - 1 AS ordinal FROM l),
 t AS (SELECT *, {_json(rules.FIELD_ALIASES['url'])} AS u, {_json(rules.FIELD_ALIASES['time'])} AS tt, r->>'$.aid' AS aid FROM e)
SELECT feed_id, ordinal, account_keyword, coalesce({_json(['title', 'name'])}, 'N/A') AS title, {_clean_url('u')} AS url,
 coalesce({_json(rules.FIELD_ALIASES['digest'])}, '') AS digest, {_epoch('tt')} AS publish_ts, aid,
 coalesce({_json(['mid', 'appmsgid'])}, nullif(split_part(aid, '_', 1), '')) AS mid,
 coalesce({_json(['idx', 'itemidx'])}, nullif(split_part(aid, '_', 2), '')) AS idx
FROM t WHERE u IS NOT NULL""",
)

_TOP1 = f"""(SELECT keyword, keyword_ord, fakeid FROM {v(I.ACCOUNT_CANDIDATES)} c
 WHERE pos = (SELECT min(pos) FROM {v(I.ACCOUNT_CANDIDATES)} d WHERE d.keyword = c.keyword) AND fakeid <> '')"""
add("top1_account", f"SELECT * FROM {_TOP1} t")
add("extract_main_content", r"SELECT page_id, regexp_extract(html, '(?i)<article[^>]*>([\s\S]*?)</article>', 1) AS main_html FROM pages")
add(
    "extract_page_meta",
    f"""SELECT page_id, CASE page_id % 3 WHEN 0 THEN '2026-04-' || (10 + page_id % 20) WHEN 1 THEN '2026-03-' || (10 + page_id % 20) ELSE '' END AS publish_time,
 CASE page_id % 4 WHEN 0 THEN '编辑' || page_id WHEN 1 THEN '小组' ELSE '' END AS author FROM {v(I.PAGE_META)} p""",
)
_plain = lambda x: (
    f"replace(replace(replace(replace(replace(replace(replace({x}, '&copy;', '©'), '&middot;', '·'), '&nbsp;', chr(160)), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&amp;', '&')"
)
add(
    "explode_links",
    rf"""WITH a AS (SELECT page_id, url, regexp_extract_all(html, '(?i)<a\b[^>]*>[\s\S]*?</a>') AS ls FROM pages),
 b AS (SELECT page_id, url, unnest(ls) AS link, generate_subscripts(ls, 1) AS pos FROM a),
 c AS (SELECT page_id, url, pos, {trim('regexp_extract(link, ' + lit('(?i)^<a[^>]*' + chr(92) + 's+href="([^"]*)"') + ', 1)')} AS href, {collapse(_plain(swap('link', '<[^>]+>')))} AS text FROM b)
SELECT page_id, pos, text, href, CASE WHEN regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN href WHEN href LIKE '/%' THEN regexp_extract(url, '^[a-z]+://[^/?#]*') || href END AS link_url,
 coalesce({first('text', FULL_DATE)}, '') AS list_date FROM c WHERE href <> ''""",
)
add("payload_html", f"SELECT page_id, {trim('html')} AS html FROM pages")
add(
    "ocr_payload_text",
    f"""SELECT conv_id, turn, CASE WHEN turn % 5 = 4 THEN '' ELSE role || ' ' || conv_id || {NL} || '第' || turn || '行' END AS text FROM conversations""",
)
add(
    "event_listing",
    """SELECT c_custkey AS page_id, 1 AS ordinal, '2026-04-' || (1 + c_custkey % 28) || ' 19:30' AS date, c_name AS title, '剧场' || c_nationkey AS location,
 (c_custkey % 9) || '0' AS price, 'https://hall.example.com/img/' || c_custkey || '.png' AS absolute_src FROM customer
UNION ALL SELECT c_custkey, 2, 'N/A', 'Second', 'N/A', 'N/A', 'https://hall.example.com/list/b.png' FROM customer""",
)
add(
    "first_nonempty_feed",
    f"SELECT feed_group, event_id, prio FROM (SELECT *, min(prio) OVER (PARTITION BY feed_group) AS best FROM {v(I.FEED_GROUPS)} g) x WHERE prio = best",
)
add(
    "load_preferences",
    """SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN '教务通知' WHEN 1 THEN '物理系学术报告' WHEN 2 THEN '图书馆信息' WHEN 3 THEN '家园网信息' ELSE '其他公众号信息' END AS section,
 '样例 ' || doc_id AS title, least(100, CASE doc_id % 3 WHEN 0 THEN doc_id % 140 WHEN 1 THEN doc_id % 90 ELSE doc_id % 101 END) AS score,
 CASE WHEN doc_id % 4 = 0 THEN '说明' || doc_id WHEN doc_id % 3 = 0 THEN '备注' || doc_id ELSE '' END AS reason FROM documents""",
)
add(
    "issue_ts_from_path",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 AND o_orderkey % 7 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') || 'T08:30' END AS issue_ts FROM orders""",
)

# --- filters -----------------------------------------------------------------

_days = lambda x: (
    f"SELECT notice_id, CAST({parsed('d')} AS DATE) AS day FROM (SELECT notice_id, unnest(list_concat({every(x, LOOSE_FULL_STAMP)}, {every(x, SHORT_STAMP)})) AS d FROM {NOTICES} n) u"
)
_RECENCY = f"""days AS ({_days('content')}), agg AS (SELECT notice_id, bool_or(day >= DATE '2026-04-20') AS ahead FROM days WHERE day IS NOT NULL GROUP BY 1),
 p0 AS (SELECT *, {publish_text('content')} AS raw FROM {NOTICES} n), p AS (SELECT *, {parsed('raw')} AS at_ FROM p0),
 recency AS (SELECT p.*, CASE WHEN at_ IS NULL THEN 'no_parseable_publish_date_keep' WHEN at_ >= {CUTOFF} THEN 'publish_recent'
   WHEN coalesce(ahead, false) THEN 'publish_old_but_effective' ELSE 'publish_older_than_cutoff' END AS reason,
   coalesce({minute('at_')}, raw) AS basis FROM p LEFT JOIN agg USING (notice_id))"""
add("publish_recency", f"WITH {_RECENCY} SELECT notice_id, reason <> 'publish_older_than_cutoff' AS keep, reason, basis FROM recency")
add(
    "write_decisions",
    f"""WITH {_RECENCY} SELECT section, CASE WHEN reason <> 'publish_older_than_cutoff' THEN 'kept' ELSE 'dropped' END AS status, reason, count(*) AS records FROM recency GROUP BY 1, 2, 3""",
)
add("write_items", f"SELECT notice_id, section, title, content FROM {NOTICES} n")
add(
    "publish_prefilter",
    """SELECT event_id, ts IS NULL OR ts >= TIMESTAMP '2024-01-15' AS keep, CASE WHEN ts IS NULL THEN 'publish_time_missing_keep_for_review'
 WHEN ts >= TIMESTAMP '2024-01-15' THEN 'publish_recent' ELSE 'publish_older_than_cutoff' END AS reason FROM events""",
)


def signal_rows(source: str, text: str, fallback: str | None = None) -> str:
    """CTEs ending in sig(notice_id, line_no, pos, kind, raw, parsed, context)."""
    parts = f"string_split_regex({text}, {lit(LINE_BREAK)})"
    explicit = f"regexp_matches(raw, {lit(CLOCK)})"
    extra = (
        f" UNION ALL SELECT notice_id, 2147483647, 1, 'publish', {fallback}, {parsed(fallback)}, 'fallback_publish_date' FROM {source} s WHERE {fallback} <> ''"
        if fallback
        else ""
    )
    return f"""ln AS (SELECT notice_id, unnest({parts}) AS l0, generate_subscripts({parts}, 1) AS line_no FROM {source} s),
 lk AS (SELECT notice_id, line_no, {trim('l0')} AS line FROM ln WHERE regexp_matches(l0, {lit(ANY_DATE)})),
 kinds AS (SELECT *, CASE WHEN {any_of_ci('line', rules.DEADLINE_WORDS)} THEN 'deadline' WHEN {any_of_ci('line', rules.PUBLISH_WORDS)} THEN 'publish'
   WHEN {any_of_ci('line', rules.EVENT_WORDS)} THEN 'event' ELSE 'mentioned' END AS kind FROM lk),
 raws AS (SELECT *, unnest({every('line', SIGNAL)}) AS raw0, generate_subscripts({every('line', SIGNAL)}, 1) AS pos FROM kinds),
 rawt AS (SELECT *, {trim('raw0')} AS raw FROM raws), rawp AS (SELECT *, {parsed('raw')} AS p0 FROM rawt),
 sig AS (SELECT notice_id, line_no, pos, kind, raw, CASE WHEN kind IN ('deadline', 'event') AND NOT {explicit}
   THEN date_trunc('day', p0) + INTERVAL '23 hours 59 minutes' ELSE p0 END AS parsed, substr(line, 1, 180) AS context FROM rawp{extra})"""


def relevance(source: str, text: str, fallback: str | None) -> str:
    """CTEs ending in rel: the source rows with reason, keep and basis."""
    return f"""{signal_rows(source, text, fallback)},
 lat AS (SELECT notice_id, max(parsed) FILTER (WHERE kind = 'deadline') AS dl, max(parsed) FILTER (WHERE kind = 'event') AS ev,
   max(parsed) FILTER (WHERE kind = 'publish') AS pu FROM sig GROUP BY 1),
 rel0 AS (SELECT s.*, CASE WHEN dl IS NOT NULL THEN CASE WHEN dl >= {NOW} THEN 'deadline_active' ELSE 'deadline_expired' END
   WHEN ev IS NOT NULL THEN CASE WHEN ev >= {GRACE} THEN 'event_active' ELSE 'event_expired' END
   WHEN pu IS NOT NULL THEN CASE WHEN pu >= {CUTOFF} THEN 'publish_recent' ELSE 'publish_older_than_cutoff' END
   ELSE 'no_parseable_date_keep' END AS reason, coalesce(dl, ev, pu) AS basis FROM {source} s LEFT JOIN lat USING (notice_id)),
 rel AS (SELECT *, reason NOT IN ('deadline_expired', 'event_expired', 'publish_older_than_cutoff') AS keep FROM rel0)"""


_TEXT = f"title || {NL} || content"
add(
    "temporal_relevance",
    f"WITH {relevance(NOTICES, _TEXT, inline('content'))} SELECT notice_id, keep, reason, {minute('basis')} AS basis FROM rel",
)


def rule(title: str, snippet: str) -> str:
    t = f"({title} || ' ' || {snippet})"
    return f"CASE WHEN {any_of(t, rules.FORCE_NO_WORDS)} THEN false WHEN {any_of(t, rules.FORCE_YES_WORDS)} THEN true END"


_RULE = rule("title", "content")
add("keyword_rules", f"SELECT notice_id, {_RULE} AS decision FROM {NOTICES} n")
_ASKED = f"(SELECT n.*, {_RULE} AS r, quality = 1 AS m FROM {NOTICES} n LEFT JOIN labels ON doc_id = notice_id)"
add(
    "copy_decision",
    f"SELECT notice_id, coalesce(r, m, true) AS keep, CASE WHEN r IS NOT NULL THEN 'keyword_rule' WHEN m THEN 'llm_yes' WHEN NOT m THEN 'llm_no' ELSE 'undecided_default' END AS reason FROM {_ASKED} x",
)
add(
    "mark_items",
    f"SELECT notice_id, coalesce(r, m, false) AS keep, CASE WHEN r IS NOT NULL THEN 'keyword_rule' WHEN m IS NOT NULL THEN 'llm' ELSE 'fallback_drop' END AS reason FROM {_ASKED} x",
)
add("visible_counts", f"SELECT account, count(*) FILTER (WHERE coalesce(r, m, true)) AS visible, count(*) AS total FROM {_ASKED} x GROUP BY 1")


def dropped(cond: str, reason: str, source: str, kept_reason: str = "crawler_selected") -> str:
    return f"SELECT notice_id, NOT ({cond}) AS keep, CASE WHEN {cond} THEN {lit(reason)} ELSE {lit(kept_reason)} END AS reason FROM {source} s"


add("title_blacklist", dropped(any_of("title", ["音乐会预热", "数据库"]), "site_blacklist", NOTICES))
_REPORT_WORDS = list(dict.fromkeys(rules.REPORT_WORDS + rules.REPORT_WORDS_DEFAULT))
_like = lambda x: f"(NOT {any_of_ci(x, rules.REPORT_EXCLUDE_WORDS)} AND {any_of_ci(x, _REPORT_WORDS)})"
_other = any_of_ci(f"(title || {NL} || substr(content, 1, 600))", rules.REPORT_EXCLUDE_WORDS + rules.NON_REPORT_PAGE_WORDS)
add(
    "report_classifier",
    f"SELECT notice_id, {_like('title')} AND NOT {_other} AS keep, CASE WHEN NOT {_like('title')} THEN 'not_report_like' WHEN {_other} THEN 'non_report_page' ELSE 'list_item' END AS reason FROM {REPORTS} r",
)
add(
    "report_keep",
    dropped(f"NOT (notice_id % 3 = 0 OR {any_of_ci('content', rules.REPORT_PLACES)} OR {_like('substr(content, 1, 200)')})", "copy_decision_false", REPORTS),
)
add("any_keyword", dropped(f"NOT {any_of_ci('title', rules.TEACHING_WORDS)}", "title_filter", NOTICES))
add("label_equals", dropped("notice_id % 3 <> 0", "other_label", NOTICES))
add(
    "url_guard",
    """SELECT page_id AS notice_id, page_id % 10 <> 0 AND contains(url, 'example.com') AS keep,
 CASE WHEN page_id % 10 = 0 THEN 'missing_url' WHEN NOT contains(url, 'example.com') THEN 'foreign_host' ELSE 'list_item' END AS reason FROM pages""",
)
_labelled_at = "coalesce(" + ", ".join(parsed_eod(first("content", rf"{label}[：:]{WS}*([^\n]+)", 1)) for label in rules.EVENT_LABELS) + ")"
_EVENTS_AT = f"(SELECT r.*, {_labelled_at} AS event_at FROM {REPORTS} r)"
add(
    "expired_event",
    f"SELECT notice_id, coalesce(event_at >= {GRACE}, true) AS keep, CASE WHEN event_at < {GRACE} THEN 'expired_physics_event' ELSE 'event_open' END AS reason, {minute('event_at')} AS event_at FROM {_EVENTS_AT} x",
)
add("older_than_cutoff", f"SELECT notice_id, coalesce({parsed('text')} < {CUTOFF}, false) AS older FROM {DATE_TEXTS} d")
add("next_week_window", f"SELECT notice_id, publish_date > DATE '2026-04-20' AND publish_date < DATE '2026-04-27' AS in_window FROM {NOTICES} n")
add(
    "drop_placeholder",
    f"""SELECT notice_id, reason = 'selectable' AS keep, reason FROM (SELECT notice_id, CASE WHEN notice_id % 11 = 0 THEN 'placeholder' WHEN notice_id % 13 = 0 THEN 'empty_title'
 WHEN notice_id % 7 = 0 THEN 'empty_body' ELSE 'selectable' END AS reason FROM {NOTICES} n) x""",
)

# --- joins -------------------------------------------------------------------

add(
    "accounts_articles",
    f"SELECT t.keyword, t.keyword_ord AS account_ord, a.fakeid, a.ordinal, a.title FROM {ARTICLES} a JOIN {_TOP1} t USING (fakeid)",
)
_key = lambda x: f"lower({swap(x, WS + chr(124) + '[' + chr(92) + '[' + chr(92) + '](){}、，,：:|?/' + chr(92) * 2 + chr(92) + '-]')})"
add(
    "previous_issue_anti",
    f"SELECT notice_id, title_key FROM (SELECT notice_id, {_key('title')} AS title_key FROM {NOTICES} n) x WHERE notice_id % 10 <> 3",
)


def rule_points(title: str, content: str) -> str:
    t = f"({title} || {NL} || {content})"
    total = " + ".join([str(rules.BASE_SCORE)] + [f"CASE WHEN {hit(t, p)} THEN {n} ELSE 0 END" for n, p in rules.SCORE_RULES])
    return f"greatest(0, least(100, {total}))"


def guardrails(source: str) -> str:
    """CTEs from source(notice_id, section, title, content, score, reason) to guarded."""
    t, head = f"(title || {NL} || content)", f"(title || {NL} || substr(content, 1, 600))"
    lib = f"section = {lit(rules.LIBRARY_SECTION)}"
    steps = [
        ("cap_general_culture_lecture", hit(t, rules.CULTURE), "least", "20"),
        ("cap_general_activity", hit(t, rules.ACTIVITY), "least", "35"),
        ("cap_publicity", hit(t, rules.PUBLICITY), "least", "25"),
        ("cap_non_undergrad", f"{hit(t, rules.NON_UNDERGRAD)} AND NOT {hit(t, rules.UNDERGRAD)}", "least", "10"),
        ("floor_physics_report", f"section = {lit(rules.REPORT_SECTION)} OR {hit('title', rules.REPORT_TITLE)}", "greatest", "80"),
        (
            "floor_actionable_training",
            f"NOT {hit(t, rules.PUBLICITY)} AND NOT {hit('title', rules.SHOWCASE)} AND {hit(t, rules.TRAINING)} AND {hit(head, rules.TRAINING_STAGE)}",
            "greatest", "55",
        ),
        ("floor_life_impact", hit(head, rules.LIFE), "greatest", "45"),
        ("floor_lib_service_impact", f"{lib} AND {hit(t, rules.LIB_SERVICE)}", "greatest", "90"),
        ("cap_lib_weak_topic", f"{lib} AND {hit(t, rules.LIB_WEAK)}", "least", "15"),
        ("cap_lib_research_tool", f"{lib} AND {hit('title', rules.LIB_TOOL)}", "least", "20"),
        ("cap_lib_research_tool", f"{lib} AND {hit('title', rules.LIB_WRITING)}", "least", "30"),
        ("cap_expired_activity", f"{lib} AND past", "least", expired("title", "content")),
    ]
    ctes = [
        f"gdays AS (SELECT notice_id, CAST({parsed('d')} AS DATE) AS day FROM (SELECT notice_id, unnest(list_concat({every(t, LOOSE_FULL_STAMP)}, {every(t, SHORT_STAMP)})) AS d FROM {source} s) u)",
        "gpast AS (SELECT notice_id, bool_and(day < DATE '2026-04-20') AS past0 FROM gdays WHERE day IS NOT NULL GROUP BY 1)",
        f"g0 AS (SELECT s.*, coalesce(past0, false) AS past, score AS adj, CAST([] AS VARCHAR[]) AS tg FROM {source} s LEFT JOIN gpast USING (notice_id))",
    ]
    for i, (tag, cond, move, bound) in enumerate(steps, start=1):
        ctes.append(
            f"g{i} AS (SELECT * REPLACE (CASE WHEN {cond} THEN {move}(adj, {bound}) ELSE adj END AS adj, CASE WHEN {cond} THEN list_append(tg, '{tag}') ELSE tg END AS tg) FROM g{i - 1})"
        )
    note = "'score_guardrail=' || array_to_string(tg, ',')"
    ctes.append(
        f"guarded AS (SELECT * REPLACE (greatest(0, least(100, adj)) AS score, CASE WHEN len(tg) = 0 THEN {trim('reason')} ELSE substr(concat_ws('；', nullif({trim('reason')}, ''), {note}), 1, 180) END AS reason),"
        f" array_to_string(tg, ',') AS tags FROM g{len(steps)})"
    )
    return ", ".join(ctes)


def expired(title: str, content: str) -> str:
    return f"CASE WHEN {hit(title, rules.LIB_WRITING)} THEN 20 WHEN {hit(title, rules.LIB_TOOL)} THEN 15 WHEN {hit(f'({title} || {NL} || {content})', rules.LIB_WEAK)} THEN 10 ELSE 12 END"


_SCORED = f"(SELECT n.*, {rule_points('title', 'content')} AS score, 'fallback_keyword_score' AS reason FROM {NOTICES} n)"
_INDEXED = f"(SELECT *, row_number() OVER (PARTITION BY section ORDER BY ordinal) AS item_index FROM {_SCORED} y)"
_REPLIES = """(SELECT CASE doc_id % 5 WHEN 0 THEN '教务通知' WHEN 1 THEN '物理系学术报告' WHEN 2 THEN '图书馆信息' WHEN 3 THEN '家园网信息' ELSE '其他公众号信息' END AS section,
 CAST(floor(doc_id / 5) AS BIGINT) + 1 AS item_index, quality * 80 AS score, CASE WHEN doc_id % 3 = 0 THEN 'llm_score' ELSE '模型' END AS reason FROM labels)"""
_APPLIED = f"(SELECT i.* REPLACE (coalesce(r.score, i.score) AS score, coalesce(r.reason, i.reason) AS reason) FROM {_INDEXED} i LEFT JOIN {_REPLIES} r USING (section, item_index))"
add("score_responses", f"SELECT section, item_index, score, reason FROM {_REPLIES} r")
add("apply_scores", f"SELECT notice_id, section, item_index, score, reason FROM {_APPLIED} a")
add("scored_items", f"WITH {guardrails(_APPLIED)} SELECT notice_id, score, reason FROM guarded")
_LEAD = lambda s, n: (
    f"CASE WHEN {n} = 0 THEN {lit(rules.EMPTY_LEAD)} ELSE CASE {s} " + " ".join(f"WHEN {lit(k)} THEN {lit(t)}" for k, t in rules.SECTION_LEADS.items()) + f" ELSE {lit(rules.GENERIC_LEAD)} END END"
)


def names(values: list[str]) -> str:
    return "(SELECT * FROM (VALUES " + ", ".join(f"({lit(x)}, {i})" for i, x in enumerate(values, start=1)) + ") s(section, section_ord))"


ISSUE_NAMES = ["教务通知", "物理系学术报告", "图书馆信息", "家园网信息", "其他公众号信息", "学生会信息"]
ISSUE = names(ISSUE_NAMES)
add(
    "section_leads",
    f"SELECT section, items, {_LEAD('section', 'items')} AS lead FROM (SELECT s.section, count(n.notice_id) AS items FROM {ISSUE} s LEFT JOIN {NOTICES} n USING (section) GROUP BY 1) x",
)
_EXAMPLES = f"""(SELECT section, substr({lit(rules.EXAMPLES_HEAD)} || {NL} || string_agg('- ' || title || ' => ' || (quality * 60 + toxic * 7) || '/100' || CASE WHEN toxic = 1 THEN '；不当' ELSE '' END, {NL} ORDER BY ordinal), 1, 3200) AS examples
 FROM {NOTICES} n JOIN labels ON doc_id = notice_id GROUP BY 1)"""
add("example_digest", f"SELECT section, examples FROM {_EXAMPLES} e")
add("section_preferences", f"SELECT notice_id, length(examples) AS example_chars, md5(examples) AS example_md5 FROM {NOTICES} n LEFT JOIN {_EXAMPLES} e USING (section)")


def _image(i: int) -> str:
    return (
        f"CASE WHEN (notice_id + {i}) % 4 < 2 THEN '![图片{i}](https://e.com/' || notice_id || '_{i}.png)' WHEN (notice_id + {i}) % 5 = 0 THEN '' "
        f"ELSE '[图片文字 {i}] 图文 ' || notice_id END"
    )


add(
    "image_annotations",
    f"SELECT notice_id, {trim(swap(f'{_image(1)} || repeat({NL}, 4) || content || {NL} || {_image(2)} || {lit('中末')}', chr(92) + 'n{3,}', chr(10) * 2))} AS content FROM {NOTICES} n",
)
add(
    "stage_errors",
    f"""SELECT section, '占位卡片' AS title, '本次抓取未成功。' || {NL} || {NL} || '原因: ' || arg_min(trim(error), stage_ord) AS content
 FROM {v(I.STAGE_ERRORS)} e JOIN (VALUES ('crawl_info', '教务通知'), ('crawl_myhome', '家园网信息'), ('crawl_lib', '新清华学堂')) t(stage, section) USING (stage)
 WHERE trim(error) <> '' AND section NOT IN (SELECT section FROM {NOTICES} n) GROUP BY 1""",
)

# --- dedup -------------------------------------------------------------------


def canonical(u: str, ignore: list[str]) -> str:
    q = f"coalesce(regexp_extract({u}, '^[^?#]*\\?([^#]*)', 1), '')"
    dec = lambda x: f"url_decode(replace({x}, '+', ' '))"
    pairs = (
        f"list_filter(list_transform(list_filter(string_split({q}, '&'), lambda p: regexp_matches(p, '^[^=]*=.')), "
        f"lambda p: {{'k': {dec('split_part(p, chr(61), 1)')}, 'v': {dec('substr(p, strpos(p, chr(61)) + 1)')}}}), lambda p: p.k NOT IN ({', '.join(lit(k) for k in ignore)}))"
    )
    enc = lambda x: f"replace(url_encode({x}), '%20', '+')"
    firsts = (
        f"list_transform(list_sort(list_distinct(list_transform({pairs}, lambda p: p.k))), "
        f"lambda k: {enc('k')} || '=' || {enc(f'list_filter({pairs}, lambda p: p.k = k)[1].v')})"
    )
    query = f"array_to_string({firsts}, '&')"
    scheme = f"lower(regexp_extract({u}, '^([A-Za-z][A-Za-z0-9+.-]*:)', 1))"
    host = f"regexp_extract({u}, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(//[^/?#]*)', 1)"
    path = f"regexp_extract({u}, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)', 1)"
    return f"({scheme} || {host} || {path} || CASE WHEN {query} <> '' THEN '?' || {query} ELSE '' END)"


_KEYED = f"(SELECT *, CASE WHEN mid <> '' AND idx <> '' THEN mid || ':' || idx ELSE {canonical('url', rules.TRACKING_KEYS)} END AS dedupe_key FROM {ARTICLES} a)"
add("dedupe_articles", f"SELECT min(ordinal) AS ordinal, dedupe_key FROM {_KEYED} k GROUP BY 2")
add(
    "dedupe_urls",
    f"""SELECT notice_id, keep, CASE WHEN keep THEN 'list_item' ELSE 'duplicate_url' END AS reason FROM (SELECT notice_id,
 notice_id % 50 = 0 OR row_number() OVER (PARTITION BY notice_id % 50 = 0, notice_id % 30 ORDER BY ordinal) = 1 AS keep FROM {ARTICLES} a) x""",
)
add(
    "merge_by_title",
    f"""SELECT title, count(*) AS n_dates, arg_max(location, ordinal) AS location, arg_max(price, ordinal) AS price,
 arg_max(absolute_src, ordinal) AS absolute_src FROM {v(I.HALL)} h GROUP BY 1""",
)
add("title_dates", f"SELECT title, date, -ordinal AS place FROM {v(I.HALL)} h")
add(
    "event_blocks",
    f"""WITH h AS (SELECT *, max(ordinal) OVER (PARTITION BY title) AS last_at, count(*) OVER (PARTITION BY title) AS n FROM {v(I.HALL)} x)
 SELECT title, last_at AS ordinal, 0 AS part, 0 AS place, '## ' || title || {NL} || {NL} || '日期:' AS text FROM h WHERE ordinal = last_at AND n > 1
 UNION ALL SELECT title, last_at, 1, -ordinal, CASE WHEN n = 1 THEN '## ' || title || {NL} || {NL} || '日期: ' || date ELSE date END FROM h
 UNION ALL SELECT title, last_at, 2, 0, '地点: ' || location || {NL} || {NL} || '票价:' || {NL} || price || {NL} || {NL} || '![](' || absolute_src || ')' FROM h WHERE ordinal = last_at""",
)
add(
    "duplicate_titles",
    f"""SELECT ordinal, keep, CASE WHEN keep THEN 'crawler_selected' ELSE 'duplicate_title' END AS reason
 FROM (SELECT ordinal, ordinal = max(ordinal) OVER (PARTITION BY title) AS keep FROM {v(I.HALL)} h) x""",
)
add(
    "distinct_signals",
    f"""WITH {signal_rows(NOTICES, _TEXT, inline('content'))} SELECT notice_id, kind, raw, {minute('parsed')} AS parsed, context FROM sig
 QUALIFY row_number() OVER (PARTITION BY notice_id, kind, raw, parsed ORDER BY line_no, pos) = 1""",
)
add("extract_signals", f"WITH {signal_rows(NOTICES, _TEXT)} SELECT notice_id, line_no, pos, kind, raw, {minute('parsed')} AS parsed, context FROM sig")
add(
    "latest_signal",
    f"""WITH {signal_rows(NOTICES, _TEXT)} SELECT notice_id, {minute("max(parsed) FILTER (WHERE kind = 'deadline')")} AS deadline,
 {minute("max(parsed) FILTER (WHERE kind = 'event')")} AS event, {minute("max(parsed) FILTER (WHERE kind = 'publish')")} AS publish FROM sig GROUP BY 1""",
)

# --- aggregation -------------------------------------------------------------

add(
    "decision_summary",
    f"""WITH l AS (SELECT coalesce(nullif(section, ''), 'unknown') AS section, coalesce(nullif(status, ''), 'unknown') AS status, coalesce(nullif(reason, ''), 'unknown') AS reason FROM {v(I.DECISION_LOG)} d)
SELECT 'total' AS level, NULL AS section, NULL AS status, NULL AS reason, count(*) AS records FROM l
UNION ALL SELECT 'status', NULL, status, NULL, count(*) FROM l GROUP BY status
UNION ALL SELECT 'section_status', section, status, NULL, count(*) FROM l GROUP BY section, status
UNION ALL SELECT 'section_reason', section, NULL, reason, count(*) FROM l GROUP BY section, reason""",
)
_ACCOUNT_TEXT = f"lower({trim('account')} || {NL} || {trim('title')} || {NL} || {trim('digest')} || {NL} || {trim('content')})"
_FILED = f"""(SELECT a.*, CASE WHEN contains(account, '学生会') OR contains(title, '学生会') THEN '学生会信息'
 WHEN {any_of('account', rules.SCIENCE_ACCOUNTS)} OR {any_of(_ACCOUNT_TEXT, rules.SCIENCE_WORDS)} THEN '青年科协信息'
 WHEN {any_of(_ACCOUNT_TEXT, rules.WELFARE_WORDS)} THEN '学生公益信息' WHEN {any_of(_ACCOUNT_TEXT, rules.CLUB_WORDS)} THEN '学生社团信息'
 ELSE '其他公众号信息' END AS section FROM {ARTICLES} a)"""
add("section_classifier", f"SELECT notice_id, section FROM {_FILED} f")
add(
    "section_buckets",
    f"""SELECT section, section_ord, count(f.ordinal) AS items, min(f.ordinal) AS first_ordinal, max(f.ordinal) AS last_ordinal,
 CASE WHEN count(f.ordinal) = 0 THEN 'empty' ELSE 'kept' END AS status, CASE WHEN count(f.ordinal) = 0 THEN 'no_visible_wechat_items' ELSE 'assigned_wechat_section' END AS reason
 FROM {names([*rules.ACCOUNT_SECTIONS, '空栏目'])} s LEFT JOIN {_FILED} f USING (section) GROUP BY 1, 2""",
)

# --- ranking -----------------------------------------------------------------

_RANKED = f"WITH {guardrails(_SCORED)}, ranked AS (SELECT *, row_number() OVER (PARTITION BY section ORDER BY score DESC, ordinal) AS rank FROM guarded)"
add("rank_in_section", f"{_RANKED} SELECT notice_id, section, score, rank FROM ranked")
add(
    "topk_per_section",
    f"""WITH {guardrails(_SCORED.replace('(SELECT n.*,', "(SELECT n.* REPLACE (CASE WHEN notice_id % 9 = 0 THEN '占位卡片' ELSE title END AS title),").replace(rule_points('title', 'content'), rule_points("CASE WHEN notice_id % 9 = 0 THEN '占位卡片' ELSE title END", 'content')))}
 SELECT notice_id, section, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY section ORDER BY score DESC, ordinal) AS rank FROM guarded WHERE title <> '占位卡片') x
 WHERE rank <= CASE WHEN section = '其他公众号信息' THEN 5 ELSE 4 END""",
)
_inline_at = parsed_eod(first("content", rf"{FULL_DATE}(?:{WS}*[0-2]?{DIGIT}[:：]{DIGIT}{{2}})?"))
add(
    "latest_events_topk",
    f"""WITH e AS (SELECT *, coalesce(event_at < {GRACE}, false) AS gone, {_inline_at} AS at_ FROM {_EVENTS_AT} x),
 r AS (SELECT *, row_number() OVER (PARTITION BY section, gone ORDER BY at_ DESC NULLS LAST, ordinal) AS rn FROM e)
 SELECT notice_id, NOT gone AND rn <= 4 AS keep, CASE WHEN gone THEN 'expired_physics_event' WHEN rn <= 4 THEN 'selected_for_final_markdown' ELSE 'max_items_per_section' END AS reason FROM r""",
)
add(
    "first_n",
    f"""SELECT notice_id, rn <= lim AS keep, CASE WHEN rn <= lim THEN 'selected_for_final_markdown' WHEN lim = 5 THEN 'max_wechat_items' ELSE 'fallback_max_items_per_section' END AS reason
 FROM (SELECT notice_id, row_number() OVER (PARTITION BY section ORDER BY ordinal) AS rn, CASE WHEN section = '其他公众号信息' THEN 5 ELSE 4 END AS lim FROM {NOTICES} n) x""",
)
add("newest_first", f"SELECT notice_id, publish_ts, row_number() OVER (ORDER BY coalesce(publish_ts, 0) DESC, ordinal) AS position FROM {ARTICLES} a")
add("item_index", f"SELECT notice_id, section, row_number() OVER (PARTITION BY section ORDER BY ordinal) AS item_index FROM {NOTICES} n WHERE title NOT LIKE '音乐会%'")
_readable = lambda x: f"{count(x, CJK)} + 2 * {count(x, rules.QUALITY_WORDS)}"
add(
    "best_candidate",
    f"""WITH c AS (SELECT doc_id, unnest([text, '报告 ' || text, substr(text, 1, 400), '时间ÃÃ' || substr(text, 1, 100)]) AS c, unnest([1, 2, 3, 4]) AS i FROM documents)
 SELECT doc_id, c AS best FROM c QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY {_readable('c')} DESC, {count('c', rules.MOJIBAKE_RUN)}, length(c), i) = 1""",
)

# --- sets --------------------------------------------------------------------

_of = lambda feed, n, section: f"SELECT '{feed}' AS feed, {n} AS feed_ord, notice_id, title, section, CAST(NULL AS VARCHAR) AS price, CAST(NULL AS VARCHAR) AS url FROM {NOTICES} n WHERE section = '{section}'"
add(
    "union_feeds",
    f"""{_of('info', 1, '教务通知')} UNION ALL {_of('myhome', 2, '家园网信息')} UNION ALL {_of('lib', 4, '图书馆信息')} UNION ALL SELECT 'hall', 5, ordinal, title, NULL, price, NULL FROM {v(I.HALL)} h
 UNION ALL {_of('physics', 6, '物理系学术报告')} UNION ALL SELECT 'accounts', 7, notice_id, title, NULL, NULL, url FROM {ARTICLES} a UNION ALL {_of('other', 8, '其他公众号信息')}""",
)
add(
    "complete_sections",
    f"""SELECT section, title, content, false AS placeholder FROM {NOTICES} n UNION ALL SELECT section, '占位卡片', '等待下次抓取结果。', true FROM {names(rules.REQUIRED_SECTIONS)} s
 WHERE section NOT IN (SELECT section FROM {NOTICES} m)""",
)
add(
    "fallback_issue",
    f"""SELECT 'empty' AS run, * FROM (SELECT 0 AS section_ord, '周报' AS section, '本期说明' AS title, {lit(rules.FALLBACK_PREFACE).replace(chr(10), "' || chr(10) || '")} || string_agg('- ' || stage || ': ' || error, {NL} ORDER BY stage_ord) AS content FROM {v(I.STAGE_ERRORS)} e WHERE error <> ''
 UNION ALL SELECT section_ord, section, '占位卡片', '等待下次抓取结果。' FROM {names(rules.FALLBACK_SECTIONS)} s) x""",
)

# --- scoring -----------------------------------------------------------------

add("rule_score", f"SELECT notice_id, {rule_points('title', 'content')} AS score FROM {NOTICES} n")
add("score_guardrails", f"WITH {guardrails(_SCORED)} SELECT notice_id, score, reason, tags FROM guarded")
add("expired_cap", f"SELECT notice_id, {expired('title', 'content')} AS cap FROM {NOTICES} n")
add(
    "all_dates_past",
    f"WITH d AS ({_days('content')}), a AS (SELECT notice_id, bool_and(day < DATE '2026-04-20') AS p FROM d WHERE day IS NOT NULL GROUP BY 1) SELECT notice_id, coalesce(p, false) AS past FROM {NOTICES} n LEFT JOIN a USING (notice_id)",
)
add(
    "has_current_or_future_date",
    f"WITH d AS ({_days('content')}), a AS (SELECT notice_id, bool_or(day >= DATE '2026-04-20') AS p FROM d WHERE day IS NOT NULL GROUP BY 1) SELECT notice_id, coalesce(p, false) AS ahead FROM {NOTICES} n LEFT JOIN a USING (notice_id)",
)
_body_lines = f"unnest(string_split(content, {NL})) AS line, generate_subscripts(string_split(content, {NL}), 1) AS k"
_is_score = f"regexp_matches({trim('line')}, '^重要性评分:{WS}*{DIGIT}{{1,3}}/100')"
add(
    "parse_embedded_score",
    f"""WITH {_LINES}, bl AS (SELECT doc_id, section_ord, item_ord, {_body_lines} FROM items),
 sc AS (SELECT doc_id, section_ord, item_ord, CAST(arg_max(regexp_extract({trim('line')}, '^重要性评分:{WS}*({DIGIT}{{1,3}})/100', 1), k) FILTER (WHERE {_is_score}) AS INT) AS score,
  string_agg(CASE WHEN NOT {_is_score} AND NOT starts_with({trim('line')}, '排序依据:') THEN line END, {NL} ORDER BY k) AS rest FROM bl GROUP BY 1, 2, 3)
 SELECT doc_id, section_ord, item_ord, least(100, coalesce(score, 0)) AS score, {trim(swap(trim("coalesce(rest, '')"), chr(92) + 'n{3,}', chr(10) * 2))} AS content FROM sc""",
)

# --- dates -------------------------------------------------------------------

add("parse_datetime_text", f"SELECT notice_id, {minute(parsed('text'))} AS parsed FROM {DATE_TEXTS} d")
add("parse_datetime_eod", f"SELECT notice_id, {minute(parsed_eod('text'))} AS parsed FROM {DATE_TEXTS} d")
add("extract_publish_date", f"SELECT notice_id, {publish_text('content')} AS publish_text FROM {NOTICES} n")
add("inline_date", f"SELECT notice_id, {inline('text')} AS inline FROM {DATE_TEXTS} d")
add(
    "assemble_date",
    f"""SELECT notice_id, CASE WHEN notice_id % 9 = 0 THEN '待定' WHEN notice_id % 4 = 0 THEN month("at") || '月' || day("at") || '日 19:30'
 ELSE '2026-' || lpad(CAST(month("at") AS VARCHAR), 2, '0') || '-' || lpad(CAST(day("at") AS VARCHAR), 2, '0') END AS date FROM {DATE_TEXTS} d""",
)
add("parse_epoch", f"SELECT notice_id, {_epoch('trim(epoch_text)')} AS epoch FROM {DATE_TEXTS} d")
_PUBLISHED = "CASE WHEN publish_ts IS NOT NULL THEN strftime(make_timestamp(publish_ts * 1000000), '%Y-%m-%d %H:%M') WHEN publish_text <> '' THEN publish_text ELSE 'N/A' END"
add("format_publish", f"SELECT notice_id, {_PUBLISHED} AS published FROM {ARTICLES} a")

# --- text --------------------------------------------------------------------

_space = lambda x: trim(swap(swap(swap(x, r"\r\n?", "\n"), r"\n{3,}", "\n\n"), r"[ \t]+", " "))
add("normalize_space", f"SELECT doc_id, {_space('dirty')} AS cleaned FROM {DIRTY} d")

_MAP = f"map([{', '.join(map(lit, html5))}], [{', '.join(map(lit, html5.values()))}])"
_SHORT = "|".join(sorted((n for n in html5 if not n.endswith(";")), key=len, reverse=True))
_C1 = "[" + ", ".join(lit(bytes([i]).decode("cp1252", errors="ignore") or chr(i)) for i in range(0x80, 0xA0)) + "]"


def one(x: str, name: str, body: str) -> str:
    """``body`` with ``x`` under a name, evaluated once."""
    return f"list_transform([{x}], lambda {name}: {body})[1]"


def unescaped(x: str) -> str:
    """Character references as HTML reads them: by name or number, some names also without their semicolon."""
    digits = "CASE WHEN regexp_matches(s, '^#[xX]') THEN '0x' || regexp_extract(s, '^#[xX]0*([0-9a-fA-F]*)', 1) ELSE regexp_extract(s, '^#0*([0-9]*)', 1) END"
    number = one(digits, "d", "CASE WHEN d IN ('', '0x') THEN 0 WHEN length(d) > 9 THEN 1114112 ELSE CAST(d AS BIGINT) END")
    char = f"""CASE WHEN n = 0 OR n BETWEEN 55296 AND 57343 OR n > 1114111 THEN chr(65533) WHEN n BETWEEN 128 AND 159 THEN {_C1}[n - 127]
 WHEN n BETWEEN 1 AND 8 OR n = 11 OR n BETWEEN 14 AND 31 OR n = 127 OR n BETWEEN 64976 AND 65007 OR n % 65536 >= 65534 THEN '' ELSE chr(CAST(n AS INT)) END"""
    by_prefix = one(f"regexp_extract(s, '^(?:{_SHORT})')", "k", f"CASE WHEN k <> '' THEN {_MAP}[k] || substr(s, length(k) + 1) ELSE '&' || s END")
    named = f"coalesce({_MAP}[s], {by_prefix})"
    said = f"CASE WHEN s = '' THEN '&' WHEN s[1] = '#' THEN {one(number, 'n', char)} ELSE {named} END || substr(p, length(s) + 1)"
    shape = lit("^(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\\t\\n\\f <&#;]{1,32};?)")
    pieces = f"list_transform(string_split({x}, '&'), lambda p, i: CASE WHEN i = 1 THEN p ELSE {one(f'regexp_extract(p, {shape})', 's', said)} END)"
    return f"array_to_string({pieces}, '')"


def _fragment() -> str:
    x = trim(r"coalesce(nullif(regexp_extract(html, '(?i)<body[^>]*>([\s\S]*?)</body>', 1), ''), html)")
    for p in (
        r"(?i)<!DOCTYPE[^>]*>", r"(?i)</?(?:html|head|body|meta|title|link)[^>]*>", r"(?i)<script[^>]*>[\s\S]*?</script>",
        r"(?i)<style[^>]*>[\s\S]*?</style>",
    ):
        x = swap(x, p)
    return trim(swap(x, r"\n{3,}", "\n\n"))


add("sanitize_fragment", f"SELECT page_id, {_fragment()} AS fragment FROM pages")
add("strip_tags", f"SELECT page_id, {collapse(unescaped(swap('html', '<[^>]+>')))} AS text FROM pages")
add(
    "doc_headline",
    f"""WITH {_LINES} SELECT doc_id, coalesce(arg_min({trim(f"substr({trim('line')}, 3)")}, n) FILTER (WHERE starts_with({trim('line')}, '# ')), '') AS headline,
 coalesce(substr({collapse(f"arg_min(line, n) FILTER (WHERE {trim('line')} <> '' AND NOT regexp_matches({trim('line')}, '^[#!]'))")}, 1, 120), '') AS summary FROM lines GROUP BY 1""",
)
_no_images = swap(swap("dirty", r"!\[[^\]]*\]\([^)]*\)"), rf"\[图片文字{WS}*{DIGIT}+\][^\n]*")
add("strip_images", f"SELECT doc_id, {_no_images} AS cleaned FROM {DIRTY} d")
add(
    "normalize_headings",
    f"""WITH l AS (SELECT doc_id, title, unnest(string_split_regex(dirty, {lit(LINE_BREAK)})) AS line, generate_subscripts(string_split_regex(dirty, {lit(LINE_BREAK)}), 1) AS n FROM {DIRTY} d),
 f AS (SELECT *, min(n) FILTER (WHERE {trim('line')} <> '') OVER (PARTITION BY doc_id) AS f FROM l),
 g AS (SELECT doc_id, n, n = f AND starts_with({trim('line')}, '#') AND {trim(swap(trim('line'), f'^#+{WS}*'))} = {trim('title')} AS is_title,
  CASE WHEN regexp_matches(line, '^{WS}*#') AND {trim(swap(trim('line'), f'^#+{WS}*'))} <> '' THEN '### ' || {trim(swap(trim('line'), f'^#+{WS}*'))} ELSE line END AS line FROM f)
 SELECT doc_id, {trim(f"string_agg(line, {NL} ORDER BY n) FILTER (WHERE NOT is_title)")} AS body FROM g GROUP BY 1""",
)
add(
    "quality_score",
    f"""SELECT doc_id, {count(trim('dirty'), CJK)} * 3 + length({trim('dirty')}) - {count(trim('dirty'), '(?i)' + rules.NOISE_WORDS)} * 20 - {count(trim('dirty'), '<[a-zA-Z/][^>]*>')} * 10 AS quality FROM {DIRTY} d""",
)
add("mojibake_score", f"SELECT doc_id, {_readable('dirty')} AS readable, -{count('dirty', rules.MOJIBAKE_RUN)} AS broken, -length(dirty) AS shorter FROM {DIRTY} d")
add(
    "mojibake_audit",
    f"""SELECT doc_id, line_no, substr({trim('line')}, 1, 160) AS sample FROM (SELECT doc_id, unnest(string_split_regex(dirty, {lit(LINE_BREAK)})) AS line,
 generate_subscripts(string_split_regex(dirty, {lit(LINE_BREAK)}), 1) AS line_no FROM {DIRTY} d) x WHERE regexp_matches(line, {lit(rules.AUDIT_PATTERNS)})""",
)


def _pairs_out(x: str, mark: str, width: int) -> str:
    """``**word**`` without its marks: runs of exactly ``width`` marks become a private character, which then pairs up."""
    m, run = re.escape(mark), re.escape(mark * width)
    for _ in range(2):  # neighbouring runs share the character between them
        x = swap(x, f"(^|[^{m}]){run}([^{m}]|$)", "\\1\ue000\\2")
    x = swap(x, f"\ue000([^{m}\ue000\n]+)\ue000", "\\1")
    return f"replace({x}, '\ue000', {lit(mark * width)})"


def clean(x: str) -> str:
    """Markup, then Markdown, then stray marks; the test texts hold no character references."""
    x = swap(f"replace({x}, chr(65279), '')", r"(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>", " ")
    x = swap(x, r"(?i)<br\s*/?>", "\n")
    x = swap(swap(x, r"(?i)</?(?:" + "|".join(rules.BLOCK_TAGS) + r")[^>]*>", "\n"), r"<[^>]+>", " ")
    x = swap(swap(x, r"!\[([^\]]*)\]\([^)]*\)", "\\1"), r"\[([^\]]+)\]\([^)]*\)", "\\1")
    x = swap(swap(x, r"`{1,3}([^`]+)`{1,3}", "\\1"), rf"(?m)^{WS}{{0,3}}>{WS}?")
    x = swap(swap(x, rf"(?m)^{WS}*[-*_]{{3,}}{WS}*$"), rf"(?m)^{WS}*#{{1,6}}{WS}*([^#\n]+?){WS}*$", "### \\1")
    for mark, width in (("*", 2), ("_", 2), ("*", 1), ("_", 1)):
        x = _pairs_out(x, mark, width)
    x = swap(x, r"\\([*_#`>\-])", "\\1")
    x = trim(swap(swap(swap(x, r"\n[ \t]+", "\n"), r"[ \t]+\n", "\n"), r"\n{3,}", "\n\n"))
    return trim(swap(swap(swap(x, r"(?m)^[ \t]*\*{3,}[ \t]*$"), r"\*{4,}"), r"\n[ \t\n]*\n", "\n\n"))


def raw_cleaned(x: str) -> str:
    bare = swap(swap(x, r"!\[[^\]]*\]\([^)]*\)"), rf"\[图片文字{WS}*{DIGIT}+\][^\n]*")
    return trim(swap(clean(bare), r"\n{3,}", "\n\n"))


add("clean_markdown", f"SELECT doc_id, {clean('dirty')} AS cleaned FROM {DIRTY} d")
_begin = f"""least(CASE WHEN strpos(content, '**报告题目') > 0 THEN strpos(content, '**报告题目') END, CASE WHEN strpos(content, '报告题目：') > 0 THEN strpos(content, '报告题目：') END,
 CASE WHEN strpos(content, '### ' || title) > 0 THEN strpos(content, '### ' || title) END, CASE WHEN strpos(content, title) > 0 THEN strpos(content, title) END)"""
_end = "least(" + ", ".join(f"CASE WHEN strpos(c, {lit(m)}) > 1 THEN strpos(c, {lit(m)}) END" for m in rules.REPORT_END_MARKERS) + ")"
add(
    "trim_report_text",
    f"""SELECT notice_id, {trim(swap(f"CASE WHEN {_end} IS NULL THEN c ELSE substr(c, 1, {_end} - 1) END", chr(92) + 'n{3,}', chr(10) * 2))} AS trimmed
 FROM (SELECT notice_id, CASE WHEN {_begin} IS NULL THEN content ELSE substr(content, {_begin}) END AS c FROM {REPORTS} r) x""",
)
add(
    "lecture_segment",
    rf"""SELECT notice_id, CASE WHEN s = '' THEN content WHEN regexp_matches(s, '教师|主讲人') THEN {trim("regexp_extract(s, '^([" + chr(92) + "s" + chr(92) + "S]*?)(?:教师|主讲人)', 1)")} ELSE s END AS segment
 FROM (SELECT notice_id, content, regexp_extract(content, '第{DIGIT}+讲：[\s\S]*') AS s FROM {REPORTS} r) x""",
)


def labelled(x: str, labels: list[str]) -> str:
    one = lambda label: f"nullif({trim('replace(' + f'regexp_extract({x}, {lit(label + WS)} || {lit(f'*[：:]{WS}*(?:' + chr(92) + '*' + chr(92) + f'*)?{WS}*([^' + chr(92) + 'n]+)')}, 1)' + ', ' + lit('**') + ', ' + lit('') + ')')}, '')"
    return "coalesce(" + ", ".join(one(label) for label in labels) + ", '')"


add(
    "labelled_field",
    f"SELECT notice_id, {labelled('content', rules.SPEAKER_LABELS)} AS speaker, {labelled('content', rules.TIME_LABELS)} AS event_time, {labelled('content', rules.PLACE_LABELS)} AS place FROM {REPORTS} r",
)


def summary_of(x: str) -> str:
    after = trim(f"regexp_extract({x}, {lit(rf'(?i)(?:{rules.SUMMARY_START}){WS}*[：:]?(?:\*\*)?{WS}*([\s\S]+)\z')}, 1)")
    stop = rules.SUMMARY_STOP.format(ws=WS)
    cut = swap(after, rf"(?m)\n{WS}*(?:\*\*)?(?:{stop})(?:{WS}*[：:][^\n]*)?$[\s\S]*", "", "")
    return trim(f"substr({swap(trim(cut), chr(92) + 'n{3,}', chr(10) * 2)}, 1, 1800)")


add("report_summary", f"SELECT notice_id, {summary_of('content')} AS summary FROM {REPORTS} r")
_FIELDS = f"""(SELECT r.*, CASE notice_id % 3 WHEN 0 THEN '模型题 ' || notice_id ELSE title END AS report_title, CASE notice_id % 3 WHEN 0 THEN '张三' ELSE {labelled('content', rules.SPEAKER_LABELS)} END AS speaker,
 {labelled('content', rules.TIME_LABELS)} AS event_time, {labelled('content', rules.PLACE_LABELS)} AS location, CASE notice_id % 3 WHEN 0 THEN '模型摘要' ELSE '' END AS model_summary,
 {summary_of('content')} AS original_summary, coalesce(nullif({inline('content')}, ''), {inline('title')}) AS publish_date FROM {REPORTS} r)"""
add("report_fields", f"SELECT notice_id, report_title, speaker, event_time, location, model_summary, publish_date FROM {_FIELDS} f")
_line = lambda label, c: f"{lit(label)} || nullif({c}, '')"
add(
    "build_report",
    f"""SELECT notice_id, report_title, {trim(f"concat_ws({NL} || {NL}, {_line('发布日期: ', 'publish_date')}, {_line('报告时间: ', 'event_time')}, {_line('报告地点: ', 'location')}, {_line('报告人: ', 'speaker')}, {lit('链接: ')} || url, {lit('')}, coalesce({_line('内容摘要：', 'original_summary')}, {_line('报告摘要：', 'model_summary')}, substr(content, 1, 1800)))")} AS body FROM {_FIELDS} f""",
)
add("text_units", f"SELECT doc_id, {UNITS('text')} AS units FROM documents")


def clip(x: str, limit: str) -> str:
    free = r"[^\x{4e00}-\x{9fff}A-Za-z0-9_]*"
    return trim(f"regexp_extract({x}, {lit(f'^(?:{free}(?:{CJK}|{WORD})){{0,')} || ({limit}) || {lit(f'}}{free}')})")


add("clip_units", f"SELECT doc_id, {clip('text', '70')} AS clipped FROM documents")


def shortened(source: str) -> str:
    """source with clean, summary and the shortened body."""
    s1 = f"(SELECT *, {_space('content')} AS clean FROM {source} s0)"
    s2 = f"(SELECT *, {clip('clean', '70')} AS summary FROM {s1} s1)"
    return f"""(SELECT *, CASE WHEN (section = '物理系学术报告' AND regexp_matches(content, '(?:内容摘要|报告摘要)[：:]')) OR {UNITS('summary')} + {UNITS('clean')} <= 250 THEN clean
 ELSE {clip('clean', f"greatest(80, 230 - {UNITS('summary')})")} END AS body FROM {s2} s2)"""


add("compress_body", f"SELECT notice_id, body FROM {shortened(REPORTS)} s")
add(
    "fallback_summary",
    f"""SELECT notice_id, substr({collapse("coalesce(nullif(digest, ''), content)")}, 1, 100) AS feed_summary, {clip(_space('content'), '70')} AS digest_summary FROM {ARTICLES} a""",
)
add("repair_mojibake", f"SELECT doc_id, text || {NL} || '学术报告：时间地点' || {NL} || '正常行' AS text FROM documents")
add(
    "summary_repeats",
    f"""SELECT doc_id, s <> '' AND starts_with({swap('text', f'{WS}+')}, s) AS repeats FROM (SELECT doc_id, text, {swap(f"CASE doc_id % 3 WHEN 0 THEN ' ' || {clip(_space('text'), '70')} WHEN 1 THEN '另写' ELSE '' END", f'{WS}+')} AS s FROM documents) x""",
)
add(
    "filter_snippet",
    f"""SELECT notice_id, substr(concat_ws({NL}, '摘要: ' || nullif({trim('digest')}, ''), '正文: ' || nullif({trim('content')}, ''), CASE WHEN notice_id % 2 = 0 THEN '图片文字: 图一' || {NL} || '图二' END), 1, 3000) AS snippet FROM {ARTICLES} a""",
)


def fit(x: str, chars: int, limit: int, dots: str = "") -> str:
    t = f"CASE WHEN length({x}) > {chars} THEN rtrim(substr({x}, 1, {chars}), {lit(WS_CHARS)}) || '{dots}' ELSE {x} END"
    return f"(SELECT CASE WHEN strlen(t) <= {limit} THEN t ELSE rtrim(substr(t, 1, list_max(list_filter(range(0, length(t) + 1), lambda k: strlen(substr(t, 1, k)) <= {limit}))), {lit(WS_CHARS)}) END FROM (SELECT {t} AS t))"


_sizes = ", ".join(f"length({c}) AS {c}_chars, strlen({c}) AS {c}_bytes" for c in ("title", "author", "digest", "source_url"))
add(
    "fit_field",
    f"""WITH a AS (SELECT notice_id, CASE WHEN notice_id % 10 = 0 THEN '周报' ELSE {collapse("'通知 ' || title || '  关于本学期各项安排的详细通知与说明' || content")} END AS t0, {collapse('account')} AS a0,
 {collapse("digest || ' ' || content")} AS d0, CASE WHEN notice_id % 3 = 0 THEN url ELSE '' END AS source_url FROM {ARTICLES} a),
 b AS (SELECT notice_id, {fit('t0', 32, 64)} AS title, {fit('a0', 4, 12)} AS author, {fit('d0', 54, 120, '...')} AS digest, source_url FROM a) SELECT *, {_sizes} FROM b""",
)
_label_shape = rf"^([^:：]{{1,12}})[:：]{WS}*([^\n]+)"
add(
    "split_label",
    f"""SELECT doc_id, n, CASE WHEN regexp_matches(line, {lit(_label_shape)}) THEN {trim(f'regexp_extract(line, {lit(_label_shape)}, 1)')} ELSE '' END AS label,
 CASE WHEN regexp_matches(line, {lit(_label_shape)}) THEN {trim(f'regexp_extract(line, {lit(_label_shape)}, 2)')} ELSE line END AS value
 FROM (SELECT doc_id, unnest(string_split(text, {NL})) AS line, generate_subscripts(string_split(text, {NL}), 1) - 1 AS n FROM {MARKED} m) x""",
)

# --- urls --------------------------------------------------------------------

add("normalize_url", f"SELECT notice_id, {_clean_url('url')} AS url FROM {LINKS} l")
add("canonical_url", f"SELECT notice_id, {canonical('url', rules.TRACKING_KEYS)} AS canonical FROM {LINKS} l")
add("canonical_page_url", f"SELECT page_id, {canonical('url', ['ref', 'utm_source'])} AS canonical FROM pages")
add(
    "set_query_param",
    f"""SELECT notice_id, CASE WHEN contains(u, 'lmid=') THEN regexp_replace(u, 'lmid=[^&]+', 'lmid=LM_JWGG', 'g') WHEN contains(u, '?') THEN u || '&lmid=LM_JWGG' ELSE u || '?lmid=LM_JWGG' END AS url
 FROM (SELECT notice_id, CASE WHEN notice_id % 5 = 0 THEN split_part(url, '?', 1) ELSE url END AS u FROM {LINKS} l) x""",
)
_origin, _folder = "regexp_extract(url, '^[a-z]+://[^/?#]*')", "regexp_extract(url, '^([a-z]+://[^/?#]*/(?:[^?#]*/)?)', 1)"
add(
    "resolve_resource_urls",
    f"""SELECT page_id, pos, src FROM (SELECT page_id, unnest([{_origin} || '/img/' || page_id || '.png', regexp_extract(url, '^[a-z]+:') || '//cdn.example.com/b.png', {_folder} || 'x.gif',
 {_origin} || ':8080/app.js', {_folder} || 'c.png']) AS src, unnest([0, 1, 2, 3, 4]) AS pos FROM pages) x""",
)
add(
    "extract_images",
    """SELECT page_id, unnest([1, 2, 3]) AS idx, unnest(['https://mp.example.com/img/' || page_id || '.png', 'https://cdn.example.com/b.png', 'pics/../c.png']) AS image_url,
 unnest(['[[IMG_OCR_1]]', '[[IMG_OCR_2]]', '[[IMG_OCR_3]]']) AS token FROM pages""",
)
add(
    "tables_to_rows",
    f"""SELECT page_id, 1 AS table_no, 2 AS columns, 2 AS table_rows, '| 名称 | A\\|B |' || {NL} || '| --- | --- |' || {NL} || '| ' || page_id || ' |  |' AS markdown FROM pages""",
)

# --- model tables ------------------------------------------------------------

add(
    "ranking_requests",
    f"""SELECT section, chunk, count(*) AS items, '版块: ' || section || {NL} || {NL} || string_agg(item_index || '. 标题: ' || title || {NL} || '正文摘录:' || {NL} || substr(content, 1, 900), {NL} || {NL} ORDER BY item_index) AS prompt
 FROM (SELECT *, CAST(floor((item_index - 1) / 40) AS BIGINT) AS chunk FROM (SELECT *, row_number() OVER (PARTITION BY section ORDER BY ordinal) AS item_index FROM {NOTICES} n) y) x GROUP BY 1, 2""",
)
add(
    "decision_requests",
    f"""SELECT notice_id, concat_ws({NL}, '站点: ' || section, '标题: ' || title, '已知日期: ' || nullif({inline('content')}, ''), '正文与摘要: ' || nullif(content, ''), '筛选规则:') AS prompt
 FROM {NOTICES} n WHERE {_RULE} IS NULL""",
)
add(
    "decision_responses",
    """SELECT doc_id AS notice_id, CASE WHEN doc_id % 5 = 4 OR doc_id % 7 = 3 THEN NULL ELSE quality = 1 END AS model_keep,
 CASE WHEN doc_id % 5 = 4 OR doc_id % 7 = 3 THEN 'undecided' WHEN quality = 1 THEN 'kept' ELSE 'dropped' END AS status,
 CASE WHEN doc_id % 5 = 4 THEN 'llm_empty' WHEN doc_id % 7 = 3 THEN 'llm_unparseable' WHEN quality = 1 THEN 'llm_yes' ELSE 'llm_no' END AS reason FROM labels""",
)
add(
    "selection_responses",
    f"""WITH i AS (SELECT notice_id, section, row_number() OVER (PARTITION BY section ORDER BY ordinal) AS item_index, count(*) OVER (PARTITION BY section) AS n,
  CASE section WHEN '物理系学术报告' THEN 4 WHEN '其他公众号信息' THEN 5 END AS own FROM {NOTICES} n)
 SELECT section, notice_id, item_index, CASE WHEN own > 0 OR section = '家园网信息' THEN item_index WHEN item_index = n THEN 1 WHEN item_index = 2 THEN 2 WHEN item_index = 1 THEN 3 ELSE 4 END AS pick,
 CASE WHEN own > 0 THEN 'section_rule' WHEN section = '家园网信息' THEN 'fallback_max_items_per_section' ELSE 'llm_section_selection' END AS reason
 FROM i WHERE CASE WHEN own > 0 THEN item_index <= own WHEN section = '家园网信息' THEN item_index <= 4 ELSE item_index IN (n, 2, 1, n - 1) END""",
)
add(
    "selection_requests",
    f"""WITH i AS (SELECT *, row_number() OVER (PARTITION BY section ORDER BY ordinal) AS item_index FROM {NOTICES} n WHERE section NOT IN ('物理系学术报告', '其他公众号信息')),
 c AS (SELECT section, item_index, (item_index - 1) // 40 AS chunk, item_index || '. 标题: ' || title || {NL} || '发布日期: ' || {inline('content')} || {NL} || '正文摘录: ' || substr({_space('content')}, 1, 500) AS c FROM i)
 SELECT section, chunk, count(*) AS items, '版块: ' || section || {NL} || {NL} || string_agg(c, {NL} || {NL} ORDER BY item_index) AS prompt FROM c GROUP BY 1, 2""",
)
add("summary_requests", f"SELECT notice_id, '标题: ' || title || {NL} || '来源: ' || section || {NL} || '正文:' || {NL} || substr(content, 1, 2500) AS prompt FROM {NOTICES} n")
add("clean_requests", f"SELECT notice_id, 'Source: crawler' || {NL} || {NL} || 'Markdown:' || {NL} || substr({clean('content')}, 1, 3000) AS prompt FROM {NOTICES} n")
add(
    "report_requests",
    f"""SELECT notice_id, '页面标题：' || title || {NL} || '发布日期：' || {inline('content')} || {NL} || '链接：' || url || {NL} || '原文如下：' || {NL} || substr(content, 1, 3000) AS prompt FROM {REPORTS} r""",
)


def quality(x: str) -> str:
    return f"({count(trim(x), CJK)} * 3 + length({trim(x)}) - {count(trim(x), '(?i)' + rules.NOISE_WORDS)} * 20 - {count(trim(x), '<[a-zA-Z/][^>]*>')} * 10)"


_heading = lambda line: trim(swap(trim(line), f"^#+{WS}*"))
add(
    "gated_clean",
    f"""WITH g AS (SELECT notice_id, section, title, own, cand, section <> '物理系学术报告' AND cand IS NOT NULL AND own <> '' AND coalesce({quality('cand')} >= {quality('own')}, false) AS accepted
  FROM (SELECT notice_id, section, title, {clean('content')} AS own, CASE notice_id % 3 WHEN 1 THEN {clean("'整理：' || content")} WHEN 2 THEN '整理要点' END AS cand FROM {NOTICES} n) x),
 l AS (SELECT notice_id, title, accepted, unnest(string_split_regex(CASE WHEN accepted THEN cand ELSE own END, {lit(LINE_BREAK)})) AS line,
   generate_subscripts(string_split_regex(CASE WHEN accepted THEN cand ELSE own END, {lit(LINE_BREAK)}), 1) AS n FROM g),
 f AS (SELECT *, n = min(n) FILTER (WHERE {trim('line')} <> '') OVER (PARTITION BY notice_id) AND starts_with({trim('line')}, '#') AND {_heading('line')} = {trim('title')} AS is_title FROM l),
 b AS (SELECT notice_id, accepted, coalesce(string_agg(CASE WHEN regexp_matches(line, '^{WS}*#') AND {_heading('line')} <> '' THEN '### ' || {_heading('line')} ELSE line END, {NL} ORDER BY n) FILTER (WHERE NOT is_title), '') AS body FROM f GROUP BY ALL)
 SELECT notice_id, accepted, {clean(trim('body'))} AS content FROM b""",
)
_RAW = f"CASE WHEN doc_id % 2 = 0 THEN '  摘要' || {NL} || text ELSE '' END"
add(
    "summary_responses",
    f"""SELECT doc_id, coalesce(nullif(substr({collapse(_RAW)}, 1, 100), ''), substr({collapse('text')}, 1, 100)) AS feed_summary,
 {clip(_space(f"coalesce(nullif({_RAW}, ''), {clip(_space('text'), '70')})"), '70')} AS digest_summary FROM documents""",
)
_PROMPT = f"('标题: ' || title || {NL} || content)"
_ANSWER = f"CASE WHEN length({_PROMPT}) % 7 = 0 THEN NULL WHEN length({_PROMPT}) % 2 = 1 THEN 'YES' ELSE 'NO' END"
add(
    "model_call",
    f"""SELECT notice_id, raw, raw = 'YES' AS model_keep, CASE raw WHEN 'YES' THEN 'kept' WHEN 'NO' THEN 'dropped' ELSE 'undecided' END AS status,
 CASE raw WHEN 'YES' THEN 'llm_yes' WHEN 'NO' THEN 'llm_no' ELSE 'llm_empty' END AS reason FROM (SELECT notice_id, {_ANSWER} AS raw FROM {NOTICES} n) x""",
)

# --- rendering ---------------------------------------------------------------

_BLANK = f"{NL} || {NL}"
add(
    "render_ranked",
    f"""{_RANKED} SELECT section, section_ord, 0 AS block, '# ' || section || CASE WHEN section IN (SELECT section FROM ranked) THEN '' ELSE {_BLANK} || '## 占位卡片' || {_BLANK} || {lit(rules.RANKED_EMPTY_BODY)} END AS text FROM {ISSUE} s
 UNION ALL SELECT section, section_ord, rank, '## ' || title || {_BLANK} || '重要性评分: ' || score || '/100' || {_BLANK} || '排序依据: ' || reason || {_BLANK} || content FROM ranked JOIN {ISSUE} s USING (section)""",
)


def digest_sql(ctes: str, source: str, every: str) -> str:
    """Rendered sections of the rows in ``source`` that survive the time filter; all sections of ``every`` are printed."""
    cut = f"""{ctes}, live AS (SELECT * EXCLUDE (reason, basis, keep), section = '物理系学术报告' AS rep, {_labelled_at} AS event_at, {_inline_at} AS at_ FROM rel WHERE keep),
 placed AS (SELECT *, row_number() OVER (PARTITION BY section ORDER BY CASE WHEN rep THEN at_ END DESC NULLS LAST, ordinal) AS rank FROM live WHERE NOT rep OR coalesce(event_at >= {GRACE}, true)),
 cut AS (SELECT * FROM placed WHERE rank <= CASE WHEN section = '其他公众号信息' THEN 5 ELSE 4 END),
 short AS (SELECT *, summary <> '' AND NOT starts_with({swap('body', f'{WS}+')}, {swap('summary', f'{WS}+')}) AS shown FROM {shortened('cut')} c),
 blocks AS (SELECT section, rank, concat_ws({_BLANK}, '## ' || title, CASE WHEN shown THEN '要点透视：' || summary END, nullif(body, '')) AS block FROM short),
 texts AS (SELECT section, string_agg(block, {_BLANK} ORDER BY rank) AS t, count(*) AS items FROM blocks GROUP BY 1)"""
    listed = f"""placed_sections AS (SELECT section, section_ord FROM {ISSUE} s UNION ALL SELECT section, {len(ISSUE_NAMES)} + row_number() OVER (ORDER BY first, section)
  FROM (SELECT section, min(ordinal) AS first FROM {every} e WHERE section NOT IN (SELECT section FROM {ISSUE} s2) GROUP BY 1) o)"""
    return f"""WITH {cut}, {listed} SELECT section, section_ord, coalesce(items, 0) AS items, concat_ws({_BLANK}, '# ' || section, {_LEAD('section', 'coalesce(items, 0)')}, t) AS text
 FROM placed_sections s LEFT JOIN texts USING (section)"""


add("render_digest", digest_sql(relevance(NOTICES, _TEXT, inline("content")), NOTICES, NOTICES))
_CHOSEN = f"""(SELECT * EXCLUDE (rk) FROM (SELECT *, row_number() OVER (PARTITION BY section ORDER BY score DESC, ordinal) AS rk FROM guarded) x WHERE rk <= CASE WHEN section = '其他公众号信息' THEN 5 ELSE 4 END)"""
_RECENT_CLEAN = f"(SELECT * REPLACE ({raw_cleaned('content')} AS content) FROM recency WHERE reason <> 'publish_older_than_cutoff')"
_RECENT_SCORED = f"(SELECT notice_id, section, title, content, ordinal, {rule_points('title', 'content')} AS score, 'fallback_keyword_score' AS reason FROM {_RECENT_CLEAN} c)"
add(
    "full_issue",
    digest_sql(
        f"{_RECENCY}, {guardrails(_RECENT_SCORED)}, chosen AS (SELECT notice_id, section, title, content, ordinal FROM {_CHOSEN} c), {relevance('chosen', _TEXT, inline('content'))}",
        "chosen",
        NOTICES,
    ),
)
add(
    "ranked_issue",
    f"""WITH {_RECENCY}, {guardrails(_RECENT_SCORED)}, ranked AS (SELECT *, row_number() OVER (PARTITION BY section ORDER BY score DESC, ordinal) AS rank FROM guarded)
 SELECT section, section_ord, 0 AS block, '# ' || section || CASE WHEN section IN (SELECT section FROM ranked) THEN '' ELSE {_BLANK} || '## 占位卡片' || {_BLANK} || {lit(rules.RANKED_EMPTY_BODY)} END AS text FROM {ISSUE} s
 UNION ALL SELECT section, section_ord, rank, concat_ws({_BLANK}, '## ' || title, '重要性评分: ' || score || '/100', '排序依据: ' || reason, nullif(content, '')) FROM ranked JOIN {ISSUE} s USING (section)""",
)
_AT = "struct_pack(d := doc_id, s := section_ord, i := item_ord)"
add(
    "refilter_issue",
    digest_sql(
        f"{_LINES}, stored AS (SELECT {_AT} AS notice_id, section, title, content, {_AT} AS ordinal FROM items), {relevance('stored', _TEXT, inline('content'))}",
        "stored",
        "stored",
    ),
)


def article_sql(summary: str) -> str:
    return f"""concat_ws({_BLANK}, '## ' || title, '来源公众号: ' || nullif(account, ''), '日期: ' || {_PUBLISHED}, '链接: ' || url, '发布时间: ' || nullif(publish_text, ''), '作者: ' || nullif(author, ''),
 coalesce('摘要: ' || nullif({summary}, ''), '摘要: ' || nullif(digest, '')), '内容:' || {_BLANK} || nullif(regexp_replace(content, '\\n\\z', ''), ''))"""


add("render_articles", f"SELECT notice_id, {article_sql(chr(39) * 2).replace(f'nullif({chr(39) * 2}, {chr(39) * 2})', 'CASE WHEN notice_id % 2 = 0 THEN ' + lit('一句话') + ' END')} AS text FROM {ARTICLES} a")
_PLAIN = ARTICLES
_PLAIN_UNIQUE = f"(SELECT * FROM {_KEYED.replace(ARTICLES, _PLAIN)} k QUALIFY row_number() OVER (PARTITION BY dedupe_key ORDER BY ordinal) = 1)"
_FEED_TEXT = f"concat_ws({NL}, title, nullif(digest, ''), nullif(publish_text, ''), content)"
_FEED_BACK = _PUBLISHED
_FEED_SUMMARY = f"substr({collapse(chr(99) + 'oalesce(nullif(digest, ' + chr(39) * 2 + '), content)')}, 1, 100)"
_FEED_KEPT = f"(SELECT * EXCLUDE (reason, basis, keep) REPLACE ({clean('content')} AS content, {clean('digest')} AS digest) FROM rel WHERE keep)"
add(
    "account_feed",
    f"""WITH uniq AS (SELECT * FROM {_PLAIN_UNIQUE} u), recent AS (SELECT * FROM uniq WHERE publish_ts IS NULL OR publish_ts >= 1776038400),
 {relevance('recent', _FEED_TEXT, _FEED_BACK)}, filed AS (SELECT section, -coalesce(publish_ts, 0) AS age, ordinal, text FROM (SELECT f.section, f.publish_ts, f.ordinal, {article_sql(trim(_FEED_SUMMARY))} AS text
  FROM {_FILED.replace(ARTICLES, _FEED_KEPT)} f) y)
 SELECT section, section_ord, age, ordinal, text FROM filed JOIN {names(rules.ACCOUNT_SECTIONS)} s USING (section)""",
)
_esc = lambda x: f"replace(replace(replace(replace(replace({x}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#x27;')"
_TIMES = "(" + "|".join(p.format(d=DIGIT, ws=WS) for p in rules.HIGHLIGHT_PATTERNS) + ")"
add("highlight_times", f"""SELECT notice_id, {swap(_esc('content'), _TIMES, "<span class='time-highlight'>" + chr(92) + "1</span>")} AS html FROM {NOTICES} n""")


def _kinds() -> str:
    line, label = "line", f"regexp_extract(line, {lit(_label_shape)}, 1)"
    lab = trim(f"CASE WHEN regexp_matches(line, {lit(_label_shape)}) THEN {label} ELSE '' END")
    val = f"CASE WHEN regexp_matches(line, {lit(_label_shape)}) THEN {trim(f'regexp_extract(line, {lit(_label_shape)}, 2)')} ELSE line END"
    img = r"^!\[([^\]]*)\]\(([^)]+)\)"
    bold, star = r"^\*\*.+\*\*$", r"^\*.*\*$"
    after = lambda n: trim(f"substr(line, {n})")
    return f"""k0 AS (SELECT doc_id, generate_subscripts(string_split_regex(text, {lit(LINE_BREAK)}), 1) AS line_no, {trim(f'unnest(string_split_regex(text, {lit(LINE_BREAK)}))')} AS line FROM {MARKED} m),
 k1 AS (SELECT *, {lab} AS lab, {val} AS val FROM k0),
 k2 AS (SELECT *, CASE WHEN line = '' OR starts_with(line, '[English](') OR (starts_with(line, '* [') AND contains(line, '](')) THEN 'skip' WHEN regexp_matches(line, {lit(img)}) THEN 'image'
  WHEN starts_with(line, '# ') THEN 'section' WHEN starts_with(line, '## ') THEN 'item' WHEN starts_with(line, '### ') THEN 'subhead' WHEN lab = '要点透视' THEN 'lede'
  WHEN lab IN ({', '.join(lit(x) for x in rules.META_LABELS)}) THEN 'meta' WHEN regexp_matches(line, '^https?://') THEN 'link' WHEN starts_with(line, '- ') OR starts_with(line, '• ') THEN 'bullet'
  WHEN starts_with(line, '*') THEN 'note' ELSE 'para' END AS kind FROM k1),
 kinds AS (SELECT doc_id, line_no, kind, CASE WHEN kind IN ('lede', 'meta') THEN lab WHEN kind = 'image' THEN {trim(f'regexp_extract(line, {lit(img)}, 1)')} ELSE '' END AS label,
  CASE kind WHEN 'section' THEN {after(3)} WHEN 'item' THEN {after(4)} WHEN 'subhead' THEN {after(5)} WHEN 'lede' THEN val WHEN 'meta' THEN val WHEN 'bullet' THEN {after(3)}
   WHEN 'note' THEN CASE WHEN regexp_matches(line, {lit(bold)}) AND length(line) > 4 THEN {trim('substr(line, 3, length(line) - 4)')} WHEN regexp_matches(line, {lit(star)}) AND length(line) > 2 THEN {trim('substr(line, 2, length(line) - 2)')} ELSE {trim(f"ltrim({line}, '*')")} END
   WHEN 'image' THEN {trim(f'regexp_extract(line, {lit(img)}, 2)')} WHEN 'skip' THEN '' ELSE line END AS value FROM k2)"""


add("classify_lines", f"WITH {_kinds()} SELECT doc_id, line_no, kind, label, value FROM kinds")


def _cards() -> str:
    """The fragments of all lines, and the tags that headings close and open."""
    esc, marked = _esc("value"), swap(_esc("value"), _TIMES, "<span class='time-highlight'>\\1</span>")
    p = lambda css, inner: f"{lit(f'<p class={chr(39)}{css}{chr(39)}>')} || {inner} || '</p>'"
    anchor = f"{lit('<a href=' + chr(39))} || {esc} || {lit(chr(39) + '>')} || {esc} || '</a>'"
    lead = "CASE value " + " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in rules.CARD_LEADS.items()) + f" ELSE {lit(rules.CARD_LEAD_GENERIC)} END"
    isin = lambda names_: "label IN (" + ", ".join(lit(n) for n in names_) + ")"
    strong = r"(regexp_matches(line, '^\*\*.+\*\*$') AND length(line) > 4) OR (regexp_matches(line, '^\*.*\*$') AND length(line) > 2)"
    section = lit("<section class='section'>\n<div class='section-head'>\n<span class='section-kicker'>本期栏目</span>\n<h2>")
    return f"""{_kinds()}, lines_of AS (SELECT k.*, k0.line, {strong} AS strong FROM kinds k JOIN k0 USING (doc_id, line_no) WHERE kind <> 'skip'),
 fr AS (SELECT *, CASE kind
   WHEN 'section' THEN {section} || {esc} || {lit("</h2>" + chr(10) + "<p class='section-lead'>")} || {lead} || {lit("</p>" + chr(10) + "</div>")}
   WHEN 'item' THEN {lit("<article class='card'>" + chr(10) + "<div class='card-notch'></div>" + chr(10) + "<h3>")} || {esc} || '</h3>'
   WHEN 'subhead' THEN {lit("<h4 class='subhead'>")} || {esc} || '</h4>'
   WHEN 'image' THEN {lit("<figure class='figure'><img src='")} || {esc} || {lit("' alt='")} || {_esc("coalesce(nullif(label, ''), '配图')")} || {lit("' loading='lazy' /></figure>")}
   WHEN 'lede' THEN {lit("<div class='lede-box'><div class='lede-tag'>" + rules.SUMMARY_LABEL + "</div><p>")} || {marked} || '</p></div>'
   WHEN 'meta' THEN {lit("<p class='meta-row'><span class='meta-label'>")} || {_esc('label')} || {lit("</span><span class='")} || CASE WHEN {isin(rules.HIGHLIGHT_LABELS)} THEN 'meta-value is-highlight' ELSE 'meta-value' END
     || {lit("'>")} || CASE WHEN label = '链接' AND regexp_matches(value, '^https?://') THEN {anchor} WHEN {isin(rules.TIME_LIKE_LABELS)} THEN {marked} ELSE {esc} END || '</span></p>'
   WHEN 'link' THEN {p('link-row', anchor)} WHEN 'bullet' THEN {p('bullet', esc)}
   WHEN 'note' THEN {p('note', f"CASE WHEN strong THEN '<strong>' || {esc} || '</strong>' ELSE {esc} END")} ELSE '<p>' || {esc} || '</p>' END AS h,
  kind IN ('section', 'item') AS heads FROM lines_of),
 st AS (SELECT *, last_value(CASE WHEN heads THEN kind END IGNORE NULLS) OVER back AS opened, coalesce(bool_or(kind = 'section') OVER back, false) AS in_section
  FROM fr WINDOW back AS (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
 body AS (SELECT doc_id, string_agg(concat_ws({NL}, CASE WHEN heads AND opened = 'item' AND NOT (kind = 'section' AND NOT in_section) THEN '</article>' END,
   CASE WHEN kind = 'section' AND in_section THEN '</section>' END, h), {NL} ORDER BY line_no) AS b, arg_max(kind, line_no) FILTER (WHERE heads) AS last_head, bool_or(kind = 'section') AS any_section FROM st GROUP BY 1)
 SELECT doc_id, concat_ws({NL}, b, CASE WHEN any_section THEN concat_ws({NL}, CASE WHEN last_head = 'item' THEN '</article>' END, '</section>') END) AS html FROM body"""


add("render_cards", f"WITH {_cards()}")


def at_run(day: str, sql: str) -> str:
    """A query written for the usual run date, for another one of the same year."""
    now = dt.date.fromisoformat(day)
    times = {
        "TIMESTAMP '2026-04-20'": f"TIMESTAMP '{now}'", "TIMESTAMP '2026-04-13'": f"TIMESTAMP '{now - dt.timedelta(days=7)}'",
        "TIMESTAMP '2026-04-19 12:00:00'": f"TIMESTAMP '{now - dt.timedelta(days=1)} 12:00:00'", "DATE '2026-04-20'": f"DATE '{now}'",
    }
    return re.sub("|".join(map(re.escape, times)), lambda m: times[m[0]], sql)


add("full_issues", " UNION ALL ".join(f"SELECT DATE '{day}' AS issue_date, * FROM ({at_run(day, ORACLES['full_issue'])}) r" for day in I.RUN_DATES))
_KEPT_COUNTS = f"WITH {_RECENCY} SELECT section, reason, count(*) AS notices FROM recency WHERE reason <> 'publish_older_than_cutoff' GROUP BY ALL"
add("issue_notices", " UNION ALL ".join(f"SELECT DATE '{day}' AS issue_date, * FROM ({at_run(day, _KEPT_COUNTS)}) r" for day in I.RUN_DATES))
_RUNS = f"""(SELECT *, coalesce(try_strptime(trim(run_date), '%Y%m%d'), try_strptime(trim(run_date), '%Y-%m-%d')) AS at_run FROM {v(I.RUNS)} r)"""
add("run_clock", f"SELECT run_id, CAST(at_run AS DATE) AS run_day, {minute('at_run')} AS now FROM {_RUNS} r")
add("issue_cutoff", f"SELECT run_id, {minute('coalesce(cutoff, at_run - INTERVAL 7 DAY)')} AS cutoff FROM {_RUNS} r")
add("issue_table", f"""SELECT CAST(at_run AS DATE) AS issue_date, {minute("min(coalesce(cutoff, at_run - INTERVAL 7 DAY))")} AS cutoff FROM {_RUNS} r WHERE at_run IS NOT NULL GROUP BY 1""")


_LOGGED = f"""SELECT '2026-04-20 00:00' AS time, n.section, n.title, CASE WHEN r.reason <> 'publish_older_than_cutoff' THEN 'kept' ELSE 'dropped' END AS status, r.reason,
 'ranked_raw_publish_filter' AS stage, CAST(n.publish_date AS VARCHAR) AS date, 'https://e.com/' || n.notice_id AS url, n.account AS source, r.basis, n.notice_id AS id
 FROM {NOTICES} n JOIN recency r USING (notice_id)"""
add("decision_log", f"WITH {_RECENCY}, logged AS ({_LOGGED}) SELECT 'weekly' AS run_id, * FROM logged UNION ALL SELECT 'kept only' AS run_id, * FROM logged WHERE status = 'kept'")
_RECENT_FILE = "doc_id % 60 >= 43"  # 60 days from 2026-03-01 on, cutoff 2026-04-13
add(
    "issue_file_items",
    f"""SELECT doc_id, section, section_ord, item_ord, title, content FROM ({ORACLES['read_digest_items']}) x WHERE {_RECENT_FILE} AND doc_id % 50 <> 7
 UNION ALL SELECT doc_id, 'unreadable', NULL, NULL, NULL, NULL FROM documents WHERE {_RECENT_FILE} AND doc_id % 50 = 7""",
)
_LIVE = f"WITH {_RECENCY} SELECT notice_id, title FROM recency WHERE reason <> 'publish_older_than_cutoff'"
add(
    "issue_memory",
    f"""SELECT DATE '2026-04-20' AS issue_date, notice_id, {_key('title')} AS title_key FROM ({_LIVE}) x WHERE notice_id % 10 NOT IN (3, 4, 6)
 UNION ALL SELECT DATE '2026-04-13', notice_id, {_key('title')} FROM ({at_run('2026-04-13', _LIVE)}) x WHERE notice_id % 10 NOT IN (4, 6)""",
)
_FEED = f"WITH uniq AS (SELECT * FROM {_PLAIN_UNIQUE} u), recent AS (SELECT * FROM uniq WHERE publish_ts IS NULL OR publish_ts >= 1776038400), {relevance('recent', _FEED_TEXT, _FEED_BACK)}"
_FEED_FILED = _FILED.replace(ARTICLES, _FEED_KEPT)
add("ingest_articles", f"{_FEED} SELECT notice_id, section, publish_ts, md5(content) AS content_md5 FROM {_FEED_FILED} f")
add(
    "article_decisions",
    f"""{_FEED}, filed AS (SELECT notice_id, section FROM {_FEED_FILED} f)
 SELECT u.notice_id, coalesce(f.section, 'unknown') AS section, u.title, CASE WHEN r.keep THEN 'kept' ELSE 'dropped' END AS status,
  CASE WHEN r.notice_id IS NULL THEN 'publish_older_than_cutoff' WHEN r.keep THEN 'after_temporal_filter' ELSE r.reason END AS reason,
  CASE WHEN r.notice_id IS NULL THEN 'publish_prefilter' WHEN r.keep THEN 'mark_items' ELSE 'temporal_filter' END AS stage, u.url, u.account AS source
 FROM uniq u LEFT JOIN rel r USING (notice_id) LEFT JOIN filed f USING (notice_id)""",
)


add(
    "collected_feeds",
    f"""SELECT feed, feed_ord, notice_id, title, n.section, 'item' AS kind FROM {NOTICES} n
  JOIN (VALUES ('crawl_info', 1, '教务通知'), ('crawl_lib', 3, '图书馆信息'), ('crawl_physics', 5, '物理系学术报告')) f(feed, feed_ord, section) USING (section)
 UNION ALL SELECT feed, feed_ord, NULL, NULL, NULL, 'error' FROM (VALUES ('crawl_hall', 2), ('crawl_myhome', 4)) f(feed, feed_ord)""",
)
_HELD = ("教务通知", "图书馆信息", "物理系学术报告")
add(
    "section_placeholders",
    f"""SELECT section, '占位卡片' AS title, CASE WHEN section = '家园网信息' THEN {lit(rules.ERROR_BODY)} || {_BLANK} || '原因: 第4个来源' ELSE {lit(rules.PLACEHOLDER_BODY)} END AS content,
 CASE WHEN section = '家园网信息' THEN 'error' ELSE 'empty' END AS kind FROM {names(rules.REQUIRED_SECTIONS)} s WHERE section NOT IN ({', '.join(map(lit, _HELD))})""",
)
_NEW_INDEXED = f"(SELECT *, row_number() OVER (PARTITION BY section ORDER BY ordinal) AS item_index FROM {_RECENT_SCORED} y WHERE notice_id % 10 <> 3)"
_NEW_APPLIED = f"(SELECT i.* REPLACE (coalesce(r.score, i.score) AS score, coalesce(r.reason, i.reason) AS reason) FROM {_NEW_INDEXED} i LEFT JOIN {_REPLIES} r USING (section, item_index))"
_RUN = f"{_RECENCY}, {guardrails(_NEW_APPLIED)}, chosen AS (SELECT notice_id, section, title, content, ordinal FROM {_CHOSEN} c), {relevance('chosen', _TEXT, inline('content'))}"
_RUN_TEXTS = digest_sql(_RUN, "chosen", NOTICES)
add("issue_run", _RUN_TEXTS)
_RUN_CTES, _RUN_SELECT = _RUN_TEXTS.rsplit(" SELECT section, section_ord,", 1)
add(
    "issue_log",
    f"""{_RUN_CTES}, printed AS (SELECT section, section_ord,{_RUN_SELECT}), ends AS (
  SELECT n.notice_id AS id, n.section, n.title, n.account AS source, g.tags, c2.notice_id IS NOT NULL AS kept,
   CASE WHEN r.reason = 'publish_older_than_cutoff' THEN r.reason WHEN n.notice_id % 10 = 3 THEN 'in_previous_issue' WHEN c1.notice_id IS NULL THEN 'below_section_best' WHEN NOT l.keep THEN l.reason
    WHEN c2.notice_id IS NOT NULL THEN 'selected_for_final_markdown' WHEN n.section = '其他公众号信息' THEN 'max_wechat_items' WHEN n.section <> '物理系学术报告' THEN 'fallback_max_items_per_section'
    WHEN p.notice_id IS NULL THEN 'expired_physics_event' ELSE 'max_items_per_section' END AS reason,
   CASE WHEN r.reason = 'publish_older_than_cutoff' THEN 'ranked_raw_publish_filter' WHEN n.notice_id % 10 = 3 THEN 'previous_issue' WHEN c1.notice_id IS NULL THEN 'ranked_selection' WHEN NOT l.keep THEN 'temporal_filter' ELSE 'section_filter' END AS stage
  FROM {NOTICES} n JOIN recency r USING (notice_id) LEFT JOIN guarded g USING (notice_id) LEFT JOIN chosen c1 USING (notice_id) LEFT JOIN rel l USING (notice_id) LEFT JOIN placed p USING (notice_id) LEFT JOIN cut c2 USING (notice_id))
 SELECT section, title, CASE WHEN kept THEN 'kept' ELSE 'dropped' END AS status, reason, stage, '' AS date, '' AS url, source, id, tags FROM ends
 UNION ALL SELECT section, '', 'empty', 'no_item_printed', 'render_digest', '', '', '', NULL, NULL FROM printed WHERE items = 0
 UNION ALL SELECT 'unknown', '', 'error', error, 'crawl', '', '', stage, NULL, NULL FROM {v(I.STAGE_ERRORS)} e WHERE error <> ''""",
)


_SECTION_BLOCKS = f"""hlines AS (SELECT doc_id, unnest(string_split(text, {NL})) AS line, generate_subscripts(string_split(text, {NL}), 1) AS n FROM {v(I.TENDENCIES)} t),
 heads AS (SELECT *, length(regexp_extract(line, '^(#{{1,3}})[ \\t].*\\S', 1)) AS level, {swap("regexp_extract(line, '^#{1,3}[ ' || chr(9) || '](.*)', 1)", f'{WS}+')} AS key FROM hlines),
 wanted AS (SELECT * FROM (VALUES ('教务通知', '教务通知'), ('图书馆信息', '图书馆信息'), ('图书馆信息', '图书馆'), ('家园网信息', '家园网信息'), ('物理系学术报告', '物理系学术报告')) w(section, key)),
 starts AS (SELECT doc_id, w.section, min(n) AS n0, arg_min(level, n) AS l0 FROM heads JOIN wanted w USING (key) WHERE level > 0 GROUP BY 1, 2),
 spans AS (SELECT s.*, (SELECT min(h.n) FROM heads h WHERE h.doc_id = s.doc_id AND h.n > s.n0 AND h.level BETWEEN 1 AND s.l0) AS n1 FROM starts s),
 inner_lines AS (SELECT s.doc_id, s.section, h.n, h.line FROM spans s JOIN heads h ON h.doc_id = s.doc_id AND h.n > s.n0 AND h.n < coalesce(s.n1, 1000000000)),
 sblocks AS (SELECT s.doc_id, s.section, {swap(trim(f"coalesce((SELECT string_agg(i.line, {NL} ORDER BY i.n) FROM inner_lines i WHERE i.doc_id = s.doc_id AND i.section = s.section), '')"), chr(92) + 'n{3,}', chr(10) * 2)} AS block FROM spans s)"""
add("section_blocks", f"WITH {_SECTION_BLOCKS} SELECT * FROM sblocks")
_human = rf"{rules.HUMAN_SCORE_LABEL}[：:]{WS}*({DIGIT}{{1,3}})(?:{WS}*/{WS}*100)?(?:[（(]([^）)]*)[）)])?"
_machine = rf"{rules.SCORE_LABEL}[：:]{WS}*({DIGIT}{{1,3}})"
_SECTION_SAMPLES = f"""{_SECTION_BLOCKS}, slines AS (SELECT doc_id, section, unnest(string_split(block, {NL})) AS line, generate_subscripts(string_split(block, {NL}), 1) AS n FROM sblocks
   WHERE contains(block, '重要性评分') OR contains(block, '物理系本科生偏好评分')),
 sitems AS (SELECT *, sum(CAST(regexp_matches(line, '^## .*\\S') AS INT)) OVER (PARTITION BY doc_id, section ORDER BY n) AS item FROM slines),
 sbodies AS (SELECT doc_id, section, item, {trim("substr(arg_min(line, n), 4)")} AS title, string_agg(line, {NL} ORDER BY n) AS body FROM sitems WHERE item > 0 GROUP BY 1, 2, 3),
 sread AS (SELECT *, coalesce({first('body', _human, 1)}, {first('body', _machine, 1)}) AS s, coalesce({trim(first('body', '(?:原因|理由|排序依据)[：:]' + WS + '*([^' + chr(92) + 'n]+)', 1))}, {trim(first('body', _human, 2))}, '') AS reason FROM sbodies),
 samples AS (SELECT doc_id, section, item, title, least(100, CAST(s AS INT)) AS score, reason FROM sread WHERE s IS NOT NULL)"""
add("section_samples", f"WITH {_SECTION_SAMPLES} SELECT doc_id, section, title, score, reason FROM samples")
add(
    "sample_digest",
    f"""WITH {_SECTION_SAMPLES}, told AS (SELECT section, substr({lit(rules.EXAMPLES_HEAD)} || {NL} || string_agg('- ' || title || ' => ' || score || '/100' || CASE WHEN reason <> '' THEN '；' || reason ELSE '' END, {NL} ORDER BY doc_id, item), 1, 3200) AS lines FROM samples GROUP BY 1),
 raw AS (SELECT section, substr(arg_min(block, doc_id), 1, 3000) AS head FROM sblocks WHERE contains(block, '重要性评分') OR contains(block, '物理系本科生偏好评分') GROUP BY 1)
 SELECT section, coalesce(lines, head) AS examples FROM raw LEFT JOIN told USING (section)""",
)


add(
    "resumed_calls",
    f"""SELECT notice_id, {_ANSWER} AS raw, CASE WHEN {_ANSWER} IS NULL THEN 'empty reply' END AS error,
 CASE WHEN {_ANSWER} IS NULL AND notice_id % 2 = 0 THEN 2 ELSE 1 END AS asked FROM {NOTICES} n""",
)


def _page_text(x: str) -> str:
    x = swap(swap(x, r"(?i)<img\b[^>]*>"), r"(?i)<table[\s\S]*?</table>", "[[TABLE_0]]")
    x = swap(swap(x, r"(?is)<!--.*?-->"), r"(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<title[^>]*>.*?</title>")
    x = swap(x, r"\s+", " ")
    for level in range(1, 7):
        x = swap(x, rf"(?i)<h{level}(?:\s[^>]*)?>\s*", "\n" + "#" * level + " ")
    x = swap(swap(x, r"(?i)<li(?:\s[^>]*)?>\s*", "\n* "), r"(?i)</?(?:" + "|".join(rules.BLOCK_TAGS) + r")(?:\s[^>]*|/)?>", "\n")
    x = unescaped(swap(x, "<[^>]+>"))
    x = trim(swap(swap(x, r"[ \t]*\n[ \t]*", "\n"), r"\n{2,}", "\n"))
    return x


_TABLE = f"{NL} || {NL} || '| 名称 | A\\|B |' || {NL} || '| --- | --- |' || {NL} || '| ' || page_id || ' |  |' || {NL} || {NL}"
add(
    "html_to_text",
    f"""SELECT page_id, replace({swap(f"replace({_page_text('html')}, '[[TABLE_0]]', {_TABLE})", chr(92) + 'n{3,}', chr(10) * 2)}, {NL}, {NL} || {NL}) AS text FROM {v(I.PAGE_PARTS)} p""",
)
