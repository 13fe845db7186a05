"""Notice-shaped views of the driver tables.

The driver tables hold Latin prose without dates. Each view below derives the columns
an operator reads, in SQL that Spark and DuckDB read alike; ``{name}`` is a table and
doubled braces are literal ones.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

RUN_DATE = "2026-04-20"
#: Issues of a run over several weeks.
RUN_DATES = ["2026-03-30", "2026-04-13", RUN_DATE]

_SECTION = (
    "CASE doc_id % 5 WHEN 0 THEN '教务通知' WHEN 1 THEN '物理系学术报告' WHEN 2 THEN '图书馆信息' "
    "WHEN 3 THEN '家园网信息' ELSE '其他公众号信息' END"
)


def _s(expr: str) -> str:
    return f"CAST({expr} AS VARCHAR(20))"


NOTICES = f"""
SELECT doc_id AS notice_id, {_SECTION} AS section,
 concat(CASE doc_id % 7 WHEN 0 THEN '选课通知' WHEN 1 THEN '学术报告' WHEN 2 THEN '研究生招聘公示'
   WHEN 3 THEN '音乐会预热' WHEN 4 THEN 'SRT报名截止' WHEN 5 THEN '宿舍熄灯安排' ELSE '数据库课堂' END,
   ' ', {_s('doc_id')}) AS title,
 concat('发布时间：', {_s('year(pub)')}, '年', {_s('month(pub)')}, '月', {_s('day(pub)')}, '日', chr(10),
   CASE doc_id % 3 WHEN 0 THEN concat('报名截止：', CAST(ev AS VARCHAR(10)), ' 17:00')
     WHEN 1 THEN concat('活动时间：', {_s('month(ev)')}, '月', {_s('day(ev)')}, '日')
     ELSE '' END, chr(10), text) AS content,
 pub AS publish_date, source AS account, doc_id AS ordinal
FROM (SELECT *, date '2026-03-01' + CAST(doc_id % 60 AS INT) AS pub,
             date '2026-03-05' + CAST((doc_id * 7) % 70 AS INT) AS ev FROM {{documents}}) x
"""

ARTICLES = f"""
SELECT doc_id AS ordinal, doc_id AS notice_id,
 concat(CASE doc_id % 6 WHEN 0 THEN '学生会权益' WHEN 1 THEN '创新创业大赛' WHEN 2 THEN '志愿者招募'
   WHEN 3 THEN '百团招新' WHEN 4 THEN '校园新闻' ELSE '开题讲座' END, ' ', {_s('doc_id')}) AS title,
 concat('https://mp.example.com/s?scene=', {_s('doc_id % 5')}, '&biz=', {_s('doc_id % 17')}, '&mid=',
   {_s('doc_id % 300')}, '&sn=', {_s('doc_id')}, '#rd') AS url,
 CASE WHEN doc_id % 4 = 0 THEN '' ELSE concat('要点 ', {_s('doc_id')}) END AS digest,
 CASE WHEN doc_id % 9 = 0 THEN NULL ELSE 1775000000 + (doc_id * 7919 % 40) * 86400 END AS publish_ts,
 CASE WHEN doc_id % 5 = 0 THEN '' ELSE concat('2026年4月', {_s('1 + doc_id % 28')}, '日') END AS publish_text,
 CASE WHEN doc_id % 3 = 0 THEN {_s('doc_id % 200')} ELSE '' END AS mid,
 CASE WHEN doc_id % 3 = 0 THEN {_s('doc_id % 2')} ELSE '' END AS idx,
 concat('id', {_s('doc_id % 100')}) AS fakeid,
 CASE doc_id % 5 WHEN 0 THEN '校学生会' WHEN 1 THEN '青年科创' ELSE source END AS account,
 CASE WHEN doc_id % 2 = 0 THEN '' ELSE '编辑部' END AS author,
 text AS content
FROM {{documents}}
"""

# One payload per document: two records, alias field names, the list under varying keys.
FEEDS = f"""
SELECT doc_id AS feed_id, source AS account_keyword,
 concat('{{{{"code":0,"', CASE doc_id % 4 WHEN 0 THEN 'list' WHEN 1 THEN 'items' WHEN 2 THEN 'rows' ELSE 'articles' END,
  '":[{{{{"', CASE doc_id % 2 WHEN 0 THEN 'title' ELSE 'name' END, '":"T', {_s('doc_id')}, '","',
  CASE doc_id % 3 WHEN 0 THEN 'url' WHEN 1 THEN 'link' ELSE 'content_url' END, '":"',
  CASE doc_id % 5 WHEN 0 THEN concat('/s?id=', {_s('doc_id')}) WHEN 1 THEN concat('//m.example.com/', {_s('doc_id')})
    WHEN 2 THEN '' ELSE concat('https://example.com/', {_s('doc_id')}) END,
  '","create_time":', {_s('1775000000 + doc_id')}, ',"aid":"', {_s('doc_id % 50')}, '_', {_s('doc_id % 3')},
  '","mid":"', CASE WHEN doc_id % 7 = 0 THEN {_s('doc_id')} ELSE '' END, '"}}}},{{{{"name":"","link":"https://example.com/second/',
  {_s('doc_id')}, '","summary":"摘要', {_s('doc_id')}, '","datetime":"2026-04-12 08:30","appmsgid":',
  {_s('doc_id')}, ',"itemidx":2}}}}]}}}}') AS raw
FROM {{documents}}
"""

ACCOUNT_CANDIDATES = f"""
SELECT n_name AS keyword, n_nationkey AS keyword_ord, s_suppkey AS pos,
 CASE WHEN s_suppkey % 10 = 0 THEN '' ELSE concat('id', {_s('s_suppkey % 100')}) END AS fakeid
FROM {{supplier}} JOIN {{nation}} ON s_nationkey = n_nationkey
"""

DIGESTS = f"""
SELECT doc_id,
 concat(CASE WHEN doc_id % 4 = 0 THEN concat('## 散件 ', {_s('doc_id')}, chr(10), '开头正文', chr(10)) ELSE concat('丢弃的行', chr(10)) END,
  '# ', {_SECTION}, '  ', chr(10), '分节前言', chr(10), '## 条目甲 ', {_s('doc_id')}, chr(10), chr(10),
  '日期: 2026-04-', lpad({_s('1 + doc_id % 28')}, 2, '0'), chr(10), text, chr(10), '### 小标题', chr(10),
  '重要性评分: ', {_s('doc_id % 130')}, '/100', chr(10), '排序依据: 规则', chr(10), '![配图](https://e.com/x.png)', chr(10),
  '# 图书馆信息', chr(10), '##   条目乙', chr(10), chr(10), text, chr(10), '# ', chr(10), '## ', chr(10), '尾行') AS text
FROM {{documents}}
"""

PREFERENCES = f"""
SELECT doc_id,
 concat('# ', {_SECTION}, chr(10), '## 样例 ', {_s('doc_id')}, chr(10),
  '重要性评分: ', {_s('doc_id % 101')}, '/100', chr(10),
  CASE doc_id % 3 WHEN 0 THEN concat('物理系本科生偏好评分：', {_s('doc_id % 140')}, '（备注', {_s('doc_id')}, '）')
    WHEN 1 THEN concat('物理系本科生偏好评分：', {_s('doc_id % 90')}, '/100') ELSE '' END, chr(10),
  CASE WHEN doc_id % 4 = 0 THEN concat('理由：说明', {_s('doc_id')}) ELSE '' END, chr(10),
  '正文', chr(10), '## 未评分', chr(10), '正文') AS text
FROM {{documents}}
"""

# Sections at every level, some twice, some by another name, with whole texts between them.
TENDENCIES = f"""
SELECT doc_id,
 concat(CASE doc_id % 3 WHEN 0 THEN concat('前言', chr(10)) ELSE '' END,
  CASE doc_id % 4 WHEN 0 THEN '# 教务 通知' WHEN 1 THEN '##  图书馆' WHEN 2 THEN '### 家园网信息' ELSE '# 物理系学术报告' END, chr(10), '导语', chr(10),
  CASE WHEN doc_id % 4 IN (0, 3) THEN concat('## 样例 ', {_s('doc_id')}, chr(10), text, chr(10), '### 细节', chr(10),
     CASE doc_id % 5 WHEN 0 THEN '' WHEN 1 THEN concat('物理系本科生偏好评分：', {_s('doc_id % 140')}, '（备注', {_s('doc_id')}, '）') ELSE concat('重要性评分: ', {_s('doc_id % 101')}, '/100') END, chr(10),
     CASE WHEN doc_id % 7 = 0 THEN concat('理由：说明', {_s('doc_id')}) ELSE '' END, chr(10), '## 第二条', chr(10), '重要性评分：', {_s('doc_id % 50')}, chr(10), '####  不是标题', chr(10))
   ELSE concat('### 说明', chr(10), CASE WHEN doc_id % 8 < 5 THEN '重要性评分的写法' ELSE '' END, chr(10), chr(10), chr(10), chr(10), text, chr(10)) END,
  CASE doc_id % 4 WHEN 1 THEN '## 别的' WHEN 2 THEN '## 更高一级' ELSE '# 另一栏' END, chr(10), '## 外面的', chr(10), '重要性评分: 77', chr(10),
  '# 教务通知', chr(10), '## 重复的', chr(10), '重要性评分: 1', chr(10)) AS text
FROM {{documents}}
"""

REPORTS = f"""
SELECT doc_id AS notice_id, doc_id AS ordinal, {_SECTION} AS section,
 concat(CASE doc_id % 6 WHEN 0 THEN '学术报告' WHEN 1 THEN '招聘信息报告' WHEN 2 THEN 'Colloquium' WHEN 3 THEN '通知'
   WHEN 4 THEN '新闻动态' ELSE '讲座' END, ' ', {_s('doc_id')}) AS title,
 concat('https://phys.example.com/r/', {_s('doc_id')}) AS url,
 concat('首页导航', chr(10), '**报告题目：** 题 ', {_s('doc_id')}, chr(10),
  CASE doc_id % 3 WHEN 0 THEN '报告人：' WHEN 1 THEN '报 告 人: **' ELSE '主讲：' END, ' 教授', {_s('doc_id')}, chr(10),
  CASE doc_id % 4 WHEN 0 THEN '报告时间：' WHEN 1 THEN '时间: ' WHEN 2 THEN '活动时间：' ELSE '日程 ' END,
  '2026年4月', {_s('1 + doc_id % 28')}, '日 ', {_s('8 + doc_id % 12')}, ':30', chr(10),
  '报告地点：', CASE doc_id % 2 WHEN 0 THEN '物理楼W101' ELSE '主楼' END, chr(10),
  CASE doc_id % 4 WHEN 0 THEN '摘要：' WHEN 1 THEN '**内容摘要：**' WHEN 2 THEN 'Abstract: ' ELSE '第3讲：' END,
  text, chr(10), chr(10), chr(10), chr(10), '教师 附注', chr(10), '上一篇', chr(10), '无') AS content
FROM {{documents}}
"""

DIRTY = f"""
SELECT doc_id, text,
 concat('<div class="a">', chr(10), '# 标题 ', {_s('doc_id')}, chr(10), chr(10), '**粗体** 与 *斜体* ', chr(10), '![图](https://e.com/a.png) [链接](https://e.com)',
  chr(10), '[图片文字 2] 删除', chr(10), '  ##  小节', chr(10), '#', chr(10), chr(10), chr(10), text, '</div>',
  CASE WHEN doc_id % 3 = 0 THEN '???? Source: Unknown' ELSE '' END, chr(10), '报告 时间 地点',
  CASE WHEN doc_id % 5 = 0 THEN ' ÃÃÃÃÃ' ELSE '' END) AS dirty,
 concat('标题 ', {_s('doc_id')}) AS title
FROM {{documents}}
"""

HALL = f"""
SELECT o_orderkey AS ordinal, concat('演出 ', {_s('o_custkey % 200')}) AS title,
 CAST(CAST(o_orderdate AS DATE) AS VARCHAR(10)) AS date, o_orderpriority AS location,
 concat(o_orderstatus, {_s('o_orderkey % 7')}, '0元') AS price, concat('https://e.com/', {_s('o_orderkey')}, '.jpg') AS absolute_src
FROM {{orders}}
"""

HALL_PAGES = f"""
SELECT c_custkey AS page_id, 'https://hall.example.com/list/1' AS url,
 concat('<html><body><div class="timemain_a"><b class="size_40">', {_s('1 + c_custkey % 28')}, '</b> 2026-04 <b class="size_bg">19:30</b>',
  '<h3 class="yahei"><a href="/x">', c_name, '</a></h3><ul><li class="add">剧场', {_s('c_nationkey')}, '<br></li></ul>',
  '<span class="money">', {_s('c_custkey % 9')}, '0</span><img src="/img/', {_s('c_custkey')}, '.png"></div>',
  '<div class="timemain_a"><h3 class="yahei"><a>Second</a></h3><img src="b.png"></div></body></html>') AS html
FROM {{customer}}
"""

DATE_TEXTS = f"""
SELECT o_orderkey AS notice_id, o_orderdate AS at,
 CASE o_orderkey % 7
  WHEN 0 THEN concat('于', {_s('year(o_orderdate)')}, '年', {_s('month(o_orderdate)')}, '月', {_s('day(o_orderdate)')}, '日13:30举行')
  WHEN 1 THEN concat({_s('month(o_orderdate)')}, '月', {_s('day(o_orderdate)')}, '日 9:05')
  WHEN 2 THEN concat(CAST(CAST(o_orderdate AS DATE) AS VARCHAR(10)), ' 25:75')
  WHEN 3 THEN concat({_s('2020 + o_orderkey % 10')}, '/', {_s('1 + o_orderkey % 13')}, '/', {_s('1 + o_orderkey % 31')}, ' 8：00')
  WHEN 4 THEN concat({_s('2020 + o_orderkey % 10')}, '.', {_s('month(o_orderdate)')}, '.', {_s('day(o_orderdate)')}, ' 周六 13:30')
  WHEN 5 THEN concat({_s('month(o_orderdate)')}, '月3１日', '2:10')
  ELSE o_orderpriority END AS text,
 CASE o_orderkey % 6
  WHEN 0 THEN {_s('1700000000 + o_orderkey')} WHEN 1 THEN concat(CAST(CAST(o_orderdate AS DATE) AS VARCHAR(10)), ' 08:30')
  WHEN 2 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR(10)) WHEN 3 THEN concat(CAST(CAST(o_orderdate AS DATE) AS VARCHAR(10)), ' 08:30:15')
  WHEN 4 THEN '0' ELSE ' n/a ' END AS epoch_text
FROM {{orders}}
"""

# Run dates as a scheduler writes them, some unreadable, some with a cutoff of their own.
RUNS = f"""
SELECT o_orderkey AS run_id,
 CASE o_orderkey % 5 WHEN 0 THEN replace(CAST(CAST(o_orderdate AS DATE) AS VARCHAR(10)), '-', '') WHEN 1 THEN concat(' ', CAST(CAST(o_orderdate AS DATE) AS VARCHAR(10)), ' ')
  WHEN 2 THEN concat({_s('year(o_orderdate)')}, '-', {_s('month(o_orderdate)')}, '-', {_s('day(o_orderdate)')}) WHEN 3 THEN o_orderpriority
  ELSE concat({_s('year(o_orderdate)')}, '-13-40') END AS run_date,
 CASE WHEN o_orderkey % 4 = 0 THEN CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) - INTERVAL '36' HOUR END AS cutoff
FROM {{orders}}
"""

LINKS = f"""
SELECT o_orderkey AS notice_id,
 concat(CASE o_orderkey % 4 WHEN 0 THEN 'https://Mp.example.com/s' WHEN 1 THEN '//m.example.com/p' WHEN 2 THEN '/local/p' ELSE 'HTTP://example.org' END,
  '?b=', {_s('o_custkey')}, '&sn=', {_s('o_orderkey')}, '&a=x+y%20z&empty=&b=second&', CASE WHEN o_orderkey % 3 = 0 THEN 'lmid=all&' ELSE '' END,
  'q=%E4%B8%AD~*', CASE WHEN o_orderkey % 2 = 0 THEN '#top' ELSE '' END) AS url
FROM {{orders}}
"""

PAGE_META = f"""
SELECT page_id, url,
 concat(html, CASE page_id % 3 WHEN 0 THEN concat('<em id="publish_time" class="t"> 2026-04-', {_s('10 + page_id % 20')}, ' </em>')
   WHEN 1 THEN concat('<script>var publish_time = "2026-03-', {_s('10 + page_id % 20')}, '";</script>') ELSE '' END,
  CASE page_id % 4 WHEN 0 THEN concat('<span id="js_author_name" x="1">编辑', {_s('page_id')}, '</span>')
   WHEN 1 THEN 'var author = " 小组 ";' ELSE '' END) AS html
FROM {{pages}}
"""

PAGE_PARTS = f"""
SELECT page_id, url,
 concat(html, '<table class="t"><tr><th>名称</th><th>A|B</th></tr><tr><td><b>', {_s('page_id')}, '</b></td></tr></table>',
  '<img alt="no source"><img src="/img/', {_s('page_id')}, '.png"><img data-src="//cdn.example.com/b.png" src="x.gif">',
  '<script src="http://localhost:8080/app.js"></script><img src="pics/../c.png">') AS html
FROM {{pages}}
"""

OCR_REPLIES = f"""
SELECT conv_id, turn,
 concat('{{{{"IsErroredOnProcessing":', CASE WHEN turn % 5 = 4 THEN 'true' ELSE 'false' END,
  ',"ParsedResults":[{{{{"ParsedText":" ', role, ' ', {_s('conv_id')}, ' "}}}},{{{{"ParsedText":"   "}}}},{{{{"ParsedText":"第', {_s('turn')}, '行"}}}}]}}}}') AS raw
FROM {{conversations}}
"""

SCORE_REPLIES = f"""
SELECT section, concat('好的：{{{{"items":[{{{{"index":', {_s('item_index')}, ',"score":"', {_s('quality * 80')}, '.5","reason":"',
  CASE WHEN doc_id % 3 = 0 THEN '' ELSE '模型' END, '"}}}},{{{{"index":"x","score":1}}}},{{{{"index":', {_s('item_index')}, ',"score":"bad"}}}}]}}}} 以上') AS raw
FROM (SELECT doc_id, quality, {_SECTION} AS section, CAST(floor(doc_id / 5) AS BIGINT) + 1 AS item_index FROM {{labels}}) x
"""

DECISION_REPLIES = f"""
SELECT doc_id AS notice_id, CASE WHEN doc_id % 5 = 4 THEN '' WHEN doc_id % 7 = 3 THEN '不确定' WHEN quality = 1 THEN ' yes.' ELSE 'No' END AS raw
FROM {{labels}}
"""

SELECTION_REPLIES = f"""
SELECT section, CASE section WHEN '家园网信息' THEN 'broken' ELSE concat('{{{{"keep_indices":[', {_s('n')}, ',2,2,"1",99999999,"x",', {_s('n - 1')}, ',5,7]}}}}') END AS raw
FROM (SELECT {_SECTION} AS section, count(*) AS n FROM {{documents}} GROUP BY 1) x
"""

REPORT_REPLIES = f"""
SELECT doc_id AS notice_id, CASE doc_id % 3 WHEN 0 THEN concat('{{{{"title":"模型题 ', {_s('doc_id')}, '","speaker":" 张三 ","time":"","summary":"模型摘要"}}}}')
  WHEN 1 THEN '{{{{"speaker":' ELSE '' END AS raw
FROM {{documents}}
"""

FEED_GROUPS = """
SELECT user_id AS feed_group, event_id, CASE event_type WHEN 'view' THEN 0 WHEN 'click' THEN 1 WHEN 'purchase' THEN 2 WHEN 'error' THEN 3 ELSE 4 END AS prio
FROM {events}
"""

DECISION_LOG = """
SELECT event_id, CASE WHEN user_id % 8 = 0 THEN '' ELSE CAST(user_id % 8 AS VARCHAR(20)) END AS section, event_type AS status,
 CASE WHEN event_id % 97 = 0 THEN NULL ELSE substring(props, 7, 2) END AS reason, ts
FROM {events}
"""

STAGE_ERRORS = """
SELECT CASE n_nationkey % 5 WHEN 0 THEN 'crawl_info' WHEN 1 THEN 'crawl_myhome' WHEN 2 THEN 'crawl_lib' ELSE concat('other', CAST(n_nationkey AS VARCHAR(20))) END AS stage,
 CASE WHEN n_nationkey >= 5 THEN '' WHEN n_nationkey = 3 THEN '  ' ELSE concat(' 连接超时 ', n_name, ' ') END AS error, n_nationkey AS stage_ord
FROM {nation}
"""

MARKED_ISSUES = f"""
SELECT doc_id, concat('# ', {_SECTION}, chr(10), '导语', chr(10), '## 卡片 ', {_s('doc_id')}, chr(10), '要点透视：', CASE doc_id % 3 WHEN 0 THEN '4月25日（周六）13:30-15:00 截止' ELSE '本周 <报名>' END, chr(10),
  '日期: 2026-04-', lpad({_s('1 + doc_id % 28')}, 2, '0'), chr(10), '链接: https://e.com/', {_s('doc_id')}, chr(10), 'https://e.com/a?b=1&c=2', chr(10),
  '- 列表 ', chr(10), '• 圆点', chr(10), '**加粗**', chr(10), '*注', chr(10), '### 小节', chr(10), '![海报](https://e.com/p.png)', chr(10),
  '[English](x)', chr(10), '* [导航](y)', chr(10), '这个标签实在是太长了超过十二: 值', chr(10), text) AS text
FROM {{documents}}
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, sql: str, deal: str | None = None) -> DataFrame:
    """Run a view over the tables it names.

    ``deal`` names a key by which the rows of its table are dealt out first: a view that
    makes whole pages of a few bytes would else do so in as few tasks as those bytes need.
    """
    names = set(re.findall(r"(?<!\{)\{([a-z]+)\}(?!\})", sql))
    tables = {name: table(spark, sf_dir, name) for name in names}
    if deal:
        # With a number, or adaptive execution joins the small partitions again.
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
        tables = {name: rows.repartition(tasks, deal) if deal in rows.columns else rows for name, rows in tables.items()}
    return spark.sql(sql, **tables)


def for_duckdb(sql: str) -> str:
    """The same view over DuckDB's registered tables."""
    names = set(re.findall(r"(?<!\{)\{([a-z]+)\}(?!\})", sql))
    return sql.format(**{name: name for name in names})
