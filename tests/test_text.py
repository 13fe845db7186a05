import html as stdlib_html
import re

from pyspark.sql import functions as F

from bulletin.functions import html as H
from bulletin.functions import text as X
from bulletin.functions import urls as U


def test_clean_markdown(values):
    dirty = [
        "﻿<p>甲</p><script>x</script>乙<br/>丙 &amp; &lt;",
        "**粗** 与 *斜* __底__ _线_ `码`",
        "# 标题 #\n\n\n\n## 小节\n> 引用\n---\n尾",
        "![图](a.png) [链](b) \\*星\\*",
        "****\n***a***\n1*2*3",
        "  行  \n \t \n\n 末  ",
        "plain text, nothing to do",
        "-*-\n甲\n_*_x",
    ]
    assert values(X.clean_markdown, dirty) == [
        "甲\n乙\n丙 & <",
        "粗 与 斜 底 线 码",
        # blank lines before a heading belong to its match
        "# 标题 #\n### 小节\n引用\n\n尾",
        # emphasis goes before backslash escapes
        "图 链 \\星\\",
        "***a***\n123",
        "行\n\n末",
        "plain text, nothing to do",
        "甲\n*x",
    ]


def test_unescape_matches_standard_library(values):
    texts = ["a &amp; b", "&lt;&gt", "&ampfoo; &notit; &nope; &", "&#65;&#x42;&#0;&#150;&#xD800;&#11;&#x1F600; &#65x", "&&amp;amp;", "", "&acE;", "&#13;&#xFDD0;"]
    assert values(H.unescape, texts) == [stdlib_html.unescape(t) for t in texts]


def test_normalize_headings(spark):
    df = spark.createDataFrame([("\n# 标题\n\n  ## 小节\n#\n正文", "标题"), ("正文\n# 标题", "标题"), ("", "x"), ("\n\n", "")], "b string, t string")
    assert [r[0] for r in df.select(X.normalize_headings(df.b, df.t)).collect()] == ["### 小节\n#\n正文", "正文\n### 标题", "", ""]


def test_repair_mojibake(values):
    broken = "学术报告".encode().decode("latin-1")
    quoted = "“时间”地点".encode().decode("cp1252", errors="ignore")
    assert values(X.repair_mojibake, [f"ok\n{broken}", "café", "时间", None])[:3] == ["ok\n学术报告", "café", "时间"]
    fixable = "报告时间‘四’".encode()
    try:
        seen = fixable.decode("cp1252")
    except UnicodeDecodeError:
        seen = None
    assert quoted and (seen is None or values(X.repair_mojibake, [seen]) == [fixable.decode()])


def test_units_and_clip(values):
    texts = ["中文 two words，三", "a b c d", "！！！甲乙", ""]
    assert values(X.text_units, texts) == [5, 4, 2, 0][:4]
    assert values(lambda c: X.clip_units(c, 3), texts) == ["中文 two", "a b c", "！！！甲乙", ""]


def test_compress_body(spark):
    long = "字" * 300
    rows = [("短文", "", "x"), (long, "要点", "x"), ("内容摘要：" + long, "", "物理系学术报告"), (long, "点" * 70, "x"), (long, "点" * 200, "x")]
    df = spark.createDataFrame(rows, "c string, s string, sec string")
    got = [len(r[0]) for r in df.select(X.compress_body(df.c, df.s, df.sec)).collect()]
    assert got == [2, 228, 305, 160, 80]


def test_report_fields(values):
    text = "导航\n**报告人：** 王\n报告时间：2026年4月2日\n摘要：第一段\n\n\n\n第二段\n报告地点：W101\n上一篇"
    assert values(lambda c: X.labelled_field(c, ["报 告 人", "报告人"]), [text]) == ["王"]
    assert values(X.report_summary, [text, "Abstract: x\n版权所有", "无"]) == ["第一段\n\n第二段", "x", ""]
    trimmed = values(lambda c: X.trim_report_text(c, F.lit("题")), ["前\n题目\n后\n上一篇\n无", "无标记"])
    assert trimmed == ["题目\n后", "无标记"]
    assert values(X.lecture_segment, ["x第3讲：光学 教师 李", "第3讲：光学", "无"]) == ["第3讲：光学", "第3讲：光学", "无"]


def test_fit_field(values):
    assert values(lambda c: X.fit_field(c, "title"), ["字" * 40, "a  b\n", "\\u901a 知"]) == ["字" * 21, "a b", "通 知"]
    assert values(lambda c: X.fit_field(c, "title", fallback="无"), [" ", None]) == ["无", "无"]
    digest = values(lambda c: X.fit_field(c, "digest"), ["a" * 60, "字" * 60])
    assert digest == ["a" * 54 + "...", "字" * 40]
    assert values(lambda c: X.fit_field(c, "source_url"), ["https://e.com/x", "ftp://e.com", "https://"]) == ["https://e.com/x", "", ""]


def test_embedded_score(values):
    body = "重要性评分: 70/100\n\n排序依据: 因\n\n正文\n  重要性评分:  250/100"
    assert values(X.embedded_score, [body, "无"]) == [100, 0]
    assert values(X.without_score_lines, [body]) == ["正文"]


def test_split_label_limit(spark):
    df = spark.createDataFrame([("日期: 明天",), ("这个标签实在是太长了超过十二: 值",), ("一: ",)], "t string")
    label, value = X.split_label(df.t)
    assert [tuple(r) for r in df.select(label, value).collect()] == [("日期", "明天"), ("", "这个标签实在是太长了超过十二: 值"), ("一", "")]


def test_canonical_url(values):
    got = values(
        U.canonical_url,
        ["https://E.com/s?b=2&a=1&sn=x&b=3&e=#frag", "HTTP://e.com", "/p?x=a+b", "https://e.com/?q=%E4%B8%AD~*", None, "https://e.com/a?chksm=1"],
    )
    assert got == ["https://E.com/s?a=1&b=2", "http://e.com", "/p?x=a+b", "https://e.com/?q=%E4%B8%AD~%2A", "", "https://e.com/a"]


def test_url_building(values):
    assert values(lambda c: U.normalize_url(c, "https://s.com"), ["//a/b", "/p?x=1&amp;y=2", " ", None]) == ["https://a/b", "https://s.com/p?x=1&y=2", None, None]
    assert values(lambda c: U.set_query_param(c, "lmid", "A"), ["x?lmid=all&b=1", "x?b=1", "x"]) == ["x?lmid=A&b=1", "x?b=1&lmid=A", "x?lmid=A"]
    base = F.lit("https://e.com/a/b.htm?q=1")
    refs = ["c.png", "../c.png", "/c.png", "//d.com/c.png", "?z", "#f", "http://x/y", "./c"]
    assert values(lambda c: U.resolve_url(base, c), refs) == [
        "https://e.com/a/c.png", "https://e.com/c.png", "https://e.com/c.png", "https://d.com/c.png",
        "https://e.com/a/b.htm?z", "https://e.com/a/b.htm?q=1#f", "http://x/y", "https://e.com/a/c",
    ]


def test_highlight_times(values):
    got = values(X.highlight_times, ["4月25日 周六 13:30-15:00 <x>"])[0]
    assert got == "<span class='time-highlight'>4月25日 周六</span> <span class='time-highlight'>13:30-15:00</span> &lt;x&gt;"
    assert re.search("&lt;", got)


def test_html_string(spark):
    rows = [
        ('{"data":{"html":"<b>1</b>"}}', "<b>1</b>"), ('{"text":"plain","x":{"y":{"z":{"w":"<i>deep</i>"}}}}', "<i>deep</i>"),
        ('"<p>s</p>"', "<p>s</p>"), ('{"a":1}', ""), ("broken", ""), ("<broken>", ""), (None, ""), ('{"k":"\\u003ci\\u003e"}', "<i>"),
        ('{"data":{"zzz":"<a>1</a>"},"text":"<b>2</b>"}', "<a>1</a>"), ('{"a":"<x>","data":{"q":[{"content":"<c>3</c>"}]}}', "<c>3</c>"), ('{"<k>":"v","m":"<z>w</z>"}', "<z>w</z>"),
        ('[[],["no",{"deep":[[{"body":["<d>"]}]]}]]', "<d>"), ('{"other":"<o>","html":" <h> "}', "<h>"), ('{"q":"<a href=\\"x\\">"}', '<a href="x">'),
    ]
    df = spark.createDataFrame(rows, "raw string, want string")
    assert all(r.got == r.want for r in df.select(H.html_string("raw").alias("got"), "want").collect())


def test_main_content(values):
    pages = [
        "<body><div class='v_news_content'>甲<div>乙</div><br>丙</div>尾</body>",
        "<div id='vsb_content'>短</div><div class='wp_articlecontent'>长一些</div>",
        "<article>文</article>", "<body>体<nav>航</nav></body>", "裸",
    ]
    assert values(H.main_content, pages) == ["甲<div>乙</div><br>丙", "长一些", "文", "体", "裸"]
