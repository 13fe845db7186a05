"""Headings bounded by their level, and what a preference corpus says about a section."""

import re

from bulletin import rules
from bulletin.operators import headings

SECTIONS = ["教务通知", "图书馆信息", "家园网信息", "空栏目"]
CORPUS = """前言
# 教 务通知
导语
## 甲 
重要性评分: 150/100
正文
### 细节
理由：要紧
## 乙
物理系本科生偏好评分：７0（备注）
#### 不是标题
## 丙
没有评分
# 其他
## 外面
重要性评分: 3
## 图书馆
一行


两行 重要性评分 的写法
### 下一级
还在里面
## 同级
不在里面
### 家园网信息
没有分数
# 教务通知
## 重复
重要性评分: 1"""


def frame(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_path int, text string")


def plain_block(text, names):
    """The definition, line by line: a stack is not needed for one heading."""
    lines, out, level = text.replace("\r\n", "\n").split("\n"), None, 0
    for line in lines:
        head = re.match(r"(#{1,3})[ \t](.*\S)", line)
        if out is None:
            if head and re.sub(r"\s", "", head[2]) in names:
                out, level = [], len(head[1])
        elif head and len(head[1]) <= level:
            break
        else:
            out.append(line)
    return None if out is None else re.sub(r"\n{3,}", "\n\n", "\n".join(out).strip())


def test_blocks_equal_the_definition(spark):
    texts = [CORPUS, CORPUS.replace("\n", "\r\n"), "# 教务通知", "# 教务通知\n# 教务通知\n## a", "", None, "#教务通知\n正文", "### 教务通知\n#### x\n## y", "## 图书馆信息\n\n### 图书馆\nx\n# z"]
    texts.append("\n".join(f"{'#' * (i % 4)} 教务通知 {i}\n行 {i}" for i in range(300)) + "\n## 教务通知\n末尾\n### 内\n" + "长" * 50_000)
    got = {(r.doc_path, r.section): r.block for r in headings.section_blocks(frame(spark, texts), SECTIONS).collect()}
    want = {(i, s): plain_block(t or "", headings.aliases(s)) for i, t in enumerate(texts) for s in SECTIONS}
    assert got == {k: b for k, b in want.items() if b is not None} and len(got) > 6


def test_samples_of_the_first_heading_only(spark):
    got = headings.section_samples(frame(spark, [CORPUS]), SECTIONS).orderBy("item_ord").collect()
    assert [(r.section, r.title, r.score, r.reason) for r in got] == [("教务通知", "甲", 100, "要紧"), ("教务通知", "乙", 70, "备注")]


def test_digest_of_lines_raw_text_or_nothing(spark):
    long = "# 图书馆\n重要性评分 " + "字" * 5000
    got = {r.section: r.examples for r in headings.sample_digest(frame(spark, [CORPUS, long]), SECTIONS).collect()}
    assert got["教务通知"] == f"{rules.EXAMPLES_HEAD}\n- 甲 => 100/100；要紧\n- 乙 => 70/100；备注"
    assert got["图书馆信息"] == "一行\n\n两行 重要性评分 的写法\n### 下一级\n还在里面" and set(got) == {"教务通知", "图书馆信息"}
    assert len(headings.sample_digest(frame(spark, [long]), SECTIONS).first().examples) == rules.EXAMPLE_SECTION_CHARS


def test_blocks_need_no_shuffle(spark):
    assert "Exchange" not in headings.section_blocks(frame(spark, [CORPUS]), SECTIONS)._jdf.queryExecution().executedPlan().toString()
