"""Rule sets as plain data.

Fixed values: the word lists, patterns, limits and labels below are part of the
digest's definition and must stay as they are for results to agree.
"""

from __future__ import annotations

UNFILED_SECTION = "未分类"
PLACEHOLDER_TITLE = "占位卡片"
REPORT_SECTION = "物理系学术报告"
LIBRARY_SECTION = "图书馆信息"
OTHER_SECTION = "其他公众号信息"

# --- dates -----------------------------------------------------------------
DEADLINE_WORDS = [
    "截止", "截止时间", "截止日期", "报名截止", "申请截止",
    "提交截止", "截至", "报名时间", "申请时间", "deadline", "due",
]
PUBLISH_WORDS = ["发布时间", "发布日期", "发布"]
EVENT_WORDS = [
    "活动时间", "报告时间", "讲座时间", "举办时间", "开始时间",
    "比赛时间", "培训时间", "日程", "宣讲会",
]
EVENT_LABELS = ["报告时间", "时间", "活动时间"]
ISSUE_DAYS = 7
EVENT_GRACE_HOURS = 12
CONTEXT_CHARS = 180

# --- keep / drop -----------------------------------------------------------
FORCE_YES_WORDS = ["开题", "注册", "学籍", "培养", "课程", "选课", "退课", "奖学金", "物理", "讲座", "SRT"]
FORCE_NO_WORDS = ["公示", "招聘", "教师", "研究生", "博士生"]
TITLE_BLACKLIST = ["学生社区中心信息周报", "学生区室外大型活动信息"]
OPENING_LABEL = "开馆通知"
TEACHING_WORDS = [
    "教务", "课程", "选课", "退课", "考试", "学籍", "培养", "本科生", "研究生", "成绩", "补退", "重修", "SRT",
]

REPORT_WORDS = ["学术报告", "学术讲座", "报告", "讲座", "colloquium", "seminar"]
REPORT_WORDS_DEFAULT = ["学术报告", "学术讲座", "报告", "讲座", "seminar", "colloquium", "lecture"]
REPORT_PLACES = ["W101", "W105", "理科楼", "物理楼"]
REPORT_EXCLUDE_WORDS = [
    "学位授权点建设报告", "招聘信息", "导师及研究方向", "本科生工作组",
    "研究生工作组", "新闻动态", "公告",
]
NON_REPORT_PAGE_WORDS = ["学位授权点建设", "研究生工作组"]

# --- base score: (points, pattern), each counted once ----------------------
BASE_SCORE = 35
SCORE_RULES = [
    (45, "选课|退课|排课|调课|调休|考试|成绩|培养方案|学籍|毕业|课程"),
    (35, "物理系学术报告|学术报告|seminar|colloquium|讲座"),
    (30, "SRT|星火|学推|挑战杯|暑校|科研训练|奖学金|奖助|保研"),
    (22, "宿舍|熄灯|交通|通行|校庆安排|校园网|志愿工时|第二成绩单|献血"),
    (12, "AI|人工智能|量子|能源|交叉"),
    (10, "报名|申请|截止|决赛|展示|公示|结果|答辩|观摩"),
    (-55, "研究生|博士生|博士后|教师|教职工|辅导员|管理人员|教学建设|课程建设"),
    (-35, "文化素质教育讲座|生态文明十五讲|新人文讲座|王国维学术讲座|学术之道|世界文学|礼仪|思政|宣传片|口号"),
    (-20, "社团骨干|内部培训|工作总结|口号发布|组织生活"),
    (-18, "儿童剧|影像展|音乐会|演讲大赛|文化节|工作坊|嘉年华|揭幕活动|升国旗仪式"),
]
BASE_SCORE_REASON = "fallback_keyword_score"

# --- guardrails ------------------------------------------------------------
HEAD_CHARS = 600  # the rules below that look at the head of an item read this much of its body
CULTURE = "文化素质教育讲座|生态文明十五讲|新人文讲座|王国维学术讲座|学术之道|世界文学"
ACTIVITY = "英语风采演讲|英语竞赛|演讲大赛|辩论赛|礼仪课堂|工作坊|嘉年华|文创|游园|诗乐会|音乐会|文化节"
PUBLICITY = "口号|揭幕|亮点预告|抢先看|开幕式|倒计时|预热"
SHOWCASE = "风采展|优秀个人|人物专访|人物故事|成长故事|校友故事"
NON_UNDERGRAD = "研究生|博士生|博士后|教师|教职工|课程建设|学位授权点建设"
UNDERGRAD = "本科生|本科|全体学生|广大师生"
REPORT_TITLE = "物理系学术报告|学术报告|colloquium|seminar"
TRAINING = "暑期学校|暑校|SRT|星火|学推|挑战杯|科研训练|保研"
TRAINING_STAGE = "报名|申请|截止|公示|结果|决赛|获奖|答辩|观摩"
LIFE = "宿舍|熄灯|交通|通行|第二成绩单|志愿工时|献血"
LIB_SERVICE = "开馆|闭馆|考试周|阅览室|座位|预约|借还|数据库访问|校外访问|资源访问|服务调整|系统维护"
LIB_WEAK = "知识产权|专利|金融|经济|WRDS|Capital IQ|医药|许可|商业|会计"
LIB_TOOL = "EndNote|NoteExpress|投稿指南|学术规范|知网AI|数据库课堂"
LIB_WRITING = "LaTeX|Word|论文写作"
EXPIRED_CAP_DEFAULT = 12
REASON_CHARS = 180

# --- sections --------------------------------------------------------------
REQUIRED_SECTIONS = [
    "教务通知", "家园网信息", "图书馆信息", "学生会信息", "青年科协信息",
    "学生社团信息", "物理系学术报告", "学生公益信息",
]
STAGE_SECTIONS = [("crawl_info", "教务通知"), ("crawl_myhome", "家园网信息")]
FALLBACK_SECTIONS = [
    "教务通知", "图书馆信息", "学生会信息", "青年科协信息", "学生社团信息",
    "家园网信息", "新清华学堂", "物理系学术报告", "学生公益信息", "其他公众号信息",
]
ACCOUNT_SECTIONS = ["学生会信息", "青年科协信息", "学生社团信息", "学生公益信息", "其他公众号信息"]
UNION_WORDS = ["学生会"]
SCIENCE_ACCOUNTS = ["青年科创", "青年科协"]
SCIENCE_WORDS = ["科协", "科创", "青科", "创新", "创业"]
WELFARE_WORDS = ["公益", "志愿", "志愿者", "支教", "捐赠", "义卖", "献血", "助残", "环保", "募捐", "慈善"]
CLUB_WORDS = ["社团", "协会", "俱乐部", "招新", "百团", "工作坊", "学生组织", "兴趣小组"]

SECTION_LEADS = {
    "教务通知": "这周教务安排里有几条和课程节奏直接相关，大家记得看截止时间。",
    "学生会信息": "学生会这边和同学权益、校园活动相关的消息放在这里。",
    "青年科协信息": "科创和青年组织相关的动态，适合关注项目、讲座和实践机会的同学。",
    "学生社团信息": "社团活动和招新消息集中在这一栏，方便大家按兴趣挑着看。",
    "学生社区": "生活面的更新也整理在这里，适合课间快速扫一眼。",
    "图书馆信息": "图书馆这边的活动和资源通知也很值得留意。",
    "新清华学堂": "如果你想给一周安排一点文艺调剂，这一栏可以看看。",
    "物理系学术报告": "天气渐暖，楼里的讲座也慢慢热闹起来了。",
    "学生公益信息": "和志愿服务、公益活动有关的消息整理在这里。",
    "其他公众号信息": "下面这几条来自其他重点公众号，和校园动态联系更紧一些。",
}
EMPTY_LEAD = "本周暂无相关信息，大家先安心上课。"
GENERIC_LEAD = "下面来看看本周值得关注的内容。"

CARD_LEADS = {
    "教务通知": "这周和课程、选课、学业节奏直接相关的更新，先看这里。",
    "家园网信息": "生活层面的提醒和安排放在这一栏，方便课间快速扫一眼。",
    "图书馆信息": "图书馆的新讲座、资源和训练营，适合顺手加入本周计划。",
    "新清华学堂": "这一周值得出门听一场、看一场的内容，集中放在这里。",
    "物理系学术报告": "楼里的报告会是这一期的重头戏，尽量把关键信息和气质都保留下来。",
    "学生会信息": "和校园活动、同学权益更贴近的消息，统一收在这一栏。",
    "青年科协信息": "如果你关心科创、沙龙和项目机会，这一栏通常最有料。",
    "学生社团信息": "社团活动和招新动向，适合按兴趣挑着看。",
    "学生公益信息": "和志愿服务、公益行动相关的消息，整理在这里。",
    "其他公众号信息": "其他重点公众号里的校园动态，也顺手汇总在这里。",
}
CARD_LEAD_GENERIC = "把这部分内容整理成更接近人工编辑版公众号的阅读卡片。"

# --- limits ----------------------------------------------------------------
SECTION_LIMIT = 4
ACCOUNT_LIMIT = 5
SUMMARY_UNITS = 70
ITEM_UNITS = 250
MIN_BODY_UNITS = 80
BODY_RESERVE = 20
FEED_SUMMARY_CHARS = 100
SNIPPET_CHARS = 3000
EXAMPLE_CHARS = 3200
EXAMPLE_SECTION_CHARS = 3000
#: Other names of a section in a preference corpus.
SECTION_ALIASES = {LIBRARY_SECTION: ["图书馆"]}
RANKING_BODY_CHARS = 900
MODEL_REASON_CHARS = 120
REPORT_SUMMARY_CHARS = 1800

# --- labels and markers ----------------------------------------------------
SCORE_LABEL = "重要性评分"
BASIS_LABEL = "排序依据"
HUMAN_SCORE_LABEL = "物理系本科生偏好评分"
SUMMARY_LABEL = "要点透视"
EXAMPLES_HEAD = "当前版块人工评分样例："
PLACEHOLDER_BODY = "等待下次抓取结果。"
#: Characters of an error that a record keeps.
ERROR_CHARS = 500
ERROR_BODY = "本次抓取未成功。"
RANKED_EMPTY_BODY = "本版块 raw 模式未抓取到一周内发布的条目。"
ACCOUNT_EMPTY_BODY = "本期没有符合条件的最新公众号信息。"

REPORT_END_MARKERS = ["\n## ", "## ", "\n上一篇", "\n下一篇", "\n关闭窗口", "\n分享到", "\n版权所有", "\n地址："]
SPEAKER_LABELS = ["报 告 人", "报告人"]
TIME_LABELS = ["报告时间", "时间"]
PLACE_LABELS = ["报告地点", "地点"]
SUMMARY_START = "内容摘要|报告摘要|摘要|Abstract"
SUMMARY_STOP = "报告题目|报告人简介|报告人|报{ws}*告{ws}*人|报告时间|报告地点|上一篇|下一篇|上一条|下一条|关闭窗口|分享到|版权所有"

META_LABELS = [
    "日期", "时间", "地点", "票价", "发布日期", "报告时间", "报告地点",
    "报告人", "来源公众号", "作者", "链接", "摘要", "报告摘要",
]
TIME_LIKE_LABELS = [
    "日期", "时间", "发布日期", "报告时间", "截止时间", "截止日期", "活动时间", "演出时间", "开票时间",
]
HIGHLIGHT_LABELS = ["日期", "时间", "发布日期", "报告时间"]
HIGHLIGHT_PATTERNS = [
    r"20{d}{{2}}[年\-/.]{d}{{1,2}}[月\-/.]{d}{{1,2}}日?",
    r"{d}{{1,2}}月{d}{{1,2}}日(?:{ws}*[（(][^）)]*[）)])?(?:{ws}*(?:周|星期)[一二三四五六日天])?",
    r"(?:周|星期)[一二三四五六日天]",
    r"{d}{{1,2}}[:：]{d}{{2}}(?:{ws}*[-~至到]{ws}*{d}{{1,2}}[:：]{d}{{2}})?",
    r"(?:今天|明天|后天|今晚|今早|今晨|本周|本周内|下周|近期|即日起)",
    r"截止至?{ws}*{d}{{1,2}}月{d}{{1,2}}日",
]

# --- feeds and URLs --------------------------------------------------------
LIST_KEYS = ["list", "items", "records", "accounts", "articles", "article"]
FIELD_ALIASES = {
    "title": ["title", "name"],
    "url": ["url", "link", "content_url"],
    "digest": ["digest", "summary", "desc", "brief"],
    "cover": ["cover", "thumb_url", "image"],
    "time": ["create_time", "datetime", "timestamp", "publish_time", "update_time"],
    "mid": ["mid", "appmsgid"],
    "idx": ["idx", "itemidx"],
}
ACCOUNT_ID_KEYS = ["fakeid", "id", "biz", "__biz"]
HTML_KEYS = ["html", "content", "data", "result", "body", "text"]
TRACKING_KEYS = [
    "sn", "chksm", "scene", "srcid", "sharer_shareinfo", "sharer_shareinfo_first",
    "clicktime", "ascene", "from", "version", "pass_ticket",
]
ARTICLE_SITE = "https://mp.weixin.qq.com"
CONTAINER_CLASSES = ["v_news_content", "wp_articlecontent", "articlecontent"]
CONTAINER_ID = "vsb_content"

# --- text quality ----------------------------------------------------------
NOISE_WORDS = "Source:|Markdown:|Content:|Status:|Unknown"
QUALITY_WORDS = "报告|讲座|时间|地点|摘要|物理楼"
MOJIBAKE_RUN = r"[\x{c0}-\x{ff}]{2,}|锟|\x{fffd}"
AUDIT_PATTERNS = r"\?{3,}|[\x{c0}-\x{ff}]{4,}"
AUDIT_CHARS = 160
BLOCK_TAGS = [
    "p", "div", "section", "article", "li", "ul", "ol", "table", "tr", "td",
    "th", "h1", "h2", "h3", "h4", "h5", "h6", "br",
]

# field -> (max characters, max UTF-8 bytes)
FIELD_LIMITS = {"title": (32, 64), "author": (4, 12), "digest": (54, 120), "source_url": (1024, 0)}

# --- fixed patterns of stored pages ----------------------------------------
# Values that decide results; their order matters.
BLOCK_PATTERNS = [
    r"""(?i)<div[^>]+id=["']vsb_content["'][^>]*>([\s\S]*?)</div>""",
    r"""(?i)<div[^>]+class=["'][^"']*wp_articlecontent[^"']*["'][^>]*>([\s\S]*?)</div>""",
    r"""(?i)<div[^>]+class=["'][^"']*content[^"']*["'][^>]*>([\s\S]*?)</div>""",
    r"(?i)<article[^>]*>([\s\S]*?)</article>",
]
MAIN_BLOCK = r"""(?i)<main[^>]*class=["'][^"']*page[^"']*["'][^>]*>([\s\S]*?)</main>"""
FRAGMENT_CUTS = [
    r"(?i)<!DOCTYPE[^>]*>",
    r"(?i)</?(?:html|head|body|meta|title|link)[^>]*>",
    r"(?i)<script[^>]*>[\s\S]*?</script>",
    r"(?i)<style[^>]*>[\s\S]*?</style>",
    r"""{ws}(?i:loading=(?:'.*?'|".*?"))""",
]
PUBLISH_TIME_FIELD = (r'id="publish_time"[^>]*>([\s\S]*?)</', r'publish_time\s*=\s*"(.*?)"')
AUTHOR_FIELD = (r'id="js_author_name"[^>]*>([\s\S]*?)</', r'var\s+author\s*=\s*"(.*?)"')

# --- fixed text of the explanatory issue -----------------------------------
FALLBACK_PREFACE = (
    "本次运行已完成富文本导出流程，但公开网站抓取未取得可用内容。"
    "请检查网络连通性、校园站点可访问性或登录态后重试。\n\n"
    "抓取阶段记录：\n\n"
)
