"""The operators with Arrow functions, against plain Python on small tables."""

import base64
import gzip
import hashlib
import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from bulletin.llm import html_density, language_id, near_dedup, repeats, warc
from bulletin.llm.common import fresh_path
from bulletin.llm.shingling import shingle_bags

# Repeats --------------------------------------------------------------------------------


def brute_repeats(rows, length):
    big = 2**63 - 1
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        for s in range(len(b) - length + 1):
            k = b[s : s + length]
            first[k] = min(first.get(k, big), big if i is None else i)
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = [False] * len(b)
        for s in range(len(b) - length + 1):
            if first[b[s : s + length]] < (big if i is None else i):
                gone[s : s + length] = [True] * length
        spans, p = [], 0
        while p < len(b):
            if gone[p]:
                e = p
                while e < len(b) and gone[e]:
                    e += 1
                spans.append((p, e))
                p = e
            else:
                p += 1
        out.append((i, len(b), tuple(spans), bytes(x for x, g in zip(b, gone, strict=True) if not g)))
    return sorted(out, key=repr)


def repeat_rows(seed, n=60):
    r = random.Random(seed)
    words = ["th", "er", "on", "an", "é", "in", "re ", "ed ", ". ", "\n"]
    text = lambda k: "".join(r.choice(words) for _ in range(k))
    pool = [text(40) for _ in range(6)]
    rows = []
    for i in range(n):
        t = "".join(r.choice([text(r.randrange(30)), r.choice(pool), r.choice(pool)[: r.randrange(90)]]) for _ in range(r.randrange(6)))
        rows.append((i, t))
    rows += [(i + n, t[: r.randrange(len(t) + 1)] + text(3) + t[r.randrange(len(t) + 1) :]) for i, (_, t) in enumerate(rows[:20])]
    rows += [(None, rows[3][1]), (None, None), (7, rows[8][1]), (7, rows[8][1]), (500, "ab" * 200), (501, "ab" * 60), (400, "a" * 300)]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize(("seed", "part_docs", "owner_bytes", "chunk", "crowd"), [(1, 4096, 1 << 20, 1 << 20, 16), (2, 4, 500, 300, 16), (3, 8, 2000, 150, 0), (4, 2, 700, 64, 1)])
def test_repeats_against_all_strings(spark, monkeypatch, seed, part_docs, owner_bytes, chunk, crowd):
    rows = repeat_rows(seed)
    # Workers fork from a server that imported nothing, so limits are tested on the part itself as well.
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = repeats.remove_repeats(docs, part_docs=part_docs, owner_bytes=owner_bytes).collect()
    got = sorted(((r.doc_id, r.n_bytes, tuple((s.start, s.end) for s in r.spans), bytes(r.kept)) for r in found), key=repr)
    assert got == brute_repeats(rows, 50)
    monkeypatch.setattr(repeats, "CHUNK", chunk)
    monkeypatch.setattr(repeats, "CROWD", crowd)
    assert in_process(rows, 50, part_docs, 3) == brute_repeats(rows, 50)


def in_process(rows, length, part_docs, owners):
    """The three passes without Spark, at limits that real sizes would not reach."""
    import pyarrow as pa

    parts = {k: rows[at : at + part_docs] for k, at in enumerate(range(0, len(rows), part_docs))}
    texts = {
        k: pa.table({"part": pa.array([k] * len(v)), "doc_id": pa.array([i for i, _ in v], pa.int64()), "text": pa.array([t or "" for _, t in v])})
        for k, v in parts.items()
    }

    def owned(tables, step):
        whole = pa.concat_tables(tables)
        out = []
        for o in set(whole.column("owner").to_pylist()):
            out.append(repeats.answer(step)(whole.filter(pa.compute.equal(whole.column("owner"), o))))
        return pa.concat_tables(out or [repeats.table([], repeats.ANSWERS)])

    mine = lambda t, k: t.filter(pa.compute.equal(t.column("part"), k))
    one = owned([repeats._first_pass(length, owners)(t) for t in texts.values()], 1)
    two = owned([repeats._second_pass(length, owners)(t, mine(one, k)) for k, t in texts.items()], 2)
    both = pa.concat_tables([one, two])
    rows = []
    for k, t in texts.items():
        for r in repeats._last_pass(length, owners)(t, mine(both, k)).to_pylist():
            rows.append((r["doc_id"], r["n_bytes"], tuple((s["start"], s["end"]) for s in r["spans"]), r["kept"]))
    return sorted(rows, key=repr)


def test_repeats_of_nothing(spark):
    assert repeats.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


# WARC -----------------------------------------------------------------------------------

PAGES = [
    (1, "http://a/1", "<p>one</p>"), (2, "http://a/2\r\nX: y", "<p>one</p>"), (3, None, None), (4, "http://a/4", ""), (5, "http://é/", "<p>é</p>" * 300),
    (None, "http://n", "<p>one</p>"), (9, "http://a/9", "lone"), (-3, "http://m", "lone2"), (6, "u", "twin"), (6, "u", "twin"), (8, "u", "WARC/1.1\r\n\r\n" * 20),
]


def test_warc_round_trip(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    archive = warc.write_warc(pages, shard_bytes=400, roll_bytes=300)
    rows = warc.read_warc(spark, archive).collect()
    assert Counter(r.page_id for r in rows) == Counter(p for p, _, _ in PAGES)
    groups = defaultdict(list)
    for p, _, h in PAGES:
        groups[(h or "").encode()].append(p)
    by_digest = {base64.b32encode(hashlib.sha1(h).digest()).decode(): (h, ids) for h, ids in groups.items()}
    for r in rows:
        payload, ids = by_digest[r.payload_digest]
        top = max((i for i in ids if i is not None), default=None)
        assert r.payload_bytes == len(payload)
        if r.page_id != top:
            assert (r.record_type, r.refers_to) == ("revisit", top)
    kinds = Counter((r.payload_digest, r.record_type) for r in rows)
    assert all(kinds[d, "response"] == 1 and kinds[d, "revisit"] == len(ids) - 1 for d, (_, ids) in by_digest.items())
    assert len({r.warc_file for r in rows}) > 2
    again = warc.write_warc(pages.repartition(3), shard_bytes=400, roll_bytes=300)
    manifest = lambda a: sorted(map(tuple, a.files(spark).collect()))
    assert manifest(archive) == manifest(again)


def test_warc_shards_are_even_and_each_a_task_of_its_own(spark):
    pages = spark.createDataFrame([(i, None, "x" * 100) for i in range(64)] + [(100, None, "y" * 50_000)], "page_id long, url string, html string")
    archive = warc.write_warc(pages, shard_bytes=400, roll_bytes=1 << 30)
    assert [r.records for r in archive.files(spark).orderBy("shard").collect()] == [4] * 16 + [1]
    assert len(spark.read.parquet(archive.manifest).inputFiles()) == 17
    (long,) = [r for r in warc.read_warc(spark, archive).collect() if r.page_id == 100]
    assert long.payload_bytes == 50_000 and long.record_type == "response"


def test_warc_without_revisits_and_empty(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    rows = warc.read_warc(spark, warc.write_warc(pages, min_bytes=11)).collect()
    assert all(r.record_type == "response" for r in rows if r.payload_bytes < 11)
    empty = warc.write_warc(pages.limit(0))
    assert warc.read_warc(spark, empty).count() == 0


def test_warc_reader_refuses_altered_records(spark):
    record = warc.render(1, "u", b"payload", 0, False, None, "2026-01-01T00:00:00Z")
    (headers, block), = warc.records(__import__("io").BytesIO(gzip.decompress(warc.member(record))))
    assert warc.parse(headers, block, "f")[:5] == (1, "u", 7, base64.b32encode(hashlib.sha1(b"payload").digest()).decode(), "response")
    with pytest.raises(ValueError, match="block digest"):
        warc.parse(headers, block[:-1] + b"X", "f")


# Pages ----------------------------------------------------------------------------------

STORY = "".join(f"<p>Sentence number {i} of a long story, with words enough to count.</p>" for i in range(8))


@pytest.mark.parametrize(
    ("html", "want"),
    [
        (None, ""),
        ("", ""),
        ("plain words", "plain words"),
        ("<html><head><title>T</title></head><body><nav><a href=/>Home</a></nav><article><h1>A &amp; B</h1><p>One\n two<br>three<p>Four &eacute;</article><footer>f</footer></body>", "A & B\n\nOne two three\n\nFour é"),
        ("<body><article><header><h1>Title</h1></header><p>Text <b>bold</b>ly.</p><div class='comments'><p>Nice!</p></div><aside>x</aside></article>", "Title\n\nText boldly."),
        ("<div id=sidebar>links</div><main><ul><li>a<li>b</ul><script>var x='</p>';</script><form>f<input></form></main>", "a\n\nb"),
        ("<article><p>1 < 2 <3 & <unknown>x</unknown></p><!-- no --><p hidden>h</p></article", "1 < 2 <3 & x"),
        ("<article><table><tr><td>a</td><td>b</td></tr><tr><td>c</table><div class='cookie-notice'>ok?</div></article>", "a b\n\nc"),
        ("<article><p class='lead adventure'>kept</p><p title=\"a>b\">too</p></article>", "kept\n\ntoo"),
    ],
)
def test_main_text(html, want):
    assert html_density.main_text(html) == want


def test_density_finds_the_story_without_marks():
    links = "".join(f"<li><a href=/{i}>link {i}</a></li>" for i in range(30))
    page = f"<html><body><div><ul>{links}</ul></div><div><h2>Head of the story</h2><div>{STORY}</div></div><div><a href=/>more</a> <a href=/>next</a></div></body></html>"
    text = html_density.main_text(page)
    assert text.split("\n\n")[-8:] == [f"Sentence number {i} of a long story, with words enough to count." for i in range(8)]
    assert "link 3" not in text and "next" not in text


@pytest.mark.parametrize(
    "wrapper",
    ['<div class="content no-sidebar">', '<div id="page" class="has-banner">', '<div class="layout with-nav">', '<section class="alert-news">', '<div class="related"><article>'],
)
def test_a_marked_wrapper_does_not_cut_the_story(wrapper):
    story = "The council met on Monday and agreed on the new plan for the harbour. " * 5
    html = f'<body><div class="menu">Menu <a href="/">home</a></div>{wrapper}<p>{story}</p><div class="share">Share this</div></body>'
    assert html_density.main_text(html) == story.strip()


LINE = "The council met on Monday and agreed on the new plan for the harbour. "


@pytest.mark.parametrize(
    ("html", "want"),
    [
        # Longer comments beside a story without a mark, and all in a wrapper that the comments give their name.
        (f'<body><div><p>{LINE * 3}</p></div><div id="comments"><p>{"I do not agree at all. " * 40}</p></div></body>', [LINE * 3]),
        (f'<body><article><p>{LINE * 3}</p><div id="comments"><article><p>{"So say I. " * 60}</p></article></div></article></body>', [LINE * 3]),
        (f'<body><div class="cookie-consent"><p>{"We value your choice. " * 40}</p></div><div><p>{LINE * 3}</p></div></body>', [LINE * 3]),
        (f'<body><div class="ad-box">{"Buy two, pay one. " * 40}</div><div><p>{LINE * 3}</p></div></body>', [LINE * 3]),
        (f"<body><article><p>{LINE * 3}</p></article><article><p>{LINE * 5}</p></article></body>", [LINE * 3, LINE * 5]),
        (f'<body><div class="promo-page"><p>{LINE * 3}</p></div><div><p>{LINE * 5}</p></div></body>', [LINE * 3, LINE * 5]),
        # Teasers in an <article> of their own do not save the part around them, but the only article does.
        (f'<body><article><p>{LINE * 3}</p></article><div class="related"><article><p>{LINE * 9}</p></article></div></body>', [LINE * 3]),
        (f'<body><div class="widget"><article><p>{LINE * 3}</p></article></div><div class="social">{LINE * 2}</div></body>', [LINE * 3]),
        # Of a page of marked parts alone, the longest that is not foreign.
        (f'<body><div class="overlay"><p>{LINE * 2}</p><div class="ads">{LINE * 9}</div></div><div class="menu">Menu</div></body>', [LINE * 2]),
        (f'<body><div class="comment-page"><p>{LINE * 2}</p></div></body>', [LINE * 2]),
        ('<body><main><p>Short.</p></main><div class="sidebar"><p>' + LINE * 9 + "</p></div></body>", ["Short."]),
    ],
)
def test_what_is_left_decides_on_marks(html, want):
    assert html_density.main_text(html).split("\n\n") == [w.strip() for w in want]


def plain_densities(html):
    """Density and sum of each element by name, over a tree of nested lists built by the library parser."""
    import math
    from html.parser import HTMLParser

    class Tree(HTMLParser):
        def __init__(self):
            super().__init__()
            self.root = self.at = {"tag": "#page", "kids": [], "up": None}

        def handle_starttag(self, tag, attrs):
            node = {"tag": tag, "kids": [], "up": self.at}
            self.at["kids"].append(node)
            self.at = node

        def handle_endtag(self, tag):
            self.at = self.at["up"]

        def handle_data(self, data):
            self.at["kids"].append(data)

    tree = Tree()
    tree.feed(html)

    def measure(node, linked=False):
        linked = linked or node["tag"] == "a"
        c = t = lc = lt = 0
        for kid in node["kids"]:
            if isinstance(kid, str):
                size = len("".join(kid.split()))
                c, lc = c + size, lc + size * linked
            else:
                kc, kt, klc, klt = measure(kid, linked)
                c, t, lc, lt = c + kc, t + kt + 1, lc + klc, lt + klt + (kid["tag"] == "a")
        node["sizes"] = c, t, lc, lt
        return node["sizes"]

    measure(tree.root)
    body = tree.root["kids"][0]
    whole, _, links, _ = body["sizes"]

    def density(node):
        c, t, lc, lt = node["sizes"]
        if not c:
            return 0.0
        t, n, lc1, lt1 = max(t, 1), max(c - lc, 1), max(lc, 1), max(lt, 1)
        if c * t <= lc1 * lt1:
            return 0.0
        return c / t * math.log((c / lc1) * (t / lt1), math.log(c / n * lc1 + links / whole * c + math.e))

    out = {}

    def walk(node):
        kids = [k for k in node["kids"] if not isinstance(k, str)]
        out[node["tag"]] = density(node), sum(map(density, kids)) if kids else density(node)
        for k in kids:
            walk(k)

    walk(body)
    return out


def test_densities_against_a_plain_tree():
    html = f"<body><x1><x2><a>link one</a><x3>{LINE}</x3></x2><x4>{LINE * 4}<x5>more of it</x5></x4></x1><x6><x7><a>{LINE}</a></x7>x</x6></body>".replace("<a>", "<a>")
    page = html_density.Page(html)
    dense, sums = page.densities()
    want = plain_densities(html)
    got = {t: (dense[i], sums[i]) for i, t in enumerate(page.tags) if t in want}
    assert got.keys() == want.keys()
    assert all(got[t] == pytest.approx(want[t]) for t in want)
    best = max(want, key=lambda t: want[t][1])
    assert page.tags[max(range(len(sums)), key=sums.__getitem__)] == best


@pytest.mark.parametrize("size", [10, 70_000])
def test_long_attribute_values_stay_in_their_tag(size):
    value = "{\"a\": \"</div><p>x > y\"}" + "z" * size
    story = "The council met on Monday and agreed on the new plan for the harbour. " * 5
    html = f"<body><div><div data-state='{value}'><p>{story}</p></div><p>{story}</p></div></body>"
    assert html_density.main_text(html) == "\n\n".join([story.strip()] * 2)
    assert html_density.main_text(f'<p class="open>{story}</p>') == story.strip()


def test_extract_rows(spark):
    pages = spark.createDataFrame([(1, "u", "<article>é</article>", "old"), (1, "u", None, None)], "page_id long, url string, html string, text string")
    rows = html_density.extract(pages).select("page_id", "text", "n_chars").collect()
    assert [tuple(r) for r in rows] == [(1, "é", 1), (1, "", 0)]
    assert html_density.main_text("<div>" * 20_000 + "deep" + '<a href="' * 2_000).startswith("deep")


# Near-duplicates ------------------------------------------------------------------------


def bag(text, size=5):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").split()
    return Counter(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))) if words else Counter()


def jaccard(a, b):
    both = sum((a & b).values())
    return both / (sum(a.values()) + sum(b.values()) - both) if both else 0.0


def near_rows():
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randrange(2, 6)))
    rows, n = [], 0
    for _ in range(12):
        base = [word() for _ in range(r.randrange(8, 200))]
        for _ in range(r.randrange(1, 14)):
            copy = list(base)
            for _ in range(r.randrange(0, 1 + len(base) // 25)):
                copy[r.randrange(len(copy))] = word()
            rows.append((n, " ".join(copy)))
            n += 1
    rows += [(n, "one two"), (n + 1, "ONE  two"), (n + 2, ""), (n + 3, None), (n + 4, " "), (n + 5, "w " * 60), (n + 6, "w " * 66), (n + 7, "w " * 300), (None, rows[0][1]), (3, rows[3][1]), (3, rows[3][1])]
    r.shuffle(rows)
    return rows


def test_near_duplicate_classes_against_all_pairs(spark):
    rows = near_rows()
    bags = [bag(t) for _, t in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if rows[i][1] == rows[j][1] or not (rows[i][1] or rows[j][1]) or jaccard(bags[i], bags[j]) >= 0.8:
                up[find(i)] = find(j)
    classes = defaultdict(list)
    for i in range(len(rows)):
        classes[find(i)].append(rows[i][0])
    want = Counter((min((x for x in ids if x is not None), default=None), len(ids)) for ids in classes.values() for _ in ids)
    found = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    got = found.collect()
    assert Counter((r.class_id, r.class_size) for r in got) == want
    assert sum(r.keep for r in got) == len(classes) and all(r.doc_id == r.class_id for r in got if r.keep)
    left = near_dedup.drop_near_duplicates(spark.createDataFrame([(*x, 1) for x in rows], "doc_id long, text string, tid int"))
    assert left.columns == ["doc_id", "text", "tid"] and left.count() == len(classes)


def test_links_inside_a_template_family_just_under_the_threshold(spark):
    r = random.Random(11)
    word = lambda: "".join(r.choice("abcdefghijklmnop") for _ in range(6))
    template, texts = [word() for _ in range(260)], []
    for _ in range(150):
        own = [word() for _ in range(36)]
        texts += [" ".join(template + own), " ".join(template + own[:8] + [word() for _ in range(24)] + own[32:])]
    bags = [bag(t) for t in texts]
    assert all(jaccard(bags[2 * i], bags[2 * i + 1]) >= 0.8 for i in range(150))
    assert all(0.74 < jaccard(bags[i], bags[j]) < 0.8 for i in range(300) for j in range(i) if i // 2 != j // 2)
    got = near_dedup.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r.doc_id: (r.class_id, r.class_size) for r in got} == {i: (i - i % 2, 2) for i in range(300)}


def test_later_rounds_of_near_duplicates_join_only_their_own_links(spark, monkeypatch):
    runs, components = [], near_dedup.components
    monkeypatch.setattr(near_dedup, "components", lambda links: runs.append(links.count()) or components(links))
    docs = spark.createDataFrame(near_rows(), "doc_id long, text string")
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    left = near_dedup.drop_near_duplicates(docs)
    # The driver keeps the plan and metrics of every query that is run: 54 when each round joined all links anew.
    assert store.executionsCount() - before - len(runs) <= 40
    assert runs[0] > 20 and all(0 < n < runs[0] / 2 for n in runs[1:])
    assert left.count() == near_dedup.near_duplicates(docs).filter("keep").count()


@pytest.mark.parametrize("find", [near_dedup.drop_near_duplicates, near_dedup.near_duplicates])
def test_near_duplicates_label_every_text_once_whatever_the_rounds(spark, monkeypatch, find):
    sizes, settle, runs, components = Counter(), near_dedup.settle, [], near_dedup.components

    def settled(df, name):
        out = settle(df, name)
        sizes[name] += out.count()
        return out

    monkeypatch.setattr(near_dedup, "settle", settled)
    monkeypatch.setattr(near_dedup, "components", lambda links: runs.append(links) or components(links))
    r = random.Random(11)
    words = lambda n: [str(r.random()) for _ in range(n)]
    template, texts = words(260), [" ".join(words(9)) for _ in range(2000)]
    for _ in range(40):
        own = words(36)
        texts += [" ".join(template + own), " ".join(template + own[:8] + words(24) + own[32:])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    find(docs).write.format("noop").mode("overwrite").save()
    made = 0
    for i in range(before, store.executionsCount()):
        x = store.executionsList().apply(i).executionId()
        values, nodes = store.executionMetrics(x), store.planGraph(x).allNodes()
        for node in map(nodes.apply, range(nodes.size())):
            found = [m for m in map(node.metrics().apply, range(node.metrics().size())) if m.name() == "number of output rows"]
            if "LeftOuter" in node.desc() and node.name().endswith("Join"):
                made += sum(int(values.apply(m.accumulatorId()).replace(",", "")) for m in found if values.contains(m.accumulatorId()))
    assert len(runs) > 1, "no later round found a link"
    # All texts once, their bucket rows once, open rows once a round, and the few texts that share a bucket.
    assert sizes["near-texts"] < made <= sizes["near-texts"] + sizes["near-members"] + sizes["near-open"] + (1 + len(runs)) * sizes["near-fetched"]


def test_bag_signatures_estimate_weighted_jaccard():
    import pyarrow as pa

    a = " ".join(f"x{i}" for i in range(200)) + " y" * 40
    b = " ".join(f"x{i}" for i in range(40, 220)) + " y" * 70
    lo, hi, owner, value, times = next(shingle_bags(pa.array([a, b, None]), 1))
    signature = near_dedup.bag_signatures(owner, value, times, 3, 4096)
    assert not np.isfinite(signature[2]).any()
    want = jaccard(bag(a, 1), bag(b, 1))
    assert (signature[0] == signature[1]).mean() == pytest.approx(want, abs=0.04)


def test_near_duplicates_of_nothing(spark):
    assert near_dedup.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


# Languages ------------------------------------------------------------------------------


def language_rows():
    r = random.Random(3)
    parts = {"en": ["the", "th", "ing", "and", "er"], "fr": ["eau", "le", "qu", "oi", "é"], "de": ["sch", "ung", "ß", "ein", "au"]}
    rows = []
    for i in range(360):
        lang = list(parts)[i % 3]
        rows.append((i, " ".join("".join(r.choice(parts[lang]) for _ in range(r.randrange(1, 5))) for _ in range(r.randrange(3, 80))), lang))
    return rows


def test_languages_on_held_out_rows(spark):
    rows = language_rows()
    docs = spark.createDataFrame([*rows, (900, None, "en"), (901, "12 %%", "fr"), (902, "", None), (None, "the thing", "en")], "doc_id long, text string, lang string")
    model = language_id.train(docs.filter(~language_id.held_out()))
    assert model.langs == ["de", "en", "fr"]
    found = {r.doc_id: r for r in language_id.identify(docs.withColumn("held_out", language_id.held_out()), model).collect()}
    import zlib

    assert all(found[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, _, _ in rows)
    held = [(found[i].lang_pred, lang) for i, _, lang in rows if found[i].held_out]
    assert len(held) > 50 and sum(a == b for a, b in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in found.values())
    assert [found[i].lang_pred for i in (900, 901, 902)] == ["und"] * 3 and found[902].rejected
    assert not any(found[i].rejected for i, _, _ in rows)
    noise = spark.createDataFrame([(1, " ".join("".join(random.Random(i).choices("qxzjkvw", k=6)) for i in range(60)))], "doc_id long, text string")
    assert language_id.identify(noise, model).head().rejected


def test_language_grams_do_not_cross_texts():
    keys, counts = language_id.gram_keys(["Ab, c", None, "!!", "d\0e"])
    spell = lambda k: "".join(chr((int(k) >> s) & 0xFFFF) for s in (48, 32, 16, 0))
    assert counts.tolist() == [4, 0, 0, 3]
    assert [spell(k) for k in keys[:4]] == ["\0\0\0a", "\0\0ab", "\0ab ", "ab c"]
    assert [spell(k) for k in keys[-3:]] == ["\0\0\0d", "\0\0d ", "\0d e"]


def dictionary_model(texts):
    """Probability of a character after up to three others, by plain dictionaries over one language's texts."""

    def squeezed(t):
        return re.sub(r"[^\W\d_]+|.", lambda m: m[0] if m[0].isalpha() else " ", t.lower(), flags=re.S)

    def grams(t):
        t = "\0\0\0" + re.sub(" +", " ", squeezed(t)).lstrip(" ")
        return [t[i - 3 : i + 1] for i in range(3, len(t))]

    counts = {4: Counter(g for t in texts for g in grams(t))}
    for k in (3, 2, 1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    floor = 1 / (len(counts[1]) + 1)

    def probability(gram):
        p = floor
        for k in (1, 2, 3, 4):
            g = gram[4 - k :]
            same = {x: n for x, n in counts[k].items() if x[:-1] == g[:-1]}
            total = sum(same.values())
            if total:
                p = max(counts[k][g] - 0.75, 0) / total + 0.75 * len(same) / total * p
        return p

    return grams, probability


@pytest.mark.parametrize("part_grams", [1_000_000, 40])
def test_languages_against_dictionaries(spark, part_grams):
    rows = [(i, t[:120], lang) for i, t, lang in language_rows()[:24]] + [(90, "zulu words", "zu"), (91, "", "en"), (92, "Twice twice", "en"), (92, "Twice twice", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.train(docs, part_grams=part_grams)
    assert model.langs == ["de", "en", "fr", "zu"] and (model.parts > 5) == (part_grams == 40)
    plain = {lang: dictionary_model([t for _, t, x in rows if x == lang]) for lang in model.langs}
    asked = [*(t for _, t, _ in rows[:3]), "eau, qui!  sch", "zulu", "ŧŋ unknown", "x"]
    found = {r.doc_id: r for r in language_id.identify(spark.createDataFrame(list(enumerate(asked)), "doc_id long, text string"), model).collect()}
    for i, t in enumerate(asked):
        entropy = {lang: -np.mean([np.log(probability(g)) for g in grams(t)]) for lang, (grams, probability) in plain.items()}
        assert found[i].lang_pred == min(entropy, key=lambda x: (entropy[x], x))
        assert found[i].cross_entropy == pytest.approx(min(entropy.values()), rel=1e-4)


@pytest.mark.parametrize("part_grams", [1_000_000, 15])
def test_the_rejection_is_calibrated_on_every_document(spark, part_grams):
    r = random.Random(11)
    texts = [" ".join("".join(r.choices("abc", [5, 2, 1], k=r.randrange(1, 4))) for _ in range(r.randrange(1, 30))) for _ in range(900)]
    docs = spark.createDataFrame([*((i, t, "xx") for i, t in enumerate(texts)), (900, "some other words", "yy")], "doc_id long, text string, lang string")
    model = language_id.train(docs, part_grams=part_grams)
    assert (model.parts > 4) == (part_grams == 15)
    grams, probability = dictionary_model(texts)
    known = {g: -np.log(probability(g)) for t in texts for g in grams(t)}
    said = np.array([known[g] for t in texts for g in grams(t)])
    share = {c: n / len(said) for c, n in Counter(g[-1] for t in texts for g in grams(t)).items()}
    space = share[" "]

    def after(x, c):
        return share[c] if x != " " else 0 if c == " " else share[c] / (1 - space)

    loose = total = 0.0
    for g in itertools.product("abc ", repeat=4):
        p = space / (1 + space) if g[0] == " " else share[g[0]] / (1 - space) / (1 + space)
        for x, c in zip(g, g[1:]):
            p *= after(x, c)
        total += p
        loose -= p * np.log(probability("".join(g))) if p else 0
    assert total == pytest.approx(1)
    assert model.usual[0].tolist() == pytest.approx([(said.mean() + loose) / 2, said.var()], rel=1e-6)


def test_a_small_language_among_many_grams_stays_learned(spark):
    r = random.Random(8)
    rows = [(i, "".join(chr(0x4E00 + r.randrange(3000)) for _ in range(3000)), "zh") for i in range(40)]
    rows += [(100 + i, "talofa lava fale aiga " * 3, "sm") for i in range(10)]
    model = language_id.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), part_grams=20_000)
    assert model.langs == ["sm", "zh"] and model.parts > 4
    asked = spark.createDataFrame([(1, "talofa aiga", 5), (2, rows[0][1][:50], 6)], "doc_id long, text string, score int")
    found = language_id.identify(asked, model)
    assert found.columns.count("score") == 1
    assert {r.doc_id: r.lang_pred for r in found.collect()} == {1: "sm", 2: "zh"}


def test_no_training_rows(spark):
    docs = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    assert language_id.identify(docs, language_id.train(docs)).head().lang_pred == "und"
    assert fresh_path(spark, "x") != fresh_path(spark, "x")
