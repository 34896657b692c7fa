import re
import time
from html import unescape

import pytest

from lexatlas.llm import htmltext as ht
from lexatlas.llm.queries import queries


def test_whole_table(spark, sf_dir):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    got = queries()["op6_html_text"](spark, sf_dir).collect()
    assert len(got) == len(pages)
    for r in got:
        html = pages[r["page_id"]]["html"]
        inner = html[html.index("<article>") + 9 : html.index("</article>")]
        blocks = (" ".join(unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"<br>|</?p>|</?h1>", inner))
        assert r["text"] == "\n".join(b for b in blocks if b) and r["n_chars"] == len(r["text"]) and r["url"] == pages[r["page_id"]]["url"]


def own(html):
    return ht.extract(html, None)[0]


def test_what_is_left_out():
    page = """<html><head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1></header><div class="cookie-notice">We use</div>
    <div id=nav><ul><li><a href=x>Home</a><li>B</ul></div><div class="content post-12"><h1>T &amp; U</h1><p>One <b>two</b>
    three<p>four &lt;x&gt; &#233;<div class=ad>buy</div><ul><li>i1<li>i2</ul><table><tr><td>c1<td>c2<tr><td>c3</table><form>x<input></form>
    <aside>s</aside><script>var a="<p>no</p>";</script><!-- <p>c</p> --><p hidden>h</p><p style="display: none">d</p></div>
    <div class="comments"><p>A very long reader comment, much longer than all of the article together, so that it would win by length alone.</p></div><footer>f</footer></body></html>"""
    assert own(page) == "T & U\nOne two three\nfour <x> é\ni1\ni2\nc1\nc2\nc3"


def test_odd_pages():
    assert own(None) == own("") == own("<html><body></body></html>") == ""
    assert own("<p>bare text") == "bare text" and own("only text") == "only text"
    assert own("<div><p>a<br>b</p></div>") == "a\nb"
    assert own("<article><p><b>x<p>y</article>z") == "x\ny"
    assert own("<body></i></div><p>a</p></p>b</body>") == "a\nb"
    assert own("<body><p>a<script>never closed <p>b") == "a"
    assert own('<body><p title="a>b">c</p>') == "c"
    long = "<body>" + "<p>w w</p>" * 20_000
    assert own(long).count("\n") == 19_999
    assert own("<div>" * 3000 + "deep" + "</div>" * 3000) == "deep"
    assert own("<" * 5000 + "a='" * 2000) is not None


def test_host_vote_decides(spark):
    """A page whose own best container is a long list of links' neighbour follows its host."""
    usual = "<body><div class='story v{0}'><h1>t{0}</h1><p>body {0}</p></div><div class='extra'>x</div></body>"
    odd = "<body><div class='story v9'><h1>t</h1><p>short</p></div><div class='extra'><p>" + "long text " * 50 + "</p></div></body>"
    rows = [(i, f"http://h.example/{i}", usual.format(i)) for i in range(5)] + [(9, "https://H.example:8080/9", odd), (10, "http://other.example/", odd), (11, None, usual.format(1)), (12, "http://h.example/n", None)]
    df = spark.createDataFrame(rows, "page_id int, url string, html string").withColumnRenamed("page_id", "main")
    got = ht.main_texts(df.withColumnRenamed("main", "k"))
    texts = {r["k"]: r["main"]["text"] for r in got.collect()}
    assert texts[0] == "t0\nbody 0" and texts[9] == "t\nshort" and texts[10].startswith("long text") and texts[11] == "t1\nbody 1" and texts[12] == ""
    assert ht.main_texts(df.where("false")).count() == 0
    clash = ht.main_texts(df)  # a column named like the output is replaced
    assert sorted(clash.columns) == ["html", "main", "url"] and clash.count() == len(rows)


def test_votes_of_every_template_count(spark):
    """A host with more templates than any rank: a page of the least voted one follows its template, not its own best container."""
    usual = "<body><div class='story{0}'><h1>t</h1><p>body of {0}</p></div><div class='extra'>x</div></body>"
    odd = "<body><div class='storyzz'><h1>t</h1><p>short</p></div><div class='extra'><p>" + "long text " * 50 + "</p></div></body>"
    names = [a + b for a in "abcdefg" for b in "abcdefgh"]
    pages = [usual.format(n) for n in names for _ in range(3)] + [usual.format("zz")] * 2 + [odd]
    for url in ("http://h.example/", None):
        rows = spark.createDataFrame([(i, url, h) for i, h in enumerate(pages)], "i int, url string, html string")
        got = {r["i"]: r["main"]["text"] for r in ht.main_texts(rows).collect()}
        assert len(got) == len(pages) and got[len(pages) - 1] == "t\nshort" and got[0] == "t\nbody of aa"


def test_formulas_and_fallbacks_stay():
    assert own("<p>Let <math><mi>x</mi></math> be") == "Let x be"
    assert own("<p>a <video src=v><source src=w>no video</video> <object data=o>no object</object> <canvas>c</canvas> <audio>d</audio> z") == "a no video no object c d z"
    assert own("<div><svg><style>p{}</style><path d='M0'/><g/><text>label</text></svg><p>b</p></div>") == "label\nb"
    assert len(ht.Page("<svg>" + "<path/>" * 3000 + "</svg>").steps) == 1
    assert own("<article><p>a <noscript>b</noscript> <button>c</button> d") == "a b c d"


def test_words_inside_a_class_hide_no_text():
    for c in ("long-form", "share-price", "form-text", "search-results", "login-help", "notice-board", "social-policy", "modal-verbs", "comment-on-law", "commentary", "has-sidebar", "adventure", "loading", "navy"):
        assert own(f"<article><p>a</p><div class='{c}'>b</div><section id={c}><p>c</p></section></article>") == "a\nb\nc", c
    for c in ("ad", "ad-slot-3", "cookie-notice", "cookieBanner", "site-nav", "related-posts", "comment-list", "reader_comments", "newsletter-signup", "SIDEBAR", "share-buttons", "post-footer"):
        assert own(f"<article><p>a</p><div class='{c}'>b</div></article>") == "a", c
    assert own("<form><div><article><p>a</p></article></div><p>b</p></form>") == "a" and own("<body><p>a</p><form><p>b</p></form>") == "a"


def test_broken_pages_take_little():
    import resource
    import time

    began, before = time.monotonic(), resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    for html in ("<b>" * 200_000 + "x", "<b>" * 50_000 + "<p>x" * 50_000, "<div>" * 100_000 + "x", "<li>" * 100_000, "</i>" * 200_000, "<table><tr><td>" * 30_000 + "y", "<div class=a><p>x</p></div>" * 40_000, "<p><b>" * 60_000, "<svg><path/>" * 60_000):
        text, _ = ht.extract(html, None)
        assert ht.vote(html)[1] is not None and text is not None
        assert ht.extract(html, (ht.Page(html).digests or [b""])[-1])[0] is not None
    assert time.monotonic() - began < 120 and resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 400_000


def site(rng, host):
    """Well-formed pages of one host without article elements: two templates, and pages on which an extra box is longest."""
    out = []
    templates = [f"<div class='wrap'><div class='t{host}x{k} body-copy'>{{0}}</div><div class='extra{k}'>{{1}}</div></div>" for k in range(2)]
    for k in range(rng.randint(3, 12)):
        words = lambda n: " ".join(rng.choice(["lorem", "ipsum", "dolor", "sit"]) for _ in range(n))
        story, extra = "".join(f"<p>{words(rng.randint(1, 12))}</p>" for _ in range(rng.randint(1, 3))), f"<p>{words(rng.choice([1, 1, 60]))}</p>"
        out.append((f"http://h{host}.example/{k}", "<html><body>" + rng.choice(templates).format(story, extra) + "</body></html>"))
    return out


def brute_texts(rows):
    """The method by a tree of the standard library, page after page."""
    import xml.etree.ElementTree as ET
    from collections import Counter, defaultdict

    parsed, votes = [], defaultdict(Counter)
    for url, html in rows:
        root, paths, up = ET.fromstring(html), {}, {}

        def walk(e, parent, at, paths=paths, up=up):
            step = e.tag + "".join(sorted("." + re.sub(r"\d+", "#", c) for c in (e.get("class") or "").split()))
            paths[e], up[e] = ht.digest(at, step), parent
            for c in e:
                walk(c, e, paths[e])

        walk(root, None, b"")
        score: Counter = Counter()
        for p in root.iter("p"):
            share, e = float(len(p.text)), p
            while e is not None and share >= 1:
                if e.tag in ("body", "div"):
                    score[e] += share
                    share /= 2
                e = up[e]
        order = {e: k for k, e in enumerate(root.iter())}
        best = max(score, key=lambda e: (score[e], -order[e]))
        host = url.split("/")[2]
        votes[host][paths[best]] += 1
        parsed.append((host, root, paths))
    texts = []
    for host, root, paths in parsed:
        win = min((p for p in set(paths.values()) if votes[host][p]), key=lambda p: (-votes[host][p], p))
        texts.append("\n".join(p.text for e in root.iter() if paths[e] == win for p in e.iter("p")))
    return texts


def test_votes_equal_brute_force(spark):
    import random

    rng = random.Random(8)
    rows = [r for h in range(25) for r in site(rng, h)]
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)] * 2, "i int, url string, html string")
    got = {r["i"]: r["main"]["text"] for r in ht.main_texts(df).collect()}
    want = brute_texts(rows)
    assert [got[k] for k in range(len(rows))] == want
    assert sum(ht.extract(h, None)[0] != w for (_, h), w in zip(rows, want, strict=True)) > 10  # the vote decides for these


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ('<p>Good.</p>Loose good words <span class="share"><div>share me</div></span><p>end</p>', "Good.\nLoose good words\nend"),
        ('<p>kept words <span class="share">x</p>', "kept words"),
        ('<p>words before <a class="share">Share<br></a></p>', "words before"),
        ('<p>Before <ins class="adsbygoogle">BUY NOW</ins> after</p>', "Before after"),
        ('<p>Before <span class="ad">BUY NOW</span>after</p>', "Before after"),
        ("<p>Before <b hidden>BUY</b> after</p>", "Before after"),
        ('<form><span class="ad">no</span><article><p>a <i class="share">no</i>b</p></article></form>', "a b"),
    ],
)
def test_left_out_in_a_line(html, text):
    assert ht.extract(html, None)[0] == text


def test_comments_by_their_form():
    story = "<div class='story-body'><p>" + "The story goes on. " * 10 + "</p><p>And ends here.</p></div>"
    box = "<div class='msg'><span class='user-name'>Ann</span><p>" + "I think so too. " * 9 + "</p></div>"
    text = ("The story goes on. " * 10).strip() + "\nAnd ends here."
    assert ht.extract(f"<body>{story}<div class='comment-thread'><h3>8 replies</h3>{box * 8}</div></body>", None)[0] == text
    assert ht.extract(f"<body><div id=wrap>{story}{box * 8}</div></body>", None)[0] == text
    # nothing longer above: a list of posts, an article's own parts
    assert ht.extract(f"<body><div class='list'>{box * 4}</div></body>", None)[0].count("I think") == 36
    assert ht.extract(f"<body><article>{story}{box * 3}</article></body>", None)[0].count("I think") == 27
    # boxes that have no author or date
    plain = box.replace("user-name", "lead")
    assert ht.extract(f"<body><div id=wrap>{story}{plain * 8}</div></body>", None)[0].count("I think") == 72


@pytest.mark.parametrize("piece", ["<option>a", "<iframe>a", "<template>x", "<select>b", "aa <span class=ad>b</span>", "<p>aa <span class=ad>b</span>", "<div class='x'><time>a</time>b"])
def test_time_in_proportion(piece):
    def seconds(n):
        began = time.process_time()
        ht.extract(piece * n, None)
        return time.process_time() - began

    seconds(1000)
    assert seconds(80_000) < 12 * seconds(20_000) + 0.5  # four times, with room
