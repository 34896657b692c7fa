"""Main text of web pages by consensus host paths.

Pass 1 scores the containers of each page: a block of text gives its length outside links to the container it lies in, half of it
to the next one out, and so on; the best container, or the article or main element around it, is the page's own choice. Its path
of tags and classes, digits generalised to #, is the page's vote. The votes of a host are counted in Spark. Pass 2 reads each page
again and extracts its host's winning path: of all paths with votes, the one with the most that the page has some text at. All
votes of a host count, however many paths have some: in pass 1 each page also tells digests of its paths with text, and each
distinct set of these is joined with the votes; ties go to the smaller digest. A page that has no path with votes falls back on its
own choice, so that no page is lost.

In the chosen container, menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader comments are left
out, known by tag, role, class or id; hidden elements too. A class or id is one of these if all its words are: `cookie-notice` and
`site-nav` are, `notice-board` and `long-form` aren't. Whether a piece of text is left out is told where it stands, so an element in a line takes
only its own text with it. A form that holds the article or main element stays. Reader comments are also known by their form: two or more
boxes of one class side by side, outside an article element, each with an author or a date, below text that is longer than such a box. Character references are
decoded, white space inside a block becomes one space, blocks are joined in page order by a line break. Nothing else is dropped,
whatever its length.

Elements are numbers with a parent, paths are numbers with a parent and a step, so a page takes time and memory in proportion to
its length, however deep or broken it is.

Edge cases: a null html is empty and gives an empty text, a page without any container gives all its text but the parts left out. A null url is a host of its
own. Unclosed elements end with their parents; an end tag without a start is ignored. Repeated rows vote each. Other columns stay
unread and may have any names.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from hashlib import md5
from html import unescape

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexatlas.llm.common import columns, name, own, ready_python, staged, table
from lexatlas.llm.uneven import HOT_ROWS, hot_keys, join_dealt

TOKEN = re.compile(
    r"""<!--(?P<comment>.*?)(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</(?P<end>[a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)|<(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?>[^>"']+|"[^"]*"|'[^']*')*+|[^>]*)(?:>|\Z)""",
    re.S,
)
ATTR = re.compile(r"""(class|id|role|hidden|aria-hidden|style|itemprop)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?(?=[\s/"']|\Z)""", re.I)

#: Elements by role in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template iframe textarea title select option head".split())
FOREIGN = frozenset("svg math".split())
TEXTLESS = frozenset("script style textarea title".split())
BLOCK = frozenset("address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
CONTAINER = frozenset("article body center div main section table tbody td".split())
LEFT_OUT = frozenset("nav footer aside form menu dialog".split())
NEVER_OUT = frozenset("html body main article".split())
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "thead": ("tr", "td", "th"), "tbody": ("thead", "tr", "td", "th"), "tfoot": ("tbody", "tr", "td", "th")}
STOPS = frozenset("ul ol dl table td th div article section body html nav aside header footer main form".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
#: Words of what is left out; in a class or id they may stand beside each other and beside PLACES.
PARTS = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs sidebar footer masthead topbar toolbar banner cookie cookies consent gdpr notice notices alert alerts disclaimer ad ads adbox adslot adsbygoogle"
    " advert adverts advertisement advertisements advertising sponsor sponsored promo promos promotion newsletter subscribe signup login paywall popup modal overlay share sharing social related recommended"
    " recommendations widget widgets pagination pager comment comments commentlist disqus respond replies form forms search skip".split()
)
#: Words that only say where or what kind of box it is.
PLACES = frozenset(
    "area article articles bar block bottom box button buttons by center container content entry global group header holder icon icons inner item items left link links list main middle outer page pages panel post posts"
    " primary reader readers right row secondary section side site slot sticky stories story top unit user wrap wrapper".split()
)
#: Words of a class that says who wrote a box, or when.
MARKERS = frozenset("author user username avatar commenter date datetime timestamp posted published ago".split())
#: Parts in which the votes of a host are looked up.
SALTS = 16
HEADER_PLACES = frozenset("site page main global top".split())
#: What an end or a start of another element may close, or what stops the search for it.
MARKED = STOPS | frozenset("p li dt dd tr thead tbody tfoot".split())


@lru_cache(1 << 16)
def names_part(token: str) -> bool:
    """Whether a class or id says that an element is none of the article."""
    words = [w.lower() for w in re.findall(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[^\W\d_]+", token)]
    return any(w in PARTS for w in words) and all(w in PARTS or w in PLACES for w in words)


@lru_cache(1 << 16)
def names_header(token: str) -> bool:
    words = [w for w in re.split(r"[-_]", token.lower()) if w]
    return words[-1:] == ["header"] and all(w in HEADER_PLACES for w in words[:-1])


@lru_cache(1 << 16)
def names_marker(token: str) -> bool:
    return any(w in MARKERS for w in re.findall(r"[a-z]+", token.lower()))


def digest(parent: bytes, step: str) -> bytes:
    """The digest of a path: of its parent's digest and its last step."""
    return md5(parent + step.encode("utf-8", "surrogatepass"), usedforsecurity=False).digest()


class Page:
    """A page's elements in order, and its blocks of text: (element, text, length outside links, left out)."""

    def __init__(self, html: str):
        self.tags: list[str] = []
        self.ups: list[int] = []
        self.ends: list[int] = []
        self.main: list[bool] = []
        self.inside: list[int] = []  # the nearest container, the element itself included
        self.path: list[int] = []  # the number of an element's path
        self.steps: list[tuple[int, str]] = []  # a path's parent and last step
        self.digests: list[bytes] = []
        self.blocks: list[tuple[int, str, int, bool]] = []
        self.marks: list[int] = []  # elements outside articles that tell an author or a date
        self.plain: list[bool] = []  # whether an element is outside articles
        self._numbers: dict[tuple[int, str], int] = {}
        self._read(html)

    @staticmethod
    def _attrs(raw: str) -> dict[str, str]:
        return {m[1].lower(): unescape((m[2] or "").strip("\"'")) for m in ATTR.finditer(raw)} if raw and not raw.isspace() else {}

    def _number(self, parent: int, step: str) -> int:
        k = self._numbers.get((parent, step))
        if k is None:
            k = self._numbers[parent, step] = len(self.steps)
            self.steps.append((parent, step))
            self.digests.append(digest(self.digests[parent] if parent >= 0 else b"", step))
        return k

    def _read(self, html: str) -> None:
        stack: list[int] = []
        marks: list[int] = []  # places in the stack of elements that may close or stop others
        open_tags: Counter[str] = Counter()
        foreign = 0
        around: list[int] = []  # elements that are left out around each block
        out: list[int] = []
        gone: list[bool] = []
        parts: list[tuple[str, bool, tuple[bool, int]]] = []  # text, whether in a link, whether left out and by which form if by a form only
        at, n = 0, len(html)
        kept_forms: set[int] = set()
        endless: set[str] = set()  # raw elements that nothing ends any more

        def add(text: str) -> None:
            parts.append((text, open_tags["a"] > 0, (bool(out), out[0] if len(out) == 1 and self.tags[out[0]] == "form" else -1)))

        def flush() -> None:
            kinds: dict[tuple[bool, int], list[tuple[str, bool]]] = {}
            for t, linked, kind in parts:
                kinds.setdefault(kind, []).append((t, linked))
            for kind, here in kinds.items():
                text = " ".join("".join(t for t, _ in here).split())
                if text:
                    self.blocks.append((stack[-1] if stack else -1, text, sum(len(t) for t, linked in here if not linked), kind[0]))
                    around.append(kind[1])
            parts.clear()

        def pop() -> None:
            nonlocal foreign
            k = stack.pop()
            self.ends[k] = len(self.tags)
            tag = self.tags[k]
            open_tags[tag] -= 1
            foreign -= tag in FOREIGN
            if gone[k]:
                out.pop()
            if marks and marks[-1] == len(stack):
                marks.pop()

        for m in iter(lambda: TOKEN.search(html, at), None):
            if m.start() > at:
                add(unescape(html[at : m.start()]))
            at = max(m.end(), m.start() + 1)
            if end := m["end"]:
                end = end.lower()
                if end in BLOCK:
                    flush()
                if end == "br":
                    continue
                if open_tags[end] > 0:
                    while self.tags[stack[-1]] != end:
                        pop()
                    pop()
            elif tag := m["tag"]:
                tag = tag.lower()
                if tag in RAW and tag != "head":
                    shut = None
                    if not m["attrs"].endswith("/") and tag not in endless:
                        shut = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(html, at)
                        if not shut:
                            endless.add(tag)
                    if shut:
                        at = shut.end()
                    elif tag in TEXTLESS:
                        at = n
                    continue
                if tag in BLOCK:
                    flush()
                    while True:
                        # the innermost element that this one closes, if no other one stops the search
                        shut_at, more = -1, False
                        for place in reversed(marks):
                            name = self.tags[stack[place]]
                            if name in CLOSES.get(tag, ()) or name == "p" and tag != "br":
                                shut_at, more = place, tag in CLOSES and name != tag
                                break
                            if name in STOPS and not (tag in CLOSES and name in ("td", "th")):
                                break
                        if shut_at < 0:
                            break
                        while len(stack) > shut_at:
                            pop()
                        if not more:
                            break
                if tag in VOID or m["attrs"].endswith("/") and (tag in FOREIGN or foreign):
                    continue
                a = self._attrs(m["attrs"])
                names = a.get("class", "").split()
                me, up = len(self.tags), stack[-1] if stack else -1
                self.tags.append(tag)
                self.ups.append(up)
                self.path.append(self._number(self.path[up] if up >= 0 else -1, tag + "".join(sorted({"." + re.sub(r"\d+", "#", c.lower()) for c in names}))))
                self.ends.append(-1)
                main = tag in ("article", "main") or a.get("role", "").lower() == "main" or "articlebody" in a.get("itemprop", "").lower()
                self.main.append(main)
                self.inside.append(me if tag in CONTAINER or main else self.inside[up] if up >= 0 else -1)
                known = [*names, *([a["id"]] if a.get("id") else [])]
                bad = tag in LEFT_OUT or "hidden" in a or a.get("aria-hidden", "").lower() == "true" or "display:none" in a.get("style", "").replace(" ", "").lower() or a.get("role", "").lower() in ROLES or any(map(names_part, known))
                bad = bad or (tag == "header" or any(map(names_header, known))) and not open_tags["article"]
                if tag in NEVER_OUT and not any(re.match(r"(?i)comment", c) for c in known):
                    bad = False
                if main and not bad and len(out) == 1 and self.tags[out[0]] == "form":
                    kept_forms.add(out[0])
                self.plain.append(not open_tags["article"] and not main)
                if self.plain[-1] and (tag == "time" or any(map(names_marker, known))):
                    self.marks.append(me)
                gone.append(bad)
                if bad:
                    out.append(me)
                open_tags[tag] += 1
                foreign += tag in FOREIGN
                if tag in MARKED:
                    marks.append(len(stack))
                stack.append(me)
        if at < n:
            add(unescape(html[at:]))
        flush()
        while stack:
            pop()
        if kept_forms:
            self.blocks = [(k, t, p, left_out and by not in kept_forms) for (k, t, p, left_out), by in zip(self.blocks, around, strict=True)]
        if self.marks:
            self._leave_comments()

    def _above(self, elements) -> set[int]:
        """These elements and all around them."""
        seen: set[int] = set()
        for k in elements:
            while k >= 0 and k not in seen:
                seen.add(k)
                k = self.ups[k]
        return seen

    def _leave_comments(self) -> None:
        """Leave out boxes of one class side by side that all have text and an author or a date, below longer text."""
        marked, full = self._above(self.marks), self._above(k for k, _, plain, left_out in self.blocks if plain and not left_out)
        alike: dict[tuple[int, int], list[int]] = {}
        for k in sorted(marked & full):
            if self.plain[k] and (self.tags[k] == "li" or "." in self.steps[self.path[k]][1]) and self.tags[k] != "body":
                alike.setdefault((self.ups[k], self.path[k]), []).append(k)
        groups = {key: boxes for key, boxes in alike.items() if len(boxes) > 1}
        if not groups:
            return
        known = Counter((self.ups[k], self.path[k]) for k in full)
        # blocks come as their elements end; in the order of elements those of one element are a range
        place = sorted(range(len(self.blocks)), key=lambda j: self.blocks[j][0])
        order, before = [self.blocks[j][0] for j in place], [0]
        for j in place:
            before.append(before[-1] + (0 if self.blocks[j][3] else self.blocks[j][2]))

        def length(k: int) -> int:
            return before[bisect_left(order, self.ends[k])] - before[bisect_left(order, k)]

        gone: list[tuple[int, int]] = []
        for (up, path), boxes in sorted(groups.items(), key=lambda g: g[1][0]):
            if known[up, path] != len(boxes) or gone and boxes[0] < gone[-1][1]:
                continue
            size = sum(map(length, boxes)) / len(boxes)
            above = before[bisect_left(order, boxes[0])]
            if above <= size:
                continue
            inside = above - before[bisect_left(order, up)] if up >= 0 else above
            gone += [(up, self.ends[up])] if up >= 0 and inside <= size and above - inside > size and self.plain[up] and self.tags[up] not in ("body", "html", "main") else [(k, self.ends[k]) for k in boxes]
        begins = [a for a, _ in gone]

        def within(k: int) -> bool:
            at = bisect_right(begins, k) - 1
            return at >= 0 and k < gone[at][1]

        self.blocks = [(k, t, p, left_out or within(k)) for k, t, p, left_out in self.blocks]

    def path_text(self, k: int) -> str:
        """The path of an element, for reading."""
        steps, at = [], self.path[k]
        while at >= 0:
            at, step = self.steps[at]
            steps.append(step)
        return ">".join(reversed(steps))

    def own_choice(self) -> int:
        """The best container, or -1."""
        score: dict[int, float] = {}
        for k, _, plain, left_out in self.blocks:
            share, k = float(plain), self.inside[k] if k >= 0 else -1
            while k >= 0 and not left_out and share >= 1:
                score[k] = score.get(k, 0.0) + share
                share /= 2
                k = self.inside[self.ups[k]] if self.ups[k] >= 0 else -1
        if not score:
            return -1
        best = max(score, key=lambda k: (score[k], -k))
        k = self.ups[best]
        while k >= 0:
            if self.main[k] and not (self.main[best] and self.tags[best] == "article"):
                best = k
            k = self.ups[k]
        return best

    def text(self, roots: list[int] | None) -> str:
        """The text inside these elements, none of which holds another, in page order; with None, all of it."""
        if roots is None:
            return "\n".join(t for _, t, _, left_out in self.blocks if not left_out)

        def within(k: int) -> bool:
            place = bisect_right(roots, k) - 1
            return place >= 0 and k < self.ends[roots[place]]

        return "\n".join(t for k, t, _, left_out in self.blocks if not left_out and within(k))

    def with_text(self) -> set[bytes]:
        """Digests of the paths whose elements have text that isn't left out."""
        seen: set[int] = set()
        for k, _, _, left_out in self.blocks:
            while k >= 0 and not left_out and k not in seen:
                seen.add(k)
                k = self.ups[k]
        return {self.digests[self.path[k]] for k in seen}

    def roots(self, path: bytes) -> list[int]:
        """The outermost elements whose path has that digest."""
        number = next((p for p, d in enumerate(self.digests) if d == path), -1)
        out: list[int] = []
        for k, p in enumerate(self.path):
            if p == number and not (out and k < self.ends[out[-1]]):
                out.append(k)
        return out


def vote(html: str | None) -> tuple[bytes | None, list[bytes], bytes]:
    """A page's vote, the digests of all its paths with text in order, and the digest of all these."""
    page = Page(html or "")
    best = page.own_choice()
    have = sorted(page.with_text())
    return page.digests[page.path[best]] if best >= 0 else None, have, md5(b"".join(have), usedforsecurity=False).digest()


def extract(html: str | None, path: bytes | None) -> tuple[str, str | None]:
    """The main text and the path it was found at. path: the digest of the winning path, or null."""
    page = Page(html or "")
    if path is not None and (roots := page.roots(bytes(path))) and (text := page.text(roots)):
        return text, page.path_text(roots[0])
    best = page.own_choice()
    return (page.text([best]), page.path_text(best)) if best >= 0 else (page.text(None), None)


def host(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def page_key(html: Column) -> Column:
    return F.sha2(F.coalesce(html.cast("string"), F.lit("")).cast("binary"), 256)


def page_votes(pages: DataFrame, *, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: host, page (its key), vote, have, kind (see vote)."""
    ready_python(pages.sparkSession)

    @F.pandas_udf("vote binary, have array<binary>, kind binary")
    def voted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame([vote(h) for h in b], columns=["vote", "have", "kind"])

    html = F.col(name(html_col))
    seen = pages.select(host(F.col(name(url_col))).alias("host"), page_key(html).alias("page"), voted(html.cast("string")).alias("v"))
    return staged(seen.select("host", "page", "v.*"), "page-votes")


def page_paths(seen: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """host, page, path: for each distinct page (by its key) of a host the path, by its digest, that has the most votes of those it has
    text at. seen: the pages' votes."""
    votes = seen.where("vote is not null").groupBy("host", "vote").agg(F.count(F.lit(1)).alias("votes"))
    # pages of a template have the same paths: each set of paths is looked up once. A path that many sets of a host share is dealt by salts.
    kinds = seen.groupBy("host", "kind").agg(F.first("have").alias("have")).select("host", "kind", F.pmod(F.xxhash64("kind"), F.lit(SALTS)).alias("salt"), F.explode("have").alias("vote"))
    votes = votes.select("host", "vote", "votes", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt"))
    best = kinds.join(votes, ["host", "vote", "salt"]).groupBy("host", "kind").agg(F.min(F.struct((-F.col("votes")).alias("k"), "vote")).alias("best"))
    best = best.select(F.col("host").alias("h"), F.col("kind").alias("k"), F.col("best.vote").alias("path"))
    # a template that a large part of all pages has meets its path in several tasks
    pages = seen.select("host", "page", "kind").distinct()
    return join_dealt(pages, best, {"host": "h", "kind": "k"}, hot_keys(seen, ["host", "kind"], hot_rows), by=["page"]).select("host", "page", "path")


def main_texts(pages: DataFrame, *, url_col: str = "url", html_col: str = "html", hot_rows: int = HOT_ROWS) -> DataFrame:
    """pages with `main` (which replaces a column of that name): struct(text, path)."""
    x, kept = own(pages), [c for c in pages.columns if c.lower() != "main"]
    seen = page_votes(pages, url_col=url_col, html_col=html_col)
    won = staged(page_paths(seen, hot_rows), "page-paths")
    won = won.select(F.col("host").alias(f"{x}won_host"), F.col("page").alias(f"{x}won_page"), F.col("path").alias(f"{x}path"))

    @F.pandas_udf("text string, path string")
    def extracted(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for html, paths in batches:
            yield pd.DataFrame([extract(h, p) for h, p in zip(html, paths, strict=True)], columns=["text", "path"])

    d = pages.withColumns({f"{x}host": host(F.col(name(url_col))), f"{x}page": page_key(F.col(name(html_col)))})
    d = join_dealt(d, won, {f"{x}host": f"{x}won_host", f"{x}page": f"{x}won_page"}, hot_keys(seen, ["host", "page"], hot_rows), "left")
    d = d.withColumn(f"{x}main", extracted(F.col(name(html_col)).cast("string"), F.col(f"{x}path")))
    return d.select(*columns(kept), F.col(f"{x}main").alias("main"))


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = main_texts(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", F.col("main.text").alias("text"), F.char_length("main.text").cast("long").alias("n_chars"), F.col("main.path").alias("path"))
