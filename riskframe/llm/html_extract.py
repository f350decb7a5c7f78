"""Main text of web pages by consensus of their host.

1. Every page is read into blocks of text and the containers around them; menus,
   headers, footers, sidebars, notices, adverts, forms and comments are known by
   their tags and class words. A tag drops the part. A class word only casts doubt on
   a block-level part, as articles carry such words too (``post category-social``): it
   stays if it is an article by tag or class and holds ``ARTICLE_PART`` of the page's
   text outside links, or if it holds ``MAIN_PART`` of it and nothing else on the page
   is an article. Each remaining block gives its length, less three
   times that of its links, to its container, half of it to the next one out, and
   so on; the best container is the page's candidate.
2. A container's path is its chain of tags and class words with digits
   generalised (``body/div.post-#``). Spark counts the candidates' paths per host
   and ranks those that at least ``SHARE`` of the host's pages vote for.
3. Every page is read again: its text is taken from all containers on the
   highest-ranked winning path that the page has, else from its own candidate,
   else from all blocks outside the parts named above.

Blocks end at block-level tags; ``<br>`` is white space; character references are
decoded; white space runs become one space; blocks are joined by an empty line.
Cut-off pages are read as far as they go. Null and empty pages give an empty
text, a null or odd url has no host and so no consensus. Rows are kept as they
are, repeated ones too; other columns take no part. The winners are broadcast if
there are at most ``BROADCAST_ROWS`` of them, else joined on host and a salt, as
one host may own most pages.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.common import bounded_batches
from riskframe.session import written

SHARE, RANKS = 0.2, 5
ARTICLE_PART, MAIN_PART = 0.5, 0.8
BROADCAST_ROWS = 100_000
SALTS = 32

BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre "
    "section summary table tbody td tfoot th thead tr ul".split())
CONTAINER = frozenset("article blockquote body center dd div dl fieldset figure html li main ol section "
                      "table tbody td tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript iframe template svg math xmp noembed noframes".split())
#: Of these, not raw text: where the end tag is missing, the page goes on after the start tag.
MARKUP = frozenset(["svg", "math", "template"])
#: Tags whose content is never main text.
OUTSIDE = frozenset("nav aside footer form button select option datalist dialog menu head object audio "
                    "video canvas map label input fieldset".split())
#: Class and id words of such parts.
OUTSIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion nav navbar "
    "navigation menu menubar breadcrumb breadcrumbs footer sidebar aside cookie cookies consent gdpr notice notices "
    "notification alert banner popup modal overlay newsletter subscribe subscription signup login comment "
    "comments disqus replies respond share sharing social related recommended widget pagination pager toolbar "
    "masthead topbar skip search copyright".split())
#: The same, but only outside an article, which may have a header of its own.
OUTER_WORDS = frozenset(["header", "head", "top"])
ARTICLE_WORDS = frozenset(["article", "content", "entry", "post", "story"])
#: Signs of an article on a part that class words cast doubt on.
SIGNS = ARTICLE_WORDS | {"hentry", "main"}
GOOD_WORDS = frozenset("article content entry main post story text body".split())
#: An open tag of the key is closed by these start tags.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}}
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"},
         "th": {"tr", "table"}, "option": {"select"}}

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")
_LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_WORDS = re.compile(r"[a-z]+|\d+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


class Page:
    """Blocks ``(text, link characters, container)`` and containers ``(parent,
    path, tag, words)`` of one page; blocks of the parts named above are left out."""

    def __init__(self, source: str):
        self.blocks: list[tuple[str, int, int]] = []
        self.containers: list[tuple[int, str, str, frozenset]] = []
        self._text: list[str] = []
        self._links = 0
        #: parts in doubt (article by its signs?), and around each block the numbers of these
        self._doubts: list[bool] = []
        self._around: list[tuple[int, ...]] = []
        # open elements: tag, own container or that around it, outside?, in an article?, doubts around it
        self._stack: list[tuple[str, int, bool, bool, tuple[int, ...]]] = [("", -1, False, False, ())]
        self._anchors = 0
        self._read(source)
        self._flush()
        if self._doubts:
            self._settle()

    def _settle(self):
        """Leave out the blocks of parts whose doubts are right."""
        share = [0.0] * len(self._doubts)
        total, article = 0.0, False
        for (text, links, at), around in zip(self.blocks, self._around):
            gain = max(0.0, len(text) - 3.0 * links)
            total += gain
            for d in around:
                share[d] += gain
            while not around and not article and at >= 0:
                at, _, tag, words = self.containers[at]
                article = tag in ("article", "main") or bool(words & SIGNS)
        stays = [x > 0 and (x >= ARTICLE_PART * total if signed else not article and x >= MAIN_PART * total)
                 for x, signed in zip(share, self._doubts)]
        self.blocks = [b for b, around in zip(self.blocks, self._around) if all(stays[d] for d in around)]

    def _flush(self):
        if self._text:
            joined = " ".join("".join(self._text).split())
            if joined:
                self.blocks.append((joined, self._links, self._stack[-1][1]))
                self._around.append(self._stack[-1][4])
            self._text, self._links = [], 0

    def _add(self, raw: str):
        if raw and not self._stack[-1][2]:
            text = references.unescape(raw) if "&" in raw else raw
            self._text.append(text)
            if self._anchors:
                self._links += len(text.strip())

    def _read(self, s: str):
        at, n = 0, len(s)
        while at < n:
            lt = s.find("<", at)
            if lt < 0:
                self._add(s[at:])
                return
            if lt > at:
                self._add(s[at:lt])
            follow = s[lt + 1:lt + 2]
            if s.startswith("<!--", lt):
                end = s.find("-->", lt + 4)
                if end < 0:
                    return
                at = end + 3
            elif follow in ("!", "?"):
                end = s.find(">", lt)
                if end < 0:
                    return
                at = end + 1
            elif follow.isalpha() and follow.isascii() or follow == "/":
                m = _TAG.match(s, lt) or _LOOSE.match(s, lt)
                if m is None:
                    if follow == "/" and not s[lt + 2:lt + 3].isalpha():
                        end = s.find(">", lt)
                        at = n if end < 0 else end + 1
                        continue
                    return  # a tag that is cut off
                at = m.end()
                tag = m[2].lower()
                if m[1]:
                    self._end(tag)
                elif tag in RAW:
                    if not m[3].endswith("/"):
                        found = re.compile(f"</{re.escape(tag)}\\b[^>]*>", re.I).search(s, at)
                        if found is None and tag not in MARKUP:
                            return
                        at = found.end() if found else at
                else:
                    self._start(tag, m[3])
            else:
                self._add("<")
                at = lt + 1

    def _pop(self, depth: int):
        """Close the elements from this depth on."""
        for tag, *_ in self._stack[depth:]:
            if tag in BLOCK:
                self._flush()
            elif tag == "a":
                self._anchors -= 1
        del self._stack[depth:]

    def _find(self, tags: set[str], scope: set[str] = frozenset()) -> int:
        for i in range(len(self._stack) - 1, 0, -1):
            if self._stack[i][0] in tags:
                return i
            if self._stack[i][0] in scope:
                return 0
        return 0

    def _start(self, tag: str, rest: str):
        if tag in BLOCK:
            self._flush()
            depth = self._find({"p"}, CONTAINER)
            if depth:
                self._pop(depth)
        if tag in CLOSES:
            depth = self._find(CLOSES[tag], SCOPE[tag])
            if depth:
                self._pop(depth)
        if tag == "br":
            self._add(" ")
        if tag in VOID or (rest.endswith("/") and tag not in BLOCK):
            return
        _, container, outside, article, doubts = self._stack[-1]
        if tag == "a":
            self._anchors += 1
        elif tag in BLOCK or tag in OUTSIDE or tag == "span":
            given = {}
            for m in _ATTRIBUTE.finditer(rest):
                given.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
            names = f"{given.get('class', '')} {given.get('id', '')}"
            words = frozenset(_WORDS.findall(_CAMEL.sub(" ", names).lower()))
            if tag not in ("html", "body", "main"):
                doubtful = bool(words & OUTSIDE_WORDS) or not article and bool(words & OUTER_WORDS)
                outside = (outside or tag in OUTSIDE or "hidden" in given or doubtful and tag not in BLOCK
                           or given.get("role", "").lower() in ("navigation", "banner", "contentinfo", "search", "complementary", "dialog", "alert")
                           or not article and tag == "header")
                if doubtful and not outside:
                    doubts = (*doubts, len(self._doubts))
                    self._doubts.append(tag == "article" or bool(words & SIGNS))
            if tag in CONTAINER:
                step = ".".join([tag, *sorted({re.sub(r"\d+", "#", c.lower()) for c in given.get("class", "").split()})])
                above = f"{self.containers[container][1]}/" if container >= 0 else ""
                self.containers.append((container, above + step, tag, words))
                container = len(self.containers) - 1
                article = article or tag in ("article", "main") or bool(words & ARTICLE_WORDS)
        self._stack.append((tag, container, outside, article, doubts))

    def _end(self, tag: str):
        if tag == "br":
            self._add(" ")
            return
        if tag in BLOCK:
            self._flush()
        # an inline end tag does not reach over a block
        depth = self._find({tag}, frozenset() if tag in BLOCK or tag in OUTSIDE else BLOCK)
        if depth:
            self._pop(depth)

    def candidate(self) -> tuple[int, float]:
        """The best container (-1: none) and its score."""
        score = [0.0] * len(self.containers)
        for text, links, at in self.blocks:
            gain = len(text) - 3.0 * links
            while at >= 0 and abs(gain) >= 1:
                score[at] += gain
                gain /= 2
                at = self.containers[at][0]
        best, top = -1, 0.0
        for i, (_, _, tag, words) in enumerate(self.containers):
            s = score[i] * (1.5 if tag in ("article", "main") else 1.2 if words & GOOD_WORDS else 1.0)
            if s > top:
                best, top = i, s
        # the article around the best container, if there is one
        at = best
        while at >= 0:
            if self.containers[at][2] in ("article", "main"):
                return at, top
            at = self.containers[at][0]
        return best, top

    def text(self, paths: list[str]) -> str:
        chosen: set[int] = set()
        for path in paths:
            chosen = {i for i, c in enumerate(self.containers) if c[1] == path}
            inside = self._inside(chosen)
            if any(at in inside for _, _, at in self.blocks):
                break
        else:
            best, _ = self.candidate()
            inside = self._inside({best}) if best >= 0 else {-1, *range(len(self.containers))}
        return "\n\n".join(t for t, _, at in self.blocks if at in inside)

    def _inside(self, roots: set[int]) -> set[int]:
        found = set(roots)
        for i, c in enumerate(self.containers):  # parents come first
            if c[0] in found:
                found.add(i)
        return found


def winning_paths(pages: DataFrame) -> DataFrame:
    """``(host, paths)``, the best first, from ``(host, html)``."""
    def vote(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for host, source in zip(f["host"], f["html"]):
                page = Page(source)
                best, score = page.candidate()
                if best >= 0:
                    rows.append((host, page.containers[best][1], score))
            yield pd.DataFrame(rows, columns=["host", "path", "score"])

    votes = (pages.where("host is not null").mapInPandas(vote, "host string, path string, score double")
             .groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("score").alias("score")))
    votes = written(votes, "votes")
    total = votes.groupBy("host").agg(F.sum("n").alias("total"))
    order = Window.partitionBy("host").orderBy(F.desc("n"), F.desc(F.round("score", 3)), "path")
    return (votes.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= RANKS)
            .join(total, "host").where(F.col("n") >= F.lit(SHARE) * F.col("total"))
            .groupBy("host").agg(F.sort_array(F.collect_list(F.struct("rank", "path"))).alias("ranked"))
            .select("host", F.col("ranked.path").alias("paths")))


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``(page_id, url, text, n_chars)`` of every row."""
    bounded_batches(pages.sparkSession, 500)
    host = F.nullif(F.lower(F.regexp_extract(F.col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1)), F.lit(""))
    source = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"),
                          F.coalesce(F.col(html).cast("string"), F.lit("")).alias("html"), host.alias("host"))
    winners = written(winning_paths(source.select("host", "html")), "paths")
    if winners.count() <= BROADCAST_ROWS:
        joined = source.join(F.broadcast(winners), "host", "left")
    else:
        copies = winners.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = (source.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
                  .join(copies, ["host", "salt"], "left"))

    @F.pandas_udf("string")
    def main_text(sources: pd.Series, paths: pd.Series) -> pd.Series:
        return pd.Series([Page(s).text([] if p is None else list(p)) for s, p in zip(sources, paths)], dtype=object)

    return (joined.select("page_id", "url", main_text("html", "paths").alias("text"))
            .withColumn("n_chars", F.length("text").cast("long")))
