"""Class words on articles, and the vote of a host against a brute-force count."""

from collections import Counter

import pytest

from riskframe.llm import html_extract

STORY = "The harvest came late that year and the whole valley spoke of little else for weeks on end. " * 9
FRAME = ('<html><body><nav>Home News</nav><div class="ad">Buy now, buy this, buy that</div>{}'
         '<div class="comments"><div class="comment-content">Nice story, thank you for it.</div></div>'
         '<div class="sidebar">Read these five other things</div><footer>All rights</footer></body></html>')


@pytest.mark.parametrize("tag,names", [
    ("article", "post category-social"), ("article", "post comments-open"), ("article", "hentry tag-promo"), ("div", "hentry tag-promo"),
    ("div", "entry-content related-none"), ("article", "article login-required"), ("div", "post comments-open"), ("main", "search"),
    ("section", "story banner"), ("div", "widget"), ("td", "notice")])
def test_a_class_word_does_not_drop_the_article(tag, names):
    inner = f'<{tag} class="{names}"><p>{STORY}</p><div class="share">Share this</div><p>The end.</p></{tag}>'
    page = html_extract.Page(FRAME.format(f"<table><tr>{inner}</tr></table>" if tag == "td" else inner))
    assert page.text([]) == f"{STORY.strip()}\n\nThe end."


def test_doubtful_parts_go_beside_an_article():
    long = "First! " * 400
    page = html_extract.Page(f'<body><article><p>{STORY}</p></article><div class="comments"><p>{long}</p></div></body>')
    assert page.text([]) == STORY.strip()
    wrapped = html_extract.Page(f'<body><div id="content" class="sidebar-right"><article><p>{STORY}</p></article><div class="related"><p>More here</p></div></div></body>')
    assert wrapped.text([]) == STORY.strip()


@pytest.mark.parametrize("tag", ["svg", "math", "template"])
def test_markup_without_an_end_does_not_take_the_rest(tag):
    assert html_extract.Page(f"<body><{tag}><article><p>{STORY}</p></article></body>").text([]) == STORY.strip()
    assert html_extract.Page(f"<body><article><p>{STORY}</p></article><script> {STORY}").text([]) == STORY.strip()


def test_winning_paths_equal_a_count(spark):
    shapes = ['<div class="post p{i}"><p>{t}</p></div>', '<article class="story"><p>{t}</p></article>',
              '<div id="x"><section class="text promo"><p>{t}</p></section></div>', "<p>{t}</p>"]
    rows = [(f"h{i % 3}", "<body>" + shapes[(i * i + i // 7) % 4].format(i=i, t=STORY[:200 + i]) + "</body>") for i in range(90)]
    rows += [(None, rows[0][1]), ("h4", None or ""), ("h5", "<body><nav>only</nav></body>")]
    got = {r.host: r.paths for r in html_extract.winning_paths(spark.createDataFrame(rows, "host string, html string")).collect()}
    want = {}
    for host in {h for h, _ in rows if h}:
        votes, scores = Counter(), Counter()
        for h, source in rows:
            if h == host:
                page = html_extract.Page(source)
                best, score = page.candidate()
                if best >= 0:
                    votes[page.containers[best][1]] += 1
                    scores[page.containers[best][1]] += score
        ranked = sorted(votes, key=lambda p: (-votes[p], -round(scores[p], 3), p))[:html_extract.RANKS]
        if ranked:
            want[host] = [p for p in ranked if votes[p] >= html_extract.SHARE * sum(votes.values())]
    assert got == want
