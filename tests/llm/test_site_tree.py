"""Names of boxes, reader comments in articles, and the style tree against a plain entropy count."""

import hashlib
import math
import random
from collections import Counter

import pytest
from xxhash import xxh64_intdigest

from wakeline.llm import htmltext

BODY = " ".join(hashlib.md5(str(i).encode()).hexdigest()[:6] for i in range(40))


@pytest.mark.parametrize("name", [
    "comments-area", "comment-list", "share-buttons", "social-icons", "related-posts", "ad-container", "cookie-bar", "newsletter-box", "footer-widgets",
    "nav_wrapper", "sidebar-section", "promo-strip", "breadcrumb-list", "comments", "main-menu", "cookie-notice",
])
def test_boxes_named_by_their_first_word_go(name):
    box = f"<div class='{name}'><p>Not this</p></div>"
    assert htmltext.main_text(f"<article><p>{BODY}</p>{box}</article>") == BODY
    assert htmltext.main_text(f"<body>{box}<div class='post'><p>{BODY}</p></div></body>") == BODY


@pytest.mark.parametrize("name", [
    "has-sidebar", "no-cookie", "category-social", "content-form", "post-list", "article-section", "text-box", "format-related-list", "commentary", "adventure-area",
    "with-ads-container", "post", "navy-blue", "shareholder-news",
])
def test_boxes_of_other_names_stay(name):
    assert htmltext.main_text(f"<body><div class='{name}'><p>{BODY}</p></div></body>") == BODY
    assert htmltext.main_text(f"<article><div class='{name}'><p>{BODY}</p></div></article>") == BODY
    assert htmltext.main_text(f"<div class='{name}'><article><p>{BODY}</p></article></div>") == BODY


@pytest.mark.parametrize("page", [
    f"<div class='post'><p>{BODY}</p></div><article class='comment'><p>First!</p></article>",
    f"<article class='comment'><p>First!</p></article><div class='post'><p>{BODY}</p></div>",
    f"<article><p>{BODY}</p></article><article class='comment'><p>First!</p></article><article id='comment-7' class='comment depth-2'>Second!</article>",
    f"<article><p>{BODY}</p><article class='comment'><p>First!</p></article></article>",
    f"<article class='post'><p>{BODY}</p></article><article class='related'>Other story</article>",
    f"<main><p>{BODY}</p><article class='comment'>First!</article></main>",
    f"<article class='social'><p>{BODY}</p></article>",
    f"<article class='comment'><p>{BODY}</p></article><p>x</p>",
])
def test_comments_in_articles_never_replace_or_join_the_text(page):
    assert htmltext.main_text(page) == BODY


# A page as nested (tag, names, children); a child is a text or such a triple.


def written(node):
    if isinstance(node, str):
        return node
    tag, names, children = node
    return f"<{tag}{f' class={chr(34)}{names}{chr(34)}' if names else ''}>{''.join(map(written, children))}</{tag}>"


def below(node):
    """What is under a node: texts before the contents of its elements, as nested tuples."""
    texts = tuple(c for c in node[2] if isinstance(c, str))
    inner = tuple(reversed([below(c) for c in node[2] if not isinstance(c, str)]))
    return (texts, inner)


def brute_importance(pages):
    """{signature: (pages, importance)} by counting presentations and contents of each path."""
    shown, looks, says = Counter(), {}, {}

    def walk(node, parent, met):
        tag, names, children = node
        sign = xxh64_intdigest(f"{parent}>{tag}.{names}") >> 1
        for child in children:
            if not isinstance(child, str):
                walk(child, sign, met)
        texts, inner = below(node)
        if texts or inner:
            looks.setdefault(sign, Counter())[tuple(c[0] for c in children if not isinstance(c, str))] += 1
            says.setdefault(sign, Counter())[(texts, inner)] += 1
            met.add(sign)

    for page in pages:
        met = set()
        walk(page, 0, met)
        shown.update(met)

    def spread(counts):
        n = sum(counts.values())
        return 1.0 if n == 1 else -sum(c / n * math.log(c / n) for c in counts.values()) / math.log(n)

    return {s: (shown[s], 0.1 * spread(looks[s]) + 0.9 * spread(says[s])) for s in shown}


def site(seed):
    rng = random.Random(seed)
    words = lambda n: " ".join(rng.choice("alpha beta gamma delta epsilon zeta".split()) for _ in range(n))
    pages = []
    for i in range(rng.randint(3, 14)):
        boxes = [("div", "kiosk", [("span", "", ["Join us"]), ("span", "", [rng.choice(["now", "today"])])])]
        text = ("div", "story", [("p", "", [f"{words(3)} {i}"]) for _ in range(rng.randint(1, 3))])
        parts = [("section", "top", [words(1)]), text, *boxes]
        rng.shuffle(parts)
        pages.append(("body", "", parts))
    return pages


def test_importance_equals_a_plain_entropy_count(spark):
    hosts = {f"h{i}.example": site(i) for i in range(10)}
    rows = [(h, written(p) + f"<!-- {i} -->") for h, pages in hosts.items() for i, p in enumerate(pages)]
    found = htmltext.importance(spark.createDataFrame(rows, "host string, html string")).collect()
    got = {(r.host, r.node): (r["count"], r.importance) for r in found}
    want = {(h, s): v for h, pages in hosts.items() for s, v in brute_importance(pages).items()}
    assert got.keys() == want.keys()
    assert all(got[k][0] == want[k][0] and got[k][1] == pytest.approx(want[k][1], abs=1e-9) for k in want)


def test_low_importance_is_what_goes(spark):
    pages = [p for seed in range(40) for p in site(seed)][:60]
    rows = [(i, "http://one.example/", written(p)) for i, p in enumerate(pages)]
    text = {r.page_id: r.text for r in htmltext.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert not any("Join us" in t for t in text.values())
    for i, page in enumerate(pages):
        story = next(c for c in page[2] if c[1] == "story")
        assert all(p[2][0] in text[i] for p in story[2])
