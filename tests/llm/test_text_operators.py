"""Toxicity, chat formatting, HTML text, URL filters and token counts."""

import hashlib
import html
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from wakeline.llm import chat, htmltext, queries, tokens, toxicity, urls

SF = "/root/testdata/sf0.01"


def null_columns(df, *names):
    return df.withColumns({c: F.lit(None).cast("string") for c in names})


# --- toxicity -------------------------------------------------------------------------

PLAIN = toxicity.Grammar(toxicity.Model().lexicon)


def test_clauses_not_words_are_scored():
    alone = PLAIN.clause("what an idiot")
    assert alone == toxicity.INSULT_WEIGHT
    assert PLAIN.clause("you are an idiot") == PLAIN.clause("idiot that you are") == alone * toxicity.TARGET_FACTOR
    assert PLAIN.clause("certainly not idiot") == alone * toxicity.NEGATION_FACTOR
    assert PLAIN.clause("not a very bad idiot") == alone
    assert PLAIN.clause("he said idiot") == alone * toxicity.TARGET_FACTOR * toxicity.REPORT_FACTOR
    assert PLAIN.clause("i will kill you") == toxicity.THREAT_WEIGHT
    assert PLAIN.clause("kill the old long process that you know") == 0
    assert PLAIN.clause("idiotic scumbag") == PLAIN.clause("") == 0


def test_matches_are_spans_of_clauses():
    text = "All fine. You IDIOT, go on; not a problem! clown"
    found = PLAIN.matches(text)
    assert [text[a:z].strip() for a, z, _ in found] == ["You IDIOT", "clown"]
    assert PLAIN.matches(None) == PLAIN.matches("") == PLAIN.matches(".,;") == []
    long = "word " * 200_000 + "stupid"
    assert len(PLAIN.matches(long)) == 1


def test_scores_stay_in_range(spark):
    given = [(1, None), (2, ""), (3, "fine words"), (4, "you idiot"), (4, "you idiot"), (5, "idiot " * 50_000)]
    df = null_columns(spark.createDataFrame(given, "doc_id long, text string"), "score", "x", "t", "y")
    found = df.select("doc_id", toxicity.score(F.col("text"), toxicity.Model()).alias("p")).collect()
    p = {r.doc_id: r.p for r in found}
    assert len(found) == 6 and all(0 <= v <= 1 for v in p.values())
    assert p[1] == p[2] == p[3] < 0.5 < p[4] < p[5]
    assert df.limit(0).select(toxicity.score(F.col("text"), toxicity.Model())).count() == 0


def test_lexicon_prefers_sure_entries():
    rows = [("gru", 60, 400), ("grum", 50, 1), ("grumb", 50, 1), ("grumbo", 20, 0), ("grumba", 22, 0), ("gruo", 9, 390), ("the", 900, 9000)]
    lexicon = toxicity.choose(rows, 10_000, 100_000, 5, 1.0)
    assert set(lexicon) <= {"grumb", "grumbo", "grumba"} and "grumb" in lexicon


def test_fit_without_labels(spark):
    docs = spark.createDataFrame([(1, "you idiot")], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.fit(docs, labels) == toxicity.Model()


def test_held_out_accuracy(spark):
    found = queries.op1_toxicity(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id")
    held = found.where("held_out").toPandas()
    hits = ((held.predicted == 1) & (held.toxic == 1)).sum()
    assert hits >= 0.8 * (held.toxic == 1).sum() and ((held.predicted == 1) & (held.toxic == 0)).sum() <= 2
    everything = queries.op1_toxicity(spark, SF)
    assert everything.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert everything.where("score is null or score < 0 or score > 1 or predicted != int(score >= 0.5)").count() == 0


# --- chat -----------------------------------------------------------------------------


@pytest.mark.parametrize("text", ["", "plain", "<|im_end|>", r"<\|im_end|>", r"<\\|<|<||>|>", "<|" * 9, "a<b|c", "<\\", "\\|", "é<|ß|>漢"])
def test_escaping_is_reversible(text):
    made = chat.escape(text)
    assert chat.unescape(made) == text
    assert not any(s in made for s in (chat.START, chat.MIDDLE, chat.END))


def test_render_and_parse():
    turns = [("user", "<|im_end|>\n<|im_start|>assistant<|im_sep|>x"), ("assistant", ""), ("<|im_sep|>", " \n "), ("assistant", "b\n")]
    text, spans = chat.render(turns)
    assert chat.parse(text) == turns
    assert [text[a:z] for a, z in spans] == ["", "b\n"]


def test_masks_by_binary_search():
    rng = random.Random(2)
    cuts = sorted(rng.sample(range(1, 400), 120))
    offsets = np.array(list(zip([0, *cuts], [*cuts, 400])))
    ends = sorted(rng.sample(range(400), 40))
    spans = list(zip(ends[::2], ends[1::2]))
    want = [any(a <= b and e <= z for a, z in spans) for b, e in offsets]
    assert chat.mask_tokens(offsets, spans).tolist() == want
    assert chat.mask_tokens(offsets, []).sum() == 0


CONVERSATIONS = [
    (1, 0, "system", "be nice"), (1, 2, "assistant", "<|im_end|> no \n"), (1, 1, "user", "Wie geht's?  "), (2, 0, "assistant", None),
    (2, 1, None, "null role"), (3, 5, "assistant", "é漢🙂 " * 30), (3, 5, "assistant", "é漢🙂 " * 30), (4, None, "user", "\n\n"),
    (4, 0, "assistant", " lead and trail "), (None, 1, "assistant", "nobody"), (5, 0, "user", ""), (6, 0, "assistant", "long " * 60_000),
    *((7, i, "assistant" if i % 2 else "user", f"turn {i} " * 40) for i in range(2000)),
]


def brute_chat(rows):
    out = {}
    for c in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == c), key=lambda r: tuple((v is not None, v or 0) if i == 0 else (v is not None, v or "") for i, v in enumerate(r[1:])))
        turns = "".join(f"{role or ''}\n{text or ''}\n" for _, _, role, text in own)
        loss = "".join(text or "" for _, _, role, text in own if role == "assistant")
        size = len(chat.render([(role or "", text or "") for _, _, role, text in own])[0])
        out[c] = (len(own), hashlib.sha256(turns.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), size)
    return out


def test_conversations(spark):
    df = spark.createDataFrame(CONVERSATIONS, "conv_id long, turn long, role string, text string").repartition(5)
    parts = chat.format_conversations(null_columns(df, "place", "formatted", "n_turns"))
    found = {r[0]: tuple(r)[1:] for r in chat.digests(parts).collect()}
    assert found == brute_chat(CONVERSATIONS)
    assert parts.where("conv_id = 7").count() > 1
    one = parts.where("conv_id = 1").first()
    assert len(one.token_ids) == len(one.loss_mask) and one.n_turns == 3
    assert chat.digests(chat.format_conversations(df.limit(0))).count() == 0


def test_parts_have_the_tokens_of_the_whole(spark, monkeypatch):
    turns = [("assistant" if i % 2 else "user", f" turn {i}\n\n é") for i in range(30)]
    with open(chat.VOCABULARY, encoding="utf-8") as file:
        encode = chat.encoder(file.read())
    whole = encode.encode(chat.render(turns)[0], add_special_tokens=False).ids
    halves = [encode.encode(chat.render(t)[0], add_special_tokens=False).ids for t in (turns[:11], turns[11:])]
    assert halves[0] + halves[1] == whole


# --- HTML -----------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{x:"</p>"}</style></head><body class="home">
<header><h1>Site</h1></header><nav><ul><li>Menu</ul></nav><div class="cookie-notice">Cookies?</div>
<script>var a = "<article>no</article>";</script><!-- <article> -->
<article class=post id='p1'><h1>Head &amp; <i>line</i></h1><p>One&nbsp;two<br>three<p>fo<b>ur</b> &#233;&lt;b&gt;
<div class="ads">Buy!</div><form><p>Sign up</p></form><table><tr><td>c1<td>c2</table><script>x</script>
<pre>  a
  b </pre><aside>side</aside><p>1 < 2 & 3</p></article>
<section id="comments"><article class="comment"><p>First!</p></article></section><footer>&copy; me</footer></body></html>"""


def test_turns_without_order_and_text_ids(spark):
    """Many rows of one turn go to many tasks by prefixes of role and text, in the order of the whole texts."""
    rng = random.Random(3)
    roles = ["user", "assistant", "r" * 32, "r" * 33, "r" * 40, None, ""]
    rows = [(rng.choice(["a", "b", None]), rng.choice([None, 1]), rng.choice(roles), rng.choice(["", "x", "y" * 40]) + "z" * rng.randint(0, 3)) for _ in range(400)]
    df = spark.createDataFrame(rows, "conv_id string, turn long, role string, text string").repartition(6)
    found = {r.conv_id: r for r in chat.digests(chat.format_conversations(df)).collect()}
    low = lambda v: (v is not None, v or "")
    for conv in ("a", "b", None):
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, low(r[2]), low(r[3])))
        digest = hashlib.sha256("".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own).encode()).hexdigest()
        assert (found[conv].n_turns, found[conv].turns_sha256) == (len(own), digest)


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("plain &amp; simple", "plain & simple"), ("<p>a</p>\n<p> b\t c </p>", "a b c"),
    ("<div class=menu>m</div><div>text</div><div class='sidebar left'>s</div>", "text"),
    (PAGE, "Head & line One two three four é<b> c1 c2 a b 1 < 2 & 3"),
    ("<article><p>cut off &am", "cut off &am"), ("<article><p>cut</p><p class='x", "cut"), ("<article>x</artic", "x"),
    ("<p>never<script>closed <p>y", "never"), ("a<article></article>", ""), ("<article><nav>n</nav>t</article>", "t"), ("x <3 y", "x <3 y"),
    ("<main><p>m</p></main><p>outside</p>", "m"), ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "a b c d"), ("</p></div>t</article>", "t"),
])
def test_main_text(page, text):
    assert htmltext.main_text(page) == text


@pytest.mark.parametrize("page, text", [
    ("<body class='single has-sidebar'><article>t</article></body>", "t"), ("<html class='no-cookie'><body><p>t</p></body></html>", "t"),
    ("<html class='cookie'><body id='menu' class='has-header'><p>t</p></body></html>", "t"), ("<article class='post category-social'>t</article>", "t"),
    ("<article class='social'>t</article>", "t"), ("<main class='header search'>t</main>", "t"), ("<div id='content-form'><article>t</article></div>", "t"),
    ("<div class='menu'><div id='form'><main><p>t</p></main></div></div><p>far longer than the rest</p>", "t"), ("<div class='social'><article>text</article></div><p>x</p>", "text"),
    ("<div class='content-form'>t</div><div class='form'>f</div>", "t"), ("<div class='no-sidebar menu-open'>t</div><div class='left sidebar2'>s</div>", "t"),
    ("<div class='category-social'>t</div><div class='main-menu'>m</div><div role='navigation'>n</div>", "t"), ("<p>long text</p><div id='related'><article>r</article></div>", "long text"),
    ("<p>t</p><div id='comments'><article class='comment'>a far longer comment</article></div>", "t"), ("<article>t<div class='related'><article>r</article></div></article>", "t"),
    ("<nav><article>n</article></nav><p>t</p>", "t"),
])
def test_noise_names_are_whole(page, text):
    assert htmltext.main_text(page) == text


def test_deep_and_long_pages():
    assert htmltext.main_text("<div>" * 20_000 + "deep" + "</div>" * 20_000) == "deep"
    assert htmltext.main_text("<p>word</p>" * 100_000) == " ".join(["word"] * 100_000)
    assert htmltext.main_text("<a " * 20_000) == ""


def test_repeated_branches_are_cut(spark):
    rows = []
    for i in range(20):
        body = "".join(f"<p>{hashlib.md5(f'{i}-{j}'.encode()).hexdigest()}</p>" for j in range(1 + i % 4))
        rows.append((i, f"http://a.example/{i}", f"<html><body><div class='box{i}'><span>Read more stories</span></div><div>{body}</div></body></html>"))
    rows += [(100, "http://b.example/", "<div class='box1'><span>Read more stories</span></div>"), (101, None, None), (102, "", ""), (0, rows[0][1], rows[0][2])]
    df = null_columns(spark.createDataFrame(rows, "page_id long, url string, html string"), "host", "node", "cut", "text")
    found = htmltext.extract(df)
    text = {r.page_id: r.text for r in found.collect()}
    assert found.count() == len(rows) and text[101] == text[102] == ""
    assert not any("Read more" in text[i] for i in range(20)) and all(len(text[i]) >= 32 for i in range(20))
    assert text[100] == "Read more stories"  # one page says nothing about its host
    assert htmltext.extract(df.limit(0)).count() == 0


def test_boxes_inside_articles_are_cut(spark):
    rows = []
    for i in range(20):
        words = [hashlib.md5(f"{i}-{j}".encode()).hexdigest() for j in range(3)]
        flag = "yes" if i % 2 else "no"
        body = (
            f"<h2>Summary</h2><p>{words[0]} <b class='x'>never</b> {words[1]}</p><div class='kiosk'><p>Join our readers</p></div>"
            f"<table><tr><td>{words[2]}</td><td>{flag}</td></tr></table><span class='pill'>Tell a friend</span>"
        )
        tag = "main" if i % 2 else "article"
        rows.append((i, f"http://a.example/{i}", f"<body><{tag}>{body}</{tag}></body>", f"Summary {words[0]} never {words[1]} {words[2]} {flag}"))
        rows.append((100 + i, "http://b.example/" if i < 1 else f"http://h{i}.example/", rows[-1][2], None))
    df = spark.createDataFrame(rows, "page_id long, url string, html string, want string")
    text = {r.page_id: r.text for r in htmltext.extract(df).collect()}
    assert all(text[r[0]] == r[3] for r in rows if r[3])
    assert all("Join our readers" in text[100 + i] and "Tell a friend" in text[100 + i] for i in range(20))  # one page a host


@pytest.mark.parametrize("copies", [7, 8, 1000])
def test_copies_of_a_page_are_one_page(spark, copies):
    page = "<html><body><div><p>Same</p><p>Same</p></div></body></html>" * 8
    rows = [(i, u, page) for i in range(copies) for u in ("http://a.example/", None)]
    # On a host with other pages the copies do not decide about those.
    others = [(1000 + i, "http://b.example/", f"<body><div>{hashlib.md5(f'{i}'.encode()).hexdigest()}</div><div class='kiosk'>Join</div></body>") for i in range(100)]
    rows += [(i, "http://b.example/", others[0][2]) for i in range(copies)] + others
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = htmltext.extract(df).collect()
    assert len(found) == len(rows)
    for r in found:
        own = hashlib.md5(f"{max(r.page_id - 1000, 0)}".encode()).hexdigest()
        assert r.text == (own if r.url and "b.ex" in r.url else htmltext.main_text(page)) != ""


def test_a_page_of_repeated_text_keeps_it(spark):
    rows = [(i, "http://a.example/", f"<body><!-- {i} --><div>Members only</div></body>") for i in range(20)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.text for r in htmltext.extract(df).collect()} == {"Members only"}


def test_pages_against_a_pattern(spark):
    def pattern(page):
        inside = re.search(r"<article>(.*?)(</article>|\Z)", page, re.S)
        blocks = re.split(r"</?(?:p|h1|br)>", re.sub(r"<[^>]*\Z", "", inside[1]) if inside else "")
        plain = (re.sub(r"\s+", " ", html.unescape(re.sub(r"</?b>", "", b))).strip() for b in blocks)
        return " ".join(b for b in plain if b)

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    found = queries.op4_html_text(spark, SF).collect()
    assert len(found) == len(pages) and all(r.text == pattern(pages[r.page_id]) and r.n_chars == len(r.text) for r in found)


# --- URLs -----------------------------------------------------------------------------


def brute_url(url, rules):
    name = path = ""
    if url and "://" in url:
        name, rest = re.match(r"([^/?#]*)(.*)", url.split("://", 1)[1], re.S).groups()
        name, path = re.sub("[A-Z]", lambda m: m[0].lower(), name), re.match(r"[^?#]*", rest)[0]
    fits = [r for r in rules if (h := r.partition("/")[0]) is not None and (name == h or name.endswith("." + h)) and path.startswith("/" + r.partition("/")[2])]
    return name, path, max(fits, key=len, default=None)


URLS = [None, "", "no scheme", "http://", "://x.com/", "HTTP://Example.COM/en/a?x#y", "http://www.example.com/en/", "http://www.example.com/enx", "http://a.www.example.com/en/q",
        "http://notexample.com/en/", "http://com", "http://com/", "http://x.net/es/1", "http://net/fr/", "http://x.net/de/", "http://x.com?q=/en/", "http://x.com#://y.net/es/",
        "http://é.org/ü", "ftp://user@h.net:80/es/", "http://a://b.com/x", "http://x.net/es", "http://" + "verylonglabel" * 200 + ".org/" + "p/" * 2000]


def test_judge(spark):
    rows = [(i, u, "<p>very long label example words</p>") for i, u in enumerate(URLS)] + [(0, None, None)]
    df = null_columns(spark.createDataFrame(rows, "page_id long, url string, html string"), "host", "rule", "tokens", "kind", "score")
    found = urls.judge(df, queries.RULES).collect()
    assert len(found) == len(rows)
    for r in found:
        name, path, rule = brute_url(URLS[r.page_id], queries.RULES)
        assert (r.host, r.path, r.rule) == (name, path, rule)
        assert r.verdict == (queries.RULES[rule] if rule else ("block" if r.score > 0 else "allow"))
    assert urls.judge(df.limit(0), queries.RULES).count() == 0
    assert {r.verdict for r in urls.judge(df, {}).collect()} == {"allow"}
    assert {r.verdict for r in urls.judge(df, {"net/": "block"}).collect()} >= {"block"}


def test_segments():
    counts = {"the": 500, "morning": 40, "post": 30, "them": 20, "or": 90, "mor": 1, "ning": 1, "a": 100}
    assert urls.segment("themorningpost", counts, 1000) == ["the", "morning", "post"]
    assert urls.segment("xyz", counts, 1000) == ["xyz"] and urls.segment("", counts, 1000) == []
    assert "".join(urls.segment("q" * 500, counts, 1000)) == "q" * 500


def test_url_table(spark):
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url").collect()}
    found = queries.op8_url_filter(spark, SF).collect()
    assert len(found) == len(pages) and all((r.host, r.path, r.rule) == brute_url(pages[r.page_id], queries.RULES) for r in found)


# --- tokens ---------------------------------------------------------------------------


def encoding():
    import tiktoken

    return tiktoken.Encoding("t", pat_str=tokens.PATTERN, mergeable_ranks=tokens.read_ranks(tokens.VOCABULARY), special_tokens={})


def test_separator_scan_over_blocks(spark, tmp_path, rows):
    rng, eod = np.random.default_rng(6), 7
    want = []
    for name in ("a.bin", "b.bin", "c.bin", "d.bin", "e.bin"):
        sizes = {"a.bin": [0, 0, 3, 5000, 1, 0], "b.bin": rng.integers(0, 40, 300).tolist(), "c.bin": [10_000], "d.bin": [], "e.bin": [0]}[name]
        ids = np.concatenate([np.append(rng.integers(8, 60_000, n), eod) for n in sizes] or [np.zeros(0)]).astype("<u2")
        if name == "c.bin":
            ids = ids[:-1]  # a last document that nothing closes
        (tmp_path / name).write_bytes(ids.tobytes())
        want += [(name, i, n) for i, n in enumerate(sizes)]
    files = tokens.list_files(spark, str(tmp_path))
    for block in (3, 64, 1 << 20):
        found = tokens.count_tokens(files, eod, block_bytes=block)
        assert sorted((r.path.rsplit("/")[-1], r.ordinal, r.n_tokens) for r in found.collect()) == want


def test_document_tokens(spark, monkeypatch):
    monkeypatch.setattr(tokens, "CALL_CHARS", 1000)
    given = [(1, None), (2, ""), (3, "<|endoftext|> is text"), (4, "one two three " * 4000), (4, "again"), (None, "no id"), (5, "x" * 5000), (6, "a  b\n\n c" * 900)]
    df = null_columns(spark.createDataFrame(given, "doc_id long, text string"), "file", "ordinal", "path", "block")
    encode = encoding().encode_ordinary
    found = sorted((tuple(r) for r in tokens.document_tokens(df, block_bytes=100).collect()), key=repr)
    assert found == sorted(((d, len(encode(t or ""))) for d, t in given), key=repr)
    assert tokens.document_tokens(df.limit(0)).count() == 0


def test_token_table(spark):
    encode = encoding().encode_ordinary
    want = {r.doc_id: len(encode(r.text)) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert {r.doc_id: r.n_tokens for r in queries.op10_token_counts(spark, SF).collect()} == want
