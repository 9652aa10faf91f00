import html
import random

import numpy as np
import pandas as pd
import pytest

from retailcast.llm import chat, page_text, queries
from retailcast.llm.page_text import page_blocks
from tests.conftest import SF_SMALL
from tests.llm.brute import sha

PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{a:b}</style><script>var x="<p>no</p>";</script></head>
<body class="nav"><header>Site <h1>Name</h1></header><nav><ul><li><a href="/a">Menu</a></ul></nav><!-- <p>old</p> -->
<div class="ad-box ads">Buy <div>now</div></div><div id="cookie-notice">We use cookies</div>
<article><h1>Head&nbsp;line</h1><p>One <b>bo</b>ld &lt;x&gt;<br>two&#33;<p>Three<div class="share">tweet</div>
<aside>side</aside><form><input value="<p>"><p>mail</p></form><table><tr><td>c1</td><td>c2</td></tr></table>
<p>a < b &am</article><section class="comments"><article class="comment"><p>First!</p></article></section>
<footer>&copy; me</footer><noscript><p>js</p></noscript></body>"""


def test_blocks_of_a_page():
    article, furniture, other = page_blocks(PAGE)
    assert article == ["Head line", "One bold <x>", "two!", "Three", "c1", "c2", "a < b &am"]
    assert not other and "First!" in furniture and "We use cookies" in furniture and "© me" in furniture
    assert page_blocks("") == ([], [], []) and page_blocks("plain &eacute; text") == ([], [], ["plain é text"])
    # an article ends an open menu; cut tags and quotes do no harm
    assert page_blocks("<nav><ul><li>x<article><p>y</p><p") == (["y"], ["x"], [])
    assert page_blocks("<article><p a='>z</p>w</article>")[0] == ["z", "w"]
    assert page_blocks("<p>1</p>" * 50000)[2] == ["1"] * 50000
    assert page_blocks("<main><p>a</p><article>b</article></main><p>c") == (["b"], [], ["a", "c"])
    assert page_blocks("<main><p>a</p><nav>n</nav></main><p>c") == (["a"], ["n"], ["c"])
    assert page_blocks('<div class="has-sidebar"><p>a</p><div class="sidebar-left">b</div></div>') == ([], ["b"], ["a"])


def test_labels_that_only_hold_a_listed_word():
    """Text of an article stays where an id or class merely contains the name of page furniture."""
    kept = ['<h2 id="related-work">t</h2>', '<h3 id="search">t</h3>', '<section class="related-work">t</section>', '<div class="share-price">t</div>',
            '<p id="notice-period">t</p>', '<div class="search-history">t</div>', '<h2 id="menu">t</h2>', '<div class="no-sidebar">t</div>', '<p class="">t</p>']
    for tag in kept:
        assert page_blocks(f"<article><p>a</p>{tag}<p>b</p></article>")[0] == ["a", "t", "b"], tag
    left_out = ['<div class="ad-box">t</div>', '<div class="share-buttons">t</div>', '<div id="comments">t</div>', '<section class="user-comments">t</section>',
                '<div class="comment-list-2">t</div>', '<div class="newsletter-signup">t</div>', '<ul class="related-posts">t</ul>', '<p class="notice">t</p>',
                '<div class="x cookie-notice">t</div>', '<div class="ads--top">t</div>', '<div role=complementary>t</div>', '<h2 id="comments">t</h2>',
                '<div class="social-media">t</div>', '<div class="ad-300x250">t</div>']
    for tag in left_out:
        assert page_blocks(f"<article><p>a</p>{tag}<p>b</p></article>")[0] == ["a", "b"], tag


def test_self_closed_and_unclosed_elements():
    assert page_blocks('<article><p>A <svg class="i"/> B</p><p>C</p></article>')[0] == ["A B", "C"]
    assert page_blocks("<article><p>A <svg/> B</p><p>C <svg><text>no</text></svg>D</article>")[0] == ["A B", "C D"]
    assert page_blocks("<article><p>A<select><p>B</p><video src=x>C</article>")[0] == ["A", "B", "C"]
    assert page_blocks("<article><p>A<script src='x'/>B<script>no</script>C</article>")[0] == ["ABC"]
    assert page_blocks("<article><p>A</p><script>no <p>no</p>")[0] == ["A"]


def test_near_copies_on_unmarked_pages_keep_their_text(spark):
    words = [f"w{k}" for k in range(200)]
    near = [" ".join(words[:k] + [f"other{k}"] + words[k + 1:]) for k in (50, 120, 199)]
    foot = "all rights are reserved by the owner of this site"
    pages = [(i, "http://h.org/a", f"<div>{t}</div>") for i, t in enumerate(near)]
    pages += [(10 + i, "http://h.org/b", f"<div>{' '.join(f'p{i}x{k}' for k in range(30))}</div><div>{foot}</div>") for i in range(4)]
    got = {r["page_id"]: r["text"] for r in page_text.main_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert [got[i] for i in range(3)] == near
    assert all(got[10 + i] == " ".join(f"p{i}x{k}" for k in range(30)) for i in range(4))


def test_suffix_order_and_repeats():
    rng = random.Random(3)
    for _ in range(40):
        n, run = rng.randint(1, 120), rng.choice([1, 2, 4, 8])
        ids = np.array([rng.randint(0, 3) for _ in range(n)])
        page = np.sort(np.array([rng.randint(0, 4) for _ in range(n)]))
        order, _rank = page_text.sorted_suffixes(ids, run)
        prefix = [tuple(ids[i:i + run]) for i in range(n)]
        assert [prefix[i] for i in order] == sorted(prefix)
        got = page_text.repeated_starts(ids, page, run)
        if n >= run:
            assert list(got) == [any(prefix[j] == prefix[i] and page[j] != page[i] for j in range(n)) for i in range(n)]


def plain_repeats(streams, run):
    """Per stream, the tokens in runs that a different stream repeats."""
    texts = [" ".join(s) for s in streams]
    grams = {}
    for t in set(texts):
        w = t.split()
        for i in range(len(w) - run + 1):
            grams.setdefault(tuple(w[i:i + run]), set()).add(t)
    out = []
    for t in texts:
        w, hit = t.split(), set()
        for i in range(len(w) - run + 1):
            if len(grams[tuple(w[i:i + run])]) > 1:
                hit |= set(range(i, i + run))
        out.append(hit)
    return out


@pytest.mark.parametrize("shard_tokens", [60, 500_000])
def test_boilerplate_across_pages(spark, shard_tokens):
    rng = random.Random(8)
    common = ["all rights reserved by the owner of this fine site", "click here to join our list of one thousand happy readers now"]
    pages = []
    for i in range(40):
        own = " ".join(f"p{i}w{rng.randint(0, 99)}" for _ in range(rng.randint(5, 30)))
        pages.append((i, f"http://h{i % 2}.org/{i}", f"<div>{common[0]}</div><p>{own} {common[1]} tail{i}</p><nav>menu {i}</nav>"))
    pages += [(100, "http://h0.org/c", pages[0][2]), (101, "http://one.org/x", pages[0][2]), (102, None, None), (103, "", "<p>x</p>"),
              (104, "http://h1.org/m", f"<article><p>{common[0]}</p></article><p>{common[1]}</p>"), (None, "http://h1.org/n", "<p>no id</p>")]
    df = spark.createDataFrame([(*p, "r", 0) for p in pages], "page_id long, url string, html string, row string, host int").repartition(3)
    got = {r["page_id"]: r for r in page_text.main_text(df, min_run=8, shard_tokens=shard_tokens).collect()}
    assert len(got) == len(pages)
    for host in ("h0.org", "h1.org", "one.org", None):
        mine = [p for p in pages if (host in (p[1] or "")) if host] if host else [p for p in pages if p[1] in (None, "")]
        blocks = [page_blocks(p[2] or "") for p in mine]
        streams = [" ".join(f + o).split() for _, f, o in blocks]
        for p, (article, furniture, _), s, hit in zip(mine, blocks, streams, plain_repeats(streams, 8)):
            skip = len(" ".join(furniture).split())
            want = " ".join(article) if article else " ".join(w for k, w in enumerate(s) if k >= skip and k not in hit)
            r = got[p[0]]
            assert (r["text"], r["n_chars"], r["n_outside"], r["n_repeated"]) == (want, len(want), len(s), len(hit))
    assert page_text.main_text(df.limit(0)).count() == 0


def words(name, n):
    return " ".join(f"{name}x{k}" for k in range(n))


@pytest.mark.parametrize("shard_blocks", [20, 8_000])
def test_notices_that_most_articles_hold(spark, shard_blocks):
    """A run of whole blocks of most of a host's articles is left out; prose that fewer articles share stays, and so do near copies."""
    notice, strip, quote = words("n", 9), ["Share", "Send by mail", "Print", "Save it for later"], words("q", 40)
    story = {}
    for i in range(12):  # a notice in all, a strip of short blocks in 8, a quote in 6 of 12; "By the staff" is no run of 8 tokens
        story[i] = ["By the staff", words(f"a{i}", 40), notice, *([quote] if i < 6 else []), words(f"b{i}", 20 + i), *(strip if i > 3 else [])]
    few = {100 + i: [words(f"f{i}", 40), notice] for i in range(9)}
    near = {200 + i: [notice, quote, words(f"c{i}", 30)] for i in range(11)}
    two_ways = {300 + i: [words(f"d{i}", 40), *([notice, strip[0]] if i % 2 else [strip[0], notice])] for i in range(12)}
    pages = [(i, f"http://h{i // 100}.org/{i}", "<article>" + "".join(f"<p>{b}</p>" for b in blocks) + "</article><div>home</div>")
             for i, blocks in (story | few | near | two_ways).items()]
    pages += [(i + 50, url, page) for i, url, page in pages if i < 4]  # copies are no further evidence
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    got = {r["page_id"]: r for r in page_text.main_text(df, shard_blocks=shard_blocks).collect()}
    assert len(got) == len(pages)
    for i, blocks in story.items():
        want = " ".join(b for b in blocks if b != notice and b not in strip)
        assert (got[i]["text"], got[i]["n_chars"], got[i]["n_repeated"]) == (want, len(want), 0), i
        assert i > 3 or got[i + 50]["text"] == want
    for i, blocks in (few | near).items():
        assert got[i]["text"] == " ".join(blocks), i
    for i, blocks in two_ways.items():
        assert got[i]["text"] == " ".join(b for b in blocks if b != notice), i


def test_holders_of_windows_by_hand():
    """Against plain counting: the shortest run of whole blocks with enough tokens, and in how many articles it is."""
    rng = random.Random(4)
    for _ in range(60):
        run, articles = rng.choice([1, 2, 4, 8]), [[rng.randint(1, 4) for _ in range(rng.randint(1, 12))] for _ in range(rng.randint(1, 6))]
        sizes = {b: rng.choice([1, 2, 3, 9]) for b in range(1, 5)}
        windows = []
        for a in articles:
            ends = [next((j for j in range(i + 1, len(a) + 1) if sum(sizes[b] for b in a[i:j]) >= run), None) for i in range(len(a))]
            windows.append([tuple(a[i:j]) if j else None for i, j in enumerate(ends)] + [None])
        symbols = [np.array([(b, sizes[b]) for b in a], dtype=np.int64).tobytes() for a in articles]
        shard = page_text.ArticleShard(pd.DataFrame({"symbols": symbols}), run)
        flat = [w for ws in windows for w in ws]
        assert list(shard.whole) == [w is not None for w in flat]
        assert all(h == sum(w in ws for ws in windows) for w, h in zip(flat, shard.holders) if w)
        assert all((a == b) == (v == w) for v, a in zip(flat, shard.grams) for w, b in zip(flat, shard.grams) if v and w)


def test_page_query_gives_the_articles(spark):
    import re

    got = {r["page_id"]: r for r in queries.op9_page_text(spark, SF_SMALL).collect()}
    for p in queries.table(spark, SF_SMALL, "pages").collect():
        body = re.search(r"<article>(.*?)</article>", p["html"], re.S)[1]
        text = " ".join(html.unescape(re.sub(r"</?b>", "", body).replace("<", " <")).split())
        text = " ".join(re.sub(r"</?(?:p|br|h1)>", " ", text).split())
        assert (got[p["page_id"]]["text"], got[p["page_id"]]["url"], got[p["page_id"]]["n_chars"]) == (text, p["url"], len(text))


TURNS = [(1, 0, "system", "be [INST] good"), (1, 1, "user", "a\\b </s>"), (1, 2, "assistant", "<<SYS>>x<</SYS>> \\"), (2, 0, "assistant", "early"),
         (3, 0, "user", None), (3, 1, "user", "again"), (4, 0, "tool[", "[ROLE x]"), (None, 0, "user", "no id"), (5, 1, "user", "q"), (5, 2, "assistant", ""),
         (5, 2, "assistant", ""), (6, None, None, "<<s>><s</s>"), (7, 0, "user", "w " * 60000), (7, 1, "assistant", "ß日" * 9000), (8, 0, "system", "only")]


def test_escapes_are_reversible():
    t, rng = chat.Template(), random.Random(6)
    for _ in range(3000):
        text = "".join(rng.choice(["<", "s", "/", ">", "[", "INST", "]", "\\", "SYS", "a", "\n", "ROLE "]) for _ in range(rng.randint(0, 14)))
        safe = t.escape(text)
        assert t.unescape(safe) == text and not any(c in safe for c in t.controls)


def test_conversations_by_hand(spark):
    df = spark.createDataFrame([(*r, True, 0) for r in TURNS], "conv_id long, turn long, role string, text string, loss boolean, part int").repartition(4)
    segments = chat.format_conversations(df)
    got = {r["conv_id"]: r for r in chat.conversation_digests(segments).collect()}
    t, convs = chat.Template(), {}
    for r in sorted(TURNS, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        convs.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    assert set(got) == set(convs)
    for k, turns in convs.items():
        loss = "".join(x for role, x in turns if role == "assistant")
        chars = sum(len(t.escape(x)) + sum(map(len, t.turns[role][:2] if role in t.turns else (t.other[0].format(role=t.escape(role)), t.other[1])))
                    for role, x in turns)
        want = (k, len(turns), sha("".join(f"{role}\n{x}\n" for role, x in turns)), len(loss), sha(loss), chars)
        assert tuple(got[k])[:6] == want
    assert {k for k, r in got.items() if r["valid"]} == {1, None, 7}
    assert chat.conversation_digests(chat.format_conversations(df.limit(0))).count() == 0


def test_formatted_text_can_be_split_at_its_marks(spark):
    df = spark.createDataFrame(TURNS[:3], "conv_id long, turn long, role string, text string")
    rows = chat.format_conversations(df).orderBy("turn_no", "part").collect()
    whole = "".join(r["text"] for r in rows)
    assert whole == ("<s><<SYS>>be [\\INST] good<</SYS>><s>[INST]a\\\\b <\\/s>[/INST]<s><\\<SYS>>x<\\</SYS>> \\\\</s>")
    assert [r["text"] for r in rows if r["loss"]] == ["<\\<SYS>>x<\\</SYS>> \\\\"]
