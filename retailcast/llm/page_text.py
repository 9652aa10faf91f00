"""Main text of web pages: markup rules, and suffix arrays over each host's articles and remaining text.

Markup leaves out scripts, menus, headers, footers, sidebars, adverts, forms, notices and reader
comments that it names.  What else repeats is found by suffix arrays.

What a page holds outside a marked article forms its token stream.  The streams of a host are put
end to end, their suffixes sorted, and substrings of MIN_RUN tokens or more that start suffixes of
two different streams are boilerplate.  On pages without a marked article the covered tokens are
removed and the unique runs kept.

The marked articles of a host have an array of their own, with blocks as symbols.  Articles share
prose too (quotes, near copies, standing lines), so a repeated run of blocks is a notice, advert or
menu that no name gives away only if most of the host's different articles hold it.
"""

from __future__ import annotations

import html
import json
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailcast.llm.blocklist import host_of
from retailcast.llm.common import batch_of, columns_of, slices, written

MIN_RUN = 8  # tokens; a power of two, as the sort doubles its prefix
SHARD_TOKENS = 500_000  # tokens sorted in one suffix array, about
MOST_REPEATED = 0.8  # a page with more of its unmarked tokens in repeated runs is a near copy, not boilerplate
SHARD_BLOCKS = 8_000  # blocks of articles sorted in one suffix array, about
LEAST_ARTICLES = 10  # fewer different articles of a host don't tell its notices from shared prose
COMMON = 0.5  # a notice is held by more of a host's articles than this, and is less than this of the article
RAW = "script|style|title|textarea|noscript|template|iframe"  # left out up to their end, or that of the page
HELD = "svg|select|object|audio|video|canvas"  # left out if they end; without an end tag only the tag is
TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?:{RAW}|{HELD})\b[^>]*/>|<(?P<raw>{RAW})\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)|<(?P<held>{HELD})\b[^>]*>.*?</(?P=held)\s*>"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][\w:-]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<[!?/][^>]*(?:>|\Z)|</?[a-zA-Z][^>]*(?:>|\Z)", re.S | re.I)
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd",
          "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
ARTICLE = ("article", "main")
FURNITURE = {"nav", "header", "footer", "menu", "aside", "form", "dialog", "button"}
# words of a class, id or role that name page furniture, adverts, notices or reader comments
NAMES = frozenset("""
ad ads advert adverts advertisement adsense sponsor sponsored promo banner cookies consent gdpr notice notices disclaimer popup modal
newsletter subscribe signup login search toolbar widget pagination pager nav navbar navigation menu breadcrumb breadcrumbs sidebar
complementary related share social comment comments replies contentinfo disqus""".split())
SITE = frozenset(("header", "footer", "masthead"))  # outside an article only
COMMENTS = frozenset(("comment", "comments", "replies", "disqus"))
# words that may follow such a name: "ad-box" is an advert, while "share-price" is a price
PARTS = frozenset("""
area articles aside bar block body bottom box button buttons card center col column container content footer form frame grid group header heading holder
icon icons image inner item items label leaderboard left link links list media message module now outer panel posts reading rectangle right row
section skyscraper slot stories strip text this thread title toggle top unit wrap wrapper""".split())
LABEL = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}


def page_blocks(page: str) -> tuple[list[str], list[str], list[str]]:
    """(article blocks, furniture blocks, other blocks) of a page, each in page order.

    Where no article element has text, the main element stands for it.

    A block's character references are decoded and its white space is one space.  Tags need not be
    closed or nested well: an article's start ends an open menu, header, footer or advert.
    """
    blocks: list[tuple[str, str]] = []
    text: list[str] = []
    skip, depth, comments = "", 0, False  # the element that is left out, and how many of its name are open
    open_, at = dict.fromkeys(ARTICLE, 0), 0

    def close_block() -> None:
        block = " ".join(html.unescape("".join(text)).split())
        text.clear()
        if block:
            blocks.append(("furniture" if skip else next((n for n in ARTICLE if open_[n]), "other"), block))

    for tag in TOKEN.finditer(page):
        text.append(page[at:tag.start()])
        at = tag.end()
        name = (tag["name"] or "").lower()
        if not name or name in INLINE:  # these don't end a block
            continue
        close_block()
        if name in VOID:
            continue
        if tag["close"]:
            if skip:
                if name == skip:
                    depth -= 1
                    if not depth:
                        skip = ""
                elif name in ARTICLE and open_[name] and not comments:
                    skip, open_[name] = "", open_[name] - 1
            elif name in ARTICLE and open_[name]:
                open_[name] -= 1
            continue
        labels = _labels(name, tag["attrs"]) if "=" in tag["attrs"] else frozenset()
        if skip:
            if name in ARTICLE and not comments and not open_["article"] and not labels & NAMES:
                skip = ""
            else:
                depth += name == skip
                continue
        named = name not in ("html", "body") and (labels & NAMES or not any(open_.values()) and labels & SITE)
        if name in FURNITURE or named:
            skip, depth, comments = name, 1, bool(labels & COMMENTS)
        elif name in ARTICLE:
            open_[name] += 1
    text.append(page[at:])
    close_block()
    chosen = next((n for n in ARTICLE if any(kind == n for kind, _ in blocks)), None)
    return ([b for kind, b in blocks if kind == chosen], [b for kind, b in blocks if kind == "furniture"],
            [b for kind, b in blocks if kind not in (chosen, "furniture")])


def _labels(name: str, attrs: str) -> frozenset[str]:
    """What the words of an element's class, id and role call it: of each its last word, parts and numbers left out.

    So "ad-box-2" is an ad and "user-comments" are comments, while "related-work" is work and "has-sidebar" no sidebar.
    The id of a heading is an anchor for links, and only counts where it names comments.
    """
    out = set()
    for kind, *values in LABEL.findall(attrs):
        anchor = name in HEADINGS and kind.lower() == "id"
        for label in "".join(values).lower().split():
            words = [w for w in re.split(r"[-_]+", label) if w]
            if words and words[0] in ("has", "with", "without", "no"):
                continue
            while len(words) > 1 and (words[-1] in PARTS or any(c.isdigit() for c in words[-1])):
                words.pop()
            if words and (not anchor or words[-1] in COMMENTS):
                out.add(words[-1])
    return frozenset(out)


PARSED = ("page_id long, url string, host string, article array<string>, marked boolean, other string, outside string, "
          "tokens long, stream long, content long, story long, symbols binary")


def signed_hash(text: str | bytes) -> int:
    h = xxhash.xxh64_intdigest(text)
    return h - (1 << 64) if h >> 63 else h


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for some in slices(batch):
            rows = []
            for page_id, url, host, page in zip(*columns_of(some, "page_id", "url", "host", "html")):
                article, furniture, other = page_blocks(page or "")
                outside = " ".join(furniture)
                stream, blocks = " ".join((*furniture, *other)), json.dumps(other)
                symbols = np.array([(signed_hash(b), b.count(" ") + 1) for b in article], dtype=np.int64).tobytes()
                rows.append((page_id, url, host, article, bool(article), blocks, outside, len(stream.split()), signed_hash(stream),
                             signed_hash(f"{len(outside)} {blocks} {outside}"), signed_hash(symbols), symbols))
            yield batch_of(PARSED, rows)


def sorted_suffixes(ids: np.ndarray, run: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffix positions in order of their first ``run`` tokens, rank of each position), by prefix doubling."""
    rank, k = np.unique(ids, return_inverse=True)[1], 1
    while k < run:
        after = np.full(len(rank), -1, dtype=np.int64)
        after[:-k] = rank[k:]
        rank = np.unique(rank * (len(rank) + 1) + after + 1, return_inverse=True)[1]
        k *= 2
    return np.argsort(rank, kind="stable"), rank


def repeated_starts(ids: np.ndarray, page: np.ndarray, run: int) -> np.ndarray:
    """True where a substring of ``run`` tokens starts that also starts in another page's stream."""
    out = np.zeros(len(ids), dtype=bool)
    if len(ids) < run:
        return out
    order, rank = sorted_suffixes(ids, run)
    first = np.concatenate([[0], np.nonzero(np.diff(rank[order]))[0] + 1])
    pages = page[order]
    shared = np.minimum.reduceat(pages, first) != np.maximum.reduceat(pages, first)
    out[order] = np.repeat(shared, np.diff(np.concatenate([first, [len(ids)]])))
    return out


class Shard:
    """Token streams of some pages of a host, put end to end with a separator of its own after each."""

    def __init__(self, pdf: pd.DataFrame, run: int):
        self.run = run
        number: dict[str, int] = {}
        ids, page, self.bounds = [], [], []
        for other, outside, key in zip(pdf["other"], pdf["outside"], pdf["stream"]):
            words = outside.split()
            for block in json.loads(other):
                words += block.split()
            self.bounds.append((len(ids), len(outside.split())))
            ids += [number.setdefault(w, len(number)) for w in words]
            page += [key] * (len(words) + 1)
            ids.append(-len(self.bounds))
        self.ids, self.page = np.array(ids, dtype=np.int64), np.array(page, dtype=np.int64)
        words = np.array([xxhash.xxh64_intdigest(w) for w in number], dtype=np.uint64)
        hashes = np.zeros(len(ids), dtype=np.uint64)
        if len(words):
            hashes = np.where(self.ids >= 0, words[np.maximum(self.ids, 0)], np.uint64(0))
        n = max(0, len(ids) - run + 1)
        grams, whole = np.zeros(n, dtype=np.uint64), np.ones(n, dtype=bool)
        for k in range(run):
            grams = grams * np.uint64(0x100000001B3) + hashes[k:k + n]
            whole &= self.ids[k:k + n] >= 0
        self.grams, self.whole = grams.view(np.int64), whole  # a window over a separator is no substring

    def covered(self, elsewhere: np.ndarray) -> np.ndarray:
        """Tokens in a run that another page of the shard, or another shard (by hash), repeats."""
        n = len(self.grams)
        start = repeated_starts(self.ids, self.page, self.run)[:n] & self.whole
        start |= self.whole & np.isin(self.grams, elsewhere)
        depth = np.zeros(len(self.ids) + 1, dtype=np.int64)
        at = np.nonzero(start)[0]
        np.add.at(depth, at, 1)
        np.add.at(depth, at + self.run, -1)
        return np.cumsum(depth)[:-1] > 0


def _grams(run: int):
    def grams(pdf: pd.DataFrame) -> pd.DataFrame:
        shard = Shard(pdf, run)
        return pd.DataFrame({"host": pdf["host"].iloc[0], "shard": pdf["shard"].iloc[0], "gram": np.unique(shard.grams[shard.whole])})
    return grams


CLEAN = "host string, stream long, content long, kept string, n_outside long, n_repeated long"


def _clean(run: int):
    def clean(pages: pd.DataFrame, shared: pd.DataFrame) -> pd.DataFrame:
        if not len(pages):
            return pd.DataFrame({c.split()[0]: [] for c in CLEAN.split(", ")})
        pages = pages.sort_values(["stream", "content"])
        shard = Shard(pages, run)
        covered = shard.covered(shared["gram"].to_numpy(np.int64))
        out = []
        for host, stream, content, other, (at, n) in zip(pages["host"], pages["stream"], pages["content"], pages["other"], shard.bounds):
            begin = at + n
            words = [w for block in json.loads(other) for w in block.split()]
            held = covered[begin:begin + len(words)]
            kept = words if words and held.mean() > MOST_REPEATED else [w for w, c in zip(words, held) if not c]
            begin += len(words)
            out.append((host, stream, content, " ".join(kept), begin - at, int(covered[at:begin].sum())))
        return pd.DataFrame(out, columns=[c.split()[0] for c in CLEAN.split(", ")])
    return clean


def common_prefixes(ids: np.ndarray, order: np.ndarray, run: int) -> np.ndarray:
    """How many symbols, ``run`` at most, each suffix but the first of ``order`` shares with the one before it."""
    out, same, n = np.zeros(max(0, len(order) - 1), dtype=np.int64), np.ones(max(0, len(order) - 1), dtype=bool), len(ids)
    for k in range(run):
        a, b = order[:-1] + k, order[1:] + k
        same &= (np.maximum(a, b) < n) & (ids[np.minimum(a, n - 1)] == ids[np.minimum(b, n - 1)])
        out += same
    return out


class ArticleShard:
    """Different articles of a host, put end to end with a separator of its own after each; blocks are the symbols.

    The window of a block is the shortest run of blocks from it on that holds ``run`` tokens.
    """

    def __init__(self, pdf: pd.DataFrame, run: int):
        self.articles = [np.frombuffer(b, dtype=np.int64).reshape(-1, 2) for b in pdf["symbols"]]
        lengths = np.array([len(a) for a in self.articles], dtype=np.int64)
        self.first = np.concatenate([[0], np.cumsum(lengths + 1)])
        n = int(self.first[-1])
        self.page = np.repeat(np.arange(len(lengths)), lengths + 1)
        block = np.ones(n, dtype=bool)
        block[self.first[1:] - 1] = False
        hashes, tokens = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
        hashes[block], tokens[block] = np.concatenate(self.articles).T
        ids = -1 - self.page
        ids[block] = np.unique(hashes[block], return_inverse=True)[1]
        total = np.concatenate([[0], np.cumsum(tokens)])
        window = np.searchsorted(total, total[:-1] + run) - np.arange(n)
        self.whole = np.arange(n) + window < self.first[1:][self.page]
        self.window = np.where(self.whole, window, run + 1)
        grams = np.zeros(n, dtype=np.uint64)
        for k in range(run):
            at = np.nonzero(self.whole & (self.window > k))[0]
            grams[at] = grams[at] * np.uint64(0x100000001B3) + hashes[at + k].view(np.uint64)
        self.grams = grams.view(np.int64)
        # neighbours in suffix order hold the same window if they share as many symbols
        order, _rank = sorted_suffixes(ids, run)
        group = np.concatenate([[0], np.cumsum(common_prefixes(ids, order, run) < self.window[order[1:]])])
        held = np.unique(group * len(lengths) + self.page[order]) // len(lengths)
        self.holders = np.zeros(n, dtype=np.int64)  # articles of this shard that hold the window
        self.holders[order] = np.bincount(held)[group]

    def left_out(self, shared: pd.DataFrame, n_articles: int) -> list[list[int]]:
        """Per article its blocks in windows that most of the host's ``n_articles`` hold; none if they were half of its tokens.

        ``shared`` has the holders in all shards, of the windows (``gram``) for which that can make a difference.
        """
        grams, n = shared["gram"].to_numpy(np.int64), shared["n"].to_numpy(np.int64)
        by_gram = np.argsort(grams)
        grams, n = grams[by_gram], n[by_gram]
        holders = self.holders.copy()
        if len(grams):
            at = np.minimum(np.searchsorted(grams, self.grams), len(grams) - 1)
            holders = np.where(grams[at] == self.grams, n[at], holders)
        start = np.nonzero(self.whole & (holders > COMMON * n_articles))[0]
        depth = np.zeros(len(self.page) + 1, dtype=np.int64)
        np.add.at(depth, start, 1)
        np.add.at(depth, start + self.window[start], -1)
        covered = np.cumsum(depth) > 0
        out = []
        for article, at in zip(self.articles, self.first):
            held, tokens = covered[at:at + len(article)], article[:, 1]
            out.append(np.nonzero(held)[0].tolist() if tokens[held].sum() < COMMON * tokens.sum() else [])
        return out


def _article_grams(run: int):
    def grams(pdf: pd.DataFrame) -> pd.DataFrame:
        shard = ArticleShard(pdf, run)
        gram, at = np.unique(shard.grams[shard.whole], return_index=True)
        n = shard.holders[shard.whole][at]
        return pd.DataFrame({"host": pdf["host"].iloc[0], "shard": pdf["shard"].iloc[0], "gram": gram, "n": n, "most": n > COMMON * len(pdf)})
    return grams


def _notices(run: int):
    def notices(articles: pd.DataFrame, shared: pd.DataFrame) -> pd.DataFrame:
        left_out = ArticleShard(articles, run).left_out(shared, int(articles["articles"].iloc[0])) if len(articles) else []
        out = [(host, story, blocks) for host, story, blocks in zip(articles["host"], articles["story"], left_out) if blocks]
        return pd.DataFrame(out, columns=["host", "story", "left_out"])
    return notices


def article_notices(articles: DataFrame, min_run: int = MIN_RUN, shard_blocks: int = SHARD_BLOCKS) -> DataFrame:
    """host, story, left_out for the rows of ``host, story, symbols`` (one per different article) that hold notices.

    ``symbols`` has the hash and the number of tokens of each block; ``left_out`` numbers the blocks, from 0, in runs of
    ``min_run`` tokens or more that more than COMMON of the host's articles hold.  Hosts of fewer than LEAST_ARTICLES
    articles give none.  Hosts are cut into shards of about ``shard_blocks``.  What most articles of a host hold, most
    articles of some shard hold: the holders of such runs in all shards are added up by the run's hash.
    """
    sizes = (articles.groupBy("host").agg(F.sum(F.length("symbols") / 16).alias("n"), F.count("*").alias("articles"))
             .where(F.col("articles") >= LEAST_ARTICLES).select("host", "articles", F.ceil(F.col("n") / shard_blocks).alias("shards")))
    # dealt anew after the join, which may leave a host's articles together
    dealt = (articles.join(written(sizes, "sizes"), "host").withColumn("shard", F.pmod(F.xxhash64("story"), F.col("shards")))
             .repartition("host", "shard"))
    grams = (dealt.where("shards > 1").groupBy("host", "shard")
             .applyInPandas(_article_grams(min_run), "host string, shard long, gram long, n long, most boolean"))
    grams = written(grams, "article-grams")
    often = written(grams.where("most").select("host", "gram").distinct(), "often")
    often = written(grams.join(often, ["host", "gram"]).select("host", "shard", "gram", "n"), "often-held")
    shared = often.drop("n").join(often.groupBy("host", "gram").agg(F.sum("n").alias("n")), ["host", "gram"])
    return (dealt.groupBy("host", "shard").cogroup(shared.groupBy("host", "shard"))
            .applyInPandas(_notices(min_run), "host string, story long, left_out array<int>"))


def main_text(pages: DataFrame, min_run: int = MIN_RUN, shard_tokens: int = SHARD_TOKENS, shard_blocks: int = SHARD_BLOCKS) -> DataFrame:
    """page_id, url, text, n_chars, n_outside, n_repeated for every row of ``page_id, url, html``.

    ``text``: the blocks of the marked article without those in runs that most of the host's articles hold, or else the
    unique runs of the unmarked blocks, joined by one space.  ``n_outside`` counts the tokens outside a marked article,
    ``n_repeated`` those of them in runs that other pages of the host repeat.  Null or empty html gives empty text; pages
    without a host form one host; rows that repeat an id are pages of their own, but equal streams count as one page and
    equal articles as one article.  An empty table gives no row; other columns are left out.  A page without a marked
    article more than MOST_REPEATED of whose unmarked tokens other pages repeat is a near copy of one, and keeps them all.

    A host of many pages is cut into shards of about ``shard_tokens``, each with its own suffix array.
    Substrings that only different shards share are found by joining the hashes of the shards'
    distinct substrings of ``min_run`` tokens, so no repeat is missed.
    """
    if min_run & (min_run - 1):
        raise ValueError("min_run must be a power of two")
    rows = pages.select(F.col("page_id").cast("long"), "url", host_of(F.col("url")).alias("host"), "html")
    # parsed twice, for the arrays and for the result: cheaper than a written copy of all articles
    parsed = rows.mapInArrow(_parse, PARSED)
    page = ["host", "stream", "content", "story"]
    found = written(parsed.where("tokens > 0 or marked").select(*page, "marked", "other", "outside", "tokens", "symbols"), "pages")
    articles = written(found.where("marked").select("host", "story", "symbols").dropDuplicates(["host", "story"]), "articles")
    # copies of one stream count as one page (they'd repeat each other entirely), in one shard
    streams = written(found.where("tokens > 0").select("host", "stream", "content", "other", "outside", "tokens")
                      .dropDuplicates(["host", "stream", "content"]), "streams")
    sizes = streams.groupBy("host").agg(F.sum("tokens").alias("n")).select("host", F.ceil(F.col("n") / shard_tokens).alias("shards"))
    streams = streams.join(sizes, "host").withColumn("shard", F.pmod(F.xxhash64("stream"), F.col("shards")))
    grams = (streams.where("shards > 1").groupBy("host", "shard").applyInPandas(_grams(min_run), "host string, shard long, gram long"))
    grams = written(grams, "grams")
    both = grams.groupBy("host", "gram").count().where("count > 1").select("host", "gram")
    shared = grams.join(both, ["host", "gram"])
    clean = streams.groupBy("host", "shard").cogroup(shared.groupBy("host", "shard")).applyInPandas(_clean(min_run), CLEAN)
    notices = article_notices(articles, min_run, shard_blocks)
    said = found.select(*page).distinct().join(clean, ["host", "stream", "content"], "left").join(notices, ["host", "story"], "left")
    blocks = F.when(F.col("left_out").isNull(), F.col("article")).otherwise(
        F.filter("article", lambda _, i: ~F.array_contains("left_out", i)))
    text = F.when(F.col("marked"), F.array_join(blocks, " ")).otherwise(F.coalesce("kept", F.lit("")))
    return (parsed.select(*page, "page_id", "url", "article", "marked")
            .join(said, page, "left").withColumn("text", text)
            .select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"),
                    F.coalesce("n_outside", F.lit(0)).cast("long").alias("n_outside"),
                    F.coalesce("n_repeated", F.lit(0)).cast("long").alias("n_repeated")))
