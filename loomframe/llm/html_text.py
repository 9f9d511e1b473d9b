"""Main text of web pages by equivalence classes of template tokens.

A page is a sequence of tokens: structural tags and blocks of text, each told apart by the path of elements it stands in.

1. Pages are parsed into token digests, and into the places, lengths and marks of their blocks.
2. Tokens of one host that occur equally often in the same distinct pages (equal occurrence vectors, compared by a hash that
   is summed up as pages are counted) form an equivalence class. Classes of enough tokens and pages are candidates.
3. Each page tells of each class which tokens leave its order there, and whether it nests with the larger classes: all of
   one between two neighbouring tokens of the other. Tokens that fail neither way in nearly all pages are valid, and the
   valid parts of classes are the host's template.
4. The template's tokens cut every page into slots; a slot is named by the template token before it. Its text is what
   varies: text that is a template's token itself goes. What a slot is for, the host's pages say together: by the share of
   its characters that elements mark as an article's, or as a menu's, advert's, form's, comment's and the like. So slots
   decide for pages whose own marks are missing or broken; only where a slot is of both kinds do a page's own marks decide.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from . import common

#: A class is a template's if it has so many tokens, and occurs in so many pages and in this share of the host's.
CLASS_TOKENS, CLASS_PAGES, CLASS_SHARE = 3, 3, 0.5
#: Share of a class's pages in which a token must keep the class's order and nesting.
CLASS_VALID = 0.95
#: Template text goes inside a marked article too, but only in this share of this many distinct pages: articles may share sentences.
ARTICLE_SHARE, ARTICLE_PAGES = 0.9, 10
#: A slot is an article's from this share of its characters on, and none up to the rest; in so many pages.
SLOT_SHARE, SLOT_PAGES = 0.95, 3
#: A block is a menu from this share of linked characters on.
LINKED = 0.9
#: Template tokens up to which all templates are broadcast; beyond it pages and templates are joined by host.
BROADCAST_TOKENS = 200_000

# Element names of HTML, and customary names of page parts.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
NEVER = frozenset("aside audio button canvas dialog footer form head iframe menu nav noscript object script select style svg template textarea title video".split())
ARTICLE = frozenset("article main".split())
PARTS = frozenset("ad ads adsense advert advertisement advertising adverts alert banner breadcrumb breadcrumbs comment comments consent cookie cookies copyright disclaimer disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices notification pager pagination popup promo promoted promotion related replies reply respond search share sharing sidebar signup social sponsor sponsored subscribe subscription toolbar topbar widget".split())
WITHOUT = frozenset("has no with without".split())  # as in "with-sidebar": says what stands elsewhere
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
CLOSED_BY = {"p": frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split()), "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr"]), "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]), "option": frozenset(["option"])}


TEXT, NAME = re.compile(r"[^<]+"), re.compile(r"</?([a-zA-Z][^\s/>]*)")
SPECIAL = re.compile("[>\"']")
RAW = {n: re.compile(rf"</{n}\s*>", re.I) for n in ("script", "style", "textarea", "title", "noscript")}
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


def marked(name: str, attributes: str, in_article: bool) -> tuple[bool, str]:
    """Whether an element is no part of an article, and its class and id for its path."""
    skip = name in NEVER or name == "header" and not in_article
    if not attributes or attributes.isspace():
        return skip, ""
    label = ""
    for key, value in ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'")
        if key in ("class", "id"):
            label += f".{value}"
            if name not in ARTICLE and name not in ("body", "html"):
                words = [w.lower() for w in NAME_PARTS.findall(value)]
                skip = skip or any(w in PARTS and before not in WITHOUT and not (in_article and w == "header") for before, w in zip(["", *words], words))
        elif key == "role":
            skip = skip or value.lower() in ROLES
        elif key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            skip = True
        else:
            skip = skip or "display:none" in value.replace(" ", "").lower()
    return skip, label


def scan(page: str):
    """Texts (text, None, None) and tags (None, name, attributes; closing ones with a slash before the name), in one pass.

    Quotes hide > inside a tag. What starts like a tag and never ends is text; where it would have ended is looked for once.
    """
    at, size, dead = 0, len(page), set()

    def tag_end(i: int) -> int:
        tried = []
        m = SPECIAL.search(page, i)
        while m and m.group() != ">" and m.start() not in dead:
            tried.append(m.start())
            close = page.find(m.group(), m.end())
            m = SPECIAL.search(page, close + 1) if close >= 0 else None
        if m and m.group() == ">":
            return m.end()
        dead.update(tried)
        return 0

    last = page.rfind(">")
    while at < size:
        if page[at] != "<":
            m = TEXT.match(page, at)
            yield m.group(), None, None
            at = m.end()
            continue
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            at = end + 3 if end >= 0 else size
            continue
        name = NAME.match(page, at) if at < last else None
        end = tag_end(name.end()) if name else page.find(">", at) + 1 if at < last and page[at + 1] in "!?/" else 0
        if not end:
            yield "<", None, None
            at += 1
        elif name:
            low = name.group(1).lower()
            closing = page[at + 1] == "/"
            at = end
            if low in RAW and not closing:
                close = RAW[low].search(page, end)
                at = close.end() if close else size
                continue
            yield None, f"/{low}" if closing else low, page[name.end() : end - 1]
        else:
            at = end


def digest(path: int, text: str) -> int:
    return xxh64_intdigest(text, path) - (1 << 63)


#: A block of text: its place among the page's tokens, text, whether marks say that it's no article's or an article's, linked characters.
Block = tuple[int, str, bool, bool, int]


def parse(page: str) -> tuple[list[int], list[Block]]:
    """Digests of a page's tokens in order, and its blocks of text. Open elements end where their parents end."""
    tokens: list[int] = []
    blocks: list[Block] = []
    stack: list[tuple[str, int, bool, bool]] = [("", 0, False, False)]  # name, hash of the path, skip, in article
    open_now: dict[str, int] = {}
    text: list[str] = []
    linked, in_link = 0, 0

    def end_block():
        nonlocal linked
        if text:
            joined = " ".join(html.unescape("".join(text)).split())
            if joined:
                _, path, skip, article = stack[-1]
                blocks.append((len(tokens), joined, skip, article, linked))
                tokens.append(digest(path, joined))
            text.clear()
            linked = 0

    def pop() -> str:
        name = stack.pop()[0]
        open_now[name] -= 1
        return name

    for chars, name, attributes in scan(page):
        if name is None:
            text.append(chars)
            linked += in_link * len(chars)
            continue
        closing, name = name[0] == "/", name.lstrip("/")
        if name in INLINE:
            if name == "a":
                in_link = 0 if closing else 1
            elif name == "br":
                text.append(" ")
            continue
        end_block()
        in_link = 0
        if closing:
            if open_now.get(name):
                while pop() != name:
                    pass
                tokens.append(digest(stack[-1][1], f"/{name}"))
            continue
        while len(stack) > 1 and name in CLOSED_BY.get(stack[-1][0], ()):
            pop()
        _, path, skip, article = stack[-1]
        mine, label = marked(name, attributes, article)
        path = xxh64_intdigest(f"{name}{label}", path)
        tokens.append(path - (1 << 63))
        if name not in VOID and not attributes.endswith("/"):
            stack.append((name, path, skip or mine, article or name in ARTICLE))
            open_now[name] = open_now.get(name, 0) + 1
    end_block()
    return tokens, blocks


def host(url: str = "url"):
    """A url's host in lower case; empty without one."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def lists(col: pa.Array) -> list[np.ndarray]:
    """The lists of a column as arrays; null as empty."""
    return [x.values.to_numpy() if x.is_valid else np.empty(0, np.int64) for x in col]


def classes(pages: DataFrame, tables: common.Tables) -> DataFrame:
    """Rows (host, token, class, rank, share, pages): candidates, their tokens ranked by mean place. pages: host, page, tokens; distinct."""

    def count(batches):
        for b in batches:
            out: list[list] = [[], [], [], []]
            for h, page, tokens in zip(common.column(b, "host").to_numpy().tolist(), common.column(b, "page").to_numpy().tolist(), lists(common.column(b, "tokens"))):
                seen, first, n = np.unique(tokens, return_index=True, return_counts=True)
                out[0].append(np.full(len(seen), h))
                out[1].append(seen)
                out[2].append(np.array([xxh64_intdigest(x.to_bytes(8, "little"), page & ((1 << 64) - 1)) - (1 << 63) for x in n.tolist()], np.int64))
                out[3].append(first)
            cat = [np.concatenate(x) if x else np.empty(0, np.int64) for x in out]
            yield pa.record_batch([pa.array(x, pa.int64()) for x in cat], ["host", "token", "vector", "place"])

    counted = pages.mapInArrow(count, "host bigint, token bigint, vector bigint, place bigint")
    counted = counted.groupBy("host", "token").agg(F.count("*").alias("pages"), F.bit_xor("vector").alias("vector"), F.avg("place").alias("place"))
    sizes = pages.groupBy("host").agg(F.count("*").alias("all_pages"))
    shared = counted.where(F.col("pages") >= CLASS_PAGES).join(sizes, "host").withColumn("share", F.col("pages") / F.col("all_pages")).where(F.col("share") >= CLASS_SHARE)
    shared = tables.write(shared.withColumn("class", F.xxhash64("pages", "vector")))
    enough = shared.groupBy("host", "class").agg(F.count("*").alias("n")).where(F.col("n") >= CLASS_TOKENS)
    return shared.join(enough, ["host", "class"]).select("host", "token", "class", "n", "place", "share", "pages")


def with_templates(pages: DataFrame, template: DataFrame, columns: list[str], tables: common.Tables) -> DataFrame:
    """Pages with their host's template tokens as arrays t_<column>, one order for all; null where the host has none.

    A template has at most 2 / CLASS_SHARE times a mean page's tokens, as each of its tokens is in that share of the pages.
    """
    # nothing is broadcast that hasn't been counted
    known = template.groupBy("host").agg(F.sort_array(F.collect_list(F.struct("place", *columns))).alias("t"))
    known = known.select("host", *[F.col(f"t.{c}").alias(f"t_{c}") for c in columns])
    return pages.join(F.broadcast(known) if template.count() <= BROADCAST_TOKENS else known, "host", "left")


def one_gap(outer: np.ndarray, inner: np.ndarray) -> bool:
    """Whether all places of one lie between two neighbouring places of the other."""
    gap = np.searchsorted(outer, inner)
    return bool((gap == gap[0]).all())


def in_order(places: np.ndarray) -> np.ndarray:
    """Which of some places belong to a longest increasing sequence."""
    out = np.zeros(len(places), bool)
    if (np.diff(places) > 0).all():
        return ~out
    ends, at, before = [], [], []  # by length: least end, its position; by position: the one before
    for i, x in enumerate(places.tolist()):
        k = bisect_left(ends, x)
        before.append(at[k - 1] if k else -1)
        ends[k : k + 1], at[k : k + 1] = [x], [i]
    i = at[-1]
    while i >= 0:
        out[i] = True
        i = before[i]
    return out


def valid(pages: DataFrame, candidates: DataFrame, tables: common.Tables) -> DataFrame:
    """The candidates that keep their class's order, in a class that nests with the host's larger ones, in nearly all of its pages."""

    def judge(batches):
        for b in batches:
            hosts, failed = [], []
            for h, tokens, known, cls, n in zip(common.column(b, "host").to_numpy().tolist(), *(lists(common.column(b, c)) for c in ("tokens", "t_token", "t_class", "t_n"))):
                seen, first = np.unique(tokens, return_index=True)
                at = np.searchsorted(seen, known)
                has = (at < len(seen)) & (seen[np.minimum(at, len(seen) - 1)] == known) if len(seen) else np.zeros(len(known), bool)
                kept: list[np.ndarray] = []
                for _, c in sorted({(-int(x), int(y)) for x, y in zip(n[has], cls[has])}):
                    own = np.flatnonzero(has & (cls == c))  # in the order of their mean places
                    ok = in_order(first[at[own]])
                    mine = first[at[own[ok]]]
                    if all(one_gap(k, mine) or one_gap(mine, k) for k in kept):
                        kept.append(mine)
                    else:
                        ok[:] = False
                    failed.append(known[own[~ok]])
                    hosts.append(np.full(len(failed[-1]), h))
            cat = [np.concatenate(x) if x else np.empty(0, np.int64) for x in (hosts, failed)]
            yield pa.record_batch([pa.array(x, pa.int64()) for x in cat], ["host", "token"])

    judged = with_templates(pages, candidates, ["token", "class", "n"], tables).where("t_token is not null").mapInArrow(judge, "host bigint, token bigint")
    bad = judged.groupBy("host", "token").agg(F.count("*").alias("bad"))
    return candidates.join(bad, ["host", "token"], "left").where(F.coalesce("bad", F.lit(0)) <= (1 - CLASS_VALID) * F.col("pages")).drop("bad")


def strength(share: float, pages: float) -> int:
    """Where the text of a template's token goes, by the share and number of its pages: 1 outside articles, 2 inside them too."""
    return 2 if share >= ARTICLE_SHARE and pages >= ARTICLE_PAGES else 1


def cut(tokens: list[int], blocks: list, template: dict[int, int]) -> list[tuple[int, int]]:
    """For each block (its place first) its slot, the template token before it or 0, and the strength of its text as template text."""
    out, last, i = [], 0, 0
    for b in blocks:
        for t in tokens[i : b[0]]:
            if t in template:
                last = t
        i = b[0]
        out.append((last, template.get(tokens[i], 0)))
    return out


def own(n: int, skip: bool, article: bool, linked: int, marks: bool) -> bool:
    """What a page's own marks say of a block; marks: whether the page has a marked article."""
    return not skip and (article if marks else linked < LINKED * n)


def slot_kinds(pages: DataFrame) -> DataFrame:
    """Rows (host, slot, article): slots of which the host's pages together say that they are an article's, or none. pages: with_templates()."""

    def run(batches):
        for b in batches:
            sums: dict[tuple[int, int], list[int]] = {}
            columns = [common.column(b, "blocks").flatten().field(c).to_pylist() for c in ("at", "n", "skip", "article", "linked")]
            flat, at = list(zip(*columns)), 0
            for h, tokens, known, share, seen, size in zip(common.column(b, "host").to_numpy().tolist(), *(lists(common.column(b, c)) for c in ("tokens", "t_token", "t_share", "t_pages")), common.column(b, "blocks").value_lengths().to_pylist()):
                blocks = flat[at : at + (size or 0)]
                at += size or 0
                template = {t: strength(x, n) for t, x, n in zip(known.tolist(), share.tolist(), seen.tolist())}
                marks = any(x[3] and not x[2] for x in blocks)
                for (slot, of), (_, n, *rest) in zip(cut(tokens.tolist(), blocks, template), blocks):
                    if slot:
                        got = sums.setdefault((h, slot), [0, 0, 0])
                        got[0] += 1
                        got[1] += n
                        got[2] += n * (not of and own(n, *rest, marks))
            rows = [(*k, *v) for k, v in sums.items()]
            yield pa.record_batch([pa.array([r[i] for r in rows], pa.int64()) for i in range(5)], ["host", "slot", "blocks", "n", "own"])

    found = pages.where("t_token is not null").mapInArrow(run, "host bigint, slot bigint, blocks bigint, n bigint, own bigint")
    found = found.groupBy("host", "slot").agg(F.sum("blocks").alias("blocks"), (F.sum("own") / F.sum("n")).alias("share")).where(F.col("blocks") >= SLOT_PAGES)
    return found.where((F.col("share") >= SLOT_SHARE) | (F.col("share") <= 1 - SLOT_SHARE)).select("host", "slot", (F.col("share") >= SLOT_SHARE).alias("article"))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", templates: bool = True) -> DataFrame:
    """Rows (id, url, text), one per input row: the article's blocks in page order, joined by one newline.

    A null or empty page has an empty text. A host with few distinct pages has no template; its pages keep what their
    elements say. Pages without a url are a host of their own. Broken markup never fails: an element that is not closed ends
    with its parent. Repeated rows stay; an empty table gives an empty result; other columns are not read. templates=False
    leaves all pages to their own marks.
    """
    spark = pages.sparkSession
    common.small_batches(spark)
    tables = common.Tables(spark)
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html")).withColumn("host", F.xxhash64(host("url")))

    def read(batches):
        kind = pa.struct([("at", pa.int32()), ("n", pa.int32()), ("skip", pa.bool_()), ("article", pa.bool_()), ("linked", pa.int32())])
        for b in batches:
            tokens, blocks, page = [], [], []
            for t in common.texts(b, "html"):
                got = parse(bytes(t).decode())
                tokens.append(got[0])
                blocks.append([(at, len(text), *rest) for at, text, *rest in got[1]])
                page.append(xxh64_intdigest(t) - (1 << 63))
            flat = [x for y in blocks for x in y]
            each = pa.StructArray.from_arrays([pa.array([x[i] for x in flat], f.type) for i, f in enumerate(kind)], fields=list(kind))
            ends = pa.array(np.concatenate([[0], np.cumsum([len(x) for x in blocks])]), pa.int32())
            yield pa.record_batch([common.column(b, "host"), pa.array(page, pa.int64()), pa.array(tokens, pa.list_(pa.int64())), pa.ListArray.from_arrays(ends, each)], ["host", "page", "tokens", "blocks"])

    parsed = tables.write(rows.select("host", "html").mapInArrow(read, "host bigint, page bigint, tokens array<bigint>, blocks array<struct<at:int,n:int,skip:boolean,article:boolean,linked:int>>"))
    distinct = tables.write(parsed.select("host", "page", "tokens").dropDuplicates(["host", "page"]))
    candidates = tables.write(classes(distinct, tables))
    template = tables.write(valid(distinct, candidates, tables).where(F.lit(templates)))
    tables.drop(distinct)
    kinds = tables.write(slot_kinds(with_templates(parsed, template, ["token", "share", "pages"], tables)))
    tables.drop(parsed)
    verdicts = kinds.groupBy("host").agg(F.collect_list("slot").alias("slots"), F.collect_list("article").alias("kinds"))
    joined = with_templates(rows, template, ["token", "share", "pages"], tables)
    joined = joined.join(F.broadcast(verdicts) if kinds.count() <= BROADCAST_TOKENS else verdicts, "host", "left")

    def write(batches):
        held: tuple = (None, {}, {})
        for b in batches:
            out = []
            for h, t, *known in zip(common.column(b, "host").to_numpy().tolist(), common.texts(b, "html"), *(common.column(b, c) for c in ("t_token", "t_share", "t_pages", "slots", "kinds"))):
                if held[0] != h:  # a host's lists are read once where its pages follow each other
                    token, share, seen, slots, article = ([] if x.as_py() is None else x.as_py() for x in known)
                    held = (h, {x: strength(y, z) for x, y, z in zip(token, share, seen)}, dict(zip(slots, article)))
                tokens, blocks = parse(bytes(t).decode())
                marks = any(x[3] and not x[2] for x in blocks)
                kept = []
                for (slot, of), (_, text, skip, article, linked) in zip(cut(tokens, blocks, held[1]), blocks):
                    if skip:
                        continue
                    if marks and article:
                        good = of < 2
                    else:
                        good = not of and held[2].get(slot, own(len(text), skip, article, linked, marks))
                    if good:
                        kept.append(text)
                out.append("\n".join(kept))
            yield pa.record_batch([common.column(b, "id"), common.column(b, "url"), pa.array(out, pa.string())], ["id", "url", "text"])

    kind = pages.schema[id_col].dataType.simpleString()
    result = joined.select("id", "url", "html", "host", "t_token", "t_share", "t_pages", "slots", "kinds").mapInArrow(write, f"id {kind}, url string, text string")
    return result.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text")
