"""Main text of pages by template deduction (operator 8).

A page is a sequence of tokens: the path of elements that a text lies in, and
path and text together, whatever the elements are called. Per host, tokens that
occur equally often on each page share an occurrence vector; such tokens form an
equivalence class. Classes of enough tokens, on enough pages of unlike html, are
valid: their texts repeat. A path whose texts mostly repeat belongs to the
template; the other paths are the slots. In a slot a repeated text is template
only if most pages that have the slot have the text. The text of a page is that
of its slots.

Names of elements check the slots: boilerplate ones are left out unless most of
the host's changing text lies in them; slots in an article or main element that
holds most of the page's text are taken alone, with the lines that repeat there.
A class that merely contains a boilerplate word only raises what is asked of a
slot. Where a host has too few pages for classes, names alone decide.

Vectors are compared by sums of a hash of page and count over all pages, which
Spark combines before the shuffle; no page list of a host is ever gathered.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.staging import Staging

# A class needs so many tokens and pages; equal pages count as one.
LEAST_PAGES = 3
LEAST_TOKENS = 3
# Of a slot's characters so many change and so many are links; the second
# values hold where a class contains a boilerplate word.
LEAST_CHANGING = (0.2, 0.5)
MOST_LINKS = (0.5, 0.25)
# Signs in paths: between elements, and after a boilerplate element, one whose
# class contains such a word, an article or main element, and a heading.
SEP, MARKED, DOUBTED, MAIN_SIGN, HEADING = "\x1f", "\x1e", "\x1d", "\x1c", "\x1b"
_SIGNS = re.compile("[\x1b-\x1f]")
_DIGITS = re.compile(r"\d+")

# Element names by role.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
RAW = frozenset("script style noscript template textarea title svg iframe object".split())
SKIPPED = RAW | frozenset("head button select option".split())
ASIDE = frozenset("nav header footer aside form dialog menu".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
MAIN = ("article", "main")
INLINE = frozenset(
    "a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
# Ends of these are implied by the next sibling or the end of the parent.
CLOSED_BY = {
    "p": frozenset(
        "p div ul ol dl table h1 h2 h3 h4 h5 h6 section article aside header footer nav main form "
        "blockquote pre hr figure".split()
    ),
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr"]),
    "td": frozenset(["td", "th", "tr"]),
    "th": frozenset(["td", "th", "tr"]),
    "option": frozenset(["option"]),
}
_WORDS = (
    r"(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notice|"
    r"sidebar|side-bar|widget|nav|navbar|navigation|menu|breadcrumbs?|footer|header|masthead|"
    r"comments?|comment-list|replies|respond|disqus|share|sharing|social|related|newsletter|"
    r"subscribe|popup|modal|pagination|pager|toolbar)"
)
# A whole class or id, and a part of one.
_BOILERPLATE = re.compile(rf"(?:^|\s){_WORDS}(?:$|\s)", re.I)
_DOUBTFUL = re.compile(rf"(?:^|[\s_-]){_WORDS}(?:$|[\s_-])", re.I)
_BOILERPLATE_ROLES = frozenset(
    "navigation banner contentinfo complementary search form menu dialog alert".split()
)
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|[^<]+|<",
    re.S,
)
_ATTRIBUTE = re.compile(
    r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.S
)
_SPACE = re.compile(r"\s+")


class Node:
    """An open element: its name, path, the paths of the boilerplate elements it
    lies in, and whether it is never shown, or in an article, main or link."""

    __slots__ = ("name", "path", "skipped", "marks", "main", "article", "link")

    def __init__(self, name: str, parent: Node | None, attributes: str):
        self.name = name
        found = {}
        if attributes and not attributes.isspace():
            for m in _ATTRIBUTE.finditer(attributes):
                found.setdefault(m[1].lower(), html.unescape(m[2] or m[3] or m[4] or ""))
        words = found.get("class", "") + " " + found.get("id", "")
        role = found.get("role", "").lower()
        skipped = name in SKIPPED or "hidden" in found or found.get("aria-hidden") == "true"
        self.skipped = skipped or bool(parent and parent.skipped)
        worded = name not in ("html", "body", *MAIN) and name not in HEADINGS
        whole = worded and bool(_BOILERPLATE.search(words))
        inside = bool(parent and (parent.main or parent.article))
        marked = (
            whole or role in _BOILERPLATE_ROLES or name in ASIDE and not (name == "header" and inside)
        )
        self.main = name == "main" or role == "main" or bool(parent and parent.main)
        self.article = name == "article" or role == "article" or bool(parent and parent.article)
        self.link = name == "a" or bool(parent and parent.link)
        label = name
        if "class" in found:
            # Numbers in classes tell pages apart, not slots.
            label += "." + ".".join(sorted(_DIGITS.sub("0", found["class"]).split()))
        label = _SIGNS.sub("", label)
        if marked:
            label += MARKED
        elif worded and _DOUBTFUL.search(words):
            label += DOUBTED
        if name in MAIN or role in MAIN:
            label += MAIN_SIGN
        if name in HEADINGS:
            label += HEADING
        self.path = f"{parent.path}{SEP}{label}" if parent else label
        self.marks = parent.marks if parent else ()
        if marked:
            self.marks += (self.path,)


def blocks(page: str) -> Iterator[tuple[Node, str]]:
    """(innermost block element, text) of each run of text, in page order, with
    character references decoded and white space made single blanks."""
    root = Node("", None, "")
    stack, held, owner = [root], [], root
    at = 0
    while at < len(page):
        m = _TOKEN.match(page, at)
        at = m.end()
        name = m[2]
        if name is None:
            token = m[0]
            if token[0] != "<" or token == "<":
                if not held:
                    owner = stack[-1]
                held.append(html.unescape(token))
            elif token.startswith("<![CDATA["):
                held.append(token[9:].removesuffix("]]>"))
            continue
        name = name.lower()
        if name not in INLINE:
            text = _SPACE.sub(" ", "".join(held)).strip()
            if text:
                yield owner, text
            held = []
        if m[1]:
            places = [i for i in range(len(stack) - 1, 0, -1) if stack[i].name == name]
            if places and (name not in INLINE or _inside(stack, places[0])):
                del stack[places[0] :]
            continue
        while len(stack) > 1 and name in CLOSED_BY.get(_block(stack).name, ()):
            del stack[_block_place(stack) :]
        if name in VOID:
            continue
        attributes = m[3]
        node = Node(name, stack[-1], attributes)
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else len(page)
        elif not attributes.endswith("/"):
            stack.append(node)
    text = _SPACE.sub(" ", "".join(held)).strip()
    if text:
        yield owner, text


def _inside(stack: list[Node], place: int) -> bool:
    """No block element is open within the inline element at ``place``."""
    return all(n.name in INLINE for n in stack[place:])


def _block_place(stack: list[Node]) -> int:
    return next((i for i in range(len(stack) - 1, 0, -1) if stack[i].name not in INLINE), 1)


def _block(stack: list[Node]) -> Node:
    return stack[_block_place(stack)]


def host_of(url):
    """Lower-case host of a URL column; empty if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))


TOKEN = (
    "host STRING, token BIGINT, path STRING, is_text BOOLEAN, n DOUBLE, low BIGINT, high BIGINT, "
    "chars BIGINT, links BIGINT"
)


def _hash(path: str, text: str | None) -> int:
    return _signed(xxhash.xxh64_intdigest(path if text is None else f"{path}\x00{text}"))


def _tokens(pages: DataFrame) -> DataFrame:
    """Per task, host and token: pages (each of ``copies`` equal ones counts in
    part), sums of both halves of the occurrence hashes, text and link
    characters. A token is a path of elements, or a path with one text."""

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            sums: dict[tuple, list] = {}
            columns = (part[c] for c in ("host", "key", "copies", "html"))
            for host, key, copies, page in zip(*columns, strict=True):
                seen, links = Counter(), Counter()
                for node, text in blocks(page):
                    if node.skipped:
                        continue
                    seen[node.path, None] += 1
                    seen[node.path, text] += 1
                    links[node.path, text] += len(text) * node.link
                for token, n in seen.items():
                    mark = xxhash.xxh64_intdigest(f"{key}\x00{n}")
                    row = sums.setdefault((host, *token), [0.0, 0, 0, 0, 0])
                    row[0] += 1 / copies
                    row[1] += mark & 0xFFFFFFFF
                    row[2] += mark >> 32
                    row[3] += n * len(token[1] or "")
                    row[4] += links[token]
            rows = [
                (host, _hash(path, text), path, text is not None, *row)
                for (host, path, text), row in sums.items()
            ]
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in TOKEN.split(", ")])

    return pages.select("host", "key", "copies", "html").mapInPandas(count, TOKEN)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _marks(paths: DataFrame) -> DataFrame:
    """(host, mark, changing): per path, all of it (null) and each boilerplate
    element it lies in."""

    def split(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for host, path, changing in part.itertuples(index=False):
                rows.append((host, None, changing))
                labels = path.split(SEP)
                rows += [
                    (host, SEP.join(labels[: i + 1]), changing)
                    for i, label in enumerate(labels)
                    if MARKED in label
                ]
            yield pd.DataFrame(rows, columns=["host", "mark", "changing"])

    return paths.select("host", "path", "changing").mapInPandas(
        split, "host STRING, mark STRING, changing BIGINT"
    )


def templates(pages: DataFrame, staging: Staging) -> DataFrame:
    """(host, known, fixed, closed, cleared) from (host, key, copies, html):
    whether the host has enough pages for classes; tokens of texts that most
    pages with their slot have; paths that are no slots; boilerplate elements
    that hold most of the changing text. All three sets are bounded by the
    host's distinct paths and template, not by its pages."""
    tokens = staging.save(
        _tokens(pages)
        .groupBy("host", "token", "path", "is_text")
        .agg(*[F.sum(c).alias(c) for c in ("n", "low", "high", "chars", "links")]),
        "tokens",
    )
    # Sums of parts of one may miss it by a little.
    enough = F.col("n") > LEAST_PAGES - 0.5
    classes = (
        tokens.where(enough)
        .groupBy("host", "low", "high")
        .agg(F.count(F.lit(1)).alias("tokens"))
        .where(F.col("tokens") >= LEAST_TOKENS)
        .drop("tokens")
    )
    member = staging.save(
        tokens.where(enough & F.col("is_text"))
        .join(classes, ["host", "low", "high"])
        .select("host", "token", "path", "n", "chars"),
        "members",
    )
    zero, none = F.lit(0).cast("bigint"), F.lit(0.0)
    text = lambda c, other: F.when(F.col("is_text"), F.col(c)).otherwise(other)
    on = F.when(F.col("is_text"), none).otherwise(F.col("n"))
    paths = tokens.select(
        "host", "path", text("chars", zero).alias("chars"), text("links", zero).alias("links"),
        zero.alias("repeated"), on.alias("on"),
    ).unionAll(
        member.select("host", "path", zero, zero, "chars", none)
    )
    paths = paths.groupBy("host", "path").agg(
        *[F.sum(c).alias(c) for c in ("chars", "links", "repeated")], F.sum("on").alias("on")
    )
    doubted = F.contains("path", F.lit(DOUBTED))
    least = F.when(doubted, LEAST_CHANGING[1]).otherwise(LEAST_CHANGING[0])
    most = F.when(doubted, MOST_LINKS[1]).otherwise(MOST_LINKS[0])
    inside = F.contains("path", F.lit(MAIN_SIGN))
    changing = F.col("chars") - F.col("repeated")
    still = (changing < least * F.col("chars")) & ~(inside & F.contains("path", F.lit(HEADING)))
    listed = ~inside & (F.col("links") > most * F.col("chars"))
    paths = staging.save(
        paths.select(
            "host", "path", "on", changing.alias("changing"),
            ((F.col("on") > LEAST_PAGES - 0.5) & (still | listed)).alias("closed"),
        ),
        "paths",
    )
    marks = _marks(paths.where("NOT closed")).groupBy("host", "mark").agg(
        F.sum("changing").alias("changing")
    )
    whole = marks.where("mark IS NULL").select(F.col("host").alias("of"), F.col("changing").alias("all"))
    cleared = marks.where("mark IS NOT NULL").join(whole, F.col("host") == F.col("of"))
    cleared = cleared.where(F.col("changing") * 2 > F.col("all")).select("host", "mark")
    fixed = (
        member.where(~F.contains("path", F.lit(MAIN_SIGN)))
        .join(paths.where("NOT closed").select("host", "path", "on"), ["host", "path"])
        .where(F.col("n") * 2 > F.col("on"))
        .select("host", "token")
    )
    no = lambda kind: F.lit(None).cast(kind)
    size = pages.groupBy("host").agg(F.sum(1 / F.col("copies")).alias("pages"))
    told = (
        size.select(
            "host", (F.col("pages") > LEAST_PAGES - 0.5).alias("known"), no("bigint").alias("token"),
            no("string").alias("path"), no("string").alias("mark"),
        )
        .unionAll(fixed.select("host", no("boolean"), "token", no("string"), no("string")))
        .unionAll(
            paths.where("closed").select("host", no("boolean"), no("bigint"), "path", no("string"))
        )
        .unionAll(cleared.select("host", no("boolean"), no("bigint"), no("string"), "mark"))
    )
    return told.groupBy("host").agg(
        F.max("known").alias("known"),
        F.collect_set("token").alias("fixed"),
        F.collect_set("path").alias("closed"),
        F.collect_set("mark").alias("cleared"),
    )


def main_text(
    page: str | None, fixed=frozenset(), closed=frozenset(), cleared=None, known=False
) -> str:
    """The blocks of the page's content slots, joined by blanks."""
    if not page:
        return ""
    every = [(n, t) for n, t in blocks(page) if not n.skipped]
    if cleared is None:  # of this page alone
        held = Counter()
        for n, t in every:
            held.update(dict.fromkeys(n.marks, len(t)))
        cleared = {m for m, chars in held.items() if chars * 2 > sum(len(t) for _, t in every)}
    every = [(n, t) for n, t in every if all(m in cleared for m in n.marks)]
    kept = [
        (n, t)
        for n, t in every
        if n.path not in closed and (not fixed or _hash(n.path, t) not in fixed)
    ]
    # A page that has nothing of its own keeps what the names of elements leave.
    kept = kept or every
    article = [t for n, t in kept if n.article]
    main = [t for n, t in kept if n.main]
    beside = sum(len(t) for n, t in kept if n.main and not n.article)
    inner = article if _chars(article) >= beside else main
    if inner and (not known or _chars(inner) * 2 >= _chars(t for _, t in kept)):
        return " ".join(inner)
    return " ".join(t for _, t in kept)


def _chars(texts) -> int:
    return sum(map(len, texts))


def extract_text(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    staging: Staging | None = None,
) -> DataFrame:
    """(id, url, text) of every row. Null and empty pages have an empty text.
    Pages without a host are one host of their own, the empty one. Repeated rows
    are pages of their own, but equal html of a host counts once in its template;
    null ids are kept."""
    staging = staging or Staging(pages.sparkSession)
    rows = pages.select(
        F.col(id_col).alias("id"),
        F.col(url_col).alias("url"),
        host_of(F.col(url_col)).alias("host"),
        F.coalesce(F.col(html_col), F.lit("")).alias("html"),
    )
    keyed = rows.withColumn("key", F.xxhash64("html"))
    copies = staging.save(
        keyed.groupBy(F.col("host").alias("of"), F.col("key").alias("body"))
        .agg(F.count(F.lit(1)).alias("copies"))
        .where("copies > 1"),
        "copies",
    )
    keyed = keyed.join(
        copies, (F.col("host") == F.col("of")) & (F.col("key") == F.col("body")), "left"
    ).withColumn("copies", F.coalesce("copies", F.lit(1)))
    known = staging.save(templates(keyed, staging), "templates").withColumnRenamed("host", "of")
    both = rows.join(known, F.col("host") == F.col("of"), "left").drop("of", "host")

    def extract(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            columns = (part[c] for c in ("html", "fixed", "closed", "cleared", "known"))
            texts = [
                main_text(page, _set(fixed), _set(closed), _set(cleared), bool(known))
                for page, fixed, closed, cleared, known in zip(*columns, strict=True)
            ]
            yield part[["id", "url"]].assign(text=texts)

    kind = pages.select(id_col).schema[0].dataType.simpleString()
    return both.mapInPandas(extract, f"id {kind}, url STRING, text STRING")


def _set(values) -> frozenset:
    return frozenset() if values is None else frozenset(values)
