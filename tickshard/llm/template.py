"""Main text of web pages by equivalence-class template deduction.

1. A page is a sequence of tokens: tags with the path of block tags they stand in, and
   whole text strings with theirs.
2. The occurrence vector of a token says how often it is on each of the different pages of
   its host; copies of a page are one page. It is kept as a digest. Tokens of one vector, on
   at least two pages and half of the host's, are an equivalence class.
3. A class is valid if its tokens come in one order on every page, and nested: of two
   classes one lies between two neighbouring tokens of the other on every page. Of classes
   that cross, the one on fewer pages is not valid. The valid classes are the template.
4. Between two tags of the template is a slot. Over all pages of a host a slot whose text is
   mostly in links is a menu.
5. A page is read again with its host's template. Its article is what stands between the
   template's article tags, whatever it holds; on hosts without such tags it is what is in
   slots, but for menus and for slots whose template tags are named as furniture. Strings of
   the template and menus are never looked for inside the article.
One page says nothing about a template: on hosts with a single different page the names of
all tags decide, and so does the presence of an article tag.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickshard.llm.scratch import Scratch, freeing, result

#: The share of a host's different pages that a token of the template is on; two at least.
SUPPORT = 0.5
#: A slot with more than this share of its text in links is a menu.
LINKED = 0.5
#: Pages that a task remembers so as not to hand on copies.
SEEN = 100_000
#: Parts that the tokens of a host are dealt to where they meet its classes.
DEALT = 32

# Tags of HTML and what they mean for text.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark "
    "q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset(
    "area base br col embed frame hr img input link meta param source track wbr".split()
)
SILENT = (
    "script|style|noscript|template|iframe|svg|math|canvas|object|video|audio|title|textarea|"
    "select|button|head"
)
RAW = "script|style|title|textarea|noscript|iframe"
DROPPED = frozenset([*SILENT.split("|"), *"nav footer aside form fieldset dialog menu".split()])
_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog".split())
_BAD = re.compile(
    r"(?:^|[\s_-])(nav|navbar|navigation|menu|breadcrumbs?|sidebar|side|footer|masthead|"
    r"site-?header|page-?header|ads?|advert|adverts|advertisement|advertising|sponsor|sponsored|"
    r"promo|banner|cookies?|consent|notice|popup|modal|newsletter|subscribe|signup|share|sharing|"
    r"social|comments?|commentlist|disqus|replies|respond|related|recommended|widget|toolbar|"
    r"pagination|pager|skip|login)(?:$|[\s_-])",
    re.I,
)
_CLOSED_BY = {
    "p": frozenset("p".split()),
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]),
    "th": frozenset(["td", "th"]),
    "option": frozenset(["option"]),
}
_SCOPES = frozenset("ul ol dl table article section main body div html".split())

_PIECE = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({RAW})\b[^>]*>.*?(?:</\1\s*>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)


class Template:
    """What the pages of a host have in common: digests of tokens."""

    def __init__(self, tags=(), strings=(), menus=()):
        self.tags, self.strings, self.menus = frozenset(tags), frozenset(strings), frozenset(menus)


class Node:
    """An open block tag."""

    __slots__ = ("dropped", "main", "name", "path")

    def __init__(self, name: str, path: str, dropped: bool, main: bool):
        self.name, self.path, self.dropped, self.main = name, path, dropped, main


def _marks(text: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(text)}


def _furniture(names: str, whole: bool) -> bool:
    """Whether a class or id names furniture; with *whole* each of its words does."""
    words = names.split()
    return bool(words) and (all if whole else any)(_BAD.search(w) for w in words)


def _open(parent: Node, name: str, attributes: str, template: Template | None) -> Node:
    marks = _marks(attributes) if "=" in attributes else {}
    label = marks.get("class", "")
    role = marks.get("role", "").lower()
    path = f"{parent.path}/{name}" + (f".{label}" if label else "")
    own = name in ("article", "main") or role in ("main", "article")
    own = own or marks.get("itemprop", "").lower() == "articlebody"
    if own and template is not None and not parent.main:
        own = not template.tags or digest("open", path, "") in template.tags
    bad = name in DROPPED or role in _ROLES or name == "header" and not parent.main
    if not bad and name not in ("html", "body", "main", "h1", "h2", "h3", "p"):
        bad = any(_furniture(marks.get(k, ""), parent.main) for k in ("class", "id"))
        # names count on tags of the template; on all tags only where there is none
        if bad and template is not None and template.tags:
            bad = digest("open", path, "") in template.tags
    if name == "article" and parent.main and _furniture(parent.path.rpartition("/")[2], False):
        bad = True
    return Node(name, path, parent.dropped or bad, parent.main or own)


def pieces(page: str, template: Template | None = None) -> Iterator[tuple[str, Node, str]]:
    """(kind, block, text) of a page in order; kinds: open, close, text, link, unlink."""
    root = Node("", "", False, False)
    stack, at = [root], 0
    for m in _PIECE.finditer(page):
        if m.start() > at:
            yield "text", stack[-1], page[at : m.start()]
        at = m.end()
        shut, name, attributes = (m[2], m[3], m[4]) if m[3] else (m[5], m[6], m[7])
        if not name:
            if m[0].startswith("<![CDATA["):
                yield "text", stack[-1], html.escape(m[0][9:-3])
            continue
        name = name.lower()
        if name in INLINE:
            if name == "a":
                yield "unlink" if shut else "link", stack[-1], ""
            elif name == "br":
                yield "text", stack[-1], " "
            continue
        if shut:
            depth = next((d for d in range(len(stack) - 1, 0, -1) if stack[d].name == name), 0)
            if depth:
                yield "close", stack[depth], name
                del stack[depth:]
            continue
        if name == "body" and stack[-1].name == "head":
            stack.pop()
        closed = _CLOSED_BY.get(name) or (_CLOSED_BY["p"] if name not in VOID else ())
        for d in range(len(stack) - 1, 0, -1):
            if stack[d].name in closed:
                del stack[d:]
                break
            if stack[d].name in _SCOPES:
                break
        node = _open(stack[-1], name, attributes or "", template)
        yield "open", node, name
        if name not in VOID and not (attributes or "").endswith("/"):
            stack.append(node)
    if at < len(page):
        yield "text", stack[-1], page[at:]


def cleaned(text: str) -> str:
    """Character references decoded, white space as one space, trimmed."""
    return " ".join(html.unescape(text).split())


def digest(*parts: str) -> int:
    raw = hashlib.blake2b("\0".join(parts).encode("utf-8", "surrogatepass"), digest_size=8)
    return int.from_bytes(raw.digest(), "little", signed=True)


def page_tokens(page: str) -> dict[tuple[str, str, str], list[int]]:
    """Tokens of a page: how often and where first; the length of a text, and of its links."""
    found: dict[tuple[str, str, str], list[int]] = {}
    in_link = False
    for place, (kind, node, text) in enumerate(pieces(page)):
        if kind in ("link", "unlink"):
            in_link = kind == "link"
            continue
        text = cleaned(text) if kind == "text" else ""
        if kind == "text" and not text:
            continue
        own = found.setdefault((kind, node.path, text), [0, place, 0, 0])
        own[0] += 1
        own[2] += len(text)
        own[3] += len(text) if in_link else 0
    return found


def host_of(url: str | None) -> str:
    """The host in a URL, in lower case; an URL without one is a host of its own kind."""
    m = re.match(r"(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", url or "")
    return m[1].lower() if m else ""


_TOKEN = "host string, page bigint, token bigint, text boolean, times bigint, place bigint, size bigint, linked bigint"


def _page_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The tokens of each different page; token 0 stands for the page."""
    seen: set[tuple[str, int]] = set()
    for batch in batches:
        rows: list[tuple] = []
        for url, page in zip(batch.column("url").to_pylist(), batch.column("html").to_pylist()):
            host, page = host_of(url), page or ""
            number = digest(page)
            if (host, number) in seen:
                continue
            if len(seen) > SEEN:
                seen.clear()
            seen.add((host, number))
            rows.append((host, number, 0, False, 1, 0, 0, 0))
            for key, (times, place, size, linked) in page_tokens(page).items():
                rows.append((host, number, digest(*key), key[0] == "text", times, place, size, linked))
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), *[pa.int64()] * 4]
        columns = list(zip(*rows)) if rows else [()] * len(kinds)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds)],
            names=["host", "page", "token", "text", "times", "place", "size", "linked"],
        )


def token_rows(pages: DataFrame) -> DataFrame:
    """The tokens of the different pages of each host, each once."""
    rows = pages.select("url", "html").mapInArrow(freeing(_page_rows), _TOKEN)
    names = ["text", "times", "place", "size", "linked"]
    return rows.groupBy("host", "page", "token").agg(*[F.any_value(n).alias(n) for n in names])


def classes_of(rows: DataFrame) -> DataFrame:
    """(host, token, text, cls, pages, once, step): the tokens of equivalence classes.

    ``step`` orders the tokens of a class by the mean of their places; ``once`` says that they
    are on a page once. Digests of vectors are sums and exclusive ors over different pages.
    """
    counted = F.xxhash64("page", "times")
    vectors = rows.groupBy("host", "token").agg(
        F.count("*").alias("pages"),
        F.sum("times").alias("times"),
        F.bit_xor(counted).alias("vector"),
        F.sum(F.pmod(F.xxhash64(counted), F.lit(1 << 31))).alias("check"),
        F.sum("place").alias("place"),
        F.any_value("text").alias("text"),
    )
    totals = vectors.where("token = 0").select("host", F.col("pages").alias("total"))
    often = (F.col("pages") >= 2) & (F.col("pages") >= F.col("total") * SUPPORT)
    common = vectors.where("token <> 0 AND pages > 1").join(totals, "host").where(often)
    name = F.xxhash64("pages", "times", "vector", "check")
    order = Window.partitionBy("host", "cls").orderBy("place", "token")
    return common.withColumn("cls", name).select(
        "host",
        "token",
        "text",
        "cls",
        "pages",
        (F.col("times") == F.col("pages")).alias("once"),
        F.row_number().over(order).alias("step"),
    )


def _met(rows: DataFrame, found: DataFrame, kind: str) -> DataFrame:
    """*rows* with the classes of their tokens. A frequent token of a large host is dealt to
    several tasks by page, and its class goes to each of them."""
    part = F.pmod(F.xxhash64("page"), F.lit(DEALT)).alias("part")
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(DEALT - 1).cast("bigint"))).alias("part")
    named = found.drop("text").select("*", every)
    return rows.select("*", part).join(named, ["host", "token", "part"], kind)


def _faults(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Classes that are out of order on a page, and those that cross one on more pages."""
    for batch in batches:
        bad: set[tuple[str, int]] = set()
        for host, members in zip(batch.column("host").to_pylist(), batch.column("members").to_pylist()):
            own: dict[int, list[dict]] = {}
            for m in sorted(members, key=lambda m: m["place"]):
                own.setdefault(m["cls"], []).append(m)
            for cls, tokens in own.items():
                if any(a["step"] > b["step"] for a, b in zip(tokens, tokens[1:])):
                    bad.add((host, cls))
            ordered = sorted(own, key=lambda c: (-own[c][0]["pages"], c))
            within = lambda a, b: any(b[0]["place"] < m["place"] < b[-1]["place"] for m in a)
            for n, less in enumerate(ordered):
                for more in ordered[:n]:
                    if (host, more) not in bad and within(own[less], own[more]) and within(own[more], own[less]):
                        bad.add((host, less))
                        break
        hosts, names = zip(*bad) if bad else ((), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(hosts, pa.string()), pa.array(names, pa.int64())], names=["host", "cls"]
        )


def templates(pages: DataFrame, scratch: Scratch) -> DataFrame:
    """(host, tags, strings, menus): the template of every host that has one.

    Its tokens are each on half of the host's pages, so they are at most about twice as many
    as a page has.
    """
    rows = scratch.store(token_rows(pages))
    found = scratch.store(classes_of(rows))
    once = found.where("once AND NOT text")
    members = F.collect_list(F.struct("place", "step", "cls", "pages")).alias("members")
    by_page = _met(rows.where("NOT text"), once, "inner").groupBy("host", "page").agg(members)
    faults = by_page.mapInArrow(_faults, "host string, cls bigint").distinct()
    valid = scratch.store(found.join(faults, ["host", "cls"], "left_anti"))
    tags = valid.where("once AND NOT text").withColumn("tag", F.col("token"))
    # a text is in the slot after the last tag of the template before it
    placed = _met(rows.where("token <> 0"), tags.select("host", "token", "tag"), "left")
    before = Window.partitionBy("host", "page").orderBy("place")
    slots = placed.withColumn("slot", F.last("tag", ignorenulls=True).over(before))
    linked = slots.where("text AND slot IS NOT NULL").groupBy("host", "slot").agg(
        F.sum("size").alias("size"), F.sum("linked").alias("linked")
    )
    menus = linked.where(F.col("linked") > F.col("size") * LINKED)
    parts = (
        tags.select("host", "token", F.lit("tags").alias("part"))
        .unionByName(valid.where("text").select("host", "token", F.lit("strings").alias("part")))
        .unionByName(menus.select("host", F.col("slot").alias("token"), F.lit("menus").alias("part")))
    )
    held = lambda part: F.collect_set(F.when(F.col("part") == part, F.col("token"))).alias(part)
    made = parts.groupBy("host").agg(held("tags"), held("strings"), held("menus"))
    return made.where(F.size("tags") > 0)


def main_text(page: str, template: Template | None = None) -> str:
    """The article of a page, its blocks on lines, by the template of its host if it has one."""
    template = template or Template()
    text = _main_text(page, template)
    if text is None and template.tags:  # the template has no article tag, or not this page's
        text = _main_text(page, template, any_article=True)
    return text or ""


def _main_text(page: str, template: Template, any_article: bool = False) -> str | None:
    """None: the page has article tags, but none of the template's."""
    blocks: list[tuple[Node, str, int]] = []  # block, raw text, slot
    raw: list[str] = []
    block: Node | None = None
    slot = 0
    marked = False

    def end() -> None:
        nonlocal block
        if block is not None and raw:
            blocks.append((block, "".join(raw), slot))
        raw.clear()
        block = None

    for kind, node, text in pieces(page, None if any_article else template):
        if kind == "text":
            if block is not None and block is not node:
                end()
            block = node
            raw.append(text)
        elif kind in ("open", "close"):
            end()
            marked = marked or node.name in ("article", "main")
            if template.menus and (token := digest(kind, node.path, "")) in template.tags:
                slot = token
    end()
    kept = [(b, cleaned(t), slot) for b, t, slot in blocks if not b.dropped and t.strip()]
    article = [line for b, line, _ in kept if b.main]
    if not article and marked and not any_article and template.tags:
        return None
    if not article:
        article = [
            line
            for b, line, slot in kept
            if slot not in template.menus and digest("text", b.path, line) not in template.strings
        ]
    return "\n".join(line for line in article if line)


def extract_main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of *pages* (page_id, url, html).

    A NULL or empty page has an empty text. Pages without an URL, or with one that has no
    host, count as pages of one nameless host. Rows with NULL or repeated ids are pages like others; other columns are ignored.
    """
    with Scratch(pages.sparkSession) as scratch:
        found = scratch.store(templates(pages, scratch))
        rows = pages.select("page_id", "url", "html").withColumn("host", _host_column())
        joined = rows.join(found, "host", "left")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen: dict[str, Template] = {}
            for batch in batches:
                texts = []
                parts = [batch.column(n) for n in ("tags", "strings", "menus")]
                rows = zip(batch.column("host").to_pylist(), batch.column("html"))
                for i, (host, page) in enumerate(rows):
                    if host not in seen:
                        if len(seen) > 1000:
                            seen.clear()
                        seen[host] = Template(*[p[i].as_py() or () for p in parts])
                    texts.append(main_text(page.as_py() or "", seen[host]))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("page_id"),
                        batch.column("url"),
                        pa.array(texts, pa.string()),
                        pa.array([len(t) for t in texts], pa.int64()),
                    ],
                    names=["page_id", "url", "text", "n_chars"],
                )

        fields = "page_id bigint, url string, text string, n_chars bigint"
        return result(joined.mapInArrow(freeing(run), fields))


def _host_column():
    pattern = r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)"
    return F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), pattern, 1))
