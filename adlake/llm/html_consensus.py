"""HTML extraction: consensus host paths.

1. Each page is parsed once: every container (article, main, section, div, ...)
   gets a score from the text of the blocks below it - full for the nearest
   container, half for the next - less linked text and boilerplate.  The page's
   scores, as shares of their sum, are its votes for generalised paths: tag and
   class steps without digits.
2. Spark sums votes and pages by (host, path).  A host's winning paths are those
   with most votes whose share on the pages that have them is at least a third of the
   best one's; the other paths that several pages have are known to have lost.
3. Each page is parsed again and its text is read from the containers on all
   winning paths that it has, each block once.  A container that no other page of the host has
   is read too if most of the page's unlinked text stands in it; a page without
   winners uses its own scores, or its body.  A path climbs to the outermost
   article or main around it, else to a container so named, else to the nearest
   winning one, whose further text is not linked text: an article split in parts,
   or one with a long quote or table, is read whole.

Boilerplate is known by tags, roles and class names.  A name is sure if all its
parts speak of boilerplate (`ad-box`, `comments`); one with other parts
(`ad-review`, `comments-policy`, `promo-story`), some weak words (`search`) and a form are in doubt.  What is
in doubt stays if the page has next to nothing else: more than DOUBT_TIMES the unlinked text around
it, mostly unlinked itself, not a part of an article with text of its own and not beside one; a form also needs
containers of its own, as a page that stands in a form has.

Votes are pre-aggregated per task batch, and hosts with a third of all pages
shuffle only sums.  The winners (a few rows a host) are broadcast up to
BROADCAST_HOSTS hosts; beyond, pages meet them on (host, salt).

Defined results: null or empty html gives an empty text; a null url is the host
''; unclosed tags, cut pages and stray angle brackets are read as far as they go;
repeated rows are extracted each; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adlake.llm.common import bounded_broadcast, in_batches, read_table, stored

QUERY_NAME = "op2_html_consensus"

#: Paths of a host that may win, by votes, and the share of the best one's mean that a winner has at least.
WINNERS, WINNING_SHARE = 16, 1 / 3
BROADCAST_HOSTS = 100_000
SALTS = 16

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9]*)((?:"[^"]*"|'[^']*'|[^'">])*)>|<[/!?][^>]*(?:>|\Z)|<[a-zA-Z][^<>]*\Z""", re.S)
ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")

#: Attributes that may leave an inline element out.
TELLING = re.compile(r"class|\bid\b|hidden|style", re.I)

RAW = frozenset("script style textarea title iframe".split())
#: Dropped inside a block without parting it; left open, they end where the next block begins.
MUTED = frozenset("svg math object canvas audio video select button".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q s samp small span strike strong sub sup time tt u var ruby rt rp center".split())
CONTAINERS = frozenset("article main section div td body blockquote".split())
DROPPED_TAGS = frozenset("nav header footer aside fieldset menu dialog head noscript template".split())
DROPPED_WORDS = frozenset(
    "ad adbox ads adslot adv advert alert announcement adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies copyright disclaimer discussion disqus footer form login masthead menu modal nav navbar navigation newsletter notice notices pager pagination popup promo promotion recommended related reply replies respond search share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)
#: Parts of a name that say nothing about what it names.
NEUTRAL = frozenset("a area articles bar bottom box block col column container content count global group head heading holder inner item items js left link links list main more outer page panel posts right row section site slot stories the thread title top unit wrap wrapper x xs s m l xl".split()) | {""}
#: Names of these words alone are in doubt as well.
DOUBTFUL = frozenset("alert announcement banner disclaimer login newsletter notice notices promo promotion related search share sharing signup social subscribe toolbar widget".split())
DOUBT_TIMES = 4
#: A name with one of these tells of another part of the page (`has-sidebar`), and an article is dropped for few words only.
ABOUT_OTHERS = frozenset("has no with without".split())
NO_ARTICLE = frozenset("ad ads advert comment comments promo related reply replies sponsored".split())
DROPPED_NAMES = frozenset("header site-header page-header top-header".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar".split())
GOOD_WORDS = frozenset("article body content entry main post story text".split())
#: An open element of the key is closed when one of these begins.
CLOSES = {
    "p": frozenset("p div article section main ul ol dl table h1 h2 h3 h4 h5 h6 blockquote pre form nav header footer aside hr fieldset figure address".split()),
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "td": frozenset(["td", "th", "tr"]),
    "th": frozenset(["td", "th", "tr"]),
    "tr": frozenset(["tr"]),
    "option": frozenset(["option"]),
}
ENDS_MUTED = CLOSES["p"] | frozenset("li dt dd td th tr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())


class Element:
    __slots__ = ("tag", "step", "path", "dropped", "doubts", "container", "good")

    def __init__(self, tag: str, attributes: str, parent: Element | None) -> None:
        got = _attributes(attributes)
        sure, doubtful = _named(got, NO_ARTICLE if tag in ("article", "main") else DROPPED_WORDS)
        classes = sorted({re.sub(r"\d+", "", n) for n in html.unescape(got.get("class", "")).lower().split()} - {""})
        self.tag = tag
        self.step = ".".join([tag, *classes])
        self.path = f"{parent.path}/{self.step}" if parent else self.step
        names = set(html.unescape(f"{got.get('class', '')} {got.get('id', '')}").lower().split())
        surely = tag in DROPPED_TAGS or tag in MUTED or sure or bool(DROPPED_NAMES & names) or got.get("role", "").lower() in DROPPED_ROLES or _hidden(got)
        whole = tag in ("body", "html")
        self.dropped = bool(parent and parent.dropped) or (surely and not whole)
        #: The elements in doubt around a block, the outermost first.
        self.doubts: tuple[Element, ...] = (parent.doubts if parent else ()) + ((self,) if (doubtful or tag == "form") and not whole and not surely else ())
        self.container = tag in CONTAINERS
        self.good = tag in ("article", "main") or bool({w for n in names for w in re.split(r"[-_\d]+", n)} & GOOD_WORDS)


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(text)} if text.strip() else {}


def _hidden(got: dict[str, str]) -> bool:
    return "hidden" in got or got.get("aria-hidden") == "true" or "display:none" in got.get("style", "").replace(" ", "").lower()


def _named(got: dict[str, str], words: frozenset[str]) -> tuple[bool, bool]:
    """Whether class or id say for sure, or may say, that this is boilerplate."""
    sure = doubtful = False
    for name in html.unescape(f"{got.get('class', '')} {got.get('id', '')}").lower().split():
        parts = set(re.split(r"[-_\d]+", name))
        if parts & ABOUT_OTHERS or not parts & words:
            continue
        if parts <= words | NEUTRAL and parts & words - DOUBTFUL:
            sure = True
        else:
            doubtful = True
    return sure, doubtful


Block = tuple[list[Element], str, int]


def blocks(page: str) -> list[Block]:
    """(open elements, text, linked characters) of each block outside boilerplate, in page order."""
    found = list(_blocks(page))
    if not any(stack and stack[-1].doubts for stack, _, _ in found):
        return found
    kept = _kept_doubts(found)
    return [b for b in found if not b[0] or all(id(d) in kept for d in b[0][-1].doubts)]


def _kept_doubts(found: list[Block]) -> set[int]:
    """The elements in doubt that the page can't do without."""
    free: dict[int, int] = defaultdict(int)  # unlinked characters below an element in doubt
    linked_in: dict[int, int] = defaultdict(int)
    sure = 0
    nested: dict[int, dict[int, Element]] = defaultdict(dict)  # by the next one around it, 0 for none
    articles: dict[int, int] = defaultdict(int)  # unlinked characters of articles outside doubt
    told: set[int] = set()  # elements in doubt (0: the page) with an article or main of their own
    built: set[int] = set()  # forms with containers: pages that stand in a form
    for stack, text, linked in found:
        doubts = stack[-1].doubts if stack else ()
        for around, d in zip((None, *doubts), doubts):
            nested[id(around) if around else 0][id(d)] = d
            free[id(d)] += len(text) - linked
            linked_in[id(d)] += linked
        if not doubts:
            sure += len(text) - linked
        for e in stack:
            if e.good and e.container and e.doubts == doubts and e not in doubts:
                articles[id(e)] += len(text) - linked
                if e.tag in ("article", "main") and len(text) > linked:
                    told.add(id(doubts[-1]) if doubts else 0)
            if e.container and e.tag != "body":
                built.update(id(d) for d in e.doubts if d is not e)
    within: dict[int, int] = {}  # text of the articles around an element in doubt
    for stack, _, _ in found:
        for k, e in enumerate(stack):
            if e.doubts and e.doubts[-1] is e:
                within[id(e)] = max((articles[id(x)] for x in stack[:k]), default=0)
    kept: set[int] = set()

    def choose(around: int, beside: int) -> None:
        """beside: unlinked text around these elements that stays for sure."""
        good = [d for k, d in nested[around].items() if free[k] > DOUBT_TIMES * beside and free[k] > 2 * linked_in[k] and not within[k]]
        good = [d for d in good if d.tag != "form" or id(d) in built]
        named = [d for d in good if d.tag in ("article", "main")]
        if not named and around not in told:
            named = [d for d in good if d.good] or good
        most = max((free[id(d)] for d in named), default=0)
        for d in named:
            if 2 * free[id(d)] >= most:
                kept.add(id(d))
                own = free[id(d)] - sum(free[k] for k in nested[id(d)])
                choose(id(d), own)

    choose(0, sure)
    return kept


def _blocks(page: str) -> Iterator[tuple[list[Element], str, int]]:
    """Blocks outside sure boilerplate."""
    stack: list[Element] = []
    parts: list[str] = []
    linked, in_link, at = 0, 0, 0
    skip_to = ""
    muted, depth = "", 0  # an inline element whose text is left out, and how many of its tag are open in it

    def flush() -> Iterator[tuple[list[Element], str, int]]:
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text and not (stack and stack[-1].dropped):
                yield list(stack), text, linked
            parts.clear()
        linked = 0

    while at < len(page):
        if skip_to:  # the content of a raw element ends at its own end tag only
            end = re.compile(rf"</{skip_to}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at, skip_to = (end.end() if end else len(page)), ""
            continue
        m = TOKEN.search(page, at)
        piece = page[at : m.start() if m else len(page)]
        if piece and not muted and not (stack and stack[-1].tag in MUTED):
            parts.append(piece)
            if in_link:
                linked += len(piece)
        if not m:
            break
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        closing = bool(m[1])
        if tag in RAW:
            if not closing and not m[3].rstrip().endswith("/"):
                skip_to = tag
            continue
        if tag in MUTED:
            if closing:
                if any(e.tag == tag for e in stack):
                    while stack.pop().tag != tag:
                        pass
            elif not m[3].rstrip().endswith("/"):
                stack.append(Element(tag, "", stack[-1] if stack else None))
            continue
        if stack and stack[-1].tag in MUTED:
            if all(e.tag != tag for e in stack) if closing else tag not in ENDS_MUTED:
                continue
            while stack and stack[-1].tag in MUTED:
                stack.pop()
        if tag in INLINE:
            if tag == "a":
                in_link = 0 if closing else 1
            if muted:
                depth += (tag == muted) * (-1 if closing else 1)
                muted = muted if depth else ""
            elif not closing and TELLING.search(m[3]) and _left_out(m[3]):
                muted, depth = tag, 1
            continue
        if tag == "br" or tag in ("wbr", "img"):
            if tag == "br":
                parts.append(" ")
            continue
        yield from flush()
        muted = ""
        if tag in VOID:
            continue
        if closing:
            if any(e.tag == tag for e in stack):
                while stack.pop().tag != tag:
                    pass
            continue
        while stack and tag in CLOSES.get(stack[-1].tag, ()):
            stack.pop()
        if stack and stack[-1].tag in HEADINGS and tag in CLOSES["p"]:
            stack.pop()
        if stack and stack[-1].tag == "head" and tag == "body":
            stack.pop()
        in_link = 0
        stack.append(Element(tag, m[3] or "", stack[-1] if stack else None))
    while stack and stack[-1].tag in MUTED:
        stack.pop()
    yield from flush()


def _left_out(attributes: str) -> bool:
    """Whether an inline element is hidden or surely boilerplate."""
    got = _attributes(attributes)
    return _hidden(got) or _named(got, DROPPED_WORDS)[0]


def container_scores(page: str) -> dict[str, float]:
    """Score of each generalised container path of a page."""
    return scores_of(blocks(page))


def scores_of(found: list[tuple[list[Element], str, int]]) -> dict[str, float]:
    scores: dict[str, float] = defaultdict(float)
    for stack, text, linked in found:
        gain = max(0, len(text) - 2 * linked)
        share = 1.0
        for e in reversed([e for e in stack if e.container][-2:]):
            scores[e.path] += gain * share * (1.5 if e.good else 1.0) * (0.5 if e.tag == "body" else 1.0)
            share *= 0.5
    return {p: s for p, s in scores.items() if s > 0}


def climbed(path: str, winners: Sequence[str], found: list[Block]) -> str:
    """The path of the container around those on *path* that holds the whole content; *path* itself if there is none."""
    inside = next(stack for stack, _, _ in found if any(e.path == path for e in stack))
    around = [e for e in inside if e.container and e.tag != "body" and path.startswith(e.path + "/")]
    articles = [e.path for e in around if e.tag in ("article", "main")]
    if articles:
        return articles[0]
    for e in [*[e for e in around if e.good], *[e for e in reversed(around) if e.path in winners]]:
        rest = [(len(text), linked) for stack, text, linked in found if any(x.path == e.path for x in stack) and all(x.path != path for x in stack)]
        if sum(n for n, _ in rest) > 2 * sum(k for _, k in rest):
            return e.path
    return path


def main_text(page: str, winners: Sequence[str], losers: Sequence[str] = ()) -> tuple[str, str]:
    """(text, paths used) by the winning paths that the page has, or the containers around them.

    losers: paths that other pages of the host have as well, and that did not win.
    """
    found = blocks(page)
    own = scores_of(found)
    there = {e.path for stack, _, _ in found for e in stack if e.container}
    chosen = [p for p in winners if p in there]
    if own:
        ranked = sorted(sorted(own), key=own.get, reverse=True)
        if not chosen:
            chosen = [p for p in ranked if own[p] >= WINNING_SHARE * own[ranked[0]]]
        else:  # a container of this page alone, with most of its text
            whole = sum(len(text) - linked for _, text, linked in found)
            held = sum(len(text) - linked for stack, text, linked in found if any(e.path == ranked[0] for e in stack))
            if ranked[0] not in winners and ranked[0] not in losers and 2 * held > whole and not ranked[0].endswith("/body"):
                chosen = [*chosen, ranked[0]]
    # the innermost of the chosen; body only if it is alone
    inner = [p for p in chosen if not any(q != p and q.startswith(p + "/") for q in chosen)]
    if not inner:
        return "\n".join(text for _, text, _ in found), ""
    wholes = dict.fromkeys(climbed(p, chosen, found) for p in inner)
    return "\n".join(text for stack, text, _ in found if any(e.container and e.path in wholes for e in stack)), " ".join(wholes)


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_replace(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1), r"^www\.", ""))


def host_winners(pages: DataFrame, winners: int = WINNERS, share: float = WINNING_SHARE) -> DataFrame:
    """(host, paths, losers): the winning paths of each host, best first, and the others among its *winners* paths with most votes."""

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums: dict[tuple[str, str], list[float]] = defaultdict(lambda: [0.0, 0])
            for host, page in zip(batch.column(0).to_pylist(), batch.column(1)):
                scores = container_scores(page.as_py() or "")
                total = sum(scores.values())
                for path, s in scores.items():
                    one = sums[host, path]
                    one[0] += s / total
                    one[1] += 1
            keys = list(sums)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()), pa.array([sums[k][0] for k in keys], pa.float64()), pa.array([sums[k][1] for k in keys], pa.int64())],
                ["host", "path", "votes", "pages"],
            )

    votes = (
        in_batches(pages.select(host_of(F.col("url")).alias("host"), "html"), vote, "host string, path string, votes double, pages long")
        .groupBy("host", "path")
        .agg(F.round(F.sum("votes"), 6).alias("votes"), F.sum("pages").alias("pages"))
    )
    best = F.row_number().over(Window.partitionBy("host").orderBy(F.desc("votes"), "path"))
    ranked = votes.withColumn("place", best).filter(F.col("place") <= winners).withColumn("mean", F.col("votes") / F.col("pages"))
    listed = ranked.groupBy("host").agg(F.array_sort(F.collect_list(F.struct("place", "path", "mean", "pages"))).alias("of"), F.max_by("mean", -F.col("place")).alias("top"))
    won = lambda x: x["mean"] >= F.lit(share) * F.col("top")
    return listed.select("host", F.transform(F.filter("of", won), lambda x: x["path"]).alias("paths"), F.transform(F.filter("of", lambda x: ~won(x) & (x["pages"] > 1)), lambda x: x["path"]).alias("losers"))


def extract_pages(pages: DataFrame, winners: int = WINNERS, broadcast_hosts: int = BROADCAST_HOSTS) -> DataFrame:
    """page_id, url, text and the path that the text was read from."""
    best = stored(host_winners(pages, winners), "winners")  # counted and joined: the pages are parsed for votes once
    spread = best.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    keyed = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", host_of(F.col("url")).alias("_host"), F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int").alias("_salt"))
    joined = keyed.join(bounded_broadcast(spread, broadcast_hosts * SALTS), (F.col("_host") == F.col("host")) & (F.col("_salt") == F.col("salt")), "left")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, len(batch), 500):
                rows = batch.slice(a, 500)
                got = [main_text(p or "", w or (), k or ()) for p, w, k in zip(*(c.to_pylist() for c in rows.columns[2:]))]
                yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array([t for t, _ in got], pa.string()), pa.array([p for _, p in got], pa.string())], ["page_id", "url", "text", "path"])

    return in_batches(joined.select("page_id", "url", "html", "paths", "losers"), read, "page_id long, url string, text string, path string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = extract_pages(read_table(spark, sf_dir, "pages"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "path")
