"""HTML main text by tag-path ratios.

A page is read once into text blocks, each at the root-to-leaf path of its enclosing
elements (inline elements add nothing to it).  Equal paths share one number, so memory
and time are linear in the page.  For every path the characters and the punctuation
of its blocks, without link text, are put in relation to the number of blocks.  The
two ratios are fused into one score and smoothed over the paths beside it: those under
the same parent, then those under the grandparent.  That is weighed by the share of
the page's text that the paths beside it hold together, so that a long footer is
little beside many paragraphs.  Paths of at least a part of the page's largest score
hold the content; headings, lists and tables beside content belong to it.

What elements and class names say about their role is a prior that multiplies the
score of a path's blocks, readers' comments are known by their shape, whatever their
names, and a main element joins its paths: that decides where ratios
tie, as on a page whose article is one line.  `hints=False` leaves it out.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import bounded_batches

#: A path is content from this part of the page's largest score.
THRESHOLD = 0.25
#: Weights of a path, of all paths under its parent, and of those under its grandparent.
KERNEL = (0.6, 0.3, 0.1)
#: Of the text under a path's grandparent this part counts as beside it.
FARTHER = 0.3
#: Power of the share of text beside a path.
MASS = 1.5
#: Paths of text in main elements have this part of the largest smoothed ratio among them at least.
JOINED = 0.3
#: A block with this part of its text in links counts nothing.
MOSTLY = 0.7
#: Priors: of blocks inside a main element, and of blocks outside where there is one.
INSIDE, OUTSIDE = 4.0, 0.25
#: A marked element that holds this part of the page's text is no furniture, unless the main element lies outside.
HOLDS = 0.8

# Elements by their role in HTML.
_INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark math q rp rt ruby s samp small span strike strong sub sup svg time tt u var wbr maction menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom mroot mrow ms mspace msqrt mstyle msub msubsup msup mtext munder munderover semantics".split())
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_RAW = set("script style textarea title noscript template iframe object select svg canvas audio video annotation".split())
_HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
_NEVER = set("nav footer aside button dialog menu head".split())
_MARKED = set("form fieldset".split())
_MAIN = set("article main".split())
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "p": {"p"}, "option": {"option"}}
# Words of class names and ids that name page furniture, words that may follow them, and words that stand before them in names of something else.
_FURNITURE = set("ad ads advert advertisement advertising alert alerts banner breadcrumb breadcrumbs comment comments commentary cookie cookies consent disclaimer disqus footer gdpr masthead menu modal nav navbar navigation newsletter notice notification overlay pagination popup promo promotion promoted related replies respond share sharing sidebar signup sponsor sponsored subscribe subscription toolbar topbar".split())
_CONTAINERS = set("area bar block box buttons container form icons inner items links list outer panel posts section slot thread unit widget wrap wrapper".split())
_OTHERS = set("has no with without is article post entry content story page-has".split())
#: What a reader's comment is made of, and the short line beside it that has a time, or asks for an answer.
_ITEMS = set("article blockquote dd div li section".split())
_BYLINE = re.compile(r"\b(?:\d{1,2}:\d\d|\d+ (?:seconds?|minutes?|hours?|days?|weeks?|months?|years?) ago|(?:vor|il y a|hace) \d+ \w+|says|wrote|reply|antworten|répondre|responder)\b", re.I)
BYLINE = 80
#: Lists and tables, which belong to the text that they stand beside.
_GROUPS = set("dl figure ol pre table ul".split())
_ROLES = re.compile(r"\brole\s*=\s*[\"']?(?:navigation|banner|contentinfo|complementary|search|dialog|alert)\b", re.I)
_HIDDEN = re.compile(r"\shidden(?:[\s=>]|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
_NAMES = re.compile(r"\b(?:class|id)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
# a tag ends before the next one begins, so none is looked at twice
_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^<>]*+>|<(/?)([a-zA-Z][^\s/<>]*+)((?:\"[^\"]*+\"|'[^']*+'|[^'\"<>])*+)>", re.S)
_LINK = re.compile(r"<(/?)a[\s>]", re.I)
_PUNCTUATION = re.compile(r"[.,;:!?…。，、；：！？؟،]")


class Block(NamedTuple):
    path: int  # number of its path; equal paths have equal numbers
    text: str
    linked: int  # characters inside links
    element: int  # number of its innermost element


class Page(NamedTuple):
    blocks: list[Block]
    up: list[int]  # parents of paths; path 0 is the root
    parents: list[int]  # parents of elements; element 0 is the root
    names: list[str]
    marks: list[int]  # of elements: 0 none, 1 maybe furniture, 2 furniture


def names_furniture(attributes: str) -> bool:
    """Whether a whole class token or id names furniture: such a word alone, at the end of a compound (site-footer), or before a container (comment-list)."""
    for found in _NAMES.findall(attributes):
        for token in "".join(found).lower().split():
            parts = re.split(r"[-_]+", token)
            if parts[0] in _OTHERS:
                continue
            if parts[-1] in _FURNITURE or len(parts) > 1 and parts[0] in _FURNITURE and parts[-1] in _CONTAINERS:
                return True
    return False


def _mark(name: str, attributes: str, in_main: bool) -> int:
    if name in _NEVER or name == "header" and not in_main:
        return 2
    if name in _MARKED:
        return 1
    if not attributes or name in ("html", "body", *_MAIN):
        return 0
    if _HIDDEN.search(attributes):
        return 2
    return int(bool(_ROLES.search(attributes)) or names_furniture(attributes))


def read_page(html: str) -> Page:
    blocks: list[Block] = []
    up, parents, names, marks = [-1], [-1], [""], [0]
    child: dict[tuple[int, str], int] = {}
    stack: list[tuple[str, int, int]] = [("", 0, 0)]  # name, path, element
    open_names: Counter = Counter()
    unclosed: set[str] = set()
    text: list[str] = []
    linked, link = 0, 0  # link: depth of the stack at which the open link began

    def flush() -> None:
        nonlocal text, linked
        if text and (joined := " ".join("".join(text).split())):
            blocks.append(Block(stack[-1][1], joined, linked, stack[-1][2]))
        text, linked = [], 0

    def pop() -> str:
        nonlocal link
        name = stack.pop()[0]
        open_names[name] -= 1
        if link > len(stack):
            link = 0
        return name

    at, n = 0, len(html)
    while at < n:
        m = _TAG.search(html, at)
        if piece := html[at : m.start() if m else n]:
            piece = unescape(piece)
            text.append(piece)
            linked += len(piece.strip()) if link else 0
        if not m:
            break
        at = m.end()
        if m[2] is None:
            continue
        name, closing, attributes = m[2].lower(), bool(m[1]), m[3]
        if name in _RAW and not closing and not attributes.endswith("/") and name not in unclosed:
            end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(html, at)
            if end or name in ("script", "style"):
                at = end.end() if end else n
                continue
            unclosed.add(name)  # of no effect, as no later one can end either
        if name == "br":
            text.append(" ")
        elif name in _INLINE or name in _RAW:
            if name == "a":
                # a link that no </a> ends before the next one begins is none
                link = len(stack) if not closing and (x := _LINK.search(html, at)) and x[1] else 0
        elif closing:
            flush()
            if open_names[name] > 0:
                while pop() != name:
                    pass
        else:
            flush()
            if name in _VOID:
                continue
            if stack[-1][0] == "p":
                pop()
            while stack[-1][0] in _CLOSES.get(name, ()):
                pop()
            if not attributes.endswith("/"):
                _, path, element = stack[-1]
                if (path, name) not in child:
                    child[path, name] = len(up)
                    up.append(path)
                marks.append(_mark(name, attributes, open_names["article"] + open_names["main"] > 0))
                parents.append(element)
                names.append(name)
                stack.append((name, child[path, name], len(parents) - 1))
                open_names[name] += 1
    flush()
    return Page(blocks, up, parents, names, marks)


def _comments(page: Page, weight: list[int], live: int) -> set[int]:
    """Elements that hold readers' comments, by their shape: two or more siblings of one kind, each with a byline and a text of its own; the sibling group's parent, where they are most of its text.  Siblings that hold most of the page's text are its posts."""
    n = len(page.parents)
    lines, bodies = [0] * n, [0] * n
    for b in page.blocks:
        if len(b.text) <= BYLINE and _BYLINE.search(b.text):
            lines[b.element] += 1
        elif b.linked < MOSTLY * len(b.text):
            bodies[b.element] += 1
    for e in range(n - 1, 0, -1):
        lines[page.parents[e]] += lines[e]
        bodies[page.parents[e]] += bodies[e]
    groups: dict[tuple[int, str], list[int]] = {}
    for e in range(1, n):
        if page.names[e] in _ITEMS and lines[e] and bodies[e]:
            groups.setdefault((page.parents[e], page.names[e]), []).append(e)
    out: set[int] = set()
    for (up, _), items in groups.items():
        if len(items) >= 2 and sum(weight[e] for e in items) < HOLDS * live:
            out.update(items)
            if page.names[up] not in ("", "html", "body", *_MAIN) and 2 * sum(weight[e] for e in items) >= weight[up]:
                out.add(up)
    return out


def priors(page: Page) -> list[float]:
    """A factor for each block, from the roles of its elements."""
    n = len(page.parents)
    weight, main = [0] * n, [False] * n
    for b in page.blocks:
        weight[b.element] += max(0, len(b.text) - b.linked)
    own = list(weight)
    for e in range(n - 1, 0, -1):
        weight[page.parents[e]] += weight[e]
    never, marked = [False] * n, [False] * n
    in_main = [0] * n  # number of the outermost main element
    for e in range(1, n):
        up = page.parents[e]
        never[e] = never[up] or page.marks[e] == 2
        in_main[e] = in_main[up] or (e if page.names[e] in _MAIN and not never[e] else 0)
    live = sum(w for e, w in enumerate(own) if not never[e])
    comments = _comments(page, weight, live)
    # where a main element holds half of the text, articles outside of it are none of it
    only = {e for e in range(1, n) if page.names[e] == "main" and in_main[e] == e and 2 * weight[e] >= live}
    in_main = [e if not only or e in only else 0 for e in in_main]
    mains = {in_main[e]: weight[in_main[e]] for e in range(n) if in_main[e] and weight[in_main[e]]}
    inner = [0] * n  # text of main elements inside an element
    for e, w in mains.items():
        inner[e] += w
    for e in range(n - 1, 0, -1):
        inner[page.parents[e]] += inner[e]
    total = sum(mains.values())
    for e in range(1, n):
        own_mark = (page.marks[e] == 1 or e in comments) and not (weight[e] >= HOLDS * live and inner[e] == total)
        marked[e] = marked[page.parents[e]] or own_mark
    has_main = any(not marked[e] for e in mains)
    out = []
    for b in page.blocks:
        e = b.element
        out.append(0.0 if never[e] or marked[e] else INSIDE if in_main[e] else OUTSIDE if has_main else 1.0)
    return out


def path_scores(page: Page, weights: list[float]) -> dict[int, float]:
    """The fused ratio of every path that has blocks of positive weight, smoothed and weighed by the text beside it."""
    sums: dict[int, list[float]] = {}
    for b, w in zip(page.blocks, weights):
        if w <= 0:
            continue
        own = sums.setdefault(b.path, [0.0, 0.0, 0.0, 0.0])
        own[2] += 1
        own[3] += w
        if b.linked < MOSTLY * len(b.text):
            own[0] += max(0, len(b.text) - b.linked)
            own[1] += len(_PUNCTUATION.findall(b.text))
    ratio = {p: c / n * (1 + k / n) ** 0.5 for p, (c, k, n, _) in sums.items()}
    under: dict[int, list[float]] = {}  # by parent, over all its paths: sum of ratios, blocks, characters
    for p, r in ratio.items():
        own = under.setdefault(page.up[p], [0.0, 0.0, 0.0])
        own[0] += r * sums[p][2]
        own[1] += sums[p][2]
        own[2] += sums[p][0]
    joined = sum(x[0] for x in sums.values() if _is_joined(x))  # the text of main elements
    most = max([joined, *(x[2] for x in under.values())])
    smooth: dict[int, tuple[float, float]] = {}
    for p, r in ratio.items():
        near, total, beside, at = KERNEL[0] * r, KERNEL[0], 0.0, p
        for k, part in zip(KERNEL[1:], (1.0, FARTHER)):
            if at < 0:
                break
            at = page.up[at]
            if at in under:
                near, total = near + k * under[at][0] / under[at][1], total + k
                beside = max(beside, part * under[at][2])
        smooth[p] = near / total, beside
    largest = max((smooth[p][0] for p in smooth if _is_joined(sums[p])), default=0.0)
    out = {}
    for p, (near, beside) in smooth.items():
        if _is_joined(sums[p]):
            near, beside = max(near, JOINED * largest), joined
        # paths of links only have no score of their own
        out[p] = near * (beside / most) ** MASS * sums[p][3] / sums[p][2] if ratio[p] > 0 else 0.0
    return out


def _is_joined(sums: list[float]) -> bool:
    """Whether all blocks of a path lie in main elements."""
    return sums[3] == INSIDE * sums[2]


def _take_groups(page: Page, weights: list[float], chosen: list[bool], around: set[int]) -> None:
    """Chooses the lists and tables that stand between or behind chosen blocks of one parent, unless they are mostly links."""
    top = [0] * len(page.parents)  # the outermost list or table around an element
    for e in range(1, len(top)):
        top[e] = top[page.parents[e]] or (e if page.names[e] in _GROUPS else 0)
    first: dict[int, int] = {}
    for k, (b, ok) in enumerate(zip(page.blocks, chosen)):
        if ok:
            first.setdefault(page.parents[b.element], k)
    sums: dict[int, list[int]] = {}
    for b in page.blocks:
        if t := top[b.element]:
            own = sums.setdefault(t, [0, 0])
            own[0] += len(b.text)
            own[1] += b.linked
    for k, (b, w) in enumerate(zip(page.blocks, weights)):
        t = top[b.element]
        if w > 0 and t and page.parents[t] in around and first[page.parents[t]] < k and sums[t][1] < MOSTLY * sums[t][0]:
            chosen[k] = True


def main_text(html: str | None, threshold: float = THRESHOLD, hints: bool = True) -> str:
    """The content blocks of a page, joined by two line ends."""
    page = read_page(html or "")
    weights = priors(page) if hints else [1.0] * len(page.blocks)
    score = path_scores(page, weights)
    top = max(score.values(), default=0.0)
    if top <= 0:
        return ""
    content = {p for p, x in score.items() if x >= threshold * top}
    chosen = [w > 0 and b.path in content for b, w in zip(page.blocks, weights)]
    around = {page.parents[b.element] for b, ok in zip(page.blocks, chosen) if ok}
    _take_groups(page, weights, chosen, around)
    for k, (b, w) in enumerate(zip(page.blocks, weights)):
        if w > 0 and page.names[b.element] in _HEADINGS:
            up = page.parents[b.element]
            chosen[k] = chosen[k] or up in around or page.parents[up] in around
    return "\n\n".join(b.text for b, ok in zip(page.blocks, chosen) if ok)


def _extract(batches: Iterator[pa.RecordBatch], keep: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a in range(0, batch.num_rows, 256):
            part = batch.slice(a, 256)
            texts = [main_text(h.as_py()) for h in part["html"]]
            yield pa.RecordBatch.from_arrays([*(part[c] for c in keep), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], [*keep, "text", "n_chars"])


def extract(pages: DataFrame, keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """For each row of pages: its `keep` columns, text (content blocks, joined by two line ends) and n_chars (code points).

    Null and empty html, and pages without content, give an empty text.  Very long and
    broken pages take time and memory in proportion to their length.  Repeated rows
    each have their result, the same one; no rows give no rows.  Other columns are left
    out, so their names can't clash.
    """
    if clash := {"text", "n_chars"} & set(keep):
        raise ValueError(f"kept columns have names of results: {sorted(clash)}")
    bounded_batches(pages)
    names = list(keep)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.select(*keep).schema) + ", text string, n_chars long"
    return pages.select(*keep, *([] if "html" in keep else ["html"])).mapInArrow(lambda it: _extract(it, names), schema)
