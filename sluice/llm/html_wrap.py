"""Main text of web pages by union-free wrapper inference.

A page is a stream of tags and texts.  The streams of one host are aligned one after
the other: equal tags at one place fold together, neighbours of the same shape become
a repeated group (runs of one, two or three items), what only some pages have becomes
optional, differing texts become a slot.  The result is a wrapper: a nested
expression without unions whose slots know how many pages filled them, with how many
characters, how many of those in links, and whether the text ever changed.

Each task folds its pages into one partial wrapper per host, partial wrappers of a
host are folded the same way, so a host with a third of all pages sends one small row
per task.  A wrapper names the path of its main slot group: the article or main
element with the most text, else the deepest group that holds most of the text that
is not boilerplate.  Pages meet their host's path in a join; a page without that path
is read by its own wrapper.

Inside the main group, menus, adverts, forms, notices, comments and the like are left
out by element, class and role, and so are slots that the host never changes while the
main text around them does.  A page leaves out a node only where its whole text is that
of the fixed slot.  Links stay unless their group is marked as one of these.  Blocks are
joined by one newline, white space inside a block is one space, character references are
decoded.

Null and empty pages have the empty text; a page without tags is its text; broken and
unclosed tags close with their parent; a tag or quoted value that never ends takes the rest
of the page; a url without a host is a host of its own name.  Elements deeper than ``DEPTH``
lie flat in the one at that depth, their blocks and texts whole and in order.  Reading a
page takes time in proportion to its length.  A host's wrapper has ``NODES`` nodes at most
and ``KIDS_MOST`` children a node: beyond that, children of one label become one group, and
what the fewest pages have leaves the wrapper (pages that the shortened wrapper does not fit
are read by their own).  Repeated pages keep a row each; empty tables give no rows; input
columns other than id, url and html are not read, so their names cannot clash.
"""

from __future__ import annotations

import html as html_lib
import json
import re
from difflib import SequenceMatcher
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import textutil as tu

# The elements of HTML by their role.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source",
        "track", "wbr"}
RAW = "script|style|noscript|template|textarea|title|iframe|svg|object|canvas|audio|video|select"
BLOCK = {"address", "article", "aside", "blockquote", "body", "center", "dd", "details", "dialog", "dir", "div",
         "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6",
         "header", "hgroup", "hr", "html", "li", "main", "menu", "nav", "ol", "p", "pre", "search", "section",
         "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul", "br"}
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}, "tbody": {"thead", "tbody"}, "tfoot": {"tbody"}}
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table", "tbody", "thead", "tfoot"},
         "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"datalist"}, "tbody": {"table"}, "tfoot": {"table"}}
LEFT_OUT = {"nav", "footer", "aside", "form", "button", "dialog", "menu", "input", "label", "head", "legend"}
WORDS = {"ad", "ads", "advert", "adverts", "advertisement", "adsense", "sponsor", "sponsored", "promo", "promotion",
         "sidebar", "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "cookie", "cookies",
         "consent", "gdpr", "notice", "notices", "banner", "popup", "modal", "overlay", "newsletter", "subscribe",
         "subscription", "signup", "login", "share", "sharing", "social", "related", "recommended", "footer",
         "masthead", "topbar", "comment", "comments", "disqus", "reply", "replies", "widget", "toolbar",
         "pagination", "pager", "hidden", "copyright"}
CONTAINERS = ("div", "section", "small")
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "menu", "menubar"}

_TOKEN = re.compile(rf"<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})\b[^>]*+(?:>|\Z).*?(?:</(?P=raw)\s*+>|\Z)"
                    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*+)"
                    r"(?P<attrs>(?:[^>=]++|=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z))?+)*+)(?:>|\Z)"
                    r"|<[!?/][^>]*+(?:>|\Z)", re.S | re.I)
_ATTR = re.compile(r"""(?<![\w-])(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.I)
_SPACE = re.compile(r"\s+")
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

# A node of a page: [label, left out?, kids]; a text is a str.  A node of a wrapper:
# [label, optional, repeated, pages, characters, in links, hash of the text or None, kids,
# hashes of the main texts around it (SHARED at most)].
LABEL, OPT, REP, PAGES, CHARS, LINKS, TEXT, KIDS, AROUND = range(9)
SHARED = 5  # different main texts that share a slot before it counts as template
DEPTH, NODES, KIDS_MOST = 200, 4000, 500


def _describe(tag: str, attrs: str) -> tuple[str, bool]:
    """Label of an element (tag and class words) and whether it is boilerplate."""
    out, names = tag in LEFT_OUT, []
    if attrs:
        for name, a, b, c in _ATTR.findall(attrs):
            name, value = name.lower(), a or b or c
            if name == "hidden" or (name == "aria-hidden" and value == "true"):
                out = True
            elif name == "style":
                out |= "display:none" in value.replace(" ", "").lower()
            elif name == "role":
                out |= value.lower() in ROLES
                names += ["main"] if value.lower() == "main" else []
            else:
                words = {w.lower() for w in _PART.findall(value)}
                if tag not in ("html", "body", "article", "main"):
                    out |= bool(words & WORDS)
                if name == "class":
                    names += sorted(words)
    return ".".join([tag, *names]), out


def parse(page: str) -> list:
    """The page as nested [label, left out, kids] with implied ends."""
    root = ["", False, []]
    stack, tags, at = [root], [""], 0
    places: dict[str, list[int]] = {}  # of each open tag in the stack

    def deepest(names):
        return max((places[t][-1] for t in names if places.get(t)), default=0)

    def close(k):
        while len(tags) > k:
            tag = tags.pop()
            stack.pop()
            places[tag].pop()
            if len(tags) >= DEPTH and tag in BLOCK:
                stack[-1][2].append(["br", False, []])

    for m in _TOKEN.finditer(page):
        if m.start() > at:
            stack[-1][2].append(page[at:m.start()])
        at = m.end()
        tag = m["tag"]
        if not tag:
            continue
        tag = tag.lower()
        if m["end"]:
            if places.get(tag):
                close(places[tag][-1])
            continue
        if tag in CLOSES:
            k = deepest(CLOSES[tag])
            if k > deepest(SCOPE[tag]):
                close(k)
        elif tag in BLOCK and tag != "br" and places.get("p"):
            k = places["p"][-1]
            if k > deepest(("table", "button", "object")):
                close(k)
        if tag in VOID:
            if tag in BLOCK:
                stack[-1][2].append([tag, False, []])
            continue
        label, out = _describe(tag, m["attrs"])
        if tag == "header" and not places.get("article") and not places.get("main"):
            out = True
        node = [label, out, []]
        if len(stack) < DEPTH:
            stack[-1][2].append(node)
        elif not out:  # flat: the element's texts go to the one at that depth
            node = stack[-1]
            if tag in BLOCK:
                node[2].append(["br", False, []])
        if not m["attrs"].endswith("/"):
            places.setdefault(tag, []).append(len(stack))
            stack.append(node)
            tags.append(tag)
    if at < len(page):
        stack[-1][2].append(page[at:])
    return root


def _tag(label: str) -> str:
    return label.partition(".")[0]


def _digest(text: str) -> str:
    return blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).hexdigest()


def _is_main(label: str) -> bool:
    names = label.split(".")
    return names[0] in ("article", "main") or "main" in names[1:]


def wrapper(node: list) -> list:
    """The wrapper of one page."""
    w, whole = _wrap(node, False)
    _surround(w, whole)
    _fold_kids(w)
    return w


def _surround(w: list, around: str) -> None:
    """Tells each text container the hash of the main text (article, main or page) it is in."""
    if w[AROUND]:
        around = w[AROUND][0]
    w[AROUND] = [around] if w[TEXT] and not w[KIDS] and _tag(w[LABEL]) in CONTAINERS else []
    for k in w[KIDS]:
        _surround(k, around)


def _wrap(node: list, linked: bool) -> tuple[list, str | None]:
    """The wrapper of a node and the hash of all text below it."""
    kids, chars, links = [], 0, 0
    linked |= _tag(node[0]) == "a"
    text, whole = [], []
    for k in node[2]:
        if isinstance(k, str):
            k = _SPACE.sub(" ", k).strip()
            n = len(k)
            if not n:
                continue
            chars, links = chars + n, links + n * linked
            text.append(k)
            whole.append(k)
        elif not k[1]:
            w, below = _wrap(k, linked)
            whole += [below] if below else []
            chars, links = chars + w[CHARS], links + w[LINKS]
            if _tag(w[LABEL]) in BLOCK or w[KIDS]:
                kids.append(w)
            elif w[TEXT]:
                text.append(w[TEXT])
    own = _digest(" ".join(text)) if text else None
    whole = own if len(whole) == len(text) else _digest(" ".join(whole))
    around = [whole] if whole and _is_main(node[0]) else []
    return [node[0], False, False, 1, chars, links, own, kids, around], whole


def _fold_kids(w: list) -> None:
    for k in w[KIDS]:
        _fold_kids(k)
    w[KIDS] = _fold_runs(w[KIDS])


def _fold_runs(kids: list) -> list:
    """Neighbours of one shape become a repeated group, for periods of one to three."""
    for period in (1, 2, 3):
        if len(kids) < 2 * period:
            break
        out = []
        for k in kids:
            out.append(k)
            if len(out) >= 2 * period:
                a, b = out[-2 * period:-period], out[-period:]
                if [x[LABEL] for x in a] == [x[LABEL] for x in b]:
                    for x, y in zip(a, b):
                        n = x[PAGES]
                        _fold(x, y)
                        x[PAGES], x[REP] = n, True
                    del out[-period:]
        kids = out
    return _gather(kids)


def _gather(kids: list) -> list:
    """Too many children become one group a label, or one an element."""
    for name in (lambda label: label, _tag):
        if len(kids) <= KIDS_MOST:
            break
        groups: dict[str, list] = {}
        for k in kids:
            a = groups.setdefault(name(k[LABEL]), k)
            if a is not k:
                n = max(a[PAGES], k[PAGES])
                _fold(a, k)
                a[PAGES], a[REP] = n, True
        for label, k in groups.items():
            k[LABEL] = label
        kids = list(groups.values())
    return kids


def _add(w: list, new: list) -> None:
    """Folds a wrapper into its host's and keeps that within ``NODES`` nodes.  A shortened
    wrapper is marked by an optional root."""
    _fold(w, new)
    few = 1
    while few < w[PAGES] and _size(w) > NODES:
        w[OPT], few = True, 2 * few
        stack = [w]
        while stack:
            node = stack.pop()
            node[KIDS] = [k for k in node[KIDS] if k[PAGES] >= few]
            stack += node[KIDS]


def _size(w: list) -> int:
    n, stack = 0, [w]
    while stack:
        node = stack.pop()
        n += 1
        stack += node[KIDS]
    return n


def _fold(a: list, b: list) -> None:
    """Folds node b into node a (both of one label)."""
    a[OPT] |= b[OPT]
    a[REP] |= b[REP]
    for k in (PAGES, CHARS, LINKS):
        a[k] += b[k]
    a[AROUND] = sorted({*a[AROUND], *b[AROUND]})[:SHARED]
    if a[TEXT] != b[TEXT]:
        a[TEXT] = ""  # a slot
    x, y = [k[LABEL] for k in a[KIDS]], [k[LABEL] for k in b[KIDS]]
    if x == y:
        for k, m in zip(a[KIDS], b[KIDS]):
            _fold(k, m)
        return
    out = []
    for op, i, j, u, v in SequenceMatcher(None, x, y, autojunk=False).get_opcodes():
        if op == "equal":
            for k, m in zip(a[KIDS][i:j], b[KIDS][u:v]):
                _fold(k, m)
                out.append(k)
        else:
            for k in (*a[KIDS][i:j], *b[KIDS][u:v]):
                k[OPT] = True
                out.append(k)
    a[KIDS] = _fold_runs(out)


def main_path(w: list) -> list[str]:
    """Labels from the root to the wrapper's main group."""
    best, where = 0, None
    stack = [(w, [])]
    while stack:
        node, path = stack.pop()
        path = path + [node[LABEL]]
        if _is_main(node[LABEL]):
            # an article inside main counts first
            own = node[CHARS] - node[LINKS] + (_tag(node[LABEL]) == "article")
            if own > best:
                best, where = own, path
        stack += [(k, path) for k in node[KIDS]]
    if where:
        return where
    path, node = [w[LABEL]], w
    while True:
        mass = node[CHARS] - node[LINKS]
        big = max(node[KIDS], key=lambda k: k[CHARS] - k[LINKS], default=None)
        if big is None or big[REP] or _tag(big[LABEL]) in ("p", "h1", "h2", "li", "td") \
                or 10 * (big[CHARS] - big[LINKS]) < 7 * mass:
            return path
        path.append(big[LABEL])
        node = big


def _at(w: list, path: list[str]) -> list | None:
    nodes = [w] if w[LABEL] == path[0] else []
    for label in path[1:]:
        nodes = [k for n in nodes for k in n[KIDS] if k[LABEL] == label]
    return nodes[0] if nodes else None


def fixed_slots(w: list, path: list[str]) -> list[list]:
    """Slots inside the main group that are template: containers whose text the host
    never changes over at least ``SHARED`` different main texts, as [path, hash of the
    text, whether a repeated group holds it]."""
    out: list[list] = []

    def walk(node, at, many):
        for k in node[KIDS]:
            here = at + [k[LABEL]]
            if len(k[AROUND]) >= SHARED and k[TEXT] and not k[KIDS] and not k[REP]:
                out.append([here, k[TEXT], many])
            else:
                walk(k, here, many or k[REP])
    top = _at(w, path)
    if top is not None:
        walk(top, [], False)
    return out


def _find(node: list, path: list[str]) -> list[list]:
    nodes = [node] if node[0] == path[0] else []
    for label in path[1:]:
        nodes = [k for n in nodes for k in n[2] if not isinstance(k, str) and not k[1] and k[0] == label]
    return nodes


def blocks(node: list, drop: list[list]) -> list[str]:
    """Texts of the blocks below a node, in page order, without the fixed slots ``drop``:
    each takes one node, or any number where a repeated group holds it."""
    out, run = [], []
    left: dict[tuple, list] = {}
    for path, text, many in drop:
        left.setdefault(tuple(path), []).append((text, many))

    def fixed(k, here):
        slots = left.get(here)
        if not slots:
            return False
        w, _ = _wrap(k, False)
        hit = next((x for x in slots if x[0] == w[TEXT] and not w[KIDS]), None)
        if hit and not hit[1]:
            slots.remove(hit)
        return hit is not None

    def flush():
        if run:
            t = _SPACE.sub(" ", html_lib.unescape("".join(run))).strip()
            run.clear()
            if t:
                out.append(t)

    def walk(n, at):
        for k in n[2]:
            if isinstance(k, str):
                run.append(k)
            elif not k[1]:
                here = (*at, k[0])
                if fixed(k, here):
                    continue
                block = _tag(k[0]) in BLOCK
                if block:
                    flush()
                walk(k, here)
                if block:
                    flush()
    walk(node, ())
    flush()
    return out


def extract(page: str | None, rule: str | None) -> str:
    """Main text of a page by its host's rule (see ``rules``)."""
    if not page:
        return ""
    tree = parse(page)
    nodes, drop = [], []
    if rule:
        path, drop = json.loads(rule)
        nodes = _find(tree, path) if path else []
    if not nodes:
        path, drop = main_path(wrapper(tree)), []
        while not (nodes := _find(tree, path)):
            path.pop()  # a group of too many children: the nearest node above it
    return "\n".join(b for n in nodes for b in blocks(n, drop))


_HOST = "coalesce(nullif(lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)', 1)), ''), url, '')"
LIMIT = 4096


def _partial(batches):
    """One wrapper per host for the pages of a task; written out when many hosts came."""
    held: dict[str, list] = {}

    def rows():
        out = pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.string()), pa.array([json.dumps(w) for w in held.values()], pa.string())],
            names=["host", "wrapper"])
        held.clear()
        return out
    for b in batches:
        for c in tu.chunks(b, "html"):
            for host, page in zip(c.column("host").to_pylist(), c.column("html").to_pylist()):
                if page:
                    w = wrapper(parse(page))
                    if host in held:
                        _add(held[host], w)
                    else:
                        held[host] = w
                    if len(held) > LIMIT:
                        yield rows()
    if held:
        yield rows()


def _rules(batches):
    """Folds the partial wrappers of each host (rows in host order) into its rule."""
    host, w = None, None
    for b in batches:
        names, rules = [], []
        for h, text in zip(b.column("host").to_pylist(), b.column("wrapper").to_pylist()):
            new = json.loads(text)
            if h == host:
                _add(w, new)
            else:
                if w is not None:
                    names.append(host)
                    rules.append(_rule(w))
                host, w = h, new
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(rules, pa.string())], ["host", "rule"])
    if w is not None:
        yield pa.RecordBatch.from_arrays([pa.array([host]), pa.array([_rule(w)])], ["host", "rule"])


def _rule(w: list) -> str:
    """The host's rule; without a path where a shortened wrapper shows no main element."""
    path = main_path(w)
    if w[OPT] and not _is_main(path[-1]):
        return json.dumps([[], []])
    return json.dumps([path, fixed_slots(w, path)])


def host_rules(pages: DataFrame) -> DataFrame:
    """(host, rule): main path and template slots of every host's wrapper."""
    return (pages.select(F.expr(_HOST).alias("host"), "html").mapInArrow(_partial, "host string, wrapper string")
            .repartition("host").sortWithinPartitions("host", "wrapper").mapInArrow(_rules, "host string, rule string"))


def extract_pages(pages: DataFrame, id_col: str = "page_id") -> DataFrame:
    """Per page: id, url, text, n_chars (code points)."""
    base = pages.select(F.col(id_col).alias("page"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html")).withColumn("host", F.expr(_HOST))
    both = base.join(host_rules(base), "host", "left").select("page", "url", "html", "rule")
    kind = base.schema["page"].dataType.simpleString()

    def run(batches):
        for b in batches:
            for c in tu.chunks(b, "html"):
                texts = [extract(h, r) for h, r in zip(c.column("html").to_pylist(), c.column("rule").to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [c.column("page"), c.column("url"), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())], ["page", "url", "text", "n_chars"])
    return (both.mapInArrow(run, f"page {kind}, url string, text string, n_chars long")
            .withColumnRenamed("page", id_col))
