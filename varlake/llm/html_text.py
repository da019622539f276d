"""All visible text of web pages, laid out as text.

``parse`` builds the tree: tags that the page leaves out are implied (a list item
ends the one before it, a block ends a paragraph, a cell opens its row), end tags
without a start are passed over, and whatever is open ends with the page.
``render`` walks the tree: elements that are not shown are left out, blocks keep
their spacing, list items get markers and indents, and the cells of a table are
aligned in columns.  Both use loops, not recursion, so any nesting is taken.

No text is left out for its size or depth, only the layout has bounds, so that a
small page can't make a large one: see ``DEEPEST``, ``WIDEST``, ``FARTHEST`` and
``TABLES``.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from varlake.llm.codec import grouped
from varlake.llm.common import arrow_map, ddl, pick, strings, text_or_empty


def _set(names: str) -> frozenset[str]:
    return frozenset(names.split())


#: The element classes of HTML.
VOID = _set("area base br col embed frame hr img input link meta param source track wbr")
RAW = _set("script style xmp iframe noembed noframes")
RAW_WITH_ENTITIES = _set("textarea title")
NOT_SHOWN = _set("head script style template title noscript noembed noframes iframe datalist rp audio video canvas object")
SPACED = _set("p h1 h2 h3 h4 h5 h6 blockquote ul ol dl menu pre listing xmp table figure fieldset")
BLOCKS = SPACED | _set("address article aside body center details dialog dd dir div dt figcaption footer form header hgroup hr html legend li main nav optgroup option search section summary tr caption tbody thead tfoot")
ENDS_PARAGRAPH = _set("address article aside blockquote center details dialog dir div dl dd dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li listing main menu nav ol p plaintext pre search section summary table ul xmp")
HEADINGS = _set("h1 h2 h3 h4 h5 h6")
SECTIONS = _set("tbody thead tfoot")
CELLS = _set("td th")
IN_HEAD = _set("base link meta title style script template noscript head html")
#: What a start tag ends, and the elements beyond which it does not look.
IMPLIED_END = {
    "li": (_set("li"), _set("ul ol menu dir table td th")),
    "dt": (_set("dt dd"), _set("dl table td th")),
    "dd": (_set("dt dd"), _set("dl table td th")),
    "option": (_set("option"), _set("select datalist optgroup")),
    "optgroup": (_set("option optgroup"), _set("select datalist")),
    "rt": (_set("rt rp"), _set("ruby")),
    "rp": (_set("rt rp"), _set("ruby")),
    "td": (CELLS | _set("caption colgroup"), _set("table")),
    "th": (CELLS | _set("caption colgroup"), _set("table")),
    "tr": (_set("tr caption colgroup"), _set("table")),
    "tbody": (SECTIONS | _set("tr caption colgroup"), _set("table")),
    "thead": (SECTIONS | _set("tr caption colgroup"), _set("table")),
    "tfoot": (SECTIONS | _set("tr caption colgroup"), _set("table")),
    "caption": (SECTIONS | _set("tr caption colgroup"), _set("table")),
    "a": (_set("a"), _set("table td th body caption")),
    "button": (_set("button"), _set("table td th body caption")),
}
SHOWN_INPUTS = _set("text search url tel email submit button reset number date time")

SIMPLE_TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9]*)>")
TAG_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
ATTRIBUTE = re.compile(r"""[\s/]*([^\s/>][^\s/>=]*)(?:\s*=\s*(?:"([^"]*)(?:"|\Z)|'([^']*)(?:'|\Z)|([^\s>]*)))?""")
RAW_END = {tag: re.compile(rf"</{tag}(?=[>/ \n\t\r\f]|\Z)", re.I | re.A) for tag in RAW | RAW_WITH_ENTITIES}
CSS_PART = re.compile(r"""/\*.*?(?:\*/|\Z)|<!--|-->|"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*'|url\([^"')]*\)|\\.|[{};]""", re.S)
SCREEN = re.compile(r"(?:only\s+)?(?:all|screen)\Z|\Z", re.I)
DECLARATION = re.compile(r"\s*(display|visibility)\s*:\s*([a-z-]+(?:\s+[a-z-]+)*|var\(.*\))\s*(!\s*important)?\s*\Z", re.I | re.S)
NAME = r"(?:[\w-]|[^\x00-\x7f]|\\.)+"
SELECTOR_PART = re.compile(
    rf"""(?P<tag>\*|{NAME})|(?P<mark>[.#])(?P<name>{NAME})"""
    r"""|\[\s*(?P<attr>[\w-]+)\s*(?:(?P<op>[~|^$*]?=)\s*(?P<value>"[^"]*"|'[^']*'|[^\s\]]+)\s*(?P<case>[isIS])?\s*)?\]"""
    r"""|:not\(\s*(?P<other>[^()]*?)\s*\)|(?P<pseudo>::?[\w-]+)(?:\([^()]*\))?"""
)
COMBINATOR = re.compile(r"\s*([>+~])\s*|\s+")
#: Pseudo-classes that hold of nothing on a page at rest; pseudo-elements begin with two colons.
NOT_AT_REST = _set(":hover :focus :focus-within :focus-visible :active :visited :target :fullscreen :before :after :first-line :first-letter")

class Node:
    __slots__ = ("attrs", "children", "root", "tag", "unseen")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs = tag, attrs
        self.root = False
        self.unseen = False  # by its visibility, which what is in it may change
        self.children: list[Node | str] = []


# ---- tree
def _attributes(page: str, at: int) -> tuple[dict[str, str], int]:
    """The attributes from ``at`` on (the first of a name counts), and the place
    after the tag."""
    attrs: dict[str, str] = {}
    while m := ATTRIBUTE.match(page, at):
        value = next((g for g in m.groups()[1:] if g is not None), "")
        attrs.setdefault(m[1].lower(), html.unescape(value) if "&" in value else value)
        at = m.end()
    end = page.find(">", at)
    return attrs, len(page) if end < 0 else end + 1


def tokens(page: str) -> Iterator[tuple[str, str, dict[str, str]]]:
    """("text", text, {}), ("start", tag, attributes) and ("end", tag, {})."""
    at, size = 0, len(page)
    while at < size:
        lt = page.find("<", at)
        if lt < 0:
            lt = size
        if lt > at:
            yield "text", html.unescape(page[at:lt]) if page.find("&", at, lt) >= 0 else page[at:lt], {}
            at = lt
            continue
        if m := SIMPLE_TAG.match(page, at):
            kind, tag, attrs, at = "end" if m[1] else "start", m[2].lower(), {}, m.end()
        elif m := TAG_NAME.match(page, at):
            kind, tag = "end" if page[at + 1] == "/" else "start", m[1].lower()
            attrs, at = _attributes(page, m.end())
        elif page.startswith("<!--", at):
            if page.startswith(("<!-->", "<!--->"), at):
                at = page.find(">", at) + 1
                continue
            end = re.compile(r"--!?>").search(page, at + 4)
            at = end.end() if end else size
            continue
        elif page.startswith(("<!", "<?", "</"), at):
            end = page.find(">", at)
            at = size if end < 0 else end + 1
            continue
        else:
            yield "text", "<", {}
            at += 1
            continue
        if kind == "end":
            yield kind, tag, {}
            continue
        yield kind, tag, attrs
        if tag == "plaintext":
            yield "text", page[at:], {}
            return
        if tag in RAW or tag in RAW_WITH_ENTITIES:
            m = RAW_END[tag].search(page, at)
            end = m.start() if m else size
            if end > at:
                yield "text", html.unescape(page[at:end]) if tag in RAW_WITH_ENTITIES else page[at:end], {}
            at = end


class Tree:
    """The open elements, from the root on, and how many of each tag."""

    def __init__(self) -> None:
        self.root = Node("html", {})
        self.root.root = True
        self.open = [self.root]
        self.count: dict[str, int] = {}

    def push(self, tag: str, attrs: dict[str, str]) -> None:
        node = Node(tag, attrs)
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.open.append(node)
            self.count[tag] = self.count.get(tag, 0) + 1

    def pop_to(self, depth: int) -> None:
        while len(self.open) > max(1, depth):
            self.count[self.open.pop().tag] -= 1

    def close(self, tags: frozenset[str], beyond: frozenset[str], all_of_them: bool = False) -> bool:
        """Ends the innermost (or outermost) of ``tags`` that is open on this
        side of ``beyond``."""
        if not any(self.count.get(t) for t in tags):
            return False
        depth = -1
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag in tags:
                depth = i
                if not all_of_them:
                    break
            elif self.open[i].tag in beyond:
                break
        if depth > 0:
            self.pop_to(depth)
        return depth > 0

    def start(self, tag: str, attrs: dict[str, str]) -> None:
        if tag in ("html", "body"):
            self.close(_set("head"), frozenset())
            target = self.root
            for k, v in attrs.items():
                target.attrs.setdefault(k, v)
            return
        if tag not in IN_HEAD and self.count.get("head") and not self.count.get("template"):
            self.close(_set("head"), frozenset())
        if tag in ENDS_PARAGRAPH:
            self.close(_set("p"), _set("table td th caption button"))
        if tag in HEADINGS and self.open[-1].tag in HEADINGS:
            self.pop_to(len(self.open) - 1)
        in_table = bool(self.count.get("table"))
        if tag in CELLS or tag == "tr" or tag in SECTIONS or tag in ("caption", "col", "colgroup"):
            if not in_table:
                return
        if rule := IMPLIED_END.get(tag):
            self.close(*rule, all_of_them=tag in ("tr", *SECTIONS, "caption", "optgroup"))
        top = self.open[-1].tag
        if tag in CELLS and top != "tr":
            if top == "table":
                self.push("tbody", {})
            if self.open[-1].tag in SECTIONS:
                self.push("tr", {})
        elif tag == "tr" and top == "table":
            self.push("tbody", {})
        self.push(tag, attrs)

    def end(self, tag: str) -> None:
        if tag in ("html", "body"):
            return
        if tag == "br":
            self.push("br", {})
            return
        if tag == "p" and not self.count.get("p"):
            self.open[-1].children.append(Node("p", {}))
            return
        if tag in HEADINGS:
            self.close(HEADINGS, _set("table td th caption"))
        elif tag in VOID:
            return
        elif tag in CELLS or tag in SECTIONS or tag in ("tr", "table", "caption"):
            self.close(frozenset((tag,)), _set("table") - {tag})
        else:
            self.close(frozenset((tag,)), _set("table td th caption"))


def parse(page: str) -> Node:
    """The tree of a page."""
    tree = Tree()
    for kind, value, attrs in tokens(page.replace("\0", "")):
        if kind == "text":
            if tree.open[-1].tag == "head" and value.strip(" \t\n\r\f"):
                tree.pop_to(len(tree.open) - 1)  # the body begins
            tree.open[-1].children.append(value)
        elif kind == "start":
            tree.start(value, attrs)
        else:
            tree.end(value)
    return tree.root


# ---- what is shown
class Compound:
    """A selector without combinators."""

    def __init__(self) -> None:
        self.tag = ""
        self.ids: set[str] = set()
        self.classes: set[str] = set()
        self.attrs: list[tuple[str, str, str, bool]] = []
        self.others: list[Compound] = []  # of :not()
        self.root = False

    def fits(self, node: Node) -> bool:
        a = node.attrs
        if self.tag and self.tag != node.tag and not (node.root and self.tag == "body") or self.root and not node.root:
            return False
        if self.ids and self.ids != {a.get("id", "")} or self.classes and not self.classes <= set(a.get("class", "").split()):
            return False
        return all(_attribute_fits(a, *x) for x in self.attrs) and not any(x.fits(node) for x in self.others)


def _attribute_fits(attrs: dict[str, str], name: str, op: str, want: str, any_case: bool) -> bool:
    if name not in attrs or not op:
        return name in attrs
    has = attrs[name]
    if any_case:
        has, want = has.lower(), want.lower()
    if op == "=":
        return has == want
    if op == "~=":
        return want in has.split()
    if op == "|=":
        return has == want or has.startswith(want + "-")
    return bool(want) and (has.startswith(want) if op == "^=" else has.endswith(want) if op == "$=" else want in has)


class Selector:
    """``parts``: (combinator before it, compound).  What is not looked at
    (siblings, other pseudo-classes) is left out, and ``exact`` says that
    nothing was: otherwise it fits more than it should."""

    __slots__ = ("exact", "parts", "specificity")

    def __init__(self) -> None:
        self.parts: list[tuple[str, Compound]] = []
        self.specificity = (0, 0, 0)
        self.exact = True

    def fits(self, node: Node, above: list[tuple[Node, Iterator]]) -> bool:
        todo = [(len(self.parts) - 1, node, len(above))]
        seen = set()
        while todo:
            at, node, depth = todo.pop()
            combinator, compound = self.parts[at]
            if not compound.fits(node):
                continue
            if at == 0:
                return True
            depths = [max(0, depth - 1)] if combinator == ">" else range(depth) if depth else [0]  # the root is html and body
            for d in depths:
                if (at, d) not in seen:
                    seen.add((at, d))
                    todo.append((at - 1, above[d][0], d))
        return False


def _selector(text: str) -> Selector | None:
    """None if it is not understood, or fits nothing on a page at rest."""
    out, compound, combinator, at = Selector(), Compound(), "", 0
    ids = classes = tags = 0
    start = 0
    while at < len(text):
        if m := COMBINATOR.match(text, at):
            if at == start:
                return None
            if (m[1] or " ") in "+~":
                out.exact = False
            else:
                out.parts.append((combinator, compound))
                combinator = m[1] or " "
            compound, start = Compound(), m.end()
        elif (m := SELECTOR_PART.match(text, at)) and m.end() > at and not (m["tag"] and at > start):
            if m["tag"]:
                if m["tag"] != "*":
                    compound.tag, tags = m["tag"].lower(), tags + 1
            elif m["mark"]:
                name = re.sub(r"\\(.)", r"\1", m["name"])
                if m["mark"] == "#":
                    compound.ids.add(name)
                    ids += 1
                else:
                    compound.classes.add(name)
                    classes += 1
            elif m["attr"]:
                value = m["value"] or ""
                compound.attrs.append((m["attr"].lower(), m["op"] or "", value[1:-1] if value[:1] in ("'", '"') else value, (m["case"] or "").lower() == "i" or m["attr"].lower() == "type"))
                classes += 1
            elif m["pseudo"]:
                name = m["pseudo"].lower()
                if name.startswith("::") or name in NOT_AT_REST:
                    return None
                classes += 1
                if name == ":root":
                    compound.root = True
                else:
                    out.exact = False
            else:
                other = _selector(m["other"])
                if other and other.exact and len(other.parts) == 1:
                    compound.others.append(other.parts[0][1])
                    i, c, t = other.specificity
                    ids, classes, tags = ids + i, classes + c, tags + t
                elif not (m["other"].startswith(":") and m["other"].lower() in NOT_AT_REST):
                    out.exact = False
        else:
            return None
        at = m.end()
    if at == start:
        return None
    out.parts.append((combinator, compound))
    out.specificity = (ids, classes, tags)
    return out


def _declared(declarations: Iterable[str]) -> dict[str, tuple[bool, str]]:
    """(important, value) of display and visibility, the last that counts."""
    out: dict[str, tuple[bool, str]] = {}
    for text in declarations:
        if m := DECLARATION.match(text):
            name, new = m[1].lower(), (bool(m[3]), m[2].lower())
            if name not in out or new[0] >= out[name][0]:
                out[name] = new
    return out


def on_screen(media: str) -> bool:
    """Whether a list of media holds on any screen, without conditions."""
    return any(SCREEN.match(x.strip()) for x in media.split(","))


def _blocks(sheet: str) -> Iterator[tuple[str, dict[str, tuple[bool, str]], bool]]:
    """(selectors, what they declare, whether outside layers) of the rules that
    hold on any screen."""
    text: list[str] = []
    inside: list[tuple[str, str]] = []  # open blocks: kind and selectors
    declarations: list[str] = []
    at = 0

    def ended(kind: str, selectors: str) -> Iterator[tuple[str, dict[str, tuple[bool, str]], bool]]:
        if kind == "rule" and (found := _declared(declarations)):
            yield selectors, found, all(k != "layer" for k, _ in inside)

    for m in [*CSS_PART.finditer(sheet), None]:
        text.append(sheet[at : m.start() if m else len(sheet)])
        part, at = (m[0], m.end()) if m else ("", len(sheet))
        if part == "{":
            head = "".join(text).strip()
            name = re.match(r"@?[\w-]*", head)[0].lower()
            rest = head[len(name) :]
            outer = inside[-1][0] if inside else "sheet"
            if outer in ("rule", "skip"):
                kind = "skip"
            elif not head.startswith("@"):
                kind, declarations = "rule", []
            elif name == "@media":
                kind = "media" if on_screen(rest) else "skip"
            elif name == "@supports":
                kind = "skip" if rest.strip().lower().startswith("not") else "media"
            else:
                kind = "layer" if name == "@layer" else "skip"
            inside.append((kind, head))
            text = []
        elif part in (";", "}"):
            if inside and inside[-1][0] == "rule":
                declarations.append("".join(text))
            if part == "}" and inside:
                yield from ended(*inside.pop())
            text = []
        else:
            text.append(" " if part.startswith(("/*", "<!--", "-->")) else part)
    if inside and inside[-1][0] == "rule":
        declarations.append("".join(text))
    while inside:
        yield from ended(*inside.pop())


class Styles:
    """What a page's style sheets say of display and visibility, by what the last
    compound of a selector asks for."""

    def __init__(self, root: Node):
        self.rules: dict[str, list[tuple[Selector, tuple, dict[str, tuple[bool, str]]]]] = {}
        order = 0
        todo = [root]
        sheets = []
        while todo:
            node = todo.pop()
            if node.tag == "style":
                if on_screen(node.attrs.get("media", "")) and node.attrs.get("type", "").strip().lower() in ("", "text/css"):
                    sheets.append("".join(c for c in node.children if isinstance(c, str)))
            elif node.tag not in ("noscript", "template"):
                todo += [c for c in reversed(node.children) if isinstance(c, Node)]
        for sheet in sheets:
            for selectors, declared, unlayered in _blocks(sheet):
                order += 1
                for text in re.split(r",(?![^(\[]*[)\]])", selectors):
                    if selector := _selector(text.strip()):
                        last = selector.parts[-1][1]
                        key = "#" + min(last.ids) if last.ids else "." + min(last.classes) if last.classes else last.tag
                        self.rules.setdefault(key, []).append((selector, (unlayered, selector.specificity, order), declared))

    def of(self, node: Node, above: list[tuple[Node, Iterator]]) -> dict[str, str]:
        """The winning values for an element."""
        a = node.attrs
        found: dict[str, tuple[tuple, str]] = {}
        if "style" in a:
            found = {name: ((important, True), value) for name, (important, value) in _declared(a["style"].split(";")).items()}
        if self.rules:
            keys = ["", node.tag]
            if a:
                keys += ["#" + a.get("id", ""), *("." + c for c in set(a.get("class", "").split()))]
            for key in keys:
                for selector, rank, declared in self.rules.get(key, ()):
                    if selector.fits(node, above):
                        for name, (important, value) in declared.items():
                            hides = value == "none" or value in ("hidden", "collapse")
                            if (selector.exact or not hides) and (name not in found or (important, False, *rank) >= found[name][0]):
                                found[name] = (important, False, *rank), value
        return {name: value for name, (_, value) in found.items()}


def hidden(node: Node, styles: dict[str, str]) -> bool:
    """Whether an element is left out with all in it."""
    a = node.attrs
    if node.tag in NOT_SHOWN or node.tag == "input" and a.get("type", "").lower() == "hidden":
        return True
    if "display" in styles:
        return styles["display"] == "none"
    return "hidden" in a or node.tag == "dialog" and "open" not in a


# ---- layout
DEEPEST = 200  #: characters; lists nested deeper are indented no further
WIDEST = 200  #: characters; longer cells don't widen their column
TABLES = 20  #: tables nested deeper are laid out as blocks, a cell below the other
FARTHEST = 1_000  #: characters; columns that would begin farther right are not aligned


class Flow:
    """Text that is being laid out: white space collapses, and breaks between
    blocks are at most as large as the largest that is asked for.  Each line gets
    the indent of the list items that are open where it begins."""

    def __init__(self) -> None:
        self.parts: list[str] = []
        self.breaks = 0  # newlines that the next text begins with
        self.space = False  # so does a space
        self.fresh = True  # no text yet, here or in the innermost open item
        self.lead = ""  # what comes before the first text: the break before the open items, and their markers
        self.indent = ""
        self.items: list[tuple[int, bool, bool, str, str]] = []

    def open_item(self, marker: str) -> None:
        self.items.append((self.breaks, self.space, self.fresh, self.lead, self.indent))
        if not self.fresh:
            self.lead = "\n" * max(self.breaks, 1) + self.indent
        self.lead += marker
        if len(self.indent) + len(marker) <= DEEPEST:
            self.indent += " " * len(marker)
        self.breaks, self.space, self.fresh = 0, False, True

    def close_item(self) -> None:
        """An item without text leaves no trace."""
        breaks, space, fresh, lead, self.indent = self.items.pop()
        if self.fresh:
            self.breaks, self.space, self.fresh, self.lead = breaks, space, fresh, lead
        else:
            self.breaks, self.space = 1, False

    def add(self, text: str, as_is: bool = False) -> None:
        if not as_is:
            words = text.split()
            if not words:
                self.space = self.space or bool(text)
                return
            lead, trail = text[0].isspace(), text[-1].isspace()
            text = " ".join(words)
        else:
            lead = trail = False
            if not text:
                return
            if self.indent:
                text = text.replace("\n", "\n" + self.indent)
        if self.fresh:
            self.parts.append(self.lead)
        else:
            self.parts.append("\n" * self.breaks + self.indent if self.breaks else " " if self.space or lead else "")
        self.parts.append(text)
        self.breaks, self.space, self.fresh, self.lead = 0, trail, False, ""

    def block(self, text: str, size: int) -> None:
        if text:
            self.break_(size)
            self.add(text, as_is=True)
            self.break_(size)

    def break_(self, size: int) -> None:
        self.breaks, self.space = max(self.breaks, size), False

    def line(self) -> None:
        """A line break within text: each one counts."""
        if not self.fresh:
            self.breaks, self.space = self.breaks + 1, False

    def text(self) -> str:
        return "".join(self.parts)


def _number(value: str | None, default: int) -> int:
    try:
        return int((value or "").strip() or default)
    except ValueError:
        return default


class Grid:
    """A table's cells that have text, row by row, and the places that cells of
    earlier rows reach down to, as ranges of columns."""

    def __init__(self) -> None:
        self.rows: list[list[tuple[int, str, bool]]] = []  # column, text, whether it is set to the right
        self.spans: list[tuple[int, int, int]] = []  # from column, to column, last row; by column
        self.held: list[tuple[int, int, int]] = []  # those that begin in the present row
        self.column = self.passed = 0  # the next column of the row, and how many spans lie before it
        self.caption = ""

    def row(self) -> None:
        last = len(self.rows)
        self.rows.append([])
        self.column = self.passed = 0
        if self.held or self.spans:
            live: list[tuple[int, int, int]] = []
            for span in sorted(s for s in self.spans + self.held if s[2] >= last):
                if live and live[-1][1] == span[0] and live[-1][2] == span[2]:
                    live[-1] = live[-1][0], span[1], span[2]
                else:
                    live.append(span)
            self.spans, self.held = live, []

    def cell(self, text: str, node: Node) -> None:
        if not self.rows:
            self.row()
        while self.passed < len(self.spans) and self.spans[self.passed][0] <= self.column:
            self.column = max(self.column, self.spans[self.passed][1])
            self.passed += 1
        wide = min(1_000, max(1, _number(node.attrs.get("colspan"), 1)))
        down = min(1_000, _number(node.attrs.get("rowspan"), 1))
        if text:
            right = "right" in (node.attrs.get("align", "") + node.attrs.get("style", "")).lower().split("align")[-1][:12]
            self.rows[-1].append((self.column, text, right))
        if down > 1:
            self.held.append((self.column, self.column + wide, len(self.rows) + down - 2))
        self.column += wide

    def text(self) -> str:
        """The rows in lines.  Text is never cut: a cell that is longer than its
        column, or lies in one too far right to align, follows after two spaces."""
        out = [self.caption] if self.caption else []
        widths: dict[int, int] = {}
        for row in self.rows:
            for c, text, _ in row:
                widths[c] = max(widths.get(c, 1), max((n for n in map(len, text.split("\n")) if n <= WIDEST), default=1))
        if len(widths) == 1:  # a table for the layout only
            (width,) = widths.values()
            for row in self.rows:
                for _, text, right in row:
                    out.append("\n".join(t.rjust(width) for t in text.split("\n")) if right else text)
            return "\n".join(out)
        begins, at = {}, 0
        for c in sorted(widths):
            begins[c] = at
            at += widths[c] + 2
        for row in self.rows:
            cells = [(c, text.split("\n"), right) for c, text, right in row]
            for i in range(max((len(lines) for _, lines, _ in cells), default=0)):
                line, size = [], 0
                for c, lines, right in cells:
                    s = lines[i] if i < len(lines) else ""
                    if not s:
                        continue
                    gap = 2 if size else 0
                    if begins[c] <= FARTHEST:
                        gap = max(gap, begins[c] + (max(0, widths[c] - len(s)) if right else 0) - size)
                    line += [" " * gap, s]
                    size += gap + len(s)
                out.append("".join(line))
        return "\n".join(out)


def _shown_children(node: Node) -> list[Node | str]:
    if node.tag == "details" and "open" not in node.attrs:
        return [c for c in node.children if isinstance(c, Node) and c.tag == "summary"][:1]
    if node.tag == "select":
        options = [o for c in node.children if isinstance(c, Node) for o in ([c] if c.tag == "option" else c.children) if isinstance(o, Node) and o.tag == "option"]
        return [o for o in options if "selected" in o.attrs][:1] or options[:1]
    return node.children


def render(root: Node) -> str:
    """The text of a tree, laid out."""
    styles = Styles(root)
    flows = [Flow()]  # the innermost takes the text
    grids: list[Grid] = []
    lists: list[list] = []  # [ordered, next number]
    pre = deep = 0  # open elements that keep white space; open tables beyond TABLES
    stack: list[tuple[Node, Iterator]] = []

    def enter(node: Node) -> None:
        nonlocal pre, deep
        tag, flow = node.tag, flows[-1]
        if tag == "br":
            if not node.unseen:
                flow.line()
            return
        if tag == "input":
            if not node.unseen and node.attrs.get("type", "text").lower() in SHOWN_INPUTS:
                flow.add(f" {node.attrs.get('value', '')} ")
            return
        if tag in ("ul", "ol", "menu", "dir"):
            flow.break_(1 if lists else 2)
            lists.append([tag == "ol", _number(node.attrs.get("start"), 1)])
        elif tag == "table" and len(grids) < TABLES:
            grids.append(Grid())
        elif tag == "table" or deep and tag in CELLS:
            deep += tag == "table"
            flow.break_(1)
        elif tag == "tr" and grids and not deep:
            grids[-1].row()
        elif tag in BLOCKS:
            flow.break_(2 if tag in SPACED else 1)
        if tag == "li":
            marker = "- "
            if lists and lists[-1][0]:
                number = _number(node.attrs.get("value"), lists[-1][1])
                marker, lists[-1][1] = f"{number}. ", number + 1
            flow.open_item(marker)
        elif (tag == "caption" or tag in CELLS) and not deep:
            flows.append(Flow())
        if tag in ("pre", "textarea", "listing", "xmp"):
            pre += 1
        stack.append((node, iter(_shown_children(node))))

    def leave(node: Node) -> None:
        nonlocal pre, deep
        tag = node.tag
        if tag in ("pre", "textarea", "listing", "xmp"):
            pre -= 1
        if tag == "li":
            flows[-1].close_item()
        elif deep and (tag in ("table", "caption") or tag in CELLS):
            deep -= tag == "table"
            flows[-1].break_(1)
        elif tag == "caption":
            text = flows.pop().text()
            if grids:
                grids[-1].caption = text
        elif tag in CELLS:
            grids[-1].cell(flows.pop().text(), node)
        elif tag == "table":
            flows[-1].block(grids.pop().text(), 2)
        elif tag in ("ul", "ol", "menu", "dir"):
            lists.pop()
            flows[-1].break_(1 if lists else 2)
        elif tag in BLOCKS and tag not in SECTIONS and tag != "tr":
            flows[-1].break_(2 if tag in SPACED else 1)

    enter(root)
    while stack:
        node, rest = stack[-1]
        child = next(rest, None)
        if child is None:
            stack.pop()
            leave(node)
        elif isinstance(child, str):
            if node.unseen:
                continue
            if pre:
                text = child.replace("\r\n", "\n").replace("\r", "\n")
                if child is node.children[0] and node.tag in ("pre", "textarea", "listing"):
                    text = text.removeprefix("\n")
                flows[-1].add(text, as_is=True)
            else:
                flows[-1].add(child)
        else:
            own = styles.of(child, stack) if styles.rules or child.attrs else {}
            if not hidden(child, own):
                value = own.get("visibility", "inherit")
                child.unseen = node.unseen if value in ("inherit", "unset") else value in ("hidden", "collapse")
                enter(child)
    return "\n".join(line.rstrip() for line in flows[0].text().split("\n")).strip("\n")


def html_to_text(page: str) -> str:
    return render(parse(page))


def extract_text(df: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(id, text): the visible text of each page, extracted where the page is
    read.  Null and empty pages have an empty text; repeated rows repeat; further
    columns are ignored; an empty table gives no rows."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for group in grouped(strings(batch.column(1))):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(group)), pa.array([html_to_text(p) for p in group], pa.string())], ["key", "text"])
                at += len(group)

    rows = pick(df, key=id_col, page=html_col)
    rows = rows.select("key", text_or_empty(rows.page).alias("page"))
    return arrow_map(rows, run, f"key {ddl(rows, 'key')}, text string").toDF(id_col, "text")
