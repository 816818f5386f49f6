"""Main text of pages through wrappers: union-free regular expressions of a host's markup."""

from __future__ import annotations

import html as entities
import json
import re
from difflib import SequenceMatcher
from hashlib import sha256

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlake.llm.batches import quoted
from bazaarlake.llm.reputation import url_host
from bazaarlake.session import write_and_read

# Fixed values of HTML and of common markup.
VOID = set("area base br col embed hr img input link meta source track wbr".split())
INLINE = set("a abbr b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s "
             "samp small span strike strong sub sup time tt u var wbr br".split())
CLOSES_P = set("address article aside blockquote details div dl fieldset figure footer form h1 h2 "
               "h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
NO_TEXT = set("head title nav header footer aside form script style noscript template iframe svg "
              "button select textarea menu dialog".split())
NO_TEXT_ROLES = set("navigation banner contentinfo complementary search alert alertdialog dialog "
                    "form menu menubar".split())
NO_TEXT_NAMES = set(
    "nav navbar navigation menu breadcrumb breadcrumbs header masthead footer sidebar aside notice "
    "notices cookie cookies consent banner alert promo ad ads advert adverts advertisement "
    "sponsor sponsored comment comments disqus respond".split())
ROOTS = ("article", "main")
HOLDERS = {*ROOTS, *"html body div section header footer aside nav form table figure details".split()}
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
TEMPLATE_PAGES = 3  # a slot equal on so many distinct pages belongs to the template

LONGEST_REPEAT = 16  # tokens of a repeated group found in one page
SALTS = 32  # partial wrappers of a host are merged in so many groups, then once more
_PIECE = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(script|style|noscript|template|textarea|title)\b(?:[^>"']++|"[^"]*+"|"""
    r"""'[^']*+')*+>.*?(?:</\1\s*>|\Z)|<[/!?A-Za-z](?:[^>"']++|"[^"]*+"|'[^']*+')*+>"""
    r"""|<[/!?A-Za-z][^>]*>|<[/!?A-Za-z][^>]*\Z""", re.S | re.I)
_NAME = re.compile(r"</?\s*([A-Za-z][\w:-]*)")
_ATTRIBUTE = re.compile(r"""\s(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_SPLIT = re.compile(r"[^a-z0-9]+")


def tokens(page: str):
    """(tag or None, name, text) in page order; hidden parts are left out.

    A tag is its name with class, id and role, a closing tag has a slash in front.
    """
    at = 0
    for piece in _PIECE.finditer(page):
        if piece.start() > at:
            yield None, "", page[at:piece.start()]
        at = piece.end()
        raw = piece.group()
        name = _NAME.match(raw)
        if not name or piece.group(1):
            continue
        name = name.group(1).lower()
        if raw[1] == "/":
            yield "/" + name, name, ""
        else:
            marks = sorted((k.lower(), (a or b or c).lower())
                           for k, a, b, c in _ATTRIBUTE.findall(raw))
            yield name + "".join(f"[{k}={v}]" for k, v in marks), name, ""
    if at < len(page):
        yield None, "", page[at:]


def hides(tag: str, name: str) -> bool:
    """Whether an element holds no article text: menus, notices, adverts, forms and the like."""
    if name in NO_TEXT:
        return True
    if "[" not in tag or name in ("html", "body", "article", "main") or re.match("h[1-6]$", name):
        return "[role=" in tag and any(f"[role={r}]" in tag for r in NO_TEXT_ROLES) or (
            name == "article" and "comment" in _SPLIT.split(tag))
    for kind, value in re.findall(r"\[(\w+)=([^\]]*)\]", tag):
        names = NO_TEXT_ROLES if kind == "role" else NO_TEXT_NAMES
        if names.intersection(_SPLIT.split(value)):
            return True
    return False


class Walk:
    """Open elements along a token stream, with the text's context at each point."""

    def __init__(self):
        self.open: list[tuple[str, str, bool]] = []

    def step(self, tag: str, name: str) -> None:
        if tag.startswith("/"):
            for i in range(len(self.open) - 1, -1, -1):
                if self.open[i][1] == name:
                    del self.open[i:]
                    break
            return
        if name in CLOSES_P:
            self._close("p", CLOSES_P - {"p"})
        elif name in ("li", "dt", "dd", "tr", "td", "th", "option"):
            self._close(name, {"ul", "ol", "dl", "table", "select"})
        if name not in VOID:
            self.open.append((tag, name, hides(tag, name)))

    def _close(self, name: str, within: set[str]) -> None:
        """End an open ``name`` as its successor does, but not beyond its container."""
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][1] == name:
                del self.open[i:]
                return
            if self.open[i][1] in within:
                return

    @property
    def hidden(self) -> bool:
        return any(h for *_, h in self.open)

    def context(self) -> str:
        """The block elements around the text; those inside an article or main need no more."""
        names = [name for _, name, _ in self.open]
        for root in ROOTS:
            if root in names:
                return root
        return " ".join(t for t, name, _ in self.open if name not in INLINE and name != "p")


# A wrapper is a list of tokens and groups; a group is ["?", items] or ["+", items].


def fold(items: list) -> list:
    """Neighbours that repeat become one repeated group, shortest repeats first."""
    out: list = []
    for item in items:
        out.append(item)
        again = True
        while again:
            again = False
            for n in range(1, min(LONGEST_REPEAT, len(out) - 1) + 1):
                before = out[-n - 1]
                if isinstance(before, list) and before[0] == "+" and before[1] == out[-n:]:
                    del out[-n:]
                    again = True
                elif before == out[-1] and out[-2 * n:-n] == out[-n:]:
                    tail = out[-n:]
                    del out[-2 * n:]
                    group = tail[0] if n == 1 and isinstance(tail[0], list) and tail[
                        0][0] == "+" else ["+", tail]
                    out.append(group)
                    again = True
                if again:
                    break
    return out


def _key(item) -> str:
    """What two items must share to be aligned: the token, or a group's first token."""
    while isinstance(item, list):
        item = item[1][0]
    return item


def _optional(items: list) -> list:
    if not items:
        return []
    if len(items) == 1 and isinstance(items[0], list) and items[0][0] == "?":
        return items
    return [["?", items]]


def align(one: list, two: list) -> list:
    """A wrapper that covers both: mismatches become optional or repeated groups."""
    if one == two:
        return one
    out: list = []
    matcher = SequenceMatcher(None, [_key(x) for x in one], [_key(x) for x in two], autojunk=False)
    for what, i, j, k, m in matcher.get_opcodes():
        if what != "equal":
            out += _optional(one[i:j]) + _optional(two[k:m])
            continue
        for x, y in zip(one[i:j], two[k:m]):
            if x == y:
                out.append(x)
            elif not isinstance(x, list) or not isinstance(y, list):
                group, single = (x, y) if isinstance(x, list) else (y, x)
                out.append([group[0], align(group[1], [single])])
            elif x[0] == y[0]:
                out.append([x[0], align(x[1], y[1])])
            else:
                repeated, other = (x, y) if x[0] == "+" else (y, x)
                out += _optional([["+", align(repeated[1], other[1])]])
    return tidy(_absorb(fold(out)))


def _absorb(items: list) -> list:
    """``(X)? (X)+``, ``(X)+ (X)?`` and the like become ``(X)+``."""
    out: list = []
    for item in items:
        last = out[-1] if out else None
        if isinstance(item, list) and isinstance(last, list) and item[1] == last[1]:
            out[-1] = ["+" if "+" in (item[0], last[0]) else "?", item[1]]
        else:
            out.append(item)
    return out


def _depth(item) -> int:
    return 1 + max(map(_depth, item[1])) if isinstance(item, list) else 0


def _tokens_of(item) -> list[str]:
    return [t for x in item[1] for t in _tokens_of(x)] if isinstance(item, list) else [item]


def tidy(items: list) -> list:
    """Runs of three or more groups, and deeply nested ones, become ``((a)? (b)? ..)+``.

    So a wrapper grows with the number of its distinct tokens, not with its pages.
    """
    out: list = []
    run: list = []
    for item in [*items, None]:
        if isinstance(item, list):
            run.append(item)
            continue
        if len(run) > 2 or any(_depth(x) > 2 for x in run):
            names = dict.fromkeys(t for x in run for t in _tokens_of(x))
            run = [["+", [["?", [t]] for t in names]]]
        out += run
        run = []
        if item is not None:
            out.append(item)
    return out


def shown(items: list) -> str:
    """The wrapper as a regular expression over tags, ``#`` standing for text slots."""
    return " ".join(f"({shown(x[1])}){x[0]}" if isinstance(x, list) else
                    x if x == "#" else f"<{x}>" for x in items)


class Wrapper:
    """What the pages of one host share, merged page by page or part by part."""

    def __init__(self):
        self.items: list | None = None
        self.seen: set[str] = set()
        # context: characters, pages, the text's digest if the same on every page, else None
        self.slots: dict[str, list] = {}

    def add_page(self, page: str) -> None:
        """Align one more page. A page gives the token ``#`` for each text, shown or hidden."""
        walk, stream, texts = Walk(), [], {}
        for tag, name, text in tokens(page):
            if tag:
                walk.step(tag, name)
                stream.append(tag)
            elif text.strip():
                stream.append("#")
                if not walk.hidden:
                    texts[walk.context()] = texts.get(walk.context(), "") + text.strip()
        items = tidy(fold(stream))
        if (key := repr(items)) not in self.seen:
            self.seen.add(key)
            self._align(items)
        for context, text in texts.items():
            self._slot(context, len(text), 1, _digest(text))

    def add_part(self, part: str) -> None:
        items, slots = json.loads(part)
        self._align(items)
        for context, values in slots.items():
            self._slot(context, *values)

    def _align(self, items: list) -> None:
        self.items = items if self.items is None else align(self.items, items)

    def _slot(self, context: str, chars: int, pages: int, text: str | None) -> None:
        if context not in self.slots:
            self.slots[context] = [chars, pages, text]
            return
        slot = self.slots[context]
        slot[0] += chars
        slot[1] += pages
        slot[2] = slot[2] if slot[2] == text else None

    def part(self) -> str:
        return json.dumps([self.items or [], self.slots], sort_keys=True)

    def roots(self) -> list[str]:
        """Contexts that may hold main text: articles, and slots that vary between pages.

        A text that is the same on all of three or more pages belongs to the template.
        """
        return sorted(c for c, (_, pages, text) in self.slots.items()
                      if c in ROOTS or text is None or pages < 3)


def _digest(text: str) -> str:
    return sha256(text.encode(errors="surrogatepass")).hexdigest()[:32]


class Matcher:
    """A wrapper as an automaton whose states are the places of its tokens.

    ``follow[p]`` has a bit for each place that may come after place p, so one page is
    matched in one pass forward and one back, without trying alternatives.
    """

    def __init__(self, items: list):
        self.names: list[str] = []
        self.follow: list[int] = []
        self.first, self.last, self.empty = self._sequence(items)
        self.places: dict[str, int] = {}
        for place, name in enumerate(self.names):
            self.places[name] = self.places.get(name, 0) | 1 << place

    def _sequence(self, items: list) -> tuple[int, int, bool]:
        first, last, empty = 0, 0, True
        for item in items:
            if isinstance(item, list):
                f, e, none = self._sequence(item[1])
                if item[0] == "+":
                    self._connect(e, f)
                none = none or item[0] == "?"
            else:
                f = e = 1 << len(self.names)
                none = False
                self.names.append(item)
                self.follow.append(0)
            self._connect(last, f)
            first |= f if empty else 0
            last = e | last if none else e
            empty = empty and none
        return first, last, empty

    def _connect(self, sources: int, targets: int) -> None:
        while sources:
            low = sources & -sources
            self.follow[low.bit_length() - 1] |= targets
            sources ^= low

    def match(self, stream: list[str]) -> list[int] | None:
        """The place of each token, the earliest that fit; None if the page is not covered."""
        reached, after = [], self.first
        for name in stream:
            here = after & self.places.get(name, 0)
            if not here:
                return None
            reached.append(here)
            after = 0
            while here:
                low = here & -here
                after |= self.follow[low.bit_length() - 1]
                here ^= low
        found: list[int] = []
        allowed = self.last
        for here in reversed(reached):
            here &= allowed if not found else here
            if found:
                following = 1 << found[-1]
                while here and not self.follow[(here & -here).bit_length() - 1] & following:
                    here &= here - 1
            if not here:
                return None
            found.append((here & -here).bit_length() - 1)
        return found[::-1]


def slot_texts(page: str | None, matcher: Matcher | None):
    """(slot, root, token, text) of each token of a page, slot and root of hidden text None.

    A slot is the place, in the host's wrapper, of the innermost element that can hold a
    part of its own (one with class, id or role, or a div, section and the like) around
    the text; its paragraphs, headings and lists vary together. Where the wrapper does
    not cover a page the slot is -1.
    """
    stream = list(tokens(page or ""))
    names = [tag or "#" for tag, _, text in stream if tag or text.strip()]
    places = iter((matcher.match(names) if matcher else None) or [-1] * len(names))
    walk, slots = Walk(), []
    for tag, name, text in stream:
        if tag is None:
            if text.strip():
                next(places)
            if walk.hidden:
                yield None, None, "#", text
            else:
                inside = [n for _, n, _ in walk.open]
                root = next((r for r in ROOTS if r in inside), "")
                yield slots[-1] if slots else (-1, ""), root, "#", text
            continue
        place = next(places)
        walk.step(tag, name)
        opened = not tag.startswith("/") and name not in VOID
        del slots[len(walk.open) - opened if opened else len(walk.open):]
        if opened:
            holds = name in HOLDERS or "[" in tag and name not in INLINE | HEADINGS
            slots.append((place, name) if holds or not slots else slots[-1])
        yield None, None, tag, name


def page_slots(page: str | None, matcher: Matcher | None) -> tuple[str, dict[int, str]]:
    """Digest of all shown text of a page, and of its text in each slot."""
    held: dict[int, list[str]] = {}
    shown_text = []
    for slot, _, token, text in slot_texts(page, matcher):
        if token == "#" and slot and text.strip():
            shown_text.append(" ".join(text.split()))
            if slot[0] >= 0 and slot[1] not in ROOTS:
                held.setdefault(slot[0], []).append(shown_text[-1])
    return _digest("\n".join(shown_text)), {k: _digest("\n".join(v)) for k, v in held.items()}


def merge_parts(frame: pd.DataFrame) -> Wrapper:
    wrapper = Wrapper()
    for part in sorted(frame["part"]):
        wrapper.add_part(part)
    return wrapper


def infer_wrappers(pages: DataFrame, url: str, html: str) -> DataFrame:
    """(host, pattern, items) for each host: the wrapper to read and, as JSON, to match.

    Tasks merge the pages they hold into one part per host; parts that are equal meet in
    a map-side aggregate; the rest are merged in ``SALTS`` groups per host and then
    once more. So a host with a third of all pages costs no task more than its share.
    """
    def local(frames):
        found: dict[str, Wrapper] = {}
        for frame in frames:
            for host, page in zip(frame["host"], frame["html"]):
                found.setdefault(host, Wrapper()).add_page(page)
        yield pd.DataFrame({"host": list(found), "part": [w.part() for w in found.values()]},
                           dtype=object)

    def again(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"host": frame["host"].iloc[:1], "part": [merge_parts(frame).part()]})

    def finish(frame: pd.DataFrame) -> pd.DataFrame:
        wrapper = merge_parts(frame)
        return pd.DataFrame({"host": frame["host"].iloc[:1], "pattern": [
            shown(wrapper.items or [])], "items": [json.dumps(wrapper.items or [])]})

    parts = pages.select(url_host(F.col(quoted(url)).cast("string")).alias("host"),
                         F.col(quoted(html)).cast("string").alias("html")).filter(
        "html IS NOT NULL").mapInPandas(local, "host string, part string").distinct()
    parts = parts.withColumn("salt", F.pmod(F.xxhash64("part"), F.lit(SALTS))).groupBy(
        "host", "salt").applyInPandas(again, "host string, part string")
    return parts.groupBy("host").applyInPandas(
        finish, "host string, pattern string, items string")


def main_text(page: str | None, roots: list[str] | None, matcher: Matcher | None = None,
              template: set[int] | None = None) -> str:
    """The page's blocks in its article, else in main, else elsewhere.

    With ``template``, the wrapper's slots that are equal on all pages, text in those is
    left out; without it, text outside the root contexts is.
    """
    if not page:
        return ""
    walk, block = Walk(), []
    inside = set(roots or ())
    found: dict[str, list[str]] = {root: [] for root in (*ROOTS, "")}
    place = ""

    def end() -> None:
        text = " ".join(entities.unescape("".join(block)).split())
        if text:
            found[place].append(text)
        block.clear()

    for slot, root, token, text in slot_texts(page, matcher):
        if token == "#":
            taken = slot is not None and (
                walk.context() in inside if template is None else slot[0] not in template)
            if taken:
                place = root
                block.append(text)
            continue
        if text == "br":
            block.append(" ")
        elif text not in INLINE:
            end()
        if template is None:
            walk.step(token, text)
    end()
    return "\n\n".join(next(filter(None, found.values()), []))


def extract_main_text(pages: DataFrame, url: str, html: str) -> DataFrame:
    """``pages`` with ``text`` and ``n_chars`` (code points) in place of the html column.

    Each host's pages are aligned to a wrapper and matched against it. A slot of it whose
    text is equal on all of ``TEMPLATE_PAGES`` or more distinct pages (pages that show
    the same text count once) is template; the direct text of an article or main is not.
    Of the other slots, those outside menus, headers, footers, sidebars, notices,
    adverts, forms, scripts, styles and reader comments that lie in the article (else in
    main, else anywhere) are the main text.
    Character references are decoded, white space in a block becomes one space, blocks
    are joined by an empty line. A null or empty page has the empty text; pages with a
    null url form one group with those without a host; broken and cut markup is read
    as far as it goes; equal pages get equal texts; input columns ``text`` and
    ``n_chars`` are replaced.
    """
    kept = [c for c in pages.columns if c.lower() not in ("text", "n_chars", html.lower())]
    wrappers = write_and_read(infer_wrappers(pages, url, html).select(
        F.col("host").alias("__host"), F.col("items").alias("__items")), "wrappers")
    source = pages.select(*[F.col(quoted(c)) for c in kept],
                          F.col(quoted(html)).cast("string").alias("__html"),
                          url_host(F.col(quoted(url)).cast("string")).alias("__at"))

    def matchers():
        known: dict[str, Matcher] = {}

        def get(items: str | None) -> Matcher | None:
            if items is not None and items not in known:
                if len(known) > 1000:
                    known.clear()
                known[items] = Matcher(json.loads(items))
            return known.get(items)

        return get

    def slots(frames):
        get = matchers()
        for frame in frames:
            rows = []
            for host, page, items in zip(frame["__host"], frame["__html"], frame["__items"]):
                shows, held = page_slots(page, get(items))
                rows += [(host, shows, slot, text) for slot, text in held.items()]
            yield pd.DataFrame(rows, columns=["host", "page", "slot", "text"])

    # Rows are distinct before they are counted per slot, so a hot host is summed up map-side.
    template = source.select("__at", "__html").filter("__html IS NOT NULL").join(
        wrappers, F.col("__at") == F.col("__host")).select("__host", "__html", "__items").mapInPandas(
        slots, "host string, page string, slot long, text string").distinct().groupBy(
        "host", "slot").agg(F.count(F.lit(1)).alias("pages"), F.min("text").alias("least"),
                            F.max("text").alias("most")).filter(
        (F.col("pages") >= TEMPLATE_PAGES) & (F.col("least") == F.col("most"))).groupBy(
        F.col("host").alias("__of")).agg(F.sort_array(F.collect_set("slot")).alias("__template"))
    judged = write_and_read(wrappers.join(
        template, F.col("__host") == F.col("__of"), "left").drop("__of"), "templates")

    @F.pandas_udf("string")
    def extract(page: pd.Series, items: pd.Series, fixed: pd.Series) -> pd.Series:
        get = matchers()
        return pd.Series([main_text(p, None, get(w), set() if t is None else set(t))
                          for p, w, t in zip(page, items, fixed)], dtype=object)

    return source.join(judged, F.col("__at") == F.col("__host"), "left").select(
        *[F.col(quoted(c)) for c in kept],
        extract("__html", "__items", "__template").alias("text")).withColumn(
        "n_chars", F.length("text").cast("long"))
