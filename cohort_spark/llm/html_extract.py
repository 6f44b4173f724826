"""Operator 6, HTML extraction by a maximum-scoring subsequence.

A page is a sequence of words and tags. Words score positive, tags negative; one linear scan finds the contiguous run
with the largest sum, the content region. The weights come from labelled pages, those that mark their text with an
``article`` or ``main`` element: a word weighs what share of the words of its enclosing element kind lies inside marked
text, a tag costs the more the larger the share of its kind lies outside (next to nothing within elements that are left out). The scale of the tag costs is chosen on a
bounded sample of the labelled pages. Elements that are never content (menus, scripts, footers ...) are left out wherever
they stand; elements that a class, id or role names as such (comments, adverts ...), and forms, only where they wrap neither
marked text nor most of the page, as many pages put everything into one form or into ``has-sidebar``.
"""

from __future__ import annotations

import html as entities
import re
import zlib
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohort_spark.llm.common import pick, stage

#: HTML element names by their role.
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "math", "object", "noframes", "xmp"}
VOID = {"br", "hr", "img", "input", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr", "param"}
INLINE = {"a", "abbr", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark",
          "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
NEVER = {"nav", "header", "footer", "aside", "button", "select", "option", "fieldset", "dialog", "menu", "audio", "video", "canvas", "head"}
MARKED = {"article", "main"}
CLOSES_P = {"p", "div", "ul", "ol", "li", "dl", "table", "section", "article", "main", "aside", "nav", "header", "footer", "form", "blockquote", "pre",
            "h1", "h2", "h3", "h4", "h5", "h6", "figure", "hr", "address", "fieldset"}
#: Words of class, id and role names that mark elements that are never content.
NOISE = {"ad", "ads", "advert", "adverts", "advertisement", "adsense", "banner", "banners", "sponsor", "sponsored", "promo", "promotion", "cookie", "cookies",
         "consent", "gdpr", "notice", "notices", "alert", "popup", "modal", "overlay", "sidebar", "side", "aside", "menu", "menus", "nav", "navbar", "navigation",
         "breadcrumb", "breadcrumbs", "header", "masthead", "footer", "comment", "comments", "disqus", "reply", "replies", "respond", "share", "sharing",
         "social", "related", "recommended", "newsletter", "subscribe", "subscription", "signup", "login", "search", "pagination", "pager", "widget", "widgets",
         "toolbar", "contentinfo", "complementary", "skip", "copyright"}

PIECE = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^"'<>]++|"[^"]*"|'[^']*')*+)(?:>|(?=<)|\Z)""", re.S)
HEADINGS = {"h1", "h2", "h3"}
WRAPS = 0.8  # an element with this share of a page's words is no menu, whatever it is called
BUCKETS = 1 << 16  # of kinds: weights are held per hash of the kind, so their number is bounded whatever names a crawl has
ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden|itemprop)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
NAME_PART = re.compile(r"[a-z]+|[0-9]+")
UNSEEN_OUTSIDE = 0.02  # share outside of a tag that no labelled page shows
SKIP_COST = 0.01  # of a tag in an element that is left out anyway: content may go on after it
GRID = (2.0, 5.0, 10.0, 20.0, 40.0)


def _names(attributes: str) -> tuple[list[str], bool]:
    """Parts of the class, id and role values, and whether the element is hidden."""
    parts, hidden = [], False
    for m in ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), (m[2] or "").strip("\"'")
        if key in ("hidden", "aria-hidden"):
            hidden = hidden or key == "hidden" or value.lower() == "true"
        elif key != "itemprop":
            parts += NAME_PART.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", value).lower())
    return parts, hidden


class _Open:
    """The open elements, innermost last. Each lookup is by position, so deep or unclosed markup costs no more than other markup."""

    def __init__(self):
        self.items: list[tuple] = []  # name, kind, skipped, marked, place of the innermost block
        self.at: dict[str, list[int]] = defaultdict(list)  # places per name

    def push(self, name: str, kind: str, skipped: bool, marked: bool) -> None:
        n = len(self.items)
        block = n if name not in INLINE else self.items[-1][4] if self.items else -1
        self.at[name].append(n)
        self.items.append((name, kind, skipped, marked, block))

    def cut(self, place: int) -> None:
        """Close all elements from ``place`` on."""
        while len(self.items) > place:
            self.at[self.items.pop()[0]].pop()

    def last(self, *names: str) -> int:
        return max(self.at[n][-1] if self.at[n] else -1 for n in names)

    def state(self) -> tuple[bool, bool]:
        return (self.items[-1][2], self.items[-1][3]) if self.items else (False, False)

    def block(self) -> tuple | None:
        place = self.items[-1][4] if self.items else -1
        return self.items[place] if place >= 0 else None


def tokens(page: str) -> list[tuple]:
    """Tokens of a page: ``("tag", kind, is_block, in_marked, skipped)`` and ``("text", string, kind of the enclosing element, in_marked, skipped)``.
    Unclosed and misnested elements are closed as browsers do in the common cases; a ``<`` that opens no tag is text."""
    out: list[tuple] = []
    open_, at, end, unclosed = _Open(), 0, len(page), set()
    named: list[list[int]] = []  # elements that only their names call noise: first token, token after
    inside: dict[int, int] = {}  # place of an open one -> its number

    def text(s: str) -> None:
        if s:
            top = open_.block()
            skipped, marked = open_.state()
            out.append(("text", s, top[1] if top else "", marked, skipped))

    def close(place: int) -> None:
        for p in [p for p in reversed(inside) if p >= place] if inside else ():
            named[inside.pop(p)][1] = len(out)
        open_.cut(place)

    while at < end:
        m = PIECE.search(page, at)
        if not m:
            text(page[at:])
            break
        text(page[at:m.start()])
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            if m[0].startswith("<![CDATA["):
                text(m[0][9:].removesuffix("]]>"))
            continue
        if m[1]:
            skipped, marked = open_.state()
            place = open_.last(name)
            if place >= 0:
                _, _, skipped, held, _ = open_.items[place]
                marked = marked and held and name not in MARKED
                close(place)
            out.append(("tag", "/" + name, name not in INLINE, marked, skipped))
            continue
        parts, hidden = _names(m[3])
        if name in RAW and not m[3].rstrip().endswith("/"):
            ended = None if name in unclosed else re.compile(rf"</{name}\s*>", re.I).search(page, at)
            if not ended:
                unclosed.add(name)
            at = ended.end() if ended else end if name in ("script", "style", "template", "svg") else at
            out.append(("tag", name, True, open_.state()[1], True))
            continue
        if name in CLOSES_P and (top := open_.block()) and top[0] == "p":
            close(open_.items[-1][4])
        if name in ("li", "dt", "dd", "tr", "td", "th", "option") and open_.last(name) > open_.last("ul", "ol", "dl", "table"):
            close(open_.last(name))
        kind = name + ("." + parts[0] if parts else "")
        above_skipped, above_marked = open_.state()
        plain = name not in ("body", "html", *MARKED)
        never = plain and (name in NEVER or hidden)
        maybe = plain and not never and not above_skipped and (name == "form" or any(p in NOISE for p in parts))
        out.append(("tag", kind, name not in INLINE, above_marked, above_skipped or never))
        if name in VOID or m[3].rstrip().endswith("/") and name not in CLOSES_P:
            if maybe:
                named.append([len(out) - 1, len(out)])
            continue
        open_.push(name, kind, above_skipped or never, above_marked or name in MARKED)
        if maybe:
            inside[len(open_.items) - 1] = len(named)
            named.append([len(out) - 1, end + 1])
    return _without_noise(out, named) if named else out


def _without_noise(out: list[tuple], named: list[list[int]]) -> list[tuple]:
    """The tokens with the named elements left out, but for those that wrap the content: they hold an ``article`` or ``main``, most of
    the page's words, or, within marked text, a heading."""
    n = len(out)
    words, starts, heads = [0] * (n + 1), [0] * (n + 1), [0] * (n + 1)
    for i, t in enumerate(out):
        tag = t[1].split(".")[0] if t[0] == "tag" else ""
        words[i + 1] = words[i] + (len(t[1].split()) if t[0] == "text" and not t[4] else 0)
        starts[i + 1] = starts[i] + (tag in MARKED)
        heads[i + 1] = heads[i] + (tag in HEADINGS)
    left_out = [0] * (n + 1)
    for a, b in named:
        b = min(b, n)
        wraps = starts[b] > starts[a] or words[n] and words[b] - words[a] >= WRAPS * words[n] or out[a][3] and heads[b] > heads[a]
        if not wraps:
            left_out[a] += 1
            left_out[b] -= 1
    depth, result = 0, []
    for i, t in enumerate(out):
        depth += left_out[i]
        result.append(t if not depth else (*t[:4], True))
    return result


def blocks(found: list[tuple]) -> str:
    """Text of the tokens: character references decoded, white space of a block turned into one space, blocks joined by an empty line."""
    parts, now = [], []

    def flush():
        s = " ".join("".join(now).split())
        if s:
            parts.append(s)
        now.clear()

    for t in found:
        if t[0] == "tag":
            if t[2]:
                flush()
            elif t[1].split(".")[0] == "br":
                now.append(" ")
        elif not t[4]:
            now.append(entities.unescape(t[1]))
    flush()
    return "\n\n".join(parts)


def bucket(kind: str) -> int:
    return zlib.crc32(kind.encode("utf-8", "surrogatepass")) % BUCKETS


class Weights:
    """Word and tag weights from counts per hash of a kind: ``(words inside, outside, tags inside, outside)`` of labelled pages."""

    def __init__(self, counts: dict[int, tuple[int, int, int, int]], scale: float):
        total = [sum(c[i] for c in counts.values()) for i in range(4)]
        prior = (total[0] + 1) / (total[0] + total[1] + 2)
        tag_prior = UNSEEN_OUTSIDE  # what labelled pages do not show may well be content
        self.scale, self._default = scale, (prior, tag_prior)
        self._word = {k: (a + 2 * prior) / (a + b + 2) for k, (a, b, _, _) in counts.items()}
        self._tag = {k: (d + 2 * tag_prior) / (c + d + 2) for k, (_, _, c, d) in counts.items()}

    def word(self, kind: str) -> float:
        v = self._word.get(bucket(kind))
        return v if v is not None else self._word.get(bucket(kind.split(".")[0]), self._default[0])

    def tag(self, kind: str) -> float:
        v = self._tag.get(bucket(kind))
        v = v if v is not None else self._tag.get(bucket(kind.split(".")[0]), self._default[1])
        return -0.05 - self.scale * v


def best_region(found: list[tuple], w: Weights) -> tuple[int, int]:
    """First and last (exclusive) token of the run with the largest score; (0, 0) if no word scores."""
    best, span, total, start = 0.0, (0, 0), 0.0, 0
    for i, t in enumerate(found):
        if t[0] == "tag":
            total += w.tag(t[1]) if not t[4] else -SKIP_COST
        elif not t[4]:
            total += len(t[1].split()) * w.word(t[2])
        if total <= 0:
            total, start = 0.0, i + 1
        elif total > best:
            best, span = total, (start, i + 1)
    return span


def extract(page: str, w: Weights) -> str:
    found = tokens(page)
    a, b = best_region(found, w)
    return blocks(found[a:b])


def _counts(batches):
    """Per hash of a kind: words inside and outside of marked text, tags inside and outside, over labelled pages."""
    for b in batches:
        sums: dict[int, list[int]] = {}
        for page in b.column("html"):
            found = tokens(page.as_py() or "")
            if not any(t[3] for t in found):
                continue
            for t in found:
                if t[4]:
                    continue
                for kind in {t[1], t[1].split(".")[0]} if t[0] == "tag" else {t[2], t[2].split(".")[0]}:
                    c = sums.setdefault(bucket(kind), [0, 0, 0, 0])
                    if t[0] == "tag":
                        c[2 if t[3] else 3] += 1
                    else:
                        c[0 if t[3] else 1] += len(t[1].split())
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), *[pa.array([c[i] for c in sums.values()], pa.int64()) for i in range(4)]],
                                         names=["kind", "a", "b", "c", "d"])


def learn_weights(src: DataFrame, sample: int) -> Weights:
    """Weights over all labelled pages; the scale with the best word overlap on ``sample`` different labelled pages, those with the
    smallest hashes (only hashes are put in order)."""
    rows = (src.select("html").mapInArrow(_counts, "kind long, a long, b long, c long, d long").groupBy("kind")
            .agg(*[F.sum(x).alias(x) for x in "abcd"]).collect())  # at most BUCKETS rows
    counts = {r["kind"]: (r["a"], r["b"], r["c"], r["d"]) for r in rows}
    marked = src.select("html", F.xxhash64("html").alias("h")).where(F.col("html").rlike("(?i)<(article|main)[ >]"))
    last = marked.select("h").distinct().orderBy("h").limit(sample).agg(F.max("h")).first()[0]
    chosen = stage(marked.where(F.col("h") <= F.lit(last)).groupBy("h").agg(F.first("html").alias("html")).select("html"), "html-sample")

    def overlap(batches):
        models = [Weights(counts, s) for s in GRID]
        for b in batches:
            f = [0.0] * len(GRID)
            for page in b.column("html"):
                found = tokens(page.as_py())
                sizes = [0 if t[0] == "tag" or t[4] else len(t[1].split()) for t in found]
                want = sum(s for s, t in zip(sizes, found) if t[3])
                for k, m in enumerate(models):
                    i, j = best_region(found, m)
                    got, hit = sum(sizes[i:j]), sum(s for s, t in zip(sizes[i:j], found[i:j]) if t[3])
                    f[k] += 2 * hit / (got + want) if got + want else 1.0
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.float64()) for x in f], names=[f"f{k}" for k in range(len(GRID))])

    names = [f"f{k}" for k in range(len(GRID))]
    sums = chosen.mapInArrow(overlap, ", ".join(f"{n} double" for n in names)).agg(*[F.sum(n).alias(n) for n in names]).first()
    best = max(range(len(GRID)), key=lambda k: (round(sums[k] or 0.0, 6), -abs(k - len(GRID) // 2)))
    return Weights(counts, GRID[best])


def html_extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                 sample: int = 1_000) -> DataFrame:
    """One row per page: ``(id, url, text, n_chars)``.

    ``text`` is the content region's blocks in page order (see the module text), character references decoded, white space
    inside a block as one space, trimmed, blocks joined by two ``\\n``; ``n_chars`` counts its code points. Null or empty html, or
    a page without words: empty text. Without labelled pages all words and all tags weigh alike. Very long pages are scanned
    whole. Rows may repeat; null ids and urls stay. Columns besides the three named are ignored.
    """
    src = pick(pages, id=id_col, url=url_col, html=html_col)
    weights = pages.sparkSession.sparkContext.broadcast(learn_weights(src, sample))

    def run(batches):
        for b in batches:
            texts = [extract(p.as_py() or "", weights.value) for p in b.column("html")]
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                             names=["id", "url", "text", "n_chars"])

    out = src.mapInArrow(run, f"id {dict(src.dtypes)['id']}, url string, text string, n_chars long")
    return out.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", "n_chars")
