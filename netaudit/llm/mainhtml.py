"""Main text of web pages: the maximum-scoring run of words and tags.

A page is cut into tags and runs of words. Words score positive and tags negative, by weights
from pages that mark their own article: how often words of a sort, and tags of a kind, lie
inside it. Words of furniture, such as menus, and words beside a marked article score negative;
furniture inside a marked article scores nothing, so that it does not cut the article.
One linear scan finds the contiguous region with the highest sum; its blocks are returned
without the furniture inside it.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import log

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from netaudit.llm.common import checkpointed

#: Pages that weights are learnt from, those with the smallest hashes of their ids.
SAMPLE_PAGES = 2_000
#: Fewer occurrences of a tag in the sample tell nothing about it; so its names are bounded by the sample's markup.
SEEN = 3
#: Scores where the labelled pages tell nothing: words by sort, and a tag.
WORDS, TAG = {"article": 2.0, "outside": -2.0, "furniture": -1.0, "text": 1.0, "link": 0.2}, -0.3
# Elements of HTML by what they do to text.
SILENT = frozenset("script style noscript template iframe object embed applet svg math canvas audio video map head title select option datalist".split())
RAW = frozenset("script style noscript template iframe textarea title".split())
FURNITURE = frozenset("nav header footer aside form dialog menu button fieldset label input textarea select".split())
#: Elements that may stand in a head; others, and words, end one that is still open.
IN_HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements that end an open one of the same sort, as their closing tag may be left out.
CLOSES = {
    "p": BLOCKS, "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
    "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]), "tr": frozenset(["tr"]), "option": frozenset(["option"]),
}
ARTICLES = ("article", "main")
#: Words of class, id and role values that name furniture.
NAMED = re.compile(
    r"(?<![a-z])(ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notice|popup|modal|overlay|newsletter|subscribe\w*|signup|"
    r"nav|navbar|navigation|menu|breadcrumbs?|sidebar|side-bar|aside|footer|header|masthead|toolbar|widget|related|recommended|recommendations|"
    r"share|sharing|social|comments?|commentlist|respond|reply|replies|disqus|pagination|pager|skip-link|search|login|complementary|contentinfo|alert)(?![a-z])"
)
#: Names that say what a page has or lacks, not what an element is.
STATE = re.compile("(?:no|has|with|without|is|hide|show)[-_]")
#: Elements that are furniture by their tag, whatever they hold.
ALWAYS = frozenset("nav footer dialog menu button label input textarea select".split())
SPACE = re.compile(r"[\s\x1c-\x1f]+")
MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?>[^>\"']+|\"[^\"]*\"|'[^']*')*+)(?:>|\Z|[\"'][^>]*(?:>|\Z))", re.S)
ATTRIBUTE = re.compile(r"(?<![\w-])(class|id|role|aria-label|hidden|aria-hidden|style)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)


@dataclass
class Run:
    """Words between two tags, in a link or not, in furniture and in a marked article or not."""

    text: str
    link: bool
    block: int
    furniture: bool = False
    marked: bool = False


@dataclass
class Tag:
    name: str
    furniture: bool = False
    marked: bool = False


@dataclass
class Page:
    """Tags and runs of words in page order, and where the elements that mark an article begin and end."""

    parts: list = field(default_factory=list)
    articles: list[tuple[int, int]] = field(default_factory=list)

    def sort(self, run: Run) -> str:
        if run.furniture:
            return "furniture"
        if self.articles:
            return "article" if run.marked else "outside"
        return "link" if run.link else "text"


@dataclass
class Suspect:
    """An element that its tag or name takes for furniture, from one part to another."""

    begin: int
    end: int
    #: Hidden elements and menus stay what they are; so do those whose whole name says it where there is another text.
    fixed: bool
    strong: bool


def _named(attrs: str) -> tuple[bool, bool, bool]:
    """Whether an element is hidden, has a furniture word in its names, or has it as a whole name."""
    hidden = named = strong = False
    for key, value in ATTRIBUTE.findall(attrs):
        key, value = key.lower(), value.strip("\"'").lower()
        hidden |= key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and bool(re.search(r"display\s*:\s*none", value))
        if key in ("class", "id", "role"):
            for word in value.split():
                if NAMED.search(word.replace("_", " ")) and not STATE.match(word):
                    named, strong = True, strong or bool(NAMED.fullmatch(word))
    return hidden, named, strong


def _is_furniture(suspects: list[Suspect], page: Page) -> list[int]:
    """How many elements of furniture each part is in.

    A name or tag alone does not make furniture of what holds most plain words of the page, or nearly
    all of a marked article: such an element is the wrapper of the text. It stays furniture if it is hidden, if an article is
    marked beside it, or if it is named for nothing else and other text of some size is left.
    """
    plain = [0]
    for part in page.parts:
        plain.append(plain[-1] + (len(part.text.split()) if isinstance(part, Run) and not part.link else 0))
    total = plain[-1]
    depth = [0] * (len(page.parts) + 1)
    for s in suspects:
        depth[s.begin] += 1
        depth[s.end] -= 1
    covered, outside = 0, 0
    for i in range(len(page.parts)):
        covered += depth[i]
        outside += (plain[i + 1] - plain[i]) * (covered == 0)
    depth = [0] * (len(page.parts) + 1)
    for s in suspects:
        held = plain[s.end] - plain[s.begin]
        beside = any(a >= s.end or b <= s.begin for a, b in page.articles) and not any(s.begin <= a < s.end or a <= s.begin < b for a, b in page.articles)
        around = next(((a, b) for a, b in page.articles if a <= s.begin < b), None)
        small = 2 * held <= total if around is None else 10 * held <= 9 * (plain[around[1]] - plain[around[0]])
        if s.fixed or small or beside or s.strong and 10 * outside >= held:
            depth[s.begin] += 1
            depth[s.end] -= 1
    out, covered = [], 0
    for i in range(len(page.parts)):
        covered += depth[i]
        out.append(covered)
    return out


class _Open:
    """The open elements, with their places by name, so that nothing is searched for."""

    def __init__(self):
        self.stack: list[tuple] = []  # of (name, silent, link, suspect) for open elements
        self.places: dict[str, list[int]] = {}
        self.walls: list[int] = []  # blocks that only their own end closes

    def push(self, name: str, *rest) -> None:
        self.places.setdefault(name, []).append(len(self.stack))
        if name in BLOCKS and name not in CLOSES:
            self.walls.append(len(self.stack))
        self.stack.append((name, *rest))

    def pop(self) -> tuple:
        element = self.stack.pop()
        self.places[element[0]].pop()
        if self.walls and self.walls[-1] == len(self.stack):
            self.walls.pop()
        return element

    def last(self, *names: str) -> int:
        """Place of the innermost open element of these names, -1 if there is none."""
        return max((self.places[n][-1] for n in names if self.places.get(n)), default=-1)


#: Elements that a start tag closes: paragraphs by blocks, others by their own sort.
CLOSED_BY = {name: [c for c, by in CLOSES.items() if name in by] for name in BLOCKS | frozenset(CLOSES)}


def read_page(source: str) -> Page:
    """One pass over the markup; unclosed and misplaced tags are borne as browsers bear them."""
    page, open_, suspects, outer_articles = Page(), _Open(), [], []
    stack, block, at, n = open_.stack, 0, 0, len(source)

    def words(piece: str) -> None:
        if stack and stack[-1][0] == "head" and piece.strip():
            close(len(stack) - 1)
        if piece and not (stack and stack[-1][1]):
            page.parts.append(Run(html.unescape(piece), bool(stack) and stack[-1][2], block))

    def close(to: int) -> None:
        while len(stack) > to:
            name, _, _, suspect = open_.pop()
            if suspect is not None:
                suspect.end = len(page.parts)
            if name in ARTICLES:
                begin = outer_articles.pop()
                page.articles.append((begin, len(page.parts)))

    while at < n:
        tag = MARKUP.search(source, at)
        if tag is None:
            words(source[at:])
            break
        words(source[at : tag.start()])
        at = tag.end()
        if tag["cdata"] is not None or tag["name"] is None:
            continue
        name, attrs = tag["name"].lower(), tag["attrs"] or ""
        if name in BLOCKS:
            block += 1
        if tag["close"]:
            page.parts.append(Tag(name))
            place = open_.last(name)
            # An article is not ended by what was never opened in it.
            if place >= 0 and (name in ("body", "html") or place >= open_.last(*ARTICLES)):
                close(place)
            continue
        if stack and stack[-1][0] == "head" and name not in IN_HEAD:
            close(len(stack) - 1)
        if name in CLOSED_BY:
            place = open_.last(*CLOSED_BY[name])
            if place >= 0 and place >= (open_.walls[-1] if open_.walls else -1):
                close(place)
        silent, link = stack[-1][1:3] if stack else (False, False)
        suspect = None
        if name not in ("html", "body", *ARTICLES):
            hidden, named, strong = _named(attrs)
            # The header of an article holds its title.
            of_article = name == "header" and bool(outer_articles)
            if hidden or (named or name in FURNITURE) and not of_article:
                suspect = Suspect(len(page.parts), len(page.parts) + 1, hidden or name in ALWAYS, strong or name == "aside")
                suspects.append(suspect)
        page.parts.append(Tag(name))
        if name == "br":
            words(" ")
        if name in VOID or attrs.rstrip().endswith("/") and name not in BLOCKS:
            continue
        if name in ARTICLES:
            outer_articles.append(len(page.parts))
        open_.push(name, silent or name in SILENT, link or name == "a", suspect)
        if name in RAW:  # nothing inside is markup
            end = re.compile(rf"</{name}(?=[\s/>]|\Z)", re.I).search(source, at)
            stop = end.start() if end else n
            words(source[at:stop])
            at = stop
    close(0)
    return _resolved(page, suspects)


def _resolved(page: Page, suspects: list[Suspect]) -> Page:
    """Furniture told from wrappers, and the outermost marked articles outside of furniture."""
    page.articles.sort(key=lambda a: (a[0], -a[1]))
    outermost: list[tuple[int, int]] = []
    for begin, end in page.articles:
        if not outermost or begin >= outermost[-1][1]:
            outermost.append((begin, end))
    # Articles in hidden or named elements, such as a reader's comment, mark nothing there.
    within = [0] * (len(page.parts) + 1)
    for s in suspects:
        if s.fixed or s.strong:
            within[s.begin] += 1
            within[s.end] -= 1
    for i in range(1, len(within)):
        within[i] += within[i - 1]
    page.articles = [a for a in outermost if not within[min(a[0], len(page.parts) - 1)]] if page.parts else []
    for part, inside in zip(page.parts, _is_furniture(suspects, page), strict=True):
        part.furniture = inside > 0
    page.articles = [a for a in page.articles if a[0] > 0 and not page.parts[a[0] - 1].furniture]
    for begin, end in page.articles:
        for part in page.parts[begin:end]:
            part.marked = True
    return page


@dataclass
class Weights:
    words: dict[str, float] = field(default_factory=dict)
    tags: dict[str, float] = field(default_factory=dict)

    def of(self, page: Page, part) -> float:
        if part.furniture and part.marked:
            return 0.0
        if isinstance(part, Tag):
            return self.tags.get(part.name, TAG)
        sort = page.sort(part)
        return len(part.text.split()) * self.words.get(sort, WORDS[sort])


def count_marked(page: Page) -> Counter:
    """Words by sort and tags by name, inside and outside the marked article; tags of furniture tell nothing about others."""
    counts: Counter = Counter()
    if page.articles:
        for part in page.parts:
            inside = part.marked
            if isinstance(part, Tag):
                counts["tag", part.name, inside] += not part.furniture or part.name in FURNITURE
            else:
                words = len(part.text.split())
                counts["word", page.sort(part), inside] += words
                if not part.furniture:
                    counts["word", "link" if part.link else "text", inside] += words
    return counts


def weigh(counts: dict) -> Weights:
    """Log-odds of lying inside, held to the method's signs: tags below 0, and words above unless they are mostly outside."""
    out = Weights()
    for kind, name in {(kind, name) for kind, name, _ in counts}:
        odds = log((counts.get((kind, name, True), 0) + 1) / (counts.get((kind, name, False), 0) + 1))
        if kind == "word":
            out.words[name] = min(2.0, max(0.2, odds)) if odds > -0.5 else max(-2.0, odds)
        elif odds < -0.5 and (name in FURNITURE or name in SILENT):
            out.tags[name] = -2.0
        else:
            out.tags[name] = TAG if odds < 0.5 else -0.1
    return out


def best_region(scores: list[float]) -> tuple[int, int]:
    """Begin and end of the contiguous part with the highest sum, the first and longest among equals; (0, 0) if none is positive."""
    best, region, total, begin = 0.0, (0, 0), 0.0, 0
    for i, score in enumerate(scores):
        if total <= 0:
            total, begin = 0.0, i
        total += score
        if total > best or total == best and region[0] == begin and total > 0:
            best, region = total, (begin, i + 1)
    return region


def region_text(page: Page, region: tuple[int, int]) -> str:
    """The blocks of a region, furniture left out."""
    blocks: dict[int, list[str]] = {}
    for part in page.parts[region[0] : region[1]]:
        if isinstance(part, Run) and not part.furniture:
            blocks.setdefault(part.block, []).append(part.text)
    texts = (SPACE.sub(" ", "".join(b)).strip() for b in blocks.values())
    return "\n".join(t for t in texts if t)


def main_text(source: str | None, weights: Weights) -> str:
    """Main text of a page; empty for a null or empty page and for one without a positive region.

    Of a page that marks articles the best region of each is taken, of others the best of all.
    """
    page = read_page(source or "")
    scores = [weights.of(page, p) for p in page.parts]
    texts = []
    for begin, end in page.articles or [(0, len(scores))]:
        first, last = best_region(scores[begin:end])
        texts.append(region_text(page, (begin + first, begin + last)))
    return "\n".join(t for t in texts if t)


def learn_weights(pages: DataFrame, sample_pages: int = SAMPLE_PAGES) -> Weights:
    """Weights from at most ``sample_pages`` pages that mark their article; pages without a mark teach nothing."""
    chosen = pages.filter("page_id is not null and html is not null").filter(F.lower("html").rlike("<(article|main)[ >]"))
    chosen = chosen.select(F.xxhash64("page_id").alias("h"), "page_id").distinct().orderBy("h", "page_id").limit(sample_pages)
    rows = pages.select("page_id", "html").join(F.broadcast(checkpointed(chosen).select("page_id")), "page_id", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for value in batch.column(0):
                counts.update(count_marked(read_page(value.as_py() or "")))
        keys = list(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[i] for k in keys], t) for i, t in enumerate((pa.string(), pa.string(), pa.bool_()))] + [pa.array([counts[k] for k in keys], pa.int64())], ["kind", "name", "inside", "n"]
        )

    found = rows.select("html").mapInArrow(run, "kind string, name string, inside boolean, n long").groupBy("kind", "name", "inside").agg(F.sum("n").alias("n"))
    return weigh({(r.kind, r.name, r.inside): r.n for r in found.filter(f"n >= {SEEN}").collect()})  # of the sample's pages


def extracted(pages: DataFrame, sample_pages: int = SAMPLE_PAGES) -> DataFrame:
    """``page_id, url, text, n_chars`` for each row of ``pages``.

    Ids and addresses may be null or repeated; a null page has an empty text. Other columns are not read.
    """
    weights = learn_weights(pages, sample_pages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(v.as_py(), weights) for v in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")).mapInArrow(run, "page_id long, url string, text string, n_chars long")
