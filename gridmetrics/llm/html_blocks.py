"""Main text of web pages by a recurrent block labeller.

A page is cut into leaf blocks: runs of text between block-level tags, each with its tag path. A
block's vector holds its path (hashed tag and class tokens, and what kind of part the tokens name), its
link share and length, and its hashed words. A bidirectional LSTM in numpy reads the vectors of
the whole page and labels every block as main text or not.

It is trained on a bounded sample of the pages themselves. Pages that name their article in
mark-up give the labels; the names are then varied, foreign parts are put inside the article, and on a
share of the pages all names are taken away, so that the labeller learns what parts look like rather
than one site's names. Every block of every page is labelled from the whole page.

A page is read in time linear in its length, however broken or deep: see ``_Scanner``, ``Path``, ``_Open``.

Defined results: null or empty html, and pages without text, give empty text; scripts, styles, comments
and mark-up are never text; ``<br>`` is white space; broken mark-up closes as browsers close it;
repeated rows give repeated rows; columns besides id, url and html are ignored.
"""

from __future__ import annotations

import re
import zlib
from html import unescape

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_rows, table
from .training import Adam, sigmoid, smallest

#: Pages the labeller is fitted on at most.
SAMPLE = 400
PATHS, WORDS, HIDDEN = 32, 24, 12

#: Fixed values of HTML: elements whose tags end a run of text, elements without content, elements
#: whose content is no text.
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe legend li "
    "main menu nav noscript ol optgroup option p pre search section select summary table tbody td "
    "template tfoot th thead title tr ul button textarea label svg video audio canvas object".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript template iframe svg select xmp".split())
_CLOSES_P = _BLOCKS - {"html", "body", "head", "label", "button", "option", "optgroup"}
_SIBLINGS = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",),
    "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
}
#: Words in tag, class and id names that tell what kind of part an element is.
KINDS = {
    "menu": "nav navigation navbar menu breadcrumb breadcrumbs pagination pager toc skip tabs",
    "frame": "header footer aside sidebar masthead copyright colophon toolbar topbar banner",
    "notice": "notice cookie cookies consent gdpr alert modal popup overlay toast message warning",
    "advert": "ad ads advert adverts advertisement promo promoted sponsor sponsored outbrain taboola",
    "form": "form newsletter subscribe signup login search input button label fieldset",
    "comment": "comment comments reply replies respond discussion disqus feedback",
    "extra": "related recommended recommendations share sharing social widget more also tags popular",
    "main": "article main content post entry story body text page read",
}
_KIND_OF = {word: i for i, words in enumerate(KINDS.values()) for word in words.split()}
_FOREIGN = [(kind, words.split()) for kind, words in KINDS.items() if kind != "main"]
_NAME = re.compile(r"[a-zA-Z][^\s/>\"'<]*")
_STOP = re.compile(r"[>\"']")
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_TOKEN = re.compile(r"[a-z]+|[0-9]+")
WIDTH = len(KINDS) + PATHS + 8 + WORDS
#: Pages nested deeper than this are extracted like all others but teach nothing.
DEEPEST = 256
#: Share of the varied training pages whose names are taken away.
BARE = 0.4


class Path:
    """The open elements around a text as a linked list: an element shares the path of its parent."""

    __slots__ = ("parent", "tokens", "depth", "_row")

    def __init__(self, parent: Path | None, tokens: list[str]) -> None:
        self.parent, self.tokens, self._row = parent, tokens, None
        self.depth: int = 1 + (parent.depth if parent else 0)

    @classmethod
    def of(cls, lists: list[list[str]]) -> Path | None:
        path = None
        for tokens in lists:
            path = cls(path, tokens)
        return path

    def row(self) -> np.ndarray:
        """Features of the whole path: those of the parent's and of its own tokens."""
        todo, path = [], self
        while path is not None and path._row is None:
            todo.append(path)
            path = path.parent
        for path in reversed(todo):
            above = path.parent
            path._row = np.zeros(len(KINDS) + PATHS, np.float32) if above is None else above._row.copy()
            for token in path.tokens:
                kind, bucket = _marks(token)
                if kind is not None:
                    path._row[kind] = 1
                path._row[bucket] = 0.5
        return self._row


_MARKS: dict[str, tuple[int | None, int]] = {}


def _marks(token: str) -> tuple[int | None, int]:
    """The kind that a token names, if any, and its bucket; a bounded memo spares repeated hashing."""
    found = _MARKS.get(token)
    if found is None:
        if len(_MARKS) > 100_000:
            _MARKS.clear()
        kind = _KIND_OF.get(token, _KIND_OF.get(token.rstrip("s")))
        found = _MARKS[token] = kind, len(KINDS) + _bucket(token, PATHS)
    return found


class Block:
    """A run of text below a path of open elements."""

    __slots__ = ("node", "text", "linked")

    def __init__(self, path: Path | list[list[str]] | None, text: str, linked: int) -> None:
        self.node = Path.of(path) if isinstance(path, list) else path
        self.text, self.linked = text, linked

    @property
    def path(self) -> list[list[str]]:
        """Token lists of the open elements, outermost first."""
        out, node = [], self.node
        while node is not None:
            out.append(node.tokens)
            node = node.parent
        return out[::-1]


class _Scanner:
    """The tags of a page, each character looked at a bounded number of times.

    A tag ends at the first ``>`` outside quotes. Where the quotes do not close, the ``<`` is text; what follows
    a quote or a ``>`` is worked out once and remembered, however many ``<`` ask for it.
    """

    def __init__(self, html: str) -> None:
        self.html, self.at, self.last = html, 0, html.rfind(">")
        self.ends: dict[int, int] = {}

    def tags(self):
        """(start, closing, name, attributes) of each tag; name is None for comments and the like.

        ``at`` is where the tag ends and the search goes on; who reads the tags may move it.
        """
        html = self.html
        while (start := html.find("<", self.at)) >= 0:
            self.at = start + 1
            if html.startswith("<!--", start):
                close = html.find("-->", start + 4)
                self.at = close + 3 if close >= 0 else len(html)
                yield start, False, None, ""
                continue
            closing = html.startswith("/", start + 1)
            name = _NAME.match(html, start + 1 + closing)
            end = self._end(name.end()) if name else -1
            if end >= 0:
                self.at = end + 1
                yield start, closing, name[0].lower(), html[name.end() : end]
            elif html[start + 1 : start + 2] in ("!", "?", "/") and start < self.last:
                self.at = html.index(">", start) + 1
                yield start, False, None, ""

    def _end(self, at: int) -> int:
        """The ``>`` that ends a tag whose attributes begin at ``at``, or -1."""
        if at > self.last:
            return -1
        asked, found = [], -1
        while (stop := _STOP.search(self.html, at)) is not None:
            place = stop.start()
            if place in self.ends:
                found = self.ends[place]
                break
            asked.append(place)
            if stop[0] == ">":
                found = place
                break
            close = self.html.find(stop[0], place + 1)
            if close < 0:
                break
            at = close + 1
        for place in asked:
            self.ends[place] = found
        return found


def _tokens(tag: str, attributes: str) -> list[str]:
    names = " ".join(a or b or c for a, b, c in _NAMES.findall(attributes)) if attributes else ""
    return [tag, *_TOKEN.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", names).lower())]


class _Open:
    """The stack of open elements, with the places of each tag and of block elements at hand."""

    def __init__(self) -> None:
        self.tags: list[str] = []
        self.paths: list[Path | None] = []
        self.blocks: list[int] = []
        self.places: dict[str, list[int]] = {}

    @property
    def path(self) -> Path | None:
        return self.paths[-1] if self.paths else None

    def push(self, tag: str, tokens: list[str]) -> None:
        shown = tag in _BLOCKS or len(tokens) > 1
        if tag in _BLOCKS:
            self.blocks.append(len(self.tags))
        self.places.setdefault(tag, []).append(len(self.tags))
        self.paths.append(Path(self.path, tokens) if shown else self.path)
        self.tags.append(tag)

    def cut(self, size: int) -> None:
        while len(self.tags) > size:
            self.places[self.tags.pop()].pop()
            self.paths.pop()
        while self.blocks and self.blocks[-1] >= size:
            self.blocks.pop()

    def last(self, tag: str) -> int | None:
        """Place of the innermost open element of this tag."""
        places = self.places.get(tag)
        return places[-1] if places else None

    def holds_block(self, place: int) -> bool:
        """Whether a block element is open inside the one at ``place``."""
        return bool(self.blocks) and self.blocks[-1] > place


def blocks_of(html: str) -> list[Block]:
    """Leaf blocks of a page in order, with white space collapsed and references decoded."""
    out: list[Block] = []
    stack = _Open()
    held: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal held, linked
        text = " ".join("".join(held).split())
        if text:
            out.append(Block(stack.path, text, linked))
        held, linked = [], 0

    def text(raw: str) -> None:
        nonlocal linked
        if raw:
            raw = unescape(raw) if "&" in raw else raw
            held.append(raw)
            if "a" in stack.tags[-4:]:
                linked += len(raw)

    at, scanner = 0, _Scanner(html)
    for start, closing, tag, attributes in scanner.tags():
        text(html[at:start])
        at = scanner.at
        if tag is None:
            continue
        if closing:
            place = stack.last(tag)
            if tag in _BLOCKS:
                flush()
            if place is not None:
                inner = stack.holds_block(place)
                if inner and tag not in _BLOCKS:
                    continue  # an inline end tag does not close the blocks inside it
                if inner:
                    flush()
                stack.cut(place)
            continue
        if tag == "br":
            held.append(" ")
            continue
        if tag in _BLOCKS:
            flush()
            closes = ("p",) if tag in _CLOSES_P else ()
            closes += _SIBLINGS.get(tag, ())
            if stack.blocks and stack.tags[stack.blocks[-1]] in closes:
                stack.cut(stack.blocks[-1])
        if tag in _VOID or attributes.endswith("/"):
            continue
        if tag in _RAW:
            close = re.compile(rf"</{tag}\s*>", re.I).search(html, at)
            at = scanner.at = close.end() if close else len(html)
            continue
        stack.push(tag, _tokens(tag, attributes))
    text(html[at:])
    flush()
    return out


def _bucket(token: str, size: int) -> int:
    return zlib.crc32(token.encode()) % size


def vectors(blocks: list[Block]) -> np.ndarray:
    """One row of features for each block."""
    out = np.zeros((len(blocks), WIDTH), np.float32)
    for i, block in enumerate(blocks):
        if block.node is not None:
            out[i, : len(KINDS) + PATHS] = block.node.row()
        words = block.text.split(" ")
        n, leaf = len(words), block.node.tokens[0] if block.node else ""
        at = len(KINDS) + PATHS
        out[i, at : at + 8] = (
            min(1.0, block.linked / len(block.text)),
            np.log1p(n) / 5,
            block.text[-1] in ".!?…。",
            leaf == "p",
            leaf == "li",
            leaf in ("h1", "h2", "h3"),
            i / len(blocks),
            sum(len(w) for w in words) / n / 10,
        )
        hashed = np.fromiter((hash_word(w) for w in words), np.int64, n)
        out[i, at + 8 :] = np.sqrt(np.bincount(hashed, minlength=WORDS) / n)
    return out


_WORD_MEMO: dict[str, int] = {}


def hash_word(word: str) -> int:
    """Bucket of a word; a bounded memo spares repeated hashing."""
    bucket = _WORD_MEMO.get(word)
    if bucket is None:
        if len(_WORD_MEMO) > 200_000:
            _WORD_MEMO.clear()
        bucket = _WORD_MEMO[word] = _bucket(word.lower(), WORDS)
    return bucket


class Model:
    """One LSTM in each direction and a logistic layer on both states."""

    def __init__(self, seed: int = 3) -> None:
        rng = np.random.default_rng(seed)
        w = {}
        for side in "fb":
            w[f"X{side}"] = rng.normal(0, 1 / np.sqrt(WIDTH), (WIDTH, 4 * HIDDEN))
            w[f"H{side}"] = rng.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, 4 * HIDDEN))
            w[f"b{side}"] = np.repeat([0.0, 1.0, 0.0, 0.0], HIDDEN)
        w["o"] = rng.normal(0, 0.3, 2 * HIDDEN)
        w["c"] = np.zeros(1)
        self.weights = {k: v.astype(np.float32) for k, v in w.items()}

    def _run(self, x: np.ndarray, mask: np.ndarray, side: str) -> list[tuple]:
        """Gates and states of each step over (steps, pages, width)."""
        w = self.weights
        steps, pages = x.shape[:2]
        fed = x.reshape(-1, WIDTH) @ w[f"X{side}"] + w[f"b{side}"]
        fed = fed.reshape(steps, pages, -1)
        h = c = np.zeros((pages, HIDDEN), np.float32)
        trace = [None] * steps
        for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
            gates = fed[t] + h @ w[f"H{side}"]
            i, f, o = (sigmoid(gates[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
            g = np.tanh(gates[:, 3 * HIDDEN :])
            m = mask[t][:, None]
            new = m * (f * c + i * g)
            top = np.tanh(new)
            out = m * o * top
            trace[t] = (i, f, o, g, c, top, h, out)
            h, c = out, new
        return trace

    def logits(self, x: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, dict]:
        traces = {side: self._run(x, mask, side) for side in "fb"}
        states = np.stack(
            [np.concatenate([a[-1], b[-1]], 1) for a, b in zip(traces["f"], traces["b"])]
        )
        return states @ self.weights["o"] + self.weights["c"][0], {"states": states, **traces}

    def gradients(self, x, mask, error, kept) -> dict[str, np.ndarray]:
        w = self.weights
        grad = {
            "o": np.tensordot(error, kept["states"], ((0, 1), (0, 1))),
            "c": np.array([error.sum()]),
        }
        back = error[:, :, None] * w["o"]
        steps = x.shape[0]
        for side, part in (("f", back[:, :, :HIDDEN]), ("b", back[:, :, HIDDEN:])):
            dgates = np.zeros((*x.shape[:2], 4 * HIDDEN), np.float32)
            dh = dc = np.zeros((x.shape[1], HIDDEN), np.float32)
            dH = np.zeros_like(w[f"H{side}"])
            for t in range(steps - 1, -1, -1) if side == "f" else range(steps):
                i, f, o, g, c, top, h, _ = kept[side][t]
                m = mask[t][:, None]
                dout = (part[t] + dh) * m
                dnew = (dc + dout * o * (1 - top**2)) * m
                d = np.concatenate(
                    [
                        dnew * g * i * (1 - i),
                        dnew * c * f * (1 - f),
                        dout * top * o * (1 - o),
                        dnew * i * (1 - g**2),
                    ],
                    1,
                )
                dgates[t] = d
                dH += h.T @ d
                dh, dc = d @ w[f"H{side}"].T, dnew * f
            flat = dgates.reshape(-1, 4 * HIDDEN)
            grad[f"X{side}"] = x.reshape(-1, WIDTH).T @ flat
            grad[f"H{side}"], grad[f"b{side}"] = dH, flat.sum(0)
        return {k: v.astype(np.float32) for k, v in grad.items()}

    def label(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """Whether each block of each page is main text; pages of like length run together."""
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        order = sorted((i for i, p in enumerate(pages) if len(p)), key=lambda i: len(pages[i]))
        start = 0
        while start < len(order):
            # As many pages as keep the padded batch small; a longer page runs with fewer others.
            longest = len(pages[order[min(start + 127, len(order) - 1)]])
            group = order[start : start + max(1, min(128, 60_000 // longest))]
            x, mask = _padded([pages[i] for i in group])
            logits, _ = self.logits(x, mask)
            for column, i in enumerate(group):
                out[i] = logits[: len(pages[i]), column] > 0
            start += len(group)
        return out


def _padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(map(len, pages))
    x = np.zeros((steps, len(pages), WIDTH), np.float32)
    mask = np.zeros((steps, len(pages)), np.float32)
    for column, page in enumerate(pages):
        x[: len(page), column], mask[: len(page), column] = page, 1
    return x, mask


# ------------------------------------------------------------------------- training


def weak_labels(blocks: list[Block]) -> np.ndarray | None:
    """Main text is what lies in ``article`` or ``main``, outside parts of another kind.

    None if the page does not name its article, or is nested too deeply to learn from.
    """
    if any(block.node and block.node.depth > DEEPEST for block in blocks):
        return None
    inside = np.zeros(len(blocks), bool)
    for i, block in enumerate(blocks):
        named = False
        for tokens in block.path:
            if tokens[0] in ("article", "main"):
                named = True
            elif any(_KIND_OF.get(t, 7) != 7 for t in tokens):
                named = False
                break
        inside[i] = named
    return inside if inside.any() and not inside.all() else None


def varied(blocks: list[Block], labels: np.ndarray, rng) -> tuple[list[Block], np.ndarray]:
    """The page with other names for its parts, and with some foreign parts inside the article."""
    main = _choice(rng, [["article"], ["main"], ["div", "content"], ["div", "post", "body"],
                         ["section", "story"], ["div", "entry", "content"], ["article", "post"], ["div"]])
    leaves = [[["ul"], ["li"]], [["blockquote"]], [["blockquote"], ["p"]], [["h2"]], [["div"]],
              [["table"], ["tr"], ["td"]], [["figure"], ["figcaption"]], [["pre"]]]
    names: dict[str, list[str]] = {}
    parts = []
    foreign = [b for b, y in zip(blocks, labels) if not y]
    for block, inside in zip(blocks, labels):
        if inside:
            path = [main if t[0] in ("article", "main") else t for t in block.path]
            if len(path) > 1 and rng.random() < 0.25:
                path = [*path[:-1], *_choice(rng, leaves)]
        else:
            key = " ".join(block.path[1]) if len(block.path) > 1 else ""
            if key not in names:
                names[key] = _foreign_name(rng)
            path = [block.path[0], names[key], *block.path[2:]] if key else block.path
        parts.append((Block(path, block.text, block.linked), inside))
    own = [i for i, (_, inside) in enumerate(parts) if inside]
    for _ in range(int(rng.integers(0, 4))):
        # A comment, notice or form inside the article may hold prose like the article's own.
        source = parts[_choice(rng, own)][0] if rng.random() < 0.6 or not foreign else _choice(rng, foreign)
        leaf = _choice(rng, [["p"], ["div"], ["li"], ["span"]])
        path = [["html"], ["body"], main, _foreign_name(rng), leaf]
        at = int(rng.integers(own[0], own[-1] + 2))
        parts.insert(at, (Block(path, source.text, source.linked), False))
        own = [i for i, (_, inside) in enumerate(parts) if inside]
    return [b for b, _ in parts], np.array([y for _, y in parts])


_NAMED = frozenset("article main section nav header footer aside figure figcaption menu".split())


def bare(blocks: list[Block]) -> list[Block]:
    """The page without names: elements that tell their part become ``div``, class, id and role go."""
    plain = lambda tokens: ["div" if tokens[0] in _NAMED else tokens[0]]
    return [Block([plain(tokens) for tokens in b.path], b.text, b.linked) for b in blocks]


def _choice(rng, values):
    return values[int(rng.integers(len(values)))]


def _foreign_name(rng) -> list[str]:
    _, words = _choice(rng, _FOREIGN)
    word = _choice(rng, words)
    if word in _BLOCKS and rng.random() < 0.5:
        return [word]
    return [_choice(rng, ["div", "section", "aside", "ul"]), word]


def train(pages: list[str], epochs: int = 6, seed: int = 3) -> Model:
    """Fit on a bounded list of pages that name their article; others teach nothing."""
    rng = np.random.default_rng(seed)
    examples = []
    variants = max(2, 2 * SAMPLE // max(1, len(pages)))  # few pages are varied more often
    for html in pages:
        blocks = blocks_of(html)
        labels = weak_labels(blocks)
        if labels is None:
            continue
        examples.append((vectors(blocks), labels))
        for _ in range(variants):
            more, marks = varied(blocks, labels, rng)
            examples.append((vectors(bare(more) if rng.random() < BARE else more), marks))
    model = Model(seed)
    adam = Adam(model.weights, 0.01)
    for _ in range(epochs):
        order = sorted(rng.permutation(len(examples)), key=lambda i: len(examples[i][0]) // 8)
        batches = [order[i : i + 24] for i in range(0, len(order), 24)]
        for k in rng.permutation(len(batches)):
            x, mask = _padded([examples[i][0] for i in batches[k]])
            y = np.zeros(mask.shape, np.float32)
            for column, i in enumerate(batches[k]):
                y[: len(examples[i][1]), column] = examples[i][1]
            logits, kept = model.logits(x, mask)
            error = ((sigmoid(logits) - y) * mask / mask.sum()).astype(np.float32)
            adam.step(model.gradients(x, mask, error, kept))
    return model


def learned(pages: DataFrame, html: str = "html", bound: int = SAMPLE) -> Model:
    """The labeller of at most ``bound`` pages, those with the smallest hashes of their content."""
    named = pages.where(F.col(html).isNotNull()).select(
        F.col(html).alias("html"), F.xxhash64(html).alias("mark")
    )
    marks = named.select("mark").distinct()
    chosen = smallest(marks, [F.col("mark")], marks.count(), bound)
    # At most ``bound`` marks: their size is bounded whatever the table holds.
    found = named.join(F.broadcast(chosen), "mark").groupBy("mark").agg(F.min("html").alias("html"))
    return train([r.html for r in sorted(found.collect())])


def extract(
    pages: DataFrame,
    model: Model,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
) -> DataFrame:
    """page_id, url, text of the blocks labelled as main text, and the numbers of blocks."""
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def of(rows):
        for start in range(0, len(rows), 256):
            part = [(r, blocks_of(r["html"])) for r in rows[start : start + 256]]
            marks = shared.value.label([vectors(blocks) for _, blocks in part])
            for (row, blocks), mark in zip(part, marks):
                text = "\n\n".join(b.text for b, m in zip(blocks, mark) if m)
                yield row["page_id"], row["url"], text, len(blocks), int(mark.sum())

    kinds = {c: pages.schema[c].dataType.simpleString() for c in (page_id, url)}
    schema = (
        f"page_id {kinds[page_id]}, url {kinds[url]}, text string, n_blocks int, n_main int"
    )
    named = pages.select(
        F.col(page_id).alias("page_id"),
        F.col(url).alias("url"),
        F.coalesce(F.col(html), F.lit("")).alias("html"),
    )
    return map_rows(named, schema, of, "html")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op3: the main text of every page."""
    pages = table(spark, sf_dir, "pages")
    return extract(pages, learned(pages)).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars")
    )
