"""Main text of web pages: a bidirectional LSTM labels every block of a page with the whole page in view."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkrank.llm.common import bounded_batches, strings, task

#: Pages, at most about, from which the labeller is trained.
SAMPLE_PAGES = 300
#: Bytes of them, at most about.
SAMPLE_BYTES = 64 << 20
#: Blocks of a page seen at a time in training, and pages labelled together.
WINDOW, TOGETHER = 64, 256
#: Most cells (pages x blocks) of a group labelled together.
CELLS = 32_768
PATHS, WORDS, NUMBERS, HIDDEN = 256, 64, 4, 24
WIDTH = PATHS + WORDS + NUMBERS

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe svg textarea select".split())
#: Formulas stand within a text, so their elements don't end a block either.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q ruby rt rp s samp small span strike strong sub sup time tt u var wbr "
    "math mrow mi mn mo ms mtext mspace mfrac msqrt mroot msub msup msubsup munder mover munderover mmultiscripts mpadded mphantom mstyle menclose mtable mtr mtd semantics annotation".split()
)
#: An opening tag that ends an open element of the same kind.
ALONE = frozenset("p li dt dd option tr td th".split())
TOKEN = re.compile(r"<!--|<!\[CDATA\[|<[!?]|<(/?)([a-zA-Z][^\s/>]*)")
QUOTE = re.compile(r"[\"']")
NAME = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)


class Element:
    """An open element with the one around it. ``mask`` has a bit for each hashed name on the way down to it, inline elements aside."""

    __slots__ = ("around", "mask", "name", "tag")

    def __init__(self, tag: str, name: str, around: Element | None):
        self.tag, self.name, self.around = tag, name, around
        self.mask = (around.mask if around else 0) | _name_mask(name)

    def path(self) -> tuple[str, ...]:
        names, at = [], self
        while at:
            names.append(at.name)
            at = at.around
        return tuple(reversed(names))


class Block(NamedTuple):
    element: Element | None
    text: str
    linked: int

    @property
    def path(self) -> tuple[str, ...]:
        """The elements around the block, inline ones aside, from the outermost one."""
        return self.element.path() if self.element else ()


class _Page:
    """Markup of a page, found from left to right. Where something is missing from a place on, it is not looked for again."""

    def __init__(self, page: str):
        self.page = page
        self.missing: set[str] = set()

    def find(self, what: str, at: int) -> int:
        if what in self.missing:
            return -1
        found = self.page.find(what, at)
        if found < 0:
            self.missing.add(what)
        return found

    def end_of(self, what: str, at: int) -> int:
        """Behind the next ``what``, or at the end of the page."""
        found = self.find(what, at)
        return found + len(what) if found >= 0 else len(self.page)

    def end_of_tag(self, at: int, first: int) -> int:
        """Behind the first ``>`` outside quotes; ``first`` is the first one at all, which counts if a quote isn't closed."""
        place, stop = at, first
        while quote := QUOTE.search(self.page, place, stop):
            place = self.find(quote[0], quote.end()) + 1
            if place > stop:
                stop = self.find(">", place)
            if not place or stop < 0:
                return first + 1
        return stop + 1


def blocks_of(page: str) -> list[Block]:
    """Texts between the bounds of block elements, in order, each with the elements around it; raw elements and markup go.

    Inline elements don't end a block and a line break is white space. Elements left open end with the one around them. The time
    grows with the length of the page, whatever is left open in it.
    """
    stack: list[tuple[str, Element | None]] = []  # tag, and the nearest block element from there on outwards
    open_: dict[str, int] = {}
    parts: list[str] = []
    out: list[Block] = []
    scan, linked, at, end = _Page(page), 0, 0, len(page)

    def flush() -> None:
        nonlocal linked
        if parts:
            text = "".join(parts)
            text = " ".join((html.unescape(text) if "&" in text else text).split())
            if text:
                out.append(Block(stack[-1][1] if stack else None, text, linked))
            parts.clear()
        linked = 0

    def close(tag: str) -> None:
        """Ends the innermost open element of that kind, and all within it."""
        while stack:
            last = stack.pop()[0]
            open_[last] -= 1
            if last == tag:
                break

    def add(text: str) -> None:
        nonlocal linked
        if text:
            parts.append(text)
            linked += len(text) * (open_.get("a", 0) > 0)

    while at < end:
        token = TOKEN.search(page, at)
        start = token.start() if token else end
        add(page[at:start])
        if not token:
            break
        if token[0] == "<!--":
            at = scan.end_of("-->", token.end())
            continue
        first = scan.find(">", start)
        if first < 0:  # no more markup but a comment that runs on to the end
            comment = page.find("<!--", start)
            add(page[start : comment if comment >= 0 else end])
            break
        if token[1] is None:
            at = scan.end_of("]]>" if token[0] == "<![CDATA[" and scan.find("]]>", start) >= 0 else ">", start)
            continue
        named = token.end()
        at = scan.end_of_tag(named, first)
        closing, name, rest = token[1], token[2].lower(), page[named : at - 1]
        if closing:
            if name not in INLINE:
                flush()
            if open_.get(name):
                close(name)
            continue
        if name in RAW and not rest.endswith("/"):
            shut = _raw_end(name).search(page, at) if f"</{name}" not in scan.missing else None
            if not shut:
                scan.missing.add(f"</{name}")
            at = shut.end() if shut else end
            continue
        if name == "br":
            parts.append(" ")
        elif name not in INLINE:
            flush()
        if name in VOID:
            continue
        around = stack[-1][1] if stack else None
        if name in ALONE and around and around.tag == name:
            close(name)
            around = stack[-1][1] if stack else None
        if name not in INLINE:
            named = " ".join(f"{m[1].lower()}={m[2] or m[3] or m[4] or ''}" for m in NAME.finditer(rest)) if rest else ""
            around = Element(name, f"{name} {named}" if named else name, around)
        stack.append((name, around))
        open_[name] = open_.get(name, 0) + 1
    flush()
    return out


@lru_cache(64)
def _raw_end(name: str) -> re.Pattern:
    return re.compile(rf"</{re.escape(name)}\s*>", re.I)


def _slot(text: str) -> int:
    return crc32(text.encode()) % PATHS


@lru_cache(1 << 16)
def _name_mask(name: str) -> int:
    """Bits of an element's tag and of the words of its class, id and role."""
    tag, _, rest = name.partition(" ")
    words = re.findall(r"[a-z]+", re.sub(r"\b(class|id|role)=", " ", rest).lower())
    return sum(1 << k for k in {_slot(x) for x in (f"<{tag}>", *words)})


class Vectors:
    """Input of the network: hashed names along the path, hashed words, and a few numbers for each block."""

    def __init__(self):
        self.slots: dict[int, np.ndarray] = {}

    def path(self, element: Element | None) -> np.ndarray:
        """Slots of all names on the path, and of the last one."""
        mask = element.mask | 1 << _slot(f"last {element.tag}") if element else 0
        slots = self.slots.get(mask)
        if slots is None:
            if len(self.slots) > 50_000:
                self.slots.clear()
            bits = np.unpackbits(np.frombuffer(mask.to_bytes(PATHS // 8, "little"), np.uint8), bitorder="little")
            slots = self.slots[mask] = np.flatnonzero(bits)
        return slots

    def fill(self, pages: list[list[Block]]) -> tuple[np.ndarray, np.ndarray]:
        """Array of (page, block, WIDTH) and the number of blocks of each page."""
        sizes = np.array([len(p) for p in pages])
        longest = int(sizes.max(initial=0))
        x = np.zeros((len(pages) * longest, WIDTH), np.float32)
        rows, slots, words, counts = [], [], [], []
        for i, page in enumerate(pages):
            for k, block in enumerate(page):
                row = i * longest + k
                path = self.path(block.element)
                rows.append(np.full(len(path), row))
                slots.append(path)
                hashed = [crc32(w) % WORDS for w in block.text.encode().split()]
                words += hashed
                counts.append((row, len(hashed)))
                n = len(block.text)
                x[row, PATHS + WORDS :] = np.log1p(n) / 6, min(1.0, block.linked / n), k / 50 if k < 50 else 1.0, block.text[-1] in ".!?"
        if rows:
            x[np.concatenate(rows), np.concatenate(slots)] = 1
            row, n = np.array(counts).T
            both = np.bincount(np.repeat(np.arange(len(row)), n) * WORDS + np.array(words, np.int64), minlength=len(row) * WORDS)
            x[row, PATHS : PATHS + WORDS] = both.reshape(-1, WORDS) / np.maximum(n, 1)[:, None]
        return x.reshape(len(pages), longest, WIDTH), sizes


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


class Labeller:
    """Two LSTMs, one along the blocks and one against, and a logistic unit on both states of a block."""

    def __init__(self, weights: dict[str, np.ndarray] | None = None, seed: int = 1):
        if weights is None:
            rng = np.random.default_rng(seed)
            weights = {"out": rng.normal(0, 0.3, 2 * HIDDEN), "bias": np.zeros(1)}
            for d in ("f", "b"):
                weights |= {f"x{d}": rng.normal(0, 0.15, (WIDTH, 4 * HIDDEN)), f"h{d}": rng.normal(0, 0.2, (HIDDEN, 4 * HIDDEN)), f"c{d}": np.repeat([0.0, 1.0, 0.0, 0.0], HIDDEN)}
        self.w = {k: np.asarray(v, np.float32) for k, v in weights.items()}

    @staticmethod
    def _turned(sizes: np.ndarray, longest: int) -> np.ndarray:
        """Index that turns each row of blocks round and leaves the padding where it is."""
        t = np.arange(longest)[None]
        return np.where(t < sizes[:, None], sizes[:, None] - 1 - t, t)

    def _run(self, d: str, x: np.ndarray, keep: list | None) -> np.ndarray:
        """Hidden states (page, block, HIDDEN); keep gets what the way back needs."""
        gates = x @ self.w[f"x{d}"] + self.w[f"c{d}"]
        h = np.zeros((len(x), HIDDEN), np.float32)
        c, out = h, np.zeros((*x.shape[:2], HIDDEN), np.float32)
        for t in range(x.shape[1]):
            g = gates[:, t] + h @ self.w[f"h{d}"]
            i, f, o = (_sigmoid(g[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
            z = np.tanh(g[:, 3 * HIDDEN :])
            before, c = c, f * c + i * z
            tc = np.tanh(c)
            if keep is not None:
                keep.append((i, f, o, z, before, tc, h))
            h = out[:, t] = o * tc
        return out

    def forward(self, x: np.ndarray, sizes: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Logit of each block."""
        turn = self._turned(sizes, x.shape[1])[:, :, None]
        turned = np.take_along_axis(x, turn, 1)
        kept = {d: [] if keep is not None else None for d in "fb"}
        ahead, back = self._run("f", x, kept["f"]), self._run("b", turned, kept["b"])
        back = np.take_along_axis(back, turn, 1)
        both = np.concatenate([ahead, back], 2)
        if keep is not None:
            keep |= {"both": both, "turn": turn, "x": {"f": x, "b": turned}, **kept}
        return both @ self.w["out"] + self.w["bias"]

    def gradient(self, x: np.ndarray, sizes: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        keep: dict = {}
        logits = self.forward(x, sizes, keep)
        real = np.arange(x.shape[1])[None] < sizes[:, None]
        p = _sigmoid(logits)
        n = max(int(real.sum()), 1)
        loss = float(-(np.where(y > 0, np.log(p + 1e-7), np.log(1 - p + 1e-7)) * real).sum() / n)
        d_logit = ((p - y) * real / n).astype(np.float32)
        grad = {"out": np.einsum("btk,bt->k", keep["both"], d_logit), "bias": np.array([d_logit.sum()], np.float32)}
        d_both = d_logit[:, :, None] * self.w["out"]
        for d, d_out in (("f", d_both[:, :, :HIDDEN]), ("b", np.take_along_axis(d_both[:, :, HIDDEN:], keep["turn"], 1))):
            steps, wh = keep[d], self.w[f"h{d}"]
            d_gates = np.zeros((*x.shape[:2], 4 * HIDDEN), np.float32)
            dh = dc = np.zeros((len(x), HIDDEN), np.float32)
            grad[f"h{d}"] = np.zeros_like(wh)
            for t in range(x.shape[1] - 1, -1, -1):
                i, f, o, z, before, tc, h = steps[t]
                dh = dh + d_out[:, t]
                dc = dc + dh * o * (1 - tc * tc)
                g = d_gates[:, t] = np.concatenate([dc * z * i * (1 - i), dc * before * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - z * z)], 1)
                grad[f"h{d}"] += h.T @ g
                dh, dc = g @ wh.T, dc * f
            flat = d_gates.reshape(-1, 4 * HIDDEN)
            grad[f"x{d}"] = keep["x"][d].reshape(-1, WIDTH).T @ flat
            grad[f"c{d}"] = flat.sum(0)
        return loss, grad

    def train(self, pages: list[tuple[list[Block], np.ndarray]], steps: int = 260, batch: int = 32, rate: float = 0.01, seed: int = 2) -> float:
        """Adam on windows of pages; returns the mean loss of the last steps."""
        rng, vectors = np.random.default_rng(seed), Vectors()
        first, second, losses = ({k: np.zeros_like(v) for k, v in self.w.items()} for _ in range(2)), None, []
        first, second = first
        for step in range(1, steps + 1):
            chosen = []
            for k in rng.integers(0, len(pages), batch):
                blocks, y = pages[k]
                at = int(rng.integers(0, max(1, len(blocks) - WINDOW + 1)))
                chosen.append((blocks[at : at + WINDOW], y[at : at + WINDOW]))
            x, sizes = vectors.fill([b for b, _ in chosen])
            y = np.zeros(x.shape[:2], np.float32)
            for i, (_, v) in enumerate(chosen):
                y[i, : len(v)] = v
            # A page may be seen without names, so that words, place and neighbours are learned too.
            x[:, :, :PATHS] *= rng.random((1, 1, PATHS)) > 0.05
            loss, grad = self.gradient(x, sizes, y)
            losses.append(loss)
            speed = rate * min(1.0, 2 * (1 - step / (steps + 1)))
            for k, g in grad.items():
                g = np.clip(g, -1, 1)
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.001 * (g * g - second[k])
                self.w[k] -= speed * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
        return float(np.mean(losses[-20:]))

    def label(self, pages: list[list[Block]], vectors: Vectors) -> list[np.ndarray]:
        """Whether each block is main text; pages of like length go together, none is cut."""
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        order = [i for i in sorted(range(len(pages)), key=lambda i: len(pages[i])) if pages[i]]
        at = len(order)
        while at > 0:
            n = max(1, min(TOGETHER, CELLS // len(pages[order[at - 1]])))
            group = order[max(0, at - n) : at]
            at -= len(group)
            x, sizes = vectors.fill([pages[i] for i in group])
            logits = self.forward(x, sizes)
            for i, row, size in zip(group, logits, sizes, strict=True):
                out[i] = row[:size] > 0
        return out


#: Names by which a training page tells its parts apart. Fixed values.
MAIN_TAGS = ("<article>", "<main>", '<div class="content">', '<div id="main-content">', '<section class="post-body">', '<div class="article-body">', '<div class="entry-content">', '<div role="main">', '<div class="story text">')
OTHER_PARTS = {
    "header": ("<header>", '<div class="header">', '<div id="masthead" class="top">'),
    "menu": ("<nav>", '<ul class="menu">', '<div class="navigation breadcrumb">', '<div class="nav links">'),
    "side": ("<aside>", '<div class="sidebar">', '<div class="related widget">', '<div id="side" class="recommended">'),
    "advert": ('<div class="ad">', '<div class="ads banner">', '<div class="advert sponsored">', '<div class="advertisement promo">'),
    "notice": ('<div class="cookie notice">', '<div class="cookie-consent banner">', '<div id="gdpr" class="alert">', '<div class="newsletter popup">', '<div class="notice">', '<div role="alert">'),
    "form": ("<form>", '<form class="search">', '<form id="subscribe" class="login">'),
    "comments": ('<section class="comments">', '<div id="comments">', '<div class="comment reply">', '<ol class="comment-list discussion">'),
    "footer": ("<footer>", '<div class="footer">', '<div id="footer" class="copyright legal">'),
}
INNER = ("<p>{}</p>", "<p>{}</p>", "<div>{}</div>", "<ul><li>{}</li></ul>", "<span>{}</span>", "<h3>{}</h3>", '<a href="/">{}</a>', '<ul><li><a href="/">{}</a></li></ul>', "<label>{}</label>", "<div><p>{}</p></div>")
OUTER = ("header", "menu", "side", "advert", "notice", "form", "comments", "footer")


MAIN = re.compile(r"^(article|main)\b|role=main")
OTHER = re.compile(r"^(nav|header|footer|aside|form)\b|\b(ad|ads|comments?|sidebar|cookie|notice)\b")


def weak_labels(blocks: list[Block]) -> np.ndarray | None:
    """Labels by the page's own article or main element, less what lies in a part of another kind; None without one."""
    kinds: dict[Element | None, tuple[bool, bool]] = {None: (False, False)}

    def kind(element: Element | None) -> tuple[bool, bool]:
        """Whether an element lies within the main one, and within a part of another kind."""
        way = []
        while element not in kinds:
            way.append(element)
            element = element.around
        inside, other = kinds[element]
        for x in reversed(way):
            inside, other = inside or bool(MAIN.search(x.name)), other or bool(OTHER.search(x.name))
            kinds[x] = inside, other
        return inside, other

    found = [kind(b.element) for b in blocks]
    return np.array([i and not o for i, o in found]) if any(i for i, _ in found) else None


def training_page(rng, texts: list[str]) -> tuple[list[Block], np.ndarray]:
    """A page put together anew from texts of real pages, parts of all kinds around and within the main one, and its labels.

    Words are the same in all parts, so names, place and neighbours must tell them apart. A sign marks the main blocks.
    """
    sign = "\x01"

    def text(words: int) -> str:
        source = texts[int(rng.integers(len(texts)))].split() or ["text"]
        at = int(rng.integers(max(1, len(source) - words)))
        return html.escape(" ".join(source[at : at + words])) or "text"

    def part(kind: str) -> str:
        tag = OTHER_PARTS[kind][int(rng.integers(len(OTHER_PARTS[kind])))]
        long = kind in ("comments", "side", "notice", "advert")
        inner = "".join(INNER[int(rng.integers(len(INNER)))].format(text(int(rng.integers(1, 40 if long else 8)))) for _ in range(int(rng.integers(1, 5))))
        if rng.random() < 0.4:
            inner = text(int(rng.integers(1, 30)))
        return f"{tag}{inner}</{re.match(r'<(\w+)', tag)[1]}>"

    tag = MAIN_TAGS[int(rng.integers(len(MAIN_TAGS)))]
    body = [f"<h1>{sign}{text(8)}</h1>"] if rng.random() < 0.8 else []
    for _ in range(int(rng.integers(1, 14))):
        shape = ("<p>{}</p>", "<p>{}</p>", "<p>{}</p>", "<p><b>{}<br>", "<h2>{}</h2>", "<blockquote>{}</blockquote>", "<ul><li>{}</li></ul>", "<div>{}</div>", "<pre>{}</pre>")[int(rng.integers(9))]
        body.append(shape.format(sign + text(int(rng.integers(1, 60)))))
        if rng.random() < 0.08:
            body.append(part(("advert", "side", "notice", "form", "comments")[int(rng.integers(5))]))
    main = f"{tag}{''.join(body)}</{re.match(r'<(\w+)', tag)[1]}>"
    before = [part(k) for k in ("header", "menu", "notice", "advert", "side") if rng.random() < 0.45]
    after = [part(k) for k in ("side", "advert", "form", "comments", "notice", "footer") if rng.random() < 0.45]
    page = "".join([*before, main, *after])
    if rng.random() < 0.3:
        page = f'<div class="page wrapper">{page}</div>'
    blocks = blocks_of(f"<html><body>{page}</body></html>")
    y = np.array([b.text.startswith(sign) for b in blocks])
    return [b._replace(text=b.text.removeprefix(sign) or "-") for b in blocks], y


def learn(pages: DataFrame, sample_pages: int = SAMPLE_PAGES, sample_bytes: int = SAMPLE_BYTES, seed: int = 4) -> Labeller:
    """Trained on about ``sample_pages`` pages, of about ``sample_bytes`` at most, whose whole html reaches the driver.

    They are chosen by a hash of page_id and html after rows alike in both are merged, so null or repeated ids weigh no more than others.

    Pages with an article or main element are labelled by it; as many pages again are put together anew from the texts of the
    sample, to learn parts that few pages have. Without any page a stock word serves as text.
    """
    bounded_batches(pages.sparkSession)
    rows = pages.select("page_id", F.col("html").cast("string").alias("html")).where("html is not null").withColumn("hash", F.xxhash64("html"))
    unlike = rows.select("page_id", "hash", F.octet_length("html").alias("bytes")).distinct().agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes")).first()
    share = min(1.0, sample_pages / max(unlike["n"], 1), sample_bytes / max(unlike["bytes"] or 0, 1))
    chosen = rows.where(F.pmod(F.xxhash64("page_id", "hash"), F.lit(1_000_000)) < share * 1_000_000).dropDuplicates(["page_id", "hash"])
    sample = sorted(r["html"] for r in chosen.select("html").collect())
    real = [(b, weak_labels(b)) for b in map(blocks_of, sample)]
    rng = np.random.default_rng(seed)
    texts = [x.text for b, _ in real for x in b] or ["text"]
    made = [training_page(rng, texts) for _ in range(2 * sample_pages)]
    labeller = Labeller()
    labeller.train([(b, y.astype(np.float32)) for b, y in [*((b, y) for b, y in real if y is not None), *made] if b])
    return labeller


def _extract(batches: Iterator[pa.RecordBatch], weights: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    labeller, vectors = Labeller(weights), Vectors()
    for batch in batches:
        pages = [blocks_of(x) for x in strings(batch, "html")]
        texts = ["\n".join(b.text for b, main in zip(p, y, strict=True) if main) for p, y in zip(pages, labeller.label(pages, vectors), strict=True)]
        yield pa.record_batch([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame, labeller: Labeller) -> DataFrame:
    """``(page_id, url, text, n_chars)`` for each row of ``pages (page_id, url, html)``; other columns are not looked at.

    text has the blocks that the labeller takes for main text, in page order, joined by newlines: references decoded, white
    space as single spaces. A null html, and a page without main text, gives the empty text. Null ids and repeated rows stay as they are.
    """
    bounded_batches(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return rows.mapInArrow(task(_extract, weights=labeller.w), "page_id long, url string, text string, n_chars long")
