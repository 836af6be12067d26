"""Main text of web pages by a bidirectional LSTM over the page's leaf blocks.

A page becomes the sequence of its text blocks. Each block is a vector: its tag path (tags,
classes and ids, hashed), its words (hashed), and a few measures. A bidirectional LSTM in numpy
reads the whole sequence, so every block is labelled with the context of the document. It is
trained on generated pages of many layouts, whose number is a documented parameter.
"""

from __future__ import annotations

import html
import random
import re
import zlib
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Generated pages the labeller is trained on.
TRAIN_PAGES = 800
EPOCHS, BATCH, RATE = 7, 20, 0.012
PATH_SIZE, WORD_SIZE, HIDDEN = 256, 32, 16
MEASURES = 6
#: Pages are labelled in batches of similar length of at most so many blocks.
BATCH_BLOCKS = 20_000
RESULT = "text string, n_chars bigint, n_blocks int, n_main int"

#: Elements whose content is not text of the page, and elements that end a block.
HIDDEN_TAGS = frozenset("script style noscript template svg math iframe object canvas audio video head select textarea button option datalist".split())
RAW_TAGS = frozenset("script style noscript template svg iframe textarea select canvas object".split())
BLOCK_TAGS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot "
    "th thead tr ul head title caption label input".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: An element's start that ends an open element of the second kind.
CLOSES = {"li": "li", "dt": "dd", "dd": "dt", "tr": "tr", "td": "td", "th": "th", "option": "option"}
MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>\"']*(?:\"[^\"]*\"[^>\"']*|'[^']*'[^>\"']*)*)>|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>",
    re.S,
)
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
PART = re.compile(r"[a-z]+")


def blocks(page: str | None) -> list[tuple[str, tuple[str, ...], int]]:
    """`(text, path, link characters)` of the leaf blocks of a page in order.

    Character references are decoded, white space becomes single spaces and `<br>` is a space.
    Comments, markup and the content of hidden elements are no text. Unclosed elements end where
    a new element of their kind or the parent's end ends them.
    """
    page = page or ""
    out: list[tuple[str, tuple[str, ...], int]] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []
    links, at = 0, 0

    def flush() -> None:
        nonlocal links
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            out.append((text, tuple(n for _, names in stack for n in names), links))
        parts.clear()
        links = 0

    hidden = 0
    low = page.lower()
    while True:
        found = MARKUP.search(page, at)
        piece = page[at : found.start() if found else len(page)]
        if piece and not hidden:
            parts.append(piece)
            if any(tag == "a" for tag, _ in stack):
                links += len(piece)
        if not found:
            break
        at = found.end()
        tag = (found[2] or found[5] or "").lower()
        if not tag:
            continue
        if found[1] or found[4]:
            if any(t == tag for t, _ in stack):
                if tag in BLOCK_TAGS:
                    flush()
                while True:
                    t, _ = stack.pop()
                    hidden -= t in HIDDEN_TAGS
                    if t == tag:
                        break
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag in RAW_TAGS:
            end = low.find(f"</{tag}", at)
            at = len(page) if end < 0 else (page.find(">", end) + 1 or len(page))
            parts.append(" ")
            continue
        if tag in BLOCK_TAGS:
            flush()
            if any(t == "p" for t, _ in stack):
                while stack:
                    t, _ = stack.pop()
                    hidden -= t in HIDDEN_TAGS
                    if t == "p":
                        break
            shut = CLOSES.get(tag)
            if shut and stack and stack[-1][0] in (shut, tag):
                stack.pop()
        if tag not in VOID_TAGS:
            names = [tag]
            for given in NAMES.findall(found[3] or found[6] or ""):
                names += [f".{p}" for p in PART.findall("".join(given).lower())]
            stack.append((tag, tuple(names)))
            hidden += tag in HIDDEN_TAGS
    flush()
    return out


_SLOTS: dict[tuple[str, int], int] = {}


def slot(name: str, size: int) -> int:
    known = _SLOTS.get((name, size))
    if known is None:
        if len(_SLOTS) > 500_000:
            _SLOTS.clear()
        known = _SLOTS[(name, size)] = zlib.crc32(name.lower().encode("utf-8", "replace")) % size
    return known


def vectors(found: list[tuple[str, tuple[str, ...], int]]) -> np.ndarray:
    """One row per block: tag path, words, measures."""
    width = PATH_SIZE + WORD_SIZE + MEASURES
    at, share, measures = [], [], []
    paths: dict[tuple[str, ...], list[int]] = {}
    for i, (text, path, links) in enumerate(found):
        slots = paths.get(path)
        if slots is None:
            slots = paths[path] = sorted({slot(name, PATH_SIZE) for name in path})
        base = i * width
        at += [base + s for s in slots]
        share += [1.0] * len(slots)
        words = text.split()
        base += PATH_SIZE
        at += [base + slot(w, WORD_SIZE) for w in words]
        share += [1.0 / len(words)] * len(words)
        stops = text.count(".") + text.count(",") + text.count("?") + text.count("!")
        measures.append((
            np.log1p(len(words)) / 5, min(1.0, links / max(1, len(text))), stops / len(words),
            i / len(found), text[0].isupper(), text[-1] in ".!?",
        ))
    out = np.bincount(at, share, len(found) * width).astype(np.float32).reshape(len(found), width)
    out[:, -MEASURES:] = measures
    return out


@dataclass
class Network:
    """Weights of both directions (input, recurrent, bias) and of the output."""

    forward: list[np.ndarray]
    backward: list[np.ndarray]
    out: list[np.ndarray] = field(default_factory=list)

    def parts(self) -> list[np.ndarray]:
        return [*self.forward, *self.backward, *self.out]


def fresh_network(seed: int) -> Network:
    rng = np.random.default_rng(seed)
    size = PATH_SIZE + WORD_SIZE + MEASURES

    def side() -> list[np.ndarray]:
        bias = np.zeros(4 * HIDDEN, np.float32)
        bias[HIDDEN : 2 * HIDDEN] = 1  # remember at first
        return [
            rng.normal(0, 0.15, (size, 4 * HIDDEN)).astype(np.float32),
            rng.normal(0, 0.2, (HIDDEN, 4 * HIDDEN)).astype(np.float32),
            bias,
        ]

    return Network(side(), side(), [rng.normal(0, 0.2, 2 * HIDDEN).astype(np.float32), np.zeros(1, np.float32)])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _run(weights: list[np.ndarray], x: np.ndarray, live: np.ndarray) -> tuple[np.ndarray, list]:
    """Hidden states of one direction over `(time, page, feature)`; dead steps keep the state."""
    steps, pages, _ = x.shape
    inputs = x @ weights[0] + weights[2]
    h, c = np.zeros((pages, HIDDEN), np.float32), np.zeros((pages, HIDDEN), np.float32)
    states, kept = np.zeros((steps, pages, HIDDEN), np.float32), []
    for t in range(steps):
        gates = inputs[t] + h @ weights[1]
        i, f, o = (_sigmoid(gates[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
        g = np.tanh(gates[:, 3 * HIDDEN :])
        alive = live[t][:, None]
        new_c = np.where(alive, f * c + i * g, c)
        tc = np.tanh(new_c)
        kept.append((h, c, i, f, o, g, tc, alive))
        h, c = np.where(alive, o * tc, h), new_c
        states[t] = h
    return states, kept


def _back(weights: list[np.ndarray], x: np.ndarray, kept: list, grad: np.ndarray) -> list[np.ndarray]:
    d_in, d_rec, d_bias = (np.zeros_like(w) for w in weights)
    dh_next, dc_next = np.zeros_like(grad[0]), np.zeros_like(grad[0])
    for t in range(len(kept) - 1, -1, -1):
        h, c, i, f, o, g, tc, alive = kept[t]
        dh = grad[t] + dh_next
        held_h, held_c = np.where(alive, 0, dh), np.where(alive, 0, dc_next)
        dh = np.where(alive, dh, 0)
        dc = np.where(alive, dc_next, 0) + dh * o * (1 - tc * tc)
        gates = np.concatenate([dc * g * i * (1 - i), dc * c * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], axis=1)
        d_in += x[t].T @ gates
        d_rec += h.T @ gates
        d_bias += gates.sum(axis=0)
        dh_next, dc_next = gates @ weights[1].T + held_h, dc * f + held_c
    return [d_in, d_rec, d_bias]


def _padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    longest = max(map(len, pages))
    x = np.zeros((longest, len(pages), pages[0].shape[1]), np.float32)
    live = np.zeros((longest, len(pages)), bool)
    for p, rows in enumerate(pages):
        x[: len(rows), p], live[: len(rows), p] = rows, True
    return x, live


def scores(network: Network, pages: list[np.ndarray]) -> list[np.ndarray]:
    """Main-text probability of every block of every page; pages have at least one block."""
    x, live = _padded(pages)
    ahead, behind = _run(network.forward, x, live)[0], _run(network.backward, x[::-1], live[::-1])[0]
    p = _sigmoid(np.concatenate([ahead, behind[::-1]], axis=2) @ network.out[0] + network.out[1])
    return [p[: len(rows), i] for i, rows in enumerate(pages)]


def train(n_pages: int = TRAIN_PAGES, seed: int = 7) -> Network:
    """Adam over generated pages; the same number and seed give the same network."""
    rng = random.Random(seed)
    made = [generated_page(rng) for _ in range(n_pages)]
    data = [(vectors(found), np.array([text in main for text, _, _ in found], np.float32)) for found, main in ((blocks(page), main) for page, main in made) if found]
    network = fresh_network(seed)
    steps = EPOCHS * -(-len(data) // BATCH)
    first, second, step = [np.zeros_like(w) for w in network.parts()], [np.zeros_like(w) for w in network.parts()], 0
    for _ in range(EPOCHS):
        rng.shuffle(data)
        for low in range(0, len(data), BATCH):
            part = data[low : low + BATCH]
            x, live = _padded([v for v, _ in part])
            y = np.zeros(live.shape, np.float32)
            for i, (_, labels) in enumerate(part):
                y[: len(labels), i] = labels
            ahead, kept_a = _run(network.forward, x, live)
            behind, kept_b = _run(network.backward, x[::-1], live[::-1])
            both = np.concatenate([ahead, behind[::-1]], axis=2)
            error = np.where(live, _sigmoid(both @ network.out[0] + network.out[1]) - y, 0) / live.sum()
            d_both = error[:, :, None] * network.out[0]
            grads = [
                *_back(network.forward, x, kept_a, d_both[:, :, :HIDDEN]),
                *_back(network.backward, x[::-1], kept_b, d_both[::-1, :, HIDDEN:]),
                (error[:, :, None] * both).sum(axis=(0, 1)),
                np.array([error.sum()], np.float32),
            ]
            step += 1
            for w, m, v, g in zip(network.parts(), first, second, grads):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                w -= RATE * (1 - (step - 1) / steps) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
    return network


#: Names that pages give to their parts, and words that stand in them.
MAIN_NAMES = "content article-body post entry-content story main-content article post-body text body-text".split()
SIDE_NAMES = {
    "nav": "nav menu navbar topnav breadcrumbs main-menu links".split(),
    "header": "header masthead site-header top banner-top logo".split(),
    "footer": "footer site-footer copyright bottom legal".split(),
    "aside": "sidebar related widget aside trending more-stories".split(),
    "ad": "ad ads advert banner sponsored promo advertisement ad-slot".split(),
    "notice": "cookie notice consent gdpr alert popup modal".split(),
    "form": "search subscribe newsletter login signup form contact-form".split(),
    "comments": "comments comment comment-list replies discussion responses reader-comments".split(),
}
SIDE_WORDS = {
    "nav": "Home About Contact News Sports Login Register Menu Help Shop",
    "header": "Daily Site Welcome Search The Online Magazine",
    "footer": "© Copyright All rights reserved Privacy Terms example.com Impressum ·",
    "aside": "Related Popular Latest Read more Trending Tags Archive",
    "ad": "Buy now Sale Offer Sponsored Advertisement Free Click",
    "notice": "We use cookies Accept Agree This site privacy settings",
    "form": "Subscribe Email Name Send Password Sign up newsletter",
    "comments": "says: Reply Great post I agree Posted by Anonymous Comment",
}


def generated_page(rng: random.Random) -> tuple[str, set[str]]:
    """A made-up page and the set of its main blocks' texts."""
    syllables = ["".join(rng.choice("bcdfghklmnprstvwzéèäöüñ") + rng.choice("aeiouáöê") for _ in range(rng.randint(1, 2))) for _ in range(25)]

    def word() -> str:
        return "".join(rng.choice(syllables) for _ in range(rng.randint(1, 3)))

    def sentence(n: int) -> str:
        return " ".join(word() for _ in range(n)).capitalize() + rng.choice("...!?")

    def prose() -> str:
        text = " ".join(sentence(rng.randint(1, 18)) for _ in range(rng.choice([1, 1, 2, 3, 6])))
        odd = rng.random()
        if odd < 0.06:
            return text.replace(" ", rng.choice([" | ", "!! ", " "]))
        if odd < 0.12:
            return text.upper()
        return text + rng.choice(["", "", "", " %%% $$$", " & more"])

    main: set[str] = set()

    def body(text: str) -> str:
        main.add(" ".join(text.split()))
        return html.escape(text, quote=False)

    def side(kind: str) -> str:
        def text() -> str:
            known = rng.sample(SIDE_WORDS[kind].split(), rng.randint(0, 4)) if rng.random() < 0.6 else []
            return html.escape(" ".join([*known, *(word() for _ in range(rng.randint(1, 4)))] + ([prose()] if kind in ("ad", "comments", "notice", "aside", "footer") and rng.random() < 0.7 else [])))

        tag = {"nav": "nav", "header": "header", "footer": "footer", "aside": "aside", "form": "form"}.get(kind, "div")
        tag = tag if rng.random() < 0.6 else rng.choice(["div", "section"])
        name = f' {rng.choice(["class", "id"])}="{rng.choice(SIDE_NAMES[kind])}"' if tag in ("div", "section") or rng.random() < 0.3 else ""
        n = rng.randint(1, 6)
        if kind == "nav" or rng.random() < 0.25:
            inner = "<ul>" + "".join(f'<li><a href="/{word()}">{text()}</a></li>' for _ in range(n)) + "</ul>"
        elif kind == "form":
            inner = f"<label>{text()}</label><input name=q><button>{word()}</button>"
        elif kind == "comments":
            inner = "".join(f'<div class="comment"><b>{word()}</b><p>{text()}</p></div>' for _ in range(n))
        elif rng.random() < 0.4:
            inner = text()
        else:
            inner = "".join(f"<p>{text()}</p>" for _ in range(rng.randint(1, 3)))
        return f"<{tag}{name}>{inner}</{tag}>"

    title = sentence(rng.randint(2, 9))
    inside = [f"<h1>{body(title)}</h1>"] if rng.random() < 0.85 else []
    if rng.random() < 0.3 and inside:
        inside = [f"<header>{inside[0]}</header>"] if rng.random() < 0.3 else inside
    for _ in range(rng.choice([1, 2, 4, 8, 12])):
        kind = rng.random()
        text = prose()
        if kind < 0.7:
            inside.append(f"<p>{body(text)}</p>")
        elif kind < 0.82:
            inside.append(f"<p><b>{body(text)}<br>")
        elif kind < 0.88:
            inside.append(f"<h2>{body(sentence(4))}</h2>")
        elif kind < 0.94:
            inside.append("<ul>" + "".join(f"<li>{body(sentence(5))}</li>" for _ in range(3)) + "</ul>")
        else:
            inside.append(f"<blockquote>{body(text)}</blockquote>")
    for kind in ("ad", "aside", "form", "notice"):
        if rng.random() < 0.12:
            inside.insert(rng.randint(1 if len(inside) > 1 else 0, len(inside)), side(kind))
    tag = rng.choice(["article", "article", "main", "div", "section"])
    name = f' class="{rng.choice(MAIN_NAMES)}"' if tag in ("div", "section") or rng.random() < 0.3 else ""
    content = f"<{tag}{name}>{''.join(inside)}</{tag}>"
    before = [side(k) for k in ("notice", "header", "nav", "ad", "aside", "form") if rng.random() < 0.4]
    after = [side(k) for k in ("ad", "aside", "comments", "form", "notice", "nav") if rng.random() < 0.3]
    rng.shuffle(before)
    foot = [side("footer")] if rng.random() < 0.85 else []
    middle = "".join([*before, content, *after])
    if rng.random() < 0.3:
        middle = f'<div class="{rng.choice(["wrapper", "page", "container", "site"])}">{middle}</div>'
    return f"<!DOCTYPE html><html><head><title>{title}</title></head><body>{middle}{''.join(foot)}</body></html>", main


def extracted(network: Network, page: Column) -> Column:
    """A struct column of type RESULT for a column of pages."""

    def run(pages: pd.Series) -> pd.DataFrame:
        rows: list = [("", 0, 0, 0)] * len(pages)
        found = [(i, f) for i, f in enumerate(map(blocks, pages)) if f]
        # Pages of like length share a batch, so little of it is padding.
        found.sort(key=lambda x: len(x[1]))
        low = 0
        while low < len(found):
            high = low + 1
            while high < len(found) and len(found[high][1]) * (high + 1 - low) <= BATCH_BLOCKS and high - low < 256:
                high += 1
            part = found[low:high]
            for (i, parts), p in zip(part, scores(network, [vectors(f) for _, f in part])):
                kept = [text for (text, _, _), share in zip(parts, p) if share >= 0.5]
                text = "\n\n".join(kept)
                rows[i] = (text, len(text), len(parts), len(kept))
            low = high
        return pd.DataFrame(rows, columns=["text", "n_chars", "n_blocks", "n_main"])

    return F.pandas_udf(run, RESULT)(page)


def extract_pages(pages: DataFrame, train_pages: int = TRAIN_PAGES) -> DataFrame:
    """`page_id, url, text, n_chars, n_blocks, n_main` of every row of `pages`.

    A null or empty page, or one without a block, gives an empty text. Repeated rows and null ids
    stay; other columns are ignored.
    """
    network = train(train_pages)
    return pages.select("page_id", "url", extracted(network, F.col("html")).alias("e")).select("page_id", "url", "e.*")
