"""A recurrent labeller of page blocks, in numpy.

Each block is a vector of hashed parts of its tag path, hashed words and a few measures. A bidirectional
LSTM reads the blocks of a page in order, so that every block is judged with the whole page in view.
Pages carry no labels; the network is trained on generated layouts, of which it is known what is main
text. The seed is fixed, the training set and the model have a fixed size.
"""

from __future__ import annotations

import functools
import random
import zlib

import numpy as np

from .html_blocks import Block, blocks

PATH, WORD, MEASURES = 128, 24, 6
INPUTS = PATH + WORD + MEASURES
HIDDEN = 12
PAGES, EPOCHS, BATCH, RATE = 700, 5, 20, 0.02
CACHED = 100_000
PADDED_CELLS = 40_000

#: Stands before main text in generated pages, and is taken away before anything is learned.
MARK = "\ue000"

#: Names of page regions that the generated layouts use.
REGIONS = {
    "menu": ["nav", "nav class=menu", "div class=nav", "ul class=menu", "div id=navigation", "div class=breadcrumb", "div class=topbar", "nav role=navigation", "div class=navbar", "ul class=pagination"],
    "head": ["header", "div id=header", "div class=masthead", "div class=site-header", "header class=banner", "div role=banner"],
    "foot": ["footer", "div id=footer", "div class=footer", "footer role=contentinfo", "div class=copyright", "div class=site-footer"],
    "side": ["aside", "div class=sidebar", "div id=sidebar", "aside class=related", "div class=widget", "section class=related", "div class=recommended", "div class=share", "div class=social", "div class=tags"],
    "ad": ["div class=ad", "div class=ads", "div class=advert", "div id=ad-top", "aside class=sponsored", "div class=promo", "div class=banner-ad", "div class=advertisement", "section class=ad"],
    "notice": ["div class=cookie", "div id=cookie-notice", "div class=cookie-banner", "div role=alert", "div class=notice", "div class=popup", "div class=consent", "div class=modal", "div role=dialog", "div class=newsletter", "div class=gdpr"],
    "form": ["form", "form class=search", "form id=login", "form class=subscribe", "fieldset", "form class=newsletter"],
    "comments": ["section class=comments", "div id=comments", "div class=comment-list", "ol class=commentlist", "div class=reader-comments", "section id=discussion class=comments", "div class=comment", "ul class=comments"],
}
BODIES = ["article", "main", "div class=content", "div class=article", "div id=content", "div class=post", "section class=article-body", "div class=entry-content", "main role=main", "div class=story", "article class=post", "div id=main", "div class=main-content", "div role=main", "section"]
PHRASES = {
    "menu": ["Home", "About", "Contact", "News", "Archive", "Next", "Sign in"], "head": ["Welcome", "The daily site", "Search"], "foot": ["© 2024 All rights reserved", "Privacy policy", "Terms", "·"],
    "side": ["Related", "Most read", "Share this", "Follow us"], "ad": ["Advertisement", "Buy now", "Sponsored"], "notice": ["We use cookies", "Accept all", "This site uses cookies"],
    "form": ["Subscribe", "Your e-mail", "Log in", "Search", "Send"], "comments": ["Comments", "Reply", "says:", "Leave a comment"],
}
SYLLABLES = "th er on an re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de rt ve ch un qu pa mo lo ga zu kei ung ción é ü ä ñ".split()


def _words(rng: random.Random, least: int, most: int) -> str:
    """Words; now and then a text is littered with signs, all capitals or a table of bars."""
    n = rng.randint(least, most)
    words = ["".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 5))) for _ in range(n)]
    style = rng.random()
    if style < 0.1:
        words = [w + rng.choice(["***", "%%%", "&amp;&amp;&amp;", "$$$", "###"]) for w in words]
    elif style < 0.15:
        words = [w.upper() + "!!" for w in words]
    elif style < 0.2:
        words = [x for w in words for x in (w, "|")]
    words[0] = words[0].capitalize()
    return " ".join(words) + rng.choice([".", ".", "", "!", "?"])


def _element(spec: str, inside: str) -> str:
    tag, *attrs = spec.split(" ")
    quoted = "".join(f' {a.split("=")[0]}="{a.split("=")[1]}"' for a in attrs)
    return f"<{tag}{quoted}>{inside}</{tag}>"


def _region(rng: random.Random, kind: str) -> str:
    spec = rng.choice(REGIONS[kind])
    said = lambda: rng.choice(PHRASES[kind]) if rng.random() < 0.35 else _words(rng, 1, 14)
    if kind == "menu" or kind in ("side", "foot") and rng.random() < 0.4:
        inside = "".join(f'<li><a href="/{i}">{_words(rng, 1, 3)}</a></li>' for i in range(rng.randint(2, 8)))
        inside = inside if spec.startswith("ul") else f"<ul>{inside}</ul>"
    elif kind == "form":
        inside = f"<label>{said()}</label><input name=q><button>{said()}</button>" + rng.choice(["", f"<p>{said()}</p>"])
    elif kind == "comments":
        one = lambda: rng.choice([f"<div class=\"comment\"><p>{_words(rng, 3, 60)}</p></div>", f"<li><b>{_words(rng, 1, 2)}</b> says: <p>{_words(rng, 3, 60)}</p></li>", f"<p>{_words(rng, 3, 60)}</p>"])
        inside = rng.choice(["", "<h2>Comments</h2>"]) + "".join(one() for _ in range(rng.randint(1, 5)))
    else:
        inside = rng.choice([said(), f"<p>{said()}</p>", f"<div>{said()}</div><p>{said()}</p>", f"<h3>{said()}</h3><p>{_words(rng, 5, 40)}</p>", _words(rng, 4, 30)])
    return _element(spec, inside)


def _mark(text: str) -> str:
    return MARK + text


def _paragraph(rng: random.Random) -> str:
    kind = rng.random()
    text = _mark(_words(rng, 1, rng.choice([4, 20, 120])))
    if kind < 0.6:
        return f"<p>{text}</p>"
    if kind < 0.7:
        return f"<p><b>{text}<br>"
    if kind < 0.76:
        return f"<h2>{text}</h2>"
    if kind < 0.82:
        return "<ul>" + "".join(f"<li>{_mark(_words(rng, 1, 12))}</li>" for _ in range(rng.randint(1, 5))) + "</ul>"
    if kind < 0.86:
        return f"<blockquote><p>{text}</p></blockquote>"
    if kind < 0.9:
        return f"<pre>{text}</pre>"
    if kind < 0.94:
        return "<table><tr>" + "".join(f"<td>{_mark(_words(rng, 1, 4))}</td>" for _ in range(3)) + "</tr></table>"
    if kind < 0.97:
        return f"<div>{text}</div>"
    return f"<figure><img src=x><figcaption>{text}</figcaption></figure>"


def generated_page(rng: random.Random) -> str:
    """A page whose blocks of main text start with a private-use character."""
    some = lambda kinds, chance: [_region(rng, k) for k in kinds if rng.random() < chance]
    title = _words(rng, 2, 12)
    inner = [f"<h1>{_mark(title)}</h1>"] if rng.random() < 0.8 else []
    for _ in range(rng.choice([0, 1, 2, 4, 8, 16, 30])):
        inner.append(_paragraph(rng))
        if rng.random() < 0.06:
            inner.append(_region(rng, rng.choice(["ad", "side", "notice", "form"])))
    if rng.random() < 0.12:
        inner.append(_region(rng, "comments"))
    body = _element(rng.choice(BODIES if rng.random() < 0.6 else BODIES[:1]), "".join(inner))
    for _ in range(rng.choice([0, 0, 0, 1, 2])):
        body = rng.choice(["<div>{}</div>", "<div class=\"container\">{}</div>", "<div id=\"page\">{}</div>", "<section>{}</section>"]).format(body)
    before, after = some(["notice", "head", "menu", "ad", "form"], 0.5), some(["comments", "side", "form", "ad", "menu", "foot", "notice"], 0.45)
    if rng.random() < 0.3:
        rng.shuffle(before)
        rng.shuffle(after)
    head = f'<head><meta charset="utf-8"><title>{title}</title><style>p{{}}</style></head>' if rng.random() < 0.9 else ""
    return f"<!DOCTYPE html><html>{head}<body>{''.join(before)}{body}{''.join(after)}</body></html>"


class Features:
    """Input vectors of blocks; what is looked up often is remembered up to a bound."""

    def __init__(self) -> None:
        self.paths: dict[tuple[str, ...], np.ndarray] = {}
        self.buckets: dict[str, int] = {}

    def path(self, path: tuple[str, ...]) -> np.ndarray:
        known = self.paths.get(path)
        if known is None:
            if len(self.paths) >= CACHED // 10:
                self.paths.clear()
            known = np.zeros(PATH, np.float32)
            for depth, label in enumerate(reversed(path)):
                tag, *names = label.split(" ")
                for part in (tag, *(f".{n}" for n in names)):
                    code = zlib.crc32(part.encode())
                    known[code % PATH] += (1.0 if code & 0x10000 else -1.0) * (1.0 if depth < 2 else 0.7)
            self.paths[path] = known
        return known

    def bucket(self, word: str) -> int:
        known = self.buckets.get(word)
        if known is None:
            if len(self.buckets) >= CACHED:
                self.buckets.clear()
            known = self.buckets[word] = zlib.crc32(word.lower().encode()) % WORD
        return known

    def page(self, found: list[Block]) -> np.ndarray:
        x = np.zeros((len(found), INPUTS), np.float32)
        for i, block in enumerate(found):
            words = block.text.split(" ")
            x[i, :PATH] = self.path(block.path)
            x[i, PATH : PATH + WORD] = np.bincount([self.bucket(w) for w in words], minlength=WORD) / len(words)
            x[i, PATH + WORD :] = (np.log1p(len(words)) / 3, np.log1p(len(block.text)) / 5, min(1.0, block.linked / len(block.text)), len(block.path) / 8, i / len(found), 1.0)
        return x


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _pad(pages: list[np.ndarray], backward: bool) -> np.ndarray:
    out = np.zeros((max(map(len, pages)), len(pages), pages[0].shape[1]), np.float32)
    for i, x in enumerate(pages):
        out[: len(x), i] = x[::-1] if backward else x
    return out


def _forward(x: np.ndarray, u: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
    """States of one direction from the inputs to its gates, (steps, pages, 4 hidden)."""
    h = c = np.zeros((x.shape[1], HIDDEN), np.float32)
    states, kept = np.empty((len(x), x.shape[1], HIDDEN), np.float32), []
    for t in range(len(x)):
        z = x[t] + h @ u
        gate, new = _sigmoid(z[:, : 3 * HIDDEN]), np.tanh(z[:, 3 * HIDDEN :])
        i, f, o = np.split(gate, 3, axis=1)
        before, c = c, f * c + i * new
        squashed = np.tanh(c)
        if keep:
            kept.append((h, before, i, f, o, new, squashed))
        h = o * squashed
        states[t] = h
    return states, kept


def _backward(grad: np.ndarray, u: np.ndarray, kept: list) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the inputs to the gates and of the recurrent weights."""
    dz = np.empty((*grad.shape[:2], 4 * HIDDEN), np.float32)
    du, dh, dc = np.zeros_like(u), np.zeros(grad.shape[1:], np.float32), np.zeros(grad.shape[1:], np.float32)
    for t in range(len(grad) - 1, -1, -1):
        h, before, i, f, o, new, squashed = kept[t]
        dh = dh + grad[t]
        dc = dc + dh * o * (1 - squashed**2)
        dz[t] = np.concatenate([dc * new * i * (1 - i), dc * before * f * (1 - f), dh * squashed * o * (1 - o), dc * i * (1 - new**2)], axis=1)
        du += h.T @ dz[t]
        dh, dc = dz[t] @ u.T, dc * f
    return dz, du


class Labeller:
    """Weights of the network: input, recurrent and output, for both directions."""

    def __init__(self, seed: int = 0):
        rng = np.random.default_rng(seed)
        self.w = [rng.normal(0, 0.25, (INPUTS, 4 * HIDDEN)).astype(np.float32) for _ in "fb"]
        self.u = [rng.normal(0, 0.2, (HIDDEN, 4 * HIDDEN)).astype(np.float32) for _ in "fb"]
        self.out = rng.normal(0, 0.2, (2 * HIDDEN + INPUTS, 1)).astype(np.float32)

    def _weights(self) -> list[np.ndarray]:
        return [*self.w, *self.u, self.out]

    def gradients(self, pages: list[np.ndarray], labels: list[np.ndarray]) -> tuple[float, list[np.ndarray]]:
        """Mean logistic loss over all blocks, and its gradients in the order of the weights."""
        xs = [_pad(pages, b) for b in (False, True)]
        runs = [_forward(x @ w, u, True) for x, w, u in zip(xs, self.w, self.u, strict=True)]
        total, loss = sum(map(len, pages)), 0.0
        dout, dstates = np.zeros_like(self.out), [np.zeros_like(s) for s, _ in runs]
        for i, (x, y) in enumerate(zip(pages, labels, strict=True)):
            n = len(x)
            joined = np.concatenate([runs[0][0][:n, i], runs[1][0][:n, i][::-1], x], axis=1)
            p = _sigmoid(joined @ self.out)[:, 0]
            loss -= float(np.log(np.where(y == 1, p, 1 - p) + 1e-9).sum())
            d = ((p - y) / total).astype(np.float32)[:, None]
            dout += joined.T @ d
            back = d @ self.out.T
            dstates[0][:n, i], dstates[1][:n, i] = back[:, :HIDDEN], back[::-1, HIDDEN : 2 * HIDDEN]
        grads = [_backward(d, u, kept) for d, u, (_, kept) in zip(dstates, self.u, runs, strict=True)]
        return loss / total, [*(np.tensordot(x, dz, ((0, 1), (0, 1))) for x, (dz, _) in zip(xs, grads, strict=True)), *(du for _, du in grads), dout]

    def fit(self, pages: list[np.ndarray], labels: list[np.ndarray], epochs: int = EPOCHS) -> Labeller:
        weights = self._weights()
        first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
        order = sorted(range(len(pages)), key=lambda i: len(pages[i]))
        batches = [order[i : i + BATCH] for i in range(0, len(order), BATCH)]
        rng, step = random.Random(0), 0
        for epoch in range(epochs):
            rng.shuffle(batches)
            for batch in batches:
                step += 1
                rate = RATE * (1.0 if epoch < epochs - 2 else 0.3)
                for w, g, m, v in zip(weights, self.gradients([pages[i] for i in batch], [labels[i] for i in batch])[1], first, second, strict=True):
                    m += 0.1 * (g - m)
                    v += 0.01 * (g * g - v)
                    w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
        return self

    def predict(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """For each page which of its blocks are main text. Pages of like length are read together."""
        out: list[np.ndarray] = [np.empty(0, bool)] * len(pages)
        order, at = sorted((i for i in range(len(pages)) if len(pages[i])), key=lambda i: -len(pages[i])), 0
        while at < len(order):
            part = order[at : at + max(1, PADDED_CELLS // len(pages[order[at]]))]
            at += len(part)
            some = [pages[i] for i in part]
            ahead, back = (_forward(_pad(some, b) @ w, u, False)[0] for b, w, u in zip((False, True), self.w, self.u, strict=True))
            for j, (i, x) in enumerate(zip(part, some, strict=True)):
                out[i] = (np.concatenate([ahead[: len(x), j], back[: len(x), j][::-1], x], axis=1) @ self.out)[:, 0] >= 0
        return out


def training_set(pages: int, seed: int) -> tuple[list[list[Block]], list[np.ndarray]]:
    rng = random.Random(seed)
    found, labels = [], []
    for _ in range(pages):
        bs = blocks(generated_page(rng))
        if bs:
            labels.append(np.array([MARK in b.text for b in bs], np.float32))
            found.append([Block(b.text.replace(MARK, ""), b.path, b.linked) for b in bs])
    return found, labels


@functools.lru_cache(maxsize=1)
def trained() -> Labeller:
    """The network, trained once a process."""
    features = Features()
    found, labels = training_set(PAGES, 7)
    return Labeller().fit([features.page(b) for b in found], labels)
