"""Personal data in texts: fixed forms, and a character model for other writings of them.

Fixed forms (``base_spans``) are e-mail and internet addresses, payment card and
telephone numbers, each kind leftmost and without overlap.  The model is a
bidirectional LSTM over characters whose outputs feed a linear-chain CRF over
begin / inside tags of each kind; both are trained here in numpy, by the
gradient of the exact log-likelihood, from labelled spans: pieces of the
corpus with the spans of the fixed forms, and the same pieces with spans
rewritten the way people obscure them (``name [at] host [dot] org``, spaced or
bracketed addresses, numbers without their plus or with other separators), so
it finds what the fixed forms miss.  Spans of fixed forms always stay.

What the model reads.  A span holds a digit, an at-sign or a bracketed "at";
around each of them, ``REACH`` characters to either side form a stretch, and
overlapping stretches are one.  A text without any of them has no stretch.
Windows of ``WIDTH`` characters, each half over the next, cover every stretch;
each is decoded to tag probabilities by the CRF's forward and backward sums;
probabilities of overlapping windows are blended with weights that rise from
a window's edge to its middle, and one best tag path is found over the whole
stretch.  Its spans are trimmed, checked (digits and Luhn's sum of a card, parts
of an address, digits of a telephone number, a name and a host of an e-mail
address), and dropped where they touch a span of a fixed form.

Scale: one pass that moves no rows; the model (some 20,000 numbers) goes with
the task.  A task holds one slice of 2 MB of text or one longer text; windows
are decoded ``BATCH`` at a time, stretches over ``LONG`` characters in pieces that
overlap by ``LAP`` (a span belongs to the piece it begins in).  The model is
fitted on at most ``max_pieces`` pieces, a fifth of them of each kind and a
fifth without spans, those of least hash: a bound that doesn't grow.

Defined results: null and empty texts have no spans; repeated rows and rows with
null ids are scanned alike; with no labelled piece the model adds nothing; an
empty table gives no rows; extra columns, whatever their names, are not read.
Starts and ends count code points, ends are exclusive.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm.text import slices

KINDS = ("email", "ip", "card", "phone")
TAGS = 1 + 2 * len(KINDS)  # outside, then begin and inside of each kind
REACH, WIDTH, BATCH = 40, 96, 256
LONG, LAP = 1 << 16, 512
SPANS = "array<struct<kind: string, start: int, end: int>>"

# --- fixed forms ---

_NAME = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_HOST = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    """Whether a number's last digit is its check digit."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) << (i & 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _part(digits: str) -> bool:
    digits = digits.lstrip("0")
    return len(digits) <= 3 and int(digits or "0") <= 255


def _digits(text: str) -> str:
    return re.sub(r"[^0-9]", "", text)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the fixed forms, by kind, then start; linear in the text."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        # One at-sign an address; the name begins as far left as it can.
        start = at
        while start > last and text[start - 1] in _NAME:
            start -= 1
        host = _HOST.match(text, at + 1) if start < at else None
        if host:
            last = host.end()
            out.append((0, start, last))
        at = text.find("@", at + 1)
    out += [(1, *m.span()) for m in _IP.finditer(text) if all(map(_part, m.group().split(".")))]
    for m in _CARD.finditer(text):
        number = _digits(m.group())
        if 13 <= len(number) <= 19 and luhn(number):
            out.append((2, *m.span()))
    out += [(3, *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m.group())) <= 15]
    return out


# --- stretches and windows ---

ANCHOR = r"[0-9@＠]|[\[({]\s*at\s*[\])}]"
_ANCHOR = re.compile(ANCHOR, re.IGNORECASE)


def stretches(text: str) -> list[tuple[int, int]]:
    """Parts of a text that the model reads, in pieces of at most ``LONG`` characters."""
    out: list[list[int]] = []
    for m in _ANCHOR.finditer(text):
        lo, hi = max(0, m.start() - REACH), min(len(text), m.end() + REACH)
        if out and lo <= out[-1][1]:
            out[-1][1] = hi
        else:
            out.append([lo, hi])
    return [(a, min(a + LONG, hi)) for lo, hi in out for a in range(lo, max(lo + 1, hi - LAP), LONG - LAP)]


def _symbols() -> np.ndarray:
    """Symbol of each ASCII character: letters and marks stand for themselves, all
    digits for one, all capitals for one; 0 is no character, the last two are
    other letters and other characters."""
    table = np.zeros(128, dtype=np.int64)
    alone = [c for c in range(128) if not chr(c).isdigit() and not chr(c).isupper() and (c >= 32 or c in (9, 10))]
    table[:] = len(alone) + 3
    for i, c in enumerate(alone):
        table[c] = i + 3
    table[[c for c in range(128) if chr(c).isdigit()]] = 1
    table[[c for c in range(128) if chr(c).isupper()]] = 2
    return table


_TABLE = _symbols()
SYMBOLS = int(_TABLE.max()) + 3


def symbols(text: str) -> np.ndarray:
    """Symbols of a piece of text."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
    out = _TABLE[np.minimum(code, 127)]
    wide = code > 127
    if wide.any():
        letter = np.fromiter((chr(c).isalpha() for c in code[wide].tolist()), dtype=bool)
        out[wide] = np.where(letter, SYMBOLS - 2, SYMBOLS - 1)
        out[code == 0xFF20] = _TABLE[ord("@")]  # the full-width at-sign
    return out


def windows(length: int) -> np.ndarray:
    """Starts of the windows over a stretch, each half over the next."""
    half = WIDTH // 2
    return np.arange(-(-max(1, length - half) // half)) * half


# --- the model ---

@dataclass
class Model:
    embed: np.ndarray   # (SYMBOLS, E)
    wx: list[np.ndarray]  # per direction (E, 4H)
    wh: list[np.ndarray]  # per direction (H, 4H)
    b: list[np.ndarray]   # per direction (4H,)
    out: np.ndarray     # (2H, TAGS)
    bias: np.ndarray    # (TAGS,)
    trans: np.ndarray   # (TAGS, TAGS)
    first: np.ndarray   # (TAGS,)

    def parts(self) -> list[np.ndarray]:
        return [self.embed, *self.wx, *self.wh, *self.b, self.out, self.bias, self.trans, self.first]


def new_model(seed: int = 0, embed: int = 16, hidden: int = 24, dtype=np.float32) -> Model:
    rng = np.random.default_rng(seed)

    def draw(*shape):
        return (rng.normal(size=shape) / np.sqrt(shape[0])).astype(dtype)

    b = np.zeros(4 * hidden, dtype=dtype)
    b[hidden:2 * hidden] = 1  # keep what is remembered, at first
    return Model(rng.normal(size=(SYMBOLS, embed)).astype(dtype) * dtype(0.5), [draw(embed, 4 * hidden) for _ in range(2)],
                 [draw(hidden, 4 * hidden) for _ in range(2)], [b.copy(), b.copy()], draw(2 * hidden, TAGS),
                 np.zeros(TAGS, dtype=dtype), np.zeros((TAGS, TAGS), dtype=dtype), np.zeros(TAGS, dtype=dtype))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _lstm(x: np.ndarray, wx, wh, b):
    """States over time of one direction; x is (T, B, E)."""
    steps, size, hidden = x.shape[0], x.shape[1], wh.shape[0]
    z = x @ wx + b
    h = np.zeros((steps + 1, size, hidden), dtype=x.dtype)
    c = np.zeros_like(h)
    gates = np.empty((steps, size, 4 * hidden), dtype=x.dtype)
    for t in range(steps):
        a = z[t] + h[t] @ wh
        g = gates[t]
        g[:, :3 * hidden] = _sigmoid(a[:, :3 * hidden])
        g[:, 3 * hidden:] = np.tanh(a[:, 3 * hidden:])
        i, f, o, n = (g[:, k * hidden:(k + 1) * hidden] for k in range(4))
        c[t + 1] = f * c[t] + i * n
        h[t + 1] = o * np.tanh(c[t + 1])
    return h, c, gates


def _lstm_back(x, wx, wh, h, c, gates, dh_out):
    """Gradients (x, wx, wh, b) from those of the states."""
    steps, size, hidden = dh_out.shape
    da = np.empty_like(gates)
    dh, dc = np.zeros((size, hidden), dtype=x.dtype), np.zeros((size, hidden), dtype=x.dtype)
    for t in range(steps - 1, -1, -1):
        i, f, o, n = (gates[t][:, k * hidden:(k + 1) * hidden] for k in range(4))
        dh = dh + dh_out[t]
        tc = np.tanh(c[t + 1])
        dc = dc + dh * o * (1 - tc * tc)
        d = da[t]
        d[:, :hidden] = dc * n * i * (1 - i)
        d[:, hidden:2 * hidden] = dc * c[t] * f * (1 - f)
        d[:, 2 * hidden:3 * hidden] = dh * tc * o * (1 - o)
        d[:, 3 * hidden:] = dc * i * (1 - n * n)
        dh, dc = d @ wh.T, dc * f
    flat = da.reshape(-1, da.shape[2])
    return da @ wx.T, x.reshape(-1, x.shape[2]).T @ flat, h[:-1].reshape(-1, hidden).T @ flat, flat.sum(0)


# A tag inside a span follows its begin or inside tag only.
FORBIDDEN = np.array([[b > 0 and b % 2 == 0 and a not in (b, b - 1) for b in range(TAGS)] for a in range(TAGS)])
FORBIDDEN_FIRST = np.array([b > 0 and b % 2 == 0 for b in range(TAGS)])
_NEVER = 1e4


def _rules(m: Model) -> tuple[np.ndarray, np.ndarray]:
    return m.trans - _NEVER * FORBIDDEN.astype(m.trans.dtype), m.first - _NEVER * FORBIDDEN_FIRST.astype(m.first.dtype)


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + np.squeeze(top, axis)


def _sums(emit: np.ndarray, trans: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward and backward log sums (T, B, TAGS) and the log total (B,)."""
    steps = len(emit)
    fwd, bwd = np.empty_like(emit), np.zeros_like(emit)
    fwd[0] = first + emit[0]
    for t in range(1, steps):
        fwd[t] = emit[t] + _logsum(fwd[t - 1][:, :, None] + trans, 1)
    for t in range(steps - 2, -1, -1):
        bwd[t] = _logsum(trans + (emit[t + 1] + bwd[t + 1])[:, None, :], 2)
    return fwd, bwd, _logsum(fwd[-1], 1)


def _emissions(m: Model, sym: np.ndarray):
    """Tag scores (T, B, TAGS) of windows (B, T), and what the gradient needs."""
    x = m.embed[sym.T]
    runs = [_lstm(x, m.wx[0], m.wh[0], m.b[0]), _lstm(x[::-1], m.wx[1], m.wh[1], m.b[1])]
    states = np.concatenate([runs[0][0][1:], runs[1][0][1:][::-1]], axis=2)
    return states @ m.out + m.bias, x, runs, states


def loss_and_gradients(m: Model, sym: np.ndarray, tags: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Negative log-likelihood of the tags of some windows, per window, and its
    gradients in the order of ``Model.parts``."""
    emit, x, runs, states = _emissions(m, sym)
    trans, first = _rules(m)
    fwd, bwd, total = _sums(emit, trans, first)
    steps, size, _ = emit.shape
    gold = tags.T
    rows = np.arange(size)
    score = first[gold[0]] + emit[0][rows, gold[0]]
    for t in range(1, steps):
        score = score + trans[gold[t - 1], gold[t]] + emit[t][rows, gold[t]]
    d = np.exp(fwd + bwd - total[:, None])
    d_trans = np.zeros_like(m.trans)
    for t in range(1, steps):
        pair = fwd[t - 1][:, :, None] + trans + (emit[t] + bwd[t])[:, None, :] - total[:, None, None]
        d_trans += np.exp(pair).sum(0)
    np.add.at(d_trans, (gold[:-1].ravel(), gold[1:].ravel()), -1)
    d_first = d[0].sum(0)
    np.add.at(d_first, gold[0], -1)
    np.put_along_axis(d, gold[:, :, None], np.take_along_axis(d, gold[:, :, None], 2) - 1, 2)
    d /= size
    hidden = m.wh[0].shape[0]
    ds = d @ m.out.T
    fw = _lstm_back(x, m.wx[0], m.wh[0], *runs[0], ds[:, :, :hidden])
    bw = _lstm_back(x[::-1], m.wx[1], m.wh[1], *runs[1], ds[::-1, :, hidden:])
    dx = fw[0] + bw[0][::-1]
    d_embed = np.zeros_like(m.embed)
    np.add.at(d_embed, sym.T, dx)
    grads = [d_embed, fw[1], bw[1], fw[2], bw[2], fw[3], bw[3],
             states.reshape(-1, states.shape[2]).T @ d.reshape(-1, TAGS), d.sum((0, 1)), d_trans / size, d_first / size]
    return float((total - score).mean()), grads


def train(sym: np.ndarray, tags: np.ndarray, epochs: int = 6, batch: int = 64, rate: float = 0.02, seed: int = 0) -> Model:
    """A model fitted to windows (N, WIDTH) and their tags by Adam."""
    m, rng = new_model(seed), np.random.default_rng(seed)
    parts = m.parts()
    mean, square = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
    step, steps = 0, epochs * -(-len(sym) // batch)
    for _ in range(epochs):
        order = rng.permutation(len(sym))
        for lo in range(0, len(order), batch):
            rows = order[lo:lo + batch]
            _, grads = loss_and_gradients(m, sym[rows], tags[rows])
            norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
            now = rate * (1 - step / steps)
            step += 1
            for p, g, a, q in zip(parts, grads, mean, square):
                g = g * min(1.0, 5.0 / max(norm, 1e-9))
                a += 0.1 * (g - a)
                q += 0.01 * (g * g - q)
                p -= (now * (a / (1 - 0.9 ** step)) / (np.sqrt(q / (1 - 0.99 ** step)) + 1e-8)).astype(p.dtype)
    return m


# --- decoding ---

def tag_probabilities(emit: np.ndarray, trans: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Tag probabilities (T, B, TAGS): the forward and backward sums as products
    of probabilities, scaled at every step."""
    each = np.exp(emit - emit.max(2, keepdims=True))
    step = np.exp(trans)
    out = np.empty_like(each)
    now = np.exp(first) * each[0]
    for t in range(len(each)):
        if t:
            now = (now @ step) * each[t]
        now /= now.sum(1, keepdims=True)
        out[t] = now
    now = np.ones_like(each[0])
    for t in range(len(each) - 2, -1, -1):
        now = (now * each[t + 1]) @ step.T
        now /= now.sum(1, keepdims=True)
        out[t] *= now
    return out / out.sum(2, keepdims=True)


def _blend(m: Model, parts: list[np.ndarray]) -> list[np.ndarray]:
    """Tag probabilities (length, TAGS) of each stretch, blended over its windows."""
    trans, first = _rules(m)
    weight = np.minimum(np.arange(WIDTH) + 1, WIDTH - np.arange(WIDTH)).astype(np.float32)
    out = [np.zeros((len(p), TAGS), dtype=np.float32) for p in parts]
    places = [(k, s) for k, p in enumerate(parts) for s in windows(len(p)).tolist()]
    for lo in range(0, len(places), BATCH):
        now = places[lo:lo + BATCH]
        sym = np.zeros((len(now), WIDTH), dtype=np.int64)
        for row, (k, s) in zip(sym, now):
            row[:len(parts[k]) - s] = parts[k][s:s + WIDTH]
        p = tag_probabilities(_emissions(m, sym)[0], trans, first)
        for i, (k, s) in enumerate(now):
            n = min(WIDTH, len(parts[k]) - s)
            out[k][s:s + n] += weight[:n, None] * p[:n, i]
    return [p / p.sum(1, keepdims=True) for p in out]


def best_path(p: np.ndarray) -> np.ndarray:
    """The allowed tag path of greatest product of probabilities."""
    score = np.log(np.maximum(p, 1e-12))
    rules = np.where(FORBIDDEN, -_NEVER, 0.0)
    back = np.zeros((len(p), TAGS), dtype=np.int8)
    now = score[0] - _NEVER * FORBIDDEN_FIRST
    for t in range(1, len(p)):
        through = now[:, None] + rules
        back[t] = through.argmax(0)
        now = through.max(0) + score[t]
    tags = np.empty(len(p), dtype=np.int64)
    tags[-1] = now.argmax()
    for t in range(len(p) - 1, 0, -1):
        tags[t - 1] = back[t, tags[t]]
    return tags


def _spans_of(tags: np.ndarray) -> list[tuple[int, int, int]]:
    """(kind, start, end) of a tag path."""
    begin = np.flatnonzero(tags % 2 == 1)
    out = []
    for s in begin.tolist():
        e = s + 1
        while e < len(tags) and tags[e] == tags[s] + 1:
            e += 1
        out.append((int(tags[s]) // 2, s, e))
    return out


_AT = re.compile(r"\s*(?:[@＠]|[\[({]\s*at\s*[\])}])\s*", re.IGNORECASE)


def plausible(kind: int, text: str) -> bool:
    """Whether a span's text can be of its kind at all."""
    digits = _digits(text)
    if kind == 0:
        name, *host = _AT.split(text)
        return bool(name and len(host) == 1 and re.search(r"\w\W+\w", host[0]) and len(text) <= 254)
    if kind == 1:
        parts = re.findall(r"[0-9]+", text)
        return len(parts) == 4 and all(map(_part, parts))
    if kind == 2:
        return 13 <= len(digits) <= 19 and luhn(digits)
    return 9 <= len(digits) <= 15


def added_spans(m: Model, texts: list[str], bases: list[list[tuple[int, int, int]]]) -> list[list[tuple[int, int, int]]]:
    """The model's spans of each text that touch none of its fixed ones."""
    places = [(k, lo, hi) for k, t in enumerate(texts) for lo, hi in stretches(t)]
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    held: list[tuple[int, int, int]] = []

    def decode():
        found = _blend(m, [symbols(texts[k][lo:hi]) for k, lo, hi in held])
        for (k, lo, hi), p in zip(held, found):
            if (p.argmax(1) == 0).all():
                continue
            for kind, s, e in _spans_of(best_path(p)):
                text = texts[k]
                cut = hi - lo >= LONG and s >= LONG - LAP  # the next piece has it whole
                s, e = s + lo, e + lo
                while s < e and text[s].isspace():
                    s += 1
                while s < e and text[e - 1].isspace():
                    e -= 1
                if not cut and s < e and plausible(kind, text[s:e]) and all(e <= a or b <= s for _, a, b in bases[k]):
                    out[k].append((kind, s, e))
        held.clear()

    size = 0
    for place in places:
        held.append(place)
        size += place[2] - place[1]
        if size >= BATCH * WIDTH:
            decode()
            size = 0
    if held:
        decode()
    return [_disjoint(spans) for spans in out]


def _disjoint(spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans without those that begin inside an earlier one: a piece of a long
    stretch may begin in the middle of a span."""
    out: list[tuple[int, int, int]] = []
    for span in sorted(spans, key=lambda s: (s[1], -s[2])):
        if not out or span[1] >= out[-1][2]:
            out.append(span)
    return out


# --- labelled pieces ---

def _rewritten(kind: int, text: str, rng: np.random.Generator) -> str:
    """Another writing of a span."""
    pick = lambda *of: of[int(rng.integers(len(of)))]
    if kind == 0:
        name, host = text.split("@")
        at = pick(" @ ", "[at]", " [at] ", "(at)", " (at) ", "＠", "@ ", " {at} ")
        dot = pick(".", " . ", "[dot]", " [dot] ", "(dot)", " (dot) ", " dot ")
        return name + at + host.replace(".", dot)
    number = _digits(text)
    if kind == 1:
        return pick("[.]", " . ", "(.)", "[dot]", "-", ", ", " dot ", ":").join(text.split("."))
    if kind == 2:
        return pick(".", "/", "  ", "_", " - ", ". ").join(number[i:i + 4] for i in range(0, len(number), 4))
    country, rest = number[:-10] or "1", number[-10:]
    a, b, c = rest[:3], rest[3:6], rest[6:]
    return pick(f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"00{country} {a} {b} {c}", f"{country}-{a}-{b}-{c}",
                f"({a}){b}-{c}", f"{a} {b} {c}", f"+{country}/{a}/{b}{c}", f"({a}) {b} {c}", f"+ {country} ({a}) {b}-{c}")


def _decoy(rng: np.random.Generator) -> str:
    """A number that is no personal data."""
    n = lambda lo, hi: int(rng.integers(lo, hi))
    return [lambda: f"{n(1900, 2100)}-{n(1, 13):02d}-{n(1, 29):02d}", lambda: f"{n(0, 24)}:{n(0, 60):02d}:{n(0, 60):02d}",
            lambda: f"{n(1, 99)},{n(0, 999):03d}.{n(0, 99):02d}", lambda: f"v{n(0, 20)}.{n(0, 30)}.{n(0, 30)}",
            lambda: f"#{n(1, 10**7)}", lambda: str(n(1, 10**9)), lambda: f"{n(1, 300)} x {n(1, 300)}",
            lambda: f"{n(0, 2**31):x}{n(0, 2**31):x}", lambda: f"@{'abcdefgh'[:n(3, 8)]}", lambda: f"{n(10, 99)} % of {n(100, 9999)}"][n(0, 10)]()


def examples(pieces: list[str], seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Windows and tags of labelled pieces: as they are, with their spans
    rewritten (twice), and with decoys in their place."""
    rng = np.random.default_rng(seed)
    sym, tags = [], []

    def add(text: str, spans):
        s, t = symbols(text), np.zeros(len(text), dtype=np.int64)
        for kind, a, b in spans:
            t[a], t[a + 1:b] = 2 * kind + 1, 2 * kind + 2
        for at in windows(len(text)).tolist():
            row, tag = np.zeros(WIDTH, dtype=np.int64), np.zeros(WIDTH, dtype=np.int64)
            n = min(WIDTH, len(text) - at)
            row[:n], tag[:n] = s[at:at + n], t[at:at + n]
            inside = tag[0] > 0 and tag[0] % 2 == 0
            if inside:  # a span that the window's edge cuts begins at the edge
                tag[0] -= 1
            sym.append(row)
            tags.append(tag)

    for piece in pieces:
        spans = []
        for span in sorted(base_spans(piece), key=lambda f: (f[1], -f[2])):
            if not spans or span[1] >= spans[-1][2]:
                spans.append(span)
        add(piece, spans)
        for write in (_rewritten, _rewritten, None) if spans else ():
            text, new, last = "", [], 0
            for kind, a, b in spans:
                text += piece[last:a]
                fresh = write(kind, piece[a:b], rng) if write else _decoy(rng)
                if write:
                    new.append((kind, len(text), len(text) + len(fresh)))
                text, last = text + fresh, b
            add(text + piece[last:], new)
    if not sym:
        return np.zeros((0, WIDTH), np.int64), np.zeros((0, WIDTH), np.int64)
    return np.array(sym), np.array(tags)


def pieces(df: DataFrame, text_col: str, max_pieces: int = 1000) -> list[str]:
    """Labelled pieces: ``REACH`` characters around fixed forms and around other
    anchors, at most a fifth of ``max_pieces`` of each kind and without spans."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                kind, piece = [], []
                for text in _anchored(batch.column(0)):
                    spans = base_spans(text)
                    for k, a, b in spans:
                        kind.append(k)
                        piece.append(text[max(0, a - REACH):b + REACH])
                    taken = 0
                    for m in _ANCHOR.finditer(text):
                        a, b = max(0, m.start() - REACH), m.end() + REACH
                        if a >= taken and all(y <= a or b <= x for _, x, y in spans):
                            kind.append(len(KINDS))
                            piece.append(text[a:b])
                            taken = b
                yield pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(piece, pa.string())], names=["kind", "piece"])

    found = df.select(F.col(text_col).cast("string").alias("text")).mapInArrow(cut, "kind int, piece string").distinct()
    found = found.withColumn("h", F.xxhash64("piece")).withColumn("part", F.pmod(F.xxhash64("piece", F.lit(1)), F.lit(64)))
    each = max(1, max_pieces // (len(KINDS) + 1))
    # First within 64 parts of each kind, so no task sorts all pieces of one.
    for by in (["kind", "part"], ["kind"]):
        rank = F.row_number().over(Window.partitionBy(*by).orderBy("h", "piece"))
        found = found.withColumn("rank", rank).where(F.col("rank") <= each).drop("rank")
    return [r["piece"] for r in found.select("kind", "h", "piece").orderBy("kind", "h", "piece").collect()]


def _anchored(column: pa.Array) -> list[str]:
    """Texts of a column that hold an anchor."""
    column = pc.fill_null(column, "")
    return column.filter(pc.match_substring_regex(column, ANCHOR, ignore_case=True)).to_pylist()


def fit(df: DataFrame, text_col: str, max_pieces: int = 1000, epochs: int = 6) -> Model | None:
    """A model trained on labelled pieces of a table; None when there are none."""
    sym, tags = examples(pieces(df, text_col, max_pieces))
    return train(sym, tags, epochs) if tags.any() else None


def find_pii(df: DataFrame, model: Model | None, id_col: str, text_col: str) -> DataFrame:
    """(id, base, spans) of every row: the spans of the fixed forms, and these
    with the model's, each (kind, start, end) by kind as listed, then start."""
    kind = dict(df.select(id_col).dtypes)[id_col]

    def listed(spans: list[list[tuple[int, int, int]]]) -> pa.Array:
        flat = [s for of in spans for s in of]
        values = pa.StructArray.from_arrays(
            [pa.array([KINDS[k] for k, _, _ in flat], pa.string()), pa.array([a for _, a, _ in flat], pa.int32()),
             pa.array([b for _, _, b in flat], pa.int32())], ["kind", "start", "end"])
        return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum([len(s) for s in spans]))), pa.int32()), values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                column = pc.fill_null(batch.column(1), "")
                base: list[list[tuple[int, int, int]]] = [[] for _ in range(batch.num_rows)]
                more = list(base)
                rows = np.flatnonzero(np.asarray(pc.match_substring_regex(column, ANCHOR, ignore_case=True)))
                texts = column.take(pa.array(rows)).to_pylist()
                bases = [base_spans(t) for t in texts]
                added = added_spans(model, texts, bases) if model else [[] for _ in texts]
                for r, b, a in zip(rows.tolist(), bases, added):
                    base[r], more[r] = b, sorted(b + a)
                yield pa.RecordBatch.from_arrays([batch.column(0), listed(base), listed(more)], names=["id", "base", "spans"])

    return (df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, f"id {kind}, base {SPANS}, spans {SPANS}"))
