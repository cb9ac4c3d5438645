"""Personal data: fixed patterns, and a character BiLSTM-CRF that adds spans.

The patterns give the base spans. The tagger is a character-level
bidirectional LSTM with CRF transitions, trained here in numpy from labelled
spans: windows around base spans of a bounded sample of texts
(``TRAIN_WINDOWS``), and the same windows with the personal data rewritten in
forms that the patterns miss (``variants``). Every stretch of a text that may
hold a span (``stretches``: the run of fitting characters around a digit or @,
as long as it is, with ``STRIDE`` characters on either side) is covered by
windows of ``WINDOW`` characters that overlap by half. Each window is decoded
(Viterbi), the tags of a stretch are stitched from the middles of its windows,
and a span goes on over as many windows as its tags do. The ends of a span are
drawn out to the ends of its address or numbers, and the spans of a text are
reconciled at once: by score, an earlier start breaking ties, non-overlapping,
none that touches a base span, and only forms that hold the digits or the @
that their kind needs. That last rule makes text outside the stretches empty by
definition; nothing else is skipped. Time and memory are linear in the text.

Defined results: a null text is empty and has no spans; offsets are code
points, ends exclusive; repeated rows each get their row; without any base
span to learn from, the tagger adds nothing. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.llm.text import column, read_documents, slices

KINDS = ("email", "ip", "card", "phone")
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
TRIGGER = re.compile(r"[0-9@]")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")

#: Labelled windows that the tagger is trained on, and the texts read for them, at most.
TRAIN_WINDOWS, TRAIN_TEXTS = 1500, 4000
WINDOW, STRIDE = 64, 32
HIDDEN, EMBED, EPOCHS, BATCH, RATE = 16, 8, 30, 64, 0.02
SEED = 7
TAGS = 1 + 2 * len(KINDS)  # outside; begin and inside of each kind
#: Windows decoded at once.
DECODED = 2048
#: Mean log odds per character that a span needs over being outside.
MARGIN = 1.0


# ------------------------------------------------------------------ base spans
def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(s: str) -> str:
    return re.sub("[^0-9]", "", s)


def valid(kind: int, s: str) -> bool:
    if kind == 1:
        return all(len(p) <= 3 and int(p or "0") <= 255 for p in (x.lstrip("0") for x in s.split(".")))
    if kind == 2:
        return 16 <= len(_digits(s)) <= 19 and luhn(_digits(s))
    if kind == 3:
        return 8 <= len(_digits(s)) <= 15
    return True


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end), by kind and start."""
    out = []
    if "@" in text:
        out += [(0, m.start(), m.end()) for m in _emails(text)]
    if TRIGGER.search(text):
        out += [(1, i, j) for i, j in _ips(text) if valid(1, text[i:j])]
        for kind, rx in ((2, CARD), (3, PHONE)):
            if kind == 3 and "+" not in text:
                continue
            out += [(kind, m.start(), m.end()) for m in rx.finditer(text) if valid(kind, m[0])]
    return out


def _ips(text: str) -> Iterator[tuple[int, int]]:
    """The matches of ``IP``: of every run of numbers with single dots between
    them, four by four from its start. A run is read once, however long."""
    for m in _DOTTED.finditer(text):
        if m[0].count(".") < 3:
            continue
        at, parts = m.start(), m[0].split(".")
        for i in range(0, len(parts) - 3, 4):
            size = sum(map(len, parts[i:i + 4])) + 3
            yield at, at + size
            at += size + 1


_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+$")


def _emails(text: str) -> Iterator[re.Match]:
    """The same matches as ``EMAIL.finditer``, tried only before an @."""
    done, at = 0, text.find("@")
    while at >= 0:
        if at >= done:
            i = at
            while i > done and (text[i - 1].isascii() and (text[i - 1].isalnum() or text[i - 1] in "._%+-")):
                i -= 1
            m = EMAIL.match(text, i) if i < at else None
            if m:
                yield m
                done = m.end()
        at = text.find("@", at + 1)


# ---------------------------------------------------------------------- tagger
_CLASS = np.zeros(128, np.int64)
for _i in range(128):
    _c = chr(_i)
    _CLASS[_i] = (1 if _c.isdigit() else 2 if _c.islower() else 3 if _c.isupper() else 4 if _c == " " else 5 if _c == "@" else 6 if _c == "."
                  else 7 if _c == "-" else 8 if _c == "+" else 9 if _c in "()[]" else 10 if _c == "_" else 11 if _c in "\n\t" else 12 if _c in ":=\"'/," else 13)
CLASSES = 15  # 14: other scripts; 0: padding


def codes(text: str) -> np.ndarray:
    """The class of every character."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(c < 128, _CLASS[np.minimum(c, 127)], 14)


def classes(texts: list[str], width: int) -> np.ndarray:
    out = np.zeros((len(texts), width), np.int64)
    for i, t in enumerate(texts):
        out[i, :len(t)] = codes(t)
    return out


def _sigmoid(x):
    return 1 / (1 + np.exp(-x))


class Tagger:
    """Embedding, one LSTM each way, linear tag scores and CRF transitions."""

    def __init__(self, seed: int = SEED):
        g = np.random.default_rng(seed)
        r = lambda *s: (g.standard_normal(s) * 0.2).astype(np.float32)
        self.p = {"E": r(CLASSES, EMBED), "O": r(2 * HIDDEN, TAGS), "c": np.zeros(TAGS, np.float32), "T": r(TAGS, TAGS)}
        for d in "fb":
            self.p |= {f"W{d}": r(EMBED, 4 * HIDDEN), f"U{d}": r(HIDDEN, 4 * HIDDEN), f"b{d}": np.zeros(4 * HIDDEN, np.float32)}
            self.p[f"b{d}"][HIDDEN:2 * HIDDEN] = 1

    def _lstm(self, x: np.ndarray, d: str, keep: bool):
        """Hidden states of inputs (length, batch, EMBED)."""
        n, b, _ = x.shape
        w = x @ self.p[f"W{d}"] + self.p[f"b{d}"]
        h, c = np.zeros((b, HIDDEN), np.float32), np.zeros((b, HIDDEN), np.float32)
        hs, cache = np.empty((n, b, HIDDEN), np.float32), []
        for t in range(n):
            z = w[t] + h @ self.p[f"U{d}"]
            i, f, o = np.split(_sigmoid(z[:, :3 * HIDDEN]), 3, 1)
            g = np.tanh(z[:, 3 * HIDDEN:])
            c0, h0 = c, h
            c = f * c + i * g
            tc = np.tanh(c)
            h = o * tc
            hs[t] = h
            if keep:
                cache.append((i, f, o, g, c0, tc, h0))
        return hs, cache

    def emissions(self, x: np.ndarray, keep: bool = False):
        """Tag scores (length, batch, TAGS) of class rows (batch, length)."""
        e = self.p["E"][x.T]
        hf, cf = self._lstm(e, "f", keep)
        hb, cb = self._lstm(e[::-1], "b", keep)
        h = np.concatenate((hf, hb[::-1]), 2)
        s = h @ self.p["O"] + self.p["c"]
        return (s, (e, h, cf, cb)) if keep else s

    def _back(self, dh: np.ndarray, x: np.ndarray, cache: list, d: str, grad: dict) -> np.ndarray:
        dx = np.empty_like(x)
        nh, nc = np.zeros_like(dh[0]), np.zeros_like(dh[0])
        for t in range(len(x) - 1, -1, -1):
            i, f, o, g, c0, tc, h0 = cache[t]
            a = dh[t] + nh
            dc = nc + a * o * (1 - tc * tc)
            dz = np.concatenate((dc * g * i * (1 - i), dc * c0 * f * (1 - f), a * tc * o * (1 - o), dc * i * (1 - g * g)), 1)
            grad[f"W{d}"] += x[t].T @ dz
            grad[f"U{d}"] += h0.T @ dz
            grad[f"b{d}"] += dz.sum(0)
            dx[t] = dz @ self.p[f"W{d}"].T
            nh, nc = dz @ self.p[f"U{d}"].T, dc * f
        return dx

    def step(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict]:
        """Loss (negative log likelihood of the tag paths) and gradients of a batch."""
        s, (e, h, cf, cb) = self.emissions(x, True)
        n, b, _ = s.shape
        tr = self.p["T"]
        alpha, beta = np.empty_like(s), np.zeros_like(s)
        alpha[0] = s[0]
        lse = lambda a, ax: (m := a.max(ax)) + np.log(np.exp(a - np.expand_dims(m, ax)).sum(ax))
        for t in range(1, n):
            alpha[t] = s[t] + lse(alpha[t - 1][:, :, None] + tr, 1)
        for t in range(n - 2, -1, -1):
            beta[t] = lse(tr + (s[t + 1] + beta[t + 1])[:, None, :], 2)
        z = lse(alpha[-1], 1)
        ds = np.exp(alpha + beta - z[None, :, None])
        grad = {k: np.zeros_like(v) for k, v in self.p.items()}
        rows, yt = np.arange(b), y.T
        gold = s[0][rows, yt[0]]
        for t in range(1, n):
            pair = np.exp(alpha[t - 1][:, :, None] + tr + (s[t] + beta[t])[:, None, :] - z[:, None, None])
            grad["T"] += pair.sum(0)
            np.add.at(grad["T"], (yt[t - 1], yt[t]), -1)
            gold = gold + s[t][rows, yt[t]] + tr[yt[t - 1], yt[t]]
        for t in range(n):
            ds[t][rows, yt[t]] -= 1
        grad["O"] = np.einsum("tbh,tbk->hk", h, ds)
        grad["c"] = ds.sum((0, 1))
        dh = ds @ self.p["O"].T
        de = self._back(dh[:, :, :HIDDEN], e, cf, "f", grad) + self._back(dh[::-1][:, :, HIDDEN:], e[::-1], cb, "b", grad)[::-1]
        np.add.at(grad["E"], x.T, de)
        return float((z - gold).mean()), {k: v / b for k, v in grad.items()}

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS) -> list[float]:
        g = np.random.default_rng(SEED)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(w) for k, w in self.p.items()}
        losses, n = [], 0
        for ep in range(epochs):
            order, total = g.permutation(len(x)), 0.0
            for i in range(0, len(x), BATCH):
                loss, grad = self.step(x[order[i:i + BATCH]], y[order[i:i + BATCH]])
                total += loss * len(order[i:i + BATCH])
                n += 1
                norm = np.sqrt(sum(float((a * a).sum()) for a in grad.values()))
                for k, a in grad.items():
                    a = a * min(1.0, 5 / (norm + 1e-9))
                    m[k] = 0.9 * m[k] + 0.1 * a
                    v[k] = 0.999 * v[k] + 0.001 * a * a
                    self.p[k] = (self.p[k] - RATE * (1 - ep / epochs) * (m[k] / (1 - 0.9 ** n)) / (np.sqrt(v[k] / (1 - 0.999 ** n)) + 1e-8)).astype(np.float32)
            losses.append(total / len(x))
        return losses

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best tag paths (batch, length) and the scores behind them."""
        s = self.emissions(x)
        n, b, _ = s.shape
        tr = self.p["T"].copy()
        for k in range(len(KINDS)):  # inside follows begin or inside of its kind only
            ok = np.zeros(TAGS, bool)
            ok[[1 + 2 * k, 2 + 2 * k]] = True
            tr[~ok, 2 + 2 * k] = -1e4
        best, back = s[0].copy(), np.empty((n, b, TAGS), np.int8)
        best[:, 2::2] = -1e4
        for t in range(1, n):
            a = best[:, :, None] + tr
            back[t] = a.argmax(1)
            best = a.max(1) + s[t]
        path = np.empty((n, b), np.int64)
        path[-1] = best.argmax(1)
        for t in range(n - 1, 0, -1):
            path[t - 1] = back[t][np.arange(b), path[t]]
        return path.T, s.transpose(1, 0, 2)


# -------------------------------------------------------------------- training
def variants(kind: int, s: str, g: np.random.Generator) -> str:
    """The same datum in a form that the patterns miss."""
    if kind == 0:
        return s.replace("@", g.choice([" @ ", "@ ", " @"]))
    if kind == 1:
        return s.replace(".", " . ")
    if kind == 2:
        d = _digits(s)
        return ".".join(d[i:i + 4] for i in range(0, len(d), 4))
    d = _digits(s)
    return g.choice([f"({d[-10:-7]}) {d[-7:-4]}-{d[-4:]}", f"{d[-10:-7]}-{d[-7:-4]}-{d[-4:]}"])


def labelled_windows(texts: Iterable[str]) -> tuple[list[str], np.ndarray]:
    """Windows around base spans, as they are and rewritten, and around other digits, with their tags."""
    g = np.random.default_rng(SEED)
    rows: list[tuple[str, list[int]]] = []
    for text in texts:
        if len(rows) >= TRAIN_WINDOWS:
            break
        spans = base_spans(text)
        tags = [0] * len(text)
        for k, i, j in spans:
            tags[i:j] = [1 + 2 * k] + [2 + 2 * k] * (j - i - 1)
        for k, i, j in spans:
            lo = max(0, i - int(g.integers(4, WINDOW - 4)))
            rows.append((text[lo:lo + WINDOW], tags[lo:lo + WINDOW]))
            s = variants(k, text[i:j], g)
            t, y = text[max(0, i - 20):i] + s, tags[max(0, i - 20):i] + [1 + 2 * k] + [2 + 2 * k] * (len(s) - 1)
            rows.append(((t + text[j:])[:WINDOW], (y + tags[j:])[:WINDOW]))
        other = [m.start() for m in TRIGGER.finditer(text) if not tags[m.start()]][:3]
        for i in other:
            lo = max(0, i - int(g.integers(0, WINDOW)))
            rows.append((text[lo:lo + WINDOW], tags[lo:lo + WINDOW]))
    rows = rows[:TRAIN_WINDOWS]
    y = np.zeros((len(rows), WINDOW), np.int64)
    for i, (_, t) in enumerate(rows):
        y[i, :len(t)] = t
        y[i, :1] = np.where(y[i, :1] % 2 == 0, np.maximum(y[i, :1] - 1, 0), y[i, :1])  # a cut span begins anew
    return [t for t, _ in rows], y


def train(docs: DataFrame) -> Tagger | None:
    """From at most ``TRAIN_TEXTS`` texts with a digit or @, the first by
    hash: the hashes are chosen first, so only the chosen texts move."""
    some = docs.filter(F.col("text").rlike("[0-9@]")).select("text", F.xxhash64("text").alias("h"))
    first = some.select("h").distinct().orderBy("h").limit(TRAIN_TEXTS).withColumnRenamed("h", "_h")
    some = some.join(F.broadcast(first), F.col("h") == F.col("_h")).groupBy("h").agg(F.min("text").alias("text")).orderBy("h").select("text")
    texts, y = labelled_windows(r.text for r in some.toLocalIterator())  # no text is fetched once the windows are enough
    if not texts:
        return None
    model = Tagger()
    model.fit(classes(texts, WINDOW), y)
    return model


# ------------------------------------------------------------------- inference
_NUMBER = re.compile(r"[0-9][0-9 ().+-]*")
_BEFORE, _AFTER = re.compile(r"[A-Za-z0-9._%+-]"), re.compile(r"[A-Za-z0-9.-]*")


def around(text: str, at: int) -> tuple[int, int]:
    """The longest form of an address with its @ at ``at``, a space on either side allowed."""
    i = at - (text[at - 1:at] == " ")
    while i > 0 and _BEFORE.match(text, i - 1):
        i -= 1
    j = at + 1 + (text[at + 1:at + 2] == " ")
    return i, _AFTER.match(text, j).end()


def stretches(text: str) -> list[tuple[int, int]]:
    """Every stretch that a span may lie in: a plausible span holds a digit or @, and lies in the run of its characters around it."""
    runs, done = [], 0
    for m in _NUMBER.finditer(text):
        i = m.start()
        while i > done and text[i - 1] in " ().+-":
            i -= 1
        runs.append((i, m.end()))
        done = m.end()
    at = text.find("@")
    while at >= 0:
        runs.append(around(text, at))
        at = text.find("@", at + 1)
    out: list[list[int]] = []
    for i, j in sorted(runs):
        if out and i < out[-1][1]:
            out[-1][1] = max(out[-1][1], j)
        else:
            out.append([i, j])
    return [(i, j) for i, j in out]


class Edges:
    """Where the digits around a place of a text end, and the address around an @; each is looked up once."""

    def __init__(self, text: str, code: np.ndarray):
        self.text, self._address = text, {}
        at, other = np.arange(len(code)), code != 1
        self._before = np.maximum.accumulate(np.where(other, at, -1)) + 1
        self._after = np.minimum.accumulate(np.where(other, at, len(code))[::-1])[::-1]

    def whole(self, kind: int, a: int, b: int) -> tuple[int, int]:
        """A decoded span, drawn out to the ends of its address or numbers."""
        if kind == 0:
            at = self.text.find("@", max(0, a - 2), b + 2)
            if at >= 0:
                if at not in self._address:
                    i, j = around(self.text, at)
                    self._address[at] = i, j - (j - i - len(self.text[i:j].rstrip(".-")))
                return self._address[at]
            return a, b
        return (int(self._before[a - 1]) if a else a), (int(self._after[b]) if b < len(self.text) else b)


def plausible(kind: int, s: str) -> bool:
    """Whether a decoded span has what its kind needs."""
    d = _digits(s)
    if kind == 0:
        return bool(re.fullmatch(r"[A-Za-z0-9._%+-]+ ?@ ?[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", s))
    if kind == 1:
        parts = re.split(r" ?\. ?", s)
        return len(parts) == 4 and all(p.isascii() and p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in parts)
    if re.search(r"[^0-9 ().+-]", s):
        return False
    return (16 <= len(d) <= 19 and luhn(d)) if kind == 2 else 8 <= len(d) <= 15


def spans_of(texts: list[str], model: Tagger | None) -> list[list[tuple[int, int, int]]]:
    """Base and added spans of each text, by kind and start."""
    base = [base_spans(t) for t in texts]
    if model is None:
        return base
    out = []
    for t, spans, more in zip(texts, base, _decoded(texts, model)):
        taken: list[tuple[int, int]] = []  # disjoint, in order
        for _, i, j in sorted(spans, key=lambda x: x[1:]):
            if taken and i < taken[-1][1]:
                taken[-1] = taken[-1][0], max(j, taken[-1][1])
            else:
                taken.append((i, j))
        added = []
        for _, a, b, k in sorted(more):  # of all stretches at once
            at = bisect_left(taken, (a, b))
            if (at == 0 or taken[at - 1][1] <= a) and (at == len(taken) or taken[at][0] >= b):
                insort(taken, (a, b))
                added.append((int(k), a, b))
        out.append(sorted(spans + added))
    return out


def windows(size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of stretches of these sizes, every window: its stretch, its start in it, and the columns that count."""
    n = 1 + np.maximum(0, -(-(size - WINDOW) // STRIDE))
    of = np.repeat(np.arange(len(size)), n)
    number = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
    edge = (WINDOW - STRIDE) // 2
    return of, number * STRIDE, np.where(number == 0, 0, edge), np.where(number == n[of] - 1, WINDOW, WINDOW - edge)


def _decoded(texts: list[str], model: Tagger) -> list[set[tuple[float, int, int, int]]]:
    """(minus the odds, start, end, kind) of the plausible spans of each text, stitched from windows."""
    found: list[set[tuple[float, int, int, int]]] = [set() for _ in texts]
    where = [(i, max(0, lo - STRIDE), min(len(t), hi + STRIDE)) for i, t in enumerate(texts) for lo, hi in stretches(t)]
    if not where:
        return found
    code = {i: codes(texts[i]) for i in {w[0] for w in where}}
    size = np.array([hi - lo for _, lo, hi in where])
    first = np.append(0, np.cumsum(size))
    flat = np.concatenate([code[i][lo:hi] for i, lo, hi in where])  # the stretches, end to end
    tag, odds = np.zeros(len(flat), np.int64), np.zeros(len(flat), np.float32)
    of, start, lo_col, hi_col = windows(size)
    cols = np.arange(WINDOW)
    for w in range(0, len(of), DECODED):
        part = slice(w, w + DECODED)
        at = (first[of[part]] + start[part])[:, None] + cols
        inside = at < first[of[part] + 1][:, None]
        path, score = model.decode(np.where(inside, flat[np.minimum(at, len(flat) - 1)], 0))
        keep = inside & (cols >= lo_col[part][:, None]) & (cols < hi_col[part][:, None])
        tag[at[keep]] = path[keep]
        odds[at[keep]] = (np.take_along_axis(score, path[:, :, None], 2)[:, :, 0] - score[:, :, 0])[keep]
    # spans: a begin, or an inside that follows another kind or nothing, opens one
    kind = np.where(tag > 0, (tag - 1) // 2, -1)
    opens = np.append(True, kind[1:] != kind[:-1]) | (tag % 2 == 1)
    opens[first[:-1]] = True
    cut = np.flatnonzero(opens)
    mean = np.add.reduceat(odds, cut) / np.diff(np.append(cut, len(flat)))
    edges: dict[int, Edges] = {}
    stop = np.append(cut[1:], len(flat))
    best: dict[tuple[int, int, int, int], float | None] = {}  # each form is judged once
    for n in np.flatnonzero((kind[cut] >= 0) & (mean >= MARGIN)):
        stretch = int(np.searchsorted(first, cut[n], side="right")) - 1
        i, lo, _ = where[stretch]
        x, y, k = int(cut[n] - first[stretch]) + lo, int(stop[n] - first[stretch]) + lo, int(kind[cut[n]])
        s = texts[i][x:y]
        if not s.strip():
            continue
        edge = edges.get(i) or edges.setdefault(i, Edges(texts[i], code[i]))
        a, b = edge.whole(k, x + len(s) - len(s.lstrip()), y - (len(s) - len(s.rstrip())))
        key, score = (i, k, a, b), float(mean[n])
        if key not in best:
            best[key] = score if plausible(k, texts[i][a:b]) else None
        elif best[key] is not None:
            best[key] = max(best[key], score)
    for (i, k, a, b), score in best.items():
        if score is not None:
            found[i].add((-score, a, b, k))
    return found


def render(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{i}:{j}" for k, i, j in sorted(spans))


def detect(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans (all) and n_added per document."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            texts = [t or "" for t in column(b, "text").to_pylist()]
            base = [base_spans(t) for t in texts]
            every = spans_of(texts, shared.value)
            counts = [np.bincount([k for k, _, _ in s], minlength=4) for s in base]
            yield pa.RecordBatch.from_arrays(
                [column(b, "doc_id").cast(pa.int64())] + [pa.array([int(c[k]) for c in counts], pa.int64()) for k in range(4)]
                + [pa.array([hashlib.sha256(render(s).encode()).hexdigest() for s in base], pa.string()),
                   pa.array([render(s) for s in every], pa.string()), pa.array([len(e) - len(s) for e, s in zip(every, base)], pa.int64())],
                names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long")


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect(read_documents(spark, sf_dir))
