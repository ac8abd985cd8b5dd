r"""Personal data in documents: base patterns, and a character-level bidirectional LSTM with a CRF on top.

The network reads classes of characters, a forward and a backward layer of ``HIDDEN`` cells each; their states give
a score for each of the tags (outside, the base kinds, and ``more``: kinds that no base pattern knows), and a CRF's
transitions between tags are learned with them. It is trained in numpy on the driver, by exact gradients through
time, from

- windows of at most ``TRAIN_DOCS`` documents (of those that hold a digit or an @ those with the least hashes of
  doc_id), at most ``WINDOWS`` a document, chosen by a hash of their place over the whole text; labels are the base spans;
- ``EXAMPLES`` sentences with base kinds and with others (telephone numbers without a plus, social security, account and
  passport numbers, cards written with points, IPv6 and hardware addresses, spelled-out mail addresses), beside dates,
  prices, versions, times, ids, codes and long numbers that are none. Half of what stands around them is cut from the
  sampled documents, at most ``WINDOWS`` pieces of each; the rest is made up, with and without capitals and labels.

Every kind that is learned holds a digit, an @ or an "(at)" in some spelling, and none reaches further than ``REACH``
characters beyond these: names and street addresses by themselves aren't looked for. So the network reads the stretches
of a text within ``REACH`` of such a character; the rest is outside by definition, not by its score. Stretches are cut into windows of ``WINDOW`` characters that overlap by ``OVERLAP``;
scores of characters in two windows are averaged by their distance from the window's ends, and one Viterbi pass runs
over the whole stretch, so spans across windows come out whole. A run tagged ``more`` that overlaps no base span is
added as a span of kind ``model``; runs of base tags that the patterns reject (a card that fails its check) are not.

Defined results: null and empty texts have no span; texts of any length are scanned whole, in time and memory in
proportion to it; spans count code points, at one start they are listed by kind; repeated rows are scanned one by one;
a null doc_id is kept; other columns, whatever their names, are not looked at; an empty table gives an empty table.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessela.llm.shared import sampled, written
from tessela.llm.spans import Span, apart_from, rows_of, span_batches, span_schema
from tessela.llm.tokens import mix64, pieces

HIDDEN = 32
WINDOW = 96
OVERLAP = 32
REACH = 24
TRAIN_DOCS = 300
WINDOWS = 6
EXAMPLES = 3000
STEPS = 400
BATCH = 48
SEED = 9
#: Characters of stretches that are decoded side by side.
SIDE_BY_SIDE = 1 << 18

#: The base patterns, by kind in the order of listing.
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "model")
TAGS = len(BASE) + 2
MORE = TAGS - 1
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
#: Email as local part and domain, addresses as whole chains of numbers: so a long run is gone through once.
LOCAL = re.compile(r"[A-Za-z0-9._%+-]++")
NUMBERS = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_SINGLE = "@.-+()_%:/,;!?'\"=#*$&|<>\n[]"
_N_CLASSES = 8 + len(_SINGLE)
_CLASS = np.full(128, 5, dtype=np.int64)
_CLASS[[ord(" "), 9, 13, 11, 12]] = 0
_CLASS[48:58], _CLASS[65:91], _CLASS[97:123] = 1, 2, 3
for _i, _c in enumerate(_SINGLE):
    _CLASS[ord(_c)] = 6 + _i
_CLASS[65:71], _CLASS[97:103] = _N_CLASSES - 2, _N_CLASSES - 1


def classes(codes: np.ndarray) -> np.ndarray:
    """Classes of code points: blank, digit, upper, lower, not ASCII (4), other (5), marks of their own, upper and lower hex letters."""
    return np.where(codes < 128, _CLASS[np.minimum(codes, 127)], 4)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def emails(text: str) -> list[Span]:
    """As ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+`` from the left: the run before an @, and the domain after it."""
    out: list[Span] = []
    for m in LOCAL.finditer(text) if "@" in text else ():
        start = max(m.start(), out[-1][2] if out else 0)
        if start < m.end() and (domain := DOMAIN.match(text, m.end())):
            out.append(("email", start, domain.end()))
    return out


def addresses(text: str) -> list[Span]:
    """Of each chain of numbers with points between them the fours from its start, if no number is above 255."""
    out: list[Span] = []
    for m in NUMBERS.finditer(text):
        if m[0].count(".") < 3:
            continue
        parts, at = m[0].split("."), m.start()
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p) <= 3 or len(p.lstrip("0")) <= 3 for p in four) and all(int(p.lstrip("0") or 0) <= 255 for p in four):
                out.append(("ip", at, end))
            at = end + 1
    return out


def base_spans(text: str) -> list[Span]:
    spans = emails(text) + addresses(text)
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            spans.append(("card", m.start(), m.end()))
    if "+" in text:
        spans += [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return spans


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


class Network:
    """Parameters by name: input, recurrent and bias of both directions, output, transitions."""

    def __init__(self) -> None:
        rng = np.random.default_rng(SEED)
        h, tags = HIDDEN, TAGS
        self.p = {}
        for d in "fb":
            self.p[f"x{d}"] = rng.normal(0, 0.3, (_N_CLASSES, 4 * h)).astype(np.float32)
            self.p[f"h{d}"] = rng.normal(0, 0.25, (h, 4 * h)).astype(np.float32)
            self.p[f"c{d}"] = np.repeat(np.array([0, 1, 0, 0], dtype=np.float32), h)
        self.p["o"] = rng.normal(0, 0.3, (2 * h, tags)).astype(np.float32)
        self.p["ob"] = np.zeros(tags, dtype=np.float32)
        self.p["t"] = np.zeros((tags, tags), dtype=np.float32)

    def _layer(self, x: np.ndarray, d: str, keep: list | None) -> np.ndarray:
        """States (window, place, cell); direction b runs from the end."""
        n, length, h = len(x), x.shape[1], HIDDEN
        out = np.zeros((n, length, h), dtype=np.float32)
        state, cell = np.zeros((n, h), dtype=np.float32), np.zeros((n, h), dtype=np.float32)
        for k in range(length) if d == "f" else range(length - 1, -1, -1):
            z = self.p[f"x{d}"][x[:, k]] + state @ self.p[f"h{d}"] + self.p[f"c{d}"]
            gates = _sigmoid(z[:, : 3 * h])
            i, f, o = gates[:, :h], gates[:, h : 2 * h], gates[:, 2 * h :]
            g = np.tanh(z[:, 3 * h :])
            before, was = state, cell
            cell = f * cell + i * g
            tc = np.tanh(cell)
            state = o * tc
            out[:, k] = state
            if keep is not None:
                keep.append((k, before, was, i, f, o, g, tc))
        return out

    def emissions(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([self._layer(x, "f", None), self._layer(x, "b", None)], axis=2) @ self.p["o"] + self.p["ob"]

    def gradients(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean log-likelihood of the tags ``y``."""
        n, length, h = len(x), x.shape[1], HIDDEN
        kept: dict[str, list] = {"f": [], "b": []}
        states = np.concatenate([self._layer(x, d, kept[d]) for d in "fb"], axis=2)
        e, t = states @ self.p["o"] + self.p["ob"], self.p["t"]
        alpha, beta = np.zeros_like(e), np.zeros_like(e)
        alpha[:, 0] = e[:, 0]
        for k in range(1, length):
            alpha[:, k] = np.logaddexp.reduce(alpha[:, k - 1, :, None] + t, axis=1) + e[:, k]
        for k in range(length - 2, -1, -1):
            beta[:, k] = np.logaddexp.reduce(t + (e[:, k + 1] + beta[:, k + 1])[:, None, :], axis=2)
        z = np.logaddexp.reduce(alpha[:, -1], axis=1)
        de = (np.eye(len(t), dtype=np.float32)[y] - np.exp(alpha + beta - z[:, None, None])) / n
        pair = np.exp(alpha[:, :-1, :, None] + t + (e[:, 1:] + beta[:, 1:])[:, :, None, :] - z[:, None, None, None])
        dt = -pair.sum(axis=(0, 1))
        np.add.at(dt, (y[:, :-1].ravel(), y[:, 1:].ravel()), 1)
        g = {"o": states.reshape(-1, 2 * h).T @ de.reshape(-1, len(t)), "ob": de.sum(axis=(0, 1)), "t": dt / n}
        ds = de @ self.p["o"].T
        for d, part in (("f", ds[:, :, :h]), ("b", ds[:, :, h:])):
            dx, dh, dc = np.zeros_like(self.p[f"x{d}"]), np.zeros_like(self.p[f"h{d}"]), np.zeros_like(self.p[f"c{d}"])
            back_h, back_c = np.zeros((n, h), dtype=np.float32), np.zeros((n, h), dtype=np.float32)
            for k, before, was, i, f, o, gg, tc in reversed(kept[d]):
                s = part[:, k] + back_h
                c = back_c + s * o * (1 - tc * tc)
                dz = np.concatenate([c * gg * i * (1 - i), c * was * f * (1 - f), s * tc * o * (1 - o), c * i * (1 - gg * gg)], axis=1)
                np.add.at(dx, x[:, k], dz)
                dh += before.T @ dz
                dc += dz.sum(axis=0)
                back_h, back_c = dz @ self.p[f"h{d}"].T, c * f
            g[f"x{d}"], g[f"h{d}"], g[f"c{d}"] = dx, dh, dc
        return g

    def fit(self, x: np.ndarray, y: np.ndarray, steps: int = STEPS, rate: float = 0.03) -> None:
        """Adam over batches in a seeded order."""
        rng = np.random.default_rng(SEED)
        m, v = ({k: np.zeros_like(p) for k, p in self.p.items()} for _ in range(2))
        for step in range(1, steps + 1):
            some = rng.permutation(len(x))[:BATCH]
            for k, g in self.gradients(x[some], y[some]).items():
                g = np.clip(g, -5, 5)
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.99 * v[k] + 0.01 * g * g
                self.p[k] = (self.p[k] + rate * min(1, 2 - 2 * step / steps) * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)

    def tag(self, stretches: list[np.ndarray]) -> list[np.ndarray]:
        """The best tags of each stretch of classes: windows are scored together, each stretch is decoded as a whole."""
        at, windows = [], []
        for s, codes in enumerate(stretches):
            for a in range(0, max(1, len(codes) - OVERLAP), WINDOW - OVERLAP):
                part = codes[a : a + WINDOW]
                windows.append(np.pad(part, (0, WINDOW - len(part))))
                at.append((s, a, len(part)))
        sums = [np.zeros((len(c), TAGS)) for c in stretches]
        weights = [np.zeros(len(c)) for c in stretches]
        edge = np.minimum(np.arange(WINDOW), np.arange(WINDOW)[::-1]) + 1.0
        for k in range(0, len(windows), 512):
            scores = self.emissions(np.stack(windows[k : k + 512]))
            for (s, a, n), e in zip(at[k : k + 512], scores, strict=True):
                sums[s][a : a + n] += e[:n] * edge[:n, None]
                weights[s][a : a + n] += edge[:n]
        return self._viterbi([x / w[:, None] for x, w in zip(sums, weights, strict=True)])

    def _viterbi(self, scores: list[np.ndarray]) -> list[np.ndarray]:
        """Stretches of similar length take their steps together, as many as hold ``SIDE_BY_SIDE`` characters."""
        out: list[np.ndarray] = [np.zeros(0, np.int8)] * len(scores)
        order = sorted(range(len(scores)), key=lambda i: -len(scores[i]))
        while order:
            n = len(scores[order[0]])
            k = max(1, SIDE_BY_SIDE // max(n, 1))
            own, order = order[:k], order[k:]
            e = np.zeros((len(own), n, TAGS), dtype=np.float32)
            for j, i in enumerate(own):
                e[j, : len(scores[i])] = scores[i]
                e[j, len(scores[i]) :, 1:] = -50
            best, back = e[:, 0], np.zeros(e.shape, dtype=np.int8)
            for j in range(1, n):
                step = best[:, :, None] + self.p["t"]
                back[:, j] = step.argmax(axis=1)
                best = step.max(axis=1) + e[:, j]
            tags = np.zeros((len(own), n), dtype=np.int8)
            tags[:, -1] = best.argmax(axis=1)
            for j in range(n - 1, 0, -1):
                tags[:, j - 1] = back[np.arange(len(own)), j, tags[:, j]]
            for j, i in enumerate(own):
                out[i] = tags[j, : len(scores[i])]
        return out


_AT = re.compile(r"[(\[] ?at ?[)\]]", re.IGNORECASE)


def stretches(text: str) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """A text's classes, and what lies within ``REACH`` of a digit, an @ or an "(at)"."""
    kind = classes(np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32))
    hot = np.flatnonzero((kind == 1) | (kind == 6))
    if "(" in text or "[" in text:
        hot = np.union1d(hot, np.array([m.start() for m in _AT.finditer(text)], dtype=np.int64))
    if not len(hot):
        return kind, []
    cut = np.flatnonzero(np.diff(hot) > 2 * REACH)
    starts, ends = hot[np.r_[0, cut + 1]] - REACH, hot[np.r_[cut, len(hot) - 1]] + REACH + 1
    return kind, list(zip(np.maximum(starts, 0).tolist(), np.minimum(ends, len(kind)).tolist(), strict=True))


def examples(n: int = EXAMPLES, seed: int = SEED, contexts: list[str] | None = None) -> list[tuple[str, list[tuple[int, int]]]]:
    """Sentences with personal data of each kind, and with numbers that are none; spans, in code points, are of the kinds that base patterns don't know.

    Half of the sentences around the values are ``contexts``, if there are any, cut anywhere; the others are made-up
    words with and without capitals, labels with a colon, or nothing at all.
    """
    rng = np.random.default_rng(seed)
    num = lambda a, b: int(rng.integers(a, b))
    pick = lambda *of: of[num(0, len(of))]
    digits = lambda k: "".join(map(str, rng.integers(10, size=k)))
    drawn = lambda of, k: "".join(rng.choice(list(of), k))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    hexa = lambda k: drawn("0123456789abcdef", k)
    fours = lambda t: " ".join(t[i : i + 4] for i in range(0, len(t), 4))

    def word() -> str:
        w = drawn("aaaabbcddeeeeeefghiiiijklllmmnnnnoooprrrrsssstttuuvwyzéñü", num(1, 11))
        return (w, w, w, w.capitalize(), w.upper() if num(0, 3) == 0 else w)[num(0, 5)]

    def name() -> str:
        return drawn("abcdefghiklmnoprstuvw", num(1, 9))

    def card(sep: str) -> str:
        body = "4" + digits(14)
        body += next(c for c in "0123456789" if luhn(body + c))
        return sep.join(body[i : i + 4] for i in range(0, 16, 4))

    def account() -> str:
        body = drawn(upper, 2) + digits(2) + drawn(upper, 4 * num(0, 2)) + digits(num(10, 20)) + pick("", drawn(upper, 1) + digits(num(2, 6)))
        return fours(body) if num(0, 2) else body

    def telephone() -> str:
        sep = pick("-", ".", " ")
        return pick(
            lambda: f"({num(100, 999)}){pick(' ', '')}{num(100, 999)}-{digits(4)}",
            lambda: f"{num(200, 999)}{sep}{num(100, 999)}{sep}{digits(4)}",
            lambda: f"{num(200, 999)}{sep}{num(100, 999)}{sep}{digits(4)}",
            lambda: f"0{num(10, 999)}{pick('/', '-', ' ')}{digits(num(6, 9))}",
            lambda: f"0{num(10, 99)} {digits(4)} {digits(4)}",
            lambda: f"0{num(100, 999)} {digits(3)} {digits(4)}",
            lambda: f"0{num(1000, 9999)} {digits(6)}",
            lambda: f"0{num(1, 9)}{''.join(sep + digits(2) for _ in range(4))}",
            lambda: f"{num(600, 999)} {pick(digits(3) + ' ' + digits(3), ' '.join(digits(2) for _ in range(3)))}",
        )()

    def more() -> str:
        at, dot = pick(" (at) ", "(at)", " [at] ", "[at]", " (At) ", " ( at ) "), pick(" (dot) ", ".", ".", " [dot] ")
        mac = pick(":", "-").join(hexa(2) for _ in range(6))
        return pick(
            telephone,
            telephone,
            telephone,
            lambda: f"{digits(3)}{(s := pick('-', '-', ' '))}{digits(2)}{s}{digits(4)}",
            account,
            account,
            lambda: card("."),
            lambda: ":".join(pick(hexa(4), hexa(4), hexa(num(1, 5)), "0") for _ in range(8)),
            lambda: pick(mac, mac.upper()),
            lambda: f"{name()}{pick('', '.' + name(), digits(2))}{at}{name()}{dot}{pick('com', 'org', 'de', 'fr', 'es', 'net')}",
            lambda: pick(drawn(upper, 1) + digits(8), drawn(upper, 2) + digits(7)),
        )()

    def other() -> str:
        d, m, y = num(1, 32), num(1, 13), num(1850, 2040)
        return pick(
            lambda: f"{name()}.{num(1, 99)}@{name()}{num(1, 9)}.{name()}.com",
            lambda: ".".join(str(num(0, 256)) for _ in range(4)),
            lambda: card(pick("", " ", "-")),
            lambda: f"+{num(1, 99)} ({num(100, 999)}) {num(100, 999)}-{num(1000, 9999)}",
            lambda: digits(num(1, 22)),
            lambda: digits(num(1, 5)),
            lambda: f"{y}{(s := pick('-', '-', '/', '.'))}{m:02d}{s}{d:02d}",
            lambda: f"{d:02d}{(s := pick('-', '/', '.'))}{m:02d}{s}{y}",
            lambda: f"{d}{(s := pick('/', '.'))}{m}{pick('', s + str(y))}",
            lambda: f"{d} {word()} {y}",
            lambda: f"{y}{pick('-', '/')}{pick(y + num(1, 30), num(10, 99))}",
            lambda: f"{pick('version ', 'v', '')}{num(1, 20)}.{num(0, 19)}{pick('', '.' + str(num(0, 99)))}",
            lambda: f"{num(1, 999)},{num(100, 999)}{pick('', ',' + digits(3), ',' + digits(3) + ',' + digits(3))}{pick('', '.50', ' EUR', '.00 EUR')}",
            lambda: f"{num(1, 99)} {digits(3)} {digits(3)}",
            lambda: f"{num(0, 24):02d}:{num(0, 60):02d}{pick('', ':' + format(num(0, 60), '02d'))}",
            lambda: f"{num(1, 200)}:{num(1, 40)}{pick('', '-' + str(num(1, 60)))}",
            lambda: f"ISO {num(1000, 30000)}:{y}",
            lambda: pick(f'"{hexa(num(16, 41))}"', hexa(num(7, 65)), "#" + hexa(6)),
            lambda: f"ISBN 978-{num(0, 9)}-{digits(num(2, 5))}-{digits(num(4, 7))}-{num(0, 9)}",
            lambda: f"({num(1, 200)}) {word()} {num(1, 99)}-{num(1, 999)}",
            lambda: f"{word()} ({pick('at', 'in', 'of', 'is')} {word()}) {num(1, 99)}",
            lambda: f"{num(1, 90)}.{digits(4)}, {num(1, 180)}.{digits(4)}",
            lambda: f"{num(1, 99)} {pick('+', '-', '=', 'x', '%', 'x', '/')} {num(1, 99)} {pick('=', '')} {num(1, 999)}",
            lambda: f"{num(1, 9)}-{num(1, 9)} {word()} @{word()}",
            lambda: f"{drawn(upper, num(1, 4))}{pick('', '-', ' ')}{num(1, 9999)}",
            lambda: f"{word()} {num(1, 999)} {word()} {num(1, 99)} {num(1, 999)}",
            lambda: f"AKIA{drawn(upper + '0123456789', 16)}",
            lambda: f"#{digits(num(3, 9))} | {num(1, 99)} | {num(1, 9)} |",
        )()

    def around(most: int) -> str:
        if contexts and num(0, 2):
            text = pick(*contexts)
            a = num(0, max(1, len(text) - 20))
            return text[a : a + num(0, 60)].strip()
        label = pick("", "", word() + ":", word() + ",", word() + " no.", word() + "'s", "(" + word())
        return " ".join([*(word() for _ in range(num(0, most))), label]).strip()

    out = []
    for _ in range(n):
        text, spans = "", []
        for _ in range(num(1, 4)):
            before = around(7)
            text += before + (" " if before and before[-1] != "(" else "")
            if rng.random() < 0.45:
                value = more()
                spans.append((len(text), len(text) + len(value)))
                text += value
            else:
                text += other()
            text += pick(" ", " ", ". ", ", ", "; ", ") ", "\n", "!! ", "### ")
        out.append(((text + around(5)).rstrip() if num(0, 2) else text.rstrip(), spans))
    return out


def _windows(text: str, spans: list[tuple[int, int]], most: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Windows of a text's stretches, all or those with the least hashes of their places: classes and tags."""
    kind, parts = stretches(text)
    y = np.zeros(len(kind), dtype=np.int64)
    for a, b in spans:
        y[a:b] = MORE
    for name, a, b in base_spans(text):
        y[a:b] = BASE.index(name) + 1
    at = np.array([(c, min(c + WINDOW, b)) for a, b in parts for c in range(a, max(a + 1, b - OVERLAP), WINDOW - OVERLAP)], dtype=np.int64).reshape(-1, 2)
    chosen = np.argsort(mix64(at[:, 0].astype(np.uint64) + np.uint64(SEED)), kind="stable")[:most]
    return [(np.pad(kind[a:b], (0, WINDOW - (b - a))), np.pad(y[a:b], (0, WINDOW - (b - a)))) for a, b in at[np.sort(chosen)].tolist()]


def _contexts(text: str, most: int) -> list[str]:
    """Pieces of a text without digits and marks of addresses, those with the least hashes of their places."""
    at = np.arange(0, len(text), WINDOW)
    at = at[np.argsort(mix64(at.astype(np.uint64) + np.uint64(SEED)), kind="stable")].tolist()
    bare = (" ".join(text[a : a + WINDOW].split()) for a in at)
    return [c for c in bare if len(c) >= 20 and not re.search(r"[0-9@(\[]", c)][:most]


def fit(docs: DataFrame, rows: int = TRAIN_DOCS) -> Network:
    """Learns from the base spans in windows of a bounded sample, and from examples."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_py() for t in batch.column(0)]
            found = [w for t in texts for w in _windows(t, [], WINDOWS)]
            around = [c for t in texts for c in _contexts(t, WINDOWS)]
            lists = [pa.array([w[k] for w in found] + [None] * len(around), type=pa.list_(pa.int64())) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([*lists, pa.array([None] * len(found) + around, type=pa.string())], names=["x", "y", "around"])

    some = written(docs.filter(F.col("text").rlike("[0-9@]") & F.col("doc_id").isNotNull()).select("doc_id"))
    ids = F.broadcast(sampled(some, "doc_id", rows).select(F.col("doc_id").alias("__id")).distinct())
    texts = docs.join(ids, F.col("doc_id") == F.col("__id")).groupBy("doc_id").agg(F.max("text").alias("text")).select("text")
    rows = texts.mapInArrow(run, "x array<long>, y array<long>, around string").collect()
    found = sorted((r["x"], r["y"]) for r in rows if r["x"] is not None)
    contexts = sorted(r["around"] for r in rows if r["around"] is not None)
    made = [w for t, spans in examples(contexts=contexts) for w in _windows(t, spans, 1 << 30)]
    x, y = (np.stack([np.array(w[k]) for w in [*found, *made]]) for k in (0, 1))
    network = Network()
    network.fit(x, y)
    return network


def scan(docs: DataFrame, network: Network | None = None) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) of each document, over whole texts."""
    docs = docs.select(F.col("doc_id").try_cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(network or fit(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for piece in pieces(batch.column(1)):
                data = piece.data
                rows = rows_of(piece, np.flatnonzero(((data >= 48) & (data < 58)) | (data == 64) | (data == 40) | (data == 91))).tolist()
                texts = [data[piece.text_at[i] : piece.text_at[i + 1]].tobytes().decode() for i in rows]
                cut = [stretches(t) for t in texts]
                tags = iter(model.tag([kind[a:b] for kind, parts in cut for a, b in parts]))
                found = {}
                for i, text, (_, parts) in zip(rows, texts, cut, strict=True):
                    base, own = base_spans(text), []
                    for a, _ in parts:
                        y = next(tags)
                        edge = np.flatnonzero(np.diff(np.r_[0, y, 0]))
                        for s, t in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
                            if y[s] == MORE and (bare := text[a + s : a + t].strip()):
                                first = a + s + text[a + s : a + t].index(bare)
                                own.append((first, first + len(bare)))
                    found[i] = base, [("model", a, b) for a, b in apart_from(own, base)]
                yield from span_batches(batch.column(0).slice(piece.first_row, piece.rows), KINDS, found, piece.rows)

    return docs.mapInArrow(run, span_schema(BASE))


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's personal data."""
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
