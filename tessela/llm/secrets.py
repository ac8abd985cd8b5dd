r"""Secrets in documents: base patterns, and a linear-chain conditional random field over tokens.

Tokens are runs of letters, digits and ``+/_.-``. The field tags them B (begins a secret), I (goes on) or O by
features of a token (shape: length, share of digits, mix of cases, changes of class, hexadecimal, known beginnings),
its neighbours (the words before, what stands between) and its file (how many tokens have digits). Weights are learned
in numpy on the driver, by gradients of the exact log-likelihood (forward-backward), from

- crops of at most ``TRAIN_DOCS`` documents (those with the least hashes of doc_id, at most half of them with a hint of
  a secret), at most ``CROPS`` a document, chosen by a hash of their place over the whole text; labels are the base spans;
- ``EXAMPLES`` written-out texts with kinds that the base patterns don't know: tokens of services, bearer headers,
  passwords given in prose or in addresses, keys in upper-case hexadecimal or base64, beside numbers, addresses, names,
  paths and words that are none.

Decoding is Viterbi over whole texts. Where O leads by more than any change of transitions could win, the best
path is O in any case; such tokens cut the chain, and only what lies between is decoded step by step: the result
is that of the full chain. A tagged run that overlaps no base span is added as a span of kind ``model``.

Defined results: null and empty texts have no span; texts of any length are scanned whole, in time and memory in
proportion to it; spans count code points, at one start the base kinds come first; repeated rows are scanned one by
one; a null doc_id is kept; if no document trains the field, the examples do; other columns, whatever their names,
are not looked at; an empty table gives an empty table.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessela.llm.shared import sampled, written
from tessela.llm.spans import Span, apart_from, places, rows_of, span_batches, span_schema
from tessela.llm.tokens import LOWER, Piece, char_at, mix64, pieces

TRAIN_DOCS = 600
CROPS = 4
CROP = 24
EXAMPLES = 700
BUCKETS = 1 << 14
STEPS = 80
SEED = 5

#: The base patterns, by kind in the order of listing.
BASE = ("assign", "access", "hex")
KINDS = (*BASE, "model")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
#: How tokens of well-known services begin.
BEGINNINGS = ("AKIA", "ASIA", "ghp_", "gho_", "ghs_", "xoxb", "xoxp", "eyJh", "sk_l", "sk-p", "AIza", "glpa", "npm_", "pypi")
#: Names that secrets are assigned to, and words of prose.
NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key", "passphrase", "credential", "bearer", "authorization", "private_key", "pwd", "senha", "contraseña", "passwort", "key", "pin")
PROSE = "the of and to in is that for it as was with be by on not he his but at der die und das ist nicht mit auf le la les des et en que el los las por una con para un est pas sur".split()

_TOKEN = bytes(sorted(set(range(256)) - set(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.-") - set(range(0x80, 0x100))))
_CLASS = {name: np.array([chr(b) in chars for b in range(256)]) for name, chars in (("digit", "0123456789"), ("upper", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"), ("lower", "abcdefghijklmnopqrstuvwxyz"), ("hex", "0123456789abcdef"), ("gap", ":="), ("quote", "\"'"), ("at", "@"))}
#: Sizes of the features' tables: length, digits, cases, hex, beginning, gap, file, changes of class, and three of hashed words.
_SIZES = (12, 5, 8, 4, len(BEGINNINGS) + 1, 16, 4, 8, BUCKETS, BUCKETS, BUCKETS)
_AT = np.r_[0, np.cumsum(_SIZES)]


def base_spans(text: str) -> list[Span]:
    spans = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    spans += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    return spans + [("hex", m.start(), m.end()) for m in HEX.finditer(text)]


def base_rows(piece: Piece) -> np.ndarray:
    """The texts of a piece that may hold a base span: all that hold a keyword, a key's beginning or a long run."""
    raw, low = piece.data.tobytes(), LOWER[piece.data].tobytes()
    at = [p for word in (b"passw", b"secret", b"token", b"api") for p in places(low, word)] + places(raw, b"AKIA")
    run = np.diff(np.flatnonzero(np.r_[True, ~_CLASS["hex"][piece.data], True]))
    ends = np.cumsum(run) - 1
    at = np.r_[np.array(at, dtype=np.int64), ends[run >= 25] - 1]
    return rows_of(piece, at)


def features(piece: Piece) -> np.ndarray:
    """A row per token: its place in the weights for each feature."""
    start, end, n = piece.start, piece.end, len(piece.start)
    if not n:
        return np.zeros((0, len(_SIZES)), dtype=np.int64)
    count = {}
    for name, table in _CLASS.items():
        sums = np.zeros(len(piece.data) + 1, dtype=np.int32)
        np.cumsum(table[piece.data], out=sums[1:])
        count[name] = sums
    size = end - start
    has = {k: count[k][end] - count[k][start] for k in ("digit", "upper", "lower", "hex")}
    row = np.repeat(np.arange(piece.rows), np.diff(piece.word_at))
    first = np.zeros(n, dtype=bool)
    first[piece.word_at[:-1][np.diff(piece.word_at) > 0]] = True
    before = np.r_[0, end[:-1]]
    before = np.where(first, start, before)
    gap = {k: np.minimum(count[k][start] - count[k][before], 1) for k in ("gap", "quote", "at")}
    first_bytes = np.zeros(n, dtype=np.uint32)
    for j in range(4):
        first_bytes = (first_bytes << np.uint32(8)) | piece.data[np.minimum(start + j, end - 1)].astype(np.uint32)
    begins = np.zeros(n, dtype=np.int64)
    for k, text in enumerate(BEGINNINGS):
        begins[first_bytes == int.from_bytes(text.encode(), "big")] = k + 1
    # how often letters, digits and cases change within a token
    group = _CLASS["digit"][piece.data] + 2 * _CLASS["upper"][piece.data] + 4 * _CLASS["lower"][piece.data]
    turns = np.zeros(len(piece.data) + 1, dtype=np.int32)
    np.cumsum(np.r_[False, group[1:] != group[:-1]], out=turns[1:])
    changes = turns[end] - turns[start + 1]
    h = (piece.hashes() >> np.uint64(50)).astype(np.int64)
    back = np.r_[0, h[:-1]]
    back[first] = 1
    back2 = np.r_[0, back[:-1]]
    last = np.r_[first[1:], True]
    ahead = np.r_[h[1:], 0]
    ahead[last] = 1
    digits = np.bincount(row, has["digit"] > 0, minlength=piece.rows) / np.maximum(np.diff(piece.word_at), 1)
    out = [
        np.digitize(size, (2, 4, 6, 8, 12, 16, 20, 24, 32, 40, 64)),
        np.digitize(has["digit"] / size, (1e-9, 0.15, 0.35, 0.6)),
        (has["upper"] > 0) * 4 + (has["lower"] > 0) * 2 + (has["digit"] > 0),
        (has["hex"] == size) * 2 + (size >= 16),
        begins,
        gap["at"] * 8 + gap["gap"] * 4 + gap["quote"] * 2 + (start - before > 3),
        np.digitize(digits, (0.01, 0.05, 0.2))[row],
        np.digitize(changes / size, (1e-9, 0.08, 0.15, 0.25, 0.35, 0.45, 0.6)),
        back,
        back2,
        ahead,
    ]
    return np.stack(out, axis=1) + _AT[:-1]


class Field:
    """Weights of the features by tag (B, I, O), and of the tags' transitions."""

    def __init__(self) -> None:
        self.w, self.t = np.zeros((_AT[-1], 3)), np.zeros((3, 3))

    def emissions(self, f: np.ndarray) -> np.ndarray:
        return self.w[f].sum(axis=1)

    def fit(self, seqs: list[tuple[np.ndarray, np.ndarray]], steps: int = STEPS, rate: float = 0.3, ridge: float = 0.3) -> None:
        """Adagrad on the log-likelihood of all sequences at once, padded to one length."""
        n, length = len(seqs), max(len(y) for _, y in seqs)
        f, y, mask = np.zeros((n, length, len(_SIZES)), dtype=np.int64), np.full((n, length), 2), np.zeros((n, length), dtype=bool)
        for i, (a, b) in enumerate(seqs):
            f[i, : len(b)], y[i, : len(b)], mask[i, : len(b)] = a, b, True
        gw, gt = np.full_like(self.w, 1e-8), np.full_like(self.t, 1e-8)
        flat = f[mask]
        for _ in range(steps):
            e = self.emissions(f.reshape(-1, len(_SIZES))).reshape(n, length, 3)
            alpha, beta = np.zeros((n, length, 3)), np.zeros((n, length, 3))
            alpha[:, 0] = e[:, 0]
            for k in range(1, length):
                alpha[:, k] = np.where(mask[:, k, None], np.logaddexp.reduce(alpha[:, k - 1, :, None] + self.t, axis=1) + e[:, k], alpha[:, k - 1])
            for k in range(length - 2, -1, -1):
                beta[:, k] = np.where(mask[:, k + 1, None], np.logaddexp.reduce(self.t + (e[:, k + 1] + beta[:, k + 1])[:, None, :], axis=2), beta[:, k + 1])
            z = np.logaddexp.reduce(alpha[:, -1], axis=1)
            p = np.exp(alpha + beta - z[:, None, None])
            diff = np.eye(3)[y] - p
            dw = np.stack([np.bincount(flat.ravel(), np.repeat(diff[mask][:, c], len(_SIZES)), minlength=len(self.w)) for c in range(3)], axis=1) - ridge * self.w
            both = mask[:, 1:]
            pair = np.exp(alpha[:, :-1, :, None] + self.t + (e[:, 1:] + beta[:, 1:])[:, :, None, :] - z[:, None, None, None])
            seen = np.zeros((3, 3))
            np.add.at(seen, (y[:, :-1][both], y[:, 1:][both]), 1)
            dt = seen - pair[both].sum(axis=0) - ridge * self.t
            gw += dw**2
            gt += dt**2
            self.w += rate * dw / np.sqrt(gw)
            self.t += rate * dt / np.sqrt(gt)

    def decode(self, e: np.ndarray, row: np.ndarray) -> np.ndarray:
        """The best tags of all tokens of a piece; ``row`` tells texts apart."""
        tags = np.full(len(e), 2, dtype=np.int8)
        # what a path could win by a transition, if a token were B or I in place of O
        gain = [max(self.t[a, x] + self.t[x, b] - self.t[a, 2] - self.t[2, b] for a in range(3) for b in range(3)) for x in (0, 1)]
        edge = [max(0.0, max(self.t[a, x] - self.t[a, 2] for a in range(3)), max(self.t[x, b] - self.t[2, b] for b in range(3))) for x in (0, 1)]
        open_ = np.flatnonzero((e[:, 2] - e[:, 0] <= max(gain[0], edge[0])) | (e[:, 2] - e[:, 1] <= max(gain[1], edge[1])))
        if not len(open_):
            return tags
        cut = np.flatnonzero((np.diff(open_) > 1) | (np.diff(row[open_]) > 0)) + 1
        for part in np.split(open_, cut):
            a, b = part[0], part[-1]
            left = a > 0 and row[a - 1] == row[a]
            right = b + 1 < len(e) and row[b + 1] == row[b]
            score, back = e[a] + (self.t[2] if left else 0), []
            for k in range(a + 1, b + 1):
                step = score[:, None] + self.t
                back.append(step.argmax(axis=0))
                score = step.max(axis=0) + e[k]
            tag = int((score + (self.t[:, 2] if right else 0)).argmax())
            tags[b] = tag
            for k in range(b - 1, a - 1, -1):
                tag = int(back[k - a][tag])
                tags[k] = tag
        return tags


def _tagged(piece: Piece, i: int, spans: list[tuple[int, int]]) -> np.ndarray:
    """The tags of a text's tokens by spans in code points."""
    a, b = piece.word_at[i], piece.word_at[i + 1]
    data = piece.data[piece.text_at[i] : piece.text_at[i + 1]]
    lo, hi = (char_at(data, x[a:b] - piece.text_at[i]) for x in (piece.start, piece.end))
    y = np.full(b - a, 2)
    for s, t in spans:
        inside = np.flatnonzero((lo >= s) & (hi <= t))
        y[inside] = 1
        y[inside[:1]] = 0
    return y


def _values(text: str) -> list[tuple[int, int]]:
    """The base spans, of assignments what is assigned."""
    own = [m.span(2) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    return own + [(s, t) for kind, s, t in base_spans(text) if kind != "assign"]


def _crops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(features, tags) of crops of tokens, of each text around some of its secrets and around some other tokens."""
    for batch in batches:
        for piece in pieces(batch.column(0), _TOKEN):
            f, out = features(piece), []
            for i in range(piece.rows):
                a, b = piece.word_at[i], piece.word_at[i + 1]
                y = _tagged(piece, i, _values(piece.data[piece.text_at[i] : piece.text_at[i + 1]].tobytes().decode()))
                order = np.argsort(mix64(np.arange(len(y), dtype=np.uint64) + np.uint64(SEED)), kind="stable")
                own = order[y[order] == 0][: CROPS // 2]
                for k in [*own.tolist(), *order[: CROPS - len(own)].tolist()]:
                    c = slice(max(0, k - CROP), k + CROP)
                    out.append((f[a:b][c].ravel(), y[c]))
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], type=pa.list_(pa.int64())), pa.array([y for _, y in out], type=pa.list_(pa.int64()))], names=["f", "y"])


def examples(n: int = EXAMPLES, seed: int = SEED, beginnings: tuple[str, ...] = BEGINNINGS) -> list[tuple[str, list[tuple[int, int]]]]:
    """Texts with secrets of kinds that base patterns don't know, and with what only looks like some; spans in code points."""
    rng = np.random.default_rng(seed)
    letters, upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", "0123456789ABCDEF"
    num = lambda a, b: int(rng.integers(a, b))
    pick = lambda of: of[num(0, len(of))]
    some = lambda of, a, b: "".join(of[k] for k in rng.integers(len(of), size=num(a, b)))
    made = lambda: some("abcdefghilmnoprstu", 3, 13)

    def mixed(low: int, high: int) -> str:
        """Random characters with a digit and both cases at least."""
        at = num(3, low - 2)
        body = some(letters, low, high)
        return body[:at] + some("0123456789", 1, 2) + some("abcdefgh", 1, 2) + some("KLMNPQ", 1, 2) + body[at:]

    def secret(k: int) -> tuple[str, str]:
        """What stands before a secret, and the secret."""
        return (
            ("", beginnings[k % len(beginnings)] + mixed(18, 40)),
            (pick(("Authorization: Bearer ", "authorization bearer ", "Bearer ")), mixed(24, 60)),
            (f"{pick(NAMES)} is ", mixed(8, 20)),
            (f"{pick(('pwd', 'pin', 'key', 'credential', 'passphrase', 'senha', 'passwort'))}{pick((': ', '=', ' = ', '=\"'))}", mixed(8, 24)),
            (f"{pick(('postgres', 'mysql', 'amqp', 'https'))}://{made()}:", mixed(8, 24)),
            (pick(("", "key ", "sha ")), some(upper, 32, 65)),
            (pick(("private_key ", "", "BEGIN ")), mixed(40, 80) + "/" + mixed(10, 30)),
        )[k % 7]

    def other(k: int) -> str:
        return (
            f"{made()}.{num(1, 99)}@mail{num(1, 9)}.{made()}.com",
            ".".join(str(num(0, 256)) for _ in range(4)),
            f"+{num(1, 99)} ({num(100, 999)}) 555-{num(1000, 9999)}",
            str(num(10**14, 10**16)),
            f"20{num(10, 30)}-0{num(1, 9)}-{num(10, 28)}T{num(10, 23)}.{num(10, 59)}",
            f"https://www.{made()}.org/{made()}/{made()}.html",
            f"/usr/{made()}/{made()}_{num(1, 99)}.txt",
            made().upper() + made().upper(),
            made().capitalize() + made().capitalize() + made(),
            f"v{num(0, 9)}.{num(0, 20)}.{num(0, 99)}-beta",
            made() + made() + "-" + made() + "-" + made(),
            f"{num(1, 999)},{num(100, 999)}.{num(10, 99)}",
            f"ISBN 978-{num(0, 9)}-{num(1000, 9999)}-{num(1000, 9999)}-{num(0, 9)}",
            f"{pick(NAMES)} {pick(PROSE)} {made()}",
        )[k % 14]

    out = []
    for k in range(n):
        text, spans = "", []
        for part in range(num(2, 6)):
            text += " ".join(pick(PROSE) if rng.random() < 0.5 else made() for _ in range(num(3, 10))) + " "
            if part and rng.random() < 0.5:
                lead, value = secret(num(0, 7 * len(beginnings)))
                text += lead
                spans.append((len(text), len(text) + len(value)))
                text += value + ("@" + made() + ".net" if "://" in lead else pick(("", "", ".", '"', ",", "###")))
            else:
                text += other(num(0, 14)) + pick(("", "", ".", "!!", ","))
            text += pick((" ", " ", "\n"))
        out.append((text, spans))
    return out


def _example_crops() -> list[tuple[np.ndarray, np.ndarray]]:
    made = examples()
    out = []
    for piece in pieces(pa.array([t for t, _ in made], type=pa.large_string()), _TOKEN):
        f = features(piece)
        out += [(f[piece.word_at[i] : piece.word_at[i + 1]], _tagged(piece, i, made[piece.first_row + i][1])) for i in range(piece.rows)]
    return out


def fit(docs: DataFrame, rows: int = TRAIN_DOCS) -> Field:
    """Learns from crops of a bounded sample, half of it with what base patterns look for, and from examples."""
    hints = r"(?i)(passw|secret|token|api_?key)|AKIA|[0-9a-f]{24}"
    marked = docs.filter("text is not null and doc_id is not null").select("doc_id", F.col("text").rlike(hints).alias("hint"))
    ids = F.broadcast(sampled(written(marked), "doc_id", rows // 2, "hint").select(F.col("doc_id").alias("__id")).distinct())
    texts = docs.join(ids, F.col("doc_id") == F.col("__id")).groupBy("doc_id").agg(F.max("text").alias("text")).select("text")
    found = texts.mapInArrow(_crops, "f array<long>, y array<long>").collect()
    crops = sorted(((r["f"], r["y"]) for r in found if r["y"]), key=str)
    field = Field()
    field.fit([(np.array(f).reshape(-1, len(_SIZES)), np.array(y)) for f, y in crops] + _example_crops())
    return field


def scan(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) of each document, over whole texts."""
    docs = docs.select(F.col("doc_id").try_cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(field or fit(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for piece in pieces(batch.column(1), _TOKEN):
                row = np.repeat(np.arange(piece.rows), np.diff(piece.word_at))
                tags = model.decode(model.emissions(features(piece)), row)
                tagged = np.flatnonzero(tags < 2)
                found = {}
                for i in np.union1d(base_rows(piece), np.unique(row[tagged])).tolist():
                    data = piece.data[piece.text_at[i] : piece.text_at[i + 1]]
                    base = base_spans(data.tobytes().decode())
                    mine = tagged[row[tagged] == i]
                    runs = np.split(mine, np.flatnonzero((np.diff(mine) > 1) | (tags[mine[1:]] == 0)) + 1) if len(mine) else []
                    own = [tuple(char_at(data, np.array([piece.start[r[0]], piece.end[r[-1]]]) - piece.text_at[i]).tolist()) for r in runs]
                    found[i] = base, [("model", a, b) for a, b in apart_from(own, base)]
                yield from span_batches(batch.column(0).slice(piece.first_row, piece.rows), KINDS, found, piece.rows)

    return docs.mapInArrow(run, span_schema(BASE))


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's secrets."""
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
