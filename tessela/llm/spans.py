"""Spans of a text: (kind, start, end) in code points, end exclusive, and how results show them."""

from __future__ import annotations

import bisect
import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from tessela.llm.tokens import Piece

Span = tuple[str, int, int]


def listed(spans: list[Span], kinds: tuple[str, ...]) -> str:
    """kind:start:end by start, then by the kind's place in ``kinds``, joined by commas."""
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (s[1], kinds.index(s[0]), s[2])))


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def apart_from(spans: list[tuple[int, int]], taken: list[Span]) -> list[tuple[int, int]]:
    """The spans, in order, that overlap none of ``taken``."""
    held = sorted((c, d) for _, c, d in taken)
    starts = [c for c, _ in held]
    reach = list(itertools.accumulate((d for _, d in held), max))  # the farthest end of those up to one
    return [(a, b) for a, b in spans if not (k := bisect.bisect_left(starts, b)) or reach[k - 1] <= a]


def rows_of(piece: Piece, at: np.ndarray) -> np.ndarray:
    """The texts of a piece that hold the byte positions ``at``, each once."""
    return np.unique(np.searchsorted(piece.text_at, at, side="right") - 1)


def places(data: bytes, needle: bytes) -> list[int]:
    out, at = [], data.find(needle)
    while at >= 0:
        out.append(at)
        at = data.find(needle, at + 1)
    return out


def span_batches(ids: pa.Array, kinds: tuple[str, ...], found: dict[int, tuple[list[Span], list[Span]]], n: int) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, counts by base kind, base spans, all spans). ``found``: a row's base and added spans."""
    base_kinds = kinds[:-1]
    counts = np.zeros((len(base_kinds), n), dtype=np.int64)
    base, both = [""] * n, [""] * n
    for row, (own, added) in found.items():
        for k, _, _ in own:
            counts[base_kinds.index(k), row] += 1
        base[row], both[row] = listed(own, kinds), listed(own + added, kinds)
    digest: dict[str, str] = {}
    shas = [digest.setdefault(x, "") or digest.__setitem__(x, sha256(x)) or digest[x] for x in base]
    yield pa.RecordBatch.from_arrays([ids, *(pa.array(c) for c in counts), pa.array(shas, type=pa.string()), pa.array(both, type=pa.string())], names=["doc_id", *(f"n_{k}" for k in base_kinds), "base_sha256", "spans"])


def span_schema(base_kinds: tuple[str, ...]) -> str:
    return "doc_id long, " + "".join(f"n_{k} long, " for k in base_kinds) + "base_sha256 string, spans string"
