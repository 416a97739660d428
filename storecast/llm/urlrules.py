"""Allow and block rules over URLs: all rules as globs in one bit-parallel automaton.

A rule's host and path become the glob `*.host/path**` over the canonical URL `.host/path`; `*` stops at a slash, `**`
does not. Each glob character is one bit. A Shift-And step moves every bit whose character matches, and the bits of
wildcards stay; all rules of all URLs of a batch advance together, 64 bits to a word.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storecast.llm.frames import flat_bytes, mapped

DEFAULT_VERDICT = "allow"
#: URL rows that advance together.
ROWS = 4096


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    @property
    def glob(self) -> str:
        return f"*.{self.host}{self.path}**"


# The rules of the query.
RULES = (
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
)


class Automaton:
    """Masks of several globs, packed into words."""

    def __init__(self, globs: list[str]):
        slots: list[tuple[bytes | None, bool]] = []  # (literal byte or None, stays on slash too)
        first, self.final = [], []
        for glob in globs:
            first.append(len(slots))
            raw, at = glob.encode(), 0
            # A slot is a state: how much of the glob has been matched. Wildcards are loops on their state.
            slots.append((None, False))
            while at < len(raw):
                if raw[at : at + 2] == b"**":
                    slots[-1] = (slots[-1][0], "any")
                    at += 2
                elif raw[at : at + 1] == b"*":
                    slots[-1] = (slots[-1][0], "host")
                    at += 1
                else:
                    slots.append((raw[at : at + 1], False))
                    at += 1
            self.final.append(len(slots) - 1)
        self.words = len(slots) // 64 + 1
        self.start = self._pack(first)
        self.step = np.stack([self._pack([i for i, (b, _) in enumerate(slots) if b == bytes([c])]) for c in range(256)])
        loops = [self._pack([i for i, (_, w) in enumerate(slots) if w == "any" or w == "host" and c != 47]) for c in range(256)]
        self.loop = np.stack(loops)

    def _pack(self, bits: list[int]) -> np.ndarray:
        out = [0] * self.words
        for b in bits:
            out[b // 64] |= 1 << b % 64
        return np.array(out, np.uint64)

    def matches(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """rows x globs: whether the glob matches the whole row. Rows are laid end to end in `data`."""
        sizes = np.diff(starts)
        order = np.argsort(-sizes, kind="stable")  # long ones first: those still running are a prefix
        state = np.tile(self.start, (len(sizes), 1))
        at, sizes = starts[:-1][order], sizes[order]
        for k in range(int(sizes[0]) if len(sizes) else 0):
            n = int(np.searchsorted(-sizes, -k, "left"))  # rows with more than k bytes
            byte, now = data[at[:n] + k], state[:n]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            state[:n] = (moved & self.step[byte]) | (now & self.loop[byte])
        out = np.empty((len(sizes), len(self.final)), bool)
        for g, bit in enumerate(self.final):
            out[order, g] = state[:, bit // 64] >> np.uint64(bit % 64) & np.uint64(1)
        return out


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; empty for null and without `://`."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host, up to `?`, `#` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def judged(pages: DataFrame, rules: tuple[Rule, ...] = RULES, default: str = DEFAULT_VERDICT) -> DataFrame:
    """page_id, host, path, rule, verdict for each row of `pages` (page_id, url).

    A rule fits its host and all subdomains if the path starts with the rule's. The longest rule (host and path) wins,
    the first of equals. Without a fitting rule, rule is null and verdict is `default`. Null and odd URLs have empty
    host and path, which no rule fits. Repeated rows are judged alike. Other columns are ignored.
    """
    ranked = sorted(rules, key=lambda r: -len(r.name))
    if any(not r.host or set(r.host + r.path) & {"*"} for r in ranked):
        raise ValueError("rules need a host, and no wildcard of their own")
    automaton = Automaton([r.glob for r in ranked])
    names = pa.array([r.name for r in ranked] + [None], pa.string())
    verdicts = pa.array([r.verdict for r in ranked] + [default], pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                fits = automaton.matches(*flat_bytes(batch.column(3)))
                best = pa.array(np.where(fits.any(axis=1), fits.argmax(axis=1), len(ranked)))
                yield pa.record_batch(
                    [*batch.columns[:3], names.take(best), verdicts.take(best)],
                    names=["page_id", "host", "path", "rule", "verdict"],
                )

    url = F.col("url")
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    rows = rows.withColumn("canonical", F.concat(F.lit("."), "host", "path"))
    return mapped(rows, run, "page_id bigint, host string, path string, rule string, verdict string")
