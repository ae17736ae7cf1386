"""URL filter: all glob rules at once in a bit-parallel wildcard automaton.

Every rule is a glob over the canonical URL ``.<host><path>``. Its literal
bytes become consecutive states of one long bit string; the rules are packed
one after another into 64-bit words, so a rule may span words. For each byte
of a URL the whole set advances with the Shift-And step

    state = ((state << 1 | start) & accepts[byte]) | (state & loops[byte])

where the shift carries across words and ``loops`` holds the states a wildcard
keeps alive: ``*`` stays within the host (any byte but ``/``), ``**`` takes any
byte. A rule has matched when its last state is ever set, so a rule is a prefix
match unless its glob says more. Many URLs advance together, one numpy row each.

Defined results: a null URL, or one without ``://``, has an empty host and
path, fits no rule and gets the default verdict; an empty path fits no rule
(each rule's path begins with ``/``); the longest fitting rule (characters of
host and path) wins, on a tie block before allow, then the smaller rule text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentinela.llm.base import map_batches

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SLASH = 0x2F


@dataclass(frozen=True)
class Rule:
    """``host`` and ``path`` as in ``example.net`` and ``/en/``; ``*`` in the host is a wildcard
    within the host, ``*`` in the path takes any bytes. The host also fits all subdomains."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def text(self) -> str:
        return f"{self.host}{self.path}"

    def glob(self) -> list[int]:
        """Bytes of the glob; 256 is the wildcard within the host, 257 the one for any byte."""
        def side(text: str, star: int) -> list[int]:
            out: list[int] = []
            for byte in text.encode():
                out.append(star if byte == 0x2A else byte)
            return out
        return [256, *side("." + self.host, 256), *side(self.path, 257)]


def squeeze(glob: list[int]) -> list[int]:
    """Neighbouring equal wildcards count once, wildcards at the end say nothing."""
    out = [g for i, g in enumerate(glob) if g < 256 or i == 0 or glob[i - 1] != g]
    while out and out[-1] >= 256:
        out.pop()
    return out


class Automaton:
    """Shift-And masks of a rule set, packed into 64-bit words."""

    def __init__(self, globs: list[list[int]]):
        globs = [squeeze(g) for g in globs]
        n_bits = sum(sum(x < 256 for x in g) for g in globs)
        words = max(1, -(-n_bits // 64))
        accepts = np.zeros((256, words * 64), bool)
        loops = np.zeros((256, words * 64), bool)
        start = np.zeros((256, words * 64), bool)   # first states that may begin at this byte
        begin = np.zeros(words * 64, bool)          # first states of rules anchored at the URL's start
        first = np.zeros(words * 64, bool)
        last = []
        at = 0
        for g in globs:
            head = True
            wild = 0
            for symbol in g:
                if symbol >= 256:
                    wild = max(wild, symbol)
                    continue
                accepts[symbol, at] = True
                if head:
                    first[at] = True
                    begin[at] = True
                    if wild:
                        start[:, at] = True
                        if wild == 256:
                            start[SLASH, at] = False
                elif wild:
                    loops[:, at - 1] = True
                    if wild == 256:
                        loops[SLASH, at - 1] = False
                head, wild = False, 0
                at += 1
            last.append(at - 1)
        self.n_words = words
        self.accepts, self.loops, self.start = (self._pack(m) for m in (accepts, loops, start))
        self.begin = self._pack(begin[None])[0]
        self.first = self._pack(first[None])[0]
        self.last = np.array(last, np.int64)
        done = np.zeros(words * 64, bool)
        done[self.last[self.last >= 0]] = True
        self.done = self._pack(done[None])[0]

    @staticmethod
    def _pack(bits: np.ndarray) -> np.ndarray:
        return np.packbits(bits, axis=1, bitorder="little").view(np.uint64)

    def matches(self, urls: list[bytes]) -> np.ndarray:
        """Boolean matrix: URL by rule."""
        n = len(urls)
        lengths = np.array([len(u) for u in urls], np.int64)
        order = np.argsort(-lengths, kind="stable")
        ends = np.cumsum(lengths[order])
        data = np.frombuffer(b"".join(urls[i] for i in order) + b"\0", np.uint8)
        offsets = ends - lengths[order]
        state = np.zeros((n, self.n_words), np.uint64)
        found = np.zeros((n, self.n_words), np.uint64)
        may_start = np.tile(self.begin, (n, 1))     # a leading wildcard is alive until its class breaks
        one, top = np.uint64(1), np.uint64(63)
        live = n
        for step in range(int(lengths.max(initial=0))):
            while live and lengths[order[live - 1]] <= step:
                live -= 1
            byte = data[offsets[:live] + step]
            s, m = state[:live], may_start[:live]
            shifted = s << one
            if self.n_words > 1:
                shifted[:, 1:] |= s[:, :-1] >> top
            # A rule's first state is entered only by its own start, not by its neighbour's last state.
            shifted &= ~self.first
            shifted |= m
            state[:live] = (shifted & self.accepts[byte]) | (s & self.loops[byte])
            found[:live] |= state[:live] & self.done
            m &= self.start[byte]
        out = np.zeros((n, len(self.last)), bool)
        bits = np.unpackbits(found.view(np.uint8), axis=1, bitorder="little")
        out[order] = bits[:, self.last].astype(bool) if len(self.last) else False
        return out


def with_host_path(df: DataFrame, url_col: str, host: str = "host", path: str = "path") -> DataFrame:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://`` or on null."""
    at = F.coalesce(F.instr(F.col(url_col), "://"), F.lit(0))
    rest = F.when(at > 0, F.col(url_col).substr(at + 3, F.length(url_col))).otherwise(F.lit(""))
    head = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    return df.withColumns({host: head, path: F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)})


def judge(df: DataFrame, rules: list[Rule], fallback: list[Rule] | None = None, id_col: str = "page_id",
          url_col: str = "url", default: str = "allow") -> DataFrame:
    """Verdict of the longest fitting rule for every row.

    Returns ``id_col``, host, path, rule (``host/path`` text or null), verdict.
    ``fallback`` rules decide, unnamed, only where none of ``rules`` fits. All
    rules run in one automaton; the set is a parameter and travels with the task.
    """
    ranked = [r for part in (rules, fallback or [])
              for r in sorted(part, key=lambda r: (-len(r.text), r.verdict != "block", r.text))]
    globs = [r.glob() for r in ranked]
    texts = [r.text if i < len(rules) else None for i, r in enumerate(ranked)]
    verdicts = [r.verdict for r in ranked]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(globs)
        for batch in batches:
            hosts, paths = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            hit = automaton.matches([f".{h}{p}".encode() for h, p in zip(hosts, paths)])
            best = np.where(hit.any(axis=1), hit.argmax(axis=1), -1) if globs else np.full(len(hosts), -1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2),
                 pa.array([texts[i] if i >= 0 else None for i in best], pa.string()),
                 pa.array([verdicts[i] if i >= 0 else default for i in best], pa.string())],
                names=["id", "host", "path", "rule", "verdict"])

    split = with_host_path(df.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url")), "url")
    kind = dict(df.dtypes)[id_col]
    out = map_batches(split.select("id", "host", "path"), run,
                      f"id {kind}, host string, path string, rule string, verdict string")
    return out.withColumnRenamed("id", id_col)
