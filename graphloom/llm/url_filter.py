"""URL filter: all glob rules as one bit-parallel automaton (Shift-And over several machine words).

A rule's glob is laid out as consecutive states; ``*`` keeps a state alive on any character but ``/``, ``**`` on any
character. One step of the automaton moves the states of every rule and every URL of a batch at once:
``D = ((D << 1) & B[c]) | (D & S[c])`` with carries between the 64-bit words. Cost per character depends on the number
of words of all the rules together, not on which rules match.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.llm.common import ascii_lower


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str = ""

    @property
    def label(self) -> str:
        return self.host + self.path

    @property
    def globs(self) -> list[str]:
        """The host and all its subdomains; the path by its beginning."""
        at = f"*.{self.host}"
        return [f"{at}{self.path}**"] if self.path else [at, f"{at}/**"]


class GlobAutomaton:
    """Simulates all globs at once. A text matches a glob as a whole."""

    def __init__(self, globs: list[str]):
        states: list[str | None] = []  # the character that leads into a state; None for a first state
        loops: list[int] = []  # 0 no loop, 1 on all but "/", 2 on all
        self.finals: list[int] = []
        for g in globs:
            states.append(None)
            loops.append(0)
            i = 0
            while i < len(g):
                if g[i] == "*":
                    wide = g[i : i + 2] == "**"
                    loops[-1] = max(loops[-1], 1 + wide)
                    i += 1 + wide
                else:
                    states.append(g[i])
                    loops.append(0)
                    i += 1
            self.finals.append(len(states) - 1)
        self.words = max(1, -(-len(states) // 64))
        self.alphabet = np.array(sorted({ord(c) for c in states if c} | {ord("/")}), np.uint32)
        self.step = np.zeros((len(self.alphabet) + 1, self.words), np.uint64)
        self.stay = np.zeros_like(self.step)
        self.first = np.zeros(self.words, np.uint64)
        slash = int(np.searchsorted(self.alphabet, ord("/")))
        for s, (c, loop) in enumerate(zip(states, loops, strict=True)):
            w, bit = s // 64, np.uint64(1 << (s % 64))
            if c is None:
                self.first[w] |= bit
            else:
                self.step[np.searchsorted(self.alphabet, ord(c)), w] |= bit
            if loop:
                self.stay[:, w] |= bit
                if loop == 1:
                    self.stay[slash, w] &= ~bit

    def match(self, texts: list[str]) -> np.ndarray:
        """Booleans: texts by globs."""
        lens = np.array([len(t) for t in texts], np.int64)
        codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        at = np.minimum(np.searchsorted(self.alphabet, codes), len(self.alphabet) - 1)
        symbols = np.where(self.alphabet[at] == codes, at, len(self.alphabet))
        order = np.argsort(-lens, kind="stable")
        begin, longest_first = (np.cumsum(lens) - lens)[order], lens[order]
        alive = np.tile(self.first, (len(texts), 1))
        n = len(texts)
        for j in range(int(lens.max(initial=0))):
            while longest_first[n - 1] <= j:
                n -= 1
            d, c = alive[:n], symbols[begin[:n] + j]
            moved = d << np.uint64(1)
            moved[:, 1:] |= d[:, :-1] >> np.uint64(63)
            alive[:n] = (moved & self.step[c]) | (d & self.stay[c])
        out = np.zeros((len(texts), len(self.finals)), bool)
        for k, s in enumerate(self.finals):
            out[order, k] = (alive[:, s // 64] >> np.uint64(s % 64)) & np.uint64(1) == 1
        return out


def filter_urls(pages: DataFrame, rules: list[Rule], default: str = "allow", url: str = "url") -> DataFrame:
    """Adds host, path, rule and verdict to every row of ``pages``; columns of these names are replaced.

    Nulls and urls without ``://`` have an empty host and path, fit no rule and get ``default``. Of the rules that fit, the one
    with the longest host and path wins, the first listed among equals. Repeated rows each get the same answer. No shuffle.
    """
    ranked = sorted(rules, key=lambda r: -len(r.label))
    owner = np.array([k for k, r in enumerate(ranked) for _ in r.globs])
    automaton = GlobAutomaton([g for r in ranked for g in r.globs])

    @F.pandas_udf("int")
    def fitting(canonical: pd.Series) -> pd.Series:
        hit = automaton.match(canonical.tolist())
        return pd.Series(np.where(hit.any(axis=1), owner[hit.argmax(axis=1)], -1) if hit.size else np.full(len(canonical), -1))

    u = F.col(url)
    after = F.when(F.instr(u, "://") > 0, F.expr(f"substring(`{url}`, instr(`{url}`, '://') + 3)")).otherwise(F.lit(""))
    host = ascii_lower(F.regexp_extract(after, r"^[^/?#]*", 0))
    path = F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)
    out = pages.withColumns({"host": F.coalesce(host, F.lit("")), "path": F.coalesce(path, F.lit(""))})
    out = out.withColumn("__rule", fitting(F.concat(F.lit("."), "host", "path")))
    pick = lambda values: F.element_at(F.array(*map(F.lit, values)), F.col("__rule") + 1)
    if not ranked:
        return out.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)}).drop("__rule")
    return out.withColumns(
        {
            "rule": F.when(F.col("__rule") >= 0, pick([r.label for r in ranked])),
            "verdict": F.when(F.col("__rule") >= 0, pick([r.verdict for r in ranked])).otherwise(F.lit(default)),
        }
    ).drop("__rule")
