"""URL filtering with a bit-parallel wildcard automaton.

Every glob rule becomes a row of states, one per consumed byte of the rule; the states of all
rules lie side by side in 64-bit words. One step of Shift-And moves all rules of a URL at once,
and numpy takes the step for all URLs of a batch together.

Globs match a whole canonical URL, its host and path: `*` stands for bytes other than `/`,
`**` for any bytes, `?` for one byte other than `/`; other bytes stand for themselves.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SLASH = ord("/")
#: Cells of the byte matrix held at once.
CELLS = 1 << 22


@dataclass(frozen=True)
class HostRule:
    """A host, its subdomains, and paths that begin with `path`."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def globs(self) -> list[str]:
        return [f"{self.name}**", f"*.{self.name}**"]


# Patterns of addresses that hold no documents; they decide where no host rule fits.
DEFAULT_BLOCKED = (
    "ads.*/**", "*.ads.*/**", "adserver.**", "*.adserver.**", "tracker.**", "*.tracker.**",
    "**/ads/**", "**/adserver/**", "**/wp-login.php", "**/cgi-bin/**", "**/signin/**", "**/cart/**", "**/checkout/**",
    "**.jpg", "**.jpeg", "**.png", "**.gif", "**.mp4", "**.mp3", "**.zip", "**.exe", "**.iso",
)


class WildcardAutomaton:
    """All globs in one set of bit masks."""

    def __init__(self, globs: Sequence[str]):
        tokens = [self._tokens(g) for g in globs]
        sizes = np.array([sum(t not in ("*", "**") for t in ts) + 1 for ts in tokens], np.int64)
        self.first = np.cumsum(sizes) - sizes
        self.last = self.first + sizes - 1
        states = int(sizes.sum())
        words = max(1, -(-states // 64))
        enter, stay = np.zeros((256, words * 64), bool), np.zeros((256, words * 64), bool)
        slash = np.arange(256) == _SLASH
        for begin, ts in zip(self.first, tokens, strict=True):
            state = begin
            for t in ts:
                if t in ("*", "**"):
                    stay[:, state] |= ~slash if t == "*" else True
                else:
                    state += 1
                    if t == "?":
                        enter[:, state] = ~slash
                    else:
                        enter[t, state] = True
        pack = lambda bits: np.packbits(bits, axis=-1, bitorder="little").view(np.uint64)
        self.enter, self.stay = pack(enter), pack(stay)
        begin = np.zeros(words * 64, bool)
        begin[self.first] = True
        self.begin = pack(begin)

    @staticmethod
    def _tokens(glob: str) -> list[int | str]:
        out: list[int | str] = []
        raw, k = glob.encode("utf-8"), 0
        while k < len(raw):
            if raw[k : k + 2] == b"**":
                out.append("**")
                k += 2
            else:
                out.append({ord("*"): "*", ord("?"): "?"}.get(raw[k], raw[k]))
                k += 1
        return out

    def _step(self, state: np.ndarray, byte: np.ndarray) -> np.ndarray:
        moved = state << np.uint64(1)
        moved[:, 1:] |= state[:, :-1] >> np.uint64(63)
        return (moved & self.enter[byte]) | (state & self.stay[byte])

    def match(self, texts: Sequence[str]) -> np.ndarray:
        """Which rows (texts) match which columns (globs)."""
        raw = [t.encode("utf-8") for t in texts]
        order = sorted(range(len(raw)), key=lambda k: -len(raw[k]))
        state = np.repeat(self.begin[None, :], len(raw), axis=0)
        at = 0
        while at < len(order):
            # Longest first, so that those still running are always the first rows.
            rows = max(1, CELLS // max(1, len(raw[order[at]])))
            some = order[at : at + rows]
            lengths = np.array([len(raw[k]) for k in some])
            flat = np.frombuffer(b"".join(raw[k] for k in some), np.uint8)
            begins = np.cumsum(lengths) - lengths
            here = np.repeat(self.begin[None, :], len(some), axis=0)
            for t in range(int(lengths.max(initial=0))):
                live = int(np.searchsorted(-lengths, -t, "left"))
                here[:live] = self._step(here[:live], flat[begins[:live] + t])
            state[some] = here
            at += rows
        word, bit = self.last // 64, (self.last % 64).astype(np.uint64)
        return ((state[:, word] >> bit) & np.uint64(1)).astype(bool)


def canonical(url: Column) -> tuple[Column, Column]:
    """(host, path): the host follows the first ://, A-Z lower-cased, up to / ? # or the end; the path goes on to ? # or the end."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    part = lambda k: F.coalesce(F.regexp_extract(url, pattern, k), F.lit(""))
    return F.translate(part(1), UPPER, LOWER), part(2)


def judge_urls(pages: DataFrame, rules: Sequence[HostRule], blocked: Sequence[str] = DEFAULT_BLOCKED) -> DataFrame:
    """page_id, host, path, rule and verdict of every page.

    The longest fitting host rule decides; between equally long ones the first given. Where none
    fits, rule is null and the verdict is block if a blocked glob matches, else allow.

    Input: page_id and url; other columns are not read. A null url, or one without ://, has an
    empty host and path and is judged as such. Null ids and repeated rows pass through; an empty
    table gives an empty result. URLs of any length are read whole. The rules are a parameter of
    the program, so the masks are small and travel with the tasks.
    """
    ordered = sorted(rules, key=lambda r: -len(r.name))
    globs = [g for r in ordered for g in r.globs()] + list(blocked)
    automaton, own = WildcardAutomaton(globs), 2 * len(ordered)

    @F.pandas_udf("rule string, verdict string")
    def verdict(urls: pd.Series) -> pd.DataFrame:
        hit = automaton.match(list(urls))
        fits = hit[:, :own].reshape(len(hit), -1, 2).any(axis=2)
        bad = hit[:, own:].any(axis=1)
        out = []
        for k in range(len(hit)):
            best = int(fits[k].argmax()) if fits.shape[1] and fits[k].any() else -1
            out.append((ordered[best].name, ordered[best].verdict) if best >= 0 else (None, "block" if bad[k] else "allow"))
        return pd.DataFrame(out, columns=["rule", "verdict"])

    host, path = canonical(F.col("url").cast("string"))
    slim = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    return slim.withColumn("v", verdict(F.concat("host", "path"))).select("page_id", "host", "path", "v.rule", "v.verdict")
