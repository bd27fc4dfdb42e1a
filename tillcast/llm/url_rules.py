"""URL filters: a bit-parallel wildcard automaton.

All rules are glob patterns over the canonical url ".host/path" and live in one bit vector of several 64-bit
words: a pattern of m characters has m + 1 states, state k meaning that its first k characters are matched. One
step for a character shifts all vectors, keeps states whose next character it is, and keeps states with a
wildcard that admits it:

    D <- ((D << 1) & NEXT[c]) | (D & LOOP[c])

so all patterns advance together over all urls of a batch, in numpy. The longest rule whose last state is
set after the whole url wins; of equally long ones the first.

A rule reads host/path. In both, `*` is any run of characters but "/", and `**` any run; `?` is one character
but "/". A rule fits its host, all subdomains, and all longer paths.

Defined results: a null url, or one without "://", has an empty host and path and fits no rule. Without a rule
the verdict is `default`. Empty tables give empty tables; repeated rows are judged each.
"""

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.llm.common import map_rows

RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
DEFAULT = "allow"
_SLASH = ord("/")


def split_url(url):
    """(host in lower case, path) of a url."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    stop = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    host, rest = rest[:stop], rest[stop:]
    stop = min((i for i in map(rest.find, "?#") if i >= 0), default=len(rest))
    return host.encode().lower().decode(), rest[:stop]


def glob_steps(rule: str):
    """[(byte or None for any but "/", loop before it)] and the loop after the last one; a loop is None,
    "segment" (any but "/") or "any"."""
    host, _, path = rule.partition("/")
    glob = f"*.{host}/{path}**"
    data, steps, loop, at = glob.encode(), [], None, 0
    while at < len(data):
        if data[at : at + 2] == b"**":
            loop, at = "any", at + 2
        elif data[at : at + 1] == b"*":
            loop, at = loop or "segment", at + 1
        else:
            steps.append((None if data[at : at + 1] == b"?" else data[at], loop))
            loop, at = None, at + 1
    return steps, loop


class Automaton:
    """Shift-And masks of a list of rules over 256 byte values."""

    def __init__(self, rules: list[str]):
        compiled = [glob_steps(rule) for rule in rules]
        bits = sum(len(steps) + 1 for steps, _ in compiled)
        self.words = bits // 64 + 1
        self.next = np.zeros((256, self.words), np.uint64)
        self.loop = np.zeros((256, self.words), np.uint64)
        self.start = np.zeros(self.words, np.uint64)
        self.accept, at = [], 0
        for steps, last in compiled:
            self._set(self.start, at)
            for byte, loop in steps:
                self._allow(self.loop, loop, at)
                at += 1
                self._allow(self.next, "segment" if byte is None else byte, at)
            self._allow(self.loop, last, at)
            self.accept.append((at >> 6, np.uint64(at & 63)))
            at += 1

    def _set(self, row, bit):
        row[..., bit >> 6] |= np.uint64(1 << (bit & 63))

    def _allow(self, masks, what, bit):
        if isinstance(what, int):
            self._set(masks[what], bit)
        elif what is not None:
            chosen = masks[np.arange(256) != _SLASH] if what == "segment" else masks
            self._set(chosen, bit)
            if what == "segment":
                masks[np.arange(256) != _SLASH] = chosen

    def run(self, texts: list[bytes]) -> np.ndarray:
        """texts x rules, whether each matches the whole text."""
        order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
        lengths = np.array([len(texts[i]) for i in order])
        data = np.frombuffer(b"".join(texts[i] for i in order), np.uint8)
        begins = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
        state = np.repeat(self.start[None, :], len(texts), axis=0)
        one, top = np.uint64(1), np.uint64(63)
        for at in range(int(lengths.max(initial=0))):
            # The longest come first, so those that still have a character are the first ones.
            alive = int(np.searchsorted(-lengths, -at, side="left"))
            now, chars = state[:alive], data[begins[:alive] + at]
            moved = now << one
            moved[:, 1:] |= now[:, :-1] >> top
            state[:alive] = (moved & self.next[chars]) | (now & self.loop[chars])
        hits = np.empty((len(texts), len(self.accept)), bool)
        for rule, (word, bit) in enumerate(self.accept):
            hits[order, rule] = (state[:, word] >> bit) & one
        return hits


def judge_urls(pages: DataFrame, rules=RULES, default: str = DEFAULT) -> DataFrame:
    """page_id, host, path, rule (null without one), verdict of every row."""
    rules = [(verdict, rule) for verdict, rule in rules]

    def make():
        # Longest first, so the first hit wins.
        ranked = sorted(rules, key=lambda r: -len(r[1]))
        automaton = Automaton([rule for _, rule in ranked])

        def judge(page_ids, urls):
            parts = [split_url(url) for url in urls]
            hits = automaton.run([f".{host}{path}".encode() for host, path in parts])
            first = np.where(hits.any(axis=1), hits.argmax(axis=1), -1) if rules else np.full(len(parts), -1)
            for page_id, (host, path), at in zip(page_ids, parts, first.tolist()):
                verdict, rule = ranked[at] if at >= 0 else (default, None)
                yield page_id, host, path, rule, verdict

        return judge

    return map_rows(
        pages.select(F.col("page_id").cast("long"), F.col("url").cast("string")), make, batched=True,
        page_id="long", host="string", path="string", rule="string", verdict="string",
    )
