"""Text expressions built only from Spark's JVM functions.

Python's ``str.split()`` splits on Unicode whitespace and drops empty pieces;
``tok`` reproduces that with ``(?U)\\s+`` and an empty-token filter (Spark's
``split('')`` yields one empty token).
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's str.split() whitespace: Unicode White_Space plus the \x1c-\x1f
# separators (which Java's (?U)\s leaves out).  A (?U) class keeps Java's
# fast path; an explicit code-point list measured about 2x slower.
WS = r"(?U)[\s\x1c-\x1f]+"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def words(c) -> Column:
    """Whitespace tokens, case kept (Python ``s.split()``)."""
    return F.filter(F.split(_col(c), WS), lambda x: x != F.lit(""))


def tok(c) -> Column:
    """Lower-cased whitespace tokens (``s.lower().split()``)."""
    return words(F.lower(_col(c)))


def word_count(c) -> Column:
    """``len(s.split())``; null input counts as the empty string."""
    return F.size(words(F.coalesce(_col(c), F.lit(""))))


def strip_py(c) -> Column:
    """Python ``str.strip()``: removes Unicode whitespace at both ends."""
    return F.regexp_replace(_col(c), "^" + WS + "|" + WS + "$", "")


def norm_collapse(c) -> Column:
    """Whitespace runs collapsed to one space, trimmed, lower-cased."""
    return F.lower(F.btrim(F.regexp_replace(_col(c), WS, " ")))


def norm_strip(c) -> Column:
    """Trim + lower only; inner whitespace kept."""
    return F.lower(strip_py(c))


def render_template(template: str, fields: Mapping[str, Column | str]) -> Column:
    """Python ``template.format(**row)`` as one ``concat`` (B1).

    The template is parsed once on the driver into literal and field pieces,
    so text inserted from a field is never expanded again; ``{{``/``}}`` become
    literal braces.  Null fields render as the empty string.
    """
    pieces: list[Column] = []
    pos = 0
    pattern = re.compile(r"\{\{|\}\}|\{([A-Za-z_][A-Za-z0-9_]*)\}")
    for m in pattern.finditer(template):
        if m.start() > pos:
            pieces.append(F.lit(template[pos:m.start()]))
        tokn = m.group(0)
        if tokn == "{{":
            pieces.append(F.lit("{"))
        elif tokn == "}}":
            pieces.append(F.lit("}"))
        else:
            name = m.group(1)
            if name not in fields:
                raise KeyError(f"template field {name!r} has no column")
            pieces.append(F.coalesce(_col(fields[name]).cast("string"), F.lit("")))
        pos = m.end()
    if pos < len(template):
        pieces.append(F.lit(template[pos:]))
    return F.concat(*pieces) if pieces else F.lit("")


def messages(*pairs: tuple[str, Column | str]) -> Column:
    """Role/content message array (B2): ``[(role, content), ...]``."""
    return F.array(*[
        F.struct(F.lit(role).alias("role"), _col(content).cast("string").alias("content"))
        for role, content in pairs
    ])


def short_key(c, n: int = 50) -> Column:
    """First ``n`` characters (Python ``s[:n]``), B7."""
    return F.substring(F.coalesce(_col(c), F.lit("")), 1, n)


class WordIds(dict):
    """Whitespace word -> ids of its tokens, each word cut once: ``cut`` gives a word's tokens.

    Equal tokens have equal ids; ``texts`` starts anew when the vocabulary is above ``limit`` words."""

    def __init__(self, cut, limit: int = 1 << 18):
        super().__init__()
        self.cut, self.limit, self.ids = cut, limit, {}

    def __missing__(self, word: str) -> list[int]:
        got = self[word] = [self.ids.setdefault(t, len(self.ids)) for t in self.cut(word)]
        return got

    def texts(self, *columns: list) -> list[list[list[int]]]:
        """The token ids of every text of each column, in one numbering (null: none)."""
        if len(self) > self.limit:
            self.clear()
            self.ids = {}
        known: dict = {}  # rows side by side share a text

        def ids(text):
            got = known.get(text)
            if got is None:
                got = known[text] = [i for w in text.split() for i in self[w]]
            return got
        return [[[] if t is None else ids(t) for t in c] for c in columns]


def text_runs(*columns: list, limit: int = 1 << 20):
    """(start, end) of runs of rows whose texts hold about ``limit`` characters in all (one row at least)."""
    start, size = 0, 0
    for i, row in enumerate(zip(*columns)):
        size += sum(len(t) for t in row if t is not None)
        if size >= limit:
            yield start, i + 1
            start, size = i + 1, 0
    if columns and start < len(columns[0]):
        yield start, len(columns[0])
