"""One consistent form for text that looks the same (problem 1).

Method
------
1. Pairs of equal-looking strings and code points come from the Unicode character data (compatibility forms, canonical
   decompositions, blanks, hyphens, invisible characters) and from a fixed table of look-alike letters.
2. Union-find joins the pairs into transitive classes over strings and code points.
3. Of each class, the member that is most frequent in the whole corpus becomes the representative. Only members that are
   themselves plain can be chosen (stable under NFKC and visible), so a corpus made of full-width text does not elect
   full-width letters; the empty string stands for invisible characters. Ties go to the lowest code points.
4. A multi-pattern automaton over all other members rewrites a text greedily, longest match at the leftmost position
   first, until nothing changes (removing an invisible character can bring a letter and its accent together).

Letters of another script are rewritten by context, for they also stand for themselves: inside a word with Latin letters
always; as a word of their own if each letter of it has a Latin look-alike and the text has no word that is certainly of
that script. Single small Greek letters that are common symbols are left alone outside Latin words.
"""

from __future__ import annotations

import re
import sys
import unicodedata as ud
from collections.abc import Iterable, Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Letters of other scripts and the Latin letters they cannot be told from.
LOOKALIKE_LETTERS = {
    # Cyrillic
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "һ": "h",
    "ԁ": "d", "ԛ": "q", "ԝ": "w", "ӏ": "l", "ё": "ë", "ї": "ï",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y",
    "Х": "X", "І": "I", "Ј": "J", "Ѕ": "S", "Ԛ": "Q", "Ԝ": "W", "Ү": "Y", "Ё": "Ë", "Ї": "Ï",
    # Greek
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P",
    "Τ": "T", "Υ": "Y", "Χ": "X", "Ϲ": "C", "ο": "o", "ϲ": "c", "ν": "v", "ρ": "p", "ϳ": "j",
    # Armenian
    "օ": "o", "ս": "u", "հ": "h", "ո": "n", "Օ": "O", "Տ": "S",
    # Cherokee
    "Ꭺ": "A", "Ᏼ": "B", "Ꮯ": "C", "Ꭰ": "D", "Ꭼ": "E", "Ꮐ": "G", "Ꮋ": "H", "Ꭻ": "J", "Ꮶ": "K", "Ꮮ": "L", "Ꮇ": "M",
    "Ꮲ": "P", "Ꮪ": "S", "Ꭲ": "T", "Ꮩ": "V", "Ꮃ": "W", "Ꮓ": "Z",
}
# Letters that pass for a Latin one only among Latin letters; alone or in a word of their script they stand for themselves.
INSIDE_LATIN = {"к": "k", "т": "t", "м": "m", "п": "n", "ɡ": "g", "ɑ": "a", "ι": "i", "υ": "u", "χ": "x"}
# Small Greek letters that stand for themselves when no Latin letter touches them.
GREEK_SYMBOLS = "νρ"
# Hyphens that look like the plain one, and code points that show nothing but are not of category Cf.
HYPHENS = "‐‑﹣－"
UNSEEN = "͏ᅟᅠ឴឵᠋᠌᠍᠏⠀ㅤﾠ"
# The kinds of compatibility form a reader cannot tell from the plain characters.
TAGS = ("<wide>", "<narrow>", "<font>", "<noBreak>", "<compat>", "<initial>", "<medial>", "<final>", "<isolated>")
# Hangul syllables compose by arithmetic, so their classes are not listed: detached letters are composed in the text.
HANGUL = range(0xAC00, 0xD7A4)
JAMO = re.compile("[\u1100-\u1112][\u1161-\u1175][\u11a8-\u11c2]?|[\uac00-\ud7a3][\u11a8-\u11c2]")


def _mark_clusters() -> re.Pattern:
    """A character with accents in an order or company that single patterns do not cover: two marks or more, or one on a letter not of ASCII."""
    marks, start, ranges = [cp for cp in range(0x300, 0x20000) if ud.combining(chr(cp))], None, []
    for cp in marks:
        if start is None or cp != ranges[-1][1] + 1:
            ranges.append([cp, cp])
            start = cp
        else:
            ranges[-1][1] = cp
    m = "".join(f"{chr(a)}-{chr(b)}" for a, b in ranges)
    return re.compile(f"[^{m}]?[{m}]{{2,}}|[^\x00-\x7f{m}][{m}]")


CLUSTERS = _mark_clusters()
# Only a text with one of these can need composing.
PARTS = frozenset(chr(cp) for cp in range(0x300, 0x20000) if ud.combining(chr(cp)) or 0x1161 <= cp <= 0x11C2)


class UnionFind:
    """Disjoint sets with path halving; the lesser root wins, so the result does not depend on the order of unions."""

    def __init__(self) -> None:
        self.up: dict[str, str] = {}

    def find(self, x: str) -> str:
        self.up.setdefault(x, x)
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def union(self, a: str, b: str) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            lo, hi = sorted((a, b), key=lambda s: (len(s), s))
            self.up[hi] = lo


def _invisible(ch: str) -> bool:
    cp = ord(ch)
    return ud.category(ch) == "Cf" or ch in UNSEEN or 0xFE00 <= cp <= 0xFE0F or 0xE0100 <= cp <= 0xE01EF


def equal_pairs() -> Iterator[tuple[str, str]]:
    """Pairs of strings that look the same, by rule over all assigned code points, then by the letter table."""
    for cp in range(0x80, sys.maxunicode + 1):
        if cp in HANGUL or 0xD800 <= cp < 0xE000 or 0x20000 <= cp < 0x2F800 or 0x2FA20 <= cp < 0xE0000:
            continue
        ch = chr(cp)
        cat = ud.category(ch)
        if cat in ("Cn", "Co", "Cs"):
            continue
        if _invisible(ch):
            yield ch, ""
        elif cat == "Zs":
            yield ch, " "
        elif ch in HYPHENS:
            yield ch, "-"
        elif d := ud.decomposition(ch):
            if d[0] != "<":
                composed = ud.normalize("NFC", ch)
                if composed != ch:
                    yield ch, composed
                for form in {ud.normalize("NFD", ch), "".join(chr(int(x, 16)) for x in d.split())}:
                    if form not in (ch, composed) and composed == ch:
                        yield form, ch
            elif d.split()[0] in TAGS:
                plain = ud.normalize("NFKC", ch)
                if not (plain.startswith(" ") and len(plain) > 1):
                    yield ch, plain
    yield from LOOKALIKE_LETTERS.items()
    yield from INSIDE_LATIN.items()


def is_plain(s: str) -> bool:
    """Visible and stable under NFKC; the empty string is the plain form of what cannot be seen."""
    return s in ("", " ", "-") or (ud.normalize("NFKC", s) == s and not any(_invisible(c) or ud.category(c) == "Zs" or c in HYPHENS for c in s))


@lru_cache(1)
def classes() -> tuple[tuple[str, ...], ...]:
    """All look-alike classes with at least two members, each sorted."""
    uf = UnionFind()
    for a, b in equal_pairs():
        uf.union(a, b)
    by: dict[str, list[str]] = {}
    for x in uf.up:
        by.setdefault(uf.find(x), []).append(x)
    return tuple(tuple(sorted(v, key=lambda s: (len(s), s))) for _, v in sorted(by.items()) if len(v) > 1)


def representatives(counts: dict[str, int]) -> dict[str, str]:
    """Every non-representative member -> representative of its class, by corpus frequency."""
    out: dict[str, str] = {}
    for members in classes():
        plain = [m for m in members if is_plain(m)] or list(members)
        best = "" if "" in plain else min(plain, key=lambda m: (-counts.get(m, 0), [ord(c) for c in m]))
        out.update((m, best) for m in members if m != best)
    return out


def count_members(values: DataFrame, column: str = "value", deciding: bool = False) -> dict[str, int]:
    """How often each member of a class occurs in all values; one row per member reaches the driver.

    With ``deciding``, only in the classes where the frequency decides: not in those with one plain member or an invisible one.
    """
    members = {m for c in classes() if not deciding or ("" not in c and sum(map(is_plain, c)) != 1) for m in c if m}
    single = np.array(sorted(ord(m) for m in members if len(m) == 1))
    several = sorted(m for m in members if len(m) > 1)
    marks = sorted({m[-1] for m in several})

    def tally(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[str, int] = {}
        hist = np.zeros(0x110000, np.int64)
        for b in batches:
            text = "\n".join(b.iloc[:, 0].dropna())
            points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
            h = np.bincount(points, minlength=1)
            hist[: len(h)] += h
            there = {x for x in marks if ord(x) < len(h) and h[ord(x)]}
            for s in several:
                if s[-1] in there and (n := text.count(s)):
                    total[s] = total.get(s, 0) + n
        total.update((chr(c), int(hist[c])) for c in single if hist[c])
        if total:
            yield pd.DataFrame(list(total.items()), columns=["member", "n"])

    rows = values.select(column).mapInPandas(tally, "member string, n long").groupBy("member").agg(F.sum("n").alias("n")).collect()
    return {r["member"]: r["n"] for r in rows}


WORD = re.compile(r"[^\W\d_]+")


@lru_cache(None)
def _script(ch: str) -> str:
    return ud.name(ch, "?").split(" ", 1)[0]


def _nfc(m: re.Match) -> str:
    return ud.normalize("NFC", m.group())


def _composed(text: str) -> str:
    """Hangul letters in syllables, accents in canonical order and as far as possible within their letter."""
    return text if PARTS.isdisjoint(text) else CLUSTERS.sub(_nfc, JAMO.sub(_nfc, text))


class Rewriter:
    """Rewrites texts into the representatives' form; built once per worker from the table of ``representatives``."""

    def __init__(self, table: dict[str, str]):
        self.table = table
        self.foreign = {a: table[a] for a in (*LOOKALIKE_LETTERS, *INSIDE_LATIN) if a in table}
        self.auto = ahocorasick.Automaton()
        for a, b in table.items():
            if a not in self.foreign:
                self.auto.add_word(a, (len(a), b))
        self.auto.make_automaton()
        self.foreign_auto = ahocorasick.Automaton()
        for a, b in self.foreign.items():
            self.foreign_auto.add_word(a, (1, b))
        self.foreign_auto.make_automaton()
        # The last character of a pattern is never ASCII nor a blank, and no pattern holds a blank: only pieces between blanks
        # with one of these characters can hold a match.
        self.triggers = frozenset(a[-1] for a in table)
        self.pieces = re.compile(f"[{''.join(map(re.escape, sorted(self.triggers)))}]") if table else None

    def _greedy(self, auto: ahocorasick.Automaton, text: str, keep: set[int] = frozenset()) -> str:
        out, at, done = [], 0, 0
        for m in self.pieces.finditer(text):
            if m.start() < done:
                continue
            base, done = text.rfind(" ", 0, m.start()) + 1, text.find(" ", m.start())
            done = done if done >= 0 else len(text)
            for end, (n, to) in auto.iter_long(text[base:done]):
                start = base + end - n + 1
                if start not in keep:
                    out += (text[at:start], to)
                    at = base + end + 1
        return "".join([*out, text[at:]]) if out else text

    def _kept(self, text: str) -> set[int]:
        """Offsets of look-alike letters that stand for themselves."""
        words = [(m.start(), m.group()) for m in WORD.finditer(text) if not m.group().isascii()]
        certain = set()
        for _, w in words:
            scripts = {_script(c) for c in w}
            if "LATIN" not in scripts:
                certain |= {_script(c) for c in w if (c not in self.foreign or c in INSIDE_LATIN) and len(w) > 1}
        kept: set[int] = set()
        for at, w in words:
            if not any(c in self.foreign for c in w):
                continue
            latin = any(_script(c) == "LATIN" for c in w)
            own = {_script(c) for c in w if c not in self.foreign or (c in INSIDE_LATIN and not latin)} - {"LATIN"}
            for i, c in enumerate(w):
                if c not in self.foreign:
                    continue
                s = _script(c)
                if c in INSIDE_LATIN and not (latin and not own):
                    kept.add(at + i)
                    continue
                if (s in own and (not latin or s != "GREEK")) or (not latin and (s in certain or (len(w) == 1 and c in GREEK_SYMBOLS))):
                    kept.add(at + i)
        return kept

    def __call__(self, text: str | None) -> str | None:
        """Null stays null. Ends because every round shortens the text or replaces members by representatives only."""
        if text is None or text.isascii() or (self.triggers.isdisjoint(text) and PARTS.isdisjoint(text)):
            return text
        for _ in range(len(text) + 2):
            was = text
            text = self._greedy(self.auto, _composed(text))
            if not self.foreign.keys().isdisjoint(text):
                text = self._greedy(self.foreign_auto, text, self._kept(text))
            if text == was:
                break
        return text


_built: dict[int, Rewriter] = {}


def rewriter(table: dict[str, str]) -> Rewriter:
    key = hash(tuple(sorted(table.items())))
    if key not in _built:
        _built[key] = Rewriter(table)
    return _built[key]


def consistent_udf(table: dict[str, str]):
    """A pandas UDF that brings a string column to the consistent form."""

    @F.pandas_udf("string")
    def consistent(s: pd.Series) -> pd.Series:
        f = rewriter(table)
        return pd.Series([f(x) if isinstance(x, str) else None for x in s], dtype=object)

    return consistent


def make_consistent(df: DataFrame, column: str, out: str, table: dict[str, str] | None = None) -> DataFrame:
    """``df`` with ``out``: the consistent form of ``column``, computed over whole values.

    Without ``table`` the frequencies are counted over ``df`` itself. Rows of plain ASCII never reach Python, for every
    pattern of the automaton holds at least one other character. Null stays null, the empty text stays empty; rows are
    neither dropped nor merged; a clash of ``out`` with a column of ``df`` replaces that column.
    """
    if table is None:
        table = representatives(count_members(df.select(F.col(column).alias("value")), deciding=True))
    odd = F.col(column).rlike(r"[^\x00-\x7F]")
    return df.withColumn(out, F.when(odd, consistent_udf(table)(F.when(odd, F.col(column)))).otherwise(F.col(column)))


def changed_rows(df: DataFrame, column: str, table: dict[str, str]) -> DataFrame:
    """The rows of ``df`` whose value is not in the consistent form yet."""
    odd = df.where(F.col(column).rlike(r"[^\x00-\x7F]"))
    return odd.where(consistent_udf(table)(F.col(column)) != F.col(column))


def consistent_values(values: Iterable[str], counts: dict[str, int] | None = None) -> list[str]:
    """The same on the driver, for small lists; letters count as plain Latin text has them unless ``counts`` is given."""
    f = rewriter(representatives(counts if counts is not None else {chr(c): 1 for c in range(32, 127)}))
    return [f(v) for v in values]
