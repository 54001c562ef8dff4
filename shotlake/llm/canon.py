"""Problem 6: texts that look alike but differ in their characters.

``canonical`` brings one text to the project's consistent form. Most text is already in that form,
so the work is split by a quick check: code points in ``STABLE`` never change on their own, a
segment between plain blanks that holds no other code point is copied as it is, and only the
remaining segments are rewritten, each with the whole segment as context (a combining mark needs
its base letter, a look-alike needs the letters beside it). The rewritten segments are spliced back
into the unchanged text.

Consistent form: NFC; ordinary width; no white space but blank and line feed; no invisible
characters but a joiner between two emoji; no look-alike of another script in a word that has a
Latin letter; Vietnamese letters in place of their foreign look-alikes.

On a DataFrame the quick check runs in the JVM (``unstable``), and only unstable cells travel to
Python. Null stays null and the empty text stays empty.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Ranges of code points that are in consistent form whatever stands beside them
# (marks, joiners and letters of other scripts are not among them).
STABLE = (
    (0x0A, 0x0A), (0x20, 0x7E), (0xA1, 0xAC), (0xAE, 0xCF), (0xD1, 0xEF), (0xF1, 0x130), (0x132, 0x148), (0x14A, 0x17E),
    (0x1A0, 0x1A1), (0x1AF, 0x1B0), (0x1EA0, 0x1EF9), (0x2010, 0x2027), (0x2030, 0x205E), (0x2070, 0x2071), (0x2074, 0x208E),
    (0x20A0, 0x20C0), (0x2100, 0x2125), (0x2127, 0x2129), (0x212C, 0x214F), (0x2150, 0x218B), (0x2190, 0x2328), (0x232B, 0x23FF),
    (0x2460, 0x27BF), (0x3001, 0x3029), (0x3041, 0x3096), (0x30A1, 0x30FA), (0x4E00, 0x9FFF), (0xAC00, 0xD7A3), (0xFFFD, 0xFFFD),
    (0x1F300, 0x1F64F), (0x1F680, 0x1F6FF), (0x1F900, 0x1F9FF), (0x1FA70, 0x1FAFF),
)

# Letters of other scripts and the Latin letters they look like.
LOOKALIKES = dict(zip("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹαγικνορυχϲϳ", "ABEZHIKMNOPTYXCayikvopuxcj"))  # Greek
LOOKALIKES |= dict(zip("АВЕЅІЈКМНОРСТУХҮԀԚԜӀаеорсухѕіјһԁԛԝӏү", "ABESIJKMHOPCTYXYDQWIaeopcyxsijhdqwly"))  # Cyrillic
LOOKALIKES |= dict(zip("ՕՍօսոհց", "OUounhg"))  # Armenian
# Latin letters foreign to Vietnamese that stand for a Vietnamese look-alike.
FOREIGN = {"Ð": "Đ", "Ɖ": "Đ", "ð": "đ", "ɖ": "đ", "ɑ": "a", "ɡ": "g", "ı": "i"}

# Format characters of Unicode that are seen, and invisible ones of other categories.
SEEN_FORMAT = {0x600, 0x601, 0x602, 0x603, 0x604, 0x605, 0x6DD, 0x70F, 0x8E2, 0x110BD, 0x110CD}
INVISIBLE = {0x34F, 0x115F, 0x1160, 0x3164, 0xFFA0, 0x17B4, 0x17B5, 0x180B, 0x180C, 0x180D, 0x180F, *range(0xFE00, 0xFE10), *range(0xE0100, 0xE01F0)}

_cls = "".join(f"{re.escape(chr(a))}-{re.escape(chr(b))}" if a != b else re.escape(chr(a)) for a, b in STABLE)
UNSTABLE = re.compile(f"[^{_cls}]+")
JAVA_UNSTABLE = "[^" + "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in STABLE) + "]"
_BREAKS = re.compile("\r\n|[\r\u0085\u2028\u2029]")


def _emoji(c: str) -> bool:
    o = ord(c)
    return 0x1F000 <= o <= 0x1FAFF or 0x2190 <= o <= 0x2BFF and unicodedata.category(c) in ("So", "Sm") or o in (0xA9, 0xAE)


def _latin(c: str) -> bool:
    o = ord(c)
    return o < 0x250 and c.isalpha() or 0x1E00 <= o <= 0x1EFF or 0x250 <= o < 0x2B0


def _width(c: str) -> str:
    return unicodedata.normalize("NFKC", c) if 0xFF01 <= ord(c) <= 0xFFEE else c


def _letters(word: str) -> str:
    """One run of letters and marks, decomposed; look-alikes replaced if it has a Latin letter."""
    word = "".join(FOREIGN.get(c, c) for c in word)
    if any(_latin(c) for c in word):
        word = "".join(LOOKALIKES.get(c, c) for c in word)
    return word


@lru_cache(maxsize=50_000)
def _segment(seg: str) -> str:
    s = _BREAKS.sub("\n", "".join(map(_width, seg)))
    out: list[str] = []
    for c in s:
        o, cat = ord(c), unicodedata.category(c)
        if c == "\n":
            out.append(c)
        elif cat == "Zs" or c in "\t\x0b\x0c\x1c\x1d\x1e\x1f":
            out.append(" ")
        elif o == 0x200D or cat != "Cc" and o not in INVISIBLE and (cat != "Cf" or o in SEEN_FORMAT):
            out.append(c)
    kept = [c for i, c in enumerate(out) if c != "\u200d" or 0 < i < len(out) - 1 and _emoji(out[i - 1]) and _emoji(out[i + 1])]
    s = unicodedata.normalize("NFC", "".join(kept))
    if s.isascii():
        return s
    # A look-alike may carry the marks itself, so words are looked at decomposed.
    s, parts, word = unicodedata.normalize("NFD", s), [], []
    for c in s:
        if c.isalpha() or unicodedata.category(c)[0] == "M":
            word.append(c)
        else:
            if word:
                parts.append(_letters("".join(word)))
                word = []
            parts.append(c)
    if word:
        parts.append(_letters("".join(word)))
    return unicodedata.normalize("NFC", "".join(parts))


def canonical(text: str | None) -> str | None:
    """The consistent form of a text; null for null."""
    if text is None or text.isascii() and text.isprintable():
        return text
    out, done = [], 0
    for m in UNSTABLE.finditer(text):
        if m.start() < done:
            continue
        a = max(text.rfind(" ", done, m.start()), text.rfind("\n", done, m.start())) + 1
        a = max(a, done)
        ends = [e for e in (text.find(" ", m.end()), text.find("\n", m.end())) if e >= 0]
        b = min(ends, default=len(text))
        seg = text[a:b]
        if seg[-1] == "\r" and text.startswith("\n", b):  # CR LF is one line feed
            seg = seg[:-1]
        out += (text[done:a], _segment(seg) if len(seg) <= 200 else _segment.__wrapped__(seg))
        done = b
    return "".join(out) + text[done:] if out else text


def folded(text: str | None) -> str | None:
    """Consistent form, case-folded."""
    return None if text is None else canonical(text).casefold()


@F.pandas_udf(StringType())
def _canonical_udf(s: pd.Series) -> pd.Series:
    return s.map(canonical, na_action="ignore")


@F.pandas_udf(StringType())
def _folded_udf(s: pd.Series) -> pd.Series:
    return s.map(folded, na_action="ignore")


def unstable(col: Column) -> Column:
    """Quick check in the JVM: may the text's consistent form differ from it?"""
    return F.coalesce(col.rlike(JAVA_UNSTABLE), F.lit(False))


def canonical_col(col: Column) -> Column:
    """Consistent form of a string column. Stable cells stay in the JVM: Python gets null for them."""
    return F.coalesce(_canonical_udf(F.when(unstable(col), col)), col)


def folded_col(col: Column) -> Column:
    """Consistent form, case-folded. Of the stable letters only ß and µ fold otherwise than to lower case."""
    plain = F.replace(F.replace(F.lower(col), F.lit("ß"), F.lit("ss")), F.lit("µ"), F.lit("μ"))
    return F.coalesce(_folded_udf(F.when(unstable(col), col)), plain)


def changed_cells(df: DataFrame, key: str, field: str, name: str | None = None) -> DataFrame:
    """(field, frame_id) of the cells whose stored text is not in consistent form.

    Null cells are no case; a row repeated under its key counts once.
    """
    t = df.select(F.col(key).alias("frame_id"), F.col(field).alias("t")).where(unstable(F.col("t")))
    return t.where(_canonical_udf("t") != F.col("t")).select(F.lit(name or field).alias("field"), "frame_id").distinct()


def consistent_texts(df: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(field, frame_id, text, changed): every non-null text in consistent form, one row per cell."""
    out = None
    for f in fields:
        t = df.select(F.lit(f).alias("field"), F.col(key).alias("frame_id"), F.col(f).alias("t")).where(F.col("t").isNotNull())
        t = t.select("field", "frame_id", "t", canonical_col(F.col("t")).alias("text"))
        t = t.groupBy("field", "frame_id").agg(F.min("text").alias("text"), F.max(F.col("text") != F.col("t")).alias("changed"))
        out = t if out is None else out.unionByName(t)
    return out
