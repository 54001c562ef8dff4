"""Scalar expressions on columns: time, text, labels, vectors. All run in the JVM unless said otherwise."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# --- time -----------------------------------------------------------------------------------------


def frame_ms_truncated(frame: Column, fps: Column) -> Column:
    """Milliseconds of a frame, truncated (bounds of the transcript join)."""
    return (frame / fps * 1000).cast("bigint")


def frame_ms_rounded(frame: Column, fps: Column) -> Column:
    """Milliseconds of a frame, rounded half to even (bounds of stored shots)."""
    return F.bround(frame / fps * 1000, 0).cast("bigint")


def keyframe_ms(frame: Column, fps: Column) -> Column:
    return (frame / F.greatest(fps, F.lit(1.0)) * 1000).cast("bigint")


def duration_sec(start_frame: Column, end_frame: Column, fps: Column) -> Column:
    return (end_frame - start_frame) / F.greatest(fps, F.lit(1.0))


def total_frames(start_frame: Column, end_frame: Column) -> Column:
    return end_frame - start_frame + 1


# --- accents --------------------------------------------------------------------------------------


def _accents() -> tuple[str, str]:
    """Accented letters and what they are without marks, from Unicode's decompositions."""
    src, dst = ["đ", "Đ"], ["d", "D"]
    for o in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00)):
        d = unicodedata.normalize("NFD", chr(o))
        if len(d) > 1 and d[0].isascii():
            src.append(chr(o))
            dst.append(d[0])
    return "".join(src), "".join(dst)


ACCENTED, PLAIN = _accents()


#: What ends a run of text that composing leaves as it is: marks, Hangul letters, and characters that composing replaces.
_COMPOSES = "[\\p{M}\\u1100-\\u11FF\\u0340-\\u0344\\u0374\\u037E\\u0387\\u1F71-\\u1FFD\\u2000\\u2001\\u2126\\u212A\\u212B\\u2329\\u232A\\u2ADC\\uF900-\\uFAFF\\uFB1D-\\uFB4E\\u0958-\\u095F\\u09DC-\\u09DF\\u0A33-\\u0A5E\\u0B5C\\u0B5D\\u0F43-\\u0FB9]|[\\x{1D15E}-\\x{1D1C0}]|[\\x{2F800}-\\x{2FA1D}]"


def composed(c: Column) -> Column:
    """Letters and their marks as one character where one exists. Only texts that composing may change leave the JVM."""
    @F.pandas_udf("string")
    def compose(s: pd.Series) -> pd.Series:
        return s.map(lambda x: unicodedata.normalize("NFC", x), na_action="ignore")

    some = c.rlike(_COMPOSES)
    return F.coalesce(compose(F.when(some, c)), c)


def fold_accents(c: Column) -> Column:
    """Marks dropped, đ and Đ taken as d and D; decomposed input too."""
    return F.regexp_replace(F.translate(c, ACCENTED, PLAIN), "\\p{M}", "")


def has_diacritics(c: Column) -> Column:
    return fold_accents(c) != c


# --- recognised text --------------------------------------------------------------------------------

# Terms that recognition spells in other ways.
TERMS = {
    "tp hcm": "TP.HCM", "tp.hcm": "TP.HCM", "tphcm": "TP.HCM", "tp hn": "TP.Hà Nội", "tp.hn": "TP.Hà Nội", "viet nam": "Việt Nam",
    "vietnam": "Việt Nam", "ha noi": "Hà Nội", "da nang": "Đà Nẵng", "sai gon": "Sài Gòn", "cong an": "Công an", "ubnd": "UBND",
    "hdnd": "HĐND", "thcs": "THCS", "thpt": "THPT", "vtv1": "VTV1", "vtv2": "VTV2", "vtv3": "VTV3", "vtv6": "VTV6", "htv7": "HTV7", "htv9": "HTV9",
}
# A letter of a word, a vowel after which "cl" stands for "đ", signs that are rubbish in runs.
_LETTER = "[A-Za-zÀ-ỹĐđ]"
_VOWEL = "[aáàảãạăắằẳẵặâấầẩẫậeéèẻẽẹêếềểễệiíìỉĩịoóòỏõọôốồổỗộơớờởỡợuúùủũụưứừửữựyýỳỷỹỵ]"
_RUBBISH = "[|~^`_]{2,}"


def underscores_to_spaces(c: Column) -> Column:
    return F.replace(c, F.lit("_"), F.lit(" "))


def _sub_matches(c: Column, pattern: str, fix) -> Column:
    """Every match of the pattern replaced by ``fix`` of it: the text between matches and the matches are split, fixed and woven again."""
    gaps, hits = F.split(c, pattern, -1), F.regexp_extract_all(c, F.lit(pattern), F.lit(0))
    return F.concat(F.element_at(gaps, 1), F.array_join(F.zip_with(F.transform(hits, fix), F.slice(gaps, F.lit(2), F.size(gaps)), lambda h, g: F.concat(h, g)), ""))


def fix_numbers(c: Column) -> Column:
    """Letters read in place of digits in times, years, percentages and digit groups."""
    digits = lambda x: F.translate(x, "Oob", "006")
    # The patterns of times, years, percentages and digit groups.
    # Most texts hold nothing of the kind; a plain pattern tells before the exact ones run.
    given, some = c, c.rlike("[0-9Oob][:.hH][0-9Oob]|19[89Oob]|20[0-3Oob]|[0-9][Oob]")
    time = r"(?U)\b([0-2]?[0-9Oob])[:.hH]([0-5]?[0-9Oob])\b"
    c = _sub_matches(c, time, lambda x: digits(F.regexp_replace(x, "^(.+?)[:.hH](.+)$", "$1:$2")))
    c = _sub_matches(c, r"(?U)\b(19[89Oob][0-9Oob]|20[0-3Oob][0-9Oob])\b", digits)
    c = F.regexp_replace(c, r"(?U)\b(?<d>\d+)[Oob]%\b", "${d}0%")
    for _ in range(2):
        c = F.regexp_replace(c, r"(?U)(?<a>\d)[Oo](?<b>\d)", "${a}0${b}")
    return F.when(some, c).otherwise(given)


def _fix_word(t: Column) -> Column:
    code = t.rlike(r"^\d+$") | t.rlike("^[A-Z]{1,4}\\d{1,4}[A-Z]?$")
    w = F.when(t.rlike(f"^{_LETTER}+0{_LETTER}+$"), F.replace(t, F.lit("0"), F.lit("O"))).when(t.rlike(f"^0{_LETTER}{{2,}}$"), F.regexp_replace(t, "^0", "O")).when(t.rlike(f"^{_LETTER}{{2,}}0$"), F.regexp_replace(t, "0$", "O")).otherwise(t)
    w = F.when(w.rlike(f"^{_LETTER}+1{_LETTER}+$"), F.replace(w, F.lit("1"), F.lit("I"))).otherwise(w)
    w = F.regexp_replace(F.regexp_replace(w, f"^cl(?={_VOWEL})", "đ"), f"^Cl(?={_VOWEL})", "Đ")
    w = F.when(t.rlike("[01]|^[cC]l"), w).otherwise(t)
    terms = F.create_map(*[F.lit(x) for kv in TERMS.items() for x in kv])
    return F.when(code, t).otherwise(F.coalesce(F.try_element_at(terms, F.lower(w)), w))


def fix_words(c: Column) -> Column:
    """Digits read in place of letters in words, known terms; code-like tokens stay."""
    return F.array_join(F.transform(F.filter(F.split(c, " "), lambda x: x != ""), _fix_word), " ")


def clean_recognised(c: Column) -> Column:
    """The whole chain: composed, trimmed, rubbish signs, numbers, words, white space. Null gives ''."""
    c = composed(c)
    c = F.regexp_replace(c, r"(?U)^\s+|\s+$", "")
    c = fix_words(fix_numbers(F.regexp_replace(c, _RUBBISH, " ")))
    return F.coalesce(F.regexp_replace(F.regexp_replace(c, r"(?U)\s+", " "), "^ | $", ""), F.lit(""))


# --- keys and labels --------------------------------------------------------------------------------


def natural_key(c: Column) -> Column:
    """Sort key in which numbers inside a name order by value: img2 before img10."""
    parts = F.split(F.lower(c), "(?<=\\d)(?=\\D)|(?<=\\D)(?=\\d)")
    return F.array_join(F.transform(parts, lambda x: F.when(x.rlike("^\\d+$"), F.lpad(F.regexp_replace(x, "^0+(?=\\d)", ""), 20, "0")).otherwise(x)), "\u0001")


def is_video_name(c: Column) -> Column:
    # Fixed value: pattern of video directories.
    return c.rlike("(?i)^[A-Z]+\\d+[_-]V\\d+$")


def adapt_charset(c: Column, charset: str) -> Column:
    """Case brought to that of a single-case character set, other characters dropped."""
    if charset == charset.lower():
        c = F.lower(c)
    elif charset == charset.upper():
        c = F.upper(c)
    escaped = "".join(f"\\x{{{ord(x):x}}}" for x in charset)
    return F.regexp_replace(c, f"[^{escaped}]", "")


def clean_label(c: Column) -> Column:
    """White space removed, compatibility characters (ligatures, wide letters) and accents taken apart, what isn't ASCII then dropped.

    Only texts with characters other than ASCII and accented Latin letters leave the JVM.
    """
    @F.pandas_udf("string")
    def apart(s: pd.Series) -> pd.Series:
        return s.map(lambda x: unicodedata.normalize("NFKD", x), na_action="ignore")

    c = F.regexp_replace(c, r"(?U)\s+", "")
    plain = c.rlike(f"^[\\x00-\\x7F\\u0300-\\u036F{ACCENTED}]*$")
    c = F.coalesce(apart(F.when(~plain, c)), fold_accents_only(c))
    return F.regexp_replace(c, "[^\\x00-\\x7F]", "")


def fold_accents_only(c: Column) -> Column:
    """Marks dropped by decomposition only: đ has none and stays."""
    pairs = [(a, b) for a, b in zip(ACCENTED, PLAIN) if a not in "đĐ"]
    return F.regexp_replace(F.translate(c, "".join(a for a, _ in pairs), "".join(b for _, b in pairs)), "\\p{M}", "")


def normalised_edit_distance(a: Column, b: Column) -> Column:
    """Edit distance over the longer length; 0 for two empty texts."""
    n = F.greatest(F.length(a), F.length(b))
    return F.when(n == 0, F.lit(0.0)).otherwise(F.levenshtein(a, b) / n)


def encode_chars(c: Column, charset: str, length: int, pad: int = -1) -> Column:
    ids = F.transform(F.filter(F.split(c, ""), lambda x: x != ""), lambda x: F.position(x, F.lit(charset)).cast("int"))
    ids = F.concat(ids, F.array(F.lit(0)))
    return F.concat(ids, F.array_repeat(F.lit(pad), F.greatest(F.lit(0), F.lit(length) - F.size(ids))))


def decode_chars(ids: Column, charset: str) -> Column:
    """The text of positions up to the first end mark (0)."""
    return F.array_join(F.transform(before_end(ids, 0), lambda i: F.substring(F.lit(charset), i, F.lit(1))), "")


def before_end(ids: Column, end: int) -> Column:
    at = F.array_position(ids, F.lit(end)).cast("int")
    return F.slice(ids, F.lit(1), F.when(at > 0, at - 1).otherwise(F.size(ids)))


def padding_after_end(ids: Column, end: int) -> Column:
    """True for each place after the first end mark."""
    at = F.array_position(ids, F.lit(end)).cast("int")
    return F.transform(ids, lambda _x, i: (at > 0) & (i >= at))


def ctc_collapse(ids: Column, blank: int = 0) -> Column:
    """Consecutive repeats dropped, then blanks."""
    return F.filter(F.filter(ids, lambda x, i: (i == 0) | (x != F.get(ids, i - 1))), lambda x: x != blank)


def greedy_choice(p: Column) -> tuple[Column, Column]:
    """(position from 0, probability) of the likeliest entry."""
    return (F.array_position(p, F.array_max(p)) - 1).cast("int"), F.array_max(p)


# --- vectors and hashes -----------------------------------------------------------------------------


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    n = norm(a) * norm(b)
    return F.when(n > 0, dot(a, b) / n)


def unit(a: Column) -> Column:
    """The vector at unit length; an error for a zero vector."""
    n = norm(a)
    return F.when(n > 0, F.transform(a, lambda x: x / n)).otherwise(F.raise_error(F.lit("zero norm")))


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


# --- paths, boxes, responses ------------------------------------------------------------------------


def relative_path(path: Column, root: str) -> Column:
    head = root.rstrip("/") + "/"
    return F.when(path.startswith(head), F.substring(path, F.lit(len(head) + 1), F.length(path))).otherwise(path)


def absolute_path(path: Column, root: str) -> Column:
    return F.when(path.startswith("/"), path).otherwise(F.concat(F.lit(root.rstrip("/") + "/"), path))


def pad_box(box: Column, width: Column, height: Column) -> Column:
    """A word's box grown by a quarter of its height sideways and a tenth up and down, inside the image."""
    h = box[3] - box[1]
    px, py = (h * 0.25).cast("int"), (h * 0.1).cast("int")
    return F.array(F.greatest(F.lit(0), box[0] - px), F.greatest(F.lit(0), box[1] - py), F.least(width, box[2] + px), F.least(height, box[3] + py))


def response_text(parts: Column) -> Column:
    """Text of a model's response: parts<text, thought> that are no thoughts, joined and trimmed."""
    return F.trim(F.array_join(F.transform(F.filter(parts, lambda p: ~F.coalesce(p["thought"], F.lit(False))), lambda p: F.coalesce(p["text"], F.lit(""))), ""))


def speech_text(json: Column) -> Column:
    """Text of a recogniser's result, given as JSON: a string, an object with ``text``, or a list of either, joined by blanks."""
    items = F.coalesce(F.from_json(json, "array<string>"), F.array(json))
    one = lambda x: F.coalesce(F.get_json_object(x, "$.text"), F.when(~x.rlike('^[\\[{].*'), F.regexp_replace(x, '^"|"$', "")), F.array_join(F.transform(F.from_json(x, "array<string>"), lambda y: F.coalesce(F.get_json_object(y, "$.text"), y)), " "))
    return F.trim(F.array_join(F.filter(F.transform(items, one), lambda x: F.length(x) > 0), " "))
