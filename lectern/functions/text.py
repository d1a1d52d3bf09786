"""Column functions on text, evaluated in the JVM, with Python's notion of white space and lines."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space and line ends as in Python, line formats, folders of finished work, numerals.
SPACE = r"[\x09-\x0d\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"
WORD = "[가-힣A-Za-z0-9]"
TIMESTAMP = rf"^{SPACE}*((?:[0-9]{{1,2}}:)?[0-9]{{1,2}}:[0-9]{{2}})(?:{SPACE}*화자{SPACE}*[0-9]+)?{SPACE}*$"
SRT_TIMECODE = rf"^[0-9]{{2}}:[0-9]{{2}}:[0-9]{{2}},[0-9]{{3}}{SPACE}+-->{SPACE}+[0-9]{{2}}:[0-9]{{2}}:[0-9]{{2}},[0-9]{{3}}$"
FINAL_FOLDERS = ("회원전용 - 기본다이제스트 (계룡산 등반)", "회원전용 - 지리산 코스 (음양오행)", "회원전용 - 한라산 코스 (십성론)")
SINO_DIGITS = "영일이삼사오육칠팔구"


def let(value: Column, body) -> Column:
    """body(value), with value evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def strip(c) -> Column:
    """Text without white space at either end; only its ends are looked at, where a pattern would be tried at every place."""
    return F.btrim(c, F.lit(BLANKS))


def lines(text: Column) -> Column:
    """Lines without their ends; none for empty text, and no empty line after a final end."""
    parts = F.split(text, LINE_END, -1)
    return let(parts, lambda p: F.when(F.element_at(p, -1) == "", F.slice(p, 1, F.size(p) - 1)).otherwise(p))


def occurrences(text: Column, word: Column) -> Column:
    """Non-overlapping occurrences of a non-empty word."""
    gone = F.length(text) - F.length(F.replace(text, word, F.lit("")))
    return F.when(F.length(word) > 0, (gone / F.length(word)).cast("long")).otherwise(F.lit(0).cast("long"))


def contains_any(text: Column, words: Column) -> Column:
    return F.exists(words, lambda w: F.contains(text, w))


def around(text: Column, start: Column, end: Column, window: int) -> Column:
    """The span and up to window characters on either side."""
    left = F.greatest(start - window, F.lit(0))
    return F.substring(text, left + 1, end + window - left)


def at_word_boundary(text: Column, start: Column, end: Column) -> Column:
    before = F.when(start > 0, F.substring(text, start, F.lit(1))).otherwise("")
    return ~before.rlike(WORD) & ~F.substring(text, end + 1, F.lit(1)).rlike(WORD)


def whole_word(word: str) -> str:
    """Pattern of a word that no word character touches."""
    return rf"(?<!{WORD})\Q{word}\E(?!{WORD})"


def is_timestamp_line(line: Column) -> Column:
    return line.rlike(TIMESTAMP)


def timestamp_of(line: Column) -> Column:
    """The time label of a timestamp line, else null."""
    return F.when(line.rlike(TIMESTAMP), F.regexp_extract(line, TIMESTAMP, 1))


def is_srt_text(line: Column) -> Column:
    """A line that is neither blank, an index nor a time code."""
    s = strip(line)
    return (s != "") & ~s.rlike("^[0-9]+$") & ~s.rlike(SRT_TIMECODE)


def has_hangul(c: Column) -> Column:
    return c.rlike("[가-힣]")


def is_short_hangul(c: Column) -> Column:
    return c.rlike("^[가-힣]{1,4}$")


def is_expandable_stem(c: Column) -> Column:
    return c.rlike("^[가-힣]{2,}$")


def is_auto_pair(wrong: Column, right: Column) -> Column:
    """Pairs that may enter a dictionary by themselves: at most 20 characters and two words each."""
    fits = lambda c: (F.length(c) <= 20) & c.rlike("^[가-힣A-Za-z0-9]+( [가-힣A-Za-z0-9]+)?$")
    return fits(wrong) & fits(right) & (wrong != right)


def final_consonant(c: Column) -> Column:
    """Index of the last syllable's final consonant, 0 for none or no syllable."""
    last = F.substring(c, -1, 1)
    return F.when(last.between("가", "힣"), F.pmod(F.ascii(last) - 44032, F.lit(28))).otherwise(0)


def glob_pattern(glob: str) -> str:
    """Anchored regular expression of a file-name pattern; * and ? cross slashes, case counts."""
    out, i = "", 0
    while i < len(glob):
        c = glob[i]
        i += 1
        if c == "*":
            out += "[\\s\\S]*"
        elif c == "?":
            out += "[\\s\\S]"
        elif c == "[" and (end := glob.find("]", i + 1 if glob[i : i + 1] in ("!", "]") else i)) > 0:
            body, i = glob[i:end], end + 1
            negate, body = body[:1] == "!", body.lstrip("!") if body[:1] == "!" else body
            out += "[" + "^" * negate + re.sub(r"([\[\]\\^&])", r"\\\1", body) + "]"
        else:
            out += re.escape(c)
    return f"^{out}$"


def is_finalised(path: Column, folders: tuple[str, ...] = FINAL_FOLDERS) -> Column:
    """Whether a folder of the path marks it as finished work."""
    return F.arrays_overlap(F.split(path, "[/\\\\]"), F.array(*map(F.lit, folders)))


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"{WORD}+"), F.lit(0))


def sentences(text: Column, ends: str = ".!?", least: int = 1) -> Column:
    """Parts of a line after sentence ends, stripped, of `least` characters or more."""
    parts = F.split(text, rf"(?<=[{re.escape(ends)}]){SPACE}+", -1)
    return F.filter(F.transform(parts, strip), lambda s: F.length(s) >= least)


def digits_to_sino(text: Column) -> Column:
    """Numbers up to 9999 in Sino-Korean numerals; longer ones stay as they are."""
    number = "(?<![0-9])0*([0-9]{1,4})(?![0-9])"
    cut = F.split(F.regexp_replace(text, number, "\u0001$1\u0001"), "\u0001", -1)
    units = F.array(*map(F.lit, ("", "십", "백", "천")))
    names = F.array(*map(F.lit, SINO_DIGITS))

    def spoken(n: Column) -> Column:
        size = F.length(n)
        digit = lambda i: F.substring(n, i, F.lit(1)).cast("int")
        name = lambda i: F.when(digit(i) == 0, "").otherwise(F.concat(F.when((digit(i) == 1) & (i < size), "").otherwise(F.get(names, digit(i))), F.get(units, size - i)))
        said = F.array_join(F.transform(F.sequence(F.lit(1), size), name), "")
        return F.when(n.cast("int") == 0, SINO_DIGITS[0]).otherwise(said)

    return F.when(text.rlike("[0-9]"), F.array_join(F.transform(cut, lambda p, i: F.when(i % 2 == 1, spoken(p)).otherwise(p)), "")).otherwise(text)


def srt_time(seconds: Column) -> Column:
    """HH:MM:SS,mmm, milliseconds rounded half to even."""
    ms = F.greatest(F.bround(seconds * 1000), F.lit(0.0)).cast("long")
    part = lambda n, of, width: F.lpad((F.floor(ms / n) % of).cast("string"), width, "0")
    hours = F.floor(ms / 3_600_000).cast("string")
    return F.concat(F.lpad(hours, F.greatest(F.length(hours), F.lit(2)), "0"), F.lit(":"), part(60_000, 60, 2), F.lit(":"), part(1000, 60, 2), F.lit(","), part(1, 1000, 3))


def squeeze(text: Column) -> Column:
    return strip(F.regexp_replace(text, f"{SPACE}+", " "))


def script_path(raw: Column) -> Column:
    return F.regexp_replace(raw, r"\.txt$", ".script.txt")


def raw_path(script: Column) -> Column:
    return F.replace(script, F.lit(".script.txt"), F.lit(".txt"))


def mirror(path: Column, suffix: str) -> Column:
    """The path with its last extension replaced."""
    return F.concat(F.regexp_replace(path, r"\.[^./]+$", ""), F.lit(suffix))


def display_stem(path: Column) -> Column:
    """File name without folders, extension and a final .script."""
    return F.regexp_replace(F.regexp_replace(F.regexp_extract(path, r"([^/]+)$", 1), r"\.[^./]+$", ""), r"(?i)\.script$", "")


def title_tokens(stem: Column) -> Column:
    parts = F.split(stem, r"[\s\-_–—·()（）\[\],.]+", -1)
    return F.filter(parts, lambda t: (F.length(t) >= 2) & ~t.rlike("^[0-9]+$") & ~F.lower(t).isin("script", "요약", "txt", "md"))


def changed_chars(before: Column, after: Column) -> Column:
    """Places at which the texts differ, and the difference of their lengths."""
    shared = F.least(F.length(before), F.length(after))
    head = lambda c: F.filter(F.split(F.substring(c, F.lit(1), shared), ""), lambda x: x != "")
    same = F.aggregate(F.zip_with(head(before), head(after), lambda a, b: (a != b).cast("int")), F.lit(0), lambda a, x: a + x)
    return F.when(before == after, 0).otherwise(F.when(shared > 0, same).otherwise(0) + F.abs(F.length(before) - F.length(after))).cast("long")
