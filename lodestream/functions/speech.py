"""Text for speech: a scanner cuts a sentence into runs, and each kind of run has a rule of its own.

Kinds: dictionary terms, markup, links, numbers with what qualifies them (signs, percent, ranges, magnitudes, years,
measures), words, and single marks. Marks are told apart by their Unicode category. The spoken parts are joined in the
end, which is where pauses merge and spaces between Chinese characters go.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIGITS = "零一二三四五六七八九"
PAUSE, STOP = "，", "。"
# Magnitudes, and the measure words before which two is read 两.
MAGNITUDES = {"K": 10**3, "M": 10**6, "B": 10**9}
MEASURES = "个只条款种家位名项类轮倍句层片颗篇段次所间周年点万亿"
# How these marks are read.
SPOKEN_MARKS = {"≈": "约", "&": "和", "°C": "摄氏度", "°F": "华氏度", "°": "度", "!": "！", "?": "？", "。": "。", "！": "！", "？": "？", "、": "、", "/": "、", "•": "、"}
CURRENCIES = {"$": "美元", "€": "欧元"}


def read_digits(number: str) -> str:
    return "".join(DIGITS[int(d)] for d in number)


@lru_cache(maxsize=4096)
def read_integer(n: int) -> str:
    """How a whole number is read: 十二, 一百零五, 一千五百, 一万零二十, 两 is left to the measure rule."""
    for size, unit in ((10**8, "亿"), (10**4, "万"), (1000, "千"), (100, "百"), (10, "十")):
        if n >= size:
            head, rest = divmod(n, size)
            first = "" if unit == "十" and n < 20 else read_integer(head)
            gap = "零" if 0 < rest < size // 10 else ""
            # within a larger number ten to nineteen are read with their one
            tail = "" if not rest else ("一" if 10 <= rest < 20 else "") + read_integer(rest)
            return f"{first}{unit}{gap}{tail}"
    return DIGITS[n]


def read_number(number: str) -> str:
    """A numeral, which may have thousands separators and, as a version has, several points."""
    whole, *parts = number.replace(",", "").split(".")
    return "点".join([read_integer(int(whole)), *map(read_digits, parts)])


_NUMERAL = r"\d{1,3}(?:,\d{3})+(?!\d)(?:\.\d+)?|\d+(?:\.\d+)*"
_RUN = re.compile(
    r"(?P<inline></?(?:strong|em|code|[bisu])>|\*\*|`)|(?P<gone><[a-zA-Z/!][^>]*>|https?://\S+|www\.\S+|[\w.+-]+@[\w-]+\.[A-Za-z]{2,}|@\w+|"
    r"[\w-]+\.(?i:com|net|org|io|ai|cn|dev|app|co|me|tv|info)(?![A-Za-z0-9])(?:/[^\s，。]*)?)|"
    rf"(?P<number>{_NUMERAL})|(?P<word>[A-Za-z]+(?:'[A-Za-z]+)*)|(?P<dots>\.{{2,}})|(?P<degrees>°[CF])|(?P<space>\s+)|(?P<mark>.)",
    re.S,
)
_SPAN = re.compile(rf"\s*[-~—–]\s*({_NUMERAL})\s*%")
_LEFT, _RIGHT = re.compile(r"[0-9A-Za-z.]+$"), re.compile(r"\s*([0-9A-Za-z.]+)")


class _Sentence:
    """One pass over a text; ``at`` is the place behind what has been spoken."""

    def __init__(self, text: str, terms: dict[str, str]) -> None:
        self.text, self.at = text, 0
        self.terms = {k.lower(): v for k, v in terms.items() if k}
        self.term = re.compile("|".join(_term(k) for k in sorted(terms, key=len, reverse=True) if k), re.I) if self.terms else None
        self.after = ""  # what the next number takes behind it

    def parts(self) -> Iterator[str]:
        while self.at < len(self.text):
            known = self.term.match(self.text, self.at) if self.term else None
            run = known or _RUN.match(self.text, self.at)
            start, self.at = self.at, run.end()
            yield self.terms[known[0].lower()] if known else getattr(self, "_" + run.lastgroup)(start, run[0])

    def _inline(self, start: int, run: str) -> str:
        return ""

    def _gone(self, start: int, run: str) -> str:
        return " "

    _space = _gone

    def _word(self, start: int, run: str) -> str:
        return run

    def _dots(self, start: int, run: str) -> str:
        return PAUSE

    def _degrees(self, start: int, run: str) -> str:
        return SPOKEN_MARKS[run]

    def _take(self, pattern: str) -> re.Match | None:
        """What follows, if it fits; it counts as spoken then."""
        found = re.compile(pattern).match(self.text, self.at)
        if found:
            self.at = found.end()
        return found

    def _number(self, start: int, run: str) -> str:
        behind, self.after = self.after, ""
        span = _SPAN.match(self.text, self.at)
        if span:
            self.at = span.end()
            return f"百分之{read_number(run)}到{read_number(span[1])}{behind}"
        if self._take(r"\s*%"):
            return f"百分之{read_number(run)}{behind}"
        before = self.text[start - 1 : start]
        if run.count(".") < 2 and not (before.isascii() and before.isalnum()) and (big := self._take(r"([KMB])(?![A-Za-z])")):
            return read_integer(int(float(run.replace(",", "")) * MAGNITUDES[big[1]])) + behind
        spoken = read_number(run)
        if before != ".":
            if len(run) == 4 and run.isdigit() and self._take(r"\s*(?=财?年)"):
                spoken = read_digits(run)
            elif run == "2" and self._take(rf"\s*(?=[{MEASURES}])"):
                spoken = "两"
        for sign, word in (("~", "到"), ("[×x]", "乘"), (r"\+", "加")):
            if self._take(rf"\s*{sign}\s*(?=\d)"):
                return spoken + behind + word
        return spoken + behind

    def _mark(self, start: int, run: str) -> str:
        next_digit = self.text[self.at : self.at + 1].isdigit()
        if run == "-":
            return self._hyphen(start)
        if run == "." and self.text[start - 1 : start].isdigit() and next_digit:
            return "点"
        if run == "~" and next_digit:
            return "约"
        if run in CURRENCIES and re.compile(r"\s*\d").match(self.text, self.at):
            return CURRENCIES[run]
        if run in "¥￥" and self._take(r"\s*(?=\d)"):
            self.after = "元"
            return ""
        return SPOKEN_MARKS[run] if run in SPOKEN_MARKS else STOP if run == "." else _by_category(run)

    def _hyphen(self, start: int) -> str:
        """By the runs on either side: between numbers a range, between words itself, from a word to a number nothing."""
        left, right = _LEFT.search(self.text[:start].rstrip()), _RIGHT.match(self.text, self.at)
        if not right:
            return PAUSE
        if not left:
            return "负" if self.text[self.at].isdigit() else PAUSE
        a, b = left[0], right[1]
        self.at = right.start(1)
        number = lambda x: x.replace(".", "").isdigit()
        if number(a) and number(b):
            return "到"
        if a.isalpha() and b.isalpha():
            return "-"
        return "" if a.isalpha() and b[0].isdigit() and number(b) else " "


def _term(term: str) -> str:
    """A dictionary term; an ASCII one on word edges, one that ends in a digit not before a point."""
    if not (term[0].isascii() and term[-1].isascii()):
        return re.escape(term)
    left = "(?<![0-9A-Za-z])" if term[0].isalnum() else ""
    return left + re.escape(term) + ("(?![0-9A-Za-z.])" if term[-1].isdigit() else "(?![0-9A-Za-z])" if term[-1].isalnum() else "")


def _by_category(mark: str) -> str:
    """Letters as they are; brackets and middle dots unspoken; dashes, quotes, commas and arrows a pause; other signs a space."""
    kind = unicodedata.category(mark)
    if kind in ("Ps", "Pe", "Cf", "Mn") or mark in "·・‥":
        return ""
    if kind in ("Pd", "Pi", "Pf") or mark in ",;:，；：\"'" or "ARROW" in unicodedata.name(mark, ""):
        return PAUSE
    return " " if kind[0] in "PSZC" else mark


def _chinese(char: str) -> bool:
    return "㐀" <= char <= "鿿" or "豈" <= char <= "\ufaff"


def _joined(parts: Iterator[str]) -> str:
    """Parts one after the other: a pause never beside another mark, no space beside a mark or between Chinese characters."""
    out: list[str] = []
    space = False
    for char in "".join(parts):
        if char.isspace():
            space = True
            continue
        last = out[-1] if out else ""
        if char == PAUSE and (not out or last in "，。！？"):
            space = False
            continue
        if last == PAUSE and char in "。！？":
            out.pop()
        if space and out and char not in "，。！？、" and not (_chinese(last) and _chinese(char)):
            out.append(" ")
        space = False
        out.append(char)
    s = "".join(out).strip(" ，、-")
    return s if not s or s[-1] in "。！？" else s + STOP


def speak(text: str | None, spoken: dict[str, str] | None = None) -> str:
    """A sentence as a synthesiser should get it; any text gives one."""
    return _joined(_Sentence(unicodedata.normalize("NFKC", text or ""), spoken or {}).parts())


def spoken_text(text: Column, spoken: dict[str, str] | None = None) -> Column:
    """``speak`` over a column."""

    @F.pandas_udf(T.StringType())
    def apply(s: pd.Series) -> pd.Series:
        return s.map(lambda x: speak(x, spoken))

    return apply(text)


def read_number_column(n: Column) -> Column:
    @F.pandas_udf(T.StringType())
    def apply(s: pd.Series) -> pd.Series:
        return s.map(lambda x: None if pd.isna(x) else read_integer(int(x)))

    return apply(n)


def width_em(text: Column) -> Column:
    """Width in hundredths of an em by a rule of thumb: wide characters 100, capitals 67, digits 56, others 50."""
    wide = F.regexp_count(text, F.lit("[\\u2e80-\\u9fff\\uac00-\\ud7a3\\uf900-\\ufaff\\uff00-\\uff60]"))
    capitals, digits = F.regexp_count(text, F.lit("[A-Z]")), F.regexp_count(text, F.lit("[0-9]"))
    return wide * 100 + capitals * 67 + digits * 56 + (F.length(text) - wide - capitals - digits) * 50
