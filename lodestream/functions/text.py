"""Text normalisation as column expressions; Arrow UDFs only for Unicode tables that Spark lacks."""

from __future__ import annotations

import html
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

TRUNCATED = "…[截断]"
CJK = "[\\u4e00-\\u9fff]"


@F.pandas_udf(T.StringType())
def _nfkc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: unicodedata.normalize("NFKC", x) if isinstance(x, str) else "")


@F.pandas_udf(T.StringType())
def _casefold(s: pd.Series) -> pd.Series:
    return s.map(lambda x: x.casefold() if isinstance(x, str) else "")


@F.pandas_udf(T.StringType())
def _unescape(s: pd.Series) -> pd.Series:
    return s.map(lambda x: html.unescape(x) if isinstance(x, str) else "")


@F.pandas_udf(T.StringType())
def _ascii(s: pd.Series) -> pd.Series:
    return s.map(lambda x: unicodedata.normalize("NFKD", x).encode("ascii", "ignore").decode() if isinstance(x, str) else "")


def fold_marks(text: Column) -> Column:
    """Zero-width characters out, controls to spaces, quotes and dashes to ASCII, white space collapsed: the JVM part."""
    t = F.regexp_replace(F.coalesce(text, F.lit("")), "[\\u200b-\\u200f\\u2060\\ufeff\\u00ad\\ufffc]", "")
    t = F.regexp_replace(t, "[\\x00-\\x08\\x0b-\\x1f\\x7f-\\x9f]", " ")
    t = F.translate(t, "“”„‟‘’‚‛–—―　", "\"\"\"\"''''--- ")
    t = F.replace(t, F.lit("…"), F.lit("..."))
    return F.trim(F.regexp_replace(t, "(?U)\\s+", " "))


def title_norm(text: Column, lower: bool = False, unicode: bool = True) -> Column:
    """A title for matching and display. unicode=False leaves out NFKC and folds case in the JVM: no Python."""
    t = fold_marks(_nfkc(text) if unicode else text)
    return t if not lower else _casefold(t) if unicode else F.lower(t)


def strip_html(text: Column, limit: int = 4000) -> Column:
    """Entities first, then tags to spaces: an escaped tag goes too."""
    t = F.regexp_replace(_unescape(text), "<[^>]+>", " ")
    return F.substring(F.trim(F.regexp_replace(t, "(?U)\\s+", " ")), 1, limit)


def strip_tags(text: Column, limit: int = 4000) -> Column:
    """strip_html for the five usual entities, in the JVM."""
    t = F.coalesce(text, F.lit(""))
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        t = F.replace(t, F.lit(entity), F.lit(char))
    return F.substring(F.trim(F.regexp_replace(F.regexp_replace(t, "<[^>]+>", " "), "\\s+", " ")), 1, limit)


def guess_lang(text: Column) -> Column:
    head = F.substring(text, 1, 600)
    n = F.regexp_count(head, F.lit(CJK))
    return F.when(F.coalesce(F.trim(head), F.lit("")) == "", None).when((n >= 8) & (n / F.greatest(F.length(head), F.lit(1)) > 0.08), "zh").otherwise("en")


def bounded_text(text: Column, cap: int) -> Column:
    """Line separators to spaces, cut at cap with a mark, empty to null."""
    t = F.translate(text, "\u0085\u000b\u000c  ", "     ")
    return F.when(F.length(t) == 0, None).when(F.length(t) > cap, F.concat(F.substring(t, 1, cap), F.lit(TRUNCATED))).otherwise(t)


def clip(text: Column, n: int) -> Column:
    t = F.coalesce(text, F.lit(""))
    return F.when(F.length(t) > n, F.concat(F.substring(t, 1, n), F.lit(TRUNCATED))).otherwise(t)


def numbers(text: Column) -> Column:
    return F.array_sort(F.array_distinct(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"\d+(?:\.\d+)?"), 0)))


def grouped_numbers(text: Column) -> Column:
    """Numeric tokens with thousands separators, separators left out."""
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"\d{1,3}(?:,\d{3})+(?:\.\d+)?|\d+(?:\.\d+)?"), 0)
    return F.transform(found, lambda x: F.replace(x, F.lit(","), F.lit("")))


def strip_inline_html(text: Column) -> Column:
    t = F.regexp_replace(F.coalesce(text, F.lit("")), "</?strong>", "**")
    return F.regexp_replace(F.regexp_replace(t, "</?code>", "`"), "</?(em|b|i|s|u)>", "**")


def md_to_html(text: Column) -> Column:
    """Bold and code spans of inline markdown to tags, links to their text, the rest escaped."""
    t = F.coalesce(text, F.lit(""))
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        t = F.replace(t, F.lit(char), F.lit(entity))
    t = F.regexp_replace(t, r"\[([^\]]+)\]\([^)]*\)", "$1")
    return F.regexp_replace(F.regexp_replace(t, r"(?s)\*\*(.+?)\*\*", "<strong>$1</strong>"), "`([^`]+)`", "<code>$1</code>")


def html_to_text(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), "<[^>]+>", "")


def weekday_cn(day: Column) -> Column:
    names = F.array(*[F.lit(x) for x in "一二三四五六日"])
    return F.when(F.try_to_date(day, "yyyy-MM-dd").isNull(), "").otherwise(F.concat(F.lit("周"), F.element_at(names, F.weekday(F.try_to_date(day, "yyyy-MM-dd")) + 1)))


def score01(value: Column, default: float) -> Column:
    """0 to 1; over 1 is a percentage, what is no number the default."""
    x = value.try_cast("double")
    return F.when(x.isNull() | F.isnan(x), F.lit(default)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.when(x > 1, x / 100).otherwise(x))))


def slugify(text: Column, key: Column, unicode: bool = True) -> Column:
    """Lower-case letters, digits and single hyphens, at most 24; else n and the key's first eight."""
    t = _ascii(text) if unicode else F.regexp_replace(F.coalesce(text, F.lit("")), "[^\\x00-\\x7f]", "")
    t = F.lower(F.regexp_replace(F.regexp_replace(t, "[^A-Za-z0-9]+", "-"), "^-+|-+$", ""))
    t = F.regexp_replace(F.substring(t, 1, 24), "-+$", "")
    return F.when(F.length(t) >= 2, t).when(F.coalesce(key, F.lit("")) != "", F.concat(F.lit("n"), F.substring(key, 1, 8))).otherwise("item-0")


def tts_text_fix(text: Column) -> Column:
    """Letter-digit hyphens opened, white space collapsed."""
    t = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), "\\s+", " "))
    return F.regexp_replace(F.regexp_replace(t, "([A-Za-z])-(\\d)", "$1 $2"), "(\\d)-([A-Za-z])", "$1 $2")


def feature_text(title_zh: Column, title: Column, summary: Column) -> Column:
    named = F.coalesce(F.nullif(title_zh, F.lit("")), title, F.lit(""))
    return F.trim(F.concat(named, F.lit(" "), F.coalesce(summary, F.lit(""))))


def apply_aliases(text: Column, aliases: dict[str, list[str]]) -> Column:
    """Alias spellings to canonical names, the longest first, without case, on word edges where the alias is ASCII."""
    spelled = {re.sub(r"\s+", "", a).casefold(): name for name, also in sorted(aliases.items()) for a in (name, *also) if a.strip()}
    terms = sorted({a for name, also in aliases.items() for a in (name, *also) if a.strip()}, key=lambda a: (-len(a), a))
    alnum = "[0-9A-Za-z]"
    edged = [("(?<!" + alnum + ")" if re.match(alnum, a) else "") + r"\s*".join(map(re.escape, a.split())) + ("(?!" + alnum + ")" if re.search(alnum + "$", a) else "") for a in terms]
    found = re.compile("|".join(edged), re.I) if edged else None

    @F.pandas_udf(T.StringType())
    def rewrite(s: pd.Series) -> pd.Series:
        name = lambda m: spelled[re.sub(r"\s+", "", m[0]).casefold()]
        return s.map(lambda x: found.sub(name, x) if found and isinstance(x, str) else x or "")

    return rewrite(text)
