"""Text functions on titles and other strings, as JVM expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words of the domain that a tokeniser must not split; fixed values.
DOMAIN_WORDS = [
    "鬼畜", "混剪", "VLOG", "vlog", "MAD", "MMD", "AMV",
    "翻唱", "手书", "宅舞", "国创", "新番", "测评", "开箱",
]
# Added for feature extraction; fixed values.
FEATURE_DOMAIN_WORDS = ["教程", "攻略", "实况", "解说", "盘点", "科普"]

# Opening and closing brackets of any kind may pair with each other; fixed values.
BRACKETED = r"(?d)[【\[（(].*?[】\]）)]"
LINK = r"(?U)https?://\S+"
NOT_WORD = r"[^一-鿿\p{L}\p{N}_]"

CJK = "一-鿿"


def clean_title(text: Column) -> Column:
    """Text without bracketed parts, links and punctuation; a missing text becomes empty."""
    out = F.coalesce(text, F.lit(""))
    out = F.regexp_replace(out, BRACKETED, "")
    out = F.regexp_replace(out, LINK, "")
    out = F.regexp_replace(out, NOT_WORD, " ")
    return F.trim(out)


def words(text: Column, pattern: str) -> Column:
    """All matches of `pattern`, in order."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def title_tokens(text: Column, keep_whole: list[str] = DOMAIN_WORDS) -> Column:
    """Tokens of a cleaned title: domain words, other words, and pairs of neighbouring CJK characters.

    A word in letters is one token anyway, so only CJK domain words need a place in the pattern.
    """
    whole = sorted((w for w in keep_whole if re.fullmatch(f"[{CJK}]+", w)), key=len, reverse=True)
    run = "(?:" + "".join(f"(?!{w})" for w in whole) + f"[{CJK}])+"
    letters = rf"[\p{{L}}\p{{N}}_&&[^{CJK}]]+"
    pieces = F.regexp_extract_all(text, F.lit("(" + "|".join([*whole, run, letters]) + ")"), 1)

    def split_run(piece: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.length(piece) - 1, F.lit(1)))
        is_run = piece.rlike(f"^[{CJK}]+$") & ~piece.isin(*whole) if whole else piece.rlike(f"^[{CJK}]+$")
        pairs = F.transform(starts, lambda i: F.substring(piece, i, F.lit(2)))
        return F.when(is_run, pairs).otherwise(F.array(piece))

    return F.filter(F.flatten(F.transform(pieces, split_run)), lambda w: F.length(w) >= 2)


def text_length(text: Column) -> Column:
    return F.length(F.coalesce(text, F.lit("")))


def has_text(text: Column) -> Column:
    return (text_length(text) > 0).cast("int")


def has_value(value: Column) -> Column:
    return value.isNotNull().cast("int")


def contains_search(text: Column, search: str) -> Column:
    """Case-insensitive substring test; % and _ in the search keep their wildcard meaning."""
    return text.ilike(f"%{search}%")


def short_label(text: Column, longest: int = 6, kept: int = 5) -> Column:
    return F.when(F.length(text) > longest, F.concat(F.substring(text, 1, kept), F.lit("…"))).otherwise(text)


def field_if_object(text: Column, field: str, cast: str = "string") -> Column:
    """A field of a value that is usually a plain string but sometimes a JSON object, else null."""
    return F.get_json_object(F.when(F.ltrim(text).startswith("{"), text), f"$.{field}").try_cast(cast)


def keyword_flags(text: Column, words_found: list[str], prefix: str) -> list[Column]:
    """One 0/1 column per keyword; plain substring test."""
    return [
        F.coalesce(text.contains(w), F.lit(False)).cast("int").alias(f"{prefix}{w}") for w in words_found
    ]


def stable_hash(value: Column) -> Column:
    """A 28-bit number from md5, the same in every engine and session."""
    return F.conv(F.substring(F.md5(value.cast("string")), 1, 7), 16, 10).cast("int")
