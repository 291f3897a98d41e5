"""Lenient numbers, ratings, file names and identifiers."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: rating words and letters, and the file types that are images
RATING_LETTERS = {"e": "explicit", "q": "questionable", "s": "safe", "g": "general"}
IMAGE_EXTENSIONS = [".jpg", ".jpeg", ".png", ".webp", ".gif"]
VIDEO_EXTENSIONS = [".zip", ".mp4", ".webm", ".swf"]


def lenient_int(col: Column) -> Column:
    """Long, from other text through double, zero where that fails ('12.7' is 12, 'abc' is 0).

    Text that is an integer stays exact beyond 2**53."""
    return F.coalesce(col.try_cast("bigint"), col.try_cast("double").try_cast("bigint"), F.lit(0).cast("bigint"))


def strict_int(col: Column, missing: int) -> Column:
    """Null becomes ``missing``; text that is no integer becomes null; numbers lose
    their fraction (NaN and what no long holds become null)."""
    return F.when(col.isNull(), F.lit(missing).cast("bigint")).otherwise(col.try_cast("bigint"))


def rating4(col: Column) -> Column:
    """explicit, questionable, safe, general or unknown, from words or letters."""
    key = F.trim(F.lower(col.cast("string")))
    out = F.lit("unknown")
    for letter, word in RATING_LETTERS.items():
        out = F.when(key.isin(letter, word), word).otherwise(out)
    return out


def rating3(col: Column) -> Column:
    """safe (general included), questionable, explicit (nsfw included), or the word itself."""
    key = F.coalesce(F.trim(F.lower(col.cast("string"))), F.lit(""))
    return (
        F.when(key.isin("s", "safe", "g", "general"), "safe")
        .when(key.isin("q", "questionable"), "questionable")
        .when(key.isin("e", "explicit", "nsfw"), "explicit")
        .otherwise(key)
    )


def rating_words(ratings: Iterable[str]) -> list[str]:
    """Each rating as its word and letter; unknown words are an error."""
    both = {k: [w, k] for k, w in RATING_LETTERS.items()} | {w: [w, k] for k, w in RATING_LETTERS.items()}
    out: list[str] = []
    for r in ratings:
        if r.strip().lower() not in both:
            raise ValueError(f"unknown rating {r!r}")
        out += both[r.strip().lower()]
    return sorted(set(out))


def extension(url: Column, known: Iterable[str] = IMAGE_EXTENSIONS) -> Column:
    """The image extension of a URL's last path segment, .jpg for any other."""
    ext = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"[^/.][^/]*(\.[^./]*)\z", 1))
    return F.when(ext.isin(*known), ext).otherwise(".jpg")


def base_name(path: Column) -> Column:
    """Last path segment, trimmed and lower-cased; blank for null."""
    text = F.rtrim(F.trim(F.coalesce(path, F.lit(""))), F.lit("/"))
    return F.lower(F.element_at(F.split(text, "/"), -1))


def id_from_key(key: Column) -> Column:
    """Last segment up to its first dot as an integer, else null."""
    return F.regexp_extract(key, r"([^/.]*)[^/]*\z", 1).try_cast("bigint")


def id_from_name(path: Column) -> Column:
    """The stem as an integer, else its first run of four digits or more, else null."""
    stem = F.regexp_replace(F.regexp_extract(path, r"([^/]*)\z", 1), r"(?<=.)\.[^.]*\z", "")
    return F.coalesce(stem.try_cast("bigint"), F.regexp_extract(stem, r"(\d{4,})", 1).try_cast("bigint"))


def floor_div(number: Column, by: int) -> Column:
    """Whole division rounded down, in long arithmetic: exact beyond 2**53."""
    number = number.cast("bigint")
    return F.call_function("div", number - F.pmod(number, F.lit(by).cast("bigint")), F.lit(by).cast("bigint"))


def shard_name(item_id: Column, files_per_shard: int) -> Column:
    return F.format_string("shard_%05d", floor_div(item_id, files_per_shard))


def archive_in_url(url: Column) -> tuple[Column, Column]:
    """(archive, inner path) of a URL with a .tar segment, null without one."""
    pattern = r"(?:^|/)([^/]*\.tar)/(.+)"
    archive = F.nullif(F.regexp_extract(url, pattern, 1), F.lit(""))
    return archive, F.nullif(F.regexp_extract(url, pattern, 2), F.lit(""))
