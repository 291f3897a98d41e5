"""A declarative item filter, compiled to one Catalyst predicate.

A criterion that is given is on; there are no separate switches. Cheap
comparisons come before regular expressions, and each polarity of each tag
column is one alternation.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import tags, values


@dataclass(frozen=True)
class ColumnBinding:
    """Which input columns hold what; None where the input has none."""

    id: str = "id"
    tags: str | None = "tag_string"
    character: str | None = "tag_string_character"
    copyright: str | None = "tag_string_copyright"
    artist: str | None = "tag_string_artist"
    meta: str | None = "tag_string_meta"
    score: str | None = "score"
    rating: str | None = "rating"
    width: str | None = "image_width"
    height: str | None = "image_height"
    url: str | None = "file_url"

    def canonical(self, df: DataFrame, number_policy: str = "zero", required: tuple[str, ...] = ()) -> DataFrame:
        """Canonical names and types; bindings without a column are left out, an error for required ones."""
        lacking = [name for name in required if getattr(self, name) not in df.columns]
        if lacking:
            raise ValueError(f"no columns for {', '.join(lacking)}")
        out = []
        for name, source in self.__dict__.items():
            if source is None or source not in df.columns:
                continue
            col = F.col(source)
            if name == "id":
                col = col.cast("bigint")
            elif name in ("tags", "character", "copyright", "artist", "meta"):
                col = tags.normalise(col)
            elif name == "rating":
                col = F.coalesce(F.lower(col.cast("string")), F.lit(""))
            elif name in ("score", "width", "height"):
                if number_policy == "zero":
                    whole = isinstance(df.schema[source].dataType, T.IntegralType)
                    col = F.coalesce(col.cast("bigint"), F.lit(0).cast("bigint")) if whole else values.lenient_int(col.cast("string"))
                else:
                    col = values.strict_int(col, -1 if name == "score" else 0)
            out.append(col.alias(name))
        return df.select(*out)


@dataclass(frozen=True)
class TagRule:
    include_all: tuple[str, ...] = ()
    include_any: tuple[str, ...] = ()
    exclude: tuple[str, ...] = ()

    def column(self, col: Column, dialect: str) -> Column | None:
        parts = []
        if self.include_all:
            parts.append(tags.all_of(col, self.include_all, dialect))
        if self.include_any:
            parts.append(tags.any_of(col, self.include_any, dialect))
        if self.exclude:
            parts.append(tags.none_of(col, self.exclude, dialect))
        return _all(parts)


@dataclass(frozen=True)
class FilterSpec:
    tags: TagRule = field(default_factory=TagRule)
    character: TagRule = field(default_factory=TagRule)
    copyright: TagRule = field(default_factory=TagRule)
    artist: TagRule = field(default_factory=TagRule)
    min_score: int | None = None
    ratings: tuple[str, ...] = ()
    rating_classes: int = 4
    square: bool = False
    min_square: int = 0
    min_width: int = 0
    max_width: int = 0
    min_height: int = 0
    max_height: int = 0
    exclude_extensions: tuple[str, ...] = ()
    exclude_video: bool = True
    exclude_gif: bool = False
    extension_case: bool = True
    keep_null_url: bool = True
    dialect: str = "token"

    def column(self, have: list[str] | None = None) -> Column:
        """The predicate over canonical columns; criteria of absent columns are an error."""
        F_ = F.col
        parts: list[Column] = []

        def need(name: str) -> Column:
            if have is not None and name not in have:
                raise ValueError(f"the filter needs column {name}")
            return F_(name)

        if self.min_score is not None:
            parts.append(need("score") >= self.min_score)
        if self.ratings:
            col = need("rating")
            if self.rating_classes == 3:
                wanted = {"s": "safe", "g": "safe", "general": "safe", "q": "questionable", "e": "explicit", "nsfw": "explicit"}
                parts.append(values.rating3(col).isin(*sorted({wanted.get(r.strip().lower(), r.strip().lower()) for r in self.ratings})))
            else:
                parts.append(col.isin(*values.rating_words(self.ratings)))
        if self.square:
            parts += [need("width") == need("height"), F_("width") >= self.min_square]
        else:
            for name in ("width", "height"):
                low, high = getattr(self, f"min_{name}"), getattr(self, f"max_{name}")
                if low > 0:
                    parts.append(need(name) >= low)
                if high > 0:
                    parts.append(need(name) <= high)
        endings = [*self.exclude_extensions, *([".gif"] if self.exclude_gif else [])]
        if self.exclude_video and have is not None and "url" in have:
            endings += values.VIDEO_EXTENSIONS
        if endings and (have is None or "url" in have):
            col = F_("url") if self.extension_case else F.lower("url")
            bad = _any([col.endswith(e) for e in endings])
            parts.append(F.coalesce(~bad, F.lit(self.keep_null_url)))
        for name in ("tags", "character", "copyright", "artist"):
            rule: TagRule = getattr(self, name)
            if rule != TagRule():
                parts.append(rule.column(need(name), self.dialect))
        return _all(parts) if parts else F.lit(True)

    def apply(self, df: DataFrame) -> DataFrame:
        return df.where(self.column(df.columns))

    def bounds(self) -> dict[str, tuple[int | None, int | None]]:
        """Least and greatest value of each numeric column that the filter bounds."""
        found = {"score": (self.min_score, None)}
        for name in ("width", "height"):
            if self.square:
                found[name] = self.min_square, None
            else:
                low, high = getattr(self, f"min_{name}"), getattr(self, f"max_{name}")
                found[name] = low if low > 0 else None, high if high > 0 else None
        return {k: v for k, v in found.items() if v != (None, None)}

    def apply_raw(self, df: DataFrame, binding: ColumnBinding, number_policy: str = "zero", required: tuple[str, ...] = ()) -> DataFrame:
        """Canonical rows of ``df`` that pass; bounds on integer columns are also stated
        on the columns as stored, so that a scan skips row groups by its statistics.

        Such a comparison follows from the filter, which still decides: a null stands
        for zero (or for -1, a missing score by the other policy), so it stays where
        that may pass."""
        for name, (low, high) in self.bounds().items():
            source = getattr(binding, name)
            if source is None or source not in df.columns or not isinstance(df.schema[source].dataType, T.IntegralType):
                continue
            col, null = F.col(source), -1 if number_policy != "zero" and name == "score" else 0
            for limit, stated, passes in ((low, col >= low, low is not None and null >= low), (high, col <= high, high is not None and null <= high)):
                if limit is not None:
                    df = df.where(stated | col.isNull() if passes else stated)
        return self.apply(binding.canonical(df, number_policy, required))

    def with_(self, **changes) -> FilterSpec:
        return replace(self, **changes)


def _all(parts: list[Column]) -> Column | None:
    out = None
    for p in parts:
        out = p if out is None else out & p
    return out


def _any(parts: list[Column]) -> Column:
    out = parts[0]
    for p in parts[1:]:
        out = out | p
    return out
