"""Quality of a record in five scores between 0 and 1, weighted to one; all built-in expressions."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from sedimenta.functions.text import let, lines, strip

# Languages that count as known, beginnings of comment lines, signs of generated files, good characters.
KNOWN_LANGUAGES = (
    "python", "javascript", "typescript", "java", "c", "c++", "c#", "go", "rust", "ruby", "php", "swift", "kotlin", "scala", "r", "matlab", "shell", "bash", "sql", "html", "css", "markdown", "haskell", "ocaml", "erlang", "elixir", "clojure", "julia", "lua", "perl",
)
COMMENT = r"^(?:#|//|--|;|%|/\*|\*|\"\"\"|''')"
AUTOGEN_PATTERNS = (r"auto[-_]?generated", r"\bdo\s+not\s+edit\b", r"generated\s+by\b", r"@generated", r"this\s+file\s+is\s+generated", r"machine[-_]generated", r"automatically\s+generated")
NOT_GOOD = r"[^\p{L}\p{N} \t\n\r_.,()\[\]{}:;\"'=\-+*/\\|<>!@#$%^&~`]"
AUTOGEN_CHARS = 2000


@dataclass(frozen=True)
class QualityConfig:
    """Weights, thresholds and patterns. ``from_settings`` follows a settings file: patterns left out there mean none."""

    token_weight: float = 0.25
    alpha_weight: float = 0.20
    comment_weight: float = 0.20
    autogen_weight: float = 0.20
    language_weight: float = 0.15
    min_score: float = 0.30
    min_tokens: int = 10
    max_tokens: int = 8192
    min_alpha_ratio: float = 0.25
    max_comment_ratio: float = 0.80
    autogen_patterns: tuple[str, ...] = field(default=AUTOGEN_PATTERNS)

    @classmethod
    def from_settings(cls, settings: dict) -> QualityConfig:
        known = {k: v for k, v in settings.items() if k in cls.__dataclass_fields__}
        return cls(**known | {"autogen_patterns": tuple(settings.get("autogen_patterns") or ())})


def token_score(text: Column, low: int = 10, high: int = 8192) -> Column:
    """0 outside [low, high] estimated tokens, 1 in the middle 80 %, linear in between."""
    n, span = F.length(text) / 4.0, float(max(high - low, 1))
    up, down = low + 0.10 * span, low + 0.90 * span
    return (
        F.when(text.isNull() | (n == 0) | (n < low) | (n > high), 0.0)
        .when(n <= up, (n - low) / max(up - low, 1e-9))
        .when(n >= down, (high - n) / max(high - down, 1e-9))
        .otherwise(1.0)
    )


def alpha_score(text: Column, least: float = 0.25) -> Column:
    """1 from the share ``least`` of good characters on, the share divided by it below; 0 for an empty text."""
    share = F.length(F.regexp_replace(text, NOT_GOOD, "")) / F.nullif(F.length(text), F.lit(0))
    return let(share, lambda s: F.when(s.isNull(), 0.0).when(s < least, s / max(least, 1e-9)).otherwise(1.0))


def comment_score(text: Column, most: float = 0.80) -> Column:
    """1 up to the share ``most`` of comment lines, down to 0 for nothing else; 0 without any line."""
    share = let(lines(text), lambda all_: F.size(F.filter(all_, lambda x: x.rlike(COMMENT))) / F.nullif(F.size(all_), F.lit(0)))
    return let(share, lambda s: F.when(s.isNull(), 0.0).when(s > most, F.greatest(F.lit(0.0), 1.0 - (s - most) / max(1.0 - most, 1e-9))).otherwise(1.0))


def autogen_score(text: Column, patterns: tuple[str, ...] = AUTOGEN_PATTERNS) -> Column:
    """0 if the first 2000 characters say that the file is generated, else 1."""
    if not patterns:
        return F.lit(1.0)
    return F.when(F.substring(text, 1, AUTOGEN_CHARS).rlike("(?iuU)" + "|".join(f"(?:{p})" for p in patterns)), 0.0).otherwise(1.0)


def language_score(language: Column) -> Column:
    return F.when(strip(F.lower(language)).isin(*KNOWN_LANGUAGES), 1.0).otherwise(0.5)


def quality(text: Column, language: Column, c: QualityConfig = QualityConfig()) -> Column:
    """The weighted score, unrounded: what thresholds are applied to."""
    return (
        c.token_weight * token_score(text, c.min_tokens, c.max_tokens)
        + c.alpha_weight * alpha_score(text, c.min_alpha_ratio)
        + c.comment_weight * comment_score(text, c.max_comment_ratio)
        + c.autogen_weight * autogen_score(text, c.autogen_patterns)
        + c.language_weight * language_score(language)
    )
