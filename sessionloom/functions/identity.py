"""Identity predicates and agent patterns."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, functions as F

# Texts that mean "no identity" after trimming and lower-casing.
PLACEHOLDERS = ("unknown", "null", "")

# Lower-case fragments that mark an automated user agent.
BOT_WORDS = (
    "bot", "crawler", "spider", "scraper", "headless",
    "urllib", "python-requests", "python-urllib", "curl", "wget", "go-http-client", "httpclient",
    "postman", "lighthouse", "monitoring",
    "ahrefs", "semrush", "dotbot", "rogerbot", "exabot", "mj12bot", "datanyze",
    "googlebot", "adsbot", "bingbot", "baiduspider", "yandexbot", "facebookexternalhit",
    "gptbot", "claudebot", "perplexitybot", "applebot", "ccbot",
    "mediapartners-google", "ia_archiver", "petalbot", "grobbot", "deepseekbot",
)


def _deciding(words: tuple[str, ...]) -> list[str]:
    """Words that contain no other listed word; the rest can never decide a match."""
    return [w for w in words if not any(o != w and o in w for o in words)]


def bot_pattern(words: tuple[str, ...] = BOT_WORDS) -> str:
    """Case-insensitive regex that finds any of ``words``."""
    return "(?i)(" + "|".join(re.escape(w).replace(r"\-", "-") for w in _deciding(words)) + ")"


def is_bot(agent: Column, lowered: Column, words: tuple[str, ...] = BOT_WORDS) -> Column:
    """Whether an agent holds any of ``words``, in any case.

    ASCII agents are searched in ``lowered``, several times faster than the regex. The
    regex ignores case for ASCII letters only, so other agents are left to it.
    """
    ascii_only = F.octet_length(agent) == F.length(agent)
    found = reduce(lambda a, b: a | b, [lowered.contains(w) for w in _deciding(words)])
    return F.when(ascii_only, found).otherwise(agent.rlike(bot_pattern(words)))


def valid_identity(c: Column) -> Column:
    """True when a value names somebody; never null."""
    text = F.lower(F.trim(c.cast("string")))
    return F.coalesce(~text.isin(*PLACEHOLDERS), F.lit(False))


def resolved_identity(primary: Column, fallback: Column) -> Column:
    """``primary`` where it is valid, else ``fallback`` as it is."""
    return F.coalesce(F.when(valid_identity(primary), primary.cast("string")), fallback.cast("string"))
