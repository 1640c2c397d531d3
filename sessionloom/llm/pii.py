"""Personal data by anchor expansion.

One Aho-Corasick pass over the whole text, lower-cased from A to Z, finds anchors: at-signs, plus
signs, digits, scheme marks, words that announce an identifier or a credential, and the
beginnings of well-known keys. From each anchor a deterministic local parser
expands to the left and right and validates what it found. Parsers look at the text around
an anchor only, move forward, and never look at a character more than a few times.

Base kinds equal the leftmost non-overlapping matches, kind by kind, of
``email``  [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+
``ip``     [0-9]+(\\.[0-9]+)(\\.[0-9]+)(\\.[0-9]+), each part at most 255
``card``   [0-9]([\\x20-]?[0-9])+, 12 to 19 digits that pass the Luhn test
``phone``  \\+[0-9][\\x20().0-9-]+[0-9], 9 to 15 digits
where a match that fails its test is dropped and the search goes on behind it. The anchors
add kinds that may overlap those: ``url`` (a known scheme, ``://`` and a host), ``login`` (the user
and password of a URL, without the at-sign), ``iban`` (behind its cue, tested modulo 97), ``account`` (5 to 24 letters,
digits and hyphens with at least three digits, behind a cue) and ``secret``: a value behind a
credential cue and a colon or equals sign or in quotation marks, that looks drawn at random (12
characters or more, six of them different, letters and digits; behind a password cue 6 are enough);
a key that is known by its beginning; a private key block. Cues count in any case.

Defined results: null and empty texts have no spans; offsets count code points, the end is
exclusive; equal texts have equal spans; texts of any length are searched whole; other
columns pass through unchanged. A row's result depends on the row alone: no shuffle.
"""

from __future__ import annotations

import re
from functools import lru_cache

import ahocorasick
from pyspark.sql import Column, DataFrame, functions as F, types as T

from sessionloom.llm.common import LOWER, UPPER, free_names, map_text

# The kinds in the order in which spans that start together are listed.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "url", "login", "iban", "account", "secret")
# What announces an address or an identifier.
SCHEMES = ("http", "https", "ftp", "ftps", "sftp", "ws", "wss")
ACCOUNT_CUES = (
    "account", "acct", "passport", "ssn", "social security", "customer id", "customer", "member id", "member", "policy", "licence", "license",
    "tax id", "national id", "patient id", "konto", "compte", "cuenta",
)
IBAN_CUE = "iban"
SECRET_CUES = (
    "token", "secret", "api key", "api_key", "api-key", "apikey", "access key", "access_key", "secret key", "secret_key", "private key",
    "client_secret", "auth", "authorization", "bearer", "credential", "credentials",
)
PASSWORD_CUES = ("password", "passwd", "pwd", "passphrase", "passwort", "mot de passe")
# Public formats of keys by their beginning.
KEY_FORMS = {
    "akia": r"AKIA[0-9A-Z]{16}(?![0-9A-Za-z])", "asia": r"ASIA[0-9A-Z]{16}(?![0-9A-Za-z])", "ghp_": r"ghp_[0-9A-Za-z]{36}(?![0-9A-Za-z])",
    "glpat-": r"glpat-[0-9A-Za-z_-]{20,}", "xoxb-": r"xoxb-[0-9A-Za-z-]{20,}", "aiza": r"AIza[0-9A-Za-z_-]{35}(?![0-9A-Za-z_-])",
    "-----begin ": r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----(?:[0-9A-Za-z+/=\s]*-----END [A-Z ]{0,30}PRIVATE KEY-----)?",
    "eyj": r"eyJ[0-9A-Za-z_-]{10,}\.eyJ[0-9A-Za-z_-]{10,}\.[0-9A-Za-z_-]{10,}",
}

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGITS = re.compile(r"[0-9]+")
_IP = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_USERINFO = re.compile(r"([^\s<>\"'/?#@:]+:[^\s<>\"'/?#@]+)@(?=[A-Za-z0-9_-])")
_HOST = re.compile(r"(?:[A-Za-z0-9_-]+\.)*[A-Za-z0-9_-]+(?::[0-9]{1,5})?(?:[/?#][^\s<>\"']*)?")
_GAP = re.compile(r"(?:[\x20\t]{0,2}(?:no\.?|number|nr\.?))?[\x20\t]{0,2}[:=#]?[\x20\t]{0,2}", re.IGNORECASE)
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?:[\x20]?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_SECRET_GAP = re.compile(r"[\x20\t]{0,2}(?:is[\x20\t])?[\x20\t]{0,2}(?:[\"']?[\x20\t]{0,2}(?:[:=]{1,2}|=>)[\x20\t]{0,2}(?:(?:bearer|basic)[\x20\t])?([\"']?)|([\"']))", re.IGNORECASE)
_BARE_GAP = re.compile(r"[\x20\t]{1,2}")
_SECRET = re.compile(r"[0-9A-Za-z_+/.~!$%^&*@#-]+=*")
_KEYS = {start: re.compile(form) for start, form in KEY_FORMS.items()}
_LOWERED = str.maketrans(UPPER, LOWER)
_ACCOUNT = re.compile(r"[A-Za-z0-9](?:-?[A-Za-z0-9]){4,23}(?![A-Za-z0-9-])")

SPANS = T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
]))


@lru_cache(maxsize=1)
def _anchors() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for digit in "0123456789":
        found.add_word(digit, ("digit", 1))
    found.add_word("@", ("at", 1))
    found.add_word("+", ("plus", 1))
    found.add_word("://", ("scheme", 3))
    for kind, cues in (("iban", (IBAN_CUE,)), ("account", ACCOUNT_CUES), ("secret", SECRET_CUES), ("password", PASSWORD_CUES)):
        for cue in cues:
            found.add_word(cue, (kind, len(cue)))
    for start in KEY_FORMS:
        found.add_word(start, ("key", len(start)))
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else n * 2 - 9 * (n > 4)
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and part <= "255"


def _email(text: str, at: int, free: int) -> tuple[int, int] | None:
    start = at
    while start > free and text[start - 1] in _LOCAL:
        start -= 1
    if start == at or not (domain := _DOMAIN.match(text, at + 1)):
        return None
    return start, domain.end()


def _url(text: str, at: int) -> tuple[int, int] | None:
    start = at
    while start > 0 and at - start < 6 and text[start - 1].isascii() and text[start - 1].isalpha():
        start -= 1
    user = _USERINFO.match(text, at + 3)
    if text[start:at].lower() not in SCHEMES or not (host := _HOST.match(text, user.end() if user else at + 3)):
        return None
    end = host.end()
    while text[end - 1] in ".,;:!?)":
        end -= 1
    return (start, end) if end > at + 3 else None


def _iban(text: str, start: int) -> tuple[int, int] | None:
    found = _IBAN.match(text, _GAP.match(text, start).end())
    if not found:
        return None
    plain = found[0].replace(" ", "")
    if len(plain) > 34 or int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 != 1:
        return None
    return found.span()


def _login(text: str, at: int) -> tuple[int, int] | None:
    """The user and password of the URL whose ``://`` is at ``at``."""
    found = _USERINFO.match(text, at + 3)
    return found.span(1) if found else None


def _secret(text: str, start: int, least: int) -> tuple[int, int] | None:
    """A value behind a credential cue; where nothing sets it off from prose it has to be longer."""
    gap = _SECRET_GAP.match(text, start)
    quote = (gap[1] or gap[2] or "") if gap else ""
    if not gap:
        gap, least = _BARE_GAP.match(text, start), max(20, least)
    found = _SECRET.match(text, gap.end()) if gap else None
    if not found:
        return None
    value = found[0]
    if not quote:
        value = value.rstrip(".!*")
    if len(value) < least or len(set(value)) < min(6, least):
        return None
    digits = sum("0" <= c <= "9" for c in value)
    if not digits or digits == len(value):
        return None
    return found.start(), found.start() + len(value)


def _account(text: str, start: int) -> tuple[int, int] | None:
    found = _ACCOUNT.match(text, _GAP.match(text, start).end())
    return found.span() if found and sum(c.isdigit() for c in found[0]) >= 3 else None


def spans_of(text: str) -> list[tuple[str, int, int]]:
    """All spans by start, then kind."""
    out: list[tuple[str, int, int]] = []
    email = ip = card = phone = 0  # behind the last match of the kind
    for end, (anchor, length) in _anchors().iter(text.translate(_LOWERED)):  # one code point for one: offsets stay
        at = end + 1 - length
        if anchor == "digit":
            if at >= card:
                if found := _CARD.match(text, at):
                    card = found.end()
                    digits = found[0].replace(" ", "").replace("-", "")
                    if 12 <= len(digits) <= 19 and luhn(digits):
                        out.append(("card", at, card))
                else:
                    card = at + 1
            if at >= ip:
                if found := _IP.match(text, at):
                    ip = found.end()
                    if all(map(_small, found[0].split("."))):
                        out.append(("ip", at, ip))
                else:
                    ip = _DIGITS.match(text, at).end()
        elif anchor == "at":
            if at >= email and (found := _email(text, at, email)):
                email = found[1]
                out.append(("email", *found))
        elif anchor == "plus":
            if at >= phone and (found := _PHONE.match(text, at)):
                phone = found.end()
                if 9 <= sum(c.isdigit() for c in found[0]) <= 15:
                    out.append(("phone", *found.span()))
        elif anchor == "scheme":
            if found := _url(text, at):
                out.append(("url", *found))
                if login := _login(text, at):
                    out.append(("login", *login))
        elif anchor == "key":
            if (at == 0 or not text[at - 1].isalnum()) and (found := _KEYS[text[at : end + 1].translate(_LOWERED)].match(text, at)):
                out.append(("secret", *found.span()))
        elif (at == 0 or not text[at - 1].isalnum()) and not text[end + 1 : end + 2].isalpha():
            if anchor in ("secret", "password"):
                if found := _secret(text, end + 1, 12 if anchor == "secret" else 6):
                    out.append(("secret", *found))
            elif found := (_iban if anchor == "iban" else _account)(text, end + 1):
                out.append((anchor, *found))
    return sorted(set(out), key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def find(docs: DataFrame, text: str = "text", spans: str = "spans") -> DataFrame:
    """Add ``spans`` (array of kind, start, end) of every text."""
    if free_names(docs, spans) != [spans]:
        raise ValueError(f"{spans} is a column already")

    def make():
        return lambda texts: [[[dict(zip(("kind", "start", "end"), s)) for s in spans_of(t)] for t in texts]]

    return map_text(docs, [T.StructField(spans, SPANS)], make, text)


def listed(spans: Column) -> Column:
    """``kind:start:end`` of the spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def of_kind(spans: Column, *kinds: str) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


def redact(df: DataFrame, text: str = "text", spans: str = "spans", out: str = "redacted") -> DataFrame:
    """Add the text with each span replaced by ``[kind]``; of overlapping spans the first one counts."""
    t = F.coalesce(F.col(text), F.lit(""))
    begin = F.struct(F.lit("").alias("done"), F.lit(0).alias("at"))

    def step(state, s):
        kept = F.substring(t, state["at"] + 1, s["start"] - state["at"])
        done = F.concat(state["done"], kept, F.lit("["), s["kind"], F.lit("]"))
        return F.when(s["start"] < state["at"], state).otherwise(F.struct(done.alias("done"), s["end"].alias("at")))

    rest = lambda state: F.concat(state["done"], F.substring(t, state["at"] + 1, F.char_length(t)))
    return df.withColumn(out, F.aggregate(spans, begin, step, rest))
