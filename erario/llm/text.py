"""Plain forms of text that the operators on documents share."""

from __future__ import annotations

import re
import unicodedata

_BROKEN = re.compile("[Â-ô][\u0080-ÿŒœŠšŸŽžƒˆ˜–-›€™]+")
_TAG = re.compile(r"<[^<>]{1,40}>")
_TOKEN = re.compile(r"[a-z]+|[0-9]+")
_SENTENCE = re.compile(r"(?<=[.!?;:])\s+|\n+|\|")
_MARKS = re.compile("[\u0300-\u036f]+")


def _byte(c: str) -> bytes:
    try:
        return c.encode("cp1252")
    except UnicodeEncodeError:
        return c.encode("latin-1", "replace")


def repaired(text: str) -> str:
    """``text`` with runs of UTF-8 that was read as an 8-bit code put right; what isn't valid UTF-8 stays."""

    def fix(m: re.Match) -> str:
        try:
            return b"".join(map(_byte, m.group())).decode("utf-8")
        except UnicodeDecodeError:
            return m.group()

    return _BROKEN.sub(fix, text) if ("Ã" in text or "Â" in text) else text


def plain(text: str) -> str:
    """Lower case without accents, markup tags or broken encoding."""
    text = _TAG.sub("\n", repaired(text)) if "<" in text else repaired(text)
    return (text if text.isascii() else _MARKS.sub("", unicodedata.normalize("NFKD", text))).lower()


def tokens(text: str) -> list[str]:
    """Words and runs of digits of the plain text, in order."""
    return _TOKEN.findall(plain(text))


def sentences(text: str) -> list[str]:
    """Plain sentences; line ends, table cells, semicolons and colons end one too."""
    return [s for s in _SENTENCE.split(plain(text)) if s and not s.isspace()]
