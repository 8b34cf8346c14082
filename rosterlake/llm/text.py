"""Reading texts regardless of case, markup, invisible characters, accents and width."""

from __future__ import annotations

import html
import re
import unicodedata

_INLINE = re.compile(r"</?(?:b|i|em|strong|span|u|a|font|mark|sup|sub|small|s|code|tt)(?:\s[^<>]*)?/?>", re.I)
_TAG = re.compile(r"<!--.*?-->|</?[A-Za-z][^<>]*>", re.S)
_HYPHEN_END = re.compile(r"(?<=[^\W\d_])[-‐‑]\s*\n\s*(?=[^\W\d_])")
_SOFT_END = re.compile(r"(?<=[^\W\d_])\xad\s*\n\s*(?=[^\W\d_])")
_APOSTROPHE = re.compile(r"(?<=\w)['‘’ʼ](?=\w)")
_WORD = re.compile(r"[^\W_]+")


def words(text: str | None) -> list[str]:
    """The words of a text in order, with everything set aside that writing may change.

    Set aside are case, punctuation, accents, markup (tags and entities),
    invisible characters, spacing, line-end hyphens and the width of letters.
    None and texts without words give an empty list.
    """
    if not text:
        return []
    if "<" in text:
        text = _TAG.sub(" ", _INLINE.sub("", text))
    if "&" in text:
        text = html.unescape(text)
        if "<" in text:
            text = _TAG.sub(" ", _INLINE.sub("", text))
    if not text.isascii():
        text = _SOFT_END.sub("", text)
        text = unicodedata.normalize("NFKD", text)
        text = "".join(c for c in text if c.isascii() or unicodedata.category(c) not in ("Mn", "Cf", "Cc", "Me"))
    text = _HYPHEN_END.sub("", text)
    return _WORD.findall(_APOSTROPHE.sub("", text).casefold())
