"""Text helpers shared by the corpus operators (Python side of Arrow UDFs)."""

from __future__ import annotations

import re
import unicodedata

WORD = re.compile(r"[^\W_]+")


def _marks() -> str:
    """Character class of the combining marks of the first two planes."""
    found = [c for c in range(0x300, 0x1F000) if unicodedata.combining(chr(c))]
    runs: list[list[int]] = []
    for c in found:
        if runs and runs[-1][1] == c - 1:
            runs[-1][1] = c
        else:
            runs.append([c, c])
    return "[" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in runs) + "]"


_LATIN_MARKS = re.compile("[\u0300-\u036f]+")
_MARKS = re.compile(_marks())
#: Blocks that hold further combining marks, roughly; a text without them needs no closer look.
_MAY_HOLD_MARKS = re.compile("[\u0483-\u0487\u0591-\u10ff\u135d-\u1dff\u20d0-\u20f0\u2cef-\u2dff\u302a-\u302f\u3099\u309a\ua66f-\uabff\ufb1e\ufe20-\ufe2f\U000101fd-\U0001efff]")


def fold(text: str) -> str:
    """Case folded, accents removed; Hangul syllables stay whole."""
    if text.isascii():
        return text.lower()
    apart = _LATIN_MARKS.sub("", unicodedata.normalize("NFKD", text))
    if _MAY_HOLD_MARKS.search(apart):
        apart = _MARKS.sub("", apart)
    return unicodedata.normalize("NFC", apart).casefold()


def words(text: str | None) -> list[str]:
    """Runs of letters and digits, without case and accents."""
    return WORD.findall(fold(text)) if text else []
