"""Splitting texts into the pieces that byte-level BPE encodes separately."""

import re
import sys
import unicodedata

import public_tokenizers
import regex

PATTERN = public_tokenizers.PATTERN


def recent_letters() -> str:
    """A class of the letters and numbers that this Python's Unicode tables do not know yet.

    Libraries built on older tables may split at these; texts with any of them
    are left to the library.
    """
    every = "".join(chr(i) for i in range(0x80, sys.maxunicode + 1) if not 0xD800 <= i < 0xE000)
    found = [ord(c) for c in regex.findall(r"[\p{L}\p{N}]", every) if unicodedata.category(c) == "Cn"]
    parts, at = [], 0
    while at < len(found):
        end = at
        while end + 1 < len(found) and found[end + 1] == found[end] + 1:
            end += 1
        parts.append(f"{chr(found[at])}-{chr(found[end])}")
        at = end + 1
    return "[" + "".join(parts) + "]" if parts else "(?!)"


def is_latin(text: str) -> bool:
    """Whether all characters are below U+0100."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def latin_pattern(pattern: str) -> str | None:
    """The pattern for texts in Latin-1, with its Unicode classes written out; None if it has others than letters, numbers and space."""
    for name in (r"\s", r"\p{L}", r"\p{N}"):
        held = "".join(re.escape(chr(c)) for c in range(256) if regex.fullmatch(name, chr(c)))
        inside = re.sub(r"\[[^\]]*\]", lambda found: found[0].replace(name, held), pattern)  # noqa: B023
        pattern = inside.replace(name, f"[{held}]")
        if name == r"\s":
            pattern = pattern.replace(r"\S", f"[^{held}]")
    return None if re.search(r"\\[pPdDwWbBsS]|\[\[:", pattern) else pattern


class Splitter:
    """Pieces of a text by the public pattern, as both tokenizer libraries make them."""

    def __init__(self, pattern: str = PATTERN, recent: str | None = None):
        self.pattern = pattern
        self._find = regex.compile(pattern).findall
        narrow = latin_pattern(pattern)
        self._find_latin = self._find if narrow is None else re.compile(narrow).findall
        self.recent = regex.compile(recent or recent_letters()).search
        self._library = None

    def find(self, text: str) -> list[str]:
        """Pieces of a text without recent letters."""
        return (self._find_latin if is_latin(text) else self._find)(text)

    def by_library(self, text: str) -> list[str]:
        """The split of a text that holds recent letters."""
        from tokenizers import Regex, pre_tokenizers

        if self._library is None:
            self._library = pre_tokenizers.Split(Regex(self.pattern), "isolated")
        return [piece for piece, _ in self._library.pre_tokenize_str(text)]
