"""Whole texts to pre-tokens, so that each distinct one is encoded once in a task.

Libraries differ in what their patterns call a letter, a number or white space beyond common scripts.  A text with
such characters is therefore left to the tokenizers library; in the others a letter is a word character that is no
digit or underscore.
"""

from __future__ import annotations

import re

#: Control characters, numbers that are no digits, and whatever lies beyond Latin letters, common punctuation and symbols.
UNUSUAL = re.compile("[^\t\n\r -~\xa1-\xb1\xb4-\xb8\xba\xbb\xbf-ɏ‐-‧‰-⁞€]")
#: How the byte-level and the word vocabulary split a text, the latter in lower case.
BYTE_LEVEL = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
WORD_LEVEL = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+")
#: Distinct pre-tokens that a task remembers.
REMEMBERED = 600_000


def usual(text: str) -> bool:
    return UNUSUAL.search(text) is None


def byte_symbols() -> list[str]:
    """The printable character by which byte vocabularies write each byte: itself, or else the next ones from 256."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in own]
    return [chr(b) if b in own else chr(256 + others.index(b)) for b in range(256)]
