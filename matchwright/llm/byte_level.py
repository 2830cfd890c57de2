"""Byte-level vocabularies: bytes behind their letters, and runs of text.

Such a tokenizer never joins what comes before a run of white space with the
run, so a text can be cut there and each distinct run be worked on once.
"""

from __future__ import annotations

import re

# Unicode's White_Space, as the tokenizer's own engine has it
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WHITE_RUN = re.compile(f"[{WHITE}]*")
RUNS = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")


def letter_bytes() -> dict[str, int]:
    """The byte of each letter of the byte-level alphabet.

    Printable bytes stand for themselves, the others follow from U+0100 on.
    """
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def token_bytes(token: str, letters: dict[str, int]) -> bytes:
    return bytes(letters[c] for c in token)
