"""Words as the contracts define them, in plain Python."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(lowered)
