"""Where this Python's Unicode tables are newer or older than those of the tokenizer libraries."""

from __future__ import annotations

import re

#: Code points (hex) that this regex library takes as letters or numbers and the tokenizer library, whose
#: Unicode tables are older, doesn't; and capitals that only the tokenizer library puts in lower case.
NOT_LETTERS = """558 58b-58c 88f c5c cdc 208f 209d-209f a7ce-a7cf a7d2 a7d4 a7dd a7e2 a7f1 ab6c-ab6d 107bb-107bf 10940-10959
10ec5-10ec7 10ed9-10eee 11b0a 11db0-11ddb 11df1 16ea0-16eb8 16ebb-16ed3 16ff2-16ff3 187f8-187ff 18cd6-18cda 18d09-18d20
18d80-18df2 18e00-19191 191a0-191d2 1b123-1b128 1b168 1d6a6 1df1f-1df24 1df2b-1df81 1df90-1df96 1dfcd-1dfff 1e6c0-1e6de
1e6e0-1e6e2 1e6e4-1e6e5 1e6e7-1e6ed 1e6f0-1e6f4 1e6fe-1e6ff 2b73a-2b73f 2b81e 2cea2-2cead 323b0-33479 3d000-3fc3f"""
NOT_NUMBERS = "11de0-11de9 1246f 12475-1247f 12550-12686 16ff4-16ff6"
NEW_CAPITALS = {0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B}
NEW_CAPITALS |= {c: c + 0x20 for c in range(0x10D50, 0x10D66)} | {c: c + 0x1B for c in range(0x16EA0, 0x16EB9)}


def char_class(ranges: str) -> str:
    return "".join("-".join(chr(int(c, 16)) for c in r.split("-")) for r in ranges.split())


_RECENT = re.compile(f"[{char_class(NOT_LETTERS)}{char_class(NOT_NUMBERS)}{''.join(map(chr, NEW_CAPITALS))}]")


def recent(text: str) -> bool:
    """Whether a text holds any of these code points; hardly any does."""
    if text.isascii():
        return False
    try:  # none of them is in Latin-1, which is quick to tell
        text.encode("latin-1")
    except UnicodeEncodeError:
        return _RECENT.search(text) is not None
    return False


def older(pattern: str) -> str:
    """The pattern with letters and numbers as the tokenizer libraries know them."""
    return "(?V1)" + pattern.replace(r"\p{L}", rf"[\p{{L}}--[{char_class(NOT_LETTERS)}]]").replace(r"\p{N}", rf"[\p{{N}}--[{char_class(NOT_NUMBERS)}]]")
