"""Very long texts in pieces of bounded size, cut where no word is split."""

from __future__ import annotations

import re
from collections.abc import Iterator

#: Characters or bytes of a piece, about; a longer word makes its piece longer.
PIECE = 1 << 22
_GAP, _GAP_BYTES = re.compile("[ \n]"), re.compile(b"[ \n]")


def cut(text, size: int = 0) -> Iterator:
    """The pieces of a string or bytes; together they are the text. A piece ends before a space or line end."""
    size, gap = size or PIECE, _GAP_BYTES if isinstance(text, bytes) else _GAP
    at = 0
    while len(text) - at > size:
        found = gap.search(text, at + size)
        if not found:
            break
        yield text[at : found.start()]
        at = found.start()
    yield text[at:] if at else text
