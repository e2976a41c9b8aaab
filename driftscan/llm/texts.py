"""Whole texts in bounded pieces."""

from __future__ import annotations

import re
from collections.abc import Iterator

_SPACE = re.compile(rb"[ \t\n\r\x0b\x0c]")


def blocks(text: bytes, size: int) -> Iterator[bytes]:
    """The text in pieces of about `size` bytes, cut at white space only, so that no word is cut."""
    at = 0
    while at < len(text):
        stop = at + size
        if stop < len(text):
            space = _SPACE.search(text, stop)
            stop = space.start() if space else len(text)
        yield text[at:stop]
        at = stop
