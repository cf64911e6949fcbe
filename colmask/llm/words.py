"""Words of whole texts, as bytes."""

from __future__ import annotations

# A-Z in lower case; ASCII other than digits and letters separates words.
FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


def split_words(text: bytes | None) -> list[bytes]:
    """Words of a whole UTF-8 text; none for null."""
    return text.translate(FOLD).split() if text else []
