"""Words of texts, taken from their UTF-8 bytes."""

from __future__ import annotations

LETTERS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
DIGITS = b"0123456789"


def byte_table(kept: bytes) -> bytes:
    """For bytes.translate(): kept ASCII bytes and all bytes of other characters stay, A-Z in lower case; what is left is a space."""
    return bytes(b if b >= 128 else (b + 32 if 65 <= b <= 90 else b) if b in kept else 32 for b in range(256))


def words(text: bytes, table: bytes) -> list[bytes]:
    """The maximal runs of kept bytes. No byte of a character beyond ASCII is ASCII, so runs of bytes are runs of characters."""
    return text.translate(table).split()
