"""The payload schema and the length of ids."""

from __future__ import annotations

# The longest message id the landing table takes.
ID_LENGTH = 16


def payload_ddl(depth: int) -> str:
    """The payload document, `depth` levels of parts deep. Below that, parts stay raw
    JSON text, so that a deeper message is seen and not cut."""
    parts = f"array<{payload_ddl(depth - 1)}>" if depth else "string"
    return (
        "struct<mimeType: string, body: struct<data: string>, "
        f"headers: array<struct<name: string, value: string>>, parts: {parts}>"
    )
