"""Markup to plain text with built-in regular expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# What is blanked, in order. Script and style bodies go first so
# that markup-like text inside them never survives as content.
BLANKED = (
    r"(?s)<script[^>]*>.*?</script>",
    r"(?s)<style[^>]*>.*?</style>",
    r"<[^>]+>",
    r"&[a-z#0-9]+;",
)


def html_to_text(html, max_chars: int | None = None) -> Column:
    """Visible text with collapsed whitespace; the whole text unless limited."""
    text = F.col(html) if isinstance(html, str) else html
    for pattern in BLANKED:
        text = F.regexp_replace(text, pattern, " ")
    text = F.trim(F.regexp_replace(text, r"\s+", " "))
    return text if max_chars is None else F.substring(text, 1, max_chars)
