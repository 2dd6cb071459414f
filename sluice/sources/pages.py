"""Stored web pages to text with light Markdown."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.text import strip

# Common named characters; numbers are decoded separately.
NAMED = {
    "&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&hellip;": "…",
    "&ndash;": "–", "&mdash;": "—", "&lsquo;": "‘", "&rsquo;": "’", "&ldquo;": "“", "&rdquo;": "”",
    "&copy;": "©", "&reg;": "®", "&middot;": "·", "&bull;": "•", "&laquo;": "«", "&raquo;": "»",
}
NUMERIC = r"&#(?:[0-9]{1,7}|[xX][0-9a-fA-F]{1,6});"
BLOCKS = [
    (r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->|<head\b.*?</head>", ""),
    (r"[\r\n\t ]+", " "),
    (r"(?i)<h1[^>]*>", "\n\n# "),
    (r"(?i)<h2[^>]*>", "\n\n## "),
    (r"(?i)<h[3-6][^>]*>", "\n\n### "),
    (r"(?i)<li[^>]*>", "\n- "),
    (r"(?i)<br[^>]*>", "\n"),
    (r"(?i)</?(?:p|div|ul|ol|table|tr|article|section|nav|h[1-6])\b[^>]*>", "\n\n"),
    (r"<[^>]+>", ""),
]
TIDY = [(r"[ ]+", " "), (r" ?\n ?", "\n"), (r"\n{3,}", "\n\n")]


def decode_numeric(text: Column) -> Column:
    """Numeric character references; texts without any are left as they are."""
    pieces = F.split(text, f"(?={NUMERIC})|(?<=;)")

    def one(piece: Column) -> Column:
        digits = F.regexp_extract(piece, r"\A&#([0-9]+);\z", 1)
        hexa = F.regexp_extract(piece, r"\A&#[xX]([0-9a-fA-F]+);\z", 1)
        code = F.when(digits != "", digits.try_cast("int")).when(hexa != "", F.conv(hexa, 16, 10).try_cast("int"))
        # UTF-32 bytes of the code point.
        char = F.decode(F.unhex(F.lpad(F.hex(code.cast("long")), 8, "0")), "UTF-32")
        return F.when(code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF), char).otherwise(piece)

    return F.when(text.rlike(NUMERIC), F.array_join(F.transform(pieces, one), "")).otherwise(text)


def html_text(html: Column) -> Column:
    text = html
    for pattern, replacement in BLOCKS:
        text = F.regexp_replace(text, pattern, replacement)
    for name, char in NAMED.items():
        text = F.replace(text, F.lit(name), F.lit(char))
    text = decode_numeric(text)
    # Last, so that an escaped reference is not decoded twice.
    text = F.replace(text, F.lit("&amp;"), F.lit("&"))
    for pattern, replacement in TIDY:
        text = F.regexp_replace(text, pattern, replacement)
    return strip(text)


def html_to_text(df: DataFrame, html_col: str = "html", output: str = "content") -> DataFrame:
    return df.withColumn(output, html_text(F.col(html_col))).drop(html_col)
