"""Message text: HTML to text, base64url, context assembly."""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalars import blank, strip

# Elements whose content is never visible text.
_HIDDEN = ("script", "style", "template")

_SPACE = " \\t\\n\\r\\f\\x0b\\x1c-\\x1f\\x85\\xa0"
_BREAK = "\x01"
# A bare "<" is text; only a letter, "/", "!" or "?" after it opens a tag.
_TAG = "<[a-zA-Z/!?][^>]*>"

# Named character references of the HTML standard, commonest first since the lookup scans in order.
_COMMON = ("amp", "lt", "gt", "quot", "nbsp", "copy", "middot")
_CHARS = {n.removesuffix(";"): c for n, c in html5.items()}
_NAMES = [*_COMMON, *(n for n in sorted(_CHARS) if n not in _COMMON)]
# Numbers from 128 to 159 are read as Windows-1252, as browsers do.
_WINDOWS = {n: bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(128, 160)}
# Names that are also read without their semicolon, longest first.
_BARE = "|".join(sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n)))


def _number(digits: Column, base: int, most: int) -> Column:
    """Code point of digits with any leading zeros; U+FFFD for 0, surrogates and what is too large."""
    bare = F.regexp_replace(digits, "^0+(?=.)", "")
    code = F.when(F.length(bare) <= most, F.conv(bare, base, 10).cast("int"))
    valid = ((code > 0) & (code < 0xD800)) | ((code > 0xDFFF) & (code <= 0x10FFFF))
    return F.when(valid, code).otherwise(0xFFFD)


def _decode_entities(text: Column) -> Column:
    """Named, decimal and hexadecimal character references to characters, in one pass."""
    names = F.create_map(*[x for n in _NAMES for x in (F.lit(n), F.lit(_CHARS[n]))])
    windows = F.create_map(*[x for n, c in _WINDOWS.items() for x in (F.lit(n), F.lit(c))])

    def piece(part: Column) -> Column:
        numeric = F.regexp_extract(part, "^(#(?:[0-9]+|[xX][0-9a-fA-F]+);?)", 1)
        dec = F.regexp_extract(numeric, "^#([0-9]+)", 1)
        hexa = F.regexp_extract(numeric, "^#[xX]([0-9a-fA-F]+)", 1)
        code = F.when(dec != "", _number(dec, 10, 7)).when(hexa != "", _number(hexa, 16, 6))
        plain = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        number = F.coalesce(F.try_element_at(windows, code), plain)
        named = F.regexp_extract(part, "^([a-zA-Z][a-zA-Z0-9]*);", 1)
        char = F.try_element_at(names, F.nullif(named, F.lit("")))
        bare = F.regexp_extract(part, f"^({_BARE})", 1)
        return (
            F.when(numeric != "", F.concat(number, F.substr(part, F.length(numeric) + F.lit(1))))
            .when(char.isNotNull(), F.concat(char, F.substr(part, F.length(named) + F.lit(2))))
            .when(
                bare != "",
                F.concat(F.try_element_at(names, bare), F.substr(part, F.length(bare) + F.lit(1))),
            )
            .otherwise(F.concat(F.lit("&"), part))
        )

    parts = F.split(text, "&")
    decoded = F.concat(
        F.get(parts, F.lit(0)),
        F.array_join(F.transform(F.slice(parts, F.lit(2), F.size(parts)), piece), ""),
    )
    return F.when(text.contains("&"), decoded).otherwise(text)


def html_to_text(html: Column, separator: str = "") -> Column:
    """Visible text of a page; every text node is stripped, then joined with ``separator``.

    Comments, doctype and the content of hidden elements go first, so that tags
    quoted inside a script are not taken for markup.
    """
    text = F.regexp_replace(html, r"(?s)<!--.*?-->", "")
    text = F.regexp_replace(text, r"(?is)<!doctype[^>]*>", "")
    for tag in _HIDDEN:
        text = F.regexp_replace(text, rf"(?is)<{tag}\b[^>]*>.*?</{tag}\s*>", "")
    text = F.replace(text, F.lit("&nbsp;"), F.lit("\u00a0"))
    # A tag takes the whitespace around it along. The look-behind lets a match
    # start only at the head of a run of whitespace, which keeps this linear.
    text = F.regexp_replace(text, f"(?:\\G|(?<![{_SPACE}]))[{_SPACE}]*{_TAG}[{_SPACE}]*", _BREAK)
    text = strip(F.regexp_replace(text, f"^{_BREAK}+|{_BREAK}+$", ""))
    text = F.regexp_replace(text, f"{_BREAK}[{_SPACE}{_BREAK}]*", separator)
    return _decode_entities(text)


def message_text(body: Column, body_type: Column) -> Column:
    """Body as text; only HTML bodies are cleaned, null becomes empty."""
    return F.coalesce(F.when(body_type == "html", html_to_text(body)).otherwise(body), F.lit(""))


def decode_base64(encoded: Column) -> Column:
    """Base64 (padding and line breaks optional) to bytes; null where it is malformed."""
    bare = F.regexp_replace(encoded, r"[\s=]+", "")
    padded = F.concat(bare, F.repeat(F.lit("="), F.pmod(-F.length(bare), F.lit(4)).cast("int")))
    return F.try_to_binary(padded, F.lit("base64"))


def decode_base64url(encoded: Column) -> Column:
    """URL-safe base64 (padding optional) to bytes; blank gives empty bytes, malformed null."""
    return F.when(blank(encoded), F.lit(b"")).otherwise(decode_base64(F.translate(encoded, "-_", "+/")))


def decode_base64url_text(encoded: Column) -> Column:
    """URL-safe base64 to UTF-8 text; blank and malformed give null."""
    return F.when(~blank(encoded), decode_base64url(encoded).cast("string"))


def join_pages(pages: Column) -> Column:
    """Pages of a document joined by newlines; a page without text counts as empty."""
    return F.array_join(F.transform(pages, lambda p: F.coalesce(p, F.lit(""))), "\n")


def classifier_context(text: Column, attachments: Column) -> Column:
    """Message text plus the attachment file names."""
    names = F.array_join(
        F.transform(attachments, lambda a: F.concat(F.lit("- "), a["filename"], F.lit("\n"))), ""
    )
    section = F.concat(F.lit("\n\nAttachments found:\n"), names)
    return F.concat(text, F.when(F.size(attachments) > 0, section).otherwise(""))


def extractor_context(text: Column, attachments: Column) -> Column:
    """Message text plus attachment texts; attachments without text are marked binary."""

    def entry(a: Column) -> Column:
        with_text = F.concat(
            F.lit("\n--- "), a["filename"], F.lit(" ---\n"), a["text"], F.lit("\n")
        )
        binary = F.concat(F.lit("\n--- "), a["filename"], F.lit(" (binary file) ---\n"))
        return F.when(a["text"].isNotNull(), with_text).otherwise(binary)

    section = F.concat(
        F.lit("\n\nAttachment contents:\n"), F.array_join(F.transform(attachments, entry), "")
    )
    return F.concat(text, F.when(F.size(attachments) > 0, section).otherwise(""))
