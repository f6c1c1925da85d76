"""The normalisations of ``functions.text`` as SQL text for the oracle."""

from __future__ import annotations

from qirtas.functions.text import ARABIC_DIGITS, ASCII_DIGITS, SPACE, TOKEN, WORD


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^[{SPACE}]+|[{SPACE}]+$', '', 'g')"


def digits(x: str) -> str:
    return f"translate({x}, '{ARABIC_DIGITS}', '{ASCII_DIGITS}')"


def squeeze(x: str) -> str:
    return strip(f"regexp_replace({x}, '[{SPACE}]+', ' ', 'g')")


def whitespace(x: str) -> str:
    inner = f"regexp_replace(replace({x}, chr(160), ' '), '[ \\t]+', ' ', 'g')"
    return strip(f"regexp_replace({inner}, '[{SPACE}]*\\n[{SPACE}]*', chr(10), 'g')")


def doc_number(x: str) -> str:
    return f"nullif(regexp_replace({whitespace(digits(x))}, '[{SPACE}]*/[{SPACE}]*', '/', 'g'), '')"


def kind(x: str) -> str:
    return f"nullif(lower({strip(x)}), '')"


def identity(x: str) -> str:
    inner = f"lower({digits(f'coalesce({x}, {chr(39)}{chr(39)})')})"
    inner = f"regexp_replace({inner}, '[\\x{{64B}}-\\x{{65F}}]', '', 'g')"
    return squeeze(f"regexp_replace({inner}, '[^a-z0-9\\x{{600}}-\\x{{6FF}}/]+', ' ', 'g')")


def topic_name(x: str) -> str:
    inner = f"lower({digits(f'coalesce({x}, {chr(39)}{chr(39)})')})"
    inner = f"regexp_replace({inner}, '[\\x{{64B}}-\\x{{65F}}]', '', 'g')"
    inner = f"regexp_replace({inner}, '[^{WORD}{SPACE}]', ' ', 'g')"
    return squeeze(f"regexp_replace({inner}, '_+', ' ', 'g')")


def tokens(x: str) -> str:
    return f"regexp_extract_all({x}, '{TOKEN}')"


def token_count(x: str) -> str:
    return f"coalesce(len({tokens(x)}), 0)"
