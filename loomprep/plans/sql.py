"""SQL fragments shared by the oracle statements (DuckDB dialect)."""

from ..functions.constants import CJK_CLASS, MAX_TEXT_CHARS, WHITESPACE_CLASS


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


WS_RE = q(WHITESPACE_CLASS + "+")
CJK_RE = q(CJK_CLASS)


def collapse(expr: str) -> str:
    return f"trim(regexp_replace({expr}, {WS_RE}, ' ', 'g'))"


def norm(expr: str, max_chars: int = MAX_TEXT_CHARS) -> str:
    return f"substring({collapse(expr)}, 1, {max_chars})"


def cjk(expr: str) -> str:
    return f"coalesce(regexp_matches({expr}, {CJK_RE}), false)"


def md5key(seed, *exprs: str) -> str:
    parts = ", ".join(f"CAST({e} AS VARCHAR)" for e in exprs)
    return f"md5(concat_ws(':', {q(str(seed))}, {parts}))"


def unit(hex_expr: str) -> str:
    return f"(CAST(('0x' || substring({hex_expr}, 1, 13)) AS BIGINT) / pow(16, 13))"


def hashed_id(expr: str, modulus: int) -> str:
    return f"CAST((CAST(('0x' || substring(md5(CAST({expr} AS VARCHAR)), 1, 8)) AS BIGINT) % {modulus}) AS INTEGER)"


def words(expr: str) -> str:
    """Whitespace tokens as a list (empty strings removed)."""
    return f"list_filter(string_split(coalesce({collapse(expr)}, ''), ' '), lambda w: w <> '')"


def strip(expr: str) -> str:
    ws = WHITESPACE_CLASS
    return f"regexp_replace({expr}, {q('^' + ws + '+|' + ws + '+$')}, '', 'g')"
