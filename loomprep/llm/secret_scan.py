"""Secret scans: fixed patterns, and a battery of randomness tests.

Fixed patterns find assignments, access keys and long hex strings.  The
battery judges every other token of ``MIN_LENGTH`` characters or more: its
encoding (hex, base32, base36, base62, base64, or letters, in which capitals count
as small letters) is inferred from its characters; a chi-squared test of the alphabet's uniformity, a runs test about
the alphabet's middle and a lag-1 serial-correlation test are combined by
Fisher's method into the evidence against a random string.  The null of a
natural token has two parts, again combined by Fisher's method: ordinary words
of the corpus (letters only) go through the same battery, and their evidence
for each character says how random a natural token of that length looks; and
natural tokens change between digits, capitals and small letters at a rate of
``CHANGES`` a character at most.  Both depend on the length, so longer tokens
are told apart more surely.  Tokens of letters only are judged like all others, against
the same words; what tells a key of mixed letters from a word is mostly its changes
between capitals and small letters.  Over the whole corpus the Benjamini-Hochberg rule
at ``Q`` sets the p-value below which tokens are reported, provided that they
also look random themselves (``RANDOM_P``).

Only binned counts leave the tasks, at most ``7 * MAX_LENGTH * BINS *
CHANGE_BINS`` rows whatever the corpus (in practice some hundreds).  Every text is scanned whole, twice: once for counts, once for spans.

Defined cases: null and empty texts have no spans; a found token inside a
pattern's span is not reported again; without any candidate nothing is added;
repeated rows are scanned alike; columns besides text are carried along
unread.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import table

Q = 0.01                 # false discoveries among the reported tokens
RANDOM_P = 1e-3          # a random string passes the battery with at least this p-value
MIN_LENGTH, NATURAL_LENGTH, MAX_LENGTH = 18, 12, 64      # longer tokens count as MAX_LENGTH
CHANGES = 0.1            # changes between kinds of characters in natural tokens, a character
BIN, BINS = 0.1, 31      # evidence in tenths of a decimal digit; the last bin is open
RATE_BIN = 0.05          # evidence a character, of natural tokens
CHANGE_BINS = 31         # evidence of the changes, in decimal digits; the last bin is open
KINDS = ("assign", "access", "hex", "random")
#: Pseudo-observations of natural text (evidence a character, spread), so that a
#: tiny corpus has a null as well: fixed values.
PRIOR_TOKENS, PRIOR_RATE, PRIOR_SPREAD = 50, 0.2, 0.3

_ASSIGN = re.compile(
    r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"""
    r"""|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")      # maximal runs, so the length is part of it
_HEX = re.compile(r"[0-9a-f]{24,}")
_TOKEN = re.compile(rf"[A-Za-z0-9+/_-]{{{NATURAL_LENGTH},}}")

_DIGIT, _UPPER, _LOWER = b"0123456789", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"


@dataclass
class Encoding:
    """Number of each byte in the alphabet, and the alphabet's size."""

    symbol: np.ndarray
    size: int


def _encoding(alphabet: bytes, same: dict[bytes, bytes] | None = None) -> Encoding:
    """``same``: other spellings of symbols."""
    symbol = np.zeros(256, np.int64)
    symbol[list(alphabet)] = np.arange(len(alphabet))
    for other, meant in (same or {}).items():
        symbol[list(other)] = symbol[list(meant)]
    return Encoding(symbol, len(alphabet))


ENCODINGS = {
    "hex": _encoding(_DIGIT + b"abcdef", {b"ABCDEF": b"abcdef"}),
    "letters": _encoding(_LOWER, {_UPPER: _LOWER}),
    "base32": _encoding(_UPPER + b"234567"),
    "base36": _encoding(_DIGIT + _LOWER, {_UPPER: _LOWER}),
    "base62": _encoding(_DIGIT + _UPPER + _LOWER),
    "base64": _encoding(_UPPER + _LOWER + _DIGIT + b"+/", {b"-_": b"+/"}),
}
NULL_OF = {"letters": "letters", "hex": "base36", "base32": "base36", "base36": "base36",
           "base62": "base62", "base64": "base62"}


def infer(token: str) -> str | None:
    """Encoding of a token; None for digits only, and for words joined by symbols."""
    digit = upper = lower = symbol = other_hex = other32 = False
    for c in set(token):
        if c.isdigit():
            digit = True
            other32 |= c in "0189"
        elif c in "+/-_":
            symbol = True
        else:
            if c.isupper():
                upper = True
            else:
                lower = True
            other_hex |= c.lower() > "f"
    if not digit:
        return "base64" if symbol and upper and lower else None if symbol else "letters"
    if symbol:
        return "base64"
    if not upper and not lower:
        return None
    if not other_hex and not (upper and lower):
        return "hex"
    if upper and lower:
        return "base62"
    return "base32" if upper and not other32 else "base36"


def _log10_tail(z: np.ndarray) -> np.ndarray:
    """log10 of the upper tail of the normal distribution."""
    near = np.clip(z, -30, 25)
    exact = np.array([math.erfc(v / math.sqrt(2)) / 2 for v in near.tolist()])
    with np.errstate(divide="ignore", invalid="ignore"):
        far = -z * z / 2 - np.log(np.maximum(z, 1) * math.sqrt(2 * math.pi))
        return np.where(z < 20, np.log(np.maximum(exact, 1e-300)), far) / math.log(10)


def evidence(tokens: list[bytes], encoding: str) -> np.ndarray:
    """-log10 of the combined p-value that each token is random in ``encoding``."""
    if not tokens:
        return np.zeros(0)
    code = ENCODINGS[encoding]
    n = np.fromiter(map(len, tokens), np.int64, len(tokens))
    data = np.frombuffer(b"".join(tokens), np.uint8)
    owner = np.repeat(np.arange(len(tokens)), n)
    symbol = code.symbol[data]
    seen = np.bincount(owner * code.size + symbol, minlength=len(n) * code.size)
    expected = n / code.size
    chi = (seen.reshape(-1, code.size) ** 2).sum(1) / expected - n
    df = code.size - 1
    uniform = _log10_tail(((chi / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df)))

    x = symbol - df / 2
    inner = owner[1:] == owner[:-1]
    high = x > 0
    n1 = np.bincount(owner, high, len(n))
    n2 = n - n1
    runs = 1 + np.bincount(owner[1:], inner & (high[1:] != high[:-1]), len(n))
    mean = 2 * n1 * n2 / n + 1
    var = (mean - 1) * (mean - 2) / np.maximum(n - 1, 1)
    # all on one side has probability 2**-n each
    z = np.where(var > 0, np.abs(runs - mean) / np.sqrt(np.maximum(var, 1e-9)), 0.0)
    run = np.where(var > 0, _log10_tail(z) + math.log10(2), (1 - n) * math.log10(2))

    lag = np.bincount(owner[1:], inner * x[1:] * x[:-1], len(n))
    square = np.bincount(owner, x * x, len(n))
    serial = _log10_tail(np.abs(lag / np.maximum(square, 1e-9) + 1 / n) * np.sqrt(n)) + math.log10(2)

    half = -math.log(10) * (np.minimum(uniform, 0) + np.minimum(run, 0) + np.minimum(serial, 0))
    return (half - np.log(1 + half + half * half / 2)) / math.log(10)


_KIND = np.full(256, -1)
_KIND[list(_DIGIT)], _KIND[list(_UPPER)], _KIND[list(_LOWER)] = 0, 1, 2


def change_evidence(tokens: list[bytes]) -> np.ndarray:
    """-log10 of (a bound on) the probability that a natural token changes so
    often between digits, capitals and small letters."""
    n = np.fromiter(map(len, tokens), np.int64, len(tokens))
    kind = _KIND[np.frombuffer(b"".join(tokens), np.uint8)]
    owner = np.repeat(np.arange(len(tokens)), n)
    change = (owner[1:] == owner[:-1]) & (kind[1:] != kind[:-1]) & (kind[1:] >= 0) & (kind[:-1] >= 0)
    rate = np.bincount(owner[1:], change, len(n)) / np.maximum(n - 1, 1)
    rate = np.clip(rate, CHANGES, 1 - 1e-9)
    gap = rate * np.log(rate / CHANGES) + (1 - rate) * np.log((1 - rate) / (1 - CHANGES))
    return (n - 1) * gap / math.log(10)


def _judge(tokens: list[str]):
    """(token numbers, encoding, natural, evidence bin, bin of the changes)."""
    by: dict = {}
    for k, t in enumerate(tokens):
        e = infer(t)
        if e is not None and (e == "letters" or len(t) >= MIN_LENGTH):
            by.setdefault(e, []).append(k)
    for e, numbers in by.items():
        raw = [tokens[k].encode() for k in numbers]
        numbers, length = np.array(numbers), len_of(raw)
        changes = np.minimum(change_evidence(raw), CHANGE_BINS - 1).astype(np.int64)
        words = ("letters", "base36", "base62") if e == "letters" else ()
        for name in words or (e,):
            value = evidence(raw, name)
            if words:
                # words: steps of the evidence a character, relative to the last bin
                yield (numbers, name, True,
                       np.clip(value / length / RATE_BIN, 0, BINS - 1).astype(np.int64), changes)
            if name == e:
                long = length >= MIN_LENGTH
                yield (numbers[long], name, False,
                       np.clip(value[long] / BIN, 0, BINS - 1).astype(np.int64), changes[long])


def len_of(raw: list[bytes]) -> np.ndarray:
    return np.fromiter(map(len, raw), np.int64, len(raw))


def _count(batches):
    for batch in batches:
        found = []
        for text in batch.column(0).to_pylist():
            found += _TOKEN.findall(text or "")
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        rows: dict = {}
        for numbers, name, natural, value, changes in _judge(found):
            n = np.minimum(lengths[numbers], MAX_LENGTH)
            at, times = np.unique((n * BINS + value) * CHANGE_BINS + changes * (not natural),
                                  return_counts=True)
            for x, c in zip(at.tolist(), times.tolist()):
                rows[natural, name, x // CHANGE_BINS // BINS, x // CHANGE_BINS % BINS,
                     x % CHANGE_BINS] = c
        keys = list(zip(*rows)) or [()] * 5
        kinds = (pa.bool_(), pa.string(), pa.int32(), pa.int32(), pa.int32())
        yield pa.RecordBatch.from_arrays(
            [pa.array(k, t) for k, t in zip(keys, kinds)] + [pa.array(rows.values(), pa.int64())],
            names=["natural", "encoding", "length", "bin", "changes", "n"])


def limits(counts: list) -> dict:
    """(encoding, length, bin of the changes) -> the last evidence bin reported.

    ``counts``: rows (natural, encoding, length, bin, changes, n)."""
    null = {}
    for name in set(NULL_OF.values()):
        # evidence a character times the square root of the length has one spread
        own = [(n, (b + 0.5) * RATE_BIN, c) for nat, e, n, b, _, c in counts if nat and e == name]
        k = PRIOR_TOKENS + sum(c for _, _, c in own)
        rate = (PRIOR_TOKENS * PRIOR_RATE + sum(r * c for _, r, c in own)) / k
        low = [(n, r, c) for n, r, c in own if r <= rate]      # the side towards random
        square = sum(n * c * (r - rate) ** 2 for n, r, c in low)
        spread = math.sqrt((PRIOR_TOKENS * PRIOR_SPREAD ** 2 + square)
                           / (PRIOR_TOKENS + sum(c for _, _, c in low)))
        null[name] = rate, spread
    cells = []
    for nat, e, n, b, changes, c in counts:
        if not nat:
            rate, spread = null[NULL_OF[e]]
            z = ((b + 0.5) * BIN / n - rate) * math.sqrt(n) / spread
            alike = max(math.erfc(-z / math.sqrt(2)) / 2, 1e-300)
            half = -math.log(alike) + changes * math.log(10)
            cells.append((math.exp(-half) * (1 + half), e, n, b, changes, c))
    cells.sort()
    total, passed, cut = sum(x[5] for x in cells), 0, -1.0
    for p, *_, c in cells:
        passed += c
        if p <= Q * passed / total:
            cut = p
    out: dict = {}
    for p, e, n, b, changes, _ in cells:
        if p <= cut and (b + 1) * BIN <= -math.log10(RANDOM_P) + BIN / 2:
            out[e, n, changes] = max(out.get((e, n, changes), -1), b)
    return out


def fit_limits(docs: DataFrame) -> dict:
    binned = docs.select("text").mapInArrow(
        _count, "natural boolean, encoding string, length int, bin int, changes int, n long")
    rows = binned.groupBy("natural", "encoding", "length", "bin", "changes").agg(
        F.sum("n").alias("n"))
    return limits([tuple(r) for r in rows.collect()])     # bins: bounded, whatever the corpus


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Spans of the fixed patterns: (start, kind number, end), in order."""
    out = []
    low = text.lower() if ("=" in text or ":" in text) else ""
    if any(k in low for k in _KEYWORDS):
        out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(out)


def all_spans(texts: list, limit: dict) -> list[list[tuple[int, int, int]]]:
    """Spans of each text, in order: (start, kind number, end)."""
    found, tokens, places = [], [], []
    for d, text in enumerate(texts):
        text = text or ""
        found.append(base_spans(text))
        if limit:
            for m in _TOKEN.finditer(text):
                if m.end() - m.start() >= MIN_LENGTH:
                    tokens.append(m.group())
                    places.append((d, m.start(), m.end()))
    for numbers, name, natural, value, changes in _judge(tokens):
        for k, b, ch in zip(numbers.tolist(), value.tolist(), changes.tolist()):
            d, a, z = places[k]
            if not natural and b <= limit.get((name, min(z - a, MAX_LENGTH), ch), -1) and not any(
                    s <= a and z <= e for s, _, e in found[d]):
                found[d].append((a, 3, z))
    return [sorted(f) for f in found]


def scan(docs: DataFrame, limit: dict) -> DataFrame:
    """``docs`` with ``secrets``: array of (kind, start, end) in code points."""
    accepted = docs.sparkSession.sparkContext.broadcast(limit)

    @F.arrow_udf("array<struct<kind: string, start: long, end: long>>")
    def find(column: pa.Array) -> pa.Array:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        return pa.array([[{"kind": KINDS[k], "start": a, "end": z} for a, k, z in spans]
                         for spans in all_spans(column.to_pylist(), accepted.value)], kind)

    return docs.withColumn("secrets", find(F.col("text")))


def redact(docs: DataFrame, mark: str = "[secret]") -> DataFrame:
    """``docs`` with every span replaced by ``mark`` (overlapping spans by one);
    rows without spans are unchanged; n_chars, where there is such a column,
    follows the text."""
    accepted = docs.sparkSession.sparkContext.broadcast(fit_limits(docs))

    @F.arrow_udf("string")
    def cut(column: pa.Array) -> pa.Array:
        texts, out = column.to_pylist(), []
        for text, spans in zip(texts, all_spans(texts, accepted.value)):
            at, parts = 0, []
            for a, _, z in spans:
                if a >= at:                      # else it overlaps the one before
                    parts += [text[at:a], mark]
                at = max(at, z)
            out.append("".join(parts) + text[at:] if parts else None)
        return pa.array(out, pa.string())

    # null where nothing was found
    cleaned = docs.select(F.struct("*").alias("row"), cut(F.col("text")).alias("cleaned"))
    hit, columns = F.col("cleaned").isNotNull(), []
    for c in docs.columns:
        old = F.col("row")[c]
        if c == "text":
            old = F.coalesce("cleaned", old)
        elif c == "n_chars":
            old = F.when(hit, F.length("cleaned").cast("long")).otherwise(old)
        columns.append(old.alias(c))
    return cleaned.select(*columns)


def _joined(kinds=KINDS):
    shown = F.filter("secrets", lambda s: s["kind"].isin(list(kinds)))
    return F.array_join(F.transform(shown, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _number(kind: str):
    return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan(docs, fit_limits(docs))
    return found.select("doc_id", *[_number(k).alias(f"n_{k}") for k in KINDS[:3]],
                        F.sha2(_joined(KINDS[:3]).cast("binary"), 256).alias("base_sha256"),
                        _joined().alias("spans"))
