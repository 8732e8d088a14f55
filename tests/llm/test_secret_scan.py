import hashlib
import random
import re
import string

import numpy as np
import pytest

from loomprep.llm import secret_scan as S

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.I | re.A)


def brute_base(text):
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text or "") if len(m.group(2)) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text or "")
            if len(m.group()) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text or "")
            if len(m.group()) >= 24]
    return sorted(out)


def tricky_texts():
    rng = random.Random(4)
    bits = ["password", "PassWD", "secret", "token:", "token", "api_key", "APIKEY", "=", ":", "\"",
            "'", " ", "  ", "\n", "abcde", "abcdef", "x.y=z-", "AKIA", "AKIA" + "Q2" * 8,
            "AKIAAKIA" + "B" * 11, "deadbeef" * 3, "0" * 23, "f" * 24, "é", "日本", "Key", "toKen=abcdefgh",
            "ſecret=abcdefgh", "g", "İ"]
    out = ["", None, "token:token:abcdefgh", "password = \"hunter22\"", "secret='a.b'",
           "x" * 30000 + " token=" + "Z9" * 2000]
    return out + ["".join(rng.choices(bits, k=rng.randint(1, 14))) for _ in range(1500)]


def test_base_spans_match_the_patterns():
    for t in tricky_texts():
        assert S.base_spans(t or "") == brute_base(t), t


@pytest.mark.parametrize("name,alphabet", [
    ("hex", "0123456789abcdef"), ("base32", string.ascii_uppercase + "234567"),
    ("base62", string.ascii_letters + string.digits),
    ("base64", string.ascii_letters + string.digits + "+/")])
def test_random_strings_pass_the_battery(name, alphabet):
    rng = random.Random(7)
    for n in (20, 40, 80):
        value = S.evidence(["".join(rng.choices(alphabet, k=n)).encode() for _ in range(1500)], name)
        assert (value <= 3).mean() > 0.985
        assert 0.8 < (value <= 1).mean() < 0.97          # p-values are near uniform


def corpus(n=300):
    rng = random.Random(3)
    syllables = ["the", "in", "er", "on", "an", "re", "st", "ing", "ly", "tion", "ou", "ble", "ea"]
    words = lambda k: " ".join("".join(rng.choices(syllables, k=rng.randint(1, 8))) for _ in range(k))
    rows, planted = [], {}
    for k in range(n):
        text = words(120) + " covid19vaccine2021 final-report-2021-12-31 12345678901234567890 "
        if k % 10 == 0:
            alphabet = [string.ascii_letters + string.digits, string.ascii_uppercase + "234567",
                        string.ascii_letters + string.digits + "+/"][k // 10 % 3]
            token = "".join(rng.choices(alphabet, k=40))
            planted[k] = (len(text), len(text) + 40)
            text += token + " " + words(5)
        rows.append((k, text, len(text)))
    return rows, planted


def test_planted_tokens_are_found_and_words_left(spark):
    rows, planted = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    got = {r.doc_id: [(s.start, s.end) for s in r.secrets if s.kind == "random"]
           for r in S.scan(df, S.fit_limits(df)).collect()}
    found = sum(any(a <= planted[k][0] and z >= planted[k][1] for a, z in got[k]) for k in planted)
    assert found >= 0.9 * len(planted)
    assert sum(len(v) for k, v in got.items() if k not in planted) <= 1
    clean = {r.doc_id: r for r in S.redact(df).collect()}
    for k, text, n in rows:
        if got[k]:
            (a, z), = got[k]
            assert clean[k].text == text[:a] + "[secret]" + text[z:]
            assert clean[k].n_chars == len(clean[k].text)
        else:
            assert (clean[k].text, clean[k].n_chars) == (text, n)


def test_redact_keeps_columns_and_handles_odd_rows(spark):
    rows = [(t, k, 5) for k, t in enumerate(tricky_texts()[:400])]
    df = spark.createDataFrame(rows, "text string, secrets int, redact_row int")
    out = S.redact(df)
    assert out.columns == df.columns
    got = {r.secrets: r.text for r in out.collect()}
    for t, k, _ in rows:
        spans, at, want = brute_base(t), 0, ""
        for a, _, z in spans:
            if a >= at:
                want += t[at:a] + "[secret]"
            at = max(at, z)
        assert got[k] == (want + t[at:] if spans else t)
    assert S.redact(df.limit(0)).count() == 0


def test_query_matches_the_patterns(spark):
    path = "/root/testdata/sf0.01"
    texts = dict(spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect())
    rows = S.op8_secret_scan(spark, path).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = brute_base(texts[r.doc_id])
        joined = ",".join(f"{S.KINDS[k]}:{a}:{z}" for a, k, z in base)
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == j for _, k, _ in base) for j in range(3))
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert set(joined.split(",")) - {""} <= set(r.spans.split(","))


def test_limits_follow_length():
    """The same evidence is accepted for long tokens only."""
    counts = [(True, "base62", 20, b, 0, 500) for b in range(10)]
    counts += [(False, "base62", n, 2, c, 10) for n, c in ((18, 0), (60, 12))]
    got = S.limits(counts)
    assert ("base62", 60, 12) in got and ("base62", 18, 0) not in got
    assert S.limits([]) == {} and np.isfinite(S.evidence([b"a" * 50], "hex")).all()


def test_keys_of_letters_only_are_found_and_names_left(spark):
    """Mixed letters are told from words and from names in camel case."""
    rows, planted = corpus()
    rng = random.Random(11)
    keys = {}
    out = []
    for k, text, _ in rows:
        text += " getElementsByClassName InternationalBusinessMachines counterrevolutionaries "
        if k % 15 == 4:
            keys[k] = (len(text), len(text) + 40)
            text += "".join(rng.choices(string.ascii_letters, k=40)) + " end"
        out.append((k, text))
    df = spark.createDataFrame(out, "doc_id long, text string")
    got = {r.doc_id: [(s.start, s.end) for s in r.secrets if s.kind == "random"]
           for r in S.scan(df, S.fit_limits(df)).collect()}
    assert sum(keys[k] in got[k] for k in keys) >= 0.9 * len(keys)
    wrong = [(k, s) for k, v in got.items() for s in v if s != keys.get(k) and s != planted.get(k)]
    assert len(wrong) <= 1


def test_infer():
    assert [S.infer(t) for t in ("abc", "AbC", "12", "a1", "G1", "x-y", "aZ1", "A-b", "a/1")] == [
        "letters", "letters", None, "hex", "base36", None, "base62", "base64", "base64"]
