"""The pipeline's stages, each judged on its own input."""

from collections import Counter

import pytest

import corpus_pipeline as C
from loomprep.llm import packing, toxicity

from .test_jaccard_join import brute as linked
from .test_mixing import water_fill
from .test_packing import check_pieces
from .test_secret_scan import brute_base

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Input and output rows of each stage, by name."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = [(10 ** 6, None, "en", "src1", 0), (10 ** 6 + 1, "", None, None, None),
             (None, "no id here at all, really", "en", "src2", 25)]
    some = docs.limit(3)
    docs = docs.union(some).union(spark.createDataFrame(extra, docs.schema))
    out, folder = {}, tmp_path_factory.mktemp("stages")
    for name, stage in C.STAGES:
        before = docs
        stage(spark, docs, SF).write.parquet(str(folder / name))
        docs = spark.read.parquet(str(folder / name))
        if name != "packing":
            assert docs.columns == before.columns
        out[name] = (before.collect(), docs.collect())
    return out


def test_order_and_names():
    assert [n for n, _ in C.STAGES] == ["toxicity", "near_duplicates", "secrets", "mixing", "packing"]


def test_toxic_documents_go(spark, stages):
    before, after = stages["toxicity"]
    docs = spark.createDataFrame(before)
    weights = toxicity.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    kept = [r for r in toxicity.score(docs, weights).collect() if r.score < 0.7]
    assert Counter(r.doc_id for r in kept) == Counter(r.doc_id for r in after)


def test_one_of_each_group_stays(stages):
    before, after = stages["near_duplicates"]
    links = linked([(r.doc_id, r.text) for r in before])
    want = Counter(i for i, c, n, _ in links if i is None or c == i)
    alone = {i for i, c, n, _ in links if n == 0}
    want = {i: n if i in alone else 1 for i, n in want.items()}
    assert Counter(r.doc_id for r in after) == want
    texts = {(r.doc_id, r.text) for r in before}
    assert all((r.doc_id, r.text) in texts for r in after)


def test_secrets_are_redacted(stages):
    before, after = stages["secrets"]
    assert len(before) == len(after)
    text = {r.doc_id: r.text for r in before}
    for r in after:
        assert not brute_base(r.text)
        if not brute_base(text[r.doc_id]) and "[secret]" not in (r.text or ""):
            assert r.text == text[r.doc_id]


def test_mix_is_near_its_targets(stages):
    before, after = stages["mixing"]
    size: Counter = Counter()
    taken: Counter = Counter()
    largest: Counter = Counter()
    words = lambda t: len((t or "").replace("\x0b", " ").replace("\x0c", " ").split())
    for r in before:
        size[r.source] += words(r.text)
        largest[r.source] = max(largest[r.source], words(r.text))
    for r in after:
        taken[r.source] += words(r.text)
    want = water_fill(dict(size))
    assert all(abs(taken[s] - want[s]) <= largest[s] for s in size)


def test_pieces(stages):
    from tokenizers import Tokenizer
    before, after = stages["packing"]
    check_pieces(after, [(r.doc_id, r.text) for r in before],
                 Tokenizer.from_file(packing.default_tokenizer()), 4096, 0.1)


def test_run_and_empty_table(spark, tmp_path):
    assert C.run(spark, SF).count() > 0
    for name in ("documents", "labels"):
        df = spark.read.parquet(f"{SF}/{name}.parquet")
        df.limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert C.run(spark, str(tmp_path)).count() == 0
