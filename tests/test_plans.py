"""Plan shapes that matter at scale."""

from conftest import SF01
from loomprep.plans import catalog


def _explain(df, mode):
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def plan(df):
    """Physical plan tree (public ``explain`` output)."""
    return _explain(df, "extended").split("== Physical Plan ==", 1)[1]


def formatted(df):
    return _explain(df, "formatted")


def test_topk_has_partial_window_group_limit(spark):
    p = formatted(catalog.QUERIES["topk_per_group"](spark, SF01))
    assert p.count("WindowGroupLimit") >= 2


def test_bottomk_is_take_ordered(spark):
    p = formatted(catalog.QUERIES["bottomk_sample"](spark, SF01))
    assert "TakeOrderedAndProject" in p


ROW_LEVEL_NO_SINGLE = ["seeded_shuffle", "sequence_positions", "sort_by_length", "temporal_groups",
                       "valid_rank", "pad_batches", "mask_positions"]


def test_no_single_partition_over_rows(spark):
    """A SinglePartition exchange may only sit on a pre-aggregated input (the
    bucket-count table of a bucketed rank, or the partial min/max of a
    bucket bound), never on row-level input."""
    for name in ROW_LEVEL_NO_SINGLE:
        lines = plan(catalog.QUERIES[name](spark, SF01)).splitlines()
        for k, line in enumerate(lines):
            if "Exchange SinglePartition" in line:
                child = lines[k + 1]
                assert "HashAggregate" in child and ("count" in child or "partial_" in child), (name, line, child)


def test_no_python_in_expression_queries(spark):
    py_nodes = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas")
    for name in ["normalize_text", "build_messages", "render_chat", "length_admission", "sequence_positions",
                 "visual_mask", "expand_placeholders", "trim_output", "embedding_gather", "calibration_mix",
                 "nucleus_filter", "patchify", "vector_export"]:
        p = formatted(catalog.QUERIES[name](spark, SF01))
        assert not any(n in p for n in py_nodes), name


def test_pruned_scan(spark):
    p = formatted(catalog.QUERIES["contains_cjk"](spark, SF01))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in p


def shuffle_inputs(df):
    """Input columns of every shuffle (non-broadcast) exchange of the plan."""
    import re
    out = []
    for block in formatted(df).split("\n\n"):
        head = block.split("\n")[0]
        if block.startswith("(") and re.search(r"\) Exchange\b", head):
            m = re.search(r"Input \[\d+\]: \[([^\]]*)\]", block)
            cols = [re.sub(r"#\d+L?$", "", c.strip()) for c in m.group(1).split(",")] if m else []
            out.append(cols)
    return out


PAYLOAD = {"text", "html", "image", "question", "answer", "prompt", "messages", "embedding"}


def test_image_sampling_shuffles_keys_only(spark):
    from pyspark.sql import functions as F
    from loomprep.operators import calibration as C
    from loomprep.plans.message_queries import _captioned
    s = C.sampled_images(_captioned(spark, SF01), F.lit(10), 1024)
    ex = shuffle_inputs(s)
    assert ex, "expected shuffles"
    for cols in ex:
        assert not PAYLOAD & set(cols), cols


def test_round_robin_rank_shuffles_no_text(spark):
    for cols in shuffle_inputs(catalog.QUERIES["round_robin_mix"](spark, SF01)):
        assert not PAYLOAD & set(cols), cols


def test_positions_shuffle_carries_no_vectors(spark):
    ex = shuffle_inputs(catalog.QUERIES["sequence_positions"](spark, SF01))
    rows = [c for c in ex if "token_id" in c]
    assert rows and all("embedding" not in c and "text" not in c for c in rows)
