"""Bench: runs the headline queries over ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) on ``local[$BENCH_CPUS]`` and prints one JSON line.

Each query is forced in full with the ``noop`` sink (no driver collect);
the time is the best of three runs after one warm-up query.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["normalize_text", "bottomk_sample", "round_robin_mix", "calibration_mix",
            "embedding_gather", "sequence_positions", "topk_per_group", "nucleus_filter",
            "prepare_batches", "masked_replace", "patchify", "temporal_groups", "batch_predict"]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from loomprep.plans import catalog
    from loomprep.session import build_session
    spark = build_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE", "8")),
                          app_name="loomprep-bench")
    names = [n for n in (sys.argv[1:] or HEADLINE) if n in catalog.QUERIES]
    run(catalog.QUERIES["normalize_text"](spark, sf_dir))          # warm-up
    times, errors = {}, {}
    for n in names:
        best = None
        try:
            for _ in range(3):
                t0 = time.perf_counter()
                run(catalog.QUERIES[n](spark, sf_dir))
                dt = time.perf_counter() - t0
                best = dt if best is None else min(best, dt)
            times[n] = round(best, 3)
        except Exception as exc:       # keep measuring the others; report the failure
            errors[n] = repr(exc)[:300]
    # input sizes for rates (counted once, outside the timed runs)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    rates = {}
    if "normalize_text" in times:
        rates["normalize_text_docs_per_s"] = round(docs / times["normalize_text"], 1)
    if "embedding_gather" in times or "sequence_positions" in times:
        from loomprep.sources import tokens as K
        conv = spark.read.parquet(f"{sf_dir}/conversations.parquet")
        if "embedding_gather" in times:
            n = K.token_rows(K.text_sequences(conv)).count()
            rates["embedding_gather_tokens_per_s"] = round(n / times["embedding_gather"], 1)
        if "sequence_positions" in times:
            n = K.token_rows(K.mm_sequences(conv)).count()
            rates["sequence_positions_tokens_per_s"] = round(n / times["sequence_positions"], 1)
    sf = os.path.basename(sf_dir).replace("sf", "")
    out = {"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
           "cpus": cpus, "rates": rates}
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
