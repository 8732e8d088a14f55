"""Write k id-shifted copies of the input tables into a scratch folder, for

    python scripts/scale_copies.py SRC_DIR DST_DIR [k]
    BENCH_SF_DIR=DST_DIR python bench.py normalize_text round_robin_mix ...

Keys are shifted per copy so every copy is a new set of rows; `embeddings`
is copied once (the vocabulary does not grow with the corpus).
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

KEYS = {"documents": ["doc_id"], "conversations": ["conv_id"], "pages": ["page_id"],
        "events": ["event_id", "user_id"], "embeddings": []}


def main() -> None:
    src, dst = sys.argv[1].rstrip("/"), sys.argv[2].rstrip("/")
    k = int(sys.argv[3]) if len(sys.argv) > 3 else 10
    from pyspark.sql import functions as F
    from loomprep.session import build_session
    spark = build_session(8)
    for t, keys in KEYS.items():
        df = spark.read.parquet(f"{src}/{t}.parquet")
        if keys:
            width = {c: df.agg(F.max(c)).first()[0] + 1 for c in keys}
            copies = [df.withColumns({c: F.col(c) + F.lit(i * width[c]) for c in keys}) for i in range(k)]
            out = copies[0]
            for c in copies[1:]:
                out = out.unionByName(c)
            df = out.repartition(2 * k)
        df.write.mode("errorifexists").parquet(f"{dst}/{t}.parquet")
    print(dst)


if __name__ == "__main__":
    main()
