"""Write ``explain("formatted")`` of selected registered queries to docs/plans/.

    python tools/dump_plans.py [sf_dir] [name ...]

Intermediates that a query materializes run while the query is built, so
the dumped plan starts from their parquet tables; ``band_buckets`` shows
the sketch and index stages in full.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

DEFAULT = ["band_buckets", "doc_near_duplicates", "cs_pairs", "cosine_topk", "rp_probe_topk", "minhash_union"]


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or DEFAULT
    from simpairs.plans.queries import QUERIES
    from simpairs.session import local_session

    spark = local_session()
    out_dir = os.path.join(ROOT, "docs", "plans")
    os.makedirs(out_dir, exist_ok=True)
    for name in names:
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            QUERIES[name](spark, sf_dir).explain("formatted")
        # temp folders differ per run; keep the plan text stable
        text = re.sub(r"file:[^\s,\]]+", "file:<path>", buf.getvalue())
        with open(os.path.join(out_dir, f"{name}.txt"), "w") as fh:
            fh.write(text)
        print(name, len(text))


if __name__ == "__main__":
    main()
