"""Print the formatted physical plan of one registered job.

    python tools/explain.py feature_table [--sf /root/testdata/sf0.01]
"""

from __future__ import annotations

import argparse
import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def main(argv=None):
    ap = argparse.ArgumentParser()
    ap.add_argument("key")
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    a = ap.parse_args(argv)
    from daycast.session import get_session
    from daycast.registry import QUERIES
    spark = get_session("local[8]", shuffle_partitions=16)
    QUERIES[a.key](spark, a.sf).explain("formatted")
    spark.stop()


if __name__ == "__main__":
    main()
