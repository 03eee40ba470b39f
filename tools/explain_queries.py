"""Print the formatted physical plan of named queries.

    python tools/explain_queries.py [sf_dir] name [name ...]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tablekit.plans import queries  # noqa: E402
from tablekit.plans.explain import plan_text  # noqa: E402
from tablekit.session import get_session  # noqa: E402


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and "/" in argv[1] else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if "/" not in a]
    spark = get_session("local[8]", shuffle_partitions=8)
    qs = queries()
    for n in names:
        print(f"===== {n}")
        print(plan_text(qs[n](spark, sf_dir)))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
