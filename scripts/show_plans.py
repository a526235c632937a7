"""Print the formatted physical plans of registered queries (plan review).

    python scripts/show_plans.py [sf_dir] [name ...]

Shows scans (ReadSchema / PushedFilters / Bucketed), exchanges, join
strategies and the Python steps, without running the queries.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    args = sys.argv[1:]
    sf_dir = "/root/testdata/sf0.1"
    if args and args[0].startswith("/"):
        sf_dir, args = args[0], args[1:]
    from trawl.plans.catalog import QUERIES
    from trawl.session import local_session

    spark = local_session()
    for name in args or ["page_text", "page_entities", "link_entities", "linked_relations", "score_entity"]:
        print(f"===== {name}")
        QUERIES[name](spark, sf_dir).explain("formatted")


if __name__ == "__main__":
    main()
