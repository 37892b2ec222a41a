"""Print the formatted physical plan of registered queries.

Usage: python tools/explain.py [sf_dir] name [name ...]
"""

import sys

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from gridcast.plans.queries import Q  # noqa: E402
from gridcast.session import get_session  # noqa: E402


def main():
    sf = sys.argv[1]
    spark = get_session("local[8]", 8)
    for name in sys.argv[2:]:
        print(f"===== {name}")
        Q[name](spark, sf).explain("formatted")


if __name__ == "__main__":
    main()
