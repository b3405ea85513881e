"""Write PLANS.md: the physical plan tree of the headline queries (``explain('formatted')``).

usage: python tools/plans.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import HEADLINE  # noqa: E402
from tally.plans.catalog import QUERIES  # noqa: E402
from tally.session import get_session  # noqa: E402


def tree(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    head = text.split("\n\n")[0]
    pushed = sorted({ln.strip() for ln in text.splitlines() if ln.strip().startswith("PushedFilters")})
    return head + ("\n" + "\n".join(pushed) if pushed else "")


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session("local[8]", shuffle_partitions=16)
    out = ["# Physical plans of the headline queries", "",
           f"`python tools/plans.py {sf_dir}` — the final query of each (steps that checkpoint, such as the position",
           "step, ran before and appear here as `Scan ExistingRDD`).", ""]
    for name in HEADLINE:
        out += [f"## {name}", "", "```", tree(QUERIES[name](spark, sf_dir)), "```", ""]
    open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w").write(
        "\n".join(out))


if __name__ == "__main__":
    main()
