"""Print the final adaptive plan tree of every registered shop query (markdown).

Usage: python scripts/show_plans.py [sf_dir] > PLANS.md
Each query runs once (collect) so that the plan shown is AQE's final plan,
with run-time decisions such as broadcast conversions and reused exchanges.
"""

import contextlib
import io
import sys

sys.path.insert(0, __file__.rsplit("/scripts/", 1)[0])

from shoplens.plans.queries import registry  # noqa: E402
from shoplens.session import build_session  # noqa: E402


def tree(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    head = text.split("\n\n\n")[0] if "\n\n\n" in text else text.split("\n(1)")[0]
    final = head.split("+- == Initial Plan ==")[0]
    return final.strip()


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", 8)
    print("# Final physical plans\n")
    print(f"Generated by `scripts/show_plans.py` on `{sf_dir}` (local[8], AQE on): the final\n"
          "adaptive plan of each registered shop query after one run.  `ReusedExchange` marks a\n"
          "shuffle computed once and read twice; `WindowGroupLimit` before an `Exchange` is the\n"
          "partial top-k; `BroadcastHashJoin` sides passed a size check or a proven row bound.\n")
    for name, fn in registry().items():
        df = fn(spark, sf_dir)
        df.collect()
        print(f"## {name}\n\n```\n{tree(df)}\n```\n")
    spark.stop()


if __name__ == "__main__":
    main()
