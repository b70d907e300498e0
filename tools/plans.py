"""Write the executed (post-AQE) formatted plan of every registered query to docs/plans/.

Usage: python tools/plans.py [SF_DIR [NAME...]]   (default /root/testdata/sf0.01, all queries)
"""

from __future__ import annotations

import os
import re
import sys

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, HERE)

from formlake.plans.queries import QUERIES  # noqa: E402
from formlake.session import local_session  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    out_dir = os.path.join(HERE, "docs", "plans")
    os.makedirs(out_dir, exist_ok=True)
    spark = local_session(8)
    spark.conf.set("spark.sql.maxMetadataStringLength", "400")
    names = sys.argv[2:] or list(QUERIES)
    for name, query in ((n, QUERIES[n]) for n in names):
        df = query(spark, sf_dir)
        df._jdf.queryExecution().toRdd().count()  # runs this plan, so AQE finalizes it
        text = spark.sparkContext._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(
            df._jdf.queryExecution(), "formatted"
        )
        text = re.sub(r"file:/[^\]\s,]*/", "file:.../", text)
        with open(os.path.join(out_dir, f"{name}.txt"), "w") as f:
            f.write(f"# {name} at {os.path.basename(sf_dir)} (executed plan)\n\n{text}")
    print(f"wrote {len(names)} plans to {out_dir}")


if __name__ == "__main__":
    main()
