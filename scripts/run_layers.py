"""spark-submit runner for the layer jobs.

    spark-submit --py-files ledgerlake.zip scripts/run_layers.py --layers all \\
        --merchants-csv s3://…/merchants.csv --transactions s3://…/txns/ --root s3://…/warehouse

(``ledgerlake.zip`` is the ``ledgerlake`` package zipped, so executors can
import it.)  With a local master, ``python -m ledgerlake.plans.cli`` does the
same.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerlake.plans.cli import main  # noqa: E402

if __name__ == "__main__":
    print(" ".join(main(sys.argv[1:])))
