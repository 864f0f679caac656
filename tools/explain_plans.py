"""Write the formatted physical plans of named queries to one text file.

python tools/explain_plans.py [sf_dir] [out_file] [names...]
"""

import io
import os
import sys
from contextlib import redirect_stdout

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from readyspark.plans.queries import QUERIES  # noqa: E402
from readyspark.session import build_session  # noqa: E402

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
out_file = sys.argv[2] if len(sys.argv) > 2 else "/tmp/plans.txt"
names = sys.argv[3:] or list(QUERIES)
spark = build_session("local[8]", shuffle_partitions=16)
with open(out_file, "w") as fh:
    for name in names:
        buf = io.StringIO()
        with redirect_stdout(buf):
            QUERIES[name](spark, sf).explain("formatted")
        fh.write(f"===== {name}\n{buf.getvalue()}\n")
print(out_file)
