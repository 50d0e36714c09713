"""Print the physical plan of registered queries: python tools/explain.py [sf_dir] name ..."""
import sys

sys.path.insert(0, ".")
from gridspark.plans import catalog  # noqa: E402
from gridspark.session import local_session  # noqa: E402

sf = sys.argv[1]
spark = local_session()
for name in sys.argv[2:]:
    print(f"===== {name}")
    catalog.QUERIES[name](spark, sf).explain("formatted")
