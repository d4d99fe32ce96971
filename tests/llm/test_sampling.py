import numpy as np
import pytest
from pyspark.sql import functions as F

from brickyard.llm.common import first_by_hash


@pytest.mark.parametrize("size", [1, 30, 5000])
def test_first_rows_by_hash(spark, size):
    rng = np.random.default_rng(0)
    rows = [("a", int(h), f"t{h}") for h in rng.integers(-(2**63), 2**63 - 1, 2000)]
    rows += [("b", int(h), f"t{h}") for h in rng.integers(-(2**63), 2**63 - 1, 40)] + [("a", 17, "copy")] * 3000 + [("c", -(2**63), "least")] * 50
    got = first_by_hash(spark.createDataFrame(rows, "stratum string, h long, text string").repartition(5), size)
    want = [(s, h) for s in "abc" for h in sorted({h for t, h, _ in rows if t == s})[:size]]
    assert [(r["stratum"], r["h"]) for r in got] == want
    assert all(r["text"] in (f"t{r['h']}", "copy", "least") for r in got)


def test_nothing(spark):
    assert first_by_hash(spark.range(0).select(F.lit("x").alias("stratum"), F.col("id").alias("h"), F.lit("t").alias("text")), 10) == []
