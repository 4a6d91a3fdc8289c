"""Property tests: generated frames with ties, missing values and a hot era."""

import numpy as np
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from erascore.operators import ranking

values = st.one_of(st.none(), st.sampled_from([0.0, 0.25, 0.5, 0.75, 1.0]), st.floats(0, 1, allow_nan=False))
rows = st.lists(st.tuples(st.sampled_from([1, 1, 1, 2, 3]), values), min_size=1, max_size=40)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=rows, strategy=st.sampled_from(["range", "window"]))
def test_rank_pct_first_property(spark, data, strategy):
    pdf = pd.DataFrame(data, columns=["era", "p"])
    pdf["idx"] = np.arange(len(pdf))
    df = spark.createDataFrame(pdf.astype({"p": "float64"}), "era long, p double, idx long") \
        .withColumn("p", F.when(~F.isnan("p"), F.col("p")))
    got = ranking.rank_pct_first(df, "p", ["era"], ["idx"], strategy=strategy, num_partitions=3)
    got = got.toPandas().set_index("idx")["rank_pct"].sort_index()
    exp = pdf.groupby("era")["p"].rank(pct=True, method="first").sort_index()
    assert np.allclose(got.astype(float).fillna(-1).values, exp.fillna(-1).values)
