"""Cases beyond usual ranges: borders near zero, any year, fractional percentiles."""

import math

import pytest
from pyspark.sql import functions as F

from fixtrail.functions.calendar import with_holiday_flag
from fixtrail.operators.hbos import EDGE_TOLERANCE, Histogram
from fixtrail.operators.thresholds import Threshold, with_labels, threshold_metrics


@pytest.mark.parametrize(("low", "high"), [(1.0, 21.0), (0.1, 2.1), (-21.0, -1.0), (0.0, 23.0), (5.0, 5.0)])
def test_outermost_border_is_the_last_double_that_counts(low, high):
    h = Histogram("hora", 10, low, high, (1,) * 10)
    borders = h.lookup_splits
    highest = -borders[1]
    reach = (h.edges[-1] - h.edges[-2]) * EDGE_TOLERANCE
    assert highest - h.edges[-1] <= reach < math.nextafter(highest, math.inf) - h.edges[-1]
    lowest = -math.nextafter(borders[-2], -math.inf)
    reach = (h.edges[1] - h.edges[0]) * EDGE_TOLERANCE
    assert h.edges[0] - lowest <= reach < h.edges[0] - math.nextafter(lowest, -math.inf)


def test_holidays_of_any_year(spark):
    days = ["1850-12-25", "2150-12-25", "2150-09-07", "2150-03-03", "1850-03-29", "2019-11-20", "2024-11-20"]
    rows = spark.createDataFrame([(d,) for d in days], "d string").withColumn("timestamp", F.col("d").cast("timestamp_ntz"))
    found = {r["d"]: r["eh_feriado"] for r in with_holiday_flag(rows).collect()}
    # 25 December is listed from 1922 on; Good Friday of 1850 was 29 March
    assert found == dict(zip(days, [0, 1, 1, 0, 1, 0, 1], strict=True))


def test_fractional_percentile_and_long_counts(spark):
    t = Threshold("m", 99.9, 5.0, "Train")
    df = with_labels(spark.range(10).withColumn("s", F.col("id").cast("double")), [t], {"m": "s"})
    out = threshold_metrics(df, [t])
    assert dict(out.dtypes)["Anomalies_Detected"] == "bigint"
    assert out.first()["Anomalies_Detected"] == 5
