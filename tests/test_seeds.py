from __future__ import annotations

import pytest

from schoolmetrics.operators import features, models
from schoolmetrics.sources.driver_tables import entities


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_segments_do_not_follow_a_setting(spark, sf):
    numbers = features.student_features(entities(spark, f"/root/testdata/sf{sf}"))
    before, found = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for parts in ("2", "8", "64"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            rows = models.segment_students(numbers).select("student_id", "cluster").collect()
            found.append(sorted(map(tuple, rows)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1] == found[2]
