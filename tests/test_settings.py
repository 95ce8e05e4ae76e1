"""What a session is given, and what it keeps."""

import pytest

from lateline.workspace import PREFERRED, configure


@pytest.mark.parametrize("key, other", [("spark.sql.files.maxPartitionBytes", "1048576"), ("spark.sql.parquet.compression.codec", "gzip")])
def test_splits_that_fit_in_memory_unless_the_session_has_its_own(spark, key, other):
    fresh = spark.newSession()
    assert configure(fresh).conf.get(key) == PREFERRED[key]
    own = spark.newSession()
    own.conf.set(key, other)
    assert configure(own).conf.get(key) == other
