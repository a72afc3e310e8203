"""Operators leave the session's settings as they are, but for the bound on Arrow batches."""

import pytest

from quayside.llm.common import BATCH_BYTES
from quayside.llm.queries import QUERIES

BOUND = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.mark.parametrize("name", ["op3_token_files", "op6_mix", "op8_top_k", "op9_simhash", "op13_permutation_index"])
def test_settings_stay(spark, sf_dir, name):
    before = dict(spark.conf.getAll)
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    after = dict(spark.conf.getAll)
    assert after.pop(BOUND, str(BATCH_BYTES)) == str(BATCH_BYTES)
    before.pop(BOUND, None)
    assert after == before
