from __future__ import annotations

import pytest

from leadtide.llm.queries import ORACLES, QUERIES
from tests.compare import difference, duck
from tests.llm.frames import SF


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, name):
    assert difference(QUERIES[name](spark, SF).toPandas(), duck(SF).execute(ORACLES[name]).df()) is None


def test_every_operator_is_registered():
    assert [int(n[2:].split("_")[0]) for n in QUERIES] == list(range(1, 14))
