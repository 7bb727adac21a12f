"""The registered queries against their SQL, and the guard around them."""

import pytest

from compare import compare, connect
from loadbay.llm import registry

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_query(spark, name):
    assert compare(spark, connect(SF), name, registry.QUERIES[name], registry.ORACLE[name], SF) is None


def test_every_operator_is_registered_once():
    numbers = sorted(int(n[2:].split("_")[0]) for n in registry.QUERIES if n.startswith("op"))
    assert numbers == list(range(1, 14)) and "pipeline" in registry.QUERIES
