import pytest

from tests.notation_cases import CASES
from tests.oracle import compare
from tests.test_queries import SF


@pytest.mark.parametrize("name", sorted(CASES))
def test_a_text_gives_what_was_worked_out_by_hand(spark, name):
    f, sql = CASES[name]
    assert compare(spark, name, f, sql, SF) > 0
