from __future__ import annotations

import pytest

from talentsift.llm.common import ship

#: Documents with a null id, a null and an empty text, one very long text without a break, repeats, and one id with two texts.
ODD = [
    (None, "One two three four five six seven. Eight nine ten."),
    (1, None),
    (2, ""),
    (3, "x" * 60_000),
    (4, "alpha beta gamma delta epsilon zeta eta theta iota kappa"),
    (4, "alpha beta gamma delta epsilon zeta eta theta iota kappa"),
    (5, "alpha beta gamma delta epsilon zeta eta theta iota kappa"),
    (6, "first text of six\nwith two lines"),
    (6, "second text of six, quite another one"),
    (7, "  !? \n\n "),
]


@pytest.fixture(autouse=True)
def code_on_workers(spark):
    ship(spark)


@pytest.fixture
def make_docs(spark):
    """Documents with further columns whose names the operators use for their own."""

    def make(rows, *clashing):
        frame = spark.createDataFrame(rows, "doc_id bigint, text string")
        return frame.selectExpr("*", *(f"cast(null as string) as {name}" for name in clashing))

    return make
